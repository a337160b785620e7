"""Toxicity: a label model weighs many voters, and a linear classifier learns from the labels it infers."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import carrying, cut, let

#: Labelled documents that are learned from, at most; which ones, a hash of the id decides.
SAMPLE = 16_000
#: Lexicon voters, and words and stems in each.
LEXICONS, ENTRIES = 24, 8
#: Words and stems of the classifier, and documents that one must be in.
VOCABULARY, LEAST_DOCUMENTS = 5_000, 4
#: How surely a word must mark toxic documents to be in a lexicon, were there as many of them as of others.
PRECISION = 0.98
#: Partitions of the sample while the classifier is fitted to it.
FIT_PARTITIONS = 6
STEMS = (4, 5, 6)
REGULARITY = 1e-4
_WORD = re.compile(r"[^\W\d_]+")
#: Patterns that vote for abuse where they are found (true) or for its absence.
PATTERNS = (
    (r"(?iU)\b(?:you|tu|du|ihr|vous|tú)\b[^.!?\n]{0,40}!", True),
    (r"[!?]{3,}", True),
    (r"(?U)\b(?:[A-Z]{3,}\W+){4}", True),
    (r"(?U)(\w)\1{4}", True),
    (r"(?iU)\b(?:shut up|get lost|hate you)\b", True),
)


def features(text: str | None) -> list[str]:
    """The distinct words of a text in lower case, and their stems of some lengths; none for null."""
    found = set(_WORD.findall((text or "").lower()))
    stems = {f"{w[:n]}*" for w in found for n in STEMS if len(w) >= n}
    return sorted(found | stems)


def features_of(text: Column) -> Column:
    """``features`` as a column, in any order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{Nl}\p{No}]+"), F.lit(0))

    def stems(found: Column, n: int) -> Column:
        return F.transform(F.filter(found, lambda w: F.char_length(w) >= n), lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*")))

    return let(F.array_distinct(words), lambda found: F.array_distinct(F.concat(found, *(stems(found, n) for n in STEMS))))


def patterns_of(text: Column) -> Column:
    """Which of the patterns a text has."""
    return F.array(*(F.coalesce(text, F.lit("")).rlike(pattern) for pattern, _ in PATTERNS))


@dataclass
class LabelModel:
    """The voters' accuracies and correlations, estimated from how they agree; votes are 1, -1 or 0 for none.

    Given the label, a voter votes for or against it with the chances in ``chances``. They are estimated by expectation
    maximisation. Voters that still go together once the label is known (``correlation``) say less than they seem to: each
    counts as a part of one, by how many it goes along with.
    """

    chances: np.ndarray = field(default_factory=lambda: np.zeros((0, 2, 3)))
    correlation: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    prior: float = 0.5

    def _evidence(self, votes: np.ndarray) -> np.ndarray:
        says = np.log(self.chances[:, 1]) - np.log(self.chances[:, 0])
        each = np.take_along_axis(says[None], votes[:, :, None] + 1, axis=2)[:, :, 0] if votes.shape[1] else np.zeros(votes.shape)
        alike = np.where(np.abs(self.correlation) > 0.2, np.abs(self.correlation), 0)
        return each @ (1 / np.maximum(1, alike.sum(1)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        score = np.log(self.prior / (1 - self.prior)) + self._evidence(votes)
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))

    def fit(self, votes: np.ndarray, start: np.ndarray, rounds: int = 20) -> LabelModel:
        """``start``: a first guess of the labels' chances, between 0 and 1."""
        n, m = votes.shape
        kinds = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
        weight = start
        for _ in range(rounds):
            both = np.stack([1 - weight, weight])
            self.chances = (np.einsum("yn,nmv->myv", both, kinds) + 0.5) / (both.sum(1)[None, :, None] + 1.5)
            self.prior = float(np.clip(weight.mean(), 1e-3, 1 - 1e-3))
            expected = np.einsum("yn,myv,v->nm", both, self.chances, np.array([-1.0, 0.0, 1.0]))
            rest = votes - expected
            spread = rest.std(0) + 1e-9
            self.correlation = (rest.T @ rest) / n / np.outer(spread, spread)
            new = self.posterior(votes)
            if np.abs(new - weight).max() < 1e-4:
                break
            weight = new
        return self


def _lexicons(counts: dict[str, tuple[int, int]], toxic: int, others: int) -> list[list[str]]:
    """Groups of words and stems that mark toxic documents of the sample, the strongest first, dealt out in turn.

    ``counts``: of each word the toxic documents that have it, and the others.
    """
    n, m = max(1, toxic), max(1, others)
    sure = {f: c for f, (c, rest) in counts.items() if c >= 2 * LEAST_DOCUMENTS and c / n > PRECISION / (1 - PRECISION) * rest / m}
    best = sorted(sure, key=lambda f: (-sure[f], f))[: LEXICONS * ENTRIES]
    return [best[i::LEXICONS] for i in range(LEXICONS)] if best else []


def _voted(lexicons: list[list[str]]) -> Callable[[Column, Column, Column], Column]:
    """A vote for each lexicon (for where a word is found, else none), pattern, for no lexicon word at all, and the label."""

    def votes(features: Column, patterns: Column, toxic: Column) -> Column:
        words = [F.arrays_overlap(features, F.array(*map(F.lit, lexicon))) for lexicon in lexicons]
        none = ~F.array_contains(F.array(F.lit(False), *words), True)
        seen = [F.when(patterns[i], 1 if abuse else -1).otherwise(0) for i, (_, abuse) in enumerate(PATTERNS)]
        each = [*(word.cast("int") for word in words), *seen, -none.cast("int"), 2 * toxic.cast("int") - 1]
        return F.array(*(vote.cast("tinyint") for vote in each))

    return votes


def first_guess(votes: np.ndarray, lexicons: int) -> np.ndarray:
    """Where the label model begins: likely toxic if any lexicon votes, the more so the more do. The given label has no say."""
    found = (votes[:, :lexicons] > 0).sum(1)
    return np.where(found == 0, 0.05, 1 - 0.5 ** (found + 1.0))


@dataclass(frozen=True)
class Classifier:
    """Weights of words and stems; ``model`` has them for Spark, and is none where every text gets the score of ``bias``."""

    weights: dict[str, float]
    bias: float
    vocabulary: tuple[str, ...] = ()
    model: LogisticRegressionModel | None = None

    def score(self, text: str | None) -> float:
        get = self.weights.get
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(get(f, 0.0) for f in features(text)), -30, 30))))

    def scored(self, documents: DataFrame, name: str) -> DataFrame:
        """The documents and the score of their text, 0 to 1; null and empty texts are scored as texts without words."""
        if self.model is None:
            return documents.withColumn(name, F.lit(self.score(None)))
        counter = CountVectorizerModel.from_vocabulary(list(self.vocabulary), inputCol="_features", outputCol="_vector").setBinary(True)
        model = self.model.copy().setFeaturesCol("_vector").setProbabilityCol("_chances").setRawPredictionCol("").setPredictionCol("")

        def run(rows: DataFrame) -> DataFrame:
            rows = model.transform(counter.transform(rows.withColumn("_features", features_of(F.col("text")))))
            return rows.withColumn(name, vector_to_array("_chances")[1]).drop("_features", "_vector", "_chances")

        return carrying(documents, run)


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def learned(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """A classifier learned from at most ``sample`` labelled documents that are not held out.

    Lexicons (learned from these documents), patterns and the given label vote. How far each can be trusted, the given label
    too, is estimated, beginning with what the lexicons say. The label model's posterior is what the classifier is fitted to,
    each document once as toxic and once as not, weighed by it. Without any labelled document, or with labels of one kind
    only, every text gets that kind's score: 0, or 1 if all are toxic. Null labels are no labels; of several labels of one
    document the greatest counts, and of documents with one id the one whose text has the least hash.
    """
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    marked = marked.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    marked = F.broadcast(marked.select(F.col("doc_id").alias("_id"), "_toxic"))  # at most ``sample`` rows
    chosen = documents.select("doc_id", "text").join(marked, F.col("doc_id") == F.col("_id")).groupBy("doc_id")
    chosen = chosen.agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"), F.max("_toxic").alias("_toxic"))
    rows = cut(chosen.select("doc_id", F.col("_toxic").alias("toxic"), features_of(F.col("text")).alias("features"), patterns_of(F.col("text")).alias("patterns")))
    kinds = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return Classifier({}, 30.0 if kinds and max(kinds) else -30.0)

    inside = F.sum(F.col("toxic").cast("int"))
    counts = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.count("*").alias("n"), inside.alias("t"))
    rate = kinds.get(1, 0) / sum(kinds.values())
    surprise = (F.col("t") - rate * F.col("n")) / F.sqrt(rate * (1 - rate) * F.col("n"))
    words = counts.filter(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.abs(surprise).desc(), "feature").limit(VOCABULARY)
    listed = words.select("feature", "n", "t").collect()  # at most VOCABULARY
    vocabulary = [r["feature"] for r in listed]
    if not vocabulary:
        return Classifier({}, float(np.log(rate / (1 - rate))))

    strong = {r["feature"]: (r["t"], r["n"] - r["t"]) for r in listed}
    lexicons = _lexicons(strong, kinds.get(1, 0), kinds.get(0, 0))
    ballots = _voted(lexicons)(F.col("features"), F.col("patterns"), F.col("toxic"))
    voted = rows.select("doc_id", "toxic", ballots.alias("votes")).toPandas()  # at most ``sample`` rows of some bytes
    votes = np.stack(voted["votes"].to_list()).astype(np.int64)
    chances = LabelModel().fit(votes, first_guess(votes, len(lexicons))).posterior(votes)
    inferred = rows.sparkSession.createDataFrame(pd.DataFrame({"_id": voted["doc_id"], "_chance": chances}))
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("_chance").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("_chance")).alias("weight")))).alias("kind")
    known_rows = rows.join(F.broadcast(inferred), F.col("doc_id") == F.col("_id")).select("features", both).select("features", "kind.*").filter("weight > 0.001")
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="features", outputCol="vector").setBinary(True)
    # A bounded sample, and a job for each round of the fit: few partitions.
    vectors = cut(counter.transform(known_rows).select("vector", "label", "weight").coalesce(FIT_PARTITIONS))
    model = LogisticRegression(featuresCol="vector", labelCol="label", weightCol="weight", regParam=REGULARITY, maxIter=60, standardization=False).fit(vectors)
    weights = {w: float(x) for w, x in zip(vocabulary, model.coefficients.toArray(), strict=True) if abs(x) > 1e-6}
    return Classifier(weights, float(model.intercept), tuple(vocabulary), model)


def scored(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every row of the documents with all its columns, and ``_held_out`` and ``_score`` (in place of any so named)."""
    own = documents.drop("_held_out", "_score")
    return learned(documents, labels, sample).scored(own, "_score").withColumn("_held_out", held_out(F.col("doc_id")))


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    scores = next(n for i in range(10**6) if (n := f"score {i}") not in documents.columns)
    return learned(documents, labels).scored(documents, scores).filter(F.col(scores) < 0.5).drop(scores)
