from __future__ import annotations

import re

import numpy as np
import pandas as pd
from conftest_llm import SF_DIR

from pyspark.sql import functions as F

from stopline.llm.queries import op1_toxicity
from stopline.llm.toxicity import LEAST_DOCUMENTS, PATTERNS, LabelModel, _lexicons, _voted, features, features_of, first_guess, held_out, learned, patterns_of, scored, without_toxic


def test_held_out_accuracy(spark):
    directory = SF_DIR.replace("sf0.01", "sf0.1")
    got = op1_toxicity(spark, directory).toPandas()
    assert len(got) == len(pd.read_parquet(f"{directory}/documents.parquet"))
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    both = got[got["held_out"]].merge(pd.read_parquet(f"{directory}/labels.parquet"), on="doc_id")
    toxic = both["toxic"] == 1
    assert ((both["predicted"] == 1) == toxic).mean() > 0.97
    assert both.loc[toxic, "score"].median() > 0.9 and both.loc[~toxic, "score"].median() < 0.1
    pairs = both.loc[toxic, "score"].to_numpy()[:, None] - both.loc[~toxic, "score"].to_numpy()
    assert (pairs > 0).mean() + (pairs == 0).mean() / 2 > 0.98


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    accuracy = [0.95, 0.8, 0.8, 0.65, 0.6]
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    votes = np.concatenate([votes, votes[:, [3]], votes[:, [3]]], axis=1)  # one voter three times over
    model = LabelModel().fit(votes, (votes[:, :3].sum(1) > 0) * 0.8 + 0.1)
    right = (model.chances[:, 0, 0] * (1 - model.prior) + model.chances[:, 1, 2] * model.prior)[:5]
    assert np.abs(right - accuracy).max() < 0.08
    assert model.correlation[3, 5] > 0.9 and abs(model.correlation[0, 1]) < 0.2
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93


def test_odd_rows_and_missing_labels(spark, odd, documents):
    schema = "doc_id long, quality int, toxic int, extra string"
    none = scored(odd, spark.createDataFrame([], schema))
    assert none.count() == odd.count() and none.select("_score").distinct().count() == 1
    labels = spark.createDataFrame([(4, 1, 1, "x"), (4, 1, 0, "x"), (5, 1, 0, "x"), (7, None, 0, "x"), (None, 0, 1, "x"), (6, 1, None, "x")], schema)
    assert scored(odd, labels).filter("_score between 0 and 1").count() == odd.count()
    assert without_toxic(odd, labels).columns == odd.columns
    assert without_toxic(documents([]), labels).count() == 0


def test_held_out_rows_are_not_learned_from(spark, documents):
    docs = documents([(i, f"good words {i}") for i in range(60)])
    out = {r["doc_id"] for r in docs.filter(held_out(docs["doc_id"])).collect()}
    labels = [(i, int(i in out)) for i in range(60)]
    assert learned(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).score("good words") < 0.5


def plain_em(votes, start, rounds):
    """The label model with loops: chances by expected counts, correlations of what is left, posterior by their parts."""
    n, m = len(votes), len(votes[0])
    weight = list(start)
    for _ in range(rounds):
        chance = [[[0.5] * 3 for _ in range(2)] for _ in range(m)]
        for row, w in zip(votes, weight, strict=True):
            for j, v in enumerate(row):
                chance[j][1][v + 1] += w
                chance[j][0][v + 1] += 1 - w
        total = [sum(1 - w for w in weight) + 1.5, sum(weight) + 1.5]
        chance = [[[c / total[y] for c in chance[j][y]] for y in range(2)] for j in range(m)]
        prior = sum(weight) / n
        mean = [[chance[j][y][2] - chance[j][y][0] for y in range(2)] for j in range(m)]
        rest = [[v - (1 - w) * mean[j][0] - w * mean[j][1] for j, v in enumerate(row)] for row, w in zip(votes, weight, strict=True)]
        centre = [sum(r[j] for r in rest) / n for j in range(m)]
        spread = [(sum((r[j] - centre[j]) ** 2 for r in rest) / n) ** 0.5 + 1e-9 for j in range(m)]
        alike = [[sum(r[j] * r[k] for r in rest) / n / spread[j] / spread[k] for k in range(m)] for j in range(m)]
        part = [1 / max(1.0, sum(abs(a) for a in alike[j] if abs(a) > 0.2)) for j in range(m)]
        score = [np.log(prior / (1 - prior)) + sum(part[j] * np.log(chance[j][1][v + 1] / chance[j][0][v + 1]) for j, v in enumerate(row)) for row in votes]
        weight = [1 / (1 + np.exp(-max(-30, min(30, x)))) for x in score]
    return np.array(chance), prior, np.array(alike), np.array(weight)


def test_voters_guess_rounds_and_posterior_against_a_plain_version(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(300):
        toxic = int(rng.random() < 0.3)
        found = [w for j, w in enumerate(words) if rng.random() < (0.5 if toxic and j < 6 else 0.0 if j < 6 else 0.2)]
        rows.append((i, found, [bool(rng.random() < 0.1 + 0.3 * toxic) for _ in PATTERNS], int(toxic if rng.random() < 0.9 else 1 - toxic)))
    counts = {w: (sum(w in f and t for _, f, _, t in rows), sum(w in f and not t for _, f, _, t in rows)) for w in words}
    toxic = sum(t for *_, t in rows)
    lexicons = _lexicons(counts, toxic, len(rows) - toxic)
    sure = [w for w, (c, r) in counts.items() if c >= 2 * LEAST_DOCUMENTS and c / toxic > 49 * r / (len(rows) - toxic)]
    assert sorted(w for lexicon in lexicons for w in lexicon) == sorted(sure)
    lexicons = [words[:2], words[2:4], words[4:6]]
    frame = spark.createDataFrame(rows, "doc_id long, features array<string>, patterns array<boolean>, toxic int")
    votes = frame.select("doc_id", _voted(lexicons)(F.col("features"), F.col("patterns"), F.col("toxic")).alias("votes")).orderBy("doc_id").collect()
    want = []
    for _, found, signs, label in rows:
        by_word = [int(any(w in found for w in lexicon)) for lexicon in lexicons]
        by_sign = [(1 if abuse else -1) if here else 0 for here, (_, abuse) in zip(signs, PATTERNS, strict=True)]
        want.append([*by_word, *by_sign, 0 if any(by_word) else -1, 1 if label else -1])
    assert [list(r["votes"]) for r in votes] == want
    start = first_guess(np.array(want), 3)
    assert list(start) == [0.05 if not (k := sum(v > 0 for v in row[:3])) else 1 - 0.5 ** (k + 1) for row in want]
    model = LabelModel().fit(np.array(want), start, rounds=4)
    chance, prior, alike, posterior = plain_em(want, start, 4)
    assert np.allclose(model.chances, chance) and np.isclose(model.prior, prior) and np.allclose(model.correlation, alike)
    assert np.allclose(model.posterior(np.array(want)), posterior, atol=1e-6)


def test_documents_with_one_id_are_learned_from_in_one_way(spark, documents):
    rows = [(i, f"{'vile nasty' if i % 2 else 'kind warm'} words number{i}") for i in range(80)] + [(i, f"other text {i}") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    first, second = (learned(documents(given).repartition(7), labels) for given in (rows, rows[::-1]))
    assert set(first.weights) == set(second.weights)


def test_features_and_patterns_against_plain_python(spark, odd):
    texts = [None, "", "Żółć ÅNGSTRÖM naïve_word x1y2 ½ Ⅷ １２３ ẞtraße", "日本語のテキスト 中文", "go " * 50_000, "A" * 300_000, "SHOUT " * 60_000, "İstanbul ΣΑΣ ǅ", "you are, well, bad!\n", "hmm?!?", "sooooo", "SHUT UP", "tú eres!"]
    texts += [r["text"] for r in odd.collect()] + pd.read_parquet(f"{SF_DIR}/documents.parquet")["text"].tolist()
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = frame.select(F.sort_array(features_of(F.col("text"))).alias("f"), patterns_of(F.col("text")).alias("p"), "i").orderBy("i").collect()
    for text, row in zip(texts, got, strict=True):
        assert set(row["f"]) == set(features(text)) and len(row["f"]) == len(features(text)), text
        plain = [p.removeprefix("(?U)").replace("(?iU)", "(?i)") for p, _ in PATTERNS]
        assert list(row["p"]) == [bool(re.search(p, text or "")) for p in plain], text


def test_scores_against_the_classifier_on_one_text(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    model = learned(docs, labels)
    named = docs.withColumns({"_features": F.lit(1), "_vector": F.lit("x"), "_chances": F.lit(2), "_found": F.lit(3)})
    got = model.scored(named, "mine")
    assert got.columns == [*named.columns, "mine"]
    rows = got.collect()
    assert len(rows) == docs.count() and {(r["_features"], r["_vector"], r["_chances"], r["_found"]) for r in rows} == {(1, "x", 2, 3)}
    assert max(abs(r["mine"] - model.score(r["text"])) for r in rows) < 1e-3
