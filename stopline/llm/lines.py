"""Line deduplication across documents: equal lines, and lines within one edited word, or sign if short, of an earlier line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stopline.llm.common import BLANKS, carrying, cut, let, small, text_key
from stopline.scratch import run_folder

#: Lines with fewer words are compared as wholes, or by their signs: one word is too much of them.
MIN_WORDS = 5
#: Signs from which the query and the pipeline compare such lines by signs.
MIN_SIGNS = 5


def normalised(line: Column) -> Column:
    """A line in lower case with its words joined by one blank; empty for a blank line."""
    lower = F.lower(line)
    odd = line.startswith(" ") | line.endswith(" ")
    for blank in ("  ", "\t", "\r", "\v", "\f"):
        odd = odd | line.contains(blank)
    return F.when(odd, F.trim(F.regexp_replace(lower, f"[{BLANKS}]+", " "))).otherwise(lower)


def _lines(documents: DataFrame, *more: Column) -> DataFrame:
    """The lines with words: ``(doc_id, text_key, line_no, norm)`` and what ``more`` makes of them."""
    each = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return each.select("doc_id", "text_key", "line_no", normalised(F.col("line")).alias("norm")).filter("norm <> ''").select("*", *more)


def _content() -> tuple[Column, Column]:
    """Two hashes by which a line's content is known."""
    return F.xxhash64("norm").alias("c1"), F.xxhash64(F.lit(0), F.col("norm")).alias("c2")


def _units(signs: int | None) -> Column:
    """What a line ``norm`` is compared by: its words, or if they are few its signs.

    A sign has a blank after it, which no word has: lines of words and lines of signs have nothing in common.
    """
    words = F.split("norm", " ")
    if signs is None:
        return words
    each = F.transform(F.regexp_extract_all("norm", F.lit("(?s)(.)"), F.lit(1)), lambda sign: F.concat(sign, F.lit(" ")))
    return F.when(F.size(words) >= MIN_WORDS, words).otherwise(each)


def _outlines(words: Column, segments: int) -> Column:
    """Keys of which two lines within one edited word share at least one: the line without each of so many segments.

    The edit is in one segment of the shorter of the two, and what is before and after it is the same in both; so every line
    gives its keys as the shorter line, and as one that is a word longer than the other.
    """
    n = F.size(words)

    def without(shorter: Column, k: int) -> Column:
        head = F.floor(shorter * k / segments).cast("int")
        tail = shorter - F.floor(shorter * (k + 1) / segments).cast("int")
        parts = [F.array_join(F.slice(words, *x), " ") for x in ((F.lit(1), head), (n - tail + 1, tail))]
        if k in (0, segments - 1):  # nothing before the first segment, nothing after the last
            parts = parts[1:] if k == 0 else parts[:1]
        return F.xxhash64(shorter, F.lit(k), *parts)

    return F.array_distinct(F.array(*(without(shorter, k) for shorter in (n, n - 1) for k in range(segments))))


def _halves(signs: int | None) -> dict[str, Column]:
    """``_outlines`` by two segments, as four numbers made from ``norm`` itself; null for a line that is not compared so.

    Needs ``n``, how many words a line has or if they are few how many signs, and ``by_words``, which of the two.
    """
    n, by_words = F.col("n"), F.col("by_words")
    compared = by_words if signs is None else by_words | (n >= signs)

    def of(shorter: Column, first: bool) -> Column:
        head = F.floor(shorter / 2).cast("int")
        words = F.call_function("substring_index", F.col("norm"), F.lit(" "), head if first else head - shorter)
        letters = F.left("norm", head) if first else F.right("norm", shorter - head)
        return F.when(compared, F.xxhash64(shorter, F.lit(first), by_words, F.when(by_words, words).otherwise(letters)))

    return {f"half{2 * k + first}": of(n - k, bool(first)) for k in (0, 1) for first in (0, 1)}


def _sharing(contents: DataFrame, outlines: Column) -> DataFrame:
    """The hashes ``c1`` of contents that have an outline in common with another: a first sieve, so one hash is enough."""
    keys = contents.select("c1", F.explode(outlines).alias("outline"))
    shared = keys.groupBy("outline").agg(F.count("*").alias("n")).filter("n > 1").select("outline")
    return keys.join(shared, "outline", "left_semi").select("c1").distinct()


def _variants(contents: DataFrame) -> DataFrame:
    """Every content whole and without each of its words, as hashed keys: ``(c1, c2, whole, length, gap, key)``.

    A key is the exclusive or of hashes of the words with their places, so that all of a line's keys come from running sums
    in its length. Two lines of equal length within one replaced word have equal keys with the same gap; for a word more or
    less, the shorter line is equal to a variant of the longer one, and gaps don't count.
    """
    whole = contents.repartition("c1", "c2")  # lines travel, not their words with two hashes each: the windows need no more
    words = whole.select("c1", "c2", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    moved = F.xxhash64(F.col("at") - 1, F.col("word"))
    words = words.select("c1", "c2", "n", "at", F.xxhash64("at", "word").alias("here"), moved.alias("moved"))
    content = W.partitionBy("c1", "c2")
    before = content.orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    rest = F.coalesce(F.bit_xor("here").over(before), zero).bitwiseXOR(F.bit_xor("moved").over(content))
    rest = rest.bitwiseXOR(F.coalesce(F.bit_xor("moved").over(before), zero)).bitwiseXOR(F.col("moved"))
    gone = words.select("c1", "c2", "n", "at", rest.alias("rest"), F.bit_xor("here").over(content).alias("all"))
    n, at = F.col("n"), F.col("at")

    def variant(whole: bool, length: Column, gap: Column, key: Column) -> Column:
        return F.struct(F.lit(whole).alias("whole"), length.alias("length"), gap.alias("gap"), key.alias("key"))

    replaced, shorter = variant(False, n, at, F.col("rest")), variant(False, n - 1, F.lit(-1), F.col("rest"))
    whole = variant(True, n, F.lit(-1), F.col("all"))
    made = F.when(at == 0, F.array(replaced, shorter, whole)).otherwise(F.array(replaced, shorter))
    return gone.select("c1", "c2", F.inline(made))


def within_one_word(a: Column, b: Column) -> Column:
    """Whether two arrays of words are within one replaced, added or left out word of each other."""

    def longer(x: Column, y: Column) -> Column:  # x has as many words as y, or one more
        same = F.zip_with(F.slice(x, F.lit(1), F.size(y)), y, lambda p, q: p == q)
        first = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0).cast("long")), F.size(y) + 1).cast("int")
        rest = F.slice(x, first + 1, F.size(x))
        return F.when(F.size(x) == F.size(y), rest == F.slice(y, first + 1, F.size(y))).otherwise(rest == F.slice(y, first, F.size(y)))

    gap = F.size(a) - F.size(b)
    return F.when(gap.isin(0, 1), longer(a, b)).when(gap == -1, longer(b, a)).otherwise(False)


def _saved_lines(documents: DataFrame, signs: int | None) -> DataFrame:
    """``(doc_id, text_key, line_no, c1, c2)`` and the halves of all lines with words, as a table in the shared folder."""
    blanks = F.octet_length("norm") - F.octet_length(F.replace("norm", F.lit(" "), F.lit("")))
    counted = _lines(documents, *_content(), (blanks + 1).alias("n_words"))
    by_words = F.col("n_words") >= MIN_WORDS
    counted = counted.withColumns({"by_words": by_words, "n": F.when(by_words, F.col("n_words")).otherwise(F.char_length("norm"))})
    halves = (c.alias(name) for name, c in _halves(signs).items())
    folder = run_folder(documents.sparkSession, "lines")
    counted.select("doc_id", "text_key", "line_no", "c1", "c2", *halves).write.parquet(folder)
    return documents.sparkSession.read.parquet(folder)


def line_contents(documents: DataFrame, saved: DataFrame, signs: int | None = None) -> DataFrame:
    """Each distinct line: where it first occurs, how often, and whether an earlier line is within one word (or sign) of it.

    ``saved`` are the lines of the documents as ``_saved_lines`` has them. Only lines that agree with another in the first
    or last half get to be compared, then only those that agree in seven of eight parts; both keep every pair within one
    word. Those give their variants.
    """
    words = _units(signs)
    place = F.struct(F.col("doc_id").alias("doc"), F.col("text_key"), F.col("line_no").alias("line"))
    halves = list(_halves(signs))
    firsts = saved.groupBy("c1", "c2").agg(F.min(place).alias("place"), F.count("*").alias("times"), *(F.max(h).alias(h) for h in halves))
    contents = cut(firsts)
    near = cut(_sharing(contents.filter("half0 is not null"), F.array(*halves)))
    texts = _lines(documents, *_content(), place.alias("place")).join(small(near), "c1", "left_semi")
    texts = texts.groupBy("c1", "c2").agg(F.first("norm").alias("norm"), F.min("place").alias("place"))
    texts = cut(texts.select("c1", "c2", "place", words.alias("words")))
    texts = cut(texts.join(_sharing(texts, let(F.col("words"), lambda w: _outlines(w, 8))), "c1", "left_semi"))

    variants = _variants(texts)
    same = ["length", "gap", "key"]
    shared = variants.groupBy(*same).agg(F.count("*").alias("n"), F.max("whole").alias("any_whole"))
    shared = shared.filter((F.col("n") > 1) & ((F.col("gap") >= 0) | F.col("any_whole"))).select(*same)
    places = texts.select("c1", "c2", "place")
    met = cut(variants.join(shared, same, "left_semi").join(places, ["c1", "c2"]))
    owner = F.struct("place", F.col("c1").alias("p1"), F.col("c2").alias("p2"))
    first = met.groupBy(*same).agg(F.min(F.when(F.col("whole"), owner)).alias("of_whole"), F.min(F.when(~F.col("whole"), owner)).alias("of_gaps"))
    partner = F.when((F.col("gap") >= 0) | F.col("whole"), F.col("of_gaps")).otherwise(F.col("of_whole"))
    pairs = met.join(first, same).select("c1", "c2", "place", partner.alias("earlier"))
    pairs = pairs.filter(F.col("earlier.place") < F.col("place")).select("c1", "c2", "earlier.p1", "earlier.p2").distinct()
    partners = texts.select(F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("words").alias("others"))
    checked = pairs.join(texts.select("c1", "c2", "words"), ["c1", "c2"]).join(partners, ["p1", "p2"]).filter(within_one_word(F.col("words"), F.col("others")))
    dropped = checked.select("c1", "c2").distinct().withColumn("near", F.lit(True))
    return cut(contents.select("c1", "c2", "place", "times").join(dropped, ["c1", "c2"], "left").withColumn("near", F.coalesce("near", F.lit(False))))


def without_repeated_lines(documents: DataFrame, signs: int | None = None) -> DataFrame:
    """The documents with all their columns, ``text`` without repeated lines, and ``_lines_before``, ``_lines_after``.

    A line goes if an equal line comes before it, or if its content has an earlier first place than it among those within
    one word (both of ``MIN_WORDS`` words or more). With ``signs``, it also goes for an earlier one within one sign, a blank
    or any other, if both are of fewer words and have so many signs at least: short lines, and lines in scripts without
    blanks, which otherwise go for equal ones only. Lines are compared in lower case and without differences of blanks, and
    ordered by doc_id (null first), a hash of the text, and place in the text; each is judged on the input. Blank lines
    stay. Null texts stay null; rows that agree in doc_id and text are one document and keep the same lines.
    """
    return carrying(documents, lambda rows: _without_repeated_lines(rows, signs), "_lines_before", "_lines_after")


def _without_repeated_lines(documents: DataFrame, signs: int | None) -> DataFrame:
    saved = _saved_lines(documents, signs)
    contents = line_contents(documents, saved, signs)
    doubtful = contents.filter("near or times > 1").select("c1", "c2", "place", "near")
    places = saved.select("doc_id", "text_key", "line_no", "c1", "c2")
    here = F.struct(F.col("doc_id").alias("doc"), F.col("text_key"), F.col("line_no").alias("line"))
    gone = places.join(doubtful, ["c1", "c2"]).filter(F.col("near") | (here != F.col("place")))
    gone = cut(gone.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.collect_set("line_no").alias("_gone")))
    split = F.split("text", "\n", -1)
    named = documents.withColumn("_text_key", text_key(F.col("text")))
    joined = named.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    kept = F.filter(split, lambda line, i: ~F.array_contains(F.col("_gone"), i))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    before = F.when(F.col("text").isNull(), 0).otherwise(F.size(split))
    after = before - F.coalesce(F.size("_gone"), F.lit(0))
    joined = joined.withColumns({"_lines_before": before.cast("long"), "_lines_after": F.when(F.col("_gone").isNull(), before).otherwise(after).cast("long"), "_kept": text})
    return joined.select(*(F.col("_kept").alias("text") if c == "text" else joined[c] for c in documents.columns), "_lines_before", "_lines_after")
