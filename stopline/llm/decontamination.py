"""Benchmark decontamination: winnowed fingerprints find the passages, comparison of whole windows settles them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import ascii_lower, carrying, cut, let, small, text_key, words_of

#: Words of a window, and of the k-grams that are hashed in it.
WINDOW, GRAM = 13, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A document is contaminated if one word in so many is hit.
SHARE = 20


def _words(text: Column) -> Column:
    return words_of(ascii_lower(text), WORD)


def _winnowed(words: Column, window: int) -> Column:
    """The least k-gram hash of each window of so many words: an array with a hash for each place a window starts."""
    gram = min(GRAM, window)
    n = F.size(words)

    def slide(count: Column, make) -> Column:
        return F.when(count >= 1, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), make)).otherwise(F.array().cast("array<long>"))

    def least(hashes: Column) -> Column:
        return slide(n - (window - 1), lambda i: F.array_min(F.slice(hashes, i, window - gram + 1)))

    return let(slide(n - (gram - 1), lambda i: F.xxhash64(F.slice(words, i, gram))), least)


def _runs(least: Column) -> Column:
    """``(first, hash)`` of each run of windows that share their least hash."""
    places = F.sequence(F.lit(1), F.greatest(F.size(least), F.lit(1)))
    starts = F.filter(places, lambda i: (F.size(least) > 0) & ((i == 1) | (F.get(least, i - 1) != F.get(least, i - 2))))
    return F.transform(starts, lambda i: F.struct(i.alias("first"), F.get(least, i - 1).alias("hash")))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``(item_id, length, window, hash)``: the items' windows as words joined by one blank; a short item is one window."""
    items = benchmark.select("item_id", let(ascii_lower(F.coalesce("text", F.lit(""))), lambda t: words_of(t, WORD)).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    each = items.select("item_id", "length", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at"))
    each = each.select("item_id", "length", F.slice("words", F.col("at"), F.col("length")).alias("part"))
    gram = F.least(F.lit(GRAM), F.col("length"))
    grams = F.transform(F.sequence(F.lit(1), F.col("length") - gram + 1), lambda i: F.xxhash64(F.slice("part", i, gram)))
    return each.select("item_id", "length", F.array_join("part", " ").alias("window"), F.array_min(grams).alias("hash")).distinct()


def hits(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n_words, spans, items)`` of each distinct document: windows found as ``(at, length)``, item ids.

    A window of 13 words holds 9 hashes of 5 words. A document keeps the least of each of its windows, and an item does; a
    common window has the same least hash in both, so no shared span of 13 words or more is missed. Runs of windows that
    share their least hash are looked up once; the documents in which some are found are read again, and there each window
    of those runs is compared word by word. Items shorter than 13 words are one window, and documents are also winnowed at
    those lengths. Hashes are broadcast if they have been counted to be few, else shuffled.
    """
    wanted = cut(item_windows(benchmark))
    lengths = [r["length"] for r in wanted.select("length").distinct().orderBy("length").collect()]  # 13 at most
    prints = cut(wanted.select("length", "hash").distinct())
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")

    def least(words: Column) -> Column:
        made = [F.struct(F.lit(n).alias("length"), _winnowed(words, n).alias("least")) for n in lengths]
        return F.array(*made) if made else F.array().cast("array<struct<length: int, least: array<long>>>")

    sought = rows.select("doc_id", "text_key", F.inline(let(_words(F.col("text")), least)))
    sought = sought.select("doc_id", "text_key", "length", F.inline(let(F.col("least"), _runs)))
    found = sought.join(small(prints), ["length", "hash"])
    # What is found in a document is a set of hashes, no more than its own words.
    found = cut(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.collect_set(F.struct("length", "hash")).alias("_found"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    marked = rows.join(small(found, "_found"), same, "left").select("doc_id", "text_key", "_found", _words(F.col("text")).alias("words"))

    def candidates(words: Column) -> Column:
        def of(length: int) -> Column:
            hashes = F.transform(F.filter("_found", lambda f: f["length"] == length), lambda f: f["hash"])

            def places(pair: Column) -> Column:
                starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(pair["least"]), F.lit(1))), lambda i: F.array_contains(pair["hashes"], F.get(pair["least"], i - 1)))
                return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice(words, i, length), " ").alias("window")))

            none = F.array().cast("array<struct<at: int, length: int, window: string>>")
            return F.when(F.size(hashes) > 0, let(F.struct(_winnowed(words, length).alias("least"), hashes.alias("hashes")), places)).otherwise(none)

        return F.concat(*(of(n) for n in lengths)) if lengths else F.array().cast("array<struct<at: int, length: int, window: string>>")

    none = F.array().cast("array<struct<at: int, length: int, window: string>>")
    marked = marked.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), F.when(F.col("_found").isNotNull(), candidates(F.col("words"))).otherwise(none).alias("at"))
    return _settled(marked, wanted)


def _settled(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    each = marked.select("doc_id", "text_key", "n_words", F.inline_outer("at"))
    owners = cut(wanted.groupBy("length", "window").agg(F.collect_set("item_id").alias("items")))
    true = each.join(small(owners, "items"), ["length", "window"], "left").withColumn("hit", F.col("items").isNotNull())
    return true.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.struct("at", "length")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def covered(spans: Column) -> Column:
    """How many places the spans ``(at, length)``, sorted by ``at``, cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(sum_: Column, span: Column) -> Column:
        end = span["at"] + span["length"]
        return F.struct(
            (sum_["n"] + F.greatest(end - F.greatest(span["at"], sum_["end"]), F.lit(0))).alias("n"), F.greatest(end, sum_["end"]).alias("end")
        )

    return F.aggregate(spans, start, add)["n"].cast("long")


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, n_items, items, contaminated)`` for every row of the documents.

    Words are runs of a-z, 0-9 and anything beyond ASCII, after lower-casing A-Z. Null and empty texts have no words and are
    clean; null items are passed over as items without words. Rows that repeat doc_id and text are returned as often.
    """
    bad = (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    answers = hits(documents, benchmark).withColumn("n_hit", covered(F.col("spans")))
    answers = answers.withColumns({"n_items": F.size("items").cast("long"), "contaminated": bad})
    answers = answers.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return rows.join(answers, same).select("doc_id", "text_key", "n_words", "n_hit", "n_items", "items", "contaminated")


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return carrying(documents, lambda rows: _clean_documents(rows, benchmark))


def _clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    bad = cut(contamination(documents, benchmark).filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    named = documents.withColumn("_text_key", text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    return named.join(small(bad), same, "left_anti").select(*(named[c] for c in documents.columns))
