"""Sharding, quality rules, preferences and substrings on odd rows, and each against a plain count."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stopline.llm.preference import assembled, borrowed_answers, preference_segments
from stopline.llm.quality import rated, repeated_words, without_frequent_lines
from stopline.llm.sharding import sharded, shards
from stopline.llm.substrings import without_repeated_substrings


def test_shards_are_contiguous_balanced_and_gapless(documents, odd):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 60)) for i in range(3000)] + [(77, "hot copy")] * 1500
    got = [r.asDict() for r in shards(documents(rows)).collect()]
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows)
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in got] == sorted(i for i, _ in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 2 * 121
    assert all(s == list(range(len(s))) for s in slots.values())
    assert shards(odd).count() == odd.count() and shards(odd.filter("text is null")).select("size", "text_crc32").distinct().collect() == [(1, 0)]
    assert shards(documents([])).count() == 0


def test_sharded_documents_keep_their_columns(documents, odd):
    rows = [(i % 40, f"text {i % 7}") for i in range(300)] + [(77, "copy")] * 200
    for frame in (documents(rows), odd):
        got = sharded(frame)
        assert got.columns == [*frame.columns, "_size", "_text_crc32", "_shard", "_slot"]
        plain = lambda x: sorted(map(str, x.collect()))
        assert plain(got.select(*frame.columns)) == plain(frame)
        assert got.select("_shard", "_slot").distinct().count() == frame.count()
        assert plain(got.selectExpr("doc_id", "_size AS size", "_text_crc32 AS text_crc32", "_shard AS shard", "_slot AS slot")) == plain(shards(frame))


def test_quality_of_odd_rows_and_frequent_lines(documents, odd):
    assert rated(odd).count() == odd.count() and rated(documents([])).count() == 0
    own = lambda i, n: " ".join(f"own{i}x{k}" for k in range(n))
    shared = " ".join(f"shared{k}" for k in range(30))
    rows = [(3 * i, f"{shared}\n{own(i, 20 + i)}") for i in range(25)] + [(3 * i + 1, f"{shared}\n{own(i, 20 + i)}") for i in range(10)]
    got = {r["doc_id"]: r for r in rated(documents(rows)).collect()}
    assert all(got[3 * i]["kept"] == (i >= 10) and got[3 * i]["n_frequent_words"] == 30 for i in range(25))
    assert all(got[3 * i + 1]["kept"] and got[3 * i + 1]["n_frequent_words"] == 0 for i in range(10))  # ten of a host are no more than ten


def test_frequent_lines_go_from_the_texts(spark, documents, odd):
    rows = [(3 * i, f"Shared  line {i}\n\nown{chr(97 + i)} text\nshared line 007\n ") for i in range(11)] + [(3 * i + 1, "Shared line 1\nown") for i in range(10)]
    rows += [rows[0], (90, None), (93, "Shared line 5\nother")]
    made = without_frequent_lines(documents(rows))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_frequent_words"]
    assert made.columns == [*documents(rows).columns, *(f"_{c}" for c in counts)]
    got = made.collect()
    want = [(i, f"\nown{chr(97 + i // 3)} text\n " if i < 90 and i % 3 == 0 else "other" if i == 93 else t) for i, t in rows]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert all(len((r["text"] or "").split()) == r["_n_words"] - r["_n_frequent_words"] and r["lang"] == "en" for r in got)
    same = without_frequent_lines(odd).select("doc_id", "text").collect()
    assert sorted(map(tuple, same), key=str) == sorted((tuple(r) for r in odd.select("doc_id", "text").collect()), key=str)
    plan = rated(documents(rows))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan  # texts are made only if they are asked for


def test_the_limit_of_frequent_lines_grows_with_the_host(documents):
    for n in (100, 300, 900):  # one in 25 has the rare line, one in 15 the other; ten documents are always allowed
        rows = [(3 * i, "\n".join([f"own {i}", *["rare line"] * (i % 25 == 0), *["menu of the host"] * (i % 15 == 0)])) for i in range(n)]
        got = dict(without_frequent_lines(documents(rows)).select("doc_id", "text").collect())
        assert all(("rare line" in got[i]) == ("rare line" in t) for i, t in rows)
        assert any("menu of the host" in t for t in got.values()) == (n == 100)


def test_repeated_words_against_plain_windows():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice((b"a", b"b")) for _ in range(rng.randint(0, 60))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        assert repeated_words(words) == len({k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 8)})


def test_preference_pairs(spark):
    schema = "pair_id long, turn long, role string, text string, part string, start long"
    chosen = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "good"), (2, 0, "user", "x"), (3, 5, "user", "only chosen"), (4, 0, "user", "same"), (None, 0, "user", "none")]
    rejected = [(1, 0, "system", "s"), (1, 7, "user", "hi"), (1, 8, "assistant", "bad"), (1, 9, "user", "so?"), (2, 0, "assistant", "x"), (4, 0, "user", "same"), (5, 0, None, None)]
    frames = [spark.createDataFrame([(*r, "x", 0) for r in rows], schema) for rows in (chosen, rejected)]
    rows = preference_segments(*frames)
    whole = {r["pair_id"]: r for r in assembled(rows).collect()}
    say = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert whole[1][1:] == (say("system", "s") + say("user", "hi"), say("assistant", "good"), say("assistant", "bad") + say("user", "so?"))
    assert whole[2][1:] == ("", say("user", "x"), say("assistant", "x")) and whole[3][1:] == ("", say("user", "only chosen"), "")
    assert whole[4][1:] == (say("user", "same"), "", "") and whole[5][1:] == ("", "", say("", "")) and None not in whole
    for r in rows.collect():
        text = whole[r["pair_id"]][r["part"]]
        assert text[r["start"] :].startswith(r["rendered"])
        learned = text[r["learn_from"] : r["learn_to"]]
        assert learned == (r["rendered"].partition("\n")[2] if r["part"] != "prompt" and r["role"] == "assistant" else "")
    empty = frames[0].limit(0)
    assert preference_segments(empty, empty).count() == 0


def test_long_and_hot_conversations(spark):
    turns = [(1, t, ("user", "assistant")[t % 2], f"turn {t} é") for t in range(2000)] + [(c, 0, "user", "same opening") for c in range(2, 300)]
    frame = spark.createDataFrame(turns + turns[:1], "conv_id long, turn long, role string, text string")
    got = preference_segments(frame.withColumnRenamed("conv_id", "pair_id"), borrowed_answers(frame))
    long = sorted((r["part"], r["position"], r["start"], len(r["rendered"])) for r in got.filter("pair_id = 1").collect())
    assert len(long) == 2001 and [p for p, *_ in long].count("chosen") == 1
    for a, b in zip(long, long[1:], strict=False):
        assert b[0] != a[0] or (b[1] == a[1] + 1 and b[2] == a[2] + a[3])
    assert got.filter("pair_id > 1").count() == 298


@pytest.mark.parametrize("hot", [False, True])
def test_substrings_against_plain_windows(spark, documents, odd, hot, monkeypatch):
    if hot:  # so few bytes a bucket that every common minimiser is hot
        monkeypatch.setattr("stopline.llm.substrings.BUCKET_BYTES", 400)
    rng = random.Random(6)
    passage = [f"p{k}" for k in range(60)]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for i in range(100, 220):
        words = []
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(0, 50)
            words += rng.choice(([f"o{rng.randint(0, 9**6)}" for _ in range(9)], passage[a : a + rng.randint(1, 40)], ["la"] * rng.randint(1, 40)))
        rows.append((rng.choice((i, i - 1)), rng.choice((" ", "\n", " \t ")).join(words)))
    least = {}
    windows = lambda w: [tuple(w[k : k + 13]) for k in range(len(w) - 12)]
    split = lambda t: [w.decode() for w in (t or "").encode().split()]
    for i, text in rows:
        for w in windows(split(text)) if i is not None else ():
            least[w] = min(i, least.get(w, i))
    want = []
    for i, text in rows:
        words = split(text)
        gone = {k + j for k, w in enumerate(windows(words)) if i is not None and least[w] < i for j in range(13)}
        want.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    got = without_repeated_substrings(documents(rows)).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert without_repeated_substrings(documents([])).count() == 0


HELPERS = ("_id", "_key", "_gone", "_size_", "_text_key", "_found", "_row_host", "_row", "_part", "_order", "_tie", "_kept_id", "_doc_id", "_ID", "carried 0")


@pytest.mark.parametrize("name", ["toxicity", "lines", "simhash", "decontamination", "quality", "sharding"])
def test_columns_named_like_helpers_are_left_alone(spark, documents, name):
    from stopline.llm import decontamination, lines, quality, sharding, simhash, toxicity

    run = {
        "toxicity": lambda d: toxicity.without_toxic(d, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")),
        "lines": lines.without_repeated_lines,
        "simhash": simhash.without_near_copies,
        "decontamination": lambda d: decontamination.clean_documents(d, spark.createDataFrame([(1, "a b c")], "item_id long, text string")),
        "quality": quality.without_frequent_lines,
        "sharding": sharding.sharded,
    }[name]
    names = [n for n in HELPERS if n != "_ID"] if spark.conf.get("spark.sql.caseSensitive") == "false" else list(HELPERS)
    plain = documents([(i, f"own{i} text number {i * 7919} with words {i ** 3} of its own\nline {i}") for i in range(6)])
    docs = plain.select("*", *(F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names))
    got = run(docs).collect()
    assert len(got) == 6 and run(docs).columns[: len(docs.columns)] == docs.columns
    assert all(r[n] == f"{n} of {r['doc_id']}" for r in got for n in names)


def test_documents_that_have_an_added_column_are_refused(documents):
    for run, column in ((sharded, "_size"), (without_frequent_lines, "_Kept")):
        with pytest.raises(ValueError, match="already have"):
            run(documents([(1, "x")]).withColumnRenamed("host", column))
