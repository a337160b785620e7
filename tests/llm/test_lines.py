from __future__ import annotations

import random
import re

from stopline.llm.lines import MIN_WORDS, within_one_word, without_repeated_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def norm(line):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    return tuple(w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w)


def brute(rows):
    """By comparing each distinct line with each earlier one; no two texts of one id here."""
    first = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if norm(line):
                first.setdefault(norm(line), ((i is not None, i or 0), k))
    order = sorted(first, key=first.get)
    gone = {b for n, b in enumerate(order) if len(b) >= MIN_WORDS and any(len(a) >= MIN_WORDS and abs(len(a) - len(b)) < 2 and distance(a, b) <= 1 for a in order[:n])}
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None))
            continue
        lines = text.split("\n")
        out.append((i, "\n".join(x for k, x in enumerate(lines) if not norm(x) or (norm(x) not in gone and first[norm(x)] == ((i is not None, i or 0), k)))))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")


def test_random_lines_against_brute_force(documents):
    rng = random.Random(3)
    words = "alpha Beta gamma delta".split()
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))) for _ in range(rng.randint(1, 8))]
        rows.append((i, rng.choice(("\n", " \n", "\n\n")).join(lines)))
    got = without_repeated_lines(documents(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_each_kind_of_edit(documents):
    base = "one two three four five six seven"
    kinds = [base.replace("four", "4"), "zero " + base, base + " eight", base.replace("one ", ""), base.replace(" seven", ""), base.replace("four", "four and"), base.upper()]
    far = ["one two three four five seven six", "two one three four five six seven", base + " eight nine", "short line", "short lines"]
    rows = [(1, base), (2, "\n".join(kinds)), (3, "\n".join(far)), (4, "other\n\n" + base)]
    got = dict(without_repeated_lines(documents(rows)).select("doc_id", "text").collect())
    assert got == dict(brute(rows)) and got[2] == "" and got[3] == "short line\nshort lines" and got[4] == "other\n"


def test_odd_rows(odd, documents):
    kept = without_repeated_lines(odd)
    assert kept.columns == [*odd.columns, "_lines_before", "_lines_after"] and kept.count() == odd.count()
    got = {(r["doc_id"], r["_lines_before"]): r["text"] for r in kept.collect()}
    assert got[1, 0] is None and got[2, 1] == "" and got[4, 1] == "word" and got[7, 1] == "Equal text, twice." and got[6, 1] == ""
    assert without_repeated_lines(documents([])).count() == 0
    assert without_repeated_lines(documents([(1, None), (2, "")])).count() == 2


def test_a_hot_line_and_hot_near_lines(documents):
    common = "this very common line is in every single document of the table"
    rows = [(i, f"{common}\npage number {i} of the very same printed report here\nown{i}") for i in range(400)]
    got = dict(without_repeated_lines(documents(rows)).select("doc_id", "text").collect())
    assert got[0] == rows[0][1] and all(got[i] == f"own{i}" for i in range(1, 400))


def test_within_one_word(spark):
    rng = random.Random(5)
    pairs = [([rng.choice("ab") for _ in range(rng.randint(0, 5))], [rng.choice("ab") for _ in range(rng.randint(0, 5))]) for _ in range(400)]
    frame = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    for a, b, near in frame.select("a", "b", within_one_word(frame.a, frame.b)).collect():
        assert near == (distance(a, b) <= 1), (a, b)


def test_signs_of_short_lines_and_of_lines_without_blanks(documents):
    rng = random.Random(9)
    chinese = "本网站使用缓存技术以改善您的浏览体验请点击同意后继续访问"
    kept = ["a b c d e", "abcde", "one two three four five", "one two three four", "row", "rob"]
    rows = [(1, "\n".join([chinese, "Read more here", "🙂 smile", *kept])), (2, "\n".join([chinese[:9] + "与" + chinese[10:], chinese + "！", chinese[1:], "Read more there", "read morehere", "🙃 smile"]))]
    got = dict(without_repeated_lines(documents(rows), signs=5).select("doc_id", "text").collect())
    assert got == {1: rows[0][1], 2: ""}
    assert dict(without_repeated_lines(documents(rows)).select("doc_id", "text").collect()) == dict(rows)
    lines = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    split = {k: x if len(x) >= MIN_WORDS else tuple(f"{s} " for s in " ".join(x)) for k, x in ((k, norm(x)) for k, x in enumerate(lines))}
    near = lambda a, b: len(a) >= 5 and len(b) >= 5 and abs(len(a) - len(b)) < 2 and distance(a, b) <= 1
    want = [(k, not x and lines[k] or (lines[k] if not any(split[j] == x or near(split[j], x) for j in range(k)) else "")) for k, x in split.items()]
    got = without_repeated_lines(documents(list(enumerate(lines))), signs=5).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == want
