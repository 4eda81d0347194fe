"""Line dedup against all pairs of lines."""

import random

import pytest

from tidemark.llm import line_dedup


def distance_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def brute(rows):
    places = sorted(((d is not None, d or 0, i), line) for d, t in {(d, t) for d, t in rows} if t is not None
                    for i, line in enumerate(t.split("\n")))
    norm = lambda x: x.strip(" ").lower()
    first = {}
    for at, line in places:
        if norm(line):
            first.setdefault(norm(line), at)
    drop = set()
    for at, line in places:
        x = norm(line)
        if not x:
            continue
        near = any(first[y] < first[x] and distance_at_most_one(x, y) for y in first if y != x)
        if near or first[x] != at:
            drop.add(at)
    return {(d, t): None if t is None else "\n".join(
        line for i, line in enumerate(t.split("\n")) if (d is not None, d or 0, i) not in drop) for d, t in rows}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = line_dedup.dedup(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((d or -1, want[(d, t)] or "") for d, t in rows)


def vary(rng, line):
    i = rng.randrange(len(line))
    return rng.choice([line[:i] + line[i + 1:], line[:i] + rng.choice("abcé漢 ") + line[i:], line[:i] + rng.choice("abcé漢") + line[i + 1:], line])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_edits(spark, seed):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("ab cdé") for _ in range(rng.choice([1, 2, 5, 9, 14, 15, 16, 17, 18, 40, 120]))) or "x" for _ in range(25)]
    rows = []
    for d in range(40):
        mine = [rng.choice(lines) for _ in range(rng.randint(1, 6))]
        for _ in range(rng.randint(0, 2)):
            mine = [vary(rng, x) if rng.random() < 0.5 and x else x for x in mine]
        rows.append((d, "\n".join(mine)))
    check(spark, rows)


def test_runs_of_one_letter_and_numbered_lines(spark):
    rows = [(d, "\n".join(["a" * (20 + d), "b" * 30 + "c" * d, f"page {d} of 20 of this long report"])) for d in range(25)]
    check(spark, rows)


def test_edges(spark):
    check(spark, [(1, None), (2, ""), (3, "\n\n"), (4, "  \nSame line here, long enough\n "), (5, "same LINE here, long enough  "),
                  (None, "no id here, but quite long"), (6, "no id here, but quite lung"), (7, "x\nx\ny"), (8, "short"), (9, "shore"),
                  (10, "z" * 5000), (11, "z" * 4999)])


def test_short_lines_and_the_edit_bound(spark):
    check(spark, [(d, "\n".join(x)) for d, x in enumerate([
        ["a", "b"], ["ab", "abc", "xyz"], ["abcdefghijklmno", "abcdefghijklmnop"], ["abcdefghijklmnox", "bcdefghijklmno"], ["zz", "ab c"], ["qrstuvwxyzabcd", "qrstuvwxyzabcde"]])])
    docs = spark.createDataFrame([(1, "alpha\nalphas"), (2, "alpha\nbeta")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup(docs, edits=0).collect()}
    assert got == {1: "alpha\nalphas", 2: "beta"}
    with pytest.raises(ValueError):
        line_dedup.dedup(docs, edits=2)


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a line\nother words", 7, 8)] * 2, "doc_id long, text string, _lines int, n_lines int")
    got = line_dedup.dedup(docs).collect()
    assert [(r.text, r._lines, r.n_lines, r.n_lines_, r.n_dropped) for r in got] == [("a line\nother words", 7, 8, 2, 0)] * 2
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def test_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", -1)
    rng = random.Random(9)
    base = "the quick brown fox jumps over the lazy dog"
    check(spark, [(d, "\n".join(vary(rng, base) for _ in range(3))) for d in range(12)])
