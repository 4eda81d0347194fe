"""N-gram Jaccard join against all pairs of sets."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import signature_tree
from tidemark.llm.components import components

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text, width=5):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    roots = [find(i) for i in range(len(rows))]
    least = {r: min((d for (d, _), q in zip(rows, roots) if q == r and d is not None), default=None) for r in set(roots)}
    return sorted((d or -1, len(s), least[r] if least[r] is not None else -1) for (d, _), s, r in zip(rows, sets, roots))


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = signature_tree.join(docs).collect()
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got)
    assert got == brute(rows)


def family(rng, n, length, edits):
    """Copies of one text that differ in some words."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_copies(spark, seed):
    rng = random.Random(seed)
    texts = [t for n, length, edits in [(30, 120, 4), (12, 60, 3), (25, 200, 9), (8, 30, 1), (40, 80, 5)] for t in family(rng, n, length, edits)]
    passage = " ".join(f"p{i}" for i in range(60))  # shared by many that are no copies
    texts += [f"{' '.join(f'u{rng.randrange(10**6)}' for _ in range(rng.randint(5, 80)))} {passage}" for _ in range(30)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_near_the_threshold(spark):
    words = [f"w{i}" for i in range(400)]
    # a and its first part: sizes n and m, so that m / n is just at, above and below 0.75
    rows = [(1, " ".join(words[:104])), (2, " ".join(words[:79])), (3, " ".join(words[:78])), (4, " ".join(words[1:104])), (5, " ".join(words[200:260]))]
    check(spark, rows)
    assert signature_tree.linked(np.arange(75, dtype=np.uint64), np.arange(75, dtype=np.uint64), 100, 75)
    assert not signature_tree.linked(np.arange(74, dtype=np.uint64), np.arange(74, dtype=np.uint64), 100, 74)


def test_small_groups_and_shuffles(spark, monkeypatch):
    """The cuts and joins for large groups, at a size that a test can have."""
    monkeypatch.setattr(signature_tree, "GROUP", 4)
    monkeypatch.setattr(signature_tree, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(signature_tree, "BLOCK_TEXTS", 7)
    rng = random.Random(4)
    texts = family(rng, 40, 60, 6) + family(rng, 20, 40, 4)
    check(spark, list(enumerate(texts)))


def test_the_exact_step_alone_finds_every_link(spark, monkeypatch):
    """With the meetings by least hashes switched off, candidates by prefix tokens must do."""
    monkeypatch.setattr(signature_tree, "_meet", lambda rows, group: rows.sparkSession.createDataFrame([], "a long, b long"))
    rng = random.Random(7)
    check(spark, list(enumerate(family(rng, 15, 70, 5) + family(rng, 15, 50, 4))))


def test_edges(spark):
    long = " ".join(f"w{i % 701}" for i in range(30_000))
    check(spark, [(3, None), (4, ""), (5, " \t\n"), (6, "one two"), (7, "One  TWO"), (8, "one two three"), (9, "a a a a a a a a"), (10, "a a a a a"),
                  (11, long), (12, long + " end"), (None, "no id at all here we are"), (2, "no id at all here we are"), (None, "alone without any id here"),
                  (13, "x y z"), (13, "x y z"), (1, "é É é É é É"), (14, "É é É é É é")])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert signature_tree.join(empty).count() == 0


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(4, text, 0), (2, text + " more", 1), (9, "another text of its own entirely", 2), (9, "another text of its own entirely", 3), (None, text, 4), (7, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int")
    got = signature_tree.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text[:3]) for r in got.collect()) == [(0, "w0 "), (2, "w0 "), (7, ""), (9, "ano")]


def test_a_bound_never_cuts_a_linked_pair():
    """Dual traversal gives the same pairs as all pairs of the sets, at any bitmap width."""
    rng = np.random.RandomState(3)
    for _ in range(30):
        sets = []
        for _ in range(6):
            base = rng.choice(5000, rng.randint(5, 400), replace=False)
            sets += [np.sort(rng.choice(base, max(1, int(len(base) * rng.uniform(0.7, 1))), replace=False)).astype(np.uint64) for _ in range(5)]
        rows = []
        for s in sets:
            rows.append({"n": len(s), "held": len(s), "component": len(rows)})
        short = [signature_tree.codes(s, len(s)) for s in sets]
        assert all(np.array_equal(signature_tree.unpacked(signature_tree.packed(c), len(s)), c) for c, s in zip(short, sets))
        found = set()

        def test(i, j):
            if signature_tree.linked(sets[i], sets[j], len(sets[i]), len(sets[j])):
                found.add((min(i, j), max(i, j)))
            return False

        signature_tree._tree(rows, [np.arange(len(rows))], short).walk(test)
        want = {(i, j) for j in range(len(sets)) for i in range(j) if signature_tree.linked(sets[i], sets[j], len(sets[i]), len(sets[j]))}
        assert found == want


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_exact_step_at_all_ratios_of_sizes(spark, monkeypatch):
    """Parts of one text, of sizes around the threshold's ratio, in pieces of four and without meetings."""
    monkeypatch.setattr(signature_tree, "_meet", lambda rows, group: rows.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(signature_tree, "GROUP", 4)
    monkeypatch.setattr(signature_tree, "BLOCK_TEXTS", 5)
    rng = random.Random(11)
    texts = []
    for _ in range(6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(20, 90))]
        passage = [f"p{i}" for i in range(30)]
        for _ in range(8):
            a, b = rng.randint(0, len(words) // 6), len(words) - rng.randint(0, len(words) // 6)
            texts.append(" ".join(words[a:b] + (passage if rng.random() < 0.3 else [])))
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_a_passage_of_many_texts_makes_no_group(spark, monkeypatch):
    """Texts of one passage and a tail that one other text holds: the tail's tokens are rarer and come
    first, and no smaller set of a pair needs the passage's."""
    monkeypatch.setattr(signature_tree, "_meet", lambda rows, group: rows.sparkSession.createDataFrame([], "a long, b long"))
    passage = [f"p{i}" for i in range(44)]
    texts = []
    for i in range(60):
        tail = [f"t{i}_{k}" for k in range(10)]
        texts += [" ".join(passage + tail), " ".join([f"o{i}_{k}" for k in range(30)] + tail)]
    seen = []
    tree = signature_tree.saved

    def noted(df, name):
        out = tree(df, name)
        if name == "groups":
            seen.append(out.agg({"size": "max"}).first()[0] if "size" in out.columns else None)
        return out

    monkeypatch.setattr(signature_tree, "saved", noted)
    check(spark, list(enumerate(texts)))
    assert seen and all(size is None or size <= 2 for size in seen)


def test_grades_are_of_all_blocks(spark):
    """A token's grade counts its texts in every block, also where a block knew it as shared itself."""
    seen = {}
    h = np.array([1, 2, 3], np.uint64) << np.uint64(20)
    blocks = [signature_tree._block(b, [0, 1], [np.array([2, 1])], [np.array([h[0], h[1], h[0]])], 1) for b in range(3)]
    blocks.append(signature_tree._block(3, [0], [np.array([2])], [np.array([h[0], h[2]])], 1))
    df = spark.createDataFrame([r for b in blocks for r in map(tuple, (d.values() for d in b.to_pylist()))], signature_tree._ROW_SQL)
    rows = [r.asDict() for r in signature_tree._shared(df).collect()]
    for b in range(4):
        head = next(r for r in rows if r["head"] and r["block"] == b)
        at, tokens, grades = signature_tree._answered(head, [r for r in rows if not r["head"] and r["block"] == b])
        seen[b] = sorted(zip(at.tolist(), tokens.tolist(), grades.tolist()))
    a, b, _ = (int(x) for x in signature_tree.token_ids(h, 1))
    assert all(seen[i] == [(0, a, 3), (0, b, 2), (1, a, 3)] for i in range(3))
    assert seen[3] == [(0, a, 3)]
