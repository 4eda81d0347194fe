"""Alignment against whole texts encoded by the libraries, the fragment monoid, and edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from tidemark.llm import alignment
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    return alignment.Vocabularies(A, B)


def spread(v, text):
    """(start, end, id) of the tokens of the whole text by each, or None."""
    if not text:
        return None
    whole = (" " + text).encode()
    out = []
    for ids, byte in ((v.a.encode(" " + text, add_special_tokens=False).ids, v.bytes_a), (v.b.encode(text), v.bytes_b)):
        if b"".join(byte[i] for i in ids) != whole:
            return None
        at, mine = 0, []
        for i in ids:
            mine.append((at, at + len(byte[i]), i))
            at += len(byte[i])
        out.append(mine)
    return out


def plain(v, rows):
    """Every row's outcome by overlaps of byte ranges; links are looked for among all near tokens."""
    found, counts = [], Counter()
    for _, text in rows:
        both = spread(v, text)
        links, groups = Counter(), []
        if both:
            first, second = both
            cuts = sorted({e for _, e, _ in first} & {e for _, e, _ in second})
            begin = 0
            by_end = [defaultdict(list), defaultdict(list)]
            for side, tokens in enumerate(both):
                k = 0
                for t in tokens:
                    while cuts[k] < t[1]:
                        k += 1
                    by_end[side][cuts[k]].append(t)
            for c in cuts:
                x, y = by_end[0][c], by_end[1][c]
                groups.append(",".join(str(t[2]) for t in x) + "|" + ",".join(str(t[2]) for t in y))
                for s, e, i in x:
                    for s2, e2, j in y:
                        if max(s, s2) < min(e, e2):
                            links[i, j] += 1
                assert begin <= c
        found.append((both, links, groups))
        counts.update(set(links))
    high = defaultdict(int)
    for (i, _), n in counts.items():
        high[i] = max(high[i], n)
    out = []
    for (key, _), (both, links, groups) in zip(rows, found):
        out.append((key, len(both[0]) if both else 0, len(both[1]) if both else 0, len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if counts[p] == high[p[0]]), sum(n * counts[p] for p, n in links.items()),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if both else ""))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=str)


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "\n", "\n\n a", "tab\there", "a▁b", "▁", "x\0y", "<s>", "</s> <unk> <0x41>", "<|endoftext|> b",
       "naïve café — “quoted” …", "日本語のテキスト", "👩‍👩‍👧 emoji", "don't we'll I'M", "a b 　c", "1234567890 12,345.67", "end.  ", "\r\n x \x1c y", "ﬁne ½ Å",
       "é ", "   three", "AAAA" * 20, "a" * 300, "  z", "= = ==  =="]


def test_odd_texts(spark, libraries):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "twice the row"), (3, "twice the row")]
    df = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B)
    assert got(df) == plain(libraries, rows)
    for r in df.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_groups else "")


def made_text(seed, size):
    rng = random.Random(seed)
    words = ["the", "alignment", "naïve", "don't", "日本語", "x=1;", "3.14159", "--", "\n", "\t", "internationalisation", "ÅÄÖ", "0x41", "👍"]
    return "".join(rng.choice(words) + rng.choice(["", " ", " ", " ", "  "]) for _ in range(size))


def test_tree_of_fragments(spark, libraries, monkeypatch):
    """Long texts over many tasks: pieces, byte ranges that cut tokens, and several levels of the tree."""
    monkeypatch.setattr(alignment, "LONG", 300)
    monkeypatch.setattr(alignment, "RANGE", 37)
    monkeypatch.setattr(alignment, "FAN", 3)
    rows = [(i, made_text(i, n)) for i, n in enumerate([5, 80, 400, 900])]
    rows += [(10, "ab" * 2000), (11, made_text(2, 400)), (11, made_text(2, 400)), (None, "x" * 400 + "▁" + made_text(3, 300)), (13, " " * 700)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expect = plain(libraries, rows)
    assert got(alignment.align(df, A, B)) == expect
    assert got(alignment.align(df, A, B, keep_groups=False, broadcast_bytes=0)) == expect  # counts joined, not broadcast


def test_monoid(libraries):
    """Composition is associative, and any cutting of the tokens composes to the same document."""
    import numpy as np

    v = libraries
    text = made_text(7, 60)
    both = spread(v, text)
    ids = [[t[2] for t in x] for x in both]
    ends = [np.array([t[1] for t in x]) for x in both]
    whole = v.finish(v.fragment(*ids, *ends))
    rng = random.Random(1)
    for _ in range(20):
        edges = np.array(sorted({0, int(ends[0][-1]), *rng.sample(range(1, int(ends[0][-1])), 6)}))
        at = [np.searchsorted(e, edges, side="right") for e in ends]
        parts = [v.fragment(ids[0][i:j], ids[1][m:n], ends[0][i:j], ends[1][m:n]) for i, j, m, n in zip(at[0], at[0][1:], at[1], at[1][1:])]
        k = rng.randint(1, len(parts) - 1)
        left = v.compose([v.compose(parts[:k]), v.compose(parts[k:])])
        right = v.compose([parts[0], v.compose(parts[1:])])
        for f in (left, right):
            f = v.finish(f)
            assert (";".join(f.groups), f.pairs, f.n_groups, f.n_b) == (";".join(whole.groups), whole.pairs, whole.n_groups, whole.n_b)


def test_query(spark, libraries):
    found = got(QUERIES["op13_token_alignment"](spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert found == plain(libraries, [(r.doc_id, r.text) for r in docs])


def test_edges(spark, libraries):
    """Clashing column names, an empty table, a very long text, and settings that come back."""
    rows = [(1, made_text(1, 60_000), "r"), (2, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    assert got(alignment.align(docs, A, B, keep_groups=False)) == plain(libraries, [r[:2] for r in rows])
    assert spark.conf.get(name) == before
    empty = alignment.align(docs.limit(0), A, B)
    assert empty.columns == ["doc_id", *COLUMNS, "groups"] and empty.count() == 0
