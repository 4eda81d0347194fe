"""Alignment of two tokenizers' tokens over the bytes of texts, by an associative fragment monoid.

Tokenizer A (byte-level BPE of the tokenizers library) encodes space + text, tokenizer B
(sentencepiece) the text, to which it adds a space itself.  Where tokens of both end at one byte,
the text is cut; between two cuts lies a group.  Within a group every byte belongs to one token of
each, so its linked pairs are found by walking both sequences.

A fragment is what a byte range knows by itself, of the tokens that end in it: those up to its first
cut (open prefix), the groups between its first and its last cut (closed) and those after that (open
suffix).  Composition joins the left suffix with the right prefix: associative, so the fragments of
a very long document are made in several tasks and composed in a tree.  Short texts are cut before
each space that follows another character; both encode such a chunk on its own, so it is closed, and
a worker remembers it.

Texts of more than ``LONG`` characters are cut into pieces before such a space too, which spread over
the tasks; their fragments end at every ``RANGE`` bytes of the document, wherever that is.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import chunks, gather, grouped, spans
from tidemark.llm.common import batch_limits, partitions, saved

#: Characters of a piece; a text of more is cut.
LONG = 1 << 16
#: Bytes of a fragment's range.
RANGE = 1 << 14
#: Fragments composed in one task at a time.
FAN = 16
#: Chunks that a worker remembers; beyond that it starts anew (speed only, never the result).
REMEMBERED = 500_000
#: Bytes of chunks that are encoded as one text.
TOGETHER = 1 << 14
#: Linked pairs counted at a time.
LINKS = 1 << 20
#: Counts of pairs are broadcast up to that many bytes, and joined beyond.
BROADCAST_BYTES = 64 << 20

Tokens = list[int]


def byte_alphabet() -> dict[str, int]:
    """Character of each byte in entries of a byte-level vocabulary: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


@dataclass
class Fragment:
    """Tokens that end in a byte range, as (A ids, B ids); without a cut all are in ``prefix``."""

    cut: bool = False
    prefix: tuple[Tokens, Tokens] = ((), ())
    groups: list[str] = field(default_factory=list)
    n_groups: int = 0
    n_b: int = 0
    pairs: dict[int, int] = field(default_factory=dict)
    suffix: tuple[Tokens, Tokens] = ((), ())


class Vocabularies:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte.get(c, 63) for c in entry)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.width = len(self.bytes_b)
        self.space = [self.b.piece_to_id("▁")]
        # an id as text with what follows it: another of its group, or the end of the A or B ids
        self.text_a = [np.array([f"{i}{c}" for i in range(len(self.bytes_a))], object) for c in ",|"]
        self.text_b = [np.array([f"{i}{c}" for i in range(self.width)], object) for c in ",;"]
        self.chars = np.array([len(str(i)) + 1 for i in range(max(len(self.bytes_a), self.width))], np.int64)

    def _together(self, parts: list[str], sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(ids, how many of each chunk) by A and by B of chunks encoded as one text, or None if that
        isn't the text again or a token lies in two chunks."""
        joined = "".join(parts)
        whole, edges, out = joined.encode(), np.cumsum(sizes), []
        # B puts a space before what it gets
        for ids, byte, length in ((self.a.encode(joined, add_special_tokens=False).ids, self.bytes_a, self.len_a),
                                  (self.b.encode(joined[1:]), self.bytes_b, self.len_b)):
            if b"".join([byte[i] for i in ids]) != whole:
                return None
            ids = np.array(ids, np.int64)
            ends = np.cumsum(length[ids])
            at = np.searchsorted(ends, edges)
            if not (ends[at] == edges).all():
                return None
            out.append((ids, np.diff(at + 1, prepend=0)))
        return out

    def _alone(self, part: str) -> list[tuple[np.ndarray, np.ndarray]] | None:
        found = self._together([part], np.array([len(part.encode())])) if part != " " else None
        if part == " ":  # of nothing B makes nothing
            a = np.array(self.a.encode(part, add_special_tokens=False).ids, np.int64)
            found = [(a, np.array([len(a)])), (np.array(self.space, np.int64), np.array([1]))]
        return found

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, how many of each chunk, B ids, how many) of chunks that begin with a space; none for
        a chunk that isn't the bytes of its tokens.

        Where a chunk ends in another character than white space, neither library joins it with the
        next, so many of them make one text."""
        sizes = np.array([len(p.encode()) for p in parts], np.int64)
        found: list = [None] * len(parts)
        plain = [i for i, p in enumerate(parts) if not p[-1].isspace()]
        for a, b in spans(sizes[plain].tolist(), TOGETHER):
            mine = plain[a:b]
            both = self._together([parts[i] for i in mine], sizes[mine])
            if both is not None:
                for k, i in enumerate(mine):
                    found[i] = (both, k)
        # each chunk's ids as (start, size) in the made arrays
        pools: list[list] = [[], []]
        starts, counts = np.zeros((2, len(parts)), np.int64), np.zeros((2, len(parts)), np.int64)
        held, seen = [0, 0], {}
        for i, p in enumerate(parts):
            if found[i] is None:
                alone = self._alone(p)
                if alone is None:
                    continue
                found[i] = (alone, 0)
            both, k = found[i]
            if id(both) not in seen:
                seen[id(both)] = [(held[s], np.cumsum(both[s][1]) - both[s][1]) for s in (0, 1)]
                for s in (0, 1):
                    pools[s].append(both[s][0])
                    held[s] += len(both[s][0])
            for s in (0, 1):
                base, at = seen[id(both)][s]
                starts[s, i], counts[s, i] = base + at[k], both[s][1][k]
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in pools]
        every = np.arange(len(parts))
        return (gather(flat[0], starts[0], counts[0], every), counts[0], gather(flat[1], starts[1], counts[1], every), counts[1])

    def walk(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(groups as text, how many groups, how many links, linked pairs) of stretches that begin and
        end together, given as the tokens of all and how many each has."""
        a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # every byte where a token ends is the end of a link, the overlap of the tokens that hold it
        ends = np.union1d(end_a, end_b)
        pairs = a[np.searchsorted(end_a, ends)] * self.width + b[np.searchsorted(end_b, ends)]
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = [np.where(cuts[g] == e, text[1][t], text[0][t]) for g, e, t, text in (
            (group_a, end_a, a, self.text_a), (group_b, end_b, b, self.text_b))]
        whole = "".join(np.concatenate(texts)[order].tolist())
        chars = np.concatenate([[0], np.cumsum(self.chars[np.concatenate([a, b])[order]])])
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        at = chars[to_a + to_b]
        last = np.concatenate([[0], end_a])[to_a]
        out = [whole[x:y - 1] if y > x else "" for x, y in zip([0, *at[:-1].tolist()], at.tolist())]
        return out, *(np.diff(np.searchsorted(x, last, side="right"), prepend=0) for x in (cuts, ends)), pairs

    def _close(self, into: Fragment, a: Tokens, b: Tokens) -> None:
        if not len(a):
            return
        text, groups, _, pairs = self.walk(a, b, [len(a)], [len(b)])
        into.groups += text
        into.n_groups += int(groups[0])
        into.n_b += len(b)
        for p, n in zip(*(x.tolist() for x in np.unique(pairs, return_counts=True))):
            into.pairs[p] = into.pairs.get(p, 0) + n

    def fragment(self, a: Tokens, b: Tokens, ends_a: np.ndarray, ends_b: np.ndarray) -> Fragment:
        """Of the tokens that end in a byte range, with the bytes where they end."""
        cuts = np.intersect1d(ends_a, ends_b)
        if not len(cuts):
            return Fragment(prefix=(a, b))
        i, k = np.searchsorted(ends_a, cuts[[0, -1]], side="right").tolist()
        j, m = np.searchsorted(ends_b, cuts[[0, -1]], side="right").tolist()
        out = Fragment(True, (a[:i], b[:j]), suffix=(a[k:], b[m:]))
        self._close(out, a[i:k], b[j:m])
        return out

    def compose(self, parts: list[Fragment]) -> Fragment:
        """The fragment of adjoining ranges, left to right."""
        out = Fragment(prefix=([], []))
        for f in parts:
            if not out.cut:
                out.prefix = ([*out.prefix[0], *f.prefix[0]], [*out.prefix[1], *f.prefix[1]])
                out.cut, out.suffix = f.cut, f.suffix
            else:
                a, b = [*out.suffix[0], *f.prefix[0]], [*out.suffix[1], *f.prefix[1]]
                if not f.cut:
                    out.suffix = a, b
                    continue
                self._close(out, a, b)
                out.suffix = f.suffix
            out.groups += f.groups
            out.n_groups += f.n_groups
            out.n_b += f.n_b
            for p, n in f.pairs.items():
                out.pairs[p] = out.pairs.get(p, 0) + n
        return out

    def finish(self, f: Fragment) -> Fragment:
        """Of a whole document, whose begin and end are cuts: the open ends are groups."""
        begin, end = Fragment(True), Fragment(True)
        return self.compose([begin, f, end])


_loaded: dict[tuple[str, str], Vocabularies] = {}


def load(path_a: str, path_b: str) -> Vocabularies:
    """The vocabularies, read once in each worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Vocabularies(path_a, path_b)
    return _loaded[path_a, path_b]


class Remembered:
    """Chunks with their groups and numbered pairs."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.number: dict[int, int] = {}
        self.pairs = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int64)
        # tokens of A and of B, groups and links of each; links are -1 where the bytes differ
        self.sizes = np.zeros((0, 4), np.int64)

    def learn(self, parts: list[list[str]]) -> None:
        if len(self.place) > REMEMBERED:
            self.forget()
        new = list(dict.fromkeys(c for p in parts for c in p if c not in self.place))
        if not new:
            return
        a, n_a, b, n_b = self.v.encode(new)
        groups, n_groups, n_links, pairs = self.v.walk(a, b, n_a, n_b)
        self.place.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.groups += groups
        distinct, which = np.unique(pairs, return_inverse=True)
        numbers = np.array([self.number.setdefault(p, len(self.number)) for p in distinct.tolist()], np.int64)
        self.pairs = np.fromiter(self.number, np.int64, len(self.number))
        self.pool = np.concatenate([self.pool, numbers[which]])
        sizes = np.stack([n_a, n_b, n_groups, np.where(n_a > 0, n_links, -1)], axis=1)
        self.sizes = np.concatenate([self.sizes, sizes])


def _row(key, groups: str | None, n, pairs: list, times: list, keep: bool) -> tuple:
    """One document's outcome; no ``groups`` where it has no tokens."""
    digest = "" if groups is None else hashlib.sha256(groups.encode()).hexdigest()
    return *key, *(int(x) for x in n), digest, pairs, times, *([groups or ""] if keep else [])


def whole(known: Remembered, keys: list[tuple], texts: list[str], keep: bool) -> Iterator[tuple]:
    """Outcomes of texts of bounded length."""
    cut = [chunks(" " + t) if t else [] for t in texts]
    known.learn(cut)
    codes = [[known.place[c] for c in p] for p in cut]
    sizes = [known.sizes[c] for c in codes]
    good = [len(s) > 0 and bool((s[:, 3] >= 0).all()) for s in sizes]
    links = [int(s[:, 3].sum()) if g else 0 for s, g in zip(sizes, good)]
    at = np.cumsum(np.maximum(known.sizes[:, 3], 0)) - np.maximum(known.sizes[:, 3], 0)
    for a, b in spans(links, LINKS):
        mine = [i for i in range(a, b) if good[i]]
        which = np.array([c for i in mine for c in codes[i]], np.int64)
        pool = gather(known.pool, at, known.sizes[:, 3], which)
        owner = np.repeat(np.arange(len(mine)), [links[i] for i in mine])
        # distinct pairs of each document and how often it has them
        base = len(known.pairs) or 1
        found, times = np.unique(owner * base + pool, return_counts=True)
        edge = np.searchsorted(found, np.arange(len(mine) + 1) * base).tolist()
        pairs, times = known.pairs[found % base].tolist(), times.tolist()
        done = 0
        for i in range(a, b):
            if not good[i]:
                yield _row(keys[i], None, (0, 0, 0, 0), [], [], keep)
                continue
            x, y = edge[done:done + 2]
            done += 1
            yield _row(keys[i], ";".join([known.groups[c] for c in codes[i]]), sizes[i].sum(axis=0), pairs[x:y], times[x:y], keep)


def pieces(text: str, size: int) -> Iterator[str]:
    """Space + text in pieces of at least ``size`` characters, each cut before a space that follows
    a character other than white space; without such a place there is no cut."""
    text = " " + text
    a = b = 0
    while a < len(text):
        b = max(b, a + size)
        b = text.find(" ", b)
        while 0 < b and text[b - 1].isspace():
            b = text.find(" ", b + 1)
        if b < 0:
            b = len(text)
        yield text[a:b]
        a = b


def fragments(vocabularies: Vocabularies, piece: str, start: int) -> Iterator[tuple[int, Fragment | None]]:
    """(range, fragment) of a piece that begins at byte ``start``; one of None if its bytes differ."""
    a, n_a, b, n_b = vocabularies.encode(chunks(piece))
    if not n_a.all():
        yield start // RANGE, None
        return
    ends = [start + np.cumsum(vocabularies.len_a[a]), start + np.cumsum(vocabularies.len_b[b])]
    a, b = a.tolist(), b.tolist()
    edges = np.arange(start // RANGE, (int(ends[0][-1]) - 1) // RANGE + 2) * RANGE
    of_a, of_b = (np.searchsorted(e, edges, side="right") for e in ends)
    for k, (i, j, m, n) in enumerate(zip(of_a, of_a[1:], of_b, of_b[1:])):
        yield int(edges[k]) // RANGE, vocabularies.fragment(a[i:j], b[m:n], ends[0][i:j], ends[1][m:n])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_LIST = pa.list_(pa.int64())
_INTS = pa.list_(pa.int32())
_FRAGMENT = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("start", pa.int64()), ("ok", pa.bool_()),
                       ("cut", pa.bool_()), ("prefix_a", _INTS), ("prefix_b", _INTS), ("groups", pa.string()), ("n_groups", pa.int64()), ("n_b", pa.int64()),
                       ("pairs", _LIST), ("times", _INTS), ("suffix_a", _INTS), ("suffix_b", _INTS)])
_FRAGMENT_SQL = ("row long, id long, place long, start long, ok boolean, cut boolean, prefix_a array<int>, prefix_b array<int>, groups string, "
                 "n_groups long, n_b long, pairs array<long>, times array<int>, suffix_a array<int>, suffix_b array<int>")


def _pack(row: int, key: int | None, place: int, start: int, f: Fragment | None) -> tuple:
    if f is None:
        return row, key, place, start, False, False, [], [], "", 0, 0, [], [], [], []
    return (row, key, place, start, True, f.cut, list(f.prefix[0]), list(f.prefix[1]), ";".join(f.groups), f.n_groups, f.n_b,
            list(f.pairs), list(f.pairs.values()), list(f.suffix[0]), list(f.suffix[1]))


def _unpack(r: dict) -> Fragment:
    return Fragment(r["cut"], (r["prefix_a"], r["prefix_b"]), [r["groups"]] if r["groups"] else [], r["n_groups"], r["n_b"],
                    dict(zip(r["pairs"], r["times"])), (r["suffix_a"], r["suffix_b"]))


def _result(keep: bool) -> tuple[pa.Schema, str]:
    names = ["n_a", "n_b", "n_groups", "n_links"]
    schema = [("row", pa.int64()), ("id", pa.int64()), *[(n, pa.int64()) for n in names], ("groups_sha256", pa.string()),
              ("pairs", _LIST), ("times", _INTS)] + [("groups", pa.string())] * keep
    sql = "row long, id long, " + "".join(f"{n} long, " for n in names) + "groups_sha256 string, pairs array<long>, times array<int>"
    return pa.schema(schema), sql + ", groups string" * keep


def _aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, keep: bool) -> DataFrame:
    """row, id, counts, digest, distinct pairs and times of every document, as a written table."""
    spark = docs.sparkSession
    schema, sql = _result(keep)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("t"))

    def first(batches):
        known = Remembered(load(path_a, path_b))
        both = pa.schema([*schema, ("piece", pa.string()), ("start", pa.int64())])
        for row, key, text in grouped(batches, 2, 1 << 20):
            row, key, text = row.to_pylist(), key.to_pylist(), text.to_pylist()
            short = [i for i, t in enumerate(text) if len(t) <= LONG]
            out = [(*r, None, None) for r in whole(known, [(row[i], key[i]) for i in short], [text[i] for i in short], keep)]
            for i in sorted(set(range(len(text))) - set(short)):
                start = 0
                for piece in pieces(text[i], LONG):
                    out.append((row[i], key[i], *[None] * (len(schema) - 2), piece, start))
                    start += len(piece.encode())
            for a, b in spans([64 + len(r[-2] or "") + 12 * len(r[7] or "") for r in out], 8 << 20):
                yield _batch(out[a:b], both)

    def second(batches):
        both = load(path_a, path_b)
        for row, key, start, piece in grouped(batches, 3, 1 << 20):
            for r, k, s, p in zip(*(x.to_pylist() for x in (row, key, start, piece))):
                yield _batch([_pack(r, k, place, s, f) for place, f in fragments(both, p, s)], _FRAGMENT)

    def together(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: (r["place"], r["start"]))
        v, one = load(path_a, path_b), found[0]
        f = v.compose([_unpack(r) for r in found]) if all(r["ok"] for r in found) else None
        return pa.Table.from_batches([_batch([_pack(one["row"], one["id"], one["place"] // FAN, one["start"], f)], _FRAGMENT)])

    def last(batches):
        v = load(path_a, path_b)
        for batch in batches:
            for r in batch.to_pylist():
                f = v.finish(_unpack(r)) if r["ok"] else None
                key = r["row"], r["id"]
                if f is None:
                    yield _batch([_row(key, None, (0, 0, 0, 0), [], [], keep)], schema)
                else:
                    groups, n_links = ";".join(f.groups), sum(f.pairs.values())
                    # a link ends where a token does; at a cut one of each does
                    yield _batch([_row(key, groups, (n_links + f.n_groups - f.n_b, f.n_b, f.n_groups, n_links), list(f.pairs),
                                       list(f.pairs.values()), keep)], schema)

    with batch_limits(spark):
        found = saved(rows.mapInArrow(first, sql + ", piece string, start long"), "aligned")
    short = found.where(F.col("piece").isNull()).drop("piece", "start")
    long = found.where(F.col("piece").isNotNull()).select("row", "id", "start", "piece").repartition(partitions(spark), "row", "start")
    with batch_limits(spark, rows=8):
        made = saved(long.mapInArrow(second, _FRAGMENT_SQL), "fragments")
        top = made.agg(F.max("place").alias("n")).first().n
        if top is None:
            return short
        while True:
            # adjoining ranges of a document meet, FAN at a time, until there is one
            made = saved(made.groupBy("row", F.floor(F.col("place") / FAN)).applyInArrow(together, _FRAGMENT_SQL), "fragments")
            top //= FAN
            if not top:
                break
        return short.unionByName(saved(made.mapInArrow(last, sql), "long_aligned"))


def _scored_by_join(found: DataFrame, counts: DataFrame) -> DataFrame:
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    each = each.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).join(counts, "pair")
    sums = each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return found.drop("pairs", "times").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])


def _scored_by_broadcast(found: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.orderBy("pair").toArrow()
    known = found.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    rest = [f for f in found.schema.fields if f.name not in ("pairs", "times")]

    def run(batches):
        pair, n, best = known.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(pair, pairs.flatten().to_numpy())
            edge = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * n[at])]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], *[pa.array(np.diff(s[edge])) for s in sums]],
                                             names=[*[f.name for f in rest], "n_best", "count_sum"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    with batch_limits(found.sparkSession):
        return saved(found.mapInArrow(run, kinds + ", n_best long, count_sum long"), "alignment_scores")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and (``keep_groups``) groups.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: decimal ids of A and of B in order.  A link is an overlap of
    one A and one B token; a pair's count is how many documents hold it linked, ``count_sum`` the sum
    over links, ``n_best`` the links whose pair has the highest count of its A id, ties included.

    Texts that are null, empty or don't come back as the bytes of either's tokens have no tokens: all
    zeros and empty texts.  Rows are independent documents, repeated ones and null ids too; other
    columns are left out; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    found = _aligned(docs, path_a, path_b, id_col, text_col, keep_groups)
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    width = load(path_a, path_b).width
    # an A id has at most as many pairs as B has ids
    a = Window.partitionBy(F.floor(F.col("pair") / width))
    counts = saved(counts.withColumn("best", F.col("n") == F.max("n").over(a)), "pair_counts")
    small = counts.count() * 17 <= broadcast_bytes
    scored = _scored_by_broadcast(found, counts) if small else _scored_by_join(found, counts)
    return scored.withColumnRenamed("id", id_col).select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
                                                         *["groups"] * keep_groups)
