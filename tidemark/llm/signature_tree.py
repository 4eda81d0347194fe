"""N-gram Jaccard join with signature trees.

A text's set is its distinct shingles.  Two texts link when 100 |A & B| >= 75 |A | B|.

A signature is a bitmap of a set's tokens.  A tree over texts in order of size holds, at each
node, the OR of the bitmaps below and the range of sizes.  Two trees (or one and itself) are
walked together: of a pair of nodes no two texts can share more tokens than the bits common to both
bitmaps, and the tokens that fell on a taken bit, so the pair is left out if that, or the sizes,
can't reach the threshold.  A pair of nodes whose texts are all connected already is left out too.

Which texts meet in a tree:
1. Only tokens that two texts share can make an overlap.  Blocks of texts send each distinct token
   once to the part of its hash and get back those that other texts hold too; a text with fewer
   than 75 % shared tokens has no partner.  Equal sets become one class.
2. Classes with an equal least hash of their tokens meet in a tree over whole sets: this connects
   most of each group of copies.  Then one class of each component, for three more hashes.
3. Exactly: two linked sets must share one of the first |A| - ceil(0.75 |A|) + 1 tokens of the larger
   and the first |B| - ceil(6/7 |B|) + 1 of the smaller, in any fixed order (6/7 is what two sets of
   one size must share).  The order is by document frequency, in powers of two, rarest first, so a
   passage of very many texts comes last, where as a rule no smaller set asks for it.  Classes of
   different components that share such a token meet in a tree over signatures; the pairs left are
   verified on the sets.  Nothing is skipped but pairs that are in one component already.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import spans
from tidemark.llm.common import batch_limits, free, partitions, saved
from tidemark.llm.components import components
from tidemark.llm.words import mix, shingle_hashes, utf8_buffers, word_hashes

_U = np.uint64
#: Distinct tokens and texts of a block.
BLOCK_TOKENS = 1 << 20
BLOCK_TEXTS = 50_000
#: Bytes of one Arrow batch, either way; a larger row is a batch of its own.
BATCH = 4 << 20
#: Texts of one tree; larger groups are cut.
GROUP = 2048
LEAF = 8
BROADCAST_ROWS = 500_000
#: Least hashes that texts meet by.
HASHES = 4
_SEEDS = np.random.RandomState(31).randint(0, 1 << 63, HASHES).astype(np.uint64) * _U(2) + _U(1)
_MARK = np.uint16(0xFFFF)

_ROW = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("head", pa.bool_()), ("ids", pa.binary()), ("nulls", pa.binary()),
                  ("sizes", pa.binary()), ("sums", pa.binary()), ("at", pa.binary()), ("tokens", pa.binary()),
                  ("held", pa.binary())])
_ROW_SQL = ("part long, block long, head boolean, ids binary, nulls binary, sizes binary, sums binary, at binary, tokens binary,"
            " held binary")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def least_needed(n: np.ndarray) -> np.ndarray:
    """Tokens that a set of n must share with any partner: ceil(0.75 n)."""
    return (3 * n + 3) // 4


def least_of_smaller(n: np.ndarray) -> np.ndarray:
    """Tokens that a set of n must share with a partner of its size or larger: ceil(6/7 n)."""
    return (6 * n + 6) // 7


def grade(texts: np.ndarray) -> np.ndarray:
    """Document frequency in powers of two."""
    return np.frexp(texts.astype(np.float64))[1].astype(np.uint8)


def _cut_batches(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """The batch in slices of about ``BATCH`` bytes."""
    wide = [batch.column(i) for i, f in enumerate(batch.schema) if pa.types.is_binary(f.type)]
    sizes = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in wide) + 64
    return [batch.slice(a, b - a) for a, b in spans(sizes.tolist(), BATCH)]


def token_ids(h: np.ndarray, parts: int) -> np.ndarray:
    """(part, low 48 bits) of a shingle hash in one number below 2**63."""
    part = ((h >> _U(48)) * _U(parts)) >> _U(16)
    return (part << _U(48)) | (h & _U((1 << 48) - 1))


def _block(number: int, ids: list, counts: list[np.ndarray], hashes: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """Rows of one block: a head with all its texts, and for each part the tokens that it asks about.

    Tokens that two texts of the block hold need no asking: they go with the head, and as a mark
    (no text, but how many) to their part, so that other blocks learn of them.
    """
    n = np.concatenate(counts)
    h = np.concatenate(hashes)
    doc = np.repeat(np.arange(len(n), dtype=np.uint16), n)
    order = np.argsort(h, kind="stable")  # texts stay in order within a token
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    sizes = np.bincount(doc, minlength=len(n)).astype(np.int64)
    back = np.argsort(doc, kind="stable")
    sums = np.zeros((2, len(n)), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        start = (np.cumsum(sizes) - sizes)[some]
        for k in range(2):
            sums[k, some] = np.add.reduceat(mix(h[back] * _U(0xA0761D6478BD642F) + _U(k + 1)), start)
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(h)))
    own = np.repeat(times, times) == 1
    key = token_ids(h, parts)
    head = (-1 - number, number, True, np.array([i or 0 for i in ids], np.int64).tobytes(), np.array([i is None for i in ids]).tobytes(),
            sizes.tobytes(), sums.tobytes(), doc[~own].tobytes(), key[~own].tobytes(), None)
    who = np.where(times == 1, doc[at], _MARK).astype(np.uint16)
    asked = key[at]
    edges = np.searchsorted(asked, np.arange(parts + 1, dtype=np.uint64) << _U(48))
    rows = [head]
    for p in range(parts):
        a, b = edges[p], edges[p + 1]
        if b > a:
            low = np.ascontiguousarray(asked[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
            marked = times[a:b][times[a:b] > 1].astype(np.uint32)
            rows.append((p, number, False, None, None, None, None, who[a:b].tobytes(), low.tobytes(), marked.tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)


def _blocks(docs: DataFrame, id_col: str, text_col: str, parts: int, width: int) -> DataFrame:

    def run(batches):
        # the same number again when a task is repeated, and no other task's
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 20
        ids, counts, hashes, held = [], [], [], 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for a, b in spans(sizes, 4 << 20):
                first, words = word_hashes(*utf8_buffers(batch.column(1).slice(a, b - a)))
                at, h = shingle_hashes(first, words, width)
                ids += batch.column(0)[a:b].to_pylist()
                counts.append(np.diff(at))
                hashes.append(h)
                held += len(h)
                if held >= BLOCK_TOKENS or len(ids) >= BLOCK_TEXTS:
                    yield from _cut_batches(_block(number, ids, counts, hashes, parts))
                    number += 1
                    ids, counts, hashes, held = [], [], [], 0
        if ids:
            yield from _cut_batches(_block(number, ids, counts, hashes, parts))

    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(run, _ROW_SQL)


def _shared(blocks: DataFrame) -> DataFrame:
    """Per part: which asked tokens are held by more than one text, with the grade of their frequency;
    marks whose grade is another than their block knows; heads pass through."""
    def run(table):
        rows = table.to_pylist()
        if rows[0]["head"]:
            return table
        part = _U(rows[0]["part"])
        raw = [np.frombuffer(r["tokens"], np.uint8).reshape(-1, 6) for r in rows]
        keys = np.zeros((sum(map(len, raw)), 8), np.uint8)
        keys[:, :6] = np.concatenate(raw)
        keys = keys.view("<u8").ravel()
        at = np.concatenate([np.frombuffer(r["at"], np.uint16) for r in rows])
        of = np.repeat(np.arange(len(rows)), [len(x) for x in raw])
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        begin = np.ones(len(k), bool)
        begin[1:] = k[1:] != k[:-1]
        run_of = np.cumsum(begin) - 1
        held = np.ones(len(k), np.int64)
        held[at == _MARK] = np.concatenate([np.frombuffer(r["held"], np.uint32) for r in rows])
        total = np.empty(len(k), np.int64)
        total[order] = np.bincount(run_of, held[order])[run_of].astype(np.int64)
        grades = grade(total)
        take = np.where(at == _MARK, grades != grade(held), total > 1)
        ends = np.searchsorted(of[take], np.arange(len(rows) + 1))
        at, tokens, grades = at[take], keys[take] | (part << _U(48)), grades[take]
        out = [(r["part"], r["block"], False, None, None, None, None, at[a:b].tobytes(), tokens[a:b].tobytes(), grades[a:b].tobytes())
               for r, a, b in zip(rows, ends, ends[1:]) if b > a]
        made = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(_ROW)], schema=_ROW)
        return pa.Table.from_batches(_cut_batches(made), _ROW)

    return blocks.groupBy("part").applyInArrow(run, _ROW_SQL)


def codes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Distinct 16-bit codes of the tokens, 32-bit ones for large sets: a very fine bitmap, as a list."""
    return np.unique((mix(tokens) >> _U(20)).astype(np.uint16 if n <= 4096 else np.uint32))


def packed(c: np.ndarray) -> bytes:
    """Codes as compressed steps from each to the next."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(c, prepend=c.dtype.type(0)).tobytes())


def unpacked(raw: bytes, n: int) -> np.ndarray:
    kind = np.uint16 if n <= 4096 else np.uint32
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind), dtype=kind)


def bitmap(c: np.ndarray, n: int) -> np.ndarray:
    """Bits of the codes, in a map of a power of two of at least 2n and 256 bits."""
    bits = max(256, 1 << int(2 * n - 1).bit_length())
    out = np.zeros(bits, bool)
    out[c & (bits - 1)] = True
    return np.packbits(out, bitorder="little")


_SET_SQL = ("key long, id long, n long, s1 long, s2 long, " + ", ".join(f"m{j} long" for j in range(HASHES))
            + ", held long, tokens binary, prefix binary, codes binary")


def _answered(head: dict, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, token and grade of all shared tokens of a block: those it knew of and those it asked for."""
    own = np.frombuffer(head["tokens"], np.uint64)
    known, number, times = np.unique(own, return_inverse=True, return_counts=True)
    grades = grade(times)
    at = np.concatenate([np.zeros(0, np.uint16), *[np.frombuffer(r["at"], np.uint16) for r in answers]])
    tokens = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r["tokens"], np.uint64) for r in answers]])
    told = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(r["held"], np.uint8) for r in answers]])
    mark = at == _MARK
    grades[np.searchsorted(known, tokens[mark])] = told[mark]
    return (np.concatenate([np.frombuffer(head["at"], np.uint16), at[~mark]]), np.concatenate([own, tokens[~mark]]),
            np.concatenate([grades[number], told[~mark]]))


def _sets(shared: DataFrame) -> DataFrame:
    """One row per text; tokens, codes and least hashes only where a partner is possible."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        *[(f"m{j}", pa.int64()) for j in range(HASHES)], ("held", pa.int64()),
                        ("tokens", pa.binary()), ("prefix", pa.binary()), ("codes", pa.binary())])

    def run(table):
        rows = table.to_pylist()
        head = next(r for r in rows if r["head"])
        sizes = np.frombuffer(head["sizes"], np.int64)
        sums = np.frombuffer(head["sums"], np.int64).reshape(2, -1)
        ids, nulls = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["nulls"], bool)
        at, tokens, grades = _answered(head, [r for r in rows if not r["head"]])
        order = np.lexsort((tokens, at))
        tokens, grades = tokens[order], grades[order]
        ends = np.searchsorted(at[order], np.arange(len(sizes) + 1))
        out = []
        for i, n in enumerate(sizes.tolist()):
            t = tokens[ends[i]:ends[i + 1]]
            row = [head["block"] << 17 | i, None if nulls[i] else int(ids[i]), n, int(sums[0, i]), int(sums[1, i])]
            spare = len(t) - int(least_needed(np.int64(n)))
            if n and spare >= 0:
                row += [int((mix(t ^ s) >> _U(1)).min()) for s in _SEEDS]
                prefix = t[np.lexsort((t, grades[ends[i]:ends[i + 1]]))[:spare + 1]]
                row += [len(t), t.tobytes(), prefix.tobytes(), packed(codes(t, n))]
            else:
                row += [None] * (HASHES + 4)
            out.append(row)
        made = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)
        return pa.Table.from_batches(_cut_batches(made), schema)

    return shared.groupBy("block").applyInArrow(run, _SET_SQL)


def linked(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> bool:
    """Whether sets of sizes na and nb with these shared tokens (sorted) link."""
    if len(a) > len(b):
        a, b = b, a
    where = np.searchsorted(b, a)
    where[where == len(b)] = 0
    both = int((b[where] == a).sum()) if len(b) else 0
    return 100 * both >= 75 * (na + nb - both)


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bits for the same tokens."""
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


class Tree:
    """Signature tree over texts: OR of bitmaps, sizes and crowding (tokens less bits) by node.

    The smaller text of a pair has to be one of ``small``.
    """

    def __init__(self, n: np.ndarray, bits: list[np.ndarray], crowded: np.ndarray, component: np.ndarray, order: np.ndarray,
                 small: np.ndarray):
        width = min(len(b) for b in bits)
        self.order, self.n, self.small = order, n, small
        self.maps = np.stack([fold(b, width) for b in bits]).view(np.uint64)
        # folding lets more tokens fall on one bit
        total = crowded + np.array([int(np.bitwise_count(b).sum()) for b in bits])
        self.crowded = total - np.bitwise_count(self.maps).sum(axis=1)
        self.total = total
        self.parent = component.copy()
        self.nodes: list[tuple] = []
        self.same: list[bool] = []
        self.root = self._make(0, len(order))

    def _make(self, a: int, b: int) -> int:
        kids = () if b - a <= LEAF else (self._make(a, (a + b) // 2), self._make((a + b) // 2, b))
        rows = self.order[a:b]
        if kids:
            x, y = (self.nodes[k] for k in kids)
            node = (a, b, kids, x[3] | y[3], min(x[4], y[4]), max(x[5], y[5]), max(x[6], y[6]), max(x[7], y[7]),
                    min(x[8], y[8]))
        else:
            node = (a, b, kids, np.bitwise_or.reduce(self.maps[rows], axis=0), int(self.n[rows].min()), int(self.n[rows].max()),
                    int(self.crowded[rows].max()), int(self.total[rows].max()),
                    int(self.n[rows][self.small[rows]].min(initial=1 << 62)))
        self.nodes.append(node)
        self.same.append(False)
        return len(self.nodes) - 1

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)

    def connected(self, k: int) -> bool:
        """Whether all texts below a node are in one component (it stays so)."""
        if not self.same[k]:
            a, b, kids = self.nodes[k][:3]
            ends = [self.find(self.order[i]) for i in ((self.nodes[kids[0]][0], self.nodes[kids[1]][0]) if kids else range(a, b))]
            self.same[k] = len(set(ends)) == 1 and all(self.connected(x) for x in kids)
        return self.same[k]

    def possible(self, x: tuple, y: tuple) -> bool:
        """Whether two nodes may hold a linked pair, by sizes and by the largest overlap."""
        if 4 * x[5] < 3 * y[4] or 4 * y[5] < 3 * x[4] or (x[8] > y[5] and y[8] > x[5]):
            return False
        most = int(np.bitwise_count(x[3] & y[3]).sum()) + min(x[6], y[6])
        # 100 o >= 75 (na + nb - o)
        return 7 * min(most, x[7], y[7]) >= 3 * (x[4] + y[4])

    def walk(self, test) -> None:
        """Call ``test`` on each possible pair of unconnected texts, joining those for which it holds."""
        stack = [(self.root, self.root)]
        while stack:
            p, q = stack.pop()
            x, y = self.nodes[p], self.nodes[q]
            if self.connected(p) and self.connected(q) and self.find(self.order[x[0]]) == self.find(self.order[y[0]]):
                continue
            if x[8] > x[5] if p == q else not self.possible(x, y):
                continue
            if not x[2] and not y[2]:
                for i, j in self._pairs(self.order[x[0]:x[1]], self.order[y[0]:y[1]], p == q):
                    if self.find(i) != self.find(j) and test(i, j):
                        self.join(i, j)
            elif p == q:
                l, r = x[2]
                stack += [(l, r), (r, r), (l, l)]  # inner pairs first: what they join needs no cross pairs
            elif y[2] and (not x[2] or y[1] - y[0] >= x[1] - x[0]):
                stack += [(p, k) for k in y[2]]
            else:
                stack += [(k, q) for k in x[2]]

    def _pairs(self, i: np.ndarray, j: np.ndarray, same: bool) -> list[tuple[int, int]]:
        """The pairs of two leaves that are possible, each once."""
        both = lambda f, v: f.outer(v[i], v[j])
        most = np.bitwise_count(self.maps[i][:, None, :] & self.maps[j][None, :, :]).sum(axis=2, dtype=np.int64)
        most = np.minimum(most + both(np.minimum, self.crowded), both(np.minimum, self.total))
        ok = (4 * both(np.minimum, self.n) >= 3 * both(np.maximum, self.n)) & (7 * most >= 3 * both(np.add, self.n))
        smaller = np.less_equal.outer(self.n[i], self.n[j])
        ok &= (smaller & self.small[i][:, None]) | (np.greater_equal.outer(self.n[i], self.n[j]) & self.small[j][None, :])
        a, b = np.nonzero(np.triu(ok, 1) if same else ok)
        return list(zip(i[a].tolist(), j[b].tolist()))


def _groups(batches, keys: list[str]):
    """Rows of equal keys that follow each other, as lists of dicts."""
    rows, now = [], None
    for batch in batches:
        for r in batch.to_pylist():
            k = tuple(r[c] for c in keys)
            if k != now and rows:
                yield rows
                rows = []
            now = k
            rows.append(r)
    if rows:
        yield rows


def _tree(rows: list[dict], by: list[np.ndarray], short: list[np.ndarray], small: np.ndarray | None = None) -> Tree:
    """Tree over texts given as rows (n, held, component) with the codes of each."""
    small = np.ones(len(rows), bool) if small is None else small
    n = np.array([r["n"] for r in rows])
    bits = [bitmap(c, r["n"]) for c, r in zip(short, rows)]
    crowded = np.array([r["held"] for r in rows]) - np.array([int(np.bitwise_count(b).sum()) for b in bits])
    component = np.array([r["component"] for r in rows])
    _, first, number = np.unique(component, return_index=True, return_inverse=True)
    order = np.lexsort(tuple(by) + (n, component, small))
    return Tree(n, bits, crowded, first[number], order, small)


def _meet(rows: DataFrame, group: list[str]) -> DataFrame:
    """Links (a, b) found in trees over whole sets: of each component that was joined to others
    one text, with the first of what it was joined to."""

    def run(batches):
        found = []
        for own in _groups(batches, group):
            tokens = [np.frombuffer(r["tokens"], np.uint64) for r in own]

            if len(own) > 1:
                tree = _tree(own, [np.array([t[-1] for t in tokens])], [codes(t, r["n"]) for t, r in zip(tokens, own)])
                heads = np.unique(tree.parent)
                tree.walk(lambda i, j: linked(tokens[i], tokens[j], own[i]["n"], own[j]["n"]))
                found += [(own[i]["key"], own[tree.find(i)]["key"]) for i in heads.tolist() if tree.find(i) != i]
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    p = partitions(rows.sparkSession)
    sorted_rows = rows.repartition(p, *group).sortWithinPartitions(*group, "key")
    return sorted_rows.select(*group, "key", "n", "held", "component", "tokens").mapInArrow(run, "a long, b long")


def _cut(rows: DataFrame, sizes: DataFrame, by: str) -> DataFrame:
    """Groups of more than GROUP rows cut into pieces by a hash of the key, each with the group's first row."""
    joined = rows.join(_small(sizes), by)
    pieces = F.ceil(F.col("size") / GROUP).cast("int")
    piece = F.when(F.col("key") == F.col("least"), F.sequence(F.lit(0), pieces - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("key"), pieces).cast("int")))
    return joined.withColumn("piece", F.explode(piece))


def _with_component(classes: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes with their component so far, the components)."""
    found = saved(components(links), "components") if links.limit(1).count() else links.select(
        F.col("a").alias("node"), F.col("b").alias("root"))
    joined = classes.join(_small(found.withColumnRenamed("node", "key")), "key", "left")
    return joined.withColumn("component", F.coalesce("root", "key")).drop("root"), found


def _candidates(reps: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix token and pass the signature trees."""
    spark = reps.sparkSession
    thin = reps.select("key", "component", "n", "held", "prefix")

    def spread(batches):
        for batch in batches:
            key, component, n, held = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            raw = batch.column(4).to_pylist()
            size = np.array([len(x) // 8 for x in raw], np.int64)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            small = place <= np.repeat(held - least_of_smaller(n), size)
            wide = [np.repeat(c, size) for c in (key, component, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.frombuffer(b"".join(raw), np.int64), *wide, small)],
                                             names=["token", "key", "component", "n", "small"])

    # small: among the first tokens that the smaller set of a pair needs
    postings = thin.mapInArrow(spread, "token long, key long, component long, n long, small boolean")

    def several(rows: DataFrame, *by: str) -> DataFrame:
        """Groups that texts of two components share, one of them with ``small``; groups of the same texts
        make one."""
        groups = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"),
            F.bit_xor(F.xxhash64("key", "small")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "key", "small")).alias("x2"),
            F.bool_or("small").alias("small"), F.collect_set("class").alias("classes"))
        groups = groups.where("lo <> hi AND small").groupBy("size", "x1", "x2").agg(
            F.min(F.struct(*by)).alias("by"), F.any_value("classes").alias("classes"))
        return saved(groups.select("by.*", "size", "classes"), "groups")

    # first the tokens of two components, then of these those of two components of like size: sizes
    # whose ratio is 0.75 or more lie in the same class of ratio 4 / 3 or in neighbouring ones, so
    # texts meet only within a run of classes that follow each other (level: its first class)
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(4 / 3) + 1e-9).cast("int")
    postings = postings.withColumn("class", size_class).drop("n")
    rows = postings.join(_small(several(postings, "token").drop("size")), "token")
    level = F.array_max(F.filter("classes", lambda c: (c <= F.col("class")) & ~F.array_contains(F.col("classes"), c - 1)))
    rows = saved(rows.withColumn("level", level).drop("classes"), "postings")
    rows = rows.join(_small(several(rows, "token", "level").drop("classes")), ["token", "level"])
    # a large group is dealt to the cells of a triangle: every two of its pieces meet in one
    pieces = F.ceil(F.col("size") / GROUP).cast("int")
    mine = F.pmod(F.xxhash64("key"), pieces).cast("int")
    cells = F.transform(F.sequence(F.lit(0), pieces - 1), lambda o: F.struct(F.least(o, mine).alias("x"), F.greatest(o, mine).alias("y")))
    rows = rows.withColumn("cell", F.explode(cells)).select("token", "level", "cell.x", "cell.y", "key", "component", "small")
    rows = rows.join(reps.select("key", "n", "held", "codes"), "key")

    group = ["token", "level", "x", "y"]

    def run(batches):
        found = set()
        for own in _groups(batches, group):
            if len({r["component"] for r in own}) > 1 and any(r["small"] for r in own):
                short = [unpacked(r["codes"], r["n"]) for r in own]
                tree = _tree(own, [np.array([r["key"] for r in own])], short, np.array([r["small"] for r in own]))

                def test(i: int, j: int) -> bool:
                    a, b, x, y = own[i], own[j], short[i], short[j]
                    if x.dtype != y.dtype:  # the finer codes at the coarser grain
                        x, y = (np.unique(c.astype(np.uint16)) for c in (x, y))
                    spare = min(int(tree.total[i]) - len(x), int(tree.total[j]) - len(y))
                    where = np.searchsorted(y, x)
                    where[where == len(y)] = 0
                    if 7 * (int((y[where] == x).sum()) + spare) < 3 * (a["n"] + b["n"]):
                        return False
                    found.add((min(own[i]["key"], own[j]["key"]), max(own[i]["key"], own[j]["key"])))
                    return False

                tree.walk(test)
            if len(found) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
                found = set()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    dealt = rows.repartition(partitions(spark), *group).sortWithinPartitions(*group, "key")
    return dealt.select(*group, "key", "component", "small", "n", "held", "codes").mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose sets link."""
    side = lambda c: reps.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("tokens").alias(f"t{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            keep = [linked(np.frombuffer(r["ta"], np.uint64), np.frombuffer(r["tb"], np.uint64), r["na"], r["nb"]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r, k in zip(rows, keep) if k], pa.int64()) for c in "ab"], names=["a", "b"])

    return both.select("a", "b", "na", "nb", "ta", "tb").mapInArrow(run, "a long, b long")


def join(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id of every row.

    ``component_id`` is the smallest id reachable by links.  A text without words has no shingles
    and no links; a null text counts as empty.  Repeated rows are linked with each other; a row
    with a null id has the smallest id of its component, null if there is none.
    """
    with batch_limits(docs.sparkSession, size=BATCH):
        return _join(docs, width, id_col, text_col)


def _join(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    parts = min(16384, 2 * partitions(spark))
    sets = saved(_sets(_shared(_blocks(docs, id_col, text_col, parts, width))), "shingle_sets")
    able = sets.where(F.col("tokens").isNotNull())
    equal = ["n", "s1", "s2"]
    classes = saved(able.groupBy(*equal).agg(F.min("key").alias("rep"), F.min("id").alias("least_id")), "shingle_classes")
    keys = _small(classes.select(F.col("rep").alias("key")))
    reps = able.join(keys, "key").withColumn("component", F.col("key"))

    sizes = saved(reps.groupBy("m0").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("least")).where("size > 1"), "meeting_sizes")
    links = saved(_meet(_cut(reps, sizes, "m0"), ["m0", "piece"]), "links")
    reps, found = _with_component(reps.drop("component"), links)

    # one text of each component for each of the other hashes
    thin = reps.select("key", "component", F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"m{j}").alias("m")) for j in range(1, HASHES)])).alias("h"))
    thin = thin.groupBy("h.j", "h.m", "component").agg(F.min("key").alias("key"))
    thin = saved(thin.withColumn("meet", F.xxhash64("j", "m")).select("meet", "key"), "meetings")
    sizes = saved(thin.groupBy("meet").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("least")).where("size > 1"), "meeting_sizes")
    more = saved(_meet(_cut(reps.join(_small(thin), "key"), sizes, "meet"), ["meet", "piece"]), "links")
    if more.limit(1).count():
        links = links.unionByName(more)
        reps, found = _with_component(reps.drop("component"), links)

    pairs = saved(_candidates(reps), "pairs")
    last = saved(_verified(pairs, reps), "links")
    if last.limit(1).count():
        found = saved(components(links.unionByName(last)), "components")
    # class -> component -> its smallest id
    named = classes.join(_small(found.withColumnRenamed("node", "rep")), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    named = saved(named, "named")
    least = saved(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    named = saved(named.join(_small(least), "root").select(*equal, "component_id"), "named")
    named = _small(named.withColumnsRenamed({c: f"_{c}" for c in equal}))
    same = [sets[c] == F.col(f"_{c}") for c in equal]
    out = sets.select("id", *equal, F.col("m0").isNotNull().alias("able")).join(
        named, (F.col("n") == F.col("_n")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")) & F.col("able"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of smallest id in their component; of repeated rows one.

    Rows without an id can't be told apart by it: they stay.
    """
    found = saved(join(docs, id_col=id_col, text_col=text_col), "components_of")
    kept = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_kept"))
    ids = _small(kept.distinct())
    named = docs.join(ids, docs[id_col] == ids["_kept"], "left_semi")
    if kept.groupBy("_kept").count().where("count > 1").limit(1).count():
        t = free("_t", docs.columns)
        named = named.withColumn(t, F.xxhash64(text_col)).dropDuplicates([id_col, t]).drop(t)
    return named.unionByName(docs.where(F.col(id_col).isNull()))
