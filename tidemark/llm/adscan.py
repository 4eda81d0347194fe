"""Approximate nearest neighbours by cosine: an adaptive dimension scan of inverted lists.

Unit vectors are rotated by a random orthogonal matrix and dealt to lists by their nearest
centroid.  A query looks into its nearest lists: as many as a sample says, and on until they hold
k + 1 rows, so that it gets k whenever there are k others.  There the dimensions are read a block of
columns at a time: after d of D rotated dimensions the squared distance is about D / d times the
partial one, and a candidate is given up when the partial distance rejects, at the confidence set
by ``epsilon``, the hypothesis that its distance is below the query's k-th so far.  What is left
after the last block is scored exactly, in double precision on the vectors given.

Centroids and the number of lists to look into come from a bounded sample (``sample`` rows in the
order of a hash of the id), fitted in a task; every row is indexed.

The index is a table of packs, runs of rows in the order of their lists.  Parts of the queries meet
every pack as both are read, so that no vector is sent once for each list that is looked into; the
driver holds the centroids and the lists' sizes alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LARGE_ROWS, batch_limits, partitions, saved
from tidemark.llm.vectors import Top, answers, few_copies, query_classes, valid

#: Column block of the scan.
STEP = 8
#: Of whole squared distances of unit vectors in single precision; what is within is scored exactly.
SLACK = 1e-4
MAX_LISTS = 4096
#: Bytes of one pack's vectors, as doubles.
PACK_BYTES = 2 << 20
#: Blocks of queries in a part.
PART_BLOCKS = 8
#: Bytes of one matrix of similarities while centroids are fitted.
FIT_BYTES = 8 << 20


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.RandomState(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two (exactly) that bring their largest component between 1/2 and 1."""
    power = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    # in two steps: the power itself may be beyond a double
    return np.ldexp(np.ldexp(x, -(power // 2)), -(power - power // 2))


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def in_pieces(x: np.ndarray, width: int) -> list[np.ndarray]:
    """Runs of rows whose products with ``width`` vectors are of bounded size."""
    return np.array_split(x, max(1, math.ceil(len(x) * width * 8 / FIT_BYTES)))


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([(p @ centroids.T).argmax(axis=1) for p in in_pieces(x, len(centroids))])


def fit_centroids(x: np.ndarray, lists: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.RandomState(seed)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def lists_needed(x: np.ndarray, centroids: np.ndarray, k: int, recall: float, queries: int = 400) -> int:
    """How many nearest lists hold that share of the k nearest sample rows of sample queries."""
    if len(x) <= k + 1:
        return len(centroids)
    home, ranks, first = nearest(x, centroids), [], 0
    for q in in_pieces(x[:queries], len(x)):
        s = q @ x.T
        s[np.arange(len(q)), first + np.arange(len(q))] = -np.inf
        first += len(q)
        near = np.argpartition(-s, k, axis=1)[:, :k]
        place = np.argsort(np.argsort(-(q @ centroids.T), axis=1), axis=1)
        ranks.append(np.take_along_axis(place, home[near], axis=1).ravel())
    return int(min(len(centroids), np.quantile(np.concatenate(ranks), recall) + 1))


def scan_block(q: np.ndarray, q_given: np.ndarray, x: np.ndarray, x_given: np.ndarray, ids: np.ndarray, top: Top,
               epsilon: float) -> int:
    """Scan one block of a list for queries that look into it; returns the components read.

    ``q`` and ``x`` are rotated unit vectors, ``*_given`` the vectors as given.
    """
    dims = q.shape[1]
    # distances in single precision and limits with room for that; scores in double
    q, x = np.asarray(q, np.float32), np.asarray(x, np.float32)
    # pairs that are still in the race
    alive = np.ones((len(q), len(x)), bool)
    partial = np.zeros(alive.shape, np.float32)
    step, within = np.empty_like(partial), np.empty_like(alive)
    read = 0
    least = top.least()
    # squared distance of the k-th; nothing is given up before there is one
    worst = np.where(least > -np.inf, 2.0 - 2.0 * np.maximum(least, -1.0), np.inf)
    for d in range(0, dims, STEP):
        seen = min(d + STEP, dims)
        left = np.count_nonzero(alive)
        if not left:
            return read
        if left > 0.25 * alive.size:  # most are there: whole column blocks, |a|^2 - 2 ab + |b|^2 as one product
            a, b = q[:, d:seen], x[:, d:seen]
            one = np.ones((max(alive.shape), 1), np.float32)
            np.matmul(np.hstack([-2 * a, (a * a).sum(1, keepdims=True), one[:len(a)]]),
                      np.hstack([b, one[:len(b)], (b * b).sum(1, keepdims=True)]).T, out=step)
            np.add(partial, step, out=partial)
            read += alive.size * (seen - d)
        else:
            i, j = np.nonzero(alive)
            partial[i, j] += ((q[i, d:seen] - x[j, d:seen]) ** 2).sum(axis=1)
            read += len(i) * (seen - d)
        if seen < dims:
            limit = worst * (seen / dims) * (1.0 + epsilon / math.sqrt(seen)) ** 2
        else:
            limit = worst + SLACK
        np.less_equal(partial, limit[:, None].astype(np.float32), out=within)
        alive &= within
    if not alive.any():
        return read
    keep = top.score.shape[1]
    if np.count_nonzero(alive) > 2 * keep * len(q):
        # all distances are whole: rows beyond the block's own k-th can't be among the best
        least = np.partition(np.where(alive, partial, np.inf), keep - 1, axis=1)[:, keep - 1]
        alive &= partial <= least[:, None] + np.float32(SLACK)
    i, j = np.nonzero(alive)
    offer(top, i, cosine(q_given[i], x_given[j]), ids[j])
    return read


def offer(top: Top, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
    """Candidates one by one, as (query, score, id)."""
    keep = top.score.shape[1]
    order = np.lexsort((ids, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, score, ids, place = (a[place < keep] for a in (row, score, ids, place))
    who, at = np.unique(row, return_inverse=True)
    best, best_ids = np.full((len(who), keep), top.none), np.full((len(who), keep), np.iinfo(np.int64).max)
    best[at, place], best_ids[at, place] = score, ids
    top.add(who, best, best_ids)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; no square under- or overflows."""
    if not len(a):
        return np.zeros(0)
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def enough_lists(s: np.ndarray, n: int, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """Of each row of similarities to the lists the ``n`` nearest, and more until they hold ``least`` rows."""
    order = np.argsort(-s, axis=1, kind="stable")
    short = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1)
    return [o[:max(n, m + 1)] for o, m in zip(order, short)]


def _vectors(column: pa.Array) -> np.ndarray:
    """A column of lists of one length, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _fit(cand: DataFrame, n: int, k: int, recall: float, sample: int, seed: int):
    """Of a task that reads the sample: its centroids, the share of its rows in each list, and how many
    lists to look into; None if there are no rows."""

    def run(batches):
        x = [_vectors(batch.column(0)) for batch in batches if batch.num_rows]
        if not x:
            return
        x = unit(np.concatenate(x))
        centroids = fit_centroids(x, max(1, min(MAX_LISTS, math.isqrt(n), len(x) // 8)), seed)
        shares = np.bincount(nearest(x, centroids), minlength=len(centroids)) / len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array([y]) for y in (len(x), x.shape[1], centroids.tobytes(), shares.tobytes(), lists_needed(x, centroids, k, recall))],
            names=["rows", "dims", "centroids", "shares", "n_probe"])

    spread = F.xxhash64(F.lit(seed), "id")

    def fitted(rows):
        picked = rows.orderBy(spread, "id").limit(sample).select("v")
        with batch_limits(cand.sparkSession):
            return next(iter(picked.mapInArrow(run, "rows long, dims long, centroids binary, shares binary, n_probe long").collect()), None)

    # twice the share of hashes that the sample takes; more only if that didn't hold enough rows
    found = None
    if 2 * sample < n:
        found = fitted(cand.where(spread < F.lit((2 * sample << 64) // n - (1 << 63))))
    if found is None or found.rows < min(sample, n):
        found = fitted(cand)
    return found and (np.frombuffer(found.centroids).reshape(-1, found.dims), np.frombuffer(found.shares), found.n_probe)


def _index(cand: DataFrame, centroids: np.ndarray, turn: np.ndarray, cuts: np.ndarray) -> DataFrame:
    """Packs of rows in the order of their lists: (lists, counts, id, v, r), r being the rotated unit vectors.

    The rows of a list go to as many places as ``cuts`` says."""
    kind = cand.schema["v"].dataType.elementType.simpleString()
    most = max(1, PACK_BYTES // (8 * turn.shape[0]))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                near = nearest(unit(_vectors(batch.column(1))), centroids)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(cuts[near])], names=["id", "v", "list", "cut"])

    def pack(rows):
        table = pa.Table.from_batches(rows).combine_chunks()
        held = table.column("list").to_numpy()
        first = np.flatnonzero(np.diff(held, prepend=-1))
        v = pa.concat_arrays(table.column("v").chunks).flatten().to_numpy(zero_copy_only=False)
        turned = unit(v.reshape(len(held), -1).astype(np.float64)) @ turn
        return pa.RecordBatch.from_arrays(
            [pa.array([held[first]]), pa.array([np.diff(first, append=len(held))]), pa.array([table.column("id").to_numpy().tobytes()]),
             pa.array([v.tobytes()]), pa.array([turned.astype(np.float32).tobytes()])], names=["lists", "counts", "id", "v", "r"])

    def packs(batches):
        held = []
        for batch in batches:
            while batch.num_rows:
                room = most - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == most:
                    yield pack(held)
                    held = []
        if held:
            yield pack(held)

    spark = cand.sparkSession
    dealt = cand.select("id", "v").mapInArrow(assign, f"id long, v array<{kind}>, list long, cut long")
    dealt = dealt.select("id", "v", "list", F.pmod(F.xxhash64("id"), "cut").alias("piece"))
    dealt = dealt.repartition(partitions(spark), "list", "piece").sortWithinPartitions("list", "piece").select("id", "v", "list")
    with batch_limits(spark):
        return saved(dealt.mapInArrow(packs, "lists array<long>, counts array<long>, id binary, v binary, r binary"), "index", LARGE_ROWS)


def _parts(asked: DataFrame, centroids: np.ndarray, n_probe: int, sizes: np.ndarray, least: int, most: int) -> DataFrame:
    """Parts of at most ``most`` queries: (part, class, v, looks), looks being a line of bits for each
    list, one for each query that looks into it."""

    def part(rows):
        given = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in rows])
        v = given.reshape(-1, centroids.shape[1]).astype(np.float64)
        looks = np.zeros((len(v), len(centroids)), bool)
        done = 0
        for x in in_pieces(unit(v), 4 * len(centroids)):
            for i, lists in enumerate(enough_lists(x @ centroids.T, n_probe, sizes, least), done):
                looks[i, lists] = True
            done += len(x)
        classes = np.concatenate([b.column(0).to_numpy() for b in rows])
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in (classes, given, np.packbits(looks.T, axis=1))],
                                          names=["class", "v", "looks"])

    def run(batches):
        held = []
        for batch in batches:
            while batch.num_rows:
                room = most - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == most:
                    yield part(held)
                    held = []
        if held:
            yield part(held)

    spark = asked.sparkSession
    out = asked.select("class", "v").mapInArrow(run, "class binary, v binary, looks binary")
    with batch_limits(spark):
        return saved(out.withColumn("part", F.monotonically_increasing_id()), "parts", LARGE_ROWS)


class Asked:
    """A part of the queries in a task that reads packs, with the best rows that they have met."""

    def __init__(self, classes: np.ndarray, v: np.ndarray, looks: np.ndarray, turn: np.ndarray, k: int):
        self.classes, self.v = classes, v.reshape(len(classes), -1)
        self.turned = (unit(self.v) @ turn).astype(np.float32)
        self.looks = looks.reshape(-1, math.ceil(len(classes) / 8))
        self.top = Top(len(classes), k)

    def meet(self, lists: np.ndarray, counts: np.ndarray, ids: np.ndarray, v: np.ndarray, r: np.ndarray, list_block: int,
             query_block: int, epsilon: float) -> None:
        start = 0
        for at, rows in zip(lists.tolist(), counts.tolist()):
            end = start + rows
            who = np.flatnonzero(np.unpackbits(self.looks[at], count=len(self.classes)))
            for a in range(start, end, list_block) if len(who) else ():
                b = min(a + list_block, end)
                given = v[a:b].astype(np.float64)
                for w in range(0, len(who), query_block):
                    q = who[w:w + query_block]
                    top = Top(len(q), self.top.score.shape[1])
                    top.score, top.id = self.top.score[q], self.top.id[q]
                    scan_block(self.turned[q], self.v[q], r[a:b], given, ids[a:b], top, epsilon)
                    self.top.score[q], self.top.id[q] = top.score, top.id
            start = end

    def found(self) -> pa.RecordBatch:
        hit = self.top.found()
        who = np.broadcast_to(self.classes[:, None], hit.shape)[hit]
        return pa.RecordBatch.from_arrays([pa.array(who), pa.array(self.top.id[hit]), pa.array(self.top.score[hit])],
                                          names=["class", "vec_id", "score"])


def search(embeddings: DataFrame, k: int = 5, every: int = 50, recall: float = 0.97, epsilon: float = 2.1,
           sample: int = 20_000, list_block: int = 2048, query_block: int = 512, seed: int = 11,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine found for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own; ties go to the smaller id.  ``recall`` is the share of a sample's true neighbours that the
    lists looked into must hold.  Zero vectors take no part; nothing valid gives an empty table.
    """
    spark = embeddings.sparkSession
    rows = valid(embeddings, F.col("v"), id_col, vec_col).where(F.exists("v", lambda x: x != 0))
    given = embeddings.schema[vec_col].dataType.elementType
    if given == T.FloatType():  # the same numbers in half of the bytes
        rows = rows.withColumn("v", F.col("v").cast("array<float>"))
    cand, n = few_copies(rows, k)
    asked, members = query_classes(rows, every)
    centroids, shares, n_probe = _fit(cand, n, k, recall, sample, seed) or (np.zeros((1, 1)), np.ones(1), 1)
    turn = rotation(centroids.shape[1], seed)

    # lists longer than a block, or than a task's share, are cut, as far as the sample knows them
    long = min(list_block, max(1, n // partitions(spark)))
    index = _index(cand, centroids, turn, np.maximum(1, np.ceil(shares * n / long)).astype(np.int64))
    each = index.select(F.explode(F.arrays_zip("lists", "counts")).alias("x")).groupBy("x.lists").agg(F.sum("x.counts").alias("rows"))
    sizes = np.zeros(len(centroids), np.int64)  # at most MAX_LISTS
    for r in each.collect():
        sizes[r.lists] = r.rows
    # a query may find itself in its lists
    parts = _parts(asked, centroids, n_probe, sizes, k + 1, PART_BLOCKS * query_block)
    # a part meets all packs of a lane in one task, which knows the k-th distances of its queries; both
    # are read again for each other, as sending every pack to every part would fill the disks
    n_parts = max(1, parts.count())
    lanes = max(1, partitions(spark) // n_parts)
    pairs = index.coalesce(lanes).crossJoin(
        parts.repartition(n_parts).withColumnRenamed("v", "q").hint("shuffle_replicate_nl"))
    kind = np.float32 if given == T.FloatType() else np.float64

    def run(batches):
        asking: dict[int, Asked] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                part, counts = batch.column(0)[i].as_py(), batch.column(5)[i].values.to_numpy()
                classes, q, looks, ids, v, r = (batch.column(j)[i].as_buffer() for j in (1, 2, 3, 6, 7, 8))
                if part not in asking:
                    asking[part] = Asked(np.frombuffer(classes, np.int64), np.frombuffer(q, kind).astype(np.float64),
                                         np.frombuffer(looks, np.uint8).copy(), turn, k + 1)
                ids = np.frombuffer(ids, np.int64)
                asking[part].meet(batch.column(4)[i].values.to_numpy(), counts, ids, np.frombuffer(v, kind).reshape(len(ids), -1),
                                  np.frombuffer(r, np.float32).reshape(len(ids), -1), list_block, query_block, epsilon)
        for a in asking.values():
            yield a.found()

    found = pairs.select("part", "class", "q", "looks", "lists", "counts", "id", "v", "r").mapInArrow(
        run, "class long, vec_id long, score double")
    with batch_limits(spark, 1):  # a row is a pack and a part
        found = saved(found, "nearest")
    return answers(found, members, k)
