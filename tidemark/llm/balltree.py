"""Exact inner-product top-k: ball-tree branch and bound in shards that share the k-th scores.

Vectors are dealt to shards of about ``shard_rows`` by a hash of the id; each shard becomes one
ball tree.  A query block walks a tree from the root: the inner product with anything in a ball of
centre c and radius r is at most q.c + |q| r, children are entered in the order of that bound, and
only by the queries whose bound still reaches their k-th score.

The k-th scores are shared twice: a task walks the shards of its lane one after the other with one
list of best rows, and the k-th scores of a first wave over a few shards go with the queries to all
the others.
"""

from __future__ import annotations

import math
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_limits, partitions, saved
from tidemark.llm.vectors import FEW, Top, answers, best, blocks, candidates, query_classes, valid

LEAF = 64


def build(matrix: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of rows, nodes of (from, to, left, right), centres, radii); left is -1 at a leaf."""
    order = np.arange(len(matrix))
    nodes, centres, radii = [], [], []

    def node(a: int, b: int) -> int:
        at = len(nodes)
        x = matrix[order[a:b]]
        c = x.mean(axis=0)
        d = np.sqrt(((x - c) ** 2).sum(axis=1))
        nodes.append([a, b, -1, -1])
        centres.append(c)
        radii.append(d.max())
        return at

    todo = [node(0, len(matrix))] if len(matrix) else []
    while todo:
        at = todo.pop()
        a, b = nodes[at][:2]
        if b - a <= leaf or radii[at] == 0:
            continue
        x = matrix[order[a:b]]
        one = x[((x - centres[at]) ** 2).sum(axis=1).argmax()]
        two = x[((x - one) ** 2).sum(axis=1).argmax()]
        side = np.argsort(x @ (two - one), kind="stable")
        order[a:b] = order[a:b][side]
        m = (a + b) // 2
        nodes[at][2:] = [node(a, m), node(m, b)]
        todo += nodes[at][2:]
    return (order, np.array(nodes, np.int64).reshape(-1, 4), np.array(centres).reshape(len(nodes), matrix.shape[1]),
            np.array(radii))


#: Scores beyond these saturate, and rank as what they saturate to.
HIGH = np.iinfo(np.int64).max
LOW = -HIGH


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of int64 vectors; through doubles only where these are exact,
    as Python's integers where a sum could leave int64 (then between LOW and HIGH)."""
    most = _largest(q) * _largest(x) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    exact = [[sum(map(operator.mul, u, v)) for v in x.tolist()] for u in q.tolist()]
    return np.array([[min(max(s, LOW), HIGH) for s in line] for line in exact], np.int64).reshape(len(q), len(x))


def walk(q: np.ndarray, top: Top, tree: tuple, matrix: np.ndarray, ids: np.ndarray) -> int:
    """Search one tree for a block of queries; returns the leaf rows that were scored.

    Bounds are doubles with a margin for their rounding; scores stay integers."""
    nodes, centres, radii = tree
    if not len(nodes):
        return 0
    qf = q.astype(float)
    norm = np.sqrt((qf ** 2).sum(axis=1))
    scored = 0

    def bound(at: int, rows: np.ndarray) -> np.ndarray:
        b = qf[rows] @ centres[at] + norm[rows] * radii[at]
        return b + 1e-9 * (np.abs(b) + norm[rows] * (radii[at] + np.abs(centres[at]).sum()) + 1)

    every = np.arange(len(q))
    stack = [(0, every, bound(0, every))]
    while stack:
        at, rows, limit = stack.pop()
        least = top.least()[rows]
        # a score that saturates at the low end is no bound of what is below
        alive = (limit >= least) | (least <= float(LOW))
        rows = rows[alive]
        if not len(rows):
            continue
        a, b, left, right = nodes[at]
        if left < 0:
            s = products(q[rows], matrix[a:b])
            top.add(rows, s, np.broadcast_to(ids[a:b], s.shape))
            scored += s.size
            continue
        two = sorted(((c, bound(c, rows)) for c in (left, right)), key=lambda x: x[1].mean())
        stack += [(c, rows, limit) for c, limit in two]  # the higher bound is on top
    return scored


def _trees(rows: DataFrame, dims: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                matrix = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64).reshape(len(ids), dims)
                order, nodes, centres, radii = build(matrix.astype(float))
                parts = [ids[order], matrix[order], nodes, centres, radii]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                                                 names=["shard", "ids", "x", "nodes", "centres", "radii"])

    return rows.mapInArrow(run, "shard long, ids binary, x binary, nodes binary, centres binary, radii binary")


def _search(trees: DataFrame, asked: DataFrame, k: int, n_blocks: int, dims: int) -> DataFrame:
    """(class, vec_id, score): the best k + 1 of every query within each lane of shards."""
    spark = trees.sparkSession
    p = partitions(spark)
    lanes = max(1, p // n_blocks)

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # every query block meets every shard: the stated query set against all rows, in blocks; a key of
    # the join is a block and a lane, so that no task gets all shards
    dealt = trees.withColumn("lane", F.col("shard") % lanes).withColumn("block", each(n_blocks))
    pairs = dealt.join(asked.withColumn("lane", each(lanes)), ["block", "lane"])
    pairs = pairs.repartition(p, "block", "lane").sortWithinPartitions("block", "lane", "shard")

    def rows(batches):
        for batch in batches:
            yield from batch.to_pylist()

    def run(batches):
        current, top, classes, q = None, None, None, None

        def out():
            hit = top.found()
            who = np.broadcast_to(classes[:, None], hit.shape)[hit]
            return pa.RecordBatch.from_arrays([pa.array(who), pa.array(top.id[hit]), pa.array(top.score[hit])],
                                              names=["class", "vec_id", "score"])

        for r in rows(batches):
            key = (r["block"], r["lane"])
            if key != current:
                if current is not None:
                    yield out()
                current = key
                classes = np.frombuffer(r["class"], np.int64)
                q = np.frombuffer(r["v"], np.int64).reshape(len(classes), dims)
                top = Top(len(classes), k + 1, np.frombuffer(r["least"]), np.int64)
            nodes = np.frombuffer(r["nodes"], np.int64).reshape(-1, 4)
            tree = nodes, np.frombuffer(r["centres"]).reshape(len(nodes), dims), np.frombuffer(r["radii"])
            ids = np.frombuffer(r["ids"], np.int64)
            walk(q, top, tree, np.frombuffer(r["x"], np.int64).reshape(len(ids), dims), ids)
        if current is not None:
            yield out()

    found = pairs.select("block", "lane", "class", "v", "least", "ids", "x", "nodes", "centres", "radii").mapInArrow(
        run, "class long, vec_id long, score long")
    with batch_limits(spark, FEW):
        return saved(found, "found")


def search(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256, shard_rows: int = 4096,
           block_rows: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query.

    Components become floor(scale * x).  Queries are the rows whose id is divisible by ``every``,
    candidates all rows but the query's own; ties go to the smaller id.  No valid vector, or no
    query, gives an empty table; fewer than k candidates are all returned.  Scores are exact; a
    component beyond int64 saturates, and so does a score, which then ranks as that.
    """
    value = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    rows = valid(embeddings, value, id_col, vec_col)
    cand = candidates(rows, k)
    asked, members = query_classes(rows, every)
    n, nq = cand.count(), asked.count()
    first = cand.select(F.size("v").alias("n")).first()
    dims = first.n if first else 1
    shards, n_blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(nq / block_rows))

    def bucket(col, count):
        return F.pmod(F.xxhash64(F.lit(3), col), F.lit(count)).cast("long")

    dealt = blocks(cand.withColumn("shard", bucket("id", shards)), ["shard"], {"id": "int64", "v": "int64"})
    with batch_limits(cand.sparkSession, FEW):
        trees = saved(_trees(dealt.select("shard", "id", "v"), dims), "trees")

    def ask(bounds: DataFrame | None) -> DataFrame:
        q = asked.withColumn("block", bucket("class", n_blocks))
        q = q.withColumn("least", F.lit(float("-inf"))) if bounds is None else q.join(bounds, "class", "left").fillna(
            float("-inf"), ["least"])
        return blocks(q, ["block"], {"class": "int64", "v": "int64", "least": "float64"}).drop("rows")

    early = math.isqrt(shards - 1) + 1 if shards > 1 else 1
    wave = saved(best(_search(trees.where(F.col("shard") < early), ask(None), k, n_blocks, dims), k + 1, "class"), "first_wave")
    bounds = wave.where(F.col("rank") == k + 1).select("class", F.col("score").cast("double").alias("least"))
    found = wave.drop("rank")
    if early < shards:
        found = found.unionByName(_search(trees.where(F.col("shard") >= early), ask(bounds), k, n_blocks, dims))
    return answers(found, members, k).select("query_id", "rank", "vec_id", "score")
