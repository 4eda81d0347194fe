"""What the two vector searches share: valid rows, equal vectors, query blocks, final ranks.

Rows without an id, and vectors that are null, hold nulls or non-finite values, or have another
length than most, take no part.  Repeated rows (one id, one vector) are one row.

Equal vectors score alike for every query, so of any group of copies only the k + 1 of smallest
id can be among a query's k nearest others; the rest never enter the search.  Queries with equal
vectors are searched once for k + 1 rows; each then leaves out itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

SALTS = 16
#: Hashes of a broadcast table.
SHARED = 100_000


def valid(df: DataFrame, value: Column, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): the rows that take part, v being ``value`` of each component."""
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where((F.size("v") > 0) & good)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    size = lengths.first()
    return rows.where(F.size("v") == (size.n if size else 0)).select("id", value.alias("v"))


def _least_ids(rows: DataFrame, keep: int) -> DataFrame:
    """Of each group of equal vectors the ``keep`` smallest ids, a salt at a time first."""
    rows = rows.dropDuplicates(["id", "v"]).withColumn("h", F.xxhash64("v"))
    for key in (["h", "v", F.pmod(F.xxhash64("id"), F.lit(SALTS))], ["h", "v"]):
        w = Window.partitionBy(*key).orderBy("id")
        rows = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep).drop("_r")
    return rows.select("id", "v")


def candidates(rows: DataFrame, k: int) -> DataFrame:
    return saved(_least_ids(rows, k + 1), "vectors")


def few_copies(rows: DataFrame, k: int) -> tuple[DataFrame, int]:
    """The rows of ``candidates``, and how many they are; vectors whose hash is theirs alone are neither
    sent nor written, as they have no copies."""
    groups = rows.groupBy(F.xxhash64("v").alias("h")).count()
    n, shared = groups.agg(F.sum("count"), F.count_if(F.col("count") > 1)).first()
    if not shared:
        return rows, n or 0
    if shared > SHARED:
        cand = candidates(rows, k)
    else:
        doubtful = F.broadcast(saved(groups.where(F.col("count") > 1).select("h"), "copies"))
        marked = rows.withColumn("h", F.xxhash64("v"))
        alone, alike = (marked.join(doubtful, "h", how).select("id", "v") for how in ("left_anti", "left_semi"))
        cand = saved(alone.unionByName(_least_ids(alike, k + 1)), "vectors")
    return cand, cand.count()


def query_classes(rows: DataFrame, every: int) -> tuple[DataFrame, DataFrame]:
    """(class, v) of the distinct query vectors and (class, query_id) of their members."""
    asked = rows.where(F.pmod(F.col("id"), F.lit(every)) == 0).distinct()
    classes = saved(asked.groupBy("v").agg(F.min("id").alias("class")).withColumn("h", F.xxhash64("v")), "queries")
    members = asked.withColumn("h", F.xxhash64("v")).join(classes, ["h", "v"]).select("class", F.col("id").alias("query_id"))
    return classes.select("class", "v"), members


def best(found: DataFrame, k: int, key: str) -> DataFrame:
    """The ``k`` rows of highest score of each key, ties to the smaller id, with their rank."""
    w = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def answers(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score from the k + 1 best rows of each class of queries."""
    own = best(found, k + 1, "class").drop("rank").join(members, "class").where("vec_id <> query_id")
    return best(own, k, "query_id").select("query_id", "rank", "vec_id", "score")


def blocks(rows: DataFrame, group: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per group with each of ``columns`` (name: numpy type) as the bytes of one array.

    Groups are bounded by whoever forms them.
    """
    fields = ", ".join(f"{g} long" for g in group) + ", rows long, " + ", ".join(f"{c} binary" for c in columns)

    def run(key, table):
        table = table.combine_chunks()
        out = {g: pa.array([key[i].as_py()], pa.int64()) for i, g in enumerate(group)}
        out["rows"] = pa.array([table.num_rows], pa.int64())
        for c, kind in columns.items():
            values = table.column(c).combine_chunks()
            if isinstance(values, pa.ChunkedArray):
                values = pa.concat_arrays(values.chunks)
            if pa.types.is_list(values.type):
                values = values.flatten()
            out[c] = pa.array([values.to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary())
        return pa.table(out)

    return rows.select(*group, *columns).groupBy(*group).applyInArrow(run, fields)


#: Rows of a batch where each holds a whole block.
FEW = 4


class Top:
    """The best ``k`` (score, id) of each of some queries, kept while candidates stream by.

    Scores are doubles, or exact integers (``kind`` int64); ``none`` stands where there is no row.
    """

    def __init__(self, n: int, k: int, bound: np.ndarray | None = None, kind=np.float64):
        self.none = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        self.score = np.full((n, k), self.none, kind)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, -np.inf) if bound is None else bound.astype(float)

    def found(self) -> np.ndarray:
        return self.score > self.none

    def least(self) -> np.ndarray:
        """Scores below these can't be among the best any more."""
        return np.maximum(np.where(self.score[:, -1] > self.none, self.score[:, -1], -np.inf), self.floor)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of some rows: matrices with a line for each (``none``: no candidate)."""
        k = self.score.shape[1]
        s = np.concatenate([self.score[rows], score], axis=1)
        i = np.concatenate([self.id[rows], ids], axis=1)
        # of integers the complement sorts the other way round, without an overflow
        order = np.lexsort((i, ~s if s.dtype == np.int64 else -s), axis=1)[:, :k]
        self.score[rows] = np.take_along_axis(s, order, 1)
        self.id[rows] = np.take_along_axis(i, order, 1)
