"""Mixing sources to target weights by Poisson replication, with native expressions only.

A source of weight w should fill w * total of the output's ``total`` rows, so each of its n
rows is wanted lambda = w * total / n times on average.  Every row inverts the Poisson
distribution at a uniform number hashed from (seed, id, draw): its count is the number of
cumulative probabilities at or below that number.  The row is exploded by its count and all
copies are dealt out by a hash of (seed, id, copy): each task sorts what it got by that hash,
so the whole output is in an order independent of source and input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free, partitions

#: A rate above this is drawn as a sum of draws of at most this rate (their sum is Poisson too).
STEP = 8.0
#: Cumulative probabilities listed for one draw: beyond these, less than 2**-53 is left at STEP.
TERMS = 48
#: Sources up to this number are sent to all executors; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000
SALTS = 64


def uniform(seed: int, draw: Column, key: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash of (seed, draw, key)."""
    text = F.concat_ws(":", F.lit(str(seed)), draw.cast("string"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def cumulative(rate: Column) -> Column:
    """P(X <= k) for k = 0 .. TERMS - 1 of a Poisson variable of the given rate."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def add(s, k):
        p = s["p"] * rate / k.cast("double")
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.array_append(s["all"], s["c"] + p).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, add, lambda s: s["all"])


def rates(docs: DataFrame, weights: dict[str, float] | None, total: int | None, source_col: str) -> DataFrame:
    """One row per source: rows, rate, number of full draws, their table and the last draw's table."""
    sizes = docs.groupBy(F.col(source_col).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is None:
        share = F.lit(1.0) / sizes.agg(F.count(F.lit(1))).scalar().cast("double")
    else:
        weight = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        share = F.coalesce(F.element_at(weight, F.col("_s")), F.lit(0.0)) / F.lit(float(sum(weights.values())))
    wanted = sizes.agg(F.sum("_n")).scalar() if total is None else F.lit(total)
    found = sizes.withColumn("_rate", share * wanted.cast("double") / F.col("_n").cast("double"))
    found = found.withColumn("_full", F.floor(F.col("_rate") / STEP).cast("int"))
    return found.select("_s", "_rate", "_full", cumulative(F.lit(STEP)).alias("_cdf"),
                        cumulative(F.col("_rate") - F.col("_full") * F.lit(STEP)).alias("_rest"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = 17,
        source_col: str = "source", id_col: str = "doc_id", copy_col: str = "copy") -> DataFrame:
    """Rows of ``docs`` repeated by hashed Poisson counts, with ``copy`` numbered from 1, shuffled.

    ``weights`` gives each source's share (scaled to sum to 1; an absent source gets none; None:
    all sources alike) of ``total`` output rows (None: as many as the input has).  A null source
    is a source of its own for equal shares.  Rows with one id (nulls too) draw the same count.
    An empty table gives an empty table; texts aren't looked at.  Where there is a column ``copy``
    already, the new one is ``copy_``.
    """
    spark = docs.sparkSession
    table = rates(docs, weights, total, source_col)
    few = table.count() <= BROADCAST_SOURCES
    # the row in one column, so that no column of the table meets one of these names
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[source_col].alias("_source"), docs[id_col].alias("_id"))
    # rows without an id are told apart by what they hold (maps can't be hashed)
    own = [F.col("_row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = rows.withColumn("_own", F.when(F.col("_id").isNull(), F.xxhash64(*own) if own else F.lit(0)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id", "_own"), F.lit(1 if few else SALTS)))
    if few:
        table = F.broadcast(table.withColumn("_z", F.lit(0)))
    else:  # a hot source is spread over the salts, each with a copy of its one row of the table
        table = table.withColumn("_z", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(table, salted["_source"].eqNullSafe(table["_s"]) & (salted["_salt"] == table["_z"]))
    key = F.col("_id")

    def drawn(cdf, draw):
        u = uniform(seed, draw, key)
        return F.size(F.filter(cdf, lambda c: c <= u))

    full = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("_full"), F.lit(1))), F.lit(0),
                       lambda n, k: n + drawn(F.col("_cdf"), k))
    count = drawn(F.col("_rest"), F.lit(0)) + F.when(F.col("_full") > 0, full).otherwise(0)
    counted = joined.withColumn("_count", count).where("_count > 0")
    copies = counted.select("_row", "_id", "_own", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("_copy"))
    order = F.xxhash64(F.lit(seed), key, F.col("_own"), F.col("_copy"))
    dealt = copies.withColumn("_order", order).repartition(partitions(spark), "_order")
    return dealt.sortWithinPartitions("_order").select("_row.*", F.col("_copy").alias(free(copy_col, docs.columns)))


#: DuckDB: the same draws with equal shares and as many rows as the input.
def sql(seed: int = 17, table: str = "documents") -> str:
    return f"""
WITH n AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
t AS (SELECT count(*) AS sources, sum(n) AS total FROM n),
r AS (SELECT source, (1.0::DOUBLE / sources::DOUBLE) * total::DOUBLE / n::DOUBLE AS rate FROM n, t),
f AS (SELECT source, rate, floor(rate / {STEP}::DOUBLE)::INT AS whole,
             rate - floor(rate / {STEP}::DOUBLE)::INT * {STEP}::DOUBLE AS rest FROM r),
k AS (SELECT unnest(generate_series(0, {TERMS - 1})) AS k),
c AS (SELECT source, whole, list(p ORDER BY k) AS one, list(q ORDER BY k) AS last FROM (
        SELECT source, whole, k, sum(exp(-{STEP}::DOUBLE + k * ln({STEP}::DOUBLE) - lgamma(k + 1))) OVER w AS p,
               CASE WHEN rest > 0 THEN sum(exp(-rest + k * ln(rest) - lgamma(k + 1))) OVER w ELSE 1.0 END AS q
        FROM f, k
        WINDOW w AS (PARTITION BY source ORDER BY k)) GROUP BY source, whole),
d AS (SELECT d.*, unnest(generate_series(0, c.whole)) AS draw, c.one, c.last
      FROM {table} d JOIN c ON d.source IS NOT DISTINCT FROM c.source),
u AS (SELECT *, ('0x' || substr(md5('{seed}:' || draw || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
             / {float(1 << 52)}::DOUBLE AS u FROM d),
g AS (SELECT doc_id, text, lang, source, n_chars,
             sum(len(list_filter(CASE WHEN draw = 0 THEN last ELSE one END, lambda x: x <= u))) AS times
      FROM u GROUP BY doc_id, text, lang, source, n_chars)
SELECT doc_id, text, lang, source, n_chars, unnest(generate_series(1, times::INT)) AS copy FROM g WHERE times > 0
"""
