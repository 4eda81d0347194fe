"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where x_i says that the text
holds term i.  The pairwise part learns what no single term shows, such as an insult beside
the mention of a group.  Terms are words (runs of letters, ASCII lower case) and word stems of
4 and 6 bytes, hashed to 2**20 slots; every word of a text counts, at any length.

Fitting takes a bounded sample of the labelled training rows (``sample`` rows, in the order of
a hash of the id) and keeps the ``kept_terms`` terms that tell the classes apart best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import spans
from tidemark.llm.common import batch_limits, free, saved
from tidemark.llm.words import utf8_buffers, word_hashes

SLOT_BITS = 20
STEMS = (4, 6)
FACTORS = 8
_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[65:91] = _NOT_LETTER[97:123] = _NOT_LETTER[128:] = False


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of the distinct terms of each text, sorted."""
    offsets, data = utf8_buffers(texts)
    first, *hashes = word_hashes(offsets, data, _NOT_LETTER, STEMS)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    keys = [doc << SLOT_BITS | ((h + np.uint64(k)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            for k, h in enumerate(hashes)]
    keys = np.unique(np.concatenate(keys))
    return keys >> SLOT_BITS, keys & ((1 << SLOT_BITS) - 1)


def _pieces(batch: pa.RecordBatch, column: int):
    """(first row, texts) slices of a batch of a few MB each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for a, b in spans(sizes, 2 << 20):
        yield a, batch.column(column).slice(a, b - a)


class Machine:
    """A fitted factorization machine: kept slots, their weights and factors."""

    def __init__(self, slots: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.slots, self.bias, self.weights, self.factors = slots, bias, weights, factors

    def scores(self, doc: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """Probability of label 1 for each of ``n`` texts from its distinct terms."""
        place = np.full(1 << SLOT_BITS, -1, np.int32)
        place[self.slots] = np.arange(len(self.slots))
        at = place[slot]
        doc, at = doc[at >= 0], at[at >= 0]
        return self._sigmoid(doc, at, n)

    def _sigmoid(self, doc: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        z = self.bias + np.bincount(doc, self.weights[at], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            z += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_machine(docs: list[np.ndarray], labels: np.ndarray, slots: np.ndarray, epochs: int = 30, rate: float = 0.1,
                decay: float = 1e-4, seed: int = 5) -> Machine:
    """Adagrad on the logistic loss; ``docs`` hold positions in ``slots``."""
    rng = np.random.RandomState(seed)
    n, k = len(docs), len(slots)
    prior = (labels.sum() + 0.5) / (n + 1.0)
    m = Machine(slots, float(np.log(prior / (1 - prior))), np.zeros(k), rng.normal(0, 0.01, (k, FACTORS)))
    gw, gv, gb = np.full(k, 1e-6), np.full((k, FACTORS), 1e-6), 1e-6
    for _ in range(epochs if n else 0):
        for part in np.array_split(rng.permutation(n), max(1, n // 64)):
            at = np.concatenate([docs[i] for i in part]) if len(part) else np.zeros(0, int)
            doc = np.repeat(np.arange(len(part)), [len(docs[i]) for i in part])
            err = (m._sigmoid(doc, at, len(part)) - labels[part]) / len(part)
            sums = np.stack([np.bincount(doc, m.factors[at, f], len(part)) for f in range(FACTORS)], 1)
            e = err[doc]
            dw = np.bincount(at, e, k) + decay * m.weights
            dv = np.stack([np.bincount(at, e * (sums[doc, f] - m.factors[at, f]), k) for f in range(FACTORS)], 1)
            dv = dv + decay * m.factors
            gw += dw * dw
            gv += dv * dv
            gb += err.sum() ** 2
            m.weights -= rate * dw / np.sqrt(gw)
            m.factors -= rate * dv / np.sqrt(gv)
            m.bias -= rate * float(err.sum()) / np.sqrt(gb)
    return m


def fit(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", sample: int = 20_000,
        kept_terms: int = 4096, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> Machine:
    """Fit on at most ``sample`` labelled rows for which ``train`` (on ``labels``) holds.

    Null ids or labels are left out; a label given twice counts twice; no labelled row at all
    gives a machine that scores one half everywhere.
    """
    spark = docs.sparkSession
    known = labels.where(train & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = (known.select(F.col(id_col).alias("_k"), (F.col(label_col) > 0).cast("int").alias("y"))
              .orderBy(F.xxhash64(F.lit(seed), "_k"), "_k", "y").limit(sample))

    def extract(batches):
        for batch in batches:
            ys = batch.column(0).to_pylist()
            for start, texts in _pieces(batch, 1):
                doc, slot = terms(texts)
                ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ys[start:start + len(texts)], pa.int32()),
                    pa.array([slot[a:b].astype(np.int32) for a, b in zip(ends, ends[1:])], pa.list_(pa.int32()))],
                    names=["y", "slots"])

    # the sample is bounded by its parameter, so it is the side to send to all executors
    text = docs.select(docs[id_col].alias("k"), docs[text_col].cast("string").alias("t"))
    held = text.join(F.broadcast(chosen), F.col("k") == F.col("_k")).select("y", "t")
    with batch_limits(spark):
        rows = saved(held.mapInArrow(extract, "y int, slots array<int>"), "toxicity_terms")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).first()
    pos, neg = float(size.p), float(size.n - size.p)
    if not size.n:
        return Machine(np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    # log-odds of each term and its standard error, from counts of texts
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (pos + 1.0 - F.col("a")) / (b / (neg + 1.0 - F.col("b"))))
    z = F.abs(odds) / F.sqrt(1.0 / a + 1.0 / b)
    best = (rows.select("y", F.explode("slots").alias("slot")).groupBy("slot")
            .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where(F.col("a") + F.col("b") >= 3)
            .withColumn("z", z).where("z >= 3").orderBy(F.desc("z"), "slot").limit(kept_terms))
    slots = np.array(sorted(r.slot for r in best.collect()), np.int64)

    def train_one(batches):
        found, ys = [], []
        for batch in batches:
            ys += batch.column(0).to_pylist()
            for s in batch.column(1):
                s = s.values.to_numpy(zero_copy_only=False)
                found.append(np.flatnonzero(np.isin(slots, s)) if len(slots) else np.zeros(0, int))
        order = sorted(range(len(ys)), key=lambda i: (found[i].tobytes(), ys[i]))
        m = fit_machine([found[i] for i in order], np.array(ys, float)[order], slots, seed=seed)
        yield pa.RecordBatch.from_arrays([pa.array([m.bias]), pa.array([m.weights.tobytes()], pa.binary()),
                                          pa.array([m.factors.tobytes()], pa.binary())], names=["b", "w", "v"])

    # the sample's kept terms fit one task whatever the size of the corpus
    wanted = rows.select("y", F.array_intersect("slots", F.lit(slots.tolist()).cast("array<int>")).alias("slots"))
    r = wanted.coalesce(1).mapInArrow(train_one, "b double, w binary, v binary").first()
    return Machine(slots, r.b, np.frombuffer(r.w), np.frombuffer(r.v).reshape(-1, FACTORS))


def score(docs: DataFrame, machine: Machine, columns: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``columns`` (None: all) of every row of ``docs`` with its ``score``.

    A null text scores as an empty one, by the bias alone.  Rows are independent, so repeated rows
    score alike.  Where there is a column ``score`` already, the new one is ``score_``.
    """
    names = docs.columns if columns is None else columns
    inner = [f"c{i}" for i in range(len(names))]
    rows = docs.select(*[docs[c].alias(i) for c, i in zip(names, inner)], docs[text_col].cast("string").alias("t"))

    def run(batches):
        for batch in batches:
            found = [machine.scores(*terms(texts), len(texts)) for _, texts in _pieces(batch, batch.num_columns - 1)]
            column = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*inner, "s"])

    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    with batch_limits(docs.sparkSession):
        return saved(rows.mapInArrow(run, f"{fields}s double"), "toxicity_scores").toDF(*names, free("score", names))
