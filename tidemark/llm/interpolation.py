"""Language-model scoring by deleted interpolation of word bigrams, unigrams and a uniform.

    p(w | h) = l(h) c(h w) / c(h) + (1 - l(h)) p(w)      p(w) = m c(w) / N + (1 - m) / (V + 1)

l depends on the bucket of c(h) (powers of two).  m and every l are learned by expectation
maximisation on held-out counts: a fold of the training texts (crc32 remainder ``FOLD``) whose
own counts are taken out.  The end of a text is a token, and the context of its first word.

How it runs: texts are packed into blocks of token numbers.  Each block asks once for each of its
distinct words and bigrams, so a word that stands in every text makes one request a block; the
requests are dealt by key hash, summed over the corpus, and the counts go back to the blocks that
asked.  No table of counts is ever sent to all tasks.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import spans
from tidemark.llm.common import batch_limits, crc_of_id, partitions, saved
from tidemark.llm.vectors import FEW
from tidemark.llm.words import mix, utf8_buffers, word_hashes

_U = np.uint64
END = _U(0x0E0D0E0D0E0D0E0D)
MODULUS, HELD_OUT, FOLD = 7, 2, 3
TRAIN, TUNE, TEST = 0, 1, 2
#: Tokens of a block; what a task holds of one kind of text.
BLOCK_TOKENS = 1 << 21
#: Width of the bins, in natural logarithms, that the learning of the weights counts in.
BIN = 0.1
BUCKETS = 64


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


_BLOCK = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()),
                    ("sizes", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary())])


def _block(kind: int, ids: list, sizes: list[np.ndarray], words: list[np.ndarray]) -> pa.RecordBatch:
    every, number, count = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")  # frequent words get small numbers: they pack better
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    row = [uuid.uuid4().int >> 65, kind, len(ids), np.array([i or 0 for i in ids], np.int64).tobytes(),
           np.array([i is None for i in ids]).tobytes(), np.concatenate(sizes).astype(np.int64).tobytes(),
           every[order].tobytes(), _pack(place[number].astype(np.uint32))]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts as blocks of token numbers, each block of one kind (train, tune, test)."""
    rest = F.pmod(crc_of_id(id_col), F.lit(MODULUS))
    kind = F.when(rest == FOLD, TUNE).when(rest != HELD_OUT, TRAIN).otherwise(TEST).cast("int")

    def run(batches):
        held: dict[int, tuple[list, list, list]] = {k: ([], [], []) for k in (TRAIN, TUNE, TEST)}
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for a, b in spans(sizes, 4 << 20):
                offsets, data = utf8_buffers(batch.column(2).slice(a, b - a))
                first, words = word_hashes(offsets, data)
                ids, kinds = batch.column(0)[a:b].to_pylist(), batch.column(1)[a:b].to_numpy()
                for k, (own, size, seq) in held.items():
                    mine = np.flatnonzero(kinds == k)
                    own += [ids[i] for i in mine]
                    size.append(first[mine + 1] - first[mine] + 1)
                    seq += [x for i in mine for x in (words[first[i]:first[i + 1]], _END)]
                    if sum(int(s.sum()) for s in size) >= BLOCK_TOKENS:
                        yield _block(k, own, size, seq)
                        held[k] = ([], [], [])
        for k, (own, size, seq) in held.items():
            if own:
                yield _block(k, own, size, seq)

    rows = docs.select(docs[id_col].cast("long").alias("id"), kind.alias("kind"), docs[text_col].cast("string").alias("t"))
    schema = "block long, kind int, n long, ids binary, nulls binary, sizes binary, words binary, tokens binary"
    return rows.mapInArrow(run, schema)


_END = np.array([END])


def _bigrams(words: np.ndarray) -> np.ndarray:
    """Hash of (word before, word) of every token; before the first stands an end."""
    before = np.concatenate([_END, words[:-1]])
    return mix(before * _U(0x9E3779B97F4A7C15) + mix(words))


def _edges(parts: int) -> np.ndarray:
    """Least key of each part and of the end; the top 16 bits of a key give its part."""
    return np.array([-(-p * 65536 // parts) << 48 for p in range(1, parts)], np.uint64)


def _six(keys: np.ndarray) -> bytes:
    """The low 48 bits of keys of one part."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _requests(held: DataFrame, parts: int) -> DataFrame:
    """One row per block and part that it has anything of: the distinct words and bigrams of that part,
    with counts."""
    edges = _edges(parts)
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("uk", pa.binary()), ("uc", pa.binary()),
                        ("bk", pa.binary()), ("bc", pa.binary())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words = np.frombuffer(r["words"], np.uint64)
                tokens = _unpack(r["tokens"], np.uint32)
                order = np.argsort(words)
                uk, uc = words[order], np.bincount(tokens, minlength=len(words))[order].astype(np.uint32)
                bk, bc = np.unique(_bigrams(words[tokens]), return_counts=True)
                bc = bc.astype(np.uint32)
                u = np.concatenate([[0], np.searchsorted(uk, edges), [len(uk)]])
                b = np.concatenate([[0], np.searchsorted(bk, edges), [len(bk)]])
                rows = [(p, r["block"], r["kind"], uk[u[p]:u[p + 1]].tobytes(), uc[u[p]:u[p + 1]].tobytes(),
                         _six(bk[b[p]:b[p + 1]]), bc[b[p]:b[p + 1]].tobytes())
                        for p in np.flatnonzero((u[1:] > u[:-1]) | (b[1:] > b[:-1])).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return held.select("block", "kind", "words", "tokens").mapInArrow(
        run, "part long, block long, kind int, uk binary, uc binary, bk binary, bc binary")


def _sum_up(keys: list[np.ndarray], counts: list[np.ndarray], kinds: list[int]):
    """Per request list: corpus counts of its keys, and those of the tuning fold alone."""
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    sizes = [len(k) for k in keys]
    kind = np.repeat(kinds, sizes)
    count = np.concatenate(counts).astype(float)
    train = np.bincount(at, np.where(kind != TEST, count, 0.0), len(every))
    tune = np.bincount(at, np.where(kind == TUNE, count, 0.0), len(every))
    cut = np.cumsum(sizes)[:-1]
    return train, np.split(train[at].astype(np.uint64), cut), np.split(tune[at].astype(np.uint64), cut)


def _answers(requests: DataFrame) -> DataFrame:
    """The counts asked for, back by block; each part also gives its known words and tokens."""
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("known", pa.int64()), ("total", pa.int64()),
                        ("u", pa.binary()), ("b", pa.binary()), ("ut", pa.binary()), ("bt", pa.binary())])

    def run(table):
        rows = table.to_pylist()
        kinds = [r["kind"] for r in rows]
        train, u, ut = _sum_up([np.frombuffer(r["uk"], np.uint64) for r in rows], [np.frombuffer(r["uc"], np.uint32) for r in rows], kinds)
        _, b, bt = _sum_up([_from_six(r["bk"]) for r in rows], [np.frombuffer(r["bc"], np.uint32) for r in rows], kinds)
        out = []
        for i, r in enumerate(rows):
            tuned = r["kind"] == TUNE
            out.append((r["part"], r["block"], int((train > 0).sum()) if i == 0 else 0, int(train.sum()) if i == 0 else 0,
                        _pack(u[i]), _pack(b[i]), _pack(ut[i]) if tuned else None, _pack(bt[i]) if tuned else None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return requests.groupBy("part").applyInArrow(
        run, "part long, block long, known long, total long, u binary, b binary, ut binary, bt binary")


def _with_counts(held: DataFrame, answers: DataFrame, use, schema: str) -> DataFrame:
    """``use(block row, words of its tokens' counts ...)`` for every block joined with its answers."""
    def run(left, right):
        out = []
        for r in left.to_pylist():
            got = sorted(right.to_pylist(), key=lambda x: x["part"])
            words = np.frombuffer(r["words"], np.uint64)
            tokens = _unpack(r["tokens"], np.uint32)
            place = np.empty(len(words), np.int64)
            place[np.argsort(words)] = np.arange(len(words))
            _, pair = np.unique(_bigrams(words[tokens]), return_inverse=True)
            end = int(np.flatnonzero(words == END)[0])
            before = np.concatenate([[end], tokens[:-1]])

            def counts(u: str, b: str):
                if got and got[0][u] is None:
                    return None
                one = np.concatenate([_unpack(x[u], np.uint64) for x in got]).astype(float)[place]
                two = np.concatenate([_unpack(x[b], np.uint64) for x in got]).astype(float)
                return one[tokens], one[before], two[pair]

            out.append(use(r, counts("u", "b"), counts("ut", "bt")))
        return pa.concat_tables(out)

    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def bucket(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.where(c > 0, np.frexp(np.maximum(c, 1))[1], 0).astype(np.int64)


def _log_bin(x: np.ndarray) -> np.ndarray:
    """Bin of a positive number; a very small number for 0."""
    return np.where(x > 0, np.round(np.log(np.maximum(x, 1e-300)) / BIN), -10_000).astype(np.int64)


def learn(events: list[tuple[int, int, int, float]], total: float, known: float, rounds: int = 60) -> tuple[float, np.ndarray]:
    """(m, l by bucket) from counted events (bucket, bin of c(hw)/c(h), bin of c(w), how many)."""
    weight = np.full(BUCKETS, 0.5)
    weight[0] = 0.0
    if not events or not total:
        return (0.5 if total else 0.0), weight
    b, two, one, n = (np.array(x) for x in zip(*events))
    back = lambda x: np.where(x > -10_000, np.exp(x * BIN), 0.0)
    f2, f1, f0 = back(two), np.minimum(back(one) / total, 1.0), 1.0 / (known + 1.0)
    m = 0.5
    for _ in range(rounds):
        m = float((n * (m * f1 / (m * f1 + (1 - m) * f0))).sum() + 1) / float(n.sum() + 2)
    p1 = m * f1 + (1 - m) * f0
    for _ in range(rounds):
        l = weight[b]
        share = np.bincount(b, n * (l * f2 / (l * f2 + (1 - l) * p1)), BUCKETS)
        weight = (share + 1.0) / (np.bincount(b, n, BUCKETS) + 2.0)
        weight[0] = 0.0
    return m, weight


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Texts whose crc32 of the id leaves 2 on division by 7 are held out; nothing is learned from
    them, nor from texts without an id (held_out null).  A null text is an empty one: it consists
    of its end.  Repeated rows are scored, and learned from, each time.  With no training text
    every probability is that of the uniform part.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    with batch_limits(spark):
        held = saved(blocks(docs, id_col, text_col), "lm_blocks")
    parts = min(32768, 2 * partitions(spark))
    with batch_limits(spark, FEW):
        answers = saved(_answers(_requests(held, parts)), "lm_answers")
    sums = answers.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("v"), F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()
    known, total = float(sums.v), float(sums.n)

    def count_events(r, train, tune):
        word, context, pair = (a - b for a, b in zip(train, tune))
        keys = np.stack([bucket(context), _log_bin(np.divide(pair, context, out=np.zeros_like(pair), where=context > 0)), _log_bin(word)])
        kinds, n = np.unique(keys, axis=1, return_counts=True)
        return pa.table({"bucket": kinds[0], "two": kinds[1], "one": kinds[2], "n": n})

    tune = _with_counts(held.where(F.col("kind") == TUNE), answers.where(F.col("ut").isNotNull()), count_events,
                        "bucket long, two long, one long, n long")
    # a grid of bins: its size doesn't grow with the corpus
    with batch_limits(spark, FEW):
        events = [tuple(r) for r in tune.groupBy("bucket", "two", "one").agg(F.sum("n").cast("double")).collect()]
    fold = sum(e[3] for e in events)
    m, weight = learn(events, max(total - fold, 0.0), known)

    def use(r, train, _):
        word, context, pair = train
        p1 = m * (word / total if total else word) + (1 - m) / (known + 1.0)
        l = weight[bucket(context)]
        p = l * np.divide(pair, context, out=np.zeros_like(pair), where=context > 0) + (1 - l) * p1
        sizes = np.frombuffer(r["sizes"], np.int64)
        at = np.cumsum(sizes) - sizes
        ids = pa.array(np.frombuffer(r["ids"], np.int64), mask=np.frombuffer(r["nulls"], bool))
        return pa.table({
            "id": ids, "n_tokens": sizes, "n_known": np.add.reduceat((word > 0).astype(np.int64), at),
            "base_score": np.add.reduceat(np.log10((word + 1.0) / (total + known + 1.0)), at),
            "score": np.add.reduceat(np.log10(p), at)})

    found = _with_counts(held, answers.drop("ut", "bt").withColumns({"ut": F.lit(None).cast("binary"), "bt": F.lit(None).cast("binary")}),
                         use, "id long, n_tokens long, n_known long, base_score double, score double")
    with batch_limits(spark, FEW):
        found = saved(found, "lm_scores")
    out = F.pmod(crc_of_id("id"), F.lit(MODULUS)) == HELD_OUT
    return found.select(F.col("id").alias(id_col), out.alias("held_out"), "n_tokens", "n_known",
                        F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
