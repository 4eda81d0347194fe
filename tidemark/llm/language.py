"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is case-folded code point by code point (by lower case where that is one code point), every
run of other characters than letters becomes one word edge, and all n-grams of 1 to 4 code points
inside a word with its edges are hashed into ``BUCKETS`` buckets.  Training counts buckets by
language over every training row, as a Spark aggregation; the matrix of log probabilities is
broadcast, and batches of texts are scored in numpy as sparse rows against it.

The matrix takes 4 * BUCKETS bytes a language.  Languages beyond ``matrix_bytes`` go into further
matrices, each broadcast for a pass of its own, so that no broadcast grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import grouped
from tidemark.llm.common import batch_limits, saved

BUCKETS = 1 << 16
#: Longest n-gram.
ORDER = 4
#: What every bucket of a language has before counting.
SMOOTHING = 0.5
UNKNOWN = "und"
#: Code points handled at a time.
PIECE = 1 << 17
#: Languages whose counts a task holds before it hands them on.
HELD = 64

_PLACE = np.random.RandomState(12).randint(0, 1 << 31, ORDER).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Of every code point its lower case, 0 if it is no letter; made once in each worker."""
    if not _fold:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _fold.append(table)
    return _fold[0]


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points of some texts, one after the other, with 0 for each word edge; where each
    text begins, and the end).  A text begins with the edge before its first letter and has no
    place if it has no letter."""
    joined = "\n" + "\n".join(texts) + "\n"
    code = fold_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
    keep = code != 0
    keep[1:] |= keep[:-1]
    keep[0] = True
    edge = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return code[keep], np.cumsum(keep)[edge] - 1


def grams(code: np.ndarray, a: int, b: int) -> list[np.ndarray]:
    """For each n the buckets of the n-grams that begin at the places from ``a`` to ``b``; BUCKETS
    where there is none.  No n-gram has a word edge inside, so none lies in two texts."""
    f = np.zeros(b - a + ORDER, np.uint32)
    part = code[a:b + ORDER]
    f[:len(part)] = part
    n = b - a
    letter = f != 0
    # beyond the end there is no n-gram
    inside = np.arange(a, b) < len(code)
    h = f[:n] * _PLACE[0]
    out = []
    for size in range(1, ORDER + 1):
        if size > 1:
            h = h + f[size - 1:size - 1 + n] * _PLACE[size - 1]
        if size > 2:
            inside = inside & letter[size - 2:size - 2 + n]
        ok = letter[:n] if size == 1 else inside & (letter[:n] | letter[1:n + 1])
        mixed = (h + np.uint32(size)) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        out.append(np.where(ok, (mixed * np.uint32(0x85EBCA77)) >> np.uint32(16), np.uint32(BUCKETS)))
    return out


def counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all (lang, text) rows, summed in each task first."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit), pa.array(n[hit])],
                                                 names=["lang", "bucket", "n"])
            held.clear()

        for langs, texts in grouped(batches, 1, 2 << 20):
            langs = langs.to_pylist()
            texts = texts.to_pylist()
            for lang in dict.fromkeys(langs):
                code, _ = letters([t for t, x in zip(texts, langs) if x == lang])
                if lang not in held:
                    if len(held) >= HELD:
                        yield from out()
                    held[lang] = np.zeros(BUCKETS, np.int64)
                for a in range(0, len(code), PIECE):
                    for bucket in grams(code, a, min(a + PIECE, len(code))):
                        held[lang] += np.bincount(bucket, minlength=BUCKETS + 1)[:BUCKETS]
        yield from out()

    found = rows.mapInArrow(run, "lang string, bucket long, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Matrices: (languages, log prior of each, log probability by bucket and language and a line of zeros)."""

    blocks: list[tuple[list[str], np.ndarray, np.ndarray]]


def fit(docs: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang",
        matrix_bytes: int = 64 << 20) -> Model:
    """Learn from all rows of ``where`` whose language is known; rows without any leave an empty model."""
    spark = docs.sparkSession
    rows = docs.where(where & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    prior = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(prior)
    with batch_limits(spark):
        found = saved(counts(rows), "language_counts")
    step = max(1, matrix_bytes // (4 * BUCKETS))
    total = sum(prior.values())
    blocks = []
    for a in range(0, len(langs), step):
        mine = langs[a:a + step]
        part = found.where(F.col("lang").isin(mine)).toArrow()  # at most BUCKETS rows a language
        place = {x: i for i, x in enumerate(mine)}
        n = np.full((BUCKETS, len(mine)), SMOOTHING)
        n[part["bucket"].to_numpy(), [place[x] for x in part["lang"].to_pylist()]] += part["n"].to_numpy()
        logs = np.vstack([np.log(n / n.sum(axis=0)), np.zeros(len(mine))]).astype(np.float32)
        blocks.append((mine, np.log(np.array([prior[x] for x in mine]) / total), logs))
    return Model(blocks)


def log_scores(code: np.ndarray, first: np.ndarray, prior: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Log of prior times likelihood: a line for each text, a column for each language.

    ``matrix`` has a last line of zeros for places without an n-gram."""
    out = np.tile(prior, (len(first) - 1, 1))
    piece = max(1024, PIECE // len(prior))
    for a in range(0, len(code), piece):
        b = min(a + piece, len(code))
        buckets = grams(code, a, b)
        s = matrix[buckets[0]]
        for more in buckets[1:]:
            s += matrix[more]
        # the texts that have a place here, each from its first place on
        edge = np.clip(first, a, b)
        here = np.flatnonzero(edge[1:] > edge[:-1])
        out[here] += np.add.reduceat(s, edge[here] - a, axis=0, dtype=float) if len(here) else 0
    return out


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns of ``keep``, ``lang_pred`` and ``score`` (the posterior of that language, 0 to 1).

    A text that is null or has no letter is ``und`` with score 0, as is every text under a model
    that has learned nothing.  Rows are independent: repeated rows and null ids stay; ties go to
    the language that sorts first; other columns are left out.
    """
    spark = docs.sparkSession
    inner = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[docs[c].alias(i) for c, i in zip(keep, inner)], docs[text_col].cast("string").alias("t"),
                       F.lit(UNKNOWN).alias("lang_pred"), F.lit(float("-inf")).alias("top"), F.lit(float("-inf")).alias("total"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    at = len(keep)
    for langs, prior, matrix in model.blocks:
        known = spark.sparkContext.broadcast((np.array(langs, object), prior, matrix))

        def run(batches, known=known):
            names, prior, matrix = known.value
            for columns in grouped(batches, at, 2 << 20):
                texts = columns[at].to_pylist()
                code, first = letters(texts)
                some = np.diff(first) > 0
                s = log_scores(code, first, prior, matrix)
                s[~some] = -np.inf
                best = s.argmax(axis=1)
                high = s[np.arange(len(s)), best]
                top, total = columns[at + 2].to_numpy(), columns[at + 3].to_numpy()
                lang = np.where(high > top, names[best], np.array(columns[at + 1].to_pylist(), object))
                inside = np.full(len(s), -np.inf)
                inside[some] = high[some] + np.log(np.exp(s[some] - high[some][:, None]).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*columns[:at + 1], pa.array(lang, pa.string()), pa.array(np.maximum(top, high)),
                     pa.array(np.logaddexp(total, inside))], names=[*inner, "t", "lang_pred", "top", "total"])

        rows = rows.mapInArrow(run, kinds)
    score = F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(F.least(F.lit(1.0), F.exp(F.col("top") - F.col("total"))))
    with batch_limits(spark):
        return saved(rows.select(*inner, "lang_pred", score.alias("score")), "languages").toDF(*keep, "lang_pred", "score")
