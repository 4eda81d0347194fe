"""Spelling variants: words at one edit from a far more frequent word, found with FM-indexes.

The vocabulary is counted over all texts.  Two words of n and n' code points that differ by one
inserted, deleted or replaced code point agree on the first half of either or on its second half.
So a search takes two schemes: match the second half exactly, then extend over the first one with
one error; and the same from the other end.  A scheme reads a word backward in an FM-index over a
delimited vocabulary (``$word$word$``), an interval of suffix ranks at each step; the other
direction is the same search in the index of the reversed words.

A word is indexed under each half that a word of its length, one less or one more can have, and
asks under its own halves; the keys are dealt to buckets by a hash.  A bucket of more than
``index_words`` words is cut into several indexes, and all that ask in the bucket look into each.
Askers stream by, so that a task holds one index and one batch of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_limits, partitions, saved

#: Least number of code points of a word.
LEAST = 7
#: Least number of occurrences of a word.
OCCURRENCES = 2
#: A form has at least that many times the occurrences of its variant.
RATIO = 10
RUN = f"[A-Za-z\\u00C0-\\u00FF]{{{LEAST},}}"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (word, index symbol) states extended at a time.
STATES = 1 << 19


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31) -> DataFrame:
    """(word, n): words of at least LEAST code points and OCCURRENCES occurrences.

    A run whose hash with its document's id is divisible by ``every`` loses a code point, and counts
    as what is left.  Runs shorter than LEAST can't become words.  A null id counts as an empty one.
    """
    run = F.explode(F.regexp_extract_all(F.col("t"), F.lit(RUN), F.lit(0))).alias("w")
    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("d"), docs[text_col].cast("string").alias("t"))
    rows = rows.select("d", run).select("d", F.translate("w", _UPPER, _UPPER.lower()).alias("w"))
    h = F.crc32(F.concat("d", F.lit(":"), "w").cast("binary"))
    at = (F.pmod(F.col("h"), F.length("w").cast("long"))).cast("int")
    less = F.concat(F.col("w").substr(F.lit(1), at), F.col("w").substr(at + 2, F.length("w")))
    words = rows.withColumn("h", h).select(F.when(F.col("h") % every == 0, less).otherwise(F.col("w")).alias("word"))
    counted = words.where(F.length("word") >= LEAST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


class Index:
    """FM-index of distinct words, each between two delimiters, for backward search."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words]
        self.symbols = np.unique(np.concatenate(points)).astype(np.int64)
        lengths = np.array([len(p) for p in points], np.int64)
        n = int(lengths.sum()) + len(words) + 1
        text = np.zeros(n, np.int64)
        # the delimiter before word i, and one at the end
        edge = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = np.ones(n, bool)
        inside[edge] = False
        text[inside] = np.searchsorted(self.symbols, np.concatenate(points)) + 1
        order = _suffix_order(text, edge, int(lengths.max()) + 1)
        before = text[order - 1]
        self.length = n
        rows = np.argsort(before, kind="stable")
        # rank of a symbol before a row, plus the number of smaller symbols: one binary search
        self.keys = before[rows] * n + rows
        self.starts = np.flatnonzero(before == 0)
        where = np.empty(n, np.int64)
        where[edge] = np.arange(len(edge))
        # the word that begins after the delimiter before a row's suffix
        self.words = where[order[self.starts] - 1]

    def encode(self, words: list[str], length: int) -> np.ndarray:
        """Symbols of words of one length, -1 for one that the index doesn't have."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length).astype(np.int64)
        at = np.minimum(np.searchsorted(self.symbols, points), len(self.symbols) - 1)
        return np.where(self.symbols[at] == points, at + 1, -1)

    def extend(self, symbol, low, high):
        """Suffix ranks after one more symbol on the left; an unknown symbol gives an empty interval."""
        base = np.maximum(symbol, 0) * self.length
        low, high = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        return low, np.where(symbol > 0, high, low)

    def found(self, low, high) -> tuple[np.ndarray, np.ndarray]:
        """(state, word): the words that are whole where their delimiter comes next."""
        a, b = np.searchsorted(self.starts, low), np.searchsorted(self.starts, high)
        state = np.repeat(np.arange(len(low)), b - a)
        at = np.arange(len(state)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
        return state, self.words[at]

    def near(self, words: list[str], exact: int) -> tuple[np.ndarray, np.ndarray]:
        """(asker, word): words at one edit from ``words`` (all of one length), the edit lying before
        their last ``exact`` code points.  A pair may come more than once, a word never with itself."""
        length = len(words[0])
        q = self.encode(words, length)
        who = np.arange(len(words))
        # suffixes that begin with a delimiter come first
        low, high = np.zeros(len(q), np.int64), np.full(len(q), self.size + 1, np.int64)
        for j in range(length - 1, length - exact - 1, -1):
            low, high = self.extend(q[who, j], low, high)
            who, low, high = _alive(who, low, high)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        step = max(1, STATES // (len(self.symbols) + 1))
        for a in range(0, len(who), step):
            out += self._one_error(q, length - exact, who[a:a + step], low[a:a + step], high[a:a + step])
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])

    def _one_error(self, q, rest, who, low, high):
        """Extend over the first ``rest`` code points, allowing one error."""
        alphabet = np.arange(1, len(self.symbols) + 1)
        wrong = [np.zeros(0, np.int64)] * 3
        for j in range(rest - 1, -2, -1):
            later = []
            if len(who):
                # every symbol that can stand to the left of what is matched so far
                child_low, child_high = self.extend(alphabet[None, :], low[:, None], high[:, None])
                i, c = np.nonzero(child_low < child_high)
                child = who[i], child_low[i, c], child_high[i, c]
                # inserted: the asker's symbol is still to come
                wrong = [np.concatenate(x) for x in zip(wrong, child)]
                if j >= 0:
                    own = q[child[0], j] == c + 1
                    later.append([x[~own] for x in child])  # replaced
                    later.append([who, low, high])  # deleted
                    who, low, high = (x[own] for x in child)
            if j < 0:
                break
            # those with their error behind them go on exactly
            next_low, next_high = self.extend(q[wrong[0], j], wrong[1], wrong[2])
            later.append(_alive(wrong[0], next_low, next_high))
            wrong = [np.concatenate(x) for x in zip(*later)]
        state, word = self.found(wrong[1], wrong[2])
        return [(wrong[0][state], word)]


def _alive(who, low, high):
    keep = low < high
    return who[keep], low[keep], high[keep]


def _suffix_order(text: np.ndarray, edge: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in order, by doubling; delimiters are ordered by their places, so that a comparison
    ends at the first one."""
    rank = text + len(edge) - 1
    rank[edge] = np.arange(len(edge))
    order = np.argsort(rank, kind="stable")
    width = 1
    while width <= longest:
        after = np.zeros(len(rank), np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (len(rank) + len(edge) + int(text.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_keys = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.append(0, sorted_keys[1:] != sorted_keys[:-1]))
        width *= 2
    return order


def pairs(words: DataFrame, index_words: int = 1 << 15) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words one edit apart, once each.

    ``words`` (word, n) are distinct.
    """
    spark = words.sparkSession
    p = partitions(spark)
    n = F.length("word")
    buckets = max(p, 4 * words.count() // index_words)

    def first(k):
        return F.col("word").substr(F.lit(1), k.cast("int"))

    def last(k):
        return F.col("word").substr((n - k + 1).cast("int"), k.cast("int"))

    def half(side, length):
        """What a word of ``length`` must have in common; here ``word`` has it at its own end."""
        m = F.floor(length / 2)
        return F.struct(F.lit(side).alias("side"), (last(length - m) if side == 0 else first(m)).alias("key"))

    held = F.array_distinct(F.array(*[half(s, n + d) for s in (0, 1) for d in (-1, 0, 1)]))
    asks = F.array(half(0, n), half(1, n))
    bucket = F.pmod(F.xxhash64("k.side", "k.key"), F.lit(buckets)).alias("bucket")
    # a word may have two of its keys in one bucket
    index = saved(words.select("word", "n", F.explode(held).alias("k")).select(F.col("k.side").alias("side"), bucket, "word", "n").distinct(),
                  "spelling_index")
    sizes = index.groupBy("side", "bucket").agg(F.ceil(F.count(F.lit(1)) / index_words).alias("pieces"))
    index = index.join(sizes, ["side", "bucket"]).select(
        "side", "bucket", F.pmod(F.xxhash64(F.lit(5), "word"), "pieces").alias("piece"), F.lit(0).alias("kind"), "word", "n")
    ask = words.select("word", F.explode(asks).alias("k")).select(F.col("k.side").alias("side"), bucket, "word").join(sizes, ["side", "bucket"])
    ask = ask.select("side", "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"),
                     F.lit(1).alias("kind"), "word", F.lit(None).cast("long").alias("n"))
    place = ["side", "bucket", "piece"]
    rows = index.unionByName(ask).repartition(p, *place).sortWithinPartitions(*place, "kind", F.length("word"))

    def run(batches):
        group, words, counts, built = None, [], [], None
        for batch in batches:
            *key, kind, word, n = (batch.column(i).to_pylist() for i in range(6))
            keys = list(zip(*key, kind))
            a = 0
            while a < len(keys):
                b = a + 1
                while b < len(keys) and keys[b] == keys[a]:
                    b += 1
                if keys[a][:3] != group:
                    group, words, counts, built = keys[a][:3], [], [], None
                side = group[0]
                mine = [w[::-1] for w in word[a:b]] if side else word[a:b]
                if keys[a][3] == 0:
                    words += mine
                    counts += n[a:b]
                elif words:  # a piece may have none
                    built = built or Index(words)
                    lengths = np.array([len(w) for w in mine])
                    for length in np.unique(lengths).tolist():
                        at = np.flatnonzero(lengths == length)
                        exact = length // 2 if side else length - length // 2
                        who, near = built.near([mine[i] for i in at.tolist()], exact)
                        who, near = np.unique(np.stack([at[who], near]), axis=1)
                        own = word[a:b]
                        names = [words[i][::-1] if side else words[i] for i in near.tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([own[i] for i in who.tolist()], pa.string()), pa.array(names, pa.string()),
                             pa.array([counts[i] for i in near.tolist()], pa.int64())], names=["word", "near", "near_n"])
                a = b

    found = rows.mapInArrow(run, "word string, near string, near_n long")
    with batch_limits(spark, rows=1 << 14):
        return saved(found, "near_words").distinct()


def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``words``."""
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    of = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = words.join(of, "word", "left")
    far = -F.col("best.n") >= ratio * F.col("n")
    rows = saved(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(far, F.col("best.word")).alias("form"), F.when(far, -F.col("best.n")).alias("form_n")), "forms")
    # roots by doubling: n grows by the ratio at each form, so there is no cycle and no long chain
    links = rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = saved(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                 F.col("next").isNotNull().alias("moved")), "roots")
        if not links.where("moved").take(1):
            break
        links = links.drop("moved")
    return rows.join(links.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    A null or empty text has no words; repeated rows count each; other columns play no part; an
    empty table, or one without words, gives an empty result.
    """
    words = saved(vocabulary(docs, id_col, text_col), "vocabulary")
    return forms(words, pairs(words))
