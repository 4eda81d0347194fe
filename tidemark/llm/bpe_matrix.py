"""Byte-level BPE encoding and decoding over length-bucketed padded matrices.

Each distinct piece (a match of the splitting pattern) is a row of byte symbols.  Rows are
grouped by length; in every round each row merges its leftmost pair of minimum rank.  The
pair ranks sit in an open-addressing hash table probed for whole columns at once; after a
round every row is one symbol shorter, rows without a mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.chunks import ChunkEncoder, by_bytes
from tidemark.llm.common import batch_limits, saved

_U = np.uint64
NONE = np.int32(2**31 - 1)
#: Rows times symbols of one matrix.
MAX_CELLS = 1 << 20
#: Pieces above this length are merged with a heap: the same merges, without a row of that width.
LONG = 512
#: Chunks and pieces that one worker remembers; a worker outlives a stage, and so does what it holds.
REMEMBERED = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """(left id, right id) -> id of the merged token, in linear-probing arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        rows = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        keys = np.array([k for k, _ in rows] or [0], np.uint64)[:len(rows)]
        values = np.array([v for _, v in rows], np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(rows)) * 4))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, _U(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE)
        left, step = np.arange(len(rows)), 0
        home = self._slot(keys)
        while len(left):
            slot = (home[left] + step) & self.mask
            free = self.values[slot] == NONE
            cand = left[free]
            # of several keys for one free slot the last one written stays
            self.keys[slot[free]] = keys[cand]
            won = self.keys[slot[free]] == keys[cand]
            self.values[slot[free][won]] = values[cand[won]]
            left = np.concatenate([left[~free], cand[~won]])
            step += 1
        self.probes = step

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where the pair doesn't merge or a side is padding (-1)."""
        keys = (left.astype(np.uint64) << _U(32)) | right.astype(np.uint64)
        out = np.full(keys.shape, NONE)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[todo])
        for _ in range(self.probes):
            if not len(todo):
                break
            hit = self.keys[slot] == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            more = ~hit & (self.values[slot] != NONE)
            todo, slot = todo[more], (slot[more] + 1) & self.mask
        return out


class BPE:
    def __init__(self, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.whole = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        known = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.token_size = np.array([len(t) for t in known])
        self.token_at = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(known), np.uint8)
        self.pairs = PairTable(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.encoder = ChunkEncoder(self._chunks, REMEMBERED)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit integers."""
        return self.encoder.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, gathered from one table of all tokens' bytes."""
        every = np.frombuffer(ids, "<u4")
        out = []
        for k in range(0, len(every), 1 << 13):
            t = every[k:k + (1 << 13)]
            n = self.token_size[t]
            end = np.cumsum(n)
            out.append(self.token_bytes[np.repeat(self.token_at[t] - end + n, n) + np.arange(end[-1])].tobytes())
        return b"".join(out)

    def _split(self, chunk: str) -> list[str]:
        """Matches of the pattern; the common forms (word, word and one mark) need no search."""
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            return [chunk]
        if chunk[-1] in ".,;:!?" and chunk[1:-1].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            return [chunk[:-1], chunk[-1]]
        return self.pattern.findall(chunk)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [self._split(c) for c in chunks]
        if len(self.pieces) > REMEMBERED:
            self.pieces = {}
        known = self.pieces
        new = list({p for parts in cut for p in parts if p not in known})
        for p, ids in zip(new, self.merge([p.encode("utf-8") for p in new])):
            known[p] = ids
        return [b"".join([known[p] for p in parts]) for parts in cut]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """ids of each piece, by merging within length buckets."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            r = self.whole.get(p)
            if r is not None and len(p) == 1:
                out[i] = np.uint32(r).tobytes()
            elif len(p) > LONG:
                out[i] = self._merge_long(p)
            elif p:
                buckets.setdefault((len(p) + 3) // 4 * 4, []).append(i)
        for width, rows in buckets.items():
            step = max(1, MAX_CELLS // width)
            for k in range(0, len(rows), step):
                self._merge_rows([pieces[i] for i in rows[k:k + step]], rows[k:k + step], width, out)
        return out

    def _merge_rows(self, pieces: list[bytes], slots: list[int], width: int, out: list[bytes]) -> None:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        sym = self.byte_id[raw].reshape(len(pieces), width)
        length = np.array([len(p) for p in pieces])
        sym[np.arange(width) >= length[:, None]] = -1
        row = np.array(slots)
        rank = self.pairs.get(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(len(pieces), width - 1)
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            best = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), NONE)
            done = best == NONE
            if done.any():
                for i, s, n in zip(row[done].tolist(), sym[done].astype("<u4"), length[done].tolist()):
                    out[i] = s[:n].tobytes()
                keep = ~done
                row, sym, rank, length = row[keep], sym[keep], rank[keep], length[keep]
                at, best = at[keep], best[keep]
            n = len(row)
            if not n:
                return
            lines = np.arange(n)
            sym[lines, at] = best
            # compaction: every row drops the symbol right of the merge and the pair it made
            keep = np.ones(sym.shape, bool)
            keep[lines, at + 1] = False
            sym = sym[keep].reshape(n, -1)
            keep = np.ones(rank.shape, bool)
            keep[lines, at] = False
            rank = rank[keep].reshape(n, -1)
            length -= 1
            inner = np.flatnonzero(at < rank.shape[1])
            rank[inner, at[inner]] = self.pairs.get(sym[inner, at[inner]], sym[inner, at[inner] + 1])
            inner = np.flatnonzero(at > 0)
            rank[inner, at[inner] - 1] = self.pairs.get(sym[inner, at[inner] - 1], sym[inner, at[inner]])

    def _merge_long(self, piece: bytes) -> bytes:
        """The same rule for one very long piece: a heap gives the leftmost pair of least rank."""
        sym = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens, whole = self.tokens, self.whole

        def pair(i: int):
            j = nxt[i]
            return whole.get(tokens[sym[i]] + tokens[sym[j]]) if j < n else None

        first = self.pairs.get(np.array(sym[:-1]), np.array(sym[1:]))
        heap = [(int(r), i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for k in (prv[i], i):
                if k >= 0 and (s := pair(k)) is not None:
                    heapq.heappush(heap, (s, k, sym[k], sym[nxt[k]]))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()


_loaded: dict[tuple[str, str], BPE] = {}


def load(ranks_path: str, pattern: str) -> BPE:
    """The vocabulary, read once in each worker process."""
    key = (ranks_path, pattern)
    if key not in _loaded:
        _loaded[key] = BPE(ranks_path, pattern)
    return _loaded[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = True, keep: list[str] | None = None) -> DataFrame:
    """id, the columns of ``keep``, ``n_tokens``, two digests and (``keep_ids``) ``ids`` of each text.

    Each text is split by ``pattern`` and each match merged on its own; a null or empty text
    has no ids.  ``ids`` are little-endian unsigned 32-bit integers; ``decoded_sha256`` is of the
    bytes that the ids decode to.  Rows are independent: repeated rows and null ids are kept as
    they are, other columns are left out.
    """
    names = [id_col, *(keep or [])]
    inner = [f"c{i}" for i in range(len(names))]
    rows = docs.select(*[docs[c].alias(i) for c, i in zip(names, inner)], docs[text_col].cast("string").alias("t"))
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def run(batches):
        bpe = load(ranks_path, pattern)
        for batch in batches:
            *own, texts = batch.columns
            for start, group in by_bytes(texts):
                ids = bpe.encode(group)
                columns = [
                    *[c.slice(start, len(group)) for c in own],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string()),
                    *[pa.array(ids, pa.binary())] * keep_ids,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*inner, *made])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    schema = f"{kinds}n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    with batch_limits(docs.sparkSession):
        return saved(rows.mapInArrow(run, schema), "encoded").toDF(*names, *made)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id and ``decoded`` bytes of each row of ``ids``; null ids decode to no bytes."""

    def run(batches):
        bpe = load(ranks_path, pattern)
        for batch in batches:
            texts = [bpe.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["_id", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    out = encoded.select(id_col, "ids").mapInArrow(run, f"_id {kind}, decoded binary")
    return out.withColumnRenamed("_id", id_col)
