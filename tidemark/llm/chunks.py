"""Cut texts into chunks whose byte-level BPE encodings can be joined, and remember them.

The splitting pattern of the vocabulary never puts a non-space character and a space after
it into one match, so a text may be cut before every such space.  A worker keeps the ids of
the chunks it has met in a bounded table and encodes only the others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks one worker remembers; beyond that it starts anew (speed only, never the result).
MAX_REMEMBERED = 500_000
#: Chunks longer than this are encoded but not remembered.
MAX_CHUNK = 64

_RUN = re.compile(r"\s ")


def chunks(text: str) -> list[str]:
    """Chunks of a text in order; joined they are the text again."""
    if not text:
        return []
    if _RUN.search(text):
        # cut only before the spaces that follow a character other than white space
        return re.split(r"(?<=\S)(?= )", text)
    first, *rest = text.split(" ")
    out = [" " + x for x in rest]
    if first:
        out.insert(0, first)
    return out


class ChunkEncoder:
    """ids of texts as little-endian unsigned 32-bit integers, through ``encode_new``.

    ``encode_new`` maps a list of distinct chunks to their encoded ids.
    """

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]], remembered: int = MAX_REMEMBERED):
        self.encode_new = encode_new
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > self.remembered:
            self.known = {}
        known = self.known
        cut = [chunks(t or "") for t in texts]
        new = {c for parts in cut for c in parts if c not in known}
        extra: dict[str, bytes] = {}
        if new:
            order = list(new)
            for c, ids in zip(order, self.encode_new(order)):
                (known if len(c) <= MAX_CHUNK else extra)[c] = ids
        if extra:
            return [b"".join([known[c] if c in known else extra[c] for c in parts]) for parts in cut]
        get = known.__getitem__
        return [b"".join(map(get, parts)) for parts in cut]


#: White space beside a space or a line feed (in the syntax of Arrow's expressions), or a byte 1.
_ARROW_RUN = r"[\x09-\x0D\x1C-\x20\x{85}\pZ][ \n]|\n[\x09-\x0D\x1C-\x20\x{85}\pZ]|\x01"
#: A word and the punctuation after it: two matches.
_WORD_AND_MARKS = r"^(?P<word> ?\pL+)(?P<marks>[^\x00-\x20\x{85}\pZ\pL\pN]+)$"


def gather(pieces: np.ndarray, at: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``pieces[at[k]:at[k] + size[k]]`` for every k of ``which``, one after the other."""
    n = size[which]
    end = np.cumsum(n)
    return pieces[np.repeat(at[which] - end + n, n) + np.arange(end[-1] if len(end) else 0)]


class ColumnEncoder:
    """ids of a whole column of texts, each distinct chunk handled once, through ``encode_new``.

    ``encode_new`` maps a list of distinct chunks to (all their ids, how many each has).  A text that
    holds one of ``added`` (strings that a library takes out before anything else) is one chunk.
    """

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], added: list[str] = ()):
        self.encode_new, self.added = encode_new, added
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.pool, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Where each of some distinct chunks is remembered; new ones are encoded first."""
        if len(self.place) > MAX_REMEMBERED:
            self.forget()
        names = chunks.to_pylist()
        got = np.array(list(map(self.place.get, names, repeat(-1))), np.int64)
        new = np.flatnonzero(got < 0)
        if len(new):
            fresh = [names[i] for i in new.tolist()]
            ids, size = self.encode_new(fresh)
            got[new] = np.arange(len(new)) + len(self.size)
            self.place.update(zip(fresh, got[new].tolist()))
            self.pool, self.size = np.concatenate([self.pool, ids]), np.concatenate([self.size, size])
        return got

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of some distinct chunks, how many each has): each is a line feed or none, a word
        or anything else, and marks after a word or none."""
        feed = pc.starts_with(chunks, "\x01")
        body = pc.if_else(feed, pc.utf8_slice_codeunits(chunks, 1), chunks)
        two = pc.extract_regex(body, _WORD_AND_MARKS)
        word = pc.if_else(pc.is_valid(two), pc.struct_field(two, "word"), body)
        marks = pc.if_else(pc.is_valid(two), pc.struct_field(two, "marks"), pa.scalar("", body.type))
        feed = pc.if_else(feed, pa.scalar("\n", body.type), pa.scalar("", body.type))
        parts = pa.chunked_array([feed, word, marks]).combine_chunks().dictionary_encode()
        which = self._places(parts.dictionary)[parts.indices.to_numpy()].reshape(3, -1).T.ravel()
        return gather(self.pool, np.cumsum(self.size) - self.size, self.size, which), self.size[which].reshape(-1, 3).sum(axis=1)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """ids of each text; nulls count as empty."""
        texts = texts.fill_null("")
        if not pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, _ARROW_RUN)
        for name in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, name))
        odd = odd.to_numpy(zero_copy_only=False)
        # where white space stands together, a text is one chunk
        slow = texts.filter(pa.array(odd))
        # else it is also cut before and after every line feed, for which byte 1 stands then
        usual = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~odd)), "\n", " \x01"), " ")
        flat = usual.flatten().dictionary_encode()
        words, code = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
        edges = usual.offsets.to_numpy().astype(np.int64)
        edges = edges - edges[0] if len(edges) else np.zeros(1, np.int64)
        # a chunk is a part with the space before it; the first part of a text has none
        first = np.zeros(len(code), bool)
        first[edges[:-1]] = True
        spaced = pc.if_else(pc.starts_with(words, "\x01"), words,
                            pc.binary_join_element_wise(pa.scalar(" ", words.type), words, pa.scalar("", words.type)))
        every = pa.chunked_array([spaced, words.take(pa.array(code[first]))]).combine_chunks().dictionary_encode()
        code[first] = np.arange(len(words), len(words) + int(first.sum()))
        code = every.indices.to_numpy()[code]
        pool, size = self._distinct(every.dictionary)
        at = np.cumsum(size) - size
        out: list = [None] * len(texts)
        whole, n = self.encode_new(slow.to_pylist()) if len(slow) else (pool[:0], [])
        for i, x in zip(np.flatnonzero(odd).tolist(), np.split(whole, np.cumsum(n)[:-1])):
            out[i] = x
        places = np.flatnonzero(~odd)
        # texts a few at a time: the gathering takes several numbers a token
        for a, b in spans(np.diff(edges).tolist(), 1 << 18):
            mine = code[edges[a]:edges[b]]
            tokens = gather(pool, at, size, mine)
            ends = np.concatenate([[0], np.cumsum(size[mine])])[edges[a:b + 1] - edges[a]]
            for i, x, y in zip(places[a:b].tolist(), ends, ends[1:]):
                out[i] = tokens[x:y]
        return out


def spans(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """(from, to) row ranges of about ``limit`` in sum, at least one row each."""
    start = held = i = 0
    for i, n in enumerate(sizes, 1):
        held += n
        if held >= limit:
            yield start, i
            start, held = i, 0
    if start < i:
        yield start, i


def by_bytes(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(first position, texts) groups of about ``limit`` bytes."""
    for a, b in spans(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), limit):
        yield a, texts.slice(a, b - a).to_pylist()


def grouped(batches: Iterable[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[list[pa.Array]]:
    """Columns of about ``limit`` bytes of text at a time (at least a row), whatever the batches.

    The text column comes without nulls, an empty text for each.
    """
    held, size = [], 0
    for batch in batches:
        text = batch.column(column).fill_null("")
        batch = batch.set_column(column, batch.schema.field(column), text)
        for a, b in spans(pc.binary_length(text).to_pylist(), limit):
            held.append(batch.slice(a, b - a))
            size += held[-1].column(column).nbytes
            if size >= limit:
                yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]
                held, size = [], 0
    if held:
        yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]
