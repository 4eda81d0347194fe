"""Token-id files of length-delimited binary records with a separate offset index.

A dataset folder holds ``data/`` (files of records in ascending id order, by file name) and
``index/`` (Parquet: one row per record with its file, offset, size and token count).

One record, all integers little-endian:

    8  payload size in bytes
    4  masked crc32 of those 8 bytes
    n  payload
    4  masked crc32 of the payload
    1  line feed (written by Spark's line writer, skipped by size, never searched for)

Payload: 8 bytes id, 1 byte flags (1: the id is null), 1 byte width of an id (2 or 4),
8 bytes number of ids, then the ids.  The mask rotates a checksum right by 15 bits and adds a
constant, so that checksums of data holding checksums stay sound.

Files are written and read by Spark's own writers and readers, so any file system that Spark
reaches will do, and its commit protocol hides files of failed or repeated tasks.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import ColumnEncoder, gather, grouped, spans
from tidemark.llm.common import batch_limits, partitions

MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<qBBQ")
#: Bytes and records of one file (one record may be more); a reader holds one file at a time.
BYTES_PER_FILE = 64 << 20
RECORDS_PER_FILE = 4096


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray, width: int) -> bytes:
    """One record without its final line feed."""
    body = _BODY.pack(key or 0, key is None, width, len(ids)) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(body))
    return size + struct.pack("<I", masked_crc(size)) + body + struct.pack("<I", masked_crc(body))


def parse(data, offset: int, payload: bool = True) -> tuple[int | None, int, np.ndarray | None, int]:
    """(id, number of ids, ids, offset of the next record); raises ValueError if it is damaged."""
    size, crc = _HEAD.unpack_from(data, offset)
    if masked_crc(bytes(data[offset:offset + 8])) != crc:
        raise ValueError(f"record at {offset}: damaged size")
    at = offset + _HEAD.size
    end = at + size
    if end + 4 > len(data):
        raise ValueError(f"record at {offset}: cut off")
    key, null, width, n = _BODY.unpack_from(data, at)
    ids = None
    if payload:
        body = bytes(data[at:end])
        if masked_crc(body) != struct.unpack_from("<I", data, end)[0]:
            raise ValueError(f"record at {offset}: damaged payload")
        ids = np.frombuffer(body, f"<u{width}", n, _BODY.size)
    return (None if null else key), n, ids, end + 5


_encoders: dict[str, tuple[ColumnEncoder, int]] = {}


def library_encoder(path: str) -> tuple[ColumnEncoder, int]:
    """Encoder of the tokenizers library for a vocabulary file, and its vocabulary size.

    The library is as loaded: strings of its added tokens in a text become those tokens.
    """
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        added = [t.content for t in library.get_added_tokens_decoder().values()]

        def one_by_one(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

        def encode_new(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Spaced words are one match each, so many of them make one text whose ids the library
            numbers by match; other chunks are texts of their own."""
            size = np.zeros(len(chunks), np.int64)
            plain = [i for i, c in enumerate(chunks) if c[:1] == " " and c[1:].isalpha()]
            ids: list[np.ndarray] = []
            order: list[int] = []
            for a in range(0, len(plain), 1024):
                mine = plain[a:a + 1024]
                e = library.encode_batch(["".join([chunks[i] for i in mine])], add_special_tokens=False)[0]
                count = np.bincount(np.array(e.word_ids, np.int64), minlength=len(mine))
                if len(count) != len(mine) or not count.all():
                    continue  # not one match each: below, one by one
                size[mine] = count
                ids.append(np.array(e.ids, np.uint32))
                order += mine
            done = set(order)
            rest = [i for i in range(len(chunks)) if i not in done]
            for a in range(0, len(rest), 4096):
                mine = rest[a:a + 4096]
                found = one_by_one([chunks[i] for i in mine])
                size[mine] = [len(x) for x in found]
                ids.append(np.array([x for f in found for x in f], np.uint32))
                order += mine
            # back to the order of the chunks
            made = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            taken = size[order]
            at = np.empty(len(chunks), np.int64)
            at[order] = np.cumsum(taken) - taken
            return gather(made, at, size, np.arange(len(chunks))), size

        _encoders[path] = ColumnEncoder(encode_new, added), library.get_vocab_size()
    return _encoders[path]


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the record files and their index.

    Records are in ascending id order (null ids first, ties by a hash of the text); a null or
    empty text gives a record of the end id alone; repeated rows give repeated records; other
    columns are left out.  An empty table gives no data file and an empty index.
    """
    spark = docs.sparkSession

    def run(batches):
        encoder, vocab = library_encoder(vocabulary)
        width = 2 if max(vocab - 1, end_id) < 1 << 16 else 4
        last = np.array([end_id], "<u4")
        file = at = held = 0
        for keys, texts in grouped(batches, 1):
            ids = encoder.encode(texts)
            keys = keys.to_pylist()
            for a, b in spans([len(x) for x in ids], 1 << 20):
                made = [frame(k, np.concatenate([x, last]), width) for k, x in zip(keys[a:b], ids[a:b])]
                files = []
                for m in made:
                    if at == RECORDS_PER_FILE or held and held + len(m) > BYTES_PER_FILE:
                        file, at, held = file + 1, 0, 0
                    at, held = at + 1, held + len(m) + 1
                    files.append((file << 32) + at)
                places = np.array(files, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(places >> 32), pa.array(places), pa.array(made, pa.binary())],
                                                 names=["file", "place", "record"])

    rows = docs.select(docs[id_col].cast("long").alias("k"), docs[text_col].cast("string").alias("t"))
    tie = F.xxhash64("t")
    ordered = rows.repartitionByRange(partitions(spark), F.col("k"), tie).sortWithinPartitions("k", tie)
    # a task writes its files one after the other, each in its own folder; they stay in this order
    records = ordered.mapInArrow(run, "file long, place long, record binary").sortWithinPartitions("file", "place")
    with batch_limits(spark):
        (records.select("file", F.col("record").cast("string").alias("value"))
         .write.partitionBy("file").text(f"{path}/data"))
    index_rows = scan(spark, path, payload=False).drop("ids")
    with batch_limits(spark, 1):
        index_rows.write.parquet(f"{path}/index")


def scan(spark: SparkSession, path: str, payload: bool = True, at: DataFrame | None = None) -> DataFrame:
    """Records of the files: file (task and its file in one number), offset, size, id, n_tokens, before, ids.

    ``before`` counts the ids of earlier records in the file; ``ids`` are little-endian
    unsigned 32-bit integers (null without ``payload``).  ``at`` (rows of the index) reads only
    the records at those offsets; ``before`` is then null.
    """
    def rows(number, content, offsets):
        data = memoryview(content)
        offset = before = 0
        todo = sorted(offsets) if offsets is not None else None
        out: list[tuple] = []
        held = k = 0
        while k < len(todo) if todo is not None else offset < len(data):
            if todo is not None:
                offset, k = todo[k], k + 1
            key, n, ids, following = parse(data, offset, payload)
            out.append((number, offset, following - offset, key, n, before if todo is None else None,
                        None if ids is None else ids.astype("<u4").tobytes()))
            held += n
            before += n
            offset = following
            if held > 1 << 20:
                yield out
                out, held = [], 0
        if out:
            yield out

    schema = pa.schema([("file", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("id", pa.int64()),
                        ("n_tokens", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                offsets = batch.column(2)[i].as_py() if batch.num_columns > 2 else None
                for out in rows(batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer(), offsets):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)

    name = F.element_at(F.split("path", "/"), -1)
    part = F.regexp_extract(name, r"^part-(\d+)-", 1).cast("long") * (1 << 32)
    number = part + F.regexp_extract("path", r"/file=(\d+)/[^/]*$", 1).cast("long")
    files = (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(f"{path}/data").select(number.alias("file"), "content"))
    if at is not None:
        wanted = at.groupBy("file").agg(F.collect_list("offset").alias("offsets"))  # at most RECORDS_PER_FILE each
        files = files.join(wanted, "file")
    return files.mapInArrow(run, "file long, offset long, size long, id long, n_tokens long, before long, ids binary")


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def with_start(records: DataFrame, idx: DataFrame) -> DataFrame:
    """Adds ``start``: how many ids stand before the record in the whole dataset."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = idx.groupBy(F.shiftright("file", 32).alias("_task"), "file").agg(F.sum("n_tokens").alias("_n"))
    totals = totals.withColumn("_first", F.coalesce(F.sum("_n").over(before.partitionBy("_task")), F.lit(0)))
    # one row for each task that wrote
    tasks = totals.groupBy("_task").agg(F.sum("_n").alias("_n"), F.min("file").alias("file"))
    tasks = tasks.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    totals = totals.join(tasks, "_task").select("file", (F.col("_first") + F.col("_base")).alias("_first"))
    return records.join(totals, "file").withColumn("start", F.col("_first") + F.col("before")).drop("_first")


def shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records in an order drawn by ``seed``; the order is settled on the index alone."""
    order = index(spark, path).select("file", "offset").withColumn("_o", F.xxhash64(F.lit(seed), "file", "offset"))
    found = scan(spark, path, at=order.select("file", "offset"))
    return found.join(order, ["file", "offset"]).orderBy("_o", "file", "offset").drop("_o")
