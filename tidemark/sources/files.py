"""Files of a folder tree as rows, and byte ranges of them, found and read by tasks.

``list_files`` lists a tree in tasks: the root's own entries in one, each of its folders in
whatever task it falls to.  No list of paths stands in the driver.  ``opened`` gives a task a file
that it reads a range at a time, so a footer costs a footer's bytes and a long file is never
held whole.  Both work on what pyarrow's file systems reach: mounted folders, HDFS, S3, GCS, ABFS.
"""

from __future__ import annotations

import io
import itertools
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path string, length long"
#: Rows of a batch handed on.
_ROWS = 10_000


def file_system(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    if "://" not in root:
        return pafs.LocalFileSystem(), root.rstrip("/")
    system, base = pafs.FileSystem.from_uri(root)
    return system, base.rstrip("/")


def _shown(name: str) -> bool:
    """Spark's rule for files that a reader sees."""
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def _entries(root: str, folder: str, recursive: bool, suffixes: tuple[str, ...], folders: bool = False) -> Iterator[tuple[str, int | None]]:
    """(relative path, length) of a folder's files with one of the suffixes; with ``folders`` (path, None)
    of the folders right in it instead.  A mounted folder is read entry by entry."""
    system, base = file_system(root)
    if not isinstance(system, pafs.LocalFileSystem):
        where = f"{base}/{folder}" if folder else base
        for info in system.get_file_info(pafs.FileSelector(where, recursive=recursive and not folders, allow_not_found=True)):
            relative = info.path[len(base):].lstrip("/")
            if all(map(_shown, relative.split("/"))):
                if folders and info.type == pafs.FileType.Directory:
                    yield relative, None
                elif not folders and info.type == pafs.FileType.File and relative.endswith(suffixes):
                    yield relative, info.size
        return
    todo = [folder]
    while todo:
        folder = todo.pop()
        try:
            found = os.scandir(f"{base}/{folder}" if folder else base)
        except FileNotFoundError:
            continue
        with found:
            for e in found:
                if not _shown(e.name):
                    continue
                relative = f"{folder}/{e.name}" if folder else e.name
                if e.is_dir():
                    if folders:
                        yield relative, None
                    elif recursive:
                        todo.append(relative)
                elif not folders and e.name.endswith(suffixes) and e.is_file():
                    yield relative, e.stat().st_size


def _in_batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while held := list(itertools.islice(rows, _ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), (pa.string(), pa.int64()))], names=["path", "length"])


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...], folders: DataFrame | None = None,
               depth: int | None = None) -> DataFrame:
    """(path, length) of the files under ``root`` with one of the suffixes, paths relative to it.

    ``folders`` (rows of one column) names the folders right under the root that are listed; files
    right under the root are listed always.  ``depth`` 1 lists only these, 2 only the files right in a
    folder of the root.  A root that doesn't exist has no files.
    """
    def own(_):
        yield from _in_batches(_entries(root, "", False, suffixes))

    def inside(_):
        yield from _in_batches(_entries(root, "", False, suffixes, folders=True))

    def below(given):
        yield from _in_batches(row for batch in given for folder in batch.column(0).to_pylist()
                               for row in _entries(root, folder, depth is None, suffixes))

    one = spark.range(0, 1, 1, 1)
    first = one.mapInArrow(own, FILES)
    if depth == 1:
        return first
    top = one.mapInArrow(inside, FILES).select("path")
    if folders is not None:
        top = top.join(folders.toDF("path"), "path", "left_semi")
    deeper = top.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(below, FILES)
    return deeper if depth == 2 else first.unionByName(deeper)


def spread(files: DataFrame) -> DataFrame:
    """``files`` over all tasks, whatever folders they came from; long ones first."""
    spark = files.sparkSession
    p = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.repartition(p, "path").sortWithinPartitions(F.desc("length"))


class Counted:
    """A file that is read a range at a time and knows how many bytes it has handed out."""

    def __init__(self, file):
        self.file, self.bytes = file, 0

    def read(self, n: int = -1) -> bytes:
        data = self.file.read(None if n is None or n < 0 else n)
        self.bytes += len(data)
        return data

    def seek(self, offset: int, whence: int = 0) -> int:
        return self.file.seek(offset, whence)

    def tell(self) -> int:
        return self.file.tell()

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def writable(self) -> bool:
        return False

    def raw(self) -> io.RawIOBase:
        """The same file for Python's own buffered readers."""
        return _Raw(self)

    def __enter__(self) -> "Counted":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    @property
    def closed(self) -> bool:
        return self.file.closed

    def close(self) -> None:
        self.file.close()

    def flush(self) -> None:
        pass


class _Raw(io.RawIOBase):
    def __init__(self, file: Counted):
        self.file = file

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


def opened(root: str, path: str) -> Counted:
    """A file under ``root`` (or of a full path, without one) for reading ranges of it."""
    system, base = file_system(f"{root}/{path}" if root else path)
    return Counted(system.open_input_file(base))


def small_files(files: DataFrame, root: str) -> DataFrame:
    """(path, value): whole documents of ``files`` (path relative to ``root``), read by tasks a few at
    a time."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                paths = batch.column(0).slice(a, 256)
                texts = []
                for path in paths.to_pylist():
                    with opened(root, path) as file:
                        texts.append(file.read().decode("utf-8", errors="replace"))
                yield pa.RecordBatch.from_arrays([paths, pa.array(texts, pa.string())], names=["path", "value"])

    return spread(files).select("path").mapInArrow(run, "path string, value string")


def glob_of(names: list[str]) -> str:
    """A file pattern that matches just these names."""
    quoted = ["".join("\\" + c if c in "\\{}[]*?,^" else c for c in n) for n in names]
    return "{" + ",".join(quoted) + "}"


def relative(root: str, path: Column) -> Column:
    """A decoded path or URI -> the path relative to ``root``."""
    base = root.split("://", 1)[-1]
    base = base[len("file:"):] if base.startswith("file:") else base
    base = "/" + base.strip("/") + "/"
    return path.substr(F.instr(path, F.lit(base)) + F.lit(len(base)), F.length(path))
