"""Which landed dumps a micro-batch takes: a streaming source that admits files by period and bytes.

Spark's file stream takes files by modification time and bounds a trigger by their number.  Here
each trigger admits the new dumps in the order that first-wins needs (by the begin of the period, a
month before its days, then parts), as many as hold ``max_bytes`` and ``max_files``, at least one.
An admission is a numbered document beside the checkpoint, written before the batch that it makes;
offsets are these numbers, so a restart or a replay sees the same files in the same batches, and a
file is admitted once.  The rows are the files, not their content: the tasks of the batch open them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources.files import file_system

NAME = "tidemark_landed_dumps"
SCHEMA = "path string, length long, admission long"
_STAMP = re.compile(r"(monthly|daily)/.*-(\d{4}-\d{2}(?:-\d{2})?)(?:\.part(\d+))?\.\w+$")
#: Files of one input partition.
_GROUP = 256


def admission_order(path: str) -> tuple:
    """Sort key of a dump's path: begin of its period, month before days, dump, part."""
    m = _STAMP.search(path)
    if not m:
        return "9999", 2, path, 0
    stamp = m[2] if len(m[2]) == 10 else m[2] + "-01"
    return stamp, int(m[1] == "daily"), path[:m.start(2)], int(m[3] or 0)


def admit(new: list[tuple[str, int]], max_bytes: int | None, max_files: int | None) -> list[tuple[str, int]]:
    """The (path, length) that go next: in order, at least one, within the bounds."""
    taken, size = [], 0
    for path, length in sorted(new, key=lambda f: admission_order(f[0])):
        if taken and (max_files and len(taken) >= max_files or max_bytes and size + length > max_bytes):
            break
        taken.append((path, length))
        size += length
    return taken


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.landing, self.segment, self.ext = options["path"].rstrip("/"), options["segment"], options["ext"]
        self.max_bytes, self.max_files = int(options.get("max_bytes", 0)) or None, int(options.get("max_files", 0)) or None
        self.system, self.log = file_system(options["log"])
        self.admitted: dict[int, list] = {}
        self.seen: set[str] = set()

    def _load(self) -> int:
        """Number of the last admission; those not yet known are read."""
        for info in self.system.get_file_info(pafs.FileSelector(self.log, allow_not_found=True)):
            name = info.base_name
            if name.endswith(".json") and int(name[:-5]) not in self.admitted:
                with self.system.open_input_stream(info.path) as f:
                    files = json.loads(f.read())
                self.admitted[int(name[:-5])] = files
                self.seen.update(p for p, _ in files)
        return max(self.admitted, default=0)

    def _landed(self) -> Iterator[tuple[str, int]]:
        for freq in ("monthly", "daily"):
            folder = f"{self.landing}/{freq}/{self.segment}"
            system, base = file_system(folder)
            for info in system.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
                if info.type == pafs.FileType.File and info.base_name.endswith("." + self.ext) and info.base_name[0] not in "._":
                    path = folder + info.path[len(base):]
                    if path not in self.seen:
                        yield path, info.size

    def initialOffset(self) -> dict:
        return {"admission": 0}

    def latestOffset(self) -> dict:
        last = self._load()
        taken = admit(list(self._landed()), self.max_bytes, self.max_files)
        if taken:
            last += 1
            self.system.create_dir(self.log, recursive=True)
            name = f"{self.log}/{last:010d}.json"
            with self.system.open_output_stream(name + ".tmp") as f:
                f.write(json.dumps(taken).encode())
            self.system.move(name + ".tmp", name)
            self.admitted[last] = taken
            self.seen.update(p for p, _ in taken)
        return {"admission": last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self._load()
        files = [(p, n, a) for a in range(start["admission"] + 1, end["admission"] + 1) for p, n in self.admitted[a]]
        return [InputPartition(files[i:i + _GROUP]) for i in range(0, len(files), _GROUP)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from (tuple(f) for f in partition.value)


class LandedDumps(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


def admitted_files(spark: SparkSession, landing: str, segment: str, ext: str, log: str, max_bytes: int | None = None,
                   max_files: int | None = None) -> DataFrame:
    """Streaming (path, length, admission) of the dumps under ``landing``; ``log`` holds the admissions."""
    spark.dataSource.register(LandedDumps)
    options = {"path": landing, "segment": segment, "ext": ext, "log": log, "max_bytes": max_bytes or 0, "max_files": max_files or 0}
    return spark.readStream.format(NAME).options(**{k: str(v) for k, v in options.items()}).load()
