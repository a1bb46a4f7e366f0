"""A streaming source that follows growing line files by byte offset: ``spark.readStream.format("tail")``.

The file source of Spark takes a file once; this one reads on where it stopped. A last line without its line break is
held back until the break is there, so no record is torn. Offsets are part of the stream's checkpoint: each line comes
once, also after a restart. A file that has become shorter was replaced and is read from its start.
"""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

BLOCK = 1 << 16


class Span(InputPartition):
    """Lines of ``file`` that begin in bytes ``start`` to ``end`` of what lies before ``stop``."""

    def __init__(self, file: str, start: int, end: int, first: int, stop: int):
        self.file, self.start, self.end, self.first, self.stop = file, start, end, first, stop


def whole_lines(file: str) -> int:
    """Bytes of ``file`` up to and with its last line break."""
    with open(file, "rb") as f:
        at = f.seek(0, os.SEEK_END)
        while at > 0:
            start = max(0, at - BLOCK)
            f.seek(start)
            found = f.read(at - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            at = start
    return 0


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.pattern = options["path"]
        self.split = int(options.get("splitbytes", 64 << 20))

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        pattern = os.path.join(self.pattern, "*.jsonl") if os.path.isdir(self.pattern) else self.pattern
        return {"files": {file: whole_lines(file) for file in sorted(glob.glob(pattern)) if os.path.isfile(file)}}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        spans = []
        for file, stop in end["files"].items():
            first = start["files"].get(file, 0)
            first = 0 if stop < first else first
            spans += [Span(file, at, min(at + self.split, stop), first, stop) for at in range(first, stop, self.split)]
        return spans

    def read(self, partition: Span) -> Iterator[tuple]:
        with open(partition.file, "rb") as f:
            at = partition.start
            if at > partition.first:  # the line that runs into this span belongs to the one before
                f.seek(at - 1)
                at += len(f.readline()) - 1
            f.seek(at)
            while at < partition.end:
                line = f.readline(partition.stop - at)
                if not line:
                    break
                yield partition.file, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    """``file, offset, value`` of the lines of the files that option ``path`` (a folder or pattern) names.

    Driver and executors open the files by that path, so it lies in a shared folder. ``splitBytes`` bounds what one task reads.
    """

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "file string, offset long, value string"

    def streamReader(self, schema) -> TailReader:
        if "path" not in self.options:
            raise ValueError("tail: option path is missing")
        return TailReader({k.lower(): v for k, v in json.loads(json.dumps(dict(self.options))).items()})


def tail_lines(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """The lines of growing JSON Lines files as a stream ``file, offset, value``."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail").option("path", path).option("splitBytes", split_bytes).load()
