"""A stream that also sees files rewritten in place.

Spark's file source takes each path once.  This Python data source streams
(path, modification time) pairs: a file is new again when it is rewritten.

* Offsets.  An offset is the newest modification time seen and the paths that
  have exactly that time.  A batch holds the files that are newer, or as new
  and not among those paths; the offset does not grow with the folder.
* Listing is done by the reader on the driver, once per micro-batch (names and
  times only); the files themselves are read by the executors, with Spark's
  JSON reader and its file splits.
* Exactly once.  A replayed micro-batch lists the same range of times, and the
  upsert is last-write-wins by (modification time, path): applying a batch
  again changes nothing.  A file rewritten between the two is read as it now
  is, and comes again in a later batch by its new time.

Folders are listed with ``pyarrow.fs`` (local paths, hdfs, s3, gcs).  Files
that appear with a modification time older than the newest one seen (copied
with their times kept) are not found: use the ledger loader (W1) for those.
"""

from __future__ import annotations

import fnmatch
import json
import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from barrio.sources.files import read_jsonl
from barrio.sources.upsert import upsert

# the reader runs in Python workers, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "file_versions"


class Listed(InputPartition):
    """The files of a range of offsets."""

    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class FileVersions(DataSource):
    """Streams (path string, modified timestamp) of files as they come and change.

    Options: ``path`` (the folder), ``pattern`` (of base names, default ``*``)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "path string, modified timestamp"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FileVersionsReader(self.options["path"], self.options.get("pattern", "*"))


class FileVersionsReader(DataSourceStreamReader):
    def __init__(self, folder: str, pattern: str):
        self.folder, self.pattern = folder, pattern

    def _listed(self) -> list[tuple[int, str]]:
        """(microseconds, path) of every file, oldest first."""
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        prefix = self.folder[:len(self.folder) - len(root)] if self.folder.endswith(root) else ""
        infos = where.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return sorted((f.mtime_ns // 1000, prefix + f.path) for f in infos
                      if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.pattern)
                      and not f.base_name.startswith((".", "_")) and "/_" not in f.path[len(root):])

    @staticmethod
    def _after(listed: list[tuple[int, str]], offset: dict) -> list[tuple[int, str]]:
        return [(t, p) for t, p in listed if t > offset["time"] or (t == offset["time"] and p not in offset["paths"])]

    def initialOffset(self) -> dict:
        return {"time": -1, "paths": "[]"}

    @staticmethod
    def _parsed(offset: dict) -> dict:
        return {"time": int(offset["time"]), "paths": set(json.loads(offset["paths"]))}

    def latestOffset(self) -> dict:
        listed = self._listed()
        if not listed:
            return self.initialOffset()
        newest = listed[-1][0]
        return {"time": newest, "paths": json.dumps(sorted(p for t, p in listed if t == newest))}

    def partitions(self, start: dict, end: dict) -> list[Listed]:
        first, last = self._parsed(start), self._parsed(end)
        files = [(p, t) for t, p in self._after(self._listed(), first)
                 if t < last["time"] or (t == last["time"] and p in last["paths"])]
        return [Listed(files)] if files else []

    def read(self, partition: Listed) -> Iterator[tuple]:
        import datetime as dt

        for path, micros in partition.files:
            yield path, dt.datetime.fromtimestamp(micros / 1_000_000, dt.timezone.utc)


def stream_changed_files(spark: SparkSession, source_dir: str, schema: StructType | str, table_path: str,
                         keys: Sequence[str], checkpoint: str, pattern: str = "*.json",
                         partition_col: str | None = None, key_buckets: int | None = None,
                         version: Sequence[Column | str] | None = None, changes: bool = False) -> int:
    """Upsert the files that came or were rewritten since the last run; how many.

    The newest file wins for a key, so a file rewritten with fewer rows replaces
    the rows it still holds and leaves the others as they were."""
    spark.dataSource.register(FileVersions)
    seen = []

    def apply(batch: DataFrame, epoch_id: int) -> None:
        paths = [r.path for r in batch.select("path").distinct().collect()]
        if not paths:
            return
        rows = (read_jsonl(batch.sparkSession, paths, schema)
                .withColumn("_src_path", F.col("_metadata.file_path"))
                .withColumn("_src_mtime", F.col("_metadata.file_modification_time")))
        upsert(batch.sparkSession, rows, table_path, keys, version or ["_src_mtime", "_src_path"], partition_col,
               key_buckets, changes)
        seen.extend(paths)

    while True:
        before = len(seen)
        q = (spark.readStream.format(NAME).option("pattern", pattern).load(source_dir).writeStream.foreachBatch(apply)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        # a run that replays a failed batch ends with it
        if len(seen) == before:
            return len(seen)
