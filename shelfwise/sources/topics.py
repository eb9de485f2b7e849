"""Topics kept as files: a streaming source with partitions, offsets and a starting point, and the batch writer of it.

A topic is a folder ``partition=<p>`` per partition with Parquet files of (offset, value), offsets rising without gaps.
Read as a stream it behaves as a message broker's topic does: every partition is one task of a batch, a query starts at
the earliest or latest offsets or at given ones, and goes on from its checkpoint.  Python reads the files, so their
folder must be one that Arrow opens on the driver and the executors (a shared mount, or an Arrow file system's URI).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import dataset as ds
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "topic_files"
SCHEMA = "partition int, offset bigint, value string"
FOLDER = "partition="


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("file:///", "/") if path.startswith("file:") else path)


def _files(path: str) -> dict[int, list[str]]:
    """Data files of every partition."""
    system, root = _opened(path)
    found: dict[int, list[str]] = {}
    for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        folder = info.path.split("/")[-2]
        if info.type == fs.FileType.File and info.path.endswith(".parquet") and folder.startswith(FOLDER):
            found.setdefault(int(folder.removeprefix(FOLDER)), []).append(info.path)
    return found


def _bounds(system: fs.FileSystem, file: str) -> tuple[int, int] | None:
    """First and last offset of a file, from its footer."""
    footer = pq.ParquetFile(system.open_input_file(file)).metadata
    at = footer.schema.names.index("offset")
    groups = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups) if footer.row_group(i).num_rows]
    return (min(g.min for g in groups), max(g.max for g in groups)) if groups else None


@dataclass
class Span(InputPartition):
    """Offsets ``start`` to before ``end`` of one partition."""

    partition: int
    start: int
    end: int


class TopicReader(DataSourceStreamReader):
    """Offsets are, by partition, the next one to be read."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.starting = options.get("startingOffsets", "latest")
        self.known: dict[str, tuple[int, int] | None] = {}

    def _ends(self, first: bool = False) -> dict[str, int]:
        system, _ = _opened(self.path)
        out = {}
        for partition, files in _files(self.path).items():
            for file in files:
                if file not in self.known:  # files are never changed
                    self.known[file] = _bounds(system, file)
            found = [self.known[f] for f in files if self.known[f]]
            if found:
                out[str(partition)] = min(b[0] for b in found) if first else max(b[1] for b in found) + 1
        return out

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return self._ends(first=True)
        return self._ends() if self.starting == "latest" else json.loads(self.starting)

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # A partition that came up later is read from its first offset.
        spans = [Span(int(p), start.get(p, 0), to) for p, to in sorted(end.items())]
        return [s for s in spans if s.start < s.end]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, root = _opened(self.path)
        folder = ds.dataset(f"{root}/{FOLDER}{partition.partition}", filesystem=system, format="parquet")
        wanted = (ds.field("offset") >= partition.start) & (ds.field("offset") < partition.end)
        for batch in folder.to_batches(columns=["offset", "value"], filter=wanted):
            if batch.num_rows:
                number = pa.array([partition.partition] * batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([number, batch.column("offset"), batch.column("value")], names=["partition", "offset", "value"])


class TopicFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TopicReader(self.options)


def topic_stream(spark: SparkSession, path: str, starting: str = "latest") -> DataFrame:
    """partition, offset, value of a topic.  ``starting``: latest, earliest, or offsets by partition as JSON."""
    spark.dataSource.register(TopicFiles)
    return spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting).load()


def append(rows: DataFrame, path: str, partitions: int, value: str = "value") -> None:
    """Adds rows (strings) to a topic behind the offsets it has; rows with equal values share a partition."""
    next_offsets = TopicReader({"path": path})._ends()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, int] = {}
        for batch in batches:
            offsets = []
            for p in batch.column("partition").to_pylist():
                at[p] = at.get(p, next_offsets.get(str(p), 0))
                offsets.append(at[p])
                at[p] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("partition"), pa.array(offsets, pa.int64()), batch.column("value")], names=["partition", "offset", "value"]
            )

    number = F.pmod(F.xxhash64(value), F.lit(partitions)).cast("int")
    # One task a partition, because its offsets are one sequence.
    dealt = rows.select(number.alias("partition"), F.col(value).alias("value")).repartitionById(partitions, F.col("partition"))
    dealt.mapInArrow(numbered, SCHEMA).write.mode("append").partitionBy("partition").parquet(path)
