"""A topic kept as stored segments with offsets, and a stream source that reads it.

Messages are numbered in the order of their segments. The source starts at the earliest or latest
message or at a number, reads a bounded count per batch, and goes on from the checkpoint. It is the one
place beside `streaming.state` where Python runs inside Spark: sources have no column form.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import DataStreamReader

from wardline.sources.store import folder_names

NAME = "wardline_segments"
SCHEMA = "value string, offset bigint"
# Messages that a task reads.
SLICE = 100_000


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears when it is complete."""
    files, hidden = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(hidden)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(hidden, _hadoop(spark, path)[1]):
        raise FileExistsError(path)


def end_offset(spark: SparkSession, path: str) -> int:
    """The number that the next message will have."""
    names = sorted(n for n in folder_names(spark, f"{path}/index") if n.endswith(".json"))
    return int(names[-1].split("-")[1].removesuffix(".json")) if names else 0


def append_messages(messages: DataFrame, path: str, value: str = "value") -> tuple[int, int]:
    """Adds a segment; the offsets of its first message and of the one after its last.

    Files are written first and the index entry that numbers their messages last. One writer at a
    time: of two entries with the same start only one can be made.
    """
    spark = messages.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    messages.select(F.col(value).cast("string").alias("value")).write.parquet(f"{path}/{folder}")
    file = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    counts = spark.read.schema("value string").parquet(f"{path}/{folder}").groupBy(file).count()
    files = [(f"{folder}/{r.file}", r["count"]) for r in counts.orderBy("file").collect()]
    start = end_offset(spark, path)
    end = start + sum(n for _, n in files)
    if files:
        entry = json.dumps({"start": start, "files": files})
        _write_whole(spark, f"{path}/index/{start:020d}-{end:020d}.json", entry)
    return start, end


@dataclass
class Slice(InputPartition):
    """Some messages of a file: the offset of the first, and which rows they are."""

    file: str
    offset: int
    first: int
    count: int


def _opened(path: str):
    """The file system of a path, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class SegmentReader(DataSourceStreamReader):
    """Offsets are message numbers. Files are opened by pyarrow's file systems, so any that it knows will do."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.starting = options.get("startingOffsets", "latest")
        self.most = int(options.get("maxOffsetsPerTrigger", 0))
        self.checkpoint = options.get("checkpoint")
        self.start: int | None = None
        self.position: int | None = None

    def _entries(self, start: int, end: int) -> list[tuple[int, int, str]]:
        """(start, end, name) of the index entries with messages of a range, by their names alone."""
        from pyarrow import fs

        files, root = _opened(self.path)
        found = files.get_file_info(fs.FileSelector(f"{root}/index", allow_not_found=True))
        names = [f.base_name for f in found if f.base_name.endswith(".json")]
        parts = [(*map(int, n.removesuffix(".json").split("-")), n) for n in names]
        return sorted(p for p in parts if p[0] < end and p[1] > start)

    def _end(self) -> int:
        return max((end for _, end, _ in self._entries(0, 1 << 62)), default=0)

    def _planned(self) -> int | None:
        """The end of the last batch in the query's checkpoint, where it has one."""
        from pyarrow import fs

        if not self.checkpoint:
            return None
        files, root = _opened(self.checkpoint.rstrip("/"))
        found = files.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
        numbers = [int(f.base_name) for f in found if f.base_name.isdigit()]
        if not numbers:
            return None
        with files.open_input_stream(f"{root}/offsets/{max(numbers)}") as file:
            lines = file.read().decode().splitlines()
        return min((json.loads(x)["offset"] for x in lines if x.startswith('{"offset"')), default=None)

    def initialOffset(self) -> dict:
        """Where a query without a checkpoint starts."""
        if self.start is None:
            self.start = {"earliest": 0, "latest": None}.get(self.starting, self.starting)
            self.start = self._end() if self.start is None else int(self.start)
        return {"offset": self.start}

    def latestOffset(self) -> dict:
        """The end of the next batch. What was given last is read by the time this is asked again."""
        if self.position is None:
            planned = self._planned()
            self.position = self.initialOffset()["offset"] if planned is None else planned
        end = self._end()
        if self.most:
            end = min(end, self.position + self.most)
        self.position = max(end, self.position)
        return {"offset": self.position}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        first, last = start["offset"], end["offset"]
        files, root = _opened(self.path)
        out = []
        for _, _, name in self._entries(first, last):
            with files.open_input_stream(f"{root}/index/{name}") as file:
                entry = json.loads(file.read())
            at = entry["start"]
            for file_name, rows in entry["files"]:
                low, high = max(first, at), min(last, at + rows)
                for begin in range(low, high, SLICE):
                    out.append(Slice(f"{root}/{file_name}", begin, begin - at, min(SLICE, high - begin)))
                at += rows
        return out

    def read(self, partition: Slice):
        import pyarrow as pa
        import pyarrow.parquet as pq

        files, _ = _opened(self.path)
        skip, left, offset = partition.first, partition.count, partition.offset
        with files.open_input_file(partition.file) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=["value"]):
                if skip >= batch.num_rows:
                    skip -= batch.num_rows
                    continue
                some = batch.column(0).slice(skip, left)
                skip = 0
                numbers = pa.array(range(offset, offset + len(some)), pa.int64())
                yield pa.record_batch([some.cast(pa.string()), numbers], names=["value", "offset"])
                offset, left = offset + len(some), left - len(some)
                if not left:
                    break


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)


def read_segments(
    spark: SparkSession, path: str, starting: str | int = "latest", per_trigger: int | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Stream of (value, offset) of the messages stored in `path`.

    `starting`: "earliest", "latest" or a number, used when a query has no checkpoint yet.
    `per_trigger` bounds a batch; it needs the query's checkpoint folder, to know where a restart goes
    on. A query that ends with the input (`availableNow`) is not bounded: its batch takes all.
    """
    spark.dataSource.register(SegmentSource)
    reader: DataStreamReader = spark.readStream.format(NAME).option("startingOffsets", str(starting))
    if per_trigger:
        if checkpoint is None:
            raise ValueError("bounded batches need the query's checkpoint folder")
        reader = reader.option("maxOffsetsPerTrigger", str(per_trigger)).option("checkpoint", checkpoint)
    return reader.load(path)
