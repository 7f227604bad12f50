"""`tokenbin`: flat little-endian 16-bit token files with a manifest, as a Spark data source.

Each write task turns its runs of consecutive chunks into files and the commit lists them in
`manifest.json`, so files of failed or repeated tasks are never read.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

SCHEMA = "split string, chunk_id long, tokens array<int>"
MANIFEST = "manifest.json"
# Chunks per input partition, and chunks per Arrow batch of a reader.
PARTITION_BYTES = 128 << 20
BATCH_CHUNKS = 256
# Windows that a task reads.
WINDOWS_PER_PART = 4096


@dataclass
class Shard:
    """A file of consecutive chunks of one split."""

    split: str
    first_chunk: int
    tokens: int
    file: str


@dataclass
class Written(WriterCommitMessage):
    shards: list[Shard]


@dataclass
class ByteRange(InputPartition):
    shard: Shard
    start: int
    tokens: int


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI; a plain path and `file:/...` are local."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, path: str, block: int):
        self.path, self.block = path, block

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_folder(self.path)
        attempt = uuid.uuid4().hex
        shards: list[Shard] = []
        stream, expected = None, None
        for batch in iterator:
            if batch.num_rows == 0:
                continue
            chunk_ids = batch.column("chunk_id").to_numpy()
            splits = batch.column("split").to_numpy(zero_copy_only=False)
            tokens = batch.column("tokens")
            ends = tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
            values = tokens.flatten().to_numpy()
            if values.size and (values.min() < 0 or values.max() > 0xFFFF):
                raise ValueError("token id does not fit 16 bits")
            data = values.astype("<u2")
            # A file goes on while full chunks of a split follow one another.
            follows = (splits[1:] == splits[:-1]) & (np.diff(chunk_ids) == 1) & (np.diff(ends)[:-1] == self.block)
            starts = np.flatnonzero(np.concatenate([[True], ~follows]))
            for first, last in zip(starts, [*starts[1:], batch.num_rows]):
                split, chunk = splits[first], int(chunk_ids[first])
                if (split, chunk) != expected:
                    if stream:
                        stream.close()
                    shards.append(Shard(split, chunk, 0, f"{split}-{chunk:012d}-{attempt}.bin"))
                    stream = fs.open_output_stream(f"{folder}/{shards[-1].file}")
                stream.write(data[ends[first] : ends[last]].tobytes())
                shards[-1].tokens += int(ends[last] - ends[first])
                full = ends[last] - ends[last - 1] == self.block
                expected = (split, int(chunk_ids[last - 1]) + 1) if full else None
        if stream:
            stream.close()
        return Written(shards)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder = open_folder(self.path)
        shards = sorted((s for m in messages if m for s in m.shards), key=lambda s: (s.split, s.first_chunk))
        manifest = {"block": self.block, "shards": [asdict(s) for s in shards]}
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(manifest).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder = open_folder(self.path)
        for message in messages:
            for shard in message.shards if message else []:
                fs.delete_file(f"{folder}/{shard.file}")


def read_manifest(path: str) -> tuple[int, list[Shard]]:
    """Tokens of a chunk, and the files in order of split and chunk."""
    fs, folder = open_folder(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as source:
        manifest = json.loads(source.read())
    return manifest["block"], [Shard(**s) for s in manifest["shards"]]


class TokenReader(DataSourceReader):
    """Reads whole chunks; filters on `split` and `chunk_id` choose files and byte ranges before anything is read."""

    def __init__(self, path: str, split: str | None):
        self.path = path
        self.block, shards = read_manifest(path)
        self.shards = [s for s in shards if split in (None, s.split)]
        # Chunks from `first` up to but not including `last` are wanted.
        self.first, self.last = 0, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ())
            value = getattr(f, "value", None)
            if column == ("split",) and isinstance(f, (EqualTo, In)):
                names = {value} if isinstance(f, EqualTo) else set(value)
                self.shards = [s for s in self.shards if s.split in names]
            elif column == ("chunk_id",) and isinstance(f, EqualTo):
                self.first, self.last = max(self.first, value), min(self.last, value + 1)
            elif column == ("chunk_id",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, value + isinstance(f, GreaterThan))
            elif column == ("chunk_id",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.last = min(self.last, value + isinstance(f, LessThanOrEqual))
            else:
                yield f

    def partitions(self) -> list[ByteRange]:
        step = max(1, PARTITION_BYTES // (2 * self.block)) * self.block
        ranges = []
        for shard in self.shards:
            low = max(self.first - shard.first_chunk, 0) * self.block
            high = min(shard.tokens, (self.last - shard.first_chunk) * self.block)
            ranges += [ByteRange(shard, start, min(step, high - start)) for start in range(low, high, step)]
        return ranges

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(self.path)
        shard, block = partition.shard, self.block
        step = BATCH_CHUNKS * block
        with fs.open_input_file(f"{folder}/{shard.file}") as source:
            for start in range(partition.start, partition.start + partition.tokens, step):
                count = min(step, partition.start + partition.tokens - start)
                values = np.frombuffer(source.read_at(2 * count, 2 * start), dtype="<u2").astype(np.int32)
                ends = np.append(np.arange(0, count, block), count).astype(np.int32)
                chunks = shard.first_chunk + start // block + np.arange(len(ends) - 1)
                yield pa.record_batch(
                    [
                        pa.array([shard.split] * len(chunks)),
                        pa.array(chunks, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    ],
                    names=["split", "chunk_id", "tokens"],
                )


class TokenBin(DataSource):
    """Options: `path`; `block` when writing; `split` to read one split."""

    @classmethod
    def name(cls) -> str:
        return "tokenbin"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"], self.options.get("split"))

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        path = self.options["path"]
        fs, folder = open_folder(path)
        if fs.get_file_info(f"{folder}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise FileExistsError(f"{path} already holds a token dataset")
        fs.create_dir(folder, recursive=True)
        return TokenWriter(path, int(self.options["block"]))


def shared_path(spark: SparkSession, path: str) -> str:
    """The path as it is if every executor means the same folder by it: it names a file system, or all run here."""
    if "://" not in path and not path.startswith("file:") and not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{path} names no file system, and executors would each write to their own disk")
    return path


def write_tokens(chunks: DataFrame, path: str, block: int, files: int | None = None) -> None:
    """Chunks to flat files, one per run of consecutive chunks of a partition.

    Chunks packed with a `run` are written as they lie. Others need `files`, about how many
    ranges of the stream to shuffle them into first.
    """
    chunks.sparkSession.dataSource.register(TokenBin)
    rows = chunks.select("split", "chunk_id", "tokens")
    if files:
        rows = rows.repartitionByRange(files, "split", "chunk_id").sortWithinPartitions("split", "chunk_id")
    folder = shared_path(chunks.sparkSession, path)
    rows.write.format("tokenbin").mode("append").option("block", block).save(folder)


def read_tokens(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Chunks of a dataset. Lets this session's Python sources see filters, as those on `split` and `chunk_id` save reading."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenBin)
    reader = spark.read.format("tokenbin")
    return (reader.option("split", split) if split else reader).load(shared_path(spark, path))


@dataclass(frozen=True)
class Place:
    """Files of a split by their first token."""

    starts: list[int]
    shards: list[Shard]
    block: int

    def pieces(self, offset: int, count: int) -> Iterator[tuple[Shard, int, int]]:
        """(file, first token in it, tokens) of a run of tokens, which may go on in the files after the first."""
        at = bisect_right(self.starts, offset) - 1
        while count:
            if not 0 <= at < len(self.shards) or not 0 <= offset - self.starts[at] < self.shards[at].tokens:
                raise ValueError("a window ends beyond the stored tokens")
            inside = offset - self.starts[at]
            taken = min(count, self.shards[at].tokens - inside)
            yield self.shards[at], inside, taken
            offset, count, at = offset + taken, count - taken, at + 1


def read_windows(windows: DataFrame, path: str, block: int, *keys: str, parts: int | None = None) -> DataFrame:
    """`x` and `y` (`x` moved on by one) of every planned window, read from the files by seeking.

    `windows` has `keys`, `split` and `offset`. They are range-partitioned by place, so that a task reads near
    bytes of few files, in order, and nothing but the windows' own: no chunk is joined or read in full.
    """
    spark = windows.sparkSession
    shared_path(spark, path)
    stored, shards = read_manifest(path)
    # One entry per file of the dataset.
    places = {}
    for split in {s.split for s in shards}:
        own = [s for s in shards if s.split == split]
        places[split] = Place([s.first_chunk * stored for s in own], own, stored)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(path)
        name, source = None, None
        for batch in batches:
            splits, offsets = batch.column("split").to_pylist(), batch.column("offset").to_pylist()
            rows = np.empty((batch.num_rows, block + 1), "<u2")
            for row in sorted(range(batch.num_rows), key=lambda i: (splits[i], offsets[i])):
                if splits[row] not in places:
                    raise ValueError(f"no split {splits[row]}")
                filled = 0
                for shard, first, count in places[splits[row]].pieces(offsets[row], block + 1):
                    if shard.file != name:
                        if source:
                            source.close()
                        name, source = shard.file, fs.open_input_file(f"{folder}/{shard.file}")
                    rows[row, filled : filled + count] = np.frombuffer(source.read_at(2 * count, 2 * first), "<u2")
                    filled += count
            ends = pa.array(np.arange(0, (batch.num_rows + 1) * block, block, dtype=np.int32))
            sides = [pa.ListArray.from_arrays(ends, pa.array(rows[:, i : i + block].astype(np.int32).ravel())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sides], [*batch.schema.names, "x", "y"])
        if source:
            source.close()

    planned = windows.select(*keys, "split", "offset")
    parts = parts or max(1, -(-planned.count() // WINDOWS_PER_PART))
    placed = planned.repartitionByRange(parts, "split", "offset").sortWithinPartitions("split", "offset")
    schema = StructType([*planned.schema.fields, *[StructField(n, ArrayType(IntegerType())) for n in "xy"]])
    return placed.mapInArrow(read, schema)
