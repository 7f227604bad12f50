"""`textrange`: text files of any size as pieces of byte ranges that end between code points.

A corpus is the concatenation of the files of a folder, in the order of their names, or one file. A
range is read by one task, in pieces of about `piece` bytes. A piece begins at the first code point
that starts at or after its byte, so pieces neither share nor lose one, whatever the sizes are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tokenloom.sources.tokenbin import open_folder, shared_path

SCHEMA = "doc_id long, text string"
RANGE_BYTES = 128 << 20
PIECE_BYTES = 1 << 20
# Most bytes that a code point goes on for.
CONTINUATION_BYTES = 3


@dataclass
class TextRange(InputPartition):
    """Bytes `start` to `end` of a file whose first byte is byte `base` of the corpus."""

    file: str
    base: int
    start: int
    end: int


def corpus_files(path: str) -> list[tuple[str, int]]:
    """Names and sizes of the files of a corpus, in its order; hidden ones are left out."""
    fs, folder = open_folder(path)
    if fs.get_file_info(folder).type == pafs.FileType.File:
        return [(folder, fs.get_file_info(folder).size)]
    files = [f for f in fs.get_file_info(pafs.FileSelector(folder)) if f.type == pafs.FileType.File and f.base_name[0] not in "._"]
    return sorted((f.path, f.size) for f in files)


def skipped(data: bytes) -> int:
    """Bytes before the first one that begins a code point."""
    at = 0
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


class TextReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, piece_bytes: int):
        self.path, self.range_bytes, self.piece_bytes = path, range_bytes, piece_bytes

    def partitions(self) -> list[TextRange]:
        ranges, base = [], 0
        for file, size in corpus_files(self.path):
            ranges += [TextRange(file, base, at, min(at + self.range_bytes, size)) for at in range(0, size, self.range_bytes)]
            base += size
        return ranges

    def read(self, partition: TextRange) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(self.path)
        with fs.open_input_file(partition.file) as source:
            for start in range(partition.start, partition.end, self.piece_bytes):
                end = min(start + self.piece_bytes, partition.end)
                # The last code point may end in the bytes of the next piece.
                data = source.read_at(end - start + CONTINUATION_BYTES, start)
                first = skipped(data[:CONTINUATION_BYTES]) if start else 0
                last = end - start + skipped(data[end - start :])
                if first < last:
                    text = data[first:last].decode("utf-8", "replace")
                    columns = [pa.array([partition.base + start]), pa.array([text], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text"])


class TextRanges(DataSource):
    """Options: `path`, `range` and `piece` in bytes."""

    @classmethod
    def name(cls) -> str:
        return "textrange"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TextReader:
        return TextReader(self.options["path"], int(self.options["range"]), int(self.options["piece"]))


def read_text_ranges(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Pieces of a corpus in order by `doc_id`, the byte at which a piece begins; bytes that are not UTF-8 become U+FFFD."""
    spark.dataSource.register(TextRanges)
    reader = spark.read.format("textrange").option("range", range_bytes).option("piece", piece_bytes)
    return reader.load(shared_path(spark, path))
