"""Character vocabularies, word counts and the assembly of a subword vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.functions import text as T
from tokenloom.functions.codepoints import CODE_POINTS, code_points, text_slices
from tokenloom.functions.lookup import ID_LIMIT
from tokenloom.operators.splits import bounded_sample
from tokenloom.sources.documents import sentences

# Reserved ids of a subword vocabulary, followed by 256 byte pieces.
SPECIAL_PIECES = [(0, "<pad>"), (1, "<unk>"), (2, "<s>"), (3, "</s>")]
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3
BYTE_BASE = 4
LEARNED_BASE = BYTE_BASE + 256

SAMPLE_SEED = 2357
SENTENCE_LIMIT = 10_000_000


def _char_histogram(docs: DataFrame) -> DataFrame:
    """`(char, cnt)` of every task: a batch is counted by code point, and a task returns its alphabet once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CODE_POINTS, np.int64)
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                found = np.bincount(code_points(texts)[0])
                counts[: len(found)] += found
        points = np.flatnonzero(counts)
        columns = [pa.array([chr(p) for p in points], pa.string()), pa.array(counts[points])]
        yield pa.RecordBatch.from_arrays(columns, ["char", "cnt"])

    return docs.select("text").mapInArrow(count, "char string, cnt long")


def char_vocab(docs: DataFrame) -> DataFrame:
    """Distinct characters with dense ids in code point order.

    The shuffle carries the alphabets of tasks, and the numbering window holds at most the alphabet.
    """
    distinct = _char_histogram(docs).select(F.col("char").alias("token")).distinct()
    return distinct.select("token", (F.row_number().over(Window.orderBy("token")) - 1).cast("int").alias("id"))


def collect_ids(vocab: DataFrame, token: str = "token") -> dict[str, int]:
    """A vocabulary as a dict; fails beyond the 16-bit id range, before anything is collected."""
    rows = vocab.limit(ID_LIMIT + 1).collect()
    if len(rows) >= ID_LIMIT:
        raise ValueError("vocabulary does not fit 16-bit ids")
    return {r[token]: r["id"] for r in rows}


def char_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each character."""
    return _char_histogram(docs).groupBy("char").agg(F.sum("cnt").alias("cnt"))


def char_coverage(counts: DataFrame, coverage: float = 0.9999) -> DataFrame:
    """Marks the most frequent characters: those with less than `coverage` of the mass before them.

    The window holds one row per character of the alphabet.
    """
    order = Window.orderBy(F.desc("cnt"), "char")
    before = F.coalesce(F.sum("cnt").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("cnt").over(Window.partitionBy())
    return counts.select(
        "char", "cnt", F.row_number().over(order).alias("char_rank"), (before < F.lit(coverage) * total).alias("kept")
    )


def word_counts(docs: DataFrame, limit: int = SENTENCE_LIMIT, max_bytes: int = 16384) -> DataFrame:
    """Distinct units of the sampled sentences with their counts; a task adds up its own words first."""
    sample = bounded_sample(sentences(docs, max_bytes), limit, SAMPLE_SEED, "doc_id", "line_no")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            found = pc.value_counts(pc.split_pattern(batch.column(0), " ").flatten())
            for word, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[word] = counts.get(word, 0) + n
            if len(counts) > WORDS_HELD:
                yield _word_batch(counts)
                counts = {}
        yield _word_batch(counts)

    partial = sample.select(T.units(F.col("line")).alias("units")).mapInArrow(count, "word string, cnt long")
    return partial.where(F.col("word") != "").groupBy("word").agg(F.sum("cnt").alias("cnt"))


# Distinct words that a task adds up before it hands them on.
WORDS_HELD = 500_000


def _word_batch(counts: dict[str, int]) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "cnt"])


@dataclass(frozen=True)
class Subwords:
    """A learned subword model: merges by rank, and the characters kept by coverage, most frequent first."""

    merges: list[tuple[str, str]]
    alphabet: list[str]

    def learned_pieces(self) -> list[str]:
        """Merged pieces by rank, then characters by frequency; a string reached twice keeps its first id."""
        return list(dict.fromkeys([a + b for a, b in self.merges] + self.alphabet))

    def piece_ids(self) -> dict[str, int]:
        return {piece: LEARNED_BASE + i for i, piece in enumerate(self.learned_pieces())}

    @property
    def size(self) -> int:
        return LEARNED_BASE + len(self.learned_pieces())


def assemble_vocab(spark: SparkSession, model: Subwords) -> DataFrame:
    """`(id, piece, kind)`: specials, bytes, learned pieces, characters."""
    if model.size >= ID_LIMIT:
        raise ValueError("vocabulary does not fit 16-bit ids")
    specials = spark.createDataFrame(SPECIAL_PIECES, "id int, piece string").withColumn("kind", F.lit("special"))
    byte_pieces = spark.range(256).select(
        (F.col("id") + BYTE_BASE).cast("int").alias("id"),
        F.concat(F.lit("<0x"), F.lpad(F.hex("id"), 2, "0"), F.lit(">")).alias("piece"),
        F.lit("byte").alias("kind"),
    )
    merged = {a + b for a, b in model.merges}
    learned = spark.createDataFrame(
        [(i, p, "merge" if p in merged else "char") for p, i in model.piece_ids().items()],
        "id int, piece string, kind string",
    )
    return specials.unionByName(byte_pieces).unionByName(learned)


def write_subwords(spark: SparkSession, model: Subwords, path: str) -> None:
    """The model as two tables: `vocab` and `merges`."""
    assemble_vocab(spark, model).write.mode("errorifexists").parquet(f"{path}/vocab")
    merges = [(rank, a, b) for rank, (a, b) in enumerate(model.merges, 1)]
    spark.createDataFrame(merges, "rank int, left string, right string").write.mode("errorifexists").parquet(
        f"{path}/merges"
    )


def read_subwords(spark: SparkSession, path: str) -> Subwords:
    """The model from its tables, which must hold fewer rows than there are 16-bit ids."""
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").limit(ID_LIMIT + 1).collect()
    pieces = spark.read.parquet(f"{path}/vocab").where("kind = 'char'").orderBy("id").limit(ID_LIMIT + 1).collect()
    if len(merges) + len(pieces) > ID_LIMIT:
        raise ValueError("the stored model does not fit 16-bit ids")
    learned = [r["left"] + r["right"] for r in merges]
    return Subwords([(r["left"], r["right"]) for r in merges], [r["piece"] for r in pieces if r["piece"] not in learned])
