"""Dataset metadata: one row with the fields of subword and character datasets alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA = (
    "vocab_size int, tokenizer_model string, eos_id int, bos_id int, pad_id int, unk_id int, "
    "stoi map<string,int>, itos map<int,string>"
)
# Fixed value: vocabulary size of a model whose dataset has no metadata.
DEFAULT_VOCAB_SIZE = 50304


def char_metadata(vocab: DataFrame) -> DataFrame:
    """Metadata of a character dataset; the alphabet is bounded by the 16-bit id range."""
    entries = vocab.agg(F.sort_array(F.collect_list(F.struct("id", "token"))).alias("e"))
    return entries.select(
        F.size("e").alias("vocab_size"),
        F.map_from_entries(F.transform("e", lambda s: F.struct(s["token"], s["id"]))).alias("stoi"),
        F.map_from_entries("e").alias("itos"),
    )


def subword_metadata(spark: SparkSession, vocab_size: int, model_path: str, eos: int, bos: int, pad: int, unk: int) -> DataFrame:
    return spark.createDataFrame(
        [(vocab_size, model_path, eos, bos, pad, unk)],
        "vocab_size int, tokenizer_model string, eos_id int, bos_id int, pad_id int, unk_id int",
    )


def write_metadata(meta: DataFrame, path: str) -> None:
    """One parquet row; fields the dataset does not have stay null."""
    wanted = StructType.fromDDL(SCHEMA)
    row = meta.select(*[F.col(f.name) if f.name in meta.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])
    row.coalesce(1).write.mode("errorifexists").parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def model_vocab_size(meta: DataFrame) -> DataFrame:
    """The vocabulary size of the metadata, or the default where it is missing."""
    return meta.agg(F.coalesce(F.max("vocab_size"), F.lit(DEFAULT_VOCAB_SIZE)).alias("vocab_size"))
