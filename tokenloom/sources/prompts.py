"""Prompts from files: a file is a prompt, and the end-of-text literal in it stands for its id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.encode import END_OF_TEXT, char_ids_with_special, encode_subwords
from tokenloom.operators.vocab import BOS_ID, EOS_ID, Subwords

# Fixed value: what an empty prompt starts from.
DEFAULT_PROMPT = "\n"
# Literals that a subword prompt may hold, and their ids.
SUBWORD_SPECIALS = {END_OF_TEXT: EOS_ID, "<s>": BOS_ID, "</s>": EOS_ID}


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """`prompt_id` (the file) and `text` of every file below `path`, read whole; an empty file is the default prompt."""
    files = spark.read.text(path, wholetext=True)
    text = F.when(F.col("value") == "", F.lit(DEFAULT_PROMPT)).otherwise(F.col("value"))
    return files.select(F.input_file_name().alias("prompt_id"), text.alias("text"))


def encode_prompts(prompts: DataFrame, vocab: Mapping[str, int], eos: int) -> DataFrame:
    """`ids` of every prompt; none is closed, and an end-of-text literal becomes `eos`."""
    text = F.coalesce(F.nullif(F.col("text"), F.lit("")), F.lit(DEFAULT_PROMPT))
    return prompts.withColumn("ids", char_ids_with_special(text, dict(vocab), eos)).drop("text")


def encode_subword_prompts(prompts: DataFrame, model: Subwords, specials: Mapping[str, int] | None = SUBWORD_SPECIALS) -> DataFrame:
    """`ids` of every prompt; none is closed. Literals of `specials` become their ids, or ordinary text without them.

    White space alone has no subwords: such a prompt is empty, and starts from the begin id when it is fanned out.
    """
    return encode_subwords(prompts, model, None, specials=specials).drop("len")
