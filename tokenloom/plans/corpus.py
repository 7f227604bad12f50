"""Queries over documents: cleaning, profile, splits, characters and words."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.functions import text as T
from tokenloom.functions.arrays import digest, joined
from tokenloom.functions.normalize import compose_with_places
from tokenloom.operators import packing, profile, splits, vocab
from tokenloom.operators.encode import (
    END_OF_TEXT,
    char_ids,
    char_ids_or_bytes,
    char_ids_with_special,
    decode_chars,
    encode_documents,
)
from tokenloom.operators.ordered import ranged_prefix_sum
from tokenloom.plans import sqlparts as S
from tokenloom.plans.tables import VAL_FRACTION, char_tokens, documents, documents_with
from tokenloom.session import scratch_path
from tokenloom.sources.documents import clean, read_corpus_lines, sentences, write_corpus_text

# Characters that `composed_text` takes apart, and what it puts for `fi` and the digits.
ACCENTED = list("áéíóúàèìòùâêîôûäëïöüñç")
LIGATURE = "ﬁ"
WIDE_DIGITS = "０１２３４５６７８９"
SAMPLE_SIZE = 2000
SHARDS = 64


def corpus_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean(documents(spark, sf)).where(F.col("text") != "")


def corpus_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.corpus_profile(documents(spark, sf)).withColumn("corpus_mb", F.round("corpus_mb", 9))


def corpus_text(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "corpus-text")
    write_corpus_text(documents(spark, sf), path)
    return read_corpus_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("cnt"))


def text_offsets(spark: SparkSession, sf: str) -> DataFrame:
    lengths = documents(spark, sf).select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("chars"))
    return ranged_prefix_sum(lengths, ["doc_id"], F.col("chars"), "char_start")


def sentence_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sentences(documents(spark, sf)).withColumn("n_bytes", F.octet_length("line"))


def sentence_sample(spark: SparkSession, sf: str) -> DataFrame:
    lines = sentences(documents(spark, sf))
    return splits.bounded_sample(lines, SAMPLE_SIZE, vocab.SAMPLE_SEED, "doc_id", "line_no").select(
        "doc_id", "line_no", "order_key", "line"
    )


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.random_split(documents(spark, sf).select("doc_id"), VAL_FRACTION)


def shuffled_order(spark: SparkSession, sf: str) -> DataFrame:
    """Position of every document in the shuffled order, written in that order and read file by file."""
    path = scratch_path(spark, "shuffled")
    splits.shuffled(random_split(spark, sf)).write.parquet(path)
    stored = spark.read.parquet(path).select("split", "doc_id", "order_key", F.input_file_name().alias("file"))
    place = Window.partitionBy("split", "file").orderBy("order_key", "doc_id")
    # The files follow each other in the order of their names.
    sizes = stored.groupBy("split", "file").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("split").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("split", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = stored.withColumn("local", F.row_number().over(place)).join(before, ["split", "file"])
    return numbered.select("split", "doc_id", (F.col("before") + F.col("local") - 1).alias("position"))


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return random_split(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("num_rows"))


def sequential_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.sequential_split(documents(spark, sf))


def shards(spark: SparkSession, sf: str) -> DataFrame:
    return splits.shards(random_split(spark, sf), SHARDS)


def char_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.char_vocab(clean(documents(spark, sf)))


def char_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.char_coverage(vocab.char_counts(clean(documents(spark, sf))))


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.word_counts(documents(spark, sf))


def char_encode(spark: SparkSession, sf: str) -> DataFrame:
    encoded, _, _ = char_tokens(spark, sf)
    return encoded.select("doc_id", "split", "len", digest(F.col("ids")).alias("ids_md5"))


def char_encode_ordinary(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).withColumn("text", F.coalesce("text", F.lit("")))
    ids = vocab.collect_ids(vocab.char_vocab(docs))
    encoded = encode_documents(docs, char_ids(F.col("text"), ids), len(ids), keep_empty=True)
    return encoded.select("doc_id", "len", digest(F.col("ids")).alias("ids_md5"))


def special_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents_with(spark, sf, "lang").withColumn("text", F.concat("text", F.lit(END_OF_TEXT), "lang"))
    ids = vocab.collect_ids(vocab.char_vocab(docs))
    special = char_ids_with_special(F.col("text"), ids, len(ids))
    return docs.select(
        "doc_id",
        F.size(char_ids(F.col("text"), ids)).alias("len_ordinary"),
        F.size(special).alias("len_special"),
        digest(special).alias("ids_md5"),
    )


def byte_fallback(spark: SparkSession, sf: str) -> DataFrame:
    docs = clean(documents(spark, sf))
    kept = vocab.char_coverage(vocab.char_counts(docs)).where("kept")
    ids = vocab.collect_ids(kept.select("char", (F.col("char_rank") + vocab.LEARNED_BASE - 1).alias("id")), "char")
    encoded = char_ids_or_bytes(F.col("text"), ids)
    return docs.select("doc_id", encoded.alias("ids")).select(
        "doc_id", F.size("ids").alias("len"), digest(F.col("ids")).alias("ids_md5")
    )


def char_decode(spark: SparkSession, sf: str) -> DataFrame:
    encoded, ids, _ = char_tokens(spark, sf)
    return encoded.select("doc_id", decode_chars(F.col("ids"), ids).alias("text"))


def char_pieces(spark: SparkSession, sf: str) -> DataFrame:
    docs = clean(documents(spark, sf))
    ids = vocab.collect_ids(vocab.char_vocab(docs))
    return docs.select(
        "doc_id",
        joined(F.slice(char_ids(F.col("text"), ids), 1, 20)).alias("first_ids"),
        F.array_join(F.slice(T.characters(F.col("text")), 1, 15), "|").alias("first_pieces"),
    )


def composed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Documents spelled with accents apart, ligatures and wide digits, composed again, with the places they come from."""
    spelled = F.coalesce("text", F.lit(""))
    for character in ACCENTED:
        spelled = F.replace(spelled, F.lit(character), F.lit(unicodedata.normalize("NFD", character)))
    spelled = F.translate(F.replace(spelled, F.lit("fi"), F.lit(LIGATURE)), "0123456789", WIDE_DIGITS)
    docs = documents(spark, sf).select("doc_id", spelled.alias("source"))
    made = docs.select("doc_id", "source", compose_with_places(F.col("source")).alias("c"))
    return made.select(
        "doc_id",
        F.char_length("source").alias("n_source"),
        F.char_length("c.text").alias("n_chars"),
        F.md5("c.text").alias("text_md5"),
        F.aggregate("c.starts", F.lit(0).cast("long"), lambda total, s: total + s).alias("place_sum"),
    )


def split_token_stats(spark: SparkSession, sf: str) -> DataFrame:
    encoded, _, _ = char_tokens(spark, sf)
    stats = profile.split_token_stats(encoded)
    return stats.select(
        "split",
        "num_rows",
        "total_tokens",
        F.round("avg_tokens", 6).alias("avg_tokens"),
        F.round("stream_gb", 12).alias("stream_gb"),
    )


def stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    encoded, _, _ = char_tokens(spark, sf)
    offsets = packing.stream_offsets(encoded.select("split", "order_key", "doc_id", "len"))
    return offsets.select("split", "doc_id", "len", "stream_start")


QUERIES = {
    "corpus_clean": corpus_clean,
    "corpus_profile": corpus_profile,
    "corpus_text": corpus_text,
    "text_offsets": text_offsets,
    "sentences": sentence_rows,
    "sentence_sample": sentence_sample,
    "random_split": random_split,
    "shuffled_order": shuffled_order,
    "split_counts": split_counts,
    "sequential_split": sequential_split,
    "shards": shards,
    "char_vocab": char_vocab,
    "char_coverage": char_coverage,
    "word_counts": word_counts,
    "char_encode": char_encode,
    "char_encode_ordinary": char_encode_ordinary,
    "special_tokens": special_tokens,
    "byte_fallback": byte_fallback,
    "char_decode": char_decode,
    "char_pieces": char_pieces,
    "composed_text": composed_text,
    "split_token_stats": split_token_stats,
    "stream_offsets": stream_offsets,
}

RAW_VOCAB = """vocab AS (
    SELECT c, row_number() OVER (ORDER BY c) - 1 AS id
    FROM (SELECT DISTINCT unnest(string_split({text}, '')) AS c FROM documents WHERE text <> ''))"""

COVERAGE = """coverage AS (
    SELECT c AS char, cnt, row_number() OVER (ORDER BY cnt DESC, c) AS char_rank,
           coalesce(sum(cnt) OVER (ORDER BY cnt DESC, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             < 0.9999::DOUBLE * sum(cnt) OVER () AS kept
    FROM (SELECT c, count(*) AS cnt FROM chars GROUP BY c))"""

ORACLE = {
    "shuffled_order": f"""WITH {S.SPLITS}
        SELECT split, doc_id, row_number() OVER (PARTITION BY split ORDER BY k, doc_id) - 1 AS position FROM splits""",
    "corpus_clean": f"WITH {S.CLEAN} SELECT doc_id, t AS text FROM clean WHERE t <> ''",
    "corpus_profile": f"""WITH {S.CLEAN}
        SELECT count(*) AS num_rows, count(*) FILTER (t <> '') AS docs_written,
               sum(length(t))::BIGINT AS total_chars,
               round(sum(strlen(t) + 1) FILTER (t <> '') / 1048576.0::DOUBLE, 9) AS corpus_mb
        FROM clean""",
    "corpus_text": f"""WITH {S.CLEAN}
        SELECT line, count(*) AS cnt FROM (
            SELECT unnest(string_split(t, chr(10))) AS line FROM clean WHERE t <> '') GROUP BY line""",
    "text_offsets": """
        SELECT doc_id, length(coalesce(text, ''))::INTEGER AS chars,
               coalesce(sum(length(coalesce(text, ''))) OVER (
                   ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start
        FROM documents""",
    "sentences": f"""WITH {S.CLEAN}, {S.LINES}
        SELECT doc_id, line_no::INTEGER AS line_no, line, strlen(line)::INTEGER AS n_bytes FROM lines""",
    "sentence_sample": f"""WITH {S.CLEAN}, {S.LINES}
        SELECT doc_id, line_no::INTEGER AS line_no, md5('2357:' || doc_id || ':' || line_no) AS order_key, line
        FROM lines ORDER BY order_key LIMIT {SAMPLE_SIZE}""",
    "random_split": f"WITH {S.SPLITS} SELECT doc_id, k AS order_key, split FROM splits",
    "split_counts": f"WITH {S.SPLITS} SELECT split, count(*) AS num_rows FROM splits GROUP BY split",
    "sequential_split": """WITH ends AS (
            SELECT doc_id, text, sum(length(text)) OVER (ORDER BY doc_id) AS e,
                   floor(0.9::DOUBLE * sum(length(text)) OVER ())::BIGINT AS cut
            FROM documents)
        SELECT doc_id, 'train' AS split, CASE WHEN e <= cut THEN text ELSE left(text, (cut - e + length(text))::BIGINT) END AS text
        FROM ends WHERE e - length(text) < cut
        UNION ALL
        SELECT doc_id, 'val', CASE WHEN e - length(text) >= cut THEN text ELSE right(text, (e - cut)::BIGINT) END
        FROM ends WHERE e > cut""",
    "shards": f"""WITH {S.SPLITS}, n AS (SELECT split, count(*) AS n FROM splits GROUP BY split)
        SELECT split, doc_id, row_number() OVER (ORDER BY k, doc_id) - 1 AS row_index,
               ntile(least({SHARDS}, (SELECT n FROM n WHERE split = 'train'))) OVER (ORDER BY k, doc_id) - 1 AS shard
        FROM splits WHERE split = 'train'
        UNION ALL
        SELECT split, doc_id, row_number() OVER (ORDER BY k, doc_id) - 1,
               ntile(least({SHARDS}, (SELECT n FROM n WHERE split = 'val'))) OVER (ORDER BY k, doc_id) - 1
        FROM splits WHERE split = 'val'""",
    "char_vocab": f"WITH {S.CLEAN}, {S.VOCAB} SELECT c AS token, id::INTEGER AS id FROM vocab",
    "char_coverage": f"""WITH {S.CLEAN}, {S.CHARS}, {COVERAGE}
        SELECT char, cnt, char_rank::INTEGER AS char_rank, kept FROM coverage""",
    "word_counts": f"WITH {S.CLEAN}, {S.LINES}, {S.WORDS} SELECT word, cnt FROM words",
    "char_encode": f"""WITH {S.TOKENS}, {S.SPLITS}
        SELECT d.doc_id, split, count(pos)::INTEGER AS len,
               md5(coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pos), '')) AS ids_md5
        FROM splits d LEFT JOIN enc e ON d.doc_id = e.doc_id GROUP BY d.doc_id, split""",
    "char_encode_ordinary": f"""WITH {RAW_VOCAB.format(text="text")},
        pieces AS (
            SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS pos
            FROM documents WHERE text <> '')
        SELECT d.doc_id, (count(pos) + 1)::INTEGER AS len,
               md5(trim(coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pos), '') || ' ' || {S.EOS})) AS ids_md5
        FROM documents d LEFT JOIN pieces p ON d.doc_id = p.doc_id LEFT JOIN vocab USING (c) GROUP BY d.doc_id""",
    "special_tokens": f"""WITH {RAW_VOCAB.format(text=f"text || '{END_OF_TEXT}' || lang")},
        pieces AS (
            SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS pos
            FROM documents
            UNION ALL
            SELECT doc_id, unnest(string_split(lang, '')),
                   length(text) + 1 + generate_subscripts(string_split(lang, ''), 1) FROM documents),
        ids AS (
            SELECT doc_id, pos, id FROM pieces JOIN vocab USING (c)
            UNION ALL SELECT doc_id, length(text) + 1, {S.EOS} FROM documents)
        SELECT doc_id, (length(any_value(text)) + {len(END_OF_TEXT)} + length(any_value(lang)))::INTEGER AS len_ordinary,
               count(*)::INTEGER AS len_special, md5(string_agg(id::VARCHAR, ' ' ORDER BY pos)) AS ids_md5
        FROM ids JOIN documents USING (doc_id) GROUP BY doc_id""",
    "byte_fallback": f"""WITH {S.CLEAN}, {S.CHARS}, {COVERAGE},
        spelled AS (
            SELECT char, CASE WHEN kept THEN (259 + char_rank)::VARCHAR
                ELSE array_to_string([(('0x' || hex(encode(char))[2 * i - 1:2 * i])::INTEGER + 4)::VARCHAR
                                      for i in range(1, strlen(char) + 1)], ' ') END AS ids
            FROM coverage),
        joined AS (
            SELECT doc_id, string_agg(ids, ' ' ORDER BY pos) AS ids
            FROM chars JOIN spelled ON c = char GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN ids IS NULL THEN 0 ELSE len(string_split(ids, ' ')) END::INTEGER AS len,
               md5(coalesce(ids, '')) AS ids_md5
        FROM clean d LEFT JOIN joined USING (doc_id)""",
    "char_decode": f"WITH {S.CLEAN} SELECT doc_id, t AS text FROM clean",
    "char_pieces": f"""WITH {S.CLEAN}, {S.VOCAB}, {S.CHARS}
        SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY pos) FILTER (pos <= 20) AS first_ids,
               string_agg(c, '|' ORDER BY pos) FILTER (pos <= 15) AS first_pieces
        FROM chars JOIN vocab USING (c) GROUP BY doc_id""",
    "composed_text": f"""WITH tokens AS (
            SELECT doc_id, t, n, length(t) AS made,
                   CASE WHEN t = 'fi' THEN 1 WHEN list_contains({ACCENTED}, t) THEN 2 ELSE 1 END AS taken
            FROM (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS n
                  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?s:fi|.)') AS w FROM documents))),
        placed AS (SELECT *, sum(taken) OVER (PARTITION BY doc_id ORDER BY n) - taken AS start FROM tokens),
        sums AS (SELECT doc_id, sum(taken) AS n_source, sum(start * made) AS place_sum FROM placed GROUP BY doc_id)
        SELECT doc_id, coalesce(n_source, 0)::INTEGER AS n_source, length(coalesce(text, ''))::INTEGER AS n_chars,
               md5(coalesce(text, '')) AS text_md5, coalesce(place_sum, 0)::BIGINT AS place_sum
        FROM documents LEFT JOIN sums USING (doc_id)""",
    "split_token_stats": f"""WITH {S.CLEAN}, {S.SPLITS}, lens AS (
            SELECT split, CASE WHEN t = '' THEN 0 ELSE length(t) + 1 END AS n FROM clean JOIN splits USING (doc_id))
        SELECT split, count(*) AS num_rows, sum(n)::BIGINT AS total_tokens, round(avg(n), 6) AS avg_tokens,
               round(sum(n) * 2 / 1073741824.0::DOUBLE, 12) AS stream_gb
        FROM lens GROUP BY split""",
    "stream_offsets": f"""WITH {S.CLEAN}, {S.SPLITS}, lens AS (
            SELECT split, k, doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) + 1 END AS n
            FROM clean JOIN splits USING (doc_id))
        SELECT split, doc_id, n::INTEGER AS len,
               coalesce(sum(n) OVER (PARTITION BY split ORDER BY k, doc_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stream_start
        FROM lens""",
}
