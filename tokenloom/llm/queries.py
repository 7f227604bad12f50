"""The registered queries of the training-data operators, and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import SHARDS
from tokenloom.llm import decontam, embeddings, extract, forest, language, lexical, licenses, mixing, oracles, quality, repeats, secrets, shards, whitening
from tokenloom.llm.mixing import DOMAINS, MIX_SHARE, MIX_WEIGHTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = quality.scored(docs.select("doc_id", "text"), model)
    return score.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.jaccard_join(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.kept_digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.manifest(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.domain_of(F.col("source")), MIX_WEIGHTS, MIX_SHARE, keep=["doc_id"])
    return mixed.select("row.doc_id", "domain", "lang", "source", "tokens", "epoch")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 folds one nibble at a time over the table of its polynomial.
CRC_TABLE = """steps(i, k, c) AS (
    SELECT range, 0, range::BIGINT FROM range(16)
    UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 4),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 4)"""


def crc_of(text: str) -> str:
    nibbles = (
        f"list_transform(regexp_extract_all(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '.'), "
        "lambda p: strpos('0123456789ABCDEF', p)::BIGINT - 1)"
    )
    fold = "lambda a, b: xor(a >> 4, tab[(xor(a, b) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), {fold}), 4294967295)"


OP7_SQL = f"""WITH RECURSIVE {CRC_TABLE},
sized AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {crc_of("coalesce(text, '')")} AS crc
          FROM documents, crc_table),
placed AS (
    SELECT *, sum(size) OVER before + size AS through, sum(size) OVER () AS total
    FROM (SELECT *, 0 AS zero FROM sized)
    WINDOW before AS (ORDER BY doc_id NULLS FIRST, crc, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sharded AS (
    SELECT doc_id, size, crc, coalesce(through, size) AS through,
           ((2 * coalesce(through, size) - size) * {SHARDS} // (2 * total))::INT AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS slot,
       NULL::INT AS grown_shard
FROM sharded"""



def weights_sql(column: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    return f"CASE {column} {cases} ELSE 1 END" if cases else "1"


def filled_sql(name: str, nodes: str, keys: list[str], level: str) -> str:
    """Budgets of the children of every parent, as in `mixing`: those that run short first, then by weight."""
    parent = ", ".join(keys) if keys else "1"
    order = f"(PARTITION BY {parent} ORDER BY capacity / weight, {level} ROWS BETWEEN"
    group = ", ".join([*keys, level])
    return f"""{name}_ranked AS (
    SELECT *, coalesce(sum(capacity) OVER {order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS spent,
           sum(weight) OVER {order} CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS weights
    FROM ({nodes})),
{name}_short AS (
    SELECT *, capacity::HUGEINT * weights <= weight * (given - spent) AND spent <= given AS short FROM {name}_ranked),
{name} AS (
    SELECT {group}, held, capacity, CASE WHEN short THEN capacity ELSE least(capacity,
        (weight * (given - coalesce(sum(capacity) FILTER (short) OVER (PARTITION BY {parent}), 0)::HUGEINT))
        // greatest(sum(weight) FILTER (NOT short) OVER (PARTITION BY {parent}), 1)::HUGEINT) END::BIGINT AS budget
    FROM {name}_short)"""


def level_sql(keys: list[str], level: str, weights: dict[str, int], parents: str) -> str:
    group = ", ".join([*keys, level])
    nodes = f"SELECT {group}, sum(held)::BIGINT AS held, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY {group}"
    given = f"JOIN (SELECT {', '.join(keys)}, budget AS given FROM {parents}) USING ({', '.join(keys)})" if keys else f", {parents}"
    return f"SELECT n.*, given, {weights_sql('n.' + level, weights)} AS weight FROM ({nodes}) n {given}"


OP9_SQL = f"""WITH rows AS (
    SELECT doc_id, coalesce(CASE WHEN regexp_matches(source, '[0-9]$') THEN
               {DOMAINS}[(regexp_extract(source, '([0-9]{{1,9}})$', 1)::INT % {len(DOMAINS)}) + 1] END, '{mixing.NONE}') AS domain,
           coalesce(lang, '{mixing.NONE}') AS lang, coalesce(source, '{mixing.NONE}') AS source,
           greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), {mixing.LEAST})::BIGINT AS tokens,
           md5(coalesce(text, '')) AS digest
    FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS held, sum(tokens)::BIGINT * {mixing.EPOCHS} AS capacity
           FROM rows GROUP BY ALL),
top AS (SELECT least(sum(capacity), floor(sum(held)::DOUBLE * {MIX_SHARE}))::BIGINT AS given FROM leaves),
{filled_sql("domains", level_sql([], "domain", MIX_WEIGHTS[0], "top"), [], "domain")},
{filled_sql("langs", level_sql(["domain"], "lang", MIX_WEIGHTS[1], "domains"), ["domain"], "lang")},
{filled_sql("sources", level_sql(["domain", "lang"], "source", MIX_WEIGHTS[2], "langs"), ["domain", "lang"], "source")},
keyed AS (
    SELECT r.*, budget // held AS whole, budget % held AS rest,
           md5('{mixing.SEED}:' || (budget // held) || ':' || coalesce(doc_id::VARCHAR, '{mixing.NONE}') || ':' || digest) AS k
    FROM rows r JOIN sources USING (domain, lang, source)),
taken AS (
    SELECT *, whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, doc_id, tokens
                                                 ROWS UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS times
    FROM keyed)
SELECT doc_id, domain, lang, source, tokens, unnest(range(times))::INT AS epoch FROM taken"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_secret_scan": op3_secret_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_embedding_neardup": op6_embedding_neardup,
    "op7_sharding": op7_sharding,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_source_mixing": op9_source_mixing,
    "op10_language": op10_language,
    "op11_license_scan": op11_license_scan,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op3_secret_scan": oracles.OP3_SQL,
    "op4_substring_dedup": oracles.OP4_SQL,
    "op6_embedding_neardup": oracles.OP6_SQL,
    "op8_jaccard_join": oracles.OP8_SQL,
    "op7_sharding": OP7_SQL,
    "op9_source_mixing": OP9_SQL,
    "op13_lexical_search": oracles.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
