"""Queries over the learned subword vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.functions.arrays import digest, joined
from tokenloom.operators import bpe, encode, packing, profile, splits, vocab
from tokenloom.plans import sqlparts as S
from tokenloom.plans.tables import VAL_FRACTION, documents, documents_with, table
from tokenloom.plans.tokens import BLOCK, summary
from tokenloom.session import cut_lineage, scratch_path
from tokenloom.sources import metadata as meta
from tokenloom.sources.prompts import encode_subword_prompts

# Pieces of the reference's tokenizer, and the most merges that a vocabulary of that size has room for.
VOCAB_SIZE = 16_000
MERGES = VOCAB_SIZE - vocab.LEARNED_BASE
# Pieces of the vocabulary that SQL learns as well; its merges are the first of the large one's.
SMALL_SIZE = 512
# Models of this session by application and folder: every query below needs the same one.
MODELS: dict[tuple[str, str], vocab.Subwords] = {}


def first_bpe_merge(spark: SparkSession, sf: str) -> DataFrame:
    words = vocab.word_counts(documents(spark, sf))
    return bpe.pair_counts(bpe.symbol_state(words)).orderBy(F.desc("cnt"), "left", "right").limit(1)


def bpe_merges(spark: SparkSession, sf: str) -> DataFrame:
    learned = bpe.learn_merges(vocab.word_counts(documents(spark, sf)), MERGES)
    rows = [(rank, *merge) for rank, merge in enumerate(learned, 1)]
    return spark.createDataFrame(rows, "rank int, left string, right string, cnt long")


def vocab_assembly(spark: SparkSession, sf: str) -> DataFrame:
    words = vocab.word_counts(documents(spark, sf))
    counts = (
        words.select("cnt", F.explode(T.characters(F.col("word"))).alias("char"))
        .groupBy("char")
        .agg(F.sum("cnt").alias("cnt"))
    )
    kept = vocab.char_coverage(counts).where("kept").orderBy("char_rank").collect()
    return vocab.assemble_vocab(spark, vocab.Subwords([], [r["char"] for r in kept]))


def trained(spark: SparkSession, sf: str) -> vocab.Subwords:
    """The subword model of the corpus, trained once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in MODELS:
        MODELS[key] = bpe.train_subwords(documents(spark, sf), VOCAB_SIZE)
    return MODELS[key]


def subword_vocab(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "subwords")
    vocab.write_subwords(spark, trained(spark, sf), path)
    return vocab.assemble_vocab(spark, vocab.read_subwords(spark, path))


def subword_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The stored metadata of the subword dataset, and the vocabulary size that a model reads back from it."""
    model, path = trained(spark, sf), scratch_path(spark, "subword-meta")
    ids = (vocab.EOS_ID, vocab.BOS_ID, vocab.PAD_ID, vocab.UNK_ID)
    meta.write_metadata(meta.subword_metadata(spark, model.size, "subwords", *ids), path)
    stored = meta.read_metadata(spark, path)
    fields = stored.select("tokenizer_model", "eos_id", "bos_id", "pad_id", "unk_id")
    return meta.model_vocab_size(stored).join(fields, F.col("vocab_size") > 0)


def bpe_encode(spark: SparkSession, sf: str) -> DataFrame:
    encoded = encode.encode_subwords(documents(spark, sf), trained(spark, sf))
    return profile.check_id_range(encoded).select("doc_id", "len", digest(F.col("ids")).alias("ids_md5"))


def roundtrip_check(spark: SparkSession, sf: str) -> DataFrame:
    """Documents encoded and decoded again; `len` counts their ids under the first merges, those of a small vocabulary."""
    model = trained(spark, sf)
    small = vocab.Subwords(model.merges[: max(0, SMALL_SIZE - vocab.LEARNED_BASE - len(model.alphabet))], model.alphabet)
    docs = documents_with(spark, sf, "lang").withColumn("body", F.col("text"))
    measured = encode.encode_subwords(docs, small).withColumnsRenamed({"body": "text", "len": "small_len"}).drop("ids")
    encoded = encode.encode_subwords(measured.withColumn("expected", T.normalize(F.col("text"))), model).drop("len")
    encoded = encoded.withColumnRenamed("small_len", "len")
    decoded = encode.decode_subwords(F.col("ids"), model)
    checked = encoded.withColumn("decoded", decoded)
    return checked.select("doc_id", "len", F.md5("decoded").alias("text_md5"), (F.col("decoded") == F.col("expected")).alias("ok"))


def bpe_pieces(spark: SparkSession, sf: str) -> DataFrame:
    model = trained(spark, sf)
    encoded = encode.encode_subwords(documents(spark, sf), model)
    return encoded.select(
        "doc_id",
        joined(F.slice("ids", 1, 20)).alias("first_ids"),
        F.array_join(F.slice(encode.pieces_of(F.col("ids"), model), 1, 15), "|").alias("first_pieces"),
    )


def bpe_packed(spark: SparkSession, sf: str) -> DataFrame:
    labelled = splits.random_split(documents(spark, sf), VAL_FRACTION)
    encoded = cut_lineage(encode.encode_subwords(labelled, trained(spark, sf)))
    return summary(packing.pack_chunks(packing.stream_offsets(encoded), BLOCK))


def special_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns between special literals, encoded with the literals on and off, and decoded again."""
    model = trained(spark, sf)
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("said"))
    prompts = turns.withColumn("text", F.concat(F.lit("<s>"), "role", F.lit("</s>"), "said", F.lit(encode.END_OF_TEXT)))
    on = encode_subword_prompts(prompts.withColumn("raw", F.col("text")), model)
    both = encode_subword_prompts(on.withColumnsRenamed({"ids": "on", "raw": "text"}), model, None)

    def specials(ids: str):
        return F.size(F.filter(ids, lambda i: i.isin(vocab.BOS_ID, vocab.EOS_ID)))

    return both.select(
        "conv_id",
        "turn",
        specials("on").alias("specials_on"),
        specials("ids").alias("specials_off"),
        F.md5(encode.decode_subwords(F.col("on"), model)).alias("on_md5"),
        F.md5(encode.decode_subwords(F.col("ids"), model)).alias("off_md5"),
    )


QUERIES = {
    "first_bpe_merge": first_bpe_merge,
    "bpe_merges": bpe_merges,
    "vocab_assembly": vocab_assembly,
    "subword_vocab": subword_vocab,
    "subword_metadata": subword_metadata,
    "bpe_encode": bpe_encode,
    "roundtrip_check": roundtrip_check,
    "bpe_pieces": bpe_pieces,
    "bpe_packed": bpe_packed,
    "special_prompts": special_prompts,
}

PAIRS = """SELECT l, r, sum(cnt)::BIGINT AS c
    FROM (SELECT unnest(s[:-2]) AS l, unnest(s[2:]) AS r, cnt
          FROM (SELECT string_split(substr(w, 2, length(w) - 2), chr(31) || chr(31)) AS s, cnt FROM {state})
          WHERE len(s) > 1)
    GROUP BY l, r ORDER BY c DESC, l, r LIMIT 1"""

WRAP_LIST = "chr(31) || array_to_string(string_split(word, ''), chr(31) || chr(31)) || chr(31)"

ALPHABET = """counted AS (
        SELECT c, sum(cnt) AS cnt FROM (SELECT unnest(string_split(word, '')) AS c, cnt FROM words) GROUP BY c),
    ranked AS (
        SELECT c, row_number() OVER (ORDER BY cnt DESC, c) AS r,
               coalesce(sum(cnt) OVER (ORDER BY cnt DESC, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 < 0.9999::DOUBLE * sum(cnt) OVER () AS kept FROM counted)"""

# One merge at a time over whole words: slower than the rounds of the job, and independent of them.
MODEL = f"""{S.CLEAN}, {S.LINES}, {S.WORDS}, {ALPHABET},
    inside AS (
        SELECT word, sum(cnt) AS cnt FROM (
            SELECT unnest(string_split(array_to_string([CASE WHEN list_contains(alphabet, c) THEN c
                ELSE chr(30) END for c in string_split(word, '')], ''), chr(30))) AS word, cnt
            FROM words, (SELECT list(c) AS alphabet FROM ranked WHERE kept))
        WHERE word <> '' GROUP BY word),
    steps(rank, w, cnt, l, r, c) AS (
        SELECT 0, {WRAP_LIST}, cnt, '', '', 0::BIGINT FROM inside
        UNION ALL
        SELECT rank + 1,
               replace(w, chr(31) || b.l || chr(31) || chr(31) || b.r || chr(31), chr(31) || b.l || b.r || chr(31)),
               cnt, b.l, b.r, b.c
        FROM steps, ({PAIRS.format(state="steps")}) b
        WHERE rank < {SMALL_SIZE - 260} - (SELECT count(*) FROM ranked WHERE kept)),
    merges AS (SELECT rank, any_value(l) AS l, any_value(r) AS r FROM steps WHERE rank > 0 GROUP BY rank),
    pieces AS (
        SELECT l || r AS piece, 259 + rank AS id FROM merges
        UNION ALL SELECT c, 259 + (SELECT count(*) FROM merges) + r FROM ranked WHERE kept)"""

TOKENS = f"""{MODEL},
    spots AS (
        SELECT doc_id, unnest(string_split(u, ' ')) AS word, generate_subscripts(string_split(u, ' '), 1) AS pos
        FROM (SELECT doc_id, {S.units_of("t")} AS u FROM clean WHERE t <> '')),
    applied(rank, word, w) AS (
        SELECT 0, word, {WRAP_LIST} FROM (SELECT DISTINCT word FROM spots)
        UNION ALL
        SELECT a.rank + 1, word,
               replace(w, chr(31) || m.l || chr(31) || chr(31) || m.r || chr(31), chr(31) || m.l || m.r || chr(31))
        FROM applied a JOIN merges m ON m.rank = a.rank + 1),
    symbols AS (
        SELECT word, unnest(s) AS symbol, generate_subscripts(s, 1) AS n FROM (
            SELECT word, string_split(substr(w, 2, length(w) - 2), chr(31) || chr(31)) AS s
            FROM applied WHERE rank = (SELECT count(*) FROM merges))),
    parts AS (
        SELECT word, n, symbol, CASE WHEN id IS NOT NULL THEN [id] ELSE
            [4 + ('0x' || hex(encode(symbol))[2 * i - 1:2 * i])::INTEGER for i in range(1, strlen(symbol) + 1)] END AS ids
        FROM symbols LEFT JOIN pieces ON piece = symbol),
    units AS (SELECT word, flatten(list(ids ORDER BY n)) AS ids FROM parts GROUP BY word),
    docs AS (
        SELECT doc_id, list_append(flatten(list(ids ORDER BY pos)), 3) AS ids
        FROM spots JOIN units USING (word) GROUP BY doc_id)"""

# SQL would learn 16,000 pieces by one scan of all words a merge, which takes hours: the queries on the learned model
# have no oracle but the round trip, with the lengths under the first merges, and tests hold them against a sequential loop.
ORACLE = {
    "first_bpe_merge": f"""WITH {S.CLEAN}, {S.LINES}, {S.WORDS}, wrapped AS (SELECT {WRAP_LIST} AS w, cnt FROM words),
        best AS ({PAIRS.format(state="wrapped")})
        SELECT l AS "left", r AS "right", c AS cnt FROM best""",
    "vocab_assembly": f"""WITH {S.CLEAN}, {S.LINES}, {S.WORDS}, {ALPHABET}
        SELECT unnest([0, 1, 2, 3]) AS id, unnest(['<pad>', '<unk>', '<s>', '</s>']) AS piece, 'special' AS kind
        UNION ALL SELECT (4 + i)::INTEGER, '<0x' || upper(printf('%02x', i)) || '>', 'byte' FROM range(256) t(i)
        UNION ALL SELECT (259 + r)::INTEGER, c, 'char' FROM ranked WHERE kept""",
    "special_prompts": f"""SELECT conv_id, turn, 3 AS specials_on, 0 AS specials_off,
               md5({S.folded("role || ' ' || coalesce(text, '')")}) AS on_md5,
               md5({S.folded(f"'<s>' || role || '</s>' || coalesce(text, '') || '{encode.END_OF_TEXT}'")}) AS off_md5
        FROM conversations""",
    "roundtrip_check": f"""WITH RECURSIVE {TOKENS}
        SELECT c.doc_id, len(coalesce(ids, []))::INTEGER AS len,
               md5(trim(regexp_replace(t, '{S.BLANK_CLASS}', ' ', 'g'))) AS text_md5, true AS ok
        FROM clean c LEFT JOIN docs USING (doc_id)""",
}
