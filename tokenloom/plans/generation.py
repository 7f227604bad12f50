"""Queries over the pair model: scoring and decoding."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.functions.arrays import crop_context, digest, joined, truncate_at
from tokenloom.operators import backoff, ngram, packing, sampling
from tokenloom.operators.encode import char_ids, decode_chars, encode_documents, encode_subwords
from tokenloom.operators.splits import random_split
from tokenloom.operators.vocab import EOS_ID, char_vocab, collect_ids
from tokenloom.plans import sqlparts as S
from tokenloom.plans import subwords
from tokenloom.plans.tables import VAL_FRACTION, documents_with, table
from tokenloom.session import cut_lineage, written
from tokenloom.sources.documents import clean
from tokenloom.sources.prompts import encode_subword_prompts

BLOCK = 64
CONTEXT = 64
EVAL_ITERS = 200
EVAL_BATCH = 4
TOP_K = 10
TEMPERATURE = 0.8
SAMPLES = 2
# Windows through which `backoff_next` sees a prompt.
BLOCKS = [1, 2, CONTEXT]
STEPS = 12


@dataclass(frozen=True)
class Corpus:
    encoded: DataFrame
    prompts: DataFrame
    vocab: dict[str, int]
    eos: int
    size: int


def corpus(spark: SparkSession, sf: str) -> Corpus:
    """Documents and conversation turns encoded with the alphabet of both."""
    docs = clean(documents_with(spark, sf, "lang"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    turns = turns.withColumn("text", T.strip(F.col("text")))
    vocab = collect_ids(char_vocab(docs.select("text").unionByName(turns.select("text"))))
    encoded = encode_documents(random_split(docs, VAL_FRACTION), char_ids(F.col("text"), vocab), len(vocab))
    prompts = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("prompt_id"), "conv_id", "turn", char_ids(F.col("text"), vocab).alias("ids")
    )
    return Corpus(encoded, prompts, vocab, len(vocab), len(vocab) + 1)


def subword_corpus(spark: SparkSession, sf: str) -> Corpus:
    """Documents and conversation turns of subword ids; end-of-text literals in a turn are ids."""
    model = subwords.trained(spark, sf)
    docs = random_split(documents_with(spark, sf, "lang"), VAL_FRACTION)
    encoded = written(encode_subwords(docs, model))
    turns = table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("prompt_id"), "text")
    prompts = encode_subword_prompts(turns, model)
    return Corpus(encoded, prompts, {}, EOS_ID, model.size)


def train_model(data: Corpus) -> ngram.NgramModel:
    train = data.encoded.where(F.col("split") == "train")
    return ngram.train_ngram(ngram.pair_counts(train, data.eos), data.size)


def bigram_model(spark: SparkSession, sf: str) -> DataFrame:
    data = corpus(spark, sf)
    model = train_model(data)
    scored = ngram.with_probability(model.pairs, model, "prev")
    return scored.select("prev", "next", "cnt", F.round("p", 12).alias("p"))


def split_entropy(data: Corpus) -> DataFrame:
    counts = cut_lineage(ngram.pair_counts(data.encoded, data.eos, "split"))
    model = ngram.train_ngram(counts.where(F.col("split") == "train"), data.size)
    return ngram.cross_entropy(counts, model, "split").select(
        "split", "tokens", F.round("loss", 9).alias("loss"), F.round("perplexity", 6).alias("perplexity")
    )


def drawn_loss(data: Corpus) -> DataFrame:
    spark = data.encoded.sparkSession
    model = train_model(data)
    encoded = data.encoded.select("split", "order_key", "doc_id", "ids", "len")
    chunks = cut_lineage(packing.pack_chunks(packing.stream_offsets(encoded), BLOCK))
    lengths = packing.stream_lengths(chunks, F.size("tokens"))
    plan = packing.batch_plan(spark, EVAL_ITERS, EVAL_BATCH)
    drawn = [packing.draw_offsets(plan, split, n, BLOCK) for split, n in sorted(lengths.items())]
    windows = reduce(DataFrame.unionByName, drawn)
    cut = packing.cut_windows(windows, chunks, BLOCK, "iter", "slot")
    losses = ngram.window_losses(cut, model, "split", "iter")
    return losses.groupBy("split").agg(F.count(F.lit(1)).alias("batches"), F.round(F.avg("loss"), 9).alias("loss"))


def banded_losses(data: Corpus, **limits: int) -> DataFrame:
    losses = ngram.document_losses(data.encoded, train_model(data), data.eos, "lang", **limits)
    banded = losses.withColumn("band", ngram.loss_band(F.col("loss")))
    return banded.groupBy("band", "lang").agg(F.count(F.lit(1)).alias("docs"), F.round(F.avg("loss"), 9).alias("loss"))


def bpe_generate(spark: SparkSession, sf: str) -> DataFrame:
    data = subword_corpus(spark, sf)
    sampler = sampling.build_sampler(probabilities(train_model(data)))
    prompts = sampling.fan_out(data.prompts, SAMPLES, data.eos)
    out = sampling.generate(prompts, sampler, "prompt_id", STEPS, CONTEXT)
    kept = F.size(truncate_at(F.col("generated"), data.eos))
    return out.select("prompt_id", "sample", joined(F.col("generated")).alias("generated"), kept.alias("kept"))


def trained_trie(data: Corpus) -> tuple[DataFrame, backoff.Trie]:
    counts = written(backoff.run_counts(data.encoded, data.eos, "split"))
    return counts, backoff.train_trie(counts.where(F.col("split") == "train"), data.size, stored=True)


def backoff_entropy(data: Corpus, **limits: int) -> DataFrame:
    counts, trie = trained_trie(data)
    return backoff.cross_entropy(counts, trie, "split", **limits).select(
        "split", "tokens", F.round("loss", 9).alias("loss"), F.round("perplexity", 6).alias("perplexity")
    )


def backoff_next(spark: SparkSession, sf: str) -> DataFrame:
    """One token after every turn, seen through windows of one, two and `CONTEXT` ids, and how much of it the trie holds."""
    data = corpus(spark, sf)
    _, trie = trained_trie(data)
    prompts = sampling.fan_out(data.prompts, SAMPLES, data.eos)
    windows = prompts.withColumn("block", F.explode(F.array(*map(F.lit, BLOCKS))))
    seen = [
        F.coalesce(*[F.when(F.col("block") == b, backoff.context_of(F.col("ids"), b)[k]) for b in BLOCKS]).alias(c)
        for k, c in enumerate(backoff.CONTEXT)
    ]
    rows = windows.select("conv_id", "turn", "prompt_id", "sample", "block", *seen)
    drawn = backoff.draw_next(rows, trie, "prompt_id", 0, TEMPERATURE)
    return drawn.select("conv_id", "turn", "sample", "block", "matched", "token")


def probabilities(model: ngram.NgramModel) -> DataFrame:
    return sampling.top_k_softmax(sampling.model_logits(model, TOP_K), "context", TOP_K, TEMPERATURE)


def topk_softmax(spark: SparkSession, sf: str) -> DataFrame:
    return probabilities(train_model(corpus(spark, sf))).select(
        "context", "token", "rank", F.round("logit", 9).alias("logit"), F.round("prob", 9).alias("prob")
    )


def next_token(spark: SparkSession, sf: str) -> DataFrame:
    data = corpus(spark, sf)
    sampler = sampling.build_sampler(probabilities(train_model(data)))
    prompts = sampling.fan_out(data.prompts, SAMPLES, data.eos)
    context = F.element_at(crop_context(F.col("ids"), CONTEXT), -1)
    drawn = sampling.draw_next(prompts.withColumn("context", context), sampler, "prompt_id", 0)
    return drawn.select("conv_id", "turn", "sample", "context", "token")


def next_token_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Like `next_token`, with every token of the vocabulary in reach."""
    data = corpus(spark, sf)
    sampler = sampling.build_whole_sampler(train_model(data), TEMPERATURE)
    prompts = sampling.fan_out(data.prompts, SAMPLES, data.eos)
    context = F.element_at(crop_context(F.col("ids"), CONTEXT), -1)
    drawn = sampling.draw_whole(prompts.withColumn("context", context), sampler, "prompt_id", 0)
    return drawn.select("conv_id", "turn", "sample", "context", "token")


def generate(spark: SparkSession, sf: str) -> DataFrame:
    data = corpus(spark, sf)
    sampler = sampling.build_sampler(probabilities(train_model(data)))
    prompts = sampling.fan_out(data.prompts, SAMPLES, data.eos)
    out = sampling.generate(prompts, sampler, "prompt_id", STEPS, CONTEXT)
    kept = truncate_at(F.col("generated"), data.eos)
    return out.select(
        "prompt_id",
        "sample",
        joined(F.col("generated")).alias("generated"),
        F.size(kept).alias("kept"),
        decode_chars(kept, data.vocab).alias("text"),
        decode_chars(F.filter("generated", lambda i: i != data.eos), data.vocab).alias("full_text"),
    )


def context_crop(spark: SparkSession, sf: str) -> DataFrame:
    prompts = corpus(spark, sf).prompts
    return prompts.select("conv_id", "turn", joined(crop_context(F.col("ids"), CONTEXT)).alias("ids"))


def eos_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """Every document cut at its first line end, which stands for the end id."""
    data = corpus(spark, sf)
    kept = truncate_at(F.col("ids"), data.vocab.get("\n", data.eos))
    return data.encoded.select("doc_id", kept.alias("kept")).select(
        "doc_id", F.size("kept").alias("kept_tokens"), digest(F.col("kept")).alias("kept_md5")
    )


def throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as generated samples: a turn number is a quarter of a second, the line end is the end id."""
    data = corpus(spark, sf)
    kept = F.size(truncate_at(F.col("ids"), data.vocab.get("\n", data.eos)))
    timed = data.prompts.select("conv_id", kept.alias("tokens"), (F.col("turn") * 0.25).alias("seconds"))
    return timed.groupBy("conv_id").agg(
        F.sum("tokens").alias("tokens"),
        F.round(sampling.throughput(F.sum("tokens"), F.sum("seconds")), 6).alias("tokens_per_sec"),
    )


QUERIES = {
    "bigram_model": bigram_model,
    "cross_entropy": lambda spark, sf: split_entropy(corpus(spark, sf)),
    "eval_loss": lambda spark, sf: drawn_loss(corpus(spark, sf)),
    "loss_bands": lambda spark, sf: banded_losses(corpus(spark, sf)),
    # The side of models beyond a broadcast: heavy keys are spread, the rest is joined plainly.
    "loss_bands_spread": lambda spark, sf: banded_losses(corpus(spark, sf), most_pairs=0, most_values=0),
    "bpe_cross_entropy": lambda spark, sf: split_entropy(subword_corpus(spark, sf)),
    "bpe_eval_loss": lambda spark, sf: drawn_loss(subword_corpus(spark, sf)),
    "bpe_loss_bands": lambda spark, sf: banded_losses(subword_corpus(spark, sf)),
    # The side of larger models: pairs are counted and joined.
    "bpe_loss_bands_joined": lambda spark, sf: banded_losses(subword_corpus(spark, sf), most_pairs=0),
    "bpe_generate": bpe_generate,
    "backoff_entropy": lambda spark, sf: backoff_entropy(corpus(spark, sf)),
    "backoff_entropy_spread": lambda spark, sf: backoff_entropy(corpus(spark, sf), most_values=0),
    "bpe_backoff_entropy": lambda spark, sf: backoff_entropy(subword_corpus(spark, sf)),
    "backoff_next": backoff_next,
    "topk_softmax": topk_softmax,
    "next_token": next_token,
    "next_token_whole": next_token_whole,
    "generate": generate,
    "context_crop": context_crop,
    "eos_truncate": eos_truncate,
    "throughput": throughput,
}

VOCAB = f"""{S.CLEAN},
    turns AS (SELECT conv_id, turn, trim(coalesce(text, ''), {S.BLANKS}) AS t FROM conversations),
    vocab AS (
        SELECT c, row_number() OVER (ORDER BY c) - 1 AS id FROM (
            SELECT unnest(string_split(t, '')) AS c FROM clean WHERE t <> ''
            UNION SELECT unnest(string_split(t, '')) FROM turns WHERE t <> ''))"""
TURN_IDS = """spots AS (
        SELECT conv_id, turn, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS pos
        FROM turns WHERE t <> ''),
    prompts AS (
        SELECT conv_id, turn, list(id ORDER BY pos) AS ids FROM spots JOIN vocab USING (c) GROUP BY conv_id, turn)"""
DOC_IDS = f"{VOCAB}, {S.CHARS}, {S.ENCODED}, {S.SPLITS}"
def model_sql(ids: str, eos: str, size: str) -> str:
    """The pair model of the rows `enc` that `ids` makes."""
    return f"""{ids},
    follow AS (
        SELECT split, lang, e.doc_id, coalesce(lag(id) OVER (PARTITION BY e.doc_id ORDER BY pos), {eos}) AS prev, id AS next
        FROM enc e JOIN splits s ON e.doc_id = s.doc_id JOIN clean c ON c.doc_id = e.doc_id),
    bi AS (SELECT prev, next, count(*) AS cnt FROM follow WHERE split = 'train' GROUP BY prev, next),
    ctx AS (SELECT prev, sum(cnt) AS context_cnt FROM bi GROUP BY prev),
    tok AS (SELECT next, sum(cnt) AS token_cnt FROM bi GROUP BY next),
    tot AS (SELECT sum(cnt) + {size} AS mass FROM bi),
    ids AS (SELECT unnest(range({size})) AS id),
    dense AS MATERIALIZED (
        SELECT a.id AS prev, b.id AS next,
               CASE WHEN context_cnt IS NULL THEN (coalesce(token_cnt, 0) + 1.0::DOUBLE) / mass::DOUBLE
                    ELSE 0.75::DOUBLE * (coalesce(cnt, 0)::DOUBLE / context_cnt::DOUBLE)
                       + 0.25::DOUBLE * ((coalesce(token_cnt, 0) + 1.0::DOUBLE) / mass::DOUBLE) END AS p
        FROM ids a CROSS JOIN ids b CROSS JOIN tot
        LEFT JOIN bi ON bi.prev = a.id AND bi.next = b.id
        LEFT JOIN ctx ON ctx.prev = a.id LEFT JOIN tok ON tok.next = b.id)"""


MODEL = model_sql(DOC_IDS, S.EOS, f"{S.EOS} + 1")


def probs_sql(model: str, top_k: int | None = TOP_K) -> str:
    return f"""{model},
    tops AS (
        SELECT prev AS context, next AS token, ln(p) / {TEMPERATURE}::DOUBLE AS logit,
               rank() OVER (PARTITION BY prev ORDER BY p DESC) AS rank FROM dense),
    probs AS (
        SELECT *, exp(logit - max(logit) OVER (PARTITION BY context))
                  / sum(exp(logit - m)) OVER (PARTITION BY context) AS prob
        FROM (SELECT *, max(logit) OVER (PARTITION BY context) AS m FROM tops WHERE {f"rank <= {top_k}" if top_k else "true"})),
    cumulative AS (
        SELECT context, token, sum(prob) OVER (PARTITION BY context ORDER BY token) AS upto,
               row_number() OVER (PARTITION BY context ORDER BY token DESC) AS from_last FROM probs)"""


PROBS = probs_sql(MODEL)
LOSS_CASE = "CASE " + " ".join(
    f"WHEN loss >= {low} THEN '{name}'" for low, name in reversed(ngram.LOSS_BANDS)
) + " END"


def drawn(rows: str, step: str) -> str:
    """Draw for rows with `prompt_id`, `sample` and `context`."""
    return f"""SELECT r.prompt_id, r.sample, min(c.token) FILTER (c.upto > r.u OR c.from_last = 1) AS token
        FROM (SELECT *, ('0x' || substr(md5(concat_ws(':', 1337, prompt_id, sample, {step})), 1, 15))::BIGINT
                        / 1152921504606846976.0::DOUBLE AS u FROM {rows}) r
        JOIN cumulative c ON c.context = r.context GROUP BY r.prompt_id, r.sample"""


STARTS = f"""{TURN_IDS},
    starts AS (
        SELECT conv_id, turn, conv_id || '-' || turn AS prompt_id, unnest(range({SAMPLES})) AS sample,
               coalesce(ids[len(ids)], {S.EOS}) AS context
        FROM turns LEFT JOIN prompts USING (conv_id, turn))"""

WALK = f"""spans AS (
            SELECT context, token, coalesce(lag(upto) OVER (PARTITION BY context ORDER BY token), -1) AS low,
                   CASE WHEN from_last = 1 THEN 2 ELSE upto END AS high FROM cumulative),
        walk(step, prompt_id, sample, context) AS (
            SELECT 0, prompt_id, sample, context FROM starts
            UNION ALL
            SELECT step + 1, prompt_id, sample, s.token FROM (
                SELECT *, ('0x' || substr(md5(concat_ws(':', 1337, prompt_id, sample, step)), 1, 15))::BIGINT
                          / 1152921504606846976.0::DOUBLE AS u FROM walk WHERE step < {STEPS}) w
            JOIN spans s ON s.context = w.context AND u >= low AND u < high),
        outs AS (
            SELECT prompt_id, sample, list(context ORDER BY step) AS g FROM walk WHERE step > 0 GROUP BY prompt_id, sample)"""


def entropy_sql(model: str) -> str:
    return f"""WITH RECURSIVE {model}
        SELECT split, count(*) AS tokens, round(avg(-ln(p)), 9) AS loss, round(exp(avg(-ln(p))), 6) AS perplexity
        FROM follow JOIN dense USING (prev, next) GROUP BY split"""


def eval_sql(model: str) -> str:
    return f"""WITH RECURSIVE {model}, {S.STREAM}, lens AS (SELECT split, count(*) AS n FROM stream GROUP BY split),
        plan AS (SELECT i // {EVAL_BATCH} AS iter, i % {EVAL_BATCH} AS slot FROM range({EVAL_ITERS * EVAL_BATCH}) t(i)),
        windows AS (
            SELECT split, iter, slot,
                   ('0x' || substr(md5(concat_ws(':', 1337, split, iter, 0, slot)), 1, 15))::BIGINT
                       % CASE WHEN n > {BLOCK} THEN n - {BLOCK} ELSE error('too few tokens') END AS o
            FROM plan, lens),
        cells AS (SELECT *, o + unnest(range({BLOCK})) AS g FROM windows),
        moves AS MATERIALIZED (
            SELECT split, g, id AS prev, lead(id) OVER (PARTITION BY split ORDER BY g) AS next FROM stream),
        scored AS MATERIALIZED (SELECT split, g, -ln(p) AS nll FROM moves JOIN dense USING (prev, next)),
        losses AS (SELECT split, iter, avg(nll) AS loss FROM cells JOIN scored USING (split, g) GROUP BY split, iter)
        SELECT split, count(*) AS batches, round(avg(loss), 9) AS loss FROM losses GROUP BY split"""


def bands_sql(model: str) -> str:
    return f"""WITH RECURSIVE {model}, losses AS (
            SELECT doc_id, any_value(lang) AS lang, avg(-ln(p)) AS loss
            FROM follow JOIN dense USING (prev, next) GROUP BY doc_id)
        SELECT {LOSS_CASE} AS band, lang, count(*) AS docs, round(avg(loss), 9) AS loss FROM losses GROUP BY 1, 2"""


def trie_sql(ids: str) -> str:
    """Runs of the rows `enc`, and the levels of the trie; a context is text, so that levels share a table."""
    levels = ["c1", "c1 || ' ' || c2", "c1 || ' ' || c2 || ' ' || c3"]
    grown = " UNION ALL ".join(f"SELECT {k} AS k, {c} AS h, next, sum(cnt) AS cnt FROM runs WHERE split = 'train' AND {c} IS NOT NULL GROUP BY h, next" for k, c in enumerate(levels, 1))
    return f"""{ids},
    placed AS (SELECT s.split, e.doc_id, pos, id FROM enc e JOIN splits s ON s.doc_id = e.doc_id
               UNION ALL SELECT split, doc_id, 0, {S.EOS} FROM splits WHERE doc_id IN (SELECT doc_id FROM enc)),
    laid AS (SELECT split, pos, id AS next, lag(id, 1) OVER w AS c1, lag(id, 2) OVER w AS c2, lag(id, 3) OVER w AS c3
             FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    runs AS (SELECT split, next, c1, c2, c3, count(*) AS cnt FROM laid WHERE pos > 0 GROUP BY ALL),
    grown AS ({grown}),
    known AS (SELECT k, h, sum(cnt) AS total, count(*) AS kinds FROM grown GROUP BY k, h HAVING sum(cnt) >= {backoff.LEAST}),
    single AS (SELECT next, sum(cnt) AS cnt FROM runs WHERE split = 'train' GROUP BY next),
    mass AS (SELECT sum(cnt) + {S.EOS} + 1 AS n FROM single)"""


def mixed_sql(rows: str) -> str:
    """`rows` (c1, c2, c3, next) with `p`, level by level."""
    out = f"SELECT r.*, (coalesce(single.cnt, 0) + 1.0::DOUBLE) / n::DOUBLE AS p, 0 AS matched FROM {rows} r CROSS JOIN mass LEFT JOIN single USING (next)"
    for k, c in enumerate(["c1", "c1 || ' ' || c2", "c1 || ' ' || c2 || ' ' || c3"], 1):
        out = f"""SELECT q.* EXCLUDE (p, matched), CASE WHEN total IS NULL THEN p ELSE (coalesce(g.cnt, 0) + kinds * p) / (total + kinds) END AS p,
            CASE WHEN total IS NULL THEN matched ELSE {k} END AS matched
            FROM (SELECT *, {c} AS h FROM ({out})) q LEFT JOIN known ON known.k = {k} AND known.h = q.h
            LEFT JOIN grown g ON g.k = {k} AND g.h = q.h AND g.next = q.next"""
        out = f"SELECT * EXCLUDE (h) FROM ({out})"
    return out


BACKOFF_ENTROPY = f"""WITH {trie_sql(DOC_IDS)}
    SELECT split, sum(cnt)::BIGINT AS tokens, round(sum(-ln(p) * cnt) / sum(cnt), 9) AS loss,
           round(exp(sum(-ln(p) * cnt) / sum(cnt)), 6) AS perplexity
    FROM ({mixed_sql("runs")}) GROUP BY split"""

ORACLE = {
    "backoff_entropy": BACKOFF_ENTROPY,
    "backoff_entropy_spread": BACKOFF_ENTROPY,
    "backoff_next": f"""WITH {trie_sql(DOC_IDS)}, {TURN_IDS},
        starts AS (
            SELECT conv_id, turn, conv_id || '-' || turn AS prompt_id, unnest(range({SAMPLES})) AS sample,
                   coalesce(ids, [{S.EOS}]) AS ids
            FROM turns LEFT JOIN prompts USING (conv_id, turn)),
        seen AS (SELECT * EXCLUDE (ids), ids[-least(len(ids), block):] AS ids
                 FROM (SELECT *, unnest({BLOCKS}) AS block FROM starts)),
        rows AS (SELECT * EXCLUDE (ids), ids[-1] AS c1, CASE WHEN len(ids) > 1 THEN ids[-2] END AS c2,
                        CASE WHEN len(ids) > 2 THEN ids[-3] END AS c3 FROM seen),
        contexts AS (SELECT DISTINCT c1, c2, c3 FROM rows),
        cells AS (SELECT contexts.*, i AS next FROM contexts, range((SELECT {S.EOS} + 1)) t(i)),
        weighed AS (SELECT *, pow(p, 1 / {TEMPERATURE}::DOUBLE) AS w FROM ({mixed_sql("cells")})),
        upto AS (
            SELECT c1, c2, c3, next, matched, sum(w) OVER (PARTITION BY c1, c2, c3 ORDER BY next) / sum(w) OVER (PARTITION BY c1, c2, c3) AS upto,
                   row_number() OVER (PARTITION BY c1, c2, c3 ORDER BY next DESC) AS from_last FROM weighed),
        drawn AS (SELECT *, ('0x' || substr(md5(concat_ws(':', 1337, prompt_id, sample, 0)), 1, 15))::BIGINT
                         / 1152921504606846976.0::DOUBLE AS u FROM rows)
        SELECT conv_id, turn, sample::INTEGER AS sample, block::INTEGER AS block, any_value(matched)::INTEGER AS matched,
               min(next) FILTER (upto > u OR from_last = 1)::INTEGER AS token
        FROM drawn d JOIN upto q ON d.c1 = q.c1 AND d.c2 IS NOT DISTINCT FROM q.c2 AND d.c3 IS NOT DISTINCT FROM q.c3
        GROUP BY conv_id, turn, sample, block""",
    "cross_entropy": entropy_sql(MODEL),
    "eval_loss": eval_sql(MODEL),
    "loss_bands": bands_sql(MODEL),
    "loss_bands_spread": bands_sql(MODEL),
    "bigram_model": f"""WITH {MODEL}
        SELECT prev::INTEGER AS prev, next::INTEGER AS next, cnt, round(p, 12) AS p FROM dense JOIN bi USING (prev, next)""",
    "topk_softmax": f"""WITH {PROBS}
        SELECT context::INTEGER AS context, token::INTEGER AS token, rank::INTEGER AS rank,
               round(logit, 9) AS logit, round(prob, 9) AS prob FROM probs""",
    "next_token": f"""WITH {PROBS}, {STARTS}, picks AS ({drawn("starts", "0")})
        SELECT conv_id, turn, sample::INTEGER AS sample, context::INTEGER AS context, token::INTEGER AS token
        FROM starts JOIN picks USING (prompt_id, sample)""",
    "next_token_whole": f"""WITH {probs_sql(MODEL, None)}, {STARTS}, picks AS ({drawn("starts", "0")})
        SELECT conv_id, turn, sample::INTEGER AS sample, context::INTEGER AS context, token::INTEGER AS token
        FROM starts JOIN picks USING (prompt_id, sample)""",
    "generate": f"""WITH RECURSIVE {PROBS}, {STARTS}, {WALK},
        cut AS (SELECT *, CASE WHEN list_position(g, {S.EOS}) > 0 THEN g[:list_position(g, {S.EOS}) - 1] ELSE g END AS k
                FROM outs),
        spelled AS (
            SELECT prompt_id, sample, string_agg(c, '' ORDER BY n) AS text
            FROM (SELECT prompt_id, sample, unnest(k) AS id, generate_subscripts(k, 1) AS n FROM cut) JOIN vocab USING (id)
            GROUP BY prompt_id, sample),
        whole AS (
            SELECT prompt_id, sample, string_agg(c, '' ORDER BY n) AS full_text
            FROM (SELECT prompt_id, sample, unnest(g) AS id, generate_subscripts(g, 1) AS n FROM outs) JOIN vocab USING (id)
            GROUP BY prompt_id, sample)
        SELECT prompt_id, sample::INTEGER AS sample, array_to_string(g, ' ') AS generated, len(k)::INTEGER AS kept,
               coalesce(text, '') AS text, coalesce(full_text, '') AS full_text
        FROM cut LEFT JOIN spelled USING (prompt_id, sample) LEFT JOIN whole USING (prompt_id, sample)""",
    "context_crop": f"""WITH {VOCAB}, {TURN_IDS}
        SELECT conv_id, turn, coalesce(array_to_string(ids[-{CONTEXT}:], ' '), '') AS ids
        FROM turns LEFT JOIN prompts USING (conv_id, turn)""",
    "eos_truncate": f"""WITH {DOC_IDS}, stops AS (
            SELECT doc_id, min(pos) AS stop FROM enc WHERE id = (SELECT id FROM vocab WHERE c = chr(10)) GROUP BY doc_id),
        kept AS (
            SELECT doc_id, count(*) AS n, md5(string_agg(id::VARCHAR, ' ' ORDER BY pos)) AS m
            FROM enc LEFT JOIN stops USING (doc_id) WHERE stop IS NULL OR pos < stop GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0)::INTEGER AS kept_tokens, coalesce(m, md5('')) AS kept_md5
        FROM documents LEFT JOIN kept USING (doc_id)""",
    "throughput": f"""WITH {VOCAB}
        SELECT conv_id, sum(n)::BIGINT AS tokens,
               CASE WHEN sum(turn) > 0 THEN round(sum(n) / (sum(turn) * 0.25::DOUBLE), 6) ELSE 0 END AS tokens_per_sec
        FROM (SELECT conv_id, turn, length(string_split(t, chr(10))[1]) AS n FROM turns) GROUP BY conv_id""",
}
