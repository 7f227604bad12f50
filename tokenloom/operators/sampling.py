"""Decoding from next-token distributions: temperature, top-k, softmax, draws and the generation loop."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.functions.arrays import crop_context
from tokenloom.functions.keys import order_key, uniform
from tokenloom.functions.lookup import constant_array, count_at_most
from tokenloom.operators.joins import fits_broadcast, lookup_join
from tokenloom.operators.ngram import PAIR_WEIGHT, NgramModel
from tokenloom.session import cut_lineage

SAMPLE_SEED = 1337
STEPS_PER_CUT = 10


def top_k_softmax(logits: DataFrame, context: str, top_k: int | None, temperature: float = 1.0) -> DataFrame:
    """Probabilities after temperature and top-k; ties with the k-th logit stay.

    `logits` has `token` and `logit` per context. A context holds at most one row per token id.
    """
    scaled = logits.withColumn("logit", F.col("logit") / F.lit(temperature))
    per_context = Window.partitionBy(context)
    ranked = scaled.withColumn("rank", F.rank().over(per_context.orderBy(F.desc("logit"))))
    if top_k is not None:
        ranked = ranked.where(F.col("rank") <= top_k)
    weight = F.exp(F.col("logit") - F.max("logit").over(per_context))
    return ranked.withColumn("_w", weight).withColumn("prob", F.col("_w") / F.sum("_w").over(per_context)).drop("_w")


def model_logits(model: NgramModel, top_k: int) -> DataFrame:
    """`(context, token, logit)` of every token that can be among the top k of its context.

    A token unseen after a context ranks there no better than among single tokens, so seen
    tokens and the top k single tokens suffice. Without a limit, use `build_whole_sampler`.
    """
    spark = model.pairs.sparkSession
    ids = spark.range(model.vocab_size).select(F.col("id").cast("int").alias("next"))
    singles = ids.join(model.tokens, "next", "left").select("next", F.coalesce("token_cnt", F.lit(0)).alias("token_cnt"))
    ranked = singles.withColumn("r", F.rank().over(Window.orderBy(F.desc("token_cnt"))))
    # At most one id per token of the vocabulary.
    listed = ranked.where(F.col("r") <= top_k).agg(F.sort_array(F.collect_list("next")).alias("heads")).first()["heads"]
    contexts = spark.range(model.vocab_size).select(F.col("id").cast("int").alias("prev"))
    unseen = contexts.select("prev", F.explode(constant_array(listed, "int")).alias("next"), F.lit(0).cast("long").alias("cnt"))
    cells = model.pairs.unionByName(unseen).groupBy("prev", "next").agg(F.max("cnt").alias("cnt"))
    joined = cells.join(F.broadcast(model.contexts), "prev", "left").join(F.broadcast(model.tokens), "next", "left")
    p = model.probability(F.col("cnt"), F.col("context_cnt"), F.col("token_cnt"))
    return joined.select(F.col("prev").alias("context"), F.col("next").alias("token"), F.log(p).alias("logit"))


@dataclass(frozen=True)
class Sampler:
    """Per context: candidate tokens in id order and their cumulative probabilities."""

    table: DataFrame
    values: int


def build_sampler(probs: DataFrame) -> Sampler:
    order = Window.partitionBy("context").orderBy("token").rowsBetween(Window.unboundedPreceding, 0)
    cumulative = probs.withColumn("upto", F.sum("prob").over(order))
    table = cut_lineage(
        cumulative.groupBy("context")
        .agg(F.sort_array(F.collect_list(F.struct("token", "upto"))).alias("c"))
        .select("context", F.col("c.token").alias("tokens"), F.col("c.upto").alias("upto"))
    )
    values = table.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("n")).first()["n"]
    return Sampler(table, 2 * values)


@dataclass(frozen=True)
class WholeSampler:
    """All tokens of every context: its seen pairs, and one shared tail for the rest.

    After any seen context an unseen token has the same share of its single-token weight, so a context
    needs its seen pairs only. `tail` holds the running sum of the single-token weights by id.
    """

    table: DataFrame
    values: int
    tail: list[float]
    # Weight of an unseen token after a seen context, per weight among the single tokens.
    share: float


def build_whole_sampler(model: NgramModel, temperature: float = 1.0) -> WholeSampler:
    """Sampler without top-k. Rows are bounded by the seen contexts, values by the seen pairs and the vocabulary."""
    power = 1.0 / temperature
    # At most one row per token id.
    counts = {r["next"]: r["token_cnt"] for r in model.tokens.collect()}
    mass = float(model.total + model.vocab_size)
    singles = [((counts.get(t, 0) + 1.0) / mass) ** power for t in range(model.vocab_size)]
    tail = list(accumulate(singles))
    share = (1 - PAIR_WEIGHT) ** power
    known = model.pairs.join(F.broadcast(model.contexts), "prev").join(F.broadcast(model.tokens), "next", "left")
    weight = F.pow(model.probability(F.col("cnt"), F.col("context_cnt"), F.col("token_cnt")), F.lit(power))
    extra = weight - F.lit(share) * F.get(constant_array(singles, "double"), F.col("next"))
    order = Window.partitionBy("prev").orderBy("next").rowsBetween(Window.unboundedPreceding, 0)
    through = F.lit(share) * F.get(constant_array(tail, "double"), F.col("next")) + F.col("extra")
    spread = (
        known.withColumn("weight", weight)
        .withColumn("extra", F.sum(extra).over(order))
        .withColumn("through", through)
        .withColumn("before", F.col("through") - F.col("weight"))
    )
    listed = spread.groupBy(F.col("prev").alias("context")).agg(
        F.sort_array(F.collect_list(F.struct("next", "through", "before", "extra"))).alias("seen")
    )
    table = cut_lineage(listed)
    values = table.agg(F.coalesce(F.sum(F.size("seen")), F.lit(0)).alias("n")).first()["n"]
    return WholeSampler(table, 4 * values, tail, share)


def draw_whole(rows: DataFrame, sampler: WholeSampler, key: str, step: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """Adds `token`, drawn from all tokens after `context`."""
    u = uniform(order_key(seed, F.col(key), F.col("sample"), F.lit(step)))
    joined = lookup_join(rows, sampler.table, ["context"], sampler.values, key)
    nothing = F.struct(F.lit(0).alias("next"), *[F.lit(0.0).alias(n) for n in ("through", "before", "extra")])
    seen = F.coalesce("seen", F.slice(F.array(nothing), 1, 0))
    share = F.when(F.size(seen) > 0, F.lit(sampler.share)).otherwise(F.lit(1.0))
    placed = joined.select(*rows.columns, seen.alias("_seen"), share.alias("_share"))
    whole = F.col("_share") * sampler.tail[-1] + F.when(F.size("_seen") > 0, F.element_at("_seen", -1)["extra"]).otherwise(0.0)
    placed = placed.withColumn("_target", u * whole)
    # The first seen token that ends beyond the target: it is drawn, or an unseen one before it.
    at = F.size(F.filter("_seen", lambda s: s["through"] <= F.col("_target")))
    placed = placed.withColumn("_hit", F.get("_seen", at)).withColumn(
        "_extra", F.when(at > 0, F.get("_seen", at - 1)["extra"]).otherwise(0.0)
    )
    unseen = count_at_most(sampler.tail, "double", (F.col("_target") - F.col("_extra")) / F.col("_share"))
    token = F.when(F.col("_target") >= F.col("_hit")["before"], F.col("_hit")["next"]).otherwise(
        F.least(unseen, F.lit(len(sampler.tail) - 1))
    )
    return placed.withColumn("token", token.cast("int")).drop("_seen", "_share", "_target", "_hit", "_extra")


def multinomial(tokens: Column, upto: Column, u: Column) -> Column:
    """The first token whose cumulative probability exceeds `u`; the last one if rounding leaves none."""
    at = F.array_position(F.transform(upto, lambda c: c > u), F.lit(True)).cast("int")
    return F.when(at > 0, F.get(tokens, at - 1)).otherwise(F.element_at(tokens, -1))


def fan_out(prompts: DataFrame, num_samples: int, bos_id: int) -> DataFrame:
    """Each prompt once per sample; an empty prompt starts from the begin id."""
    start = F.when(F.size("ids") > 0, F.col("ids")).otherwise(F.array(F.lit(bos_id).cast("int")))
    return prompts.withColumn("ids", start).withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(num_samples - 1))))


def draw_next(rows: DataFrame, sampler: Sampler, key: str, step: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """Adds `token`, drawn from the distribution of `context`."""
    u = uniform(order_key(seed, F.col(key), F.col("sample"), F.lit(step)))
    joined = lookup_join(rows, sampler.table, ["context"], sampler.values, key)
    return joined.withColumn("token", multinomial(F.col("tokens"), F.col("upto"), u)).drop("tokens", "upto")


def generate(
    prompts: DataFrame, sampler: Sampler, key: str, steps: int, block: int, seed: int = SAMPLE_SEED
) -> DataFrame:
    """`generated` ids after `steps` draws for all fanned-out prompts at once.

    The prompt itself is cropped to the context once; the pair model needs only its last id. Beyond a broadcast sampler
    every step is written, as its heavy contexts are counted before they are joined.
    """
    state = prompts.withColumn("context", F.element_at(crop_context(F.col("ids"), block), -1)).withColumn(
        "generated", F.array().cast("array<int>")
    )
    slim = state.select(key, "sample", "context", "generated")
    steps_per_cut = STEPS_PER_CUT
    if not fits_broadcast(sampler.values):
        slim, steps_per_cut = cut_lineage(slim), 1
    for step in range(steps):
        drawn = draw_next(slim, sampler, key, step, seed)
        slim = drawn.select(
            key, "sample", F.col("token").alias("context"), F.array_append("generated", F.col("token")).alias("generated")
        )
        if (step + 1) % steps_per_cut == 0 and step + 1 < steps:
            slim = cut_lineage(slim)
    return slim.select(key, "sample", "generated")


def throughput(tokens: Column, seconds: Column) -> Column:
    """Tokens per second, 0 when no time passed."""
    return F.when(seconds > 0, tokens / seconds).otherwise(F.lit(0.0))
