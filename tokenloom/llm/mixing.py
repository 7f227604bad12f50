"""Mixing sources to target weights: hierarchical budgets, and token prefixes of seeded epochs.

A budget of tokens goes down a tree (domain, language, source) by the weights of its nodes. A node can spend at
most what its leaves hold, times the epochs that a leaf may be repeated. What a child cannot spend
goes to its siblings by their weights; only what all siblings together cannot spend is left to
the level above, so shortages are made good among siblings before ancestors. Budgets are whole tokens, rounded down.

A leaf spends its budget epoch by epoch: whole epochs take every document, the last one takes the longest prefix of its
own seeded order whose tokens fit: every epoch of a leaf has its own order. The order is cut into hash buckets, so a leaf that holds a third of all rows
is summed in many tasks.

* Null tree columns form a node of their own, named `NONE`. Weights default to 1; a weight of 0 excludes a node.
* The order key hashes id and text, so rows with null or one repeated id are spread by their texts.
* Null and empty texts count `LEAST` tokens, so they are ordered and chosen like others. Repeated rows and ids are rows of their
  own; rows equal in order key, id and tokens are interchangeable.
* Empty tables give empty results. The input's columns travel inside one struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.functions.keys import order_key, uniform
from tokenloom.llm.storage import written

# The domains that sources are dealt to by their number, and the weights of domains and languages.
DOMAINS = ["web", "books", "news", "forums"]
MIX_WEIGHTS = [{"web": 4, "books": 3, "news": 2, "forums": 1}, {"en": 6, "de": 2, "fr": 2, "es": 1}, {}]
# Tokens that are mixed, as a share of those held: as many as there are.
MIX_SHARE = 1.0
NONE = "(none)"
LEVELS = ("domain", "lang", "source")
ROWS_PER_BUCKET, MOST_BUCKETS = 2_000, 1 << 16
SEED = 4099
EPOCHS = 3
LEAST = 1
TOKEN_PATTERN = "[^\\x20\\x09-\\x0D]+"


def domain_of(source: Column) -> Column:
    """The domain of a source, by the number at the end of its name; null without one."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    names = F.array(*map(F.lit, DOMAINS))
    return F.when(number != "", F.element_at(names, F.pmod(number.cast("int"), F.lit(len(DOMAINS))) + 1))


def tokens_of(text: Column) -> Column:
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN)), F.lit(LEAST)).cast("long")


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    """The whole-number weight of a node; 1 where none is given."""
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(int(v))) for k, v in sorted(weights.items())))
    return F.coalesce(F.try_element_at(table, name), F.lit(1)).cast("long")


def leaf_budgets(leaves: DataFrame, weights: Sequence[Mapping[str, int]], share: float, epochs: int) -> DataFrame:
    """(`domain`, `lang`, `source`, `held`, `budget`) of every leaf; the root spends `share` of all tokens."""
    capacity = leaves.withColumn("capacity", F.col("held") * epochs)
    for level, own in zip(LEVELS, weights):
        # A weight of 0 takes its whole subtree out.
        capacity = capacity.withColumn("capacity", F.when(weight_of(F.col(level), own) > 0, F.col("capacity")).otherwise(F.lit(0)))
    whole = capacity.agg(F.sum("capacity").alias("capacity"), F.sum("held").alias("held")).first()
    given = min(whole["capacity"] or 0, int((whole["held"] or 0) * share))
    parents, keys = None, []
    for depth, own in enumerate(weights):
        level = LEVELS[depth]
        nodes = capacity.groupBy(*keys, level).agg(F.sum("capacity").alias("capacity"), F.sum("held").alias("held"))
        if parents is None:
            nodes = nodes.withColumn("given", F.lit(given).cast("long"))
        else:
            nodes = nodes.join(parents.select(*keys, F.col("budget").alias("given")), keys)
        parents = _filled(nodes.withColumn("weight", weight_of(F.col(level), own)), keys, level)
        keys = [*keys, level]
    return parents.select(*LEVELS, "held", "budget")


def _filled(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Fills the children of every parent by weight up to their capacities, all in whole numbers.

    In the order of capacity per weight the children that run short come first: a child is short if its
    capacity is below its share of what the ones before it have left.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.greatest("weight", F.lit(1))).asc(), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    wide = "decimal(38,0)"
    ranked = (
        nodes.withColumn("spent", F.coalesce(F.sum("capacity").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(onward))
        .withColumn(
            "short",
            (F.col("capacity").cast(wide) * F.col("weights") <= F.col("weight").cast(wide) * (F.col("given") - F.col("spent")))
            & (F.col("spent") <= F.col("given")),
        )
        .withColumn("short_spent", F.coalesce(F.sum(F.when(F.col("short"), F.col("capacity"))).over(whole), F.lit(0)))
        .withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("short"), F.col("weight"))).over(whole), F.lit(0)))
    )
    share = F.expr("CAST((CAST(weight AS DECIMAL(19,0)) * (given - short_spent)) DIV greatest(open_weight, 1) AS BIGINT)")
    return ranked.withColumn("budget", F.when(F.col("short"), F.col("capacity")).otherwise(F.least("capacity", share)))


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Sequence[Mapping[str, int]],
    share: float,
    epochs: int = EPOCHS,
    seed: int = SEED,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """(`row`, `domain`, `lang`, `source`, `tokens`, `epoch`): one row per document and epoch that takes it.

    `row` holds the columns of `keep`, all of the input's by default.
    """
    rows = docs.select(
        F.struct(*(["*"] if keep is None else keep)).alias("row"),
        F.coalesce(domain, F.lit(NONE)).alias("domain"),
        F.coalesce(docs["lang"].cast("string"), F.lit(NONE)).alias("lang"),
        F.coalesce(docs["source"].cast("string"), F.lit(NONE)).alias("source"),
        tokens_of(docs[text]).alias("tokens"),
        docs[doc_id].alias("id"),
        F.md5(F.coalesce(docs[text], F.lit(""))).alias("digest"),
    )
    leaf = list(LEVELS)
    leaves = written(rows.groupBy(*leaf).agg(F.sum("tokens").alias("held")), "leaves")
    # One row per leaf; its partial epoch has the number of the whole ones before it.
    plan = written(
        leaf_budgets(leaves, weights, share, epochs).select(
            *leaf, F.expr("budget div held").alias("whole"), F.expr("budget % held").alias("rest")
        ),
        "budgets",
    )
    buckets = min(MOST_BUCKETS, docs.count() // ROWS_PER_BUCKET + 1)
    key = order_key(seed, F.col("whole"), F.coalesce(F.col("id").cast("string"), F.lit(NONE)), F.col("digest"))
    ordered = (
        rows.join(plan, leaf)
        .withColumn("key", key)
        .withColumn("bucket", F.floor(uniform(F.col("key")) * buckets).cast("int"))
    )
    totals = written(ordered.groupBy(*leaf, "bucket").agg(F.sum("tokens").alias("bucket_tokens")), "buckets")
    earlier = Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("base", F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0))).drop("bucket_tokens")
    inside = Window.partitionBy(*leaf, "bucket").orderBy("key", "id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    taken = F.col("whole") + F.when(F.col("base") + F.col("local") <= F.col("rest"), 1).otherwise(0)
    reached = (
        ordered.withColumn("local", F.sum("tokens").over(inside))
        .join(bases, [*leaf, "bucket"])
        .withColumn("taken", taken)
        .where("taken > 0")
    )
    return reached.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1))).select(
        "row", *leaf, "tokens", F.col("epoch").cast("int").alias("epoch")
    )
