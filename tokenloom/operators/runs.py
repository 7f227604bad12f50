"""Analysis of training runs: schedule, logged loss, utilization, checkpoints and timing.

A run may hold any share of all rows. Its rows are numbered once by `ordered.row_numbers` and
written, as the functions here read them several times; then they are cut into blocks of consecutive numbers, and only one row per block meets the rest of its run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values of the utilization estimate.
PEAK_FLOPS = 312e12
MFU_DECAY = 0.9
SETTLE_ITERATIONS = 5
# Fixed value: best validation loss before the first evaluation.
INITIAL_BEST = 1e9
# Burn-in iterations and timed iterations of a benchmark.
BURN_IN, TIMED = 10, 20
# Rows of a run that are sorted together; a run of 10^11 rows meets itself as 10^5 block rows.
BLOCK_ROWS = 1 << 20


def learning_rate(it: Column, peak: float, minimum: float, warmup: int, decay: int) -> Column:
    """Linear warm-up, cosine decay, then the minimum."""
    if decay <= warmup:
        raise ValueError("decay must end after warm-up")
    ratio = (it - warmup) / (decay - warmup)
    cosine = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * ratio))
    return (
        F.when(it < warmup, F.lit(peak) * (it + 1) / (warmup + 1))
        .when(it > decay, F.lit(minimum))
        .otherwise(F.lit(minimum) + cosine * (peak - minimum))
    )


def logged_loss(micro_losses: DataFrame, run: str, accumulation: int, log_interval: int) -> DataFrame:
    """Loss of the last micro step of every logged iteration, scaled back by the accumulation.

    Micro steps are `step` from 1; a group holds at most `accumulation` of them.
    """
    zero = F.col("step") - 1
    placed = micro_losses.withColumn("iter", F.expr(f"(step - 1) div {accumulation}")).withColumn(
        "micro_step", zero % accumulation
    )
    logged = placed.where(F.col("iter") % log_interval == 0)
    return logged.groupBy(run, "iter").agg((F.max_by("loss", "micro_step") * accumulation).alias("loss"))


def mfu(dt: Column, params: int, n_layer: int, n_head: int, head: int, block: int, sequences: int) -> Column:
    """Share of the peak that an iteration of `dt` seconds reaches; `params` excludes positions."""
    per_token = 6 * params + 12 * n_layer * n_head * head * block
    return F.lit(float(per_token * block * sequences)) / dt / F.lit(PEAK_FLOPS)


def exponential_average(rows: DataFrame, run: str, index: str, value: str, name: str, decay: float = MFU_DECAY) -> DataFrame:
    """Running average seeded by the first value; `index` counts the values of a run from 0.

    A block is long enough for everything before the previous block to be weighted below
    e^-400, which no double can hold next to a newer term, so each block takes in the end of
    the one before it and nothing else.
    """
    size = int(400 / -math.log(decay))
    placed = rows.withColumn("_block", F.expr(f"{index} div {size}")).withColumn("_k", F.col(index) % size)
    inside = Window.partitionBy(run, "_block").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    power = F.pow(F.lit(decay), F.col("_k").cast("double"))
    weighted = F.lit(1.0 - decay) * F.col(value) / power
    local = placed.withColumn("_local", F.sum(weighted).over(inside) * power).withColumn(
        "_seed", F.first(value).over(inside)
    )
    ends = placed.groupBy(run, "_block").agg(
        (F.sum(weighted) * F.pow(F.lit(decay), F.lit(size - 1.0))).alias("_carry")
    )
    before = ends.select(run, (F.col("_block") + 1).alias("_block"), "_carry")
    joined = local.join(before, [run, "_block"], "left")
    start = F.when(F.col("_block") == 0, F.col("_seed")).otherwise(F.col("_carry"))
    average = F.col("_local") + power * F.lit(decay) * start
    return joined.withColumn(name, average).drop("_block", "_k", "_local", "_seed", "_carry")


def running_mfu(steps: DataFrame, run: str, utilization: Column, log_interval: int) -> DataFrame:
    """`running_mfu` of every logged iteration, -1 before the run has settled. `step` counts from 1."""
    logged = steps.withColumn("iter", F.col("step") - 1).where(F.col("iter") % log_interval == 0)
    first = -(-SETTLE_ITERATIONS // log_interval) * log_interval
    settled = logged.where(F.col("iter") >= first).withColumn("_mfu", utilization)
    settled = settled.withColumn("_index", F.expr(f"(iter - {first}) div {log_interval}"))
    averaged = exponential_average(settled, run, "_index", "_mfu", "running_mfu")
    early = logged.where(F.col("iter") < first).withColumn("running_mfu", F.lit(-1.0))
    return averaged.select(run, "iter", "running_mfu").unionByName(early.select(run, "iter", "running_mfu"))


def checkpoint_decisions(evals: DataFrame, run: str, loss: str) -> DataFrame:
    """Best loss before each evaluation and whether it saves, when saving improvements only and always.

    `step` counts the evaluations of a run from 1. The first one never writes a file.
    """
    placed = evals.withColumn("_block", F.expr(f"(step - 1) div {BLOCK_ROWS}"))
    inside = Window.partitionBy(run, "_block").orderBy("step")
    local = placed.withColumn("_min", F.min(loss).over(inside.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "_last", F.lag(loss).over(inside)
    )
    blocks = placed.groupBy(run, "_block").agg(F.min(loss).alias("_m"), F.max_by(loss, "step").alias("_l"))
    earlier = Window.partitionBy(run).orderBy("_block")
    carried = blocks.select(
        run,
        "_block",
        F.min("_m").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_min_before"),
        F.lag("_l").over(earlier).alias("_last_before"),
    )
    best = F.coalesce(F.least("_min", "_min_before"), F.lit(INITIAL_BEST))
    last = F.coalesce("_last", "_last_before", F.lit(INITIAL_BEST))
    written = F.col("step") > 1
    return (
        local.join(carried, [run, "_block"])
        .withColumn("best_before", best)
        .withColumn("saves", (F.col(loss) < best) & written)
        .withColumn("best_before_always", last)
        .withColumn("saves_always", written)
        .drop("_block", "_min", "_last", "_min_before", "_last_before")
    )


def timed_iterations(rows: DataFrame, run: str, order: list[str], ms: str) -> DataFrame:
    """Mean milliseconds of the iterations after burn-in, per run.

    The bound on the row number lets every task keep only the head of a run before the shuffle.
    """
    number = F.row_number().over(Window.partitionBy(run).orderBy(*order))
    head = rows.select(run, *order, ms).withColumn("_n", number).where(F.col("_n") <= BURN_IN + TIMED)
    return head.where(F.col("_n") > BURN_IN).groupBy(run).agg(
        F.count(F.lit(1)).alias("iterations"), F.avg(ms).alias("mean_ms")
    )
