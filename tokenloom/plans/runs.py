"""Queries over run metrics: a user of `events` is a run, its events in time order are iterations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators import runs
from tokenloom.operators.ordered import row_numbers
from tokenloom.plans.tables import table
from tokenloom.session import cut_lineage, scratch_path
from tokenloom.sources import runlog

ACCUMULATION = 4
LOG_INTERVAL = 2
PEAK, MINIMUM, WARMUP, DECAY = 6e-4, 6e-5, 10, 50
MODEL = dict(params=123_551_232, n_layer=12, n_head=12, head=64, block=1024, sequences=100)


def steps(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    return row_numbers(events, "user_id", ["ts", "event_id"], "step")


def lr_schedule(spark: SparkSession, sf: str) -> DataFrame:
    it = F.col("step") - 1
    return steps(spark, sf).select(
        "event_id",
        "user_id",
        it.alias("it"),
        F.round(runs.learning_rate(it, PEAK, MINIMUM, WARMUP, DECAY), 12).alias("lr"),
    )


def logged_loss(spark: SparkSession, sf: str) -> DataFrame:
    micro = steps(spark, sf).select("user_id", "step", (F.col("value") / ACCUMULATION).alias("loss"))
    return runs.logged_loss(micro, "user_id", ACCUMULATION, LOG_INTERVAL).withColumn("loss", F.round("loss", 6))


def mfu_ema(spark: SparkSession, sf: str) -> DataFrame:
    numbered = cut_lineage(steps(spark, sf).select("user_id", "step", "value"))
    averaged = runs.running_mfu(numbered, "user_id", runs.mfu(F.col("value") + 0.01, **MODEL), LOG_INTERVAL)
    return averaged.withColumn("running_mfu", F.round("running_mfu", 9))


def checkpoint_decisions(spark: SparkSession, sf: str) -> DataFrame:
    evals = cut_lineage(steps(spark, sf).select("event_id", "user_id", "step", "value"))
    return runs.checkpoint_decisions(evals, "user_id", "value").drop("value")


def bench_timing(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    timed = runs.timed_iterations(events, "user_id", ["ts", "event_id"], "value")
    share = runs.mfu(F.col("mean_ms") / 1000.0, **{**MODEL, "sequences": 12})
    return timed.select(
        "user_id", "iterations", F.round("mean_ms", 6).alias("mean_ms"), F.round(share, 6).alias("mfu")
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the lines a run prints: clicks and views log, the others print something else."""
    share = F.when(F.col("event_id") % 10 == 0, -100.0).otherwise(F.col("value"))
    line = (
        F.when(
            F.col("event_type") == "click",
            F.format_string(runlog.ITER_FORMAT, "event_id", "value", F.col("value") * 2, share),
        )
        .when(F.col("event_type") == "view", F.format_string(runlog.STEP_FORMAT, "event_id", "value", F.col("value") + 1))
        .otherwise(F.concat(F.lit("saving checkpoint to "), "props"))
    )
    return table(spark, sf, "events").select(line.alias("line"))


def run_log_iterations(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "log")
    log_lines(spark, sf).write.text(path)
    return runlog.iteration_rows(runlog.read_log(spark, path))


def run_log_evaluations(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "log")
    log_lines(spark, sf).write.text(path)
    return runlog.evaluation_rows(runlog.read_log(spark, path))


def json_props(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("props", "k long")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


def json_rows(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    text = F.format_string("[[%d.0, %d, %d], [%d, 0, 1e3]]", "user_id", "event_id", F.lit(8), "event_id")
    return runlog.json_rows(events.select("event_id", text.alias("models")), "models", ["params", "width", "layers"])


QUERIES = {
    "lr_schedule": lr_schedule,
    "logged_loss": logged_loss,
    "mfu_ema": mfu_ema,
    "checkpoint_decisions": checkpoint_decisions,
    "bench_timing": bench_timing,
    "run_log_iterations": run_log_iterations,
    "run_log_evaluations": run_log_evaluations,
    "json_props": json_props,
    "json_rows": json_rows,
}

STEPS = """steps AS (
    SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events)"""
FLOPS = (6 * MODEL["params"] + 12 * 12 * 12 * 64 * 1024) * 1024

ORACLE = {
    "lr_schedule": f"""WITH {STEPS}
        SELECT event_id, user_id, step - 1 AS it, round(CASE
            WHEN step - 1 < {WARMUP} THEN {PEAK}::DOUBLE * step / {WARMUP + 1}
            WHEN step - 1 > {DECAY} THEN {MINIMUM}::DOUBLE
            ELSE {MINIMUM}::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * (step - 1 - {WARMUP}) / {DECAY - WARMUP}))
                 * ({PEAK}::DOUBLE - {MINIMUM}::DOUBLE) END, 12) AS lr
        FROM steps""",
    "logged_loss": f"""WITH {STEPS}
        SELECT user_id, (step - 1) // {ACCUMULATION} AS iter, round(arg_max(value, step), 6) AS loss
        FROM steps WHERE ((step - 1) // {ACCUMULATION}) % {LOG_INTERVAL} = 0 GROUP BY 1, 2""",
    "mfu_ema": f"""WITH {STEPS}, logged AS (
            SELECT user_id, step - 1 AS iter, {FLOPS}.0::DOUBLE * 100 / (value + 0.01::DOUBLE) / 312e12::DOUBLE AS mfu
            FROM steps WHERE (step - 1) % {LOG_INTERVAL} = 0),
        settled AS (
            SELECT *, list(mfu) OVER (PARTITION BY user_id ORDER BY iter) AS seen FROM logged WHERE iter >= 5)
        SELECT user_id, iter, round(list_reduce(seen, lambda a, b: 0.9::DOUBLE * a + 0.1::DOUBLE * b), 9) AS running_mfu
        FROM settled
        UNION ALL SELECT user_id, iter, -1.0::DOUBLE FROM logged WHERE iter < 5""",
    "checkpoint_decisions": f"""WITH {STEPS}, bests AS (
            SELECT event_id, user_id, step, value,
                   coalesce(min(value) OVER (PARTITION BY user_id ORDER BY step
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9::DOUBLE) AS best_before,
                   coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY step), 1e9::DOUBLE) AS best_before_always
            FROM steps)
        SELECT event_id, user_id, step, best_before, value < best_before AND step > 1 AS saves,
               best_before_always, step > 1 AS saves_always FROM bests""",
    "bench_timing": f"""WITH {STEPS}
        SELECT user_id, count(*) AS iterations, round(avg(value), 6) AS mean_ms,
               round({FLOPS}.0::DOUBLE * 12 / (avg(value) / 1000) / 312e12::DOUBLE, 6) AS mfu
        FROM steps WHERE step BETWEEN 11 AND 30 GROUP BY user_id""",
    "run_log_iterations": """
        SELECT event_id AS iter, round(value, 4) AS loss, round(value * 2, 2) AS time_ms,
               CASE WHEN event_id % 10 = 0 THEN -100.0::DOUBLE ELSE round(value, 2) END AS mfu_pct
        FROM events WHERE event_type = 'click'""",
    "run_log_evaluations": """
        SELECT event_id AS step, round(value, 4) AS train_loss, round(value + 1, 4) AS val_loss
        FROM events WHERE event_type = 'view'""",
    "json_props": "SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events",
    "json_rows": """
        SELECT event_id, 0 AS position, user_id::DOUBLE AS params, event_id::DOUBLE AS width, 8.0::DOUBLE AS layers FROM events
        UNION ALL SELECT event_id, 1, event_id::DOUBLE, 0.0::DOUBLE, 1000.0::DOUBLE FROM events""",
}
