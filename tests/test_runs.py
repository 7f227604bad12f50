import math
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import runs
from tokenloom.sources import runlog


def test_learning_rate_edges(spark):
    its = [0, 9, 10, 60, 61, 35]
    frame = spark.createDataFrame([(i, it) for i, it in enumerate(its)], "i int, it long")
    lr = [r.lr for r in frame.select("i", runs.learning_rate(F.col("it"), 6e-4, 6e-5, 10, 60).alias("lr")).orderBy("i").collect()]
    assert lr == pytest.approx([6e-4 / 11, 6e-4 * 10 / 11, 6e-4, 6e-5, 6e-5, 3.3e-4])
    with pytest.raises(ValueError):
        runs.learning_rate(F.col("it"), 1, 0, 5, 5)


@pytest.mark.parametrize("decay", [0.2, 0.9])
def test_exponential_average_crosses_blocks(spark, decay):
    rng = random.Random(1)
    values = {run: [rng.uniform(0.1, 90) for _ in range(n)] for run, n in (("a", 1300), ("b", 1), ("c", 249))}
    rows = [(run, i, v) for run, vs in values.items() for i, v in enumerate(vs)]
    frame = spark.createDataFrame(rows, "run string, i long, v double").repartition(5)
    got = {(r.run, r.i): r.ema for r in runs.exponential_average(frame, "run", "i", "v", "ema", decay).collect()}
    for run, vs in values.items():
        ema = vs[0]
        for i, v in enumerate(vs):
            ema = ema if i == 0 else decay * ema + (1 - decay) * v
            assert got[run, i] == pytest.approx(ema, rel=1e-12)


def test_running_mfu_starts_after_settling(spark):
    steps = spark.range(1, 21).select(F.lit("r").alias("run"), F.col("id").alias("step"), F.lit(0.5).alias("dt"))
    for interval, first in ((1, 5), (2, 6), (10, 10)):
        rows = runs.running_mfu(steps, "run", F.col("dt"), interval).orderBy("iter").collect()
        assert [r.iter for r in rows] == list(range(0, 20, interval))
        assert [r.running_mfu for r in rows] == [-1.0 if r.iter < first else pytest.approx(0.5) for r in rows]


def test_mfu_of_a_published_run(spark):
    share = spark.range(1).select(runs.mfu(F.lit(0.755), 123_551_232, 12, 12, 64, 1024, 100).alias("m")).first().m
    assert share == pytest.approx(0.3715, abs=1e-3)


def test_checkpoints_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK_ROWS", 4)
    rng = random.Random(3)
    losses = [round(rng.uniform(1, 9), 2) for _ in range(30)]
    frame = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(losses)], "run string, step long, loss double")
    rows = runs.checkpoint_decisions(frame, "run", "loss").orderBy("step").collect()
    best = 1e9
    for i, r in enumerate(rows):
        assert r.best_before == best and r.saves == (losses[i] < best and i > 0)
        assert r.best_before_always == (losses[i - 1] if i else 1e9) and r.saves_always == (i > 0)
        best = min(best, losses[i])


def test_logged_loss_takes_the_last_micro_step(spark):
    frame = spark.range(1, 13).select(F.lit(1).alias("run"), F.col("id").alias("step"), (F.col("id") / 4).alias("loss"))
    rows = runs.logged_loss(frame, "run", 4, 2).orderBy("iter").collect()
    assert [(r.iter, r.loss) for r in rows] == [(0, 4.0), (2, 12.0)]


def test_timing_leaves_out_the_burn_in_before_the_shuffle(spark):
    frame = spark.range(80).select(
        (F.col("id") % 2).alias("run"), F.expr("id div 2").alias("id"), F.expr("cast(id div 2 as double)").alias("ms")
    )
    timed = runs.timed_iterations(frame, "run", ["id"], "ms")
    row = timed.where("run = 1").first()
    assert (row.iterations, row.mean_ms) == (20, sum(range(10, 30)) / 20)
    assert "WindowGroupLimit" in timed._jdf.queryExecution().executedPlan().toString()


def test_log_lines(spark):
    lines = [
        "iter 10: loss 3.1416, time 755.00ms, mfu -100.00%",
        "step 1000: train loss 2.8500, val loss 2.9000",
        "saving checkpoint to out",
        "iter 1: loss x",
    ]
    frame = spark.createDataFrame([(s,) for s in lines], "line string")
    assert [tuple(r) for r in runlog.iteration_rows(frame).collect()] == [(10, 3.1416, 755.0, -100.0)]
    assert [tuple(r) for r in runlog.evaluation_rows(frame).collect()] == [(1000, 2.85, 2.9)]
    assert lines[0] == runlog.ITER_FORMAT % (10, 3.1416, 755, -100)


def test_json_rows(spark):
    frame = spark.createDataFrame([(1, "[[44e6, 512, 8], [1, 2]]"), (2, "[]")], "id int, j string")
    rows = runlog.json_rows(frame, "j", ["params", "width", "layers"]).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 44e6, 512.0, 8.0), (1, 1, 1.0, 2.0, None)]


def test_cosine_uses_pi():
    assert 0.5 * (1 + math.cos(math.pi)) == 0
