"""Queries of the sizing and scaling analysis over configurations and points taken from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.operators import asof, scaling
from tokenloom.plans.tables import table

SIZE_LIMIT = 20_000_000
RANKED = 10


def configs(spark: SparkSession, sf: str) -> DataFrame:
    """A model configuration per part, and the published presets with keys below 0."""
    key = F.col("p_partkey")
    block = (F.lit(256) * (1 + key % 4)).cast("int")
    width = (F.lit(64) * (1 + F.expr("p_partkey div 48") % 25)).cast("int")
    vocab = F.get(F.array(F.lit(65), F.lit(16000), F.lit(50257), F.lit(50304)), F.col("p_size") % 4)
    drawn = table(spark, sf, "part").select(
        "p_partkey",
        F.lit("").alias("preset"),
        (1 + key % 48).cast("int").alias("n_layer"),
        (1 + F.col("p_size") % 25).cast("int").alias("n_head"),
        width.alias("n_embd"),
        block.alias("block_size"),
        vocab.alias("vocab_size"),
        (width * 4).alias("ffw_size"),
    )
    listed = enumerate(scaling.PRESETS.items(), 1)
    presets = [(-i, name, layers, heads, d, 1024, 50257, 4 * d) for i, (name, (layers, heads, d)) in listed]
    return drawn.unionAll(spark.createDataFrame(presets, drawn.schema))


def sizing_sweep(spark: SparkSession, sf: str) -> DataFrame:
    sized = scaling.sizing(configs(spark, sf))
    rounded = ["palm_ratio", "relative_ratio", "memory_ratio", "training_days"]
    return sized.select(
        *[c for c in sized.columns if c not in rounded],
        *[F.round(c, 10).alias(c) for c in rounded],
    )


def sizing_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """The largest models below the size limit, a rank per number of layers so that no rank spans the whole table."""
    small = scaling.sizing(configs(spark, sf)).where(F.col("params") < SIZE_LIMIT)
    by_size = Window.partitionBy("n_layer").orderBy(F.desc("params"), "p_partkey")
    ranked = small.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= RANKED)
    return ranked.select("n_layer", "rank", "p_partkey", "n_head", "n_embd", "block_size", "vocab_size", "params")


def sizing_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return scaling.breakdown(configs(spark, sf), "p_partkey", "preset").withColumn("pct", F.round("pct", 9))


def loss_surface(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "orders").select(
        "o_orderkey",
        F.pow(F.lit(10.0), F.lit(7.0) + (F.col("o_orderkey") % 64) / 16.0).alias("n"),
        F.pow(F.lit(10.0), F.lit(9.0) + (F.col("o_custkey") % 48) / 16.0).alias("d"),
    )
    surface = scaling.loss_surface(points)
    return surface.select("o_orderkey", F.round("loss", 9).alias("loss"), F.round("log10_flops", 9).alias("log10_flops"))


def compute_optimal(spark: SparkSession, sf: str) -> DataFrame:
    budgets = table(spark, sf, "orders").select("o_orderkey", budget().alias("c"))
    best = scaling.compute_optimal(budgets)
    return best.select(
        "o_orderkey",
        F.round(F.log10("n"), 8).alias("log10_n"),
        F.round(F.log10("d"), 8).alias("log10_d"),
        F.round("loss", 9).alias("loss"),
    )


def budget():
    return F.pow(F.lit(10.0), F.lit(17.0) + (F.floor("o_totalprice") % scaling.BUDGETS) / 256.0)


def nearest_model(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") * 10000.0).alias("size"))
    found = scaling.nearest_model(sizes, scaling.optimal_models(spark), "size")
    return found.select(
        "o_orderkey",
        F.round(F.log10("n"), 8).alias("log10_n"),
        F.round(F.log10("d"), 8).alias("log10_d"),
        F.round(F.log10("flops"), 8).alias("log10_flops"),
        F.round("loss", 9).alias("loss"),
    )


def nearest_line(spark: SparkSession, sf: str) -> DataFrame:
    """The lineitem row whose price is closest to the total of an order, from a table that grows with the data."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").cast("double").alias("price"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    )
    totals = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("total"))
    found = asof.nearest(totals, lines, "total", "price", "line", "_m")
    return found.select("o_orderkey", F.col("_m.line").alias("line"), F.round("_m.price", 6).alias("price"))


def loglog_fit(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    fit = scaling.log_log_fit(points, "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    return fit.select(
        "l_returnflag",
        "l_linestatus",
        "points",
        F.round("slope", 9).alias("slope"),
        F.round("intercept", 9).alias("intercept"),
        F.round(scaling.fit_prediction(F.col("slope"), F.col("intercept"), 124.0), 4).alias("predicted"),
    )


QUERIES = {
    "sizing_sweep": sizing_sweep,
    "sizing_ranked": sizing_ranked,
    "sizing_breakdown": sizing_breakdown,
    "loss_surface": loss_surface,
    "compute_optimal": compute_optimal,
    "nearest_model": nearest_model,
    "nearest_line": nearest_line,
    "loglog_fit": loglog_fit,
}

PRESET_ROWS = ", ".join(
    f"({-i}, '{n}', {l}, {h}, {d}, 1024, 50257)" for i, (n, (l, h, d)) in enumerate(scaling.PRESETS.items(), 1)
)
CONFIGS = f"""configs AS (
    SELECT * FROM (
        SELECT p_partkey, '' AS preset, 1 + p_partkey % 48 AS l, 1 + p_size % 25 AS h,
               64 * (1 + (p_partkey // 48) % 25) AS d, 256 * (1 + p_partkey % 4) AS t,
               ([65, 16000, 50257, 50304])[p_size % 4 + 1] AS v FROM part
        UNION ALL VALUES {PRESET_ROWS})
    WHERE d % h = 0)"""
LOSS = "(406.4::DOUBLE / pow({n}, 0.34::DOUBLE) + 410.7::DOUBLE / pow({d}, 0.28::DOUBLE) + 1.69::DOUBLE)"
OPTIMAL = f"""sizes AS (SELECT i, pow(10.0::DOUBLE, 7 + i / 256.0::DOUBLE) AS n FROM range(1792) t(i)),
    budgets AS (SELECT b, pow(10.0::DOUBLE, 17 + b / 256.0::DOUBLE) AS c FROM range(2304) t(b)),
    cells AS (SELECT b, c, n, c / (6 * n) AS d FROM budgets CROSS JOIN sizes),
    losses AS (SELECT *, {LOSS.format(n="n", d="d")} AS loss FROM cells),
    best AS MATERIALIZED (
        SELECT b, arg_min(n, loss) AS n, arg_min(d, loss) AS d, min(loss) AS loss FROM losses GROUP BY b)"""

LAYERS = "l * (12 * d * d + 2 * d)"
PARAMS = [
    ("place_table", "d * t"), ("token_table", "d * v"), ("tables", "d * t + d * v"),
    ("first_scale", "l * d"), ("read_heads", "l * 3 * d * d"), ("join_heads", "l * d * d"), ("second_scale", "l * d"),
    ("widen", "l * 4 * d * d"), ("narrow", "l * 4 * d * d"), ("layers", LAYERS), ("last_scale", "d"), ("end", "d"),
    ("total", f"d * t + d * v + {LAYERS} + d"),
]
LAYER_FLOPS = "l * (24 * t * d * d + 4 * t * t * d)"
FORWARD = f"({LAYER_FLOPS} + 2 * t * d * v)"
FLOPS = [
    ("token_table", "2 * t * d * v"), ("read_heads", "l * 6 * t * d * d"), ("join_heads", "l * 2 * t * d * d"),
    ("widen", "l * 8 * t * d * d"), ("narrow", "l * 8 * t * d * d"), ("token_pairs", "l * 4 * t * t * d"),
    ("layers", LAYER_FLOPS), ("total", FORWARD),
]
TOTAL = PARAMS[-1][1]

ORACLE = {
    "sizing_sweep": f"""WITH {CONFIGS}, p AS (
            SELECT *, {TOTAL} AS params, 3 * {FORWARD} AS flops_total,
                   l * (4 * d * d + 4 * d + d * d + 2 * d + 8 * d * d + 5 * d + 4 * d) + 2 * d + d * v AS rel,
                   3 * l * (6 * t * d * d + 2 * t * t * d + 3 * h * t * t + 2 * t * t * d + 2 * t * d * d + 16 * t * d * d) AS frel
            FROM configs)
        SELECT p_partkey, preset, l::INTEGER AS n_layer, h::INTEGER AS n_head, d::INTEGER AS n_embd, t::INTEGER AS block_size,
               v::INTEGER AS vocab_size, (4 * d)::INTEGER AS ffw_size, params, params - d * t AS params_no_position,
               l * (12 * d * d + 13 * d) + 2 * d + d * v AS params_biased, rel AS params_relative, frel AS flops_relative,
               d * t + d * v + 12 * l * d * d AS params_decayed, (2 * l + 1) * d AS params_not_decayed,
               {FORWARD} AS flops_forward, 2 * {FORWARD} AS flops_backward, flops_total,
               (6 * (params - d * t) + 12 * l * d * t) * t AS flops_palm, 12 * params AS checkpoint_bytes,
               round((6 * (params - d * t) + 12 * l * d * t) * t / flops_total, 10) AS palm_ratio,
               round(frel / (6.0::DOUBLE * rel * t), 10) AS relative_ratio,
               round(12 * params / 40e9::DOUBLE, 10) AS memory_ratio,
               round(6.0::DOUBLE * params * 300e9::DOUBLE / (312e12::DOUBLE * 8 * 0.3::DOUBLE) / 86400, 10) AS training_days
        FROM p""",
    "sizing_ranked": f"""WITH {CONFIGS}, ranked AS (
            SELECT *, {TOTAL} AS params, row_number() OVER (PARTITION BY l ORDER BY {TOTAL} DESC, p_partkey) AS rank
            FROM configs WHERE {TOTAL} < {SIZE_LIMIT})
        SELECT l::INTEGER AS n_layer, rank::INTEGER AS rank, p_partkey, h::INTEGER AS n_head, d::INTEGER AS n_embd,
               t::INTEGER AS block_size, v::INTEGER AS vocab_size, params FROM ranked WHERE rank <= {RANKED}""",
    "sizing_breakdown": f"WITH {CONFIGS} "
    + " UNION ALL ".join(
        f"SELECT p_partkey, preset, '{measure}' AS measure, '{name}' AS component, ({amount})::BIGINT AS amount, "
        f"round(({amount}) / ({total}) * 100, 9) AS pct FROM configs"
        for measure, parts, total in (("params", PARAMS, TOTAL), ("flops", FLOPS, FORWARD))
        for name, amount in parts
    ),
    "loss_surface": f"""WITH points AS (
            SELECT o_orderkey, pow(10.0::DOUBLE, 7 + (o_orderkey % 64) / 16.0::DOUBLE) AS n,
                   pow(10.0::DOUBLE, 9 + (o_custkey % 48) / 16.0::DOUBLE) AS d FROM orders)
        SELECT o_orderkey, round({LOSS.format(n="n", d="d")}, 9) AS loss, round(log10(6 * n * d), 9) AS log10_flops
        FROM points""",
    "compute_optimal": f"""WITH {OPTIMAL}
        SELECT o_orderkey, round(log10(n), 8) AS log10_n, round(log10(d), 8) AS log10_d, round(loss, 9) AS loss
        FROM orders JOIN best ON b = floor(o_totalprice)::BIGINT % 2304""",
    "nearest_model": f"""WITH {OPTIMAL},
        firsts AS (SELECT n, arg_min(d, b) AS d, arg_min(loss, b) AS loss, min(b) AS b FROM best GROUP BY n),
        found AS (
            SELECT o_orderkey, arg_min(f, [abs(f.n - o_totalprice * 10000), f.b]) AS m FROM orders CROSS JOIN firsts f
            GROUP BY o_orderkey)
        SELECT o_orderkey, round(log10(m.n), 8) AS log10_n, round(log10(m.d), 8) AS log10_d,
               round(log10(6 * m.n * m.d), 8) AS log10_flops, round(m.loss, 9) AS loss
        FROM found""",
    "nearest_line": """WITH firsts AS (
            SELECT l_extendedprice::DOUBLE AS v, min(l_orderkey * 8 + l_linenumber)::BIGINT AS line FROM lineitem GROUP BY 1),
        totals AS (SELECT o_orderkey, o_totalprice::DOUBLE AS total FROM orders),
        below AS (SELECT o_orderkey, total, v, line FROM totals ASOF LEFT JOIN firsts ON total >= v),
        above AS (SELECT o_orderkey, v AS v2, line AS line2 FROM totals ASOF LEFT JOIN firsts ON total <= v),
        picked AS (
            SELECT *, v2 IS NULL OR (v IS NOT NULL AND (total - v < v2 - total OR (total - v = v2 - total AND line <= line2))) AS low
            FROM below JOIN above USING (o_orderkey))
        SELECT o_orderkey, CASE WHEN low THEN line ELSE line2 END AS line, round(CASE WHEN low THEN v ELSE v2 END, 6) AS price
        FROM picked""",
    "loglog_fit": """WITH fit AS (
            SELECT l_returnflag, l_linestatus, count(*) AS points,
                   regr_slope(log10(l_extendedprice), log10(l_quantity)) AS slope,
                   regr_intercept(log10(l_extendedprice), log10(l_quantity)) AS intercept
            FROM lineitem GROUP BY l_returnflag, l_linestatus)
        SELECT l_returnflag, l_linestatus, points, round(slope, 9) AS slope, round(intercept, 9) AS intercept,
               round(pow(10.0::DOUBLE, slope * log10(124.0::DOUBLE) + intercept), 4) AS predicted FROM fit""",
}
