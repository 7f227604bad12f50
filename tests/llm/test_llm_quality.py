import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.train(docs, labels)
    scored = quality.scored(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    rows = scored.join(labels, "doc_id").select("score", "quality", quality.held_out(F.col("doc_id")).alias("held_out")).collect()
    held = [(r.score, r.quality) for r in rows if r.held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert len(held) > 50 and all(0 <= s <= 1 for s, _ in held)
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= quality.CUT for s in good]) > 0.97


def test_the_expression_equals_the_rules(spark):
    rng = np.random.default_rng(5)
    names = list(quality.statistics(F.col("text")))
    texts = ["", None, "One two. Three!", "A!! B!! C!!", "x | y | z", "the the the the", "Ünï &&& 12"] * 30
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    values = docs.select("doc_id", *[v.alias(n) for n, v in quality.statistics(F.col("text")).items()]).orderBy("doc_id").toPandas()
    x = values[names].to_numpy(float)
    y = (x[:, names.index("bang")] < 0.01).astype(int)
    y[rng.random(len(y)) < 0.05] ^= 1
    model = quality.fit(names, x, y)
    assert model.rules
    total = np.full(len(x), model.bias)
    for weight, rule in model.rules:
        total += weight * quality._holds(rule, names, x)
    got = quality.scored(docs, model).orderBy("doc_id").toPandas()["score"]
    assert np.allclose(got, 1 / (1 + np.exp(-total)))


def test_fold_rule(spark):
    got = spark.range(200).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
    assert not spark.range(1).select(quality.held_out(F.lit(None).cast("long")).alias("h")).first().h


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(None, 1, 0), (7, None, 0), (99, 0, 0)]])
def test_too_little_to_learn_from(spark, labels):
    docs = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (2, "", "z"), (None, "b " * 50_000, "w")], "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, known)
    got = quality.scored(docs, model, name="p").collect()
    assert len(got) == 4 and len({r.p for r in got}) == 1 and {r.score for r in got} == {"x", "y", "z", "w"}
    assert quality.keep_good(docs, known).columns == docs.columns
    assert quality.keep_good(docs.limit(0), known).count() == 0
