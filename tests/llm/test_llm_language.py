import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import language
from tokenloom.llm.quality import held_out

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, confidence string"
PAGES = "page_id long, url string, html string, domain string"


@pytest.fixture(scope="module")
def model(spark):
    return language.train_text(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs, pages = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "pages"))
    got = language.identify(docs, pages, model)
    assert got.count() == docs.count() + pages.count()
    held = got.join(docs.where(held_out(F.col("doc_id"))).select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert len(held) > 100 and np.mean([r.lang == r.truth for r in held]) > 0.98
    marked = pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("truth"))
    assert np.mean([r.lang == r.truth for r in got.join(marked, "page_id").collect()]) > 0.98


def test_evidence_beats_each_other_by_bayes(spark, model):
    english = "<article>The and attion to thanedble the, anea. Eriner of thanea with this</article>"
    french = "<article>Éanré de la èque pour les queçé, eauê et dans une eauché</article>"
    pages = [(i, f"https://a{i}.example.com/en/{i}", f'<html lang="en">{english}', "x") for i in range(30)]
    pages += [(100 + i, f"https://b{i}.example.org/fr/{i}", f'<html lang="fr">{french}', "x") for i in range(30)]
    # No text at all: declaration and address decide; no evidence but the host: its other pages do.
    pages += [(200, "https://z.example.net/fr/1", '<html lang="fr">', "x"), (201, "https://b1.example.org/", "", "x"), (202, None, None, None)]
    # Clear text stands against a wrong declaration.
    pages += [(203, "https://c.example.net/", '<html lang="en">' + french * 3, "x")]
    docs = spark.createDataFrame([], DOCS)
    got = {r.page_id: r for r in language.identify(docs, spark.createDataFrame(pages, PAGES), model).collect()}
    assert len(got) == len(pages)
    assert {got[i].lang for i in range(30)} == {"en"} and {got[100 + i].lang for i in range(30)} == {"fr"}
    assert got[200].lang == "fr" and got[200].text_lang is None
    assert got[201].lang == "fr" and got[203].lang == "fr"
    assert got[202].lang in model.languages and 0 < got[202].confidence <= 1


def test_text_model_equals_direct_sums(model):
    texts = ["The and of it", "", None, "de", "Éanré de la"]
    found = model.evidence(pa.array(texts))
    data = np.frombuffer("Éanré de la".encode(), np.uint8)
    direct = model.table[language.trigrams(data)].sum(axis=0)
    assert np.allclose(found[4], direct - direct.max())
    assert not found[1].any() and not found[2].any() and not found[3].any()


def test_cases(spark, model):
    rows = [(1, "the and of the thing with", "en", "s", "x"), (1, "the and of the thing with", "en", "s", "x"), (None, None, None, None, None), (2, "", "en", "s", "x"), (3, "the of and " * 100_000, "en", "t", "x")]
    docs, pages = spark.createDataFrame(rows, DOCS), spark.createDataFrame([], PAGES)
    got = language.identify(docs, pages, model).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "3", "None"]
    assert all(r.lang in model.languages for r in got)
    assert {r.lang for r in got if r.doc_id in (1, 3)} == {"en"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang for r in language.identify(unlabelled, pages).collect()} == {None}
    assert language.identify(docs.limit(0), pages).count() == 0


def test_declared_language_stands_anywhere_in_the_tag(spark):
    from pyspark.sql import functions as F

    tags = {
        f"<html data-x='{'y' * 2000}' lang=\"fr\">": "fr",
        "<HTML LANG=de>": "de",
        "<html lang = 'es-MX' class=x>": "es",
        "<html class=x><p lang=en>": "",
        "<htmlx lang=en>": "",
    }
    rows = spark.createDataFrame([(t,) for t in tags], "html string")
    found = [r[0] for r in rows.select(F.lower(F.regexp_extract("html", language.LANGUAGE_TAG, 1))).collect()]
    assert found == list(tags.values())
