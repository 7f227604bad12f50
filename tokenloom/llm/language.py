"""Language identification: Bayesian fusion of text, declared language, address suffix and host.

* Text: log likelihoods of byte trigrams per language, counted over all documents outside the held-out fold. A long text
  gives no more evidence than `EVIDENCE` trigrams would, as its trigrams are not independent.
* Markup and address: the declared language of a page and the language-like part of its address are noisy
  witnesses. How often each value goes with each language is counted over all pages by their text's language.
* Host: the share of a language among the other pages of a host, smoothed towards that of the domain above it, which is smoothed
  towards that of all pages. A document's host is its source. The row's own count is left out.

The posterior is the normalised product. Missing evidence says nothing: null or empty text, no declaration, no address. A row
without any evidence gets the overall shares. Ties go to the language first in order. Without labelled documents the
result has null languages. Repeated rows and ids are rows of their own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.extract import main_text
from tokenloom.llm.quality import held_out
from tokenloom.llm.storage import written
from tokenloom.llm.words import slices, text_buffers

BUCKETS = 1 << 16
EVIDENCE = 60
# Keys that rows without a witness are spread over in its join.
SPREAD = 1 << 14
# More declared languages than this are no label of a classifier.
MOST_LANGUAGES = 256
TRIGRAM_SMOOTHING = 0.5
WITNESS_SMOOTHING = 1.0
HOST_STRENGTH, DOMAIN_STRENGTH = 10.0, 50.0
GRAM_BASES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
LANGUAGE_TAG = "(?i)<html(?=\\s)[^>]*?\\slang\\s*=\\s*[\"']?([a-z]{2,3})"
# The language part of an address: a first label, a first folder, or a parameter of two letters.
SUFFIXES = ["(?i)^[a-z]+://[^/?#]+/([a-z]{2})(?:[-_][a-z]{2})?(?:[/?#]|$)", "(?i)[?&](?:lang|hl|locale)=([a-z]{2})\\b", "(?i)^[a-z]+://[^/?#:]+\\.([a-z]{2})(?:[:/?#]|$)"]
HOST = "(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes that begin at every byte but the last two; letters in ASCII count in lower case."""
    lower = data.astype(np.uint32)
    lower += np.where((lower >= 65) & (lower <= 90), 32, 0).astype(np.uint32)
    mixed = lower[:-2] * np.uint32(GRAM_BASES[0]) ^ lower[1:-1] * np.uint32(GRAM_BASES[1]) ^ lower[2:] * np.uint32(GRAM_BASES[2])
    return (mixed * np.uint32(GRAM_BASES[0])) >> np.uint32(16)


def _bucket_counts(languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), BUCKETS), np.int64)
        number = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            for part in slices(batch, 1):
                offsets, data = text_buffers(part.column(1))
                for row, name in enumerate(part.column(0).to_pylist()):
                    own = data[offsets[row] : offsets[row + 1]]
                    if len(own) > 2:
                        totals[number[name]] += np.bincount(trigrams(own), minlength=BUCKETS)
        which, bucket = np.nonzero(totals)
        columns = [pa.array([languages[i] for i in which], pa.string()), pa.array(bucket.astype(np.int32)), pa.array(totals[which, bucket])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    return count


class TextModel:
    """Log likelihood of a trigram's bucket per language."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log likelihoods per text and language, relative to the best, with at most `EVIDENCE` trigrams' weight."""
        out = np.zeros((len(texts), len(self.languages)))
        offsets, data = text_buffers(texts)
        for row in range(len(texts)):
            own = data[offsets[row] : offsets[row + 1]]
            if len(own) > 2:
                seen = np.bincount(trigrams(own), minlength=BUCKETS)
                total = seen @ self.table
                out[row] = total * (min(len(own) - 2, EVIDENCE) / (len(own) - 2))
        return out - out.max(axis=1, keepdims=True)


def train_text(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> TextModel:
    """Counts trigrams of all documents that have a language and lie outside the held-out fold."""
    known = docs.where(docs[lang].isNotNull() & ~held_out(docs[doc_id])).select(docs[lang].cast("string").alias("lang"), docs[text].alias("text"))
    languages = sorted(r["lang"] for r in known.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counted = known.mapInArrow(_bucket_counts(languages), "lang string, bucket int, n long")
    # At most BUCKETS rows per language, whatever the corpus.
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((BUCKETS, max(1, len(languages))), TRIGRAM_SMOOTHING)
    for i, name in enumerate(languages):
        own = table[table["lang"] == name]
        counts[own["bucket"].to_numpy(), i] += own["n"].to_numpy()
    return TextModel(languages, np.log(counts / counts.sum(axis=0))[:, : len(languages)])


def _evidence(model: TextModel, pages: bool):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                texts = part.column(part.num_columns - 1)
                if pages:
                    texts = pa.array([main_text(h.as_py()) for h in texts], pa.string())
                found = model.evidence(texts)
                lists = pa.array(list(found), pa.list_(pa.float64()))
                # No text, no guess: such a row is no witness for its host.
                some = [bool(t.as_py()) and len(model.languages) > 0 and bool(found[i].any()) for i, t in enumerate(texts)]
                guess = pa.array([int(found[i].argmax()) if some[i] else None for i in range(len(some))], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, guess], [*part.schema.names[:-1], "evidence", "guess"])

    return judge


EVIDENCE_TYPE = "doc_id long, page_id long, host string, domain string, declared string, suffix string, evidence array<double>, guess int"


def domain_above(host: Column) -> Column:
    """The last two labels of a host; a host of fewer labels is its own domain."""
    return F.regexp_extract(host, "([^.]+\\.[^.]+)$", 1)


def documents_and_pages(docs: DataFrame, pages: DataFrame, model: TextModel) -> DataFrame:
    """Every row with its text evidence, its guess by text alone, and its other witnesses."""
    none = F.lit(None).cast("string")
    no_id = F.lit(None).cast("long")
    from_docs = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), no_id.alias("page_id"), docs["source"].cast("string").alias("host"),
        none.alias("domain"), none.alias("declared"), none.alias("suffix"), docs["text"].alias("text"),
    ).mapInArrow(_evidence(model, False), EVIDENCE_TYPE)
    url = pages["url"].cast("string")
    found = lambda pattern, column: F.nullif(F.lower(F.regexp_extract(column, pattern, 1)), F.lit(""))
    host = found(HOST, url)
    domain = domain_above(host)
    from_pages = pages.select(
        no_id.alias("doc_id"), pages["page_id"].cast("long").alias("page_id"), host.alias("host"),
        F.when(domain == "", host).otherwise(domain).alias("domain"), found(LANGUAGE_TAG, pages["html"]).alias("declared"),
        F.coalesce(*[found(p, url) for p in SUFFIXES]).alias("suffix"), pages["html"].alias("html"),
    ).mapInArrow(_evidence(model, True), EVIDENCE_TYPE)
    return from_docs.unionAll(from_pages)


def _counts(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """Per key, how many rows are guessed to be in each language, as one array."""
    known = rows.where(F.col("guess").isNotNull())
    sums = [F.coalesce(F.sum(F.when(F.col("guess") == i, 1.0)), F.lit(0.0)) for i in range(size)]
    return known.groupBy(*keys).agg(F.array(*sums).alias(name))


def _with_counts(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of the rows that have the witness; the others, often nearly all, are spread by a key that nothing has."""
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("doc_id", "page_id"), F.lit(SPREAD)).cast("string"))
    keyed = rows.withColumn("_key", F.coalesce(F.col(keys[0]), spread))
    sought = counts.where(F.col(keys[0]).isNotNull()).withColumnRenamed(keys[0], "_key")
    return keyed.join(sought, ["_key", *keys[1:]], "left").drop("_key")


def identify(docs: DataFrame, pages: DataFrame, model: TextModel | None = None) -> DataFrame:
    """(`doc_id`, `page_id`, `lang`, `confidence`, `text_lang`) of every document and every page; one id is null."""
    model = model or train_text(docs)
    size = len(model.languages)
    if not size:
        nothing = F.lit(None).cast("string")
        none = F.lit(None).cast("long")
        both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), none.alias("page_id")).unionAll(
            pages.select(none.alias("doc_id"), F.col("page_id").cast("long").alias("page_id"))
        )
        return both.select("*", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_lang"))
    rows = written(documents_and_pages(docs, pages, model), "evidence")
    rows = rows.withColumn("place", F.when(F.col("doc_id").isNotNull() | F.col("domain").isNull(), F.lit("source")).otherwise(F.lit("host")))
    total = rows.where("guess is not null").groupBy("guess").count().collect()
    overall = np.ones(size)
    for r in total:
        overall[r["guess"]] += r["count"]
    shares = F.array(*[F.lit(float(v)) for v in overall / overall.sum()])

    own = F.array(*[F.when(F.col("guess") == i, 1.0).otherwise(0.0) for i in range(size)])
    zeros = F.array(*[F.lit(0.0)] * size)
    # Written, so that a join with a hot host reads two plain shuffles, whose large partitions Spark splits.
    by_host = written(_counts(rows, ["place", "host"], size, "host_counts"), "hosts")
    by_domain = written(_counts(rows.where("domain is not null"), ["domain"], size, "domain_counts"), "domains")
    placed = _with_counts(_with_counts(rows, by_host, ["host", "place"]), by_domain, ["domain"])
    for witness in ("declared", "suffix"):
        counts = _counts(rows.where(f"{witness} is not null"), [witness], size, f"{witness}_counts")
        placed = _with_counts(placed, written(counts, witness), [witness])
    totals = F.array(*[F.lit(float(v)) for v in overall])

    def less_own(counts: str) -> Column:
        return F.zip_with(F.coalesce(F.col(counts), zeros), own, lambda n, o: F.greatest(n - o, F.lit(0.0)))

    def smoothed(counts: Column, above: Column, strength: float) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, p: (c + p * strength) / (n + strength))

    def witness(name: str) -> Column:
        # The share of a language's rows that show this value; the row's own guess does not speak for itself.
        seen = F.zip_with(less_own(f"{name}_counts"), totals, lambda c, t: F.log((c + WITNESS_SMOOTHING) / (t + 2 * WITNESS_SMOOTHING)))
        return F.when(F.col(name).isNotNull(), seen).otherwise(zeros)

    prior = smoothed(less_own("host_counts"), smoothed(less_own("domain_counts"), shares, DOMAIN_STRENGTH), HOST_STRENGTH)
    parts = [F.transform(prior, lambda p: F.log(p)), witness("declared"), witness("suffix")]
    logs = F.col("evidence")
    for part in parts:
        logs = F.zip_with(logs, part, lambda a, b: a + b)
    names = F.array(*map(F.lit, model.languages))
    best = F.array_max("logs")
    return (
        placed.withColumn("logs", logs)
        .withColumn("best", best)
        .select(
            "doc_id",
            "page_id",
            F.element_at(names, F.array_position("logs", F.col("best")).cast("int")).alias("lang"),
            (F.lit(1.0) / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))).alias("confidence"),
            F.when(F.col("guess").isNotNull(), F.element_at(names, F.col("guess") + 1)).alias("text_lang"),
        )
    )
