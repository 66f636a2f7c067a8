"""Language identification by Bayesian fusion of evidence.

The text gives a likelihood per language (hashed character trigrams, weighed down to a bounded number of independent
observations, since trigrams of one text depend on each other). It is combined with the language that the markup or the
metadata declares, and with a prior for the address: the posteriors by text alone are summed by host, by domain and by
address suffix, and each level is smoothed towards the next wider one, the widest being all rows. Every row is left out of
the sums that make its own prior.

The labels are counted over all rows, and each language's trigram model is fitted on at most SAMPLE_DOCS of its labelled
rows (equal rows count once); all rows take part in the sums. Only the MOST_LANGUAGES languages with the most rows have a
model. Where there are more, a row that declares one without a model is declared only: it is taken to be of that language
(posterior DECLARED_RIGHT), kept if it is readable, and takes no part in the sums.

A row is rejected if its text holds no trigram of letters, if the text is less likely under the best language than chance
(all trigrams equally likely), or if no language reaches LEAST_POSTERIOR.

Defined results: null and empty texts are rejected, with language null and posterior 0; a null declared language, or one
that no label names, says nothing; a null address has only the widest prior; repeated rows get equal results; without labelled rows
all rows are rejected; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import bounded_batches, claim, mixed, stored
from clickmill.llm.tokens import portions

SAMPLE_DOCS = 2_000  # for each language
BUCKET_BITS = 15
SMOOTHING = 0.5
# Languages with a model, which takes 256 KB; there are about 180 with a code of two letters.
MOST_LANGUAGES = 256
TEXT_OBSERVATIONS = 60
# Chance that a declared language is right, and rows of its parent that the prior of an address level is worth.
DECLARED_RIGHT = 0.85
LEVEL_STRENGTH = 20.0
LEAST_POSTERIOR = 0.6

# Three letters, as ``trigram_buckets`` takes them: a text that has trigrams for certain.
_LETTER = r"A-Za-z\x{C0}-\x{1FFF}\x{3040}-\x{10FFFF}"
_READABLE = rf"[{_LETTER}](?:[^{_LETTER}]*[{_LETTER}]){{2}}"
_TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;")


def trigram_buckets(text: str) -> np.ndarray:
    """Bucket numbers of the trigrams of letters and single blanks of the lowered text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    # Letters: a-z and everything beyond the signs of Latin-1; all else is a blank, runs of which count once.
    letter = ((codes >= 97) & (codes <= 122)) | ((codes >= 0xC0) & (codes < 0x2000)) | (codes >= 0x3040)
    codes = np.where(letter, codes, np.uint64(32))
    codes = codes[np.append(True, letter[1:] | letter[:-1])] if len(codes) else codes
    if len(codes) < 3 or not letter.any():
        return np.zeros(0, np.int64)
    grams = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    return (mixed(grams) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def visible_text(html: str) -> str:
    """The text between the tags of a page, without scripts, styles and comments."""
    return _TAGS.sub(" ", html)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim()
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if lang not in counts:
                counts[lang] = np.zeros(1 << BUCKET_BITS, np.int64)
            counts[lang] += np.bincount(trigram_buckets(text), minlength=1 << BUCKET_BITS)
    for lang, table in counts.items():
        at = np.flatnonzero(table)
        columns = [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(table[at])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


def _labelled_sample(docs: DataFrame, sample: int) -> DataFrame:
    """lang, text: for each of the MOST_LANGUAGES most frequent labels at most ``sample`` rows, those with the smallest hash.

    As in ``sampled``, thresholds on the hash leave few rows to sort; each language keeps its smallest one.
    """
    labelled = docs.filter("lang is not null and text is not null").select(F.lower("lang").alias("lang"), "doc_id", "text")
    readable = labelled.filter(F.col("text").rlike(_READABLE)).select("lang", "text", F.xxhash64("doc_id", "lang", "text").alias("number"))
    counts = readable.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("number").alias("n_distinct"), F.min("number").alias("least")
    )
    most = counts.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    share = F.least(F.lit(1.0), 1.5 * (sample + 100) / F.col("n_distinct"))
    limits = most.select("lang", "least", ((2 * share - 1) * 2.0**63).alias("limit"))
    near = readable.join(F.broadcast(limits), "lang").filter((F.col("number").cast("double") <= F.col("limit")) | (F.col("number") == F.col("least")))
    once = near.groupBy("lang", "number").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("number"))
    return once.withColumn("place", place).filter(F.col("place") <= sample).select("lang", "text")


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """The languages, and log-probabilities by language and bucket, from at most ``sample`` rows a language of doc_id, text, lang."""
    counted = _labelled_sample(docs, sample).mapInArrow(_bucket_counts, "lang string, bucket bigint, n bigint")
    with bounded_batches(docs.sparkSession):
        rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = rows["lang"].combine_chunks().dictionary_encode()
    langs = sorted(names.dictionary.to_pylist())
    order = np.array([langs.index(lang) for lang in names.dictionary.to_pylist()], np.int64)
    table = np.full((len(langs), 1 << BUCKET_BITS), SMOOTHING)
    if langs:
        table[order[names.indices.to_numpy()], rows["bucket"].to_numpy()] += rows["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def _evidence(model: np.ndarray):
    """key, host, declared, n_grams, logs: the mean log-probability per language, relative to chance."""
    chance = -np.log(float(1 << BUCKET_BITS))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        table = np.ascontiguousarray(model.T.astype(np.float32))
        for batch in portions(batches, 4):
            sizes, logs = [], []
            for html, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                grams = trigram_buckets(visible_text(text) if html else text) if text else np.zeros(0, np.int64)
                # A bucket at a time: repeated trigrams are counted first, so the table is read once for each.
                count = np.bincount(grams, minlength=1 << BUCKET_BITS) if len(grams) > 20_000 else None
                total = count @ table if count is not None else table[grams].sum(axis=0, dtype=float)
                sizes.append(len(grams))
                logs.append((total / len(grams) - chance).tolist() if len(grams) else [0.0] * table.shape[1])
            columns = [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(logs, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "host", "declared", "n_grams", "logs"])

    return weigh


def _softmax(logs: Column, prior: Column | None = None) -> Column:
    """The logs as probabilities, with a prior per language if given."""
    most = F.array_max(logs)
    chances = F.transform(logs, lambda x: F.exp(x - most))
    chances = F.zip_with(chances, prior, lambda a, b: a * b) if prior is not None else chances
    total = F.aggregate(chances, F.lit(0.0), lambda a, b: a + b)
    return F.transform(chances, lambda x: x / total)


def address_levels(host: Column) -> list[Column]:
    """The host, its domain (the last two labels) and its suffix (the last label)."""
    return [host.alias("host"), F.substring_index(host, ".", -2).alias("domain"), F.substring_index(host, ".", -1).alias("suffix")]


def _summed(rows: DataFrame, by: list[str], n_langs: int, name: str) -> DataFrame:
    """by, ``name``: posteriors by text alone, summed; one column per language, so that sums are made before the shuffle."""
    sums = rows.groupBy(*by).agg(*[F.sum(F.element_at("alone", i + 1)).alias(f"s{i}") for i in range(n_langs)])
    return sums.select(*by, F.array(*[F.coalesce(f"s{i}", F.lit(0.0)) for i in range(n_langs)]).alias(name))


def _smoothed(sums: str, parent: Column, own: Column) -> Column:
    """Prior of a level without the row's own share: its sums with LEVEL_STRENGTH rows of the wider level."""
    rest = F.zip_with(F.col(sums), own, lambda s, o: F.greatest(s - o, F.lit(0.0)))
    total = F.aggregate(rest, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(rest, parent, lambda r, p: (r + p * LEVEL_STRENGTH) / (total + LEVEL_STRENGTH))


def identify(rows: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """key, declared, lang, posterior, text_lang, n_grams, kept for rows of key, host, declared, html, text."""
    texts = rows.select(
        F.col("key").cast("bigint"), F.col("host").cast("string"), F.lower(F.col("declared").cast("string")).alias("declared"),
        "html", F.col("text").cast("string"),
    )
    columns = "key bigint, host string, declared string, n_grams bigint, logs array<double>"
    if not langs:
        none = F.lit(None).cast("string")
        return texts.select(
            "key", "declared", none.alias("lang"), F.lit(0.0).alias("posterior"), none.alias("text_lang"),
            F.lit(0).cast("bigint").alias("n_grams"), F.lit(False).alias("kept"),
        )
    weighed = texts.mapInArrow(_evidence(model), columns)
    known = F.col("declared").isin(langs)
    # Where all labelled languages have a model, one without it is unknown.
    declared_only = F.coalesce(F.lit(len(langs) >= MOST_LANGUAGES) & ~known, F.lit(False))
    observed = F.least("n_grams", F.lit(TEXT_OBSERVATIONS)).cast("double")
    scaled = F.transform("logs", lambda x: x * observed)
    levels = address_levels(F.coalesce("host", F.lit("")))
    alone = stored(weighed.select("key", *levels, "declared", "n_grams", "logs", scaled.alias("scaled"), _softmax(scaled).alias("alone")), "evidence")

    counted = alone.filter((F.col("n_grams") > 0) & ~declared_only)
    n = len(langs)
    by_host = stored(_summed(counted, ["host", "domain", "suffix"], n, "host_sums"), "hosts")

    def wider(sums: DataFrame, by: list[str], below: str, name: str) -> DataFrame:
        return _summed(sums.withColumnRenamed(below, "alone"), by, n, name)

    by_domain = wider(by_host, ["domain", "suffix"], "host_sums", "domain_sums")
    by_suffix = wider(by_domain, ["suffix"], "domain_sums", "suffix_sums")
    overall = wider(by_suffix, [], "suffix_sums", "all_sums")
    priors = by_host.join(by_domain, ["domain", "suffix"]).join(by_suffix, "suffix").join(F.broadcast(overall)).drop("domain", "suffix")

    # By host only the rows' own sums are joined; a crowded host is split like any large key.
    joined = alone.join(priors, "host", "left")
    nothing = F.array_repeat(F.lit(0.0), n)
    own = F.when(F.col("n_grams") > 0, F.col("alone")).otherwise(nothing)
    for name in ("host_sums", "domain_sums", "suffix_sums", "all_sums"):
        joined = joined.withColumn(name, F.coalesce(name, nothing))
    prior = F.array_repeat(F.lit(1.0 / n), n)
    for name in ("all_sums", "suffix_sums", "domain_sums", "host_sums"):
        joined = joined.withColumn(f"{name}_prior", _smoothed(name, prior, own))
        prior = F.col(f"{name}_prior")
    right = [F.when(F.col("declared") == lang, DECLARED_RIGHT).otherwise((1 - DECLARED_RIGHT) / max(1, n - 1)) for lang in langs]
    declared = F.when(known, F.array(*right)).otherwise(F.array_repeat(F.lit(1.0), n))
    fused = joined.withColumn("fused", _softmax(F.col("scaled"), F.zip_with(prior, declared, lambda p, d: p * d)))
    names = F.array(*[F.lit(lang) for lang in langs])
    readable = F.col("n_grams") > 0

    def best(chances: str) -> Column:
        return F.element_at(names, F.array_position(chances, F.array_max(chances)).cast("int"))

    posterior = F.when(readable & declared_only, DECLARED_RIGHT).when(readable, F.array_max("fused")).otherwise(0.0)
    kept = readable & (declared_only | (F.array_max("logs") > 0) & (posterior >= LEAST_POSTERIOR))
    lang = F.when(declared_only, F.col("declared")).otherwise(best("fused"))
    return fused.select(
        "key", "declared", F.when(readable, lang).alias("lang"), posterior.alias("posterior"),
        F.when(readable, best("alone")).alias("text_lang"), "n_grams", kept.alias("kept"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence: their metadata declares a language, and their source is the host."""
    return docs.select(F.col("doc_id").alias("key"), F.col("source").alias("host"), F.col("lang").alias("declared"), F.lit(False).alias("html"), "text")


def page_rows(pages: DataFrame) -> DataFrame:
    """Web pages as evidence: the markup declares a language, and the address names the host."""
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return pages.select(
        F.col("page_id").alias("key"), F.when(host != "", host).alias("host"), F.when(declared != "", declared).alias("declared"),
        F.lit(True).alias("html"), F.col("html").alias("text"),
    )
