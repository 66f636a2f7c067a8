"""The corpus pipeline: documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and returns a DataFrame; it is
written as Parquet and read again before the next stage. All stages but the last return the columns of their input.

A stage's decisions are carried by a row key, the hash of doc_id and text: different texts under one doc_id, and rows without
a doc_id, are decided each by itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm import decontamination, language, near_dedup, packing, pii
from clickmill.llm.common import importable, small_side, stored, table


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with their row key as doc_id."""
    return docs.withColumn("doc_id", _row_key())


def _without(docs: DataFrame, refused: DataFrame) -> DataFrame:
    """The documents whose row key is not among the refused ones, which stand in doc_id."""
    ids = stored(refused.select(F.col("doc_id").alias("refused_key")).distinct(), "refused")
    side = small_side(ids, ids.count(), 16)
    return docs.join(side, _row_key() == side["refused_key"], "left_anti")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    importable(spark)
    langs, model = language.train(docs)
    found = language.identify(language.document_rows(_keyed(docs)), langs, model)
    by_key = found.groupBy(F.col("key").alias("doc_id")).agg(F.max("kept").alias("kept"))
    return _without(docs, by_key.filter("not kept"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id (none counts last); repeated rows go as well."""
    importable(spark)
    found = stored(near_dedup.near_duplicates(_keyed(docs)).select("doc_id", "component_id").distinct(), "found")
    ids = docs.select(_row_key().alias("doc_id"), F.col("doc_id").cast("bigint").alias("id")).distinct()
    order = F.struct(F.col("id").isNull().alias("last"), "id", "doc_id")
    several = found.filter(F.col("doc_id") != F.col("component_id")).select("component_id").distinct()
    groups = stored(found.join(several, "component_id", "left_semi").join(ids, "doc_id"), "groups")
    first = groups.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first")["doc_id"].alias("doc_id"))
    rest = _without(docs, groups.select("doc_id").join(first, "doc_id", "left_anti"))
    return rest.withColumn("row_key", _row_key()).dropDuplicates(["row_key"]).drop("row_key")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, also not with other numbers or names."""
    importable(spark)
    leaks = decontamination.leaks(_keyed(docs), table(spark, sf_dir, "benchmark"))
    return _without(docs, leaks)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind, and their new lengths."""
    importable(spark)
    redacted = pii.redact(docs)
    length = F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", length)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place in it."""
    importable(spark)
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# The stages hold trained models and a tokenizer, which SQL cannot express; tests compare what run() keeps with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
