"""Readers. All take paths and return DataFrames; nothing is read before an action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

IMPRESSION_SCHEMA = "vin STRING, impression_type STRING, cnt BIGINT"
SESSION_SCHEMA = """
    user_id STRING,
    events ARRAY<STRUCT<
        event_type: STRING, event_subtype: STRING, event_time: STRING, city: STRING, vin: STRING,
        condition: STRING, year: INT, make: STRING, model: STRING, trim: STRING, body_style: STRING,
        cab_style: STRING, price: FLOAT, mileage: INT, free_carfax_report: BOOLEAN, features: ARRAY<STRING>>>
"""


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files and scan splits than the cluster has cores, dealt out to all of them; others as they are.

    A file of one row group is read by one task, and what follows up to the first exchange stays in that task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    # Files are listed only where they are few: a split may hold several small ones.
    few = df.rdd.getNumPartitions() < cores and len(df.inputFiles()) < cores
    return df.repartition(cores) if few else df


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """value: text lines of one path, a comma-separated list of paths, or a sequence of paths."""
    listed = paths.split(",") if isinstance(paths, str) else list(paths)
    return spark.read.text([path.strip() for path in listed])


def read_lines_union(spark: SparkSession, *inputs: str | Sequence[str]) -> DataFrame:
    """Several text inputs as one; a file named in two inputs is read twice."""
    lines = read_lines(spark, inputs[0])
    for paths in inputs[1:]:
        lines = lines.unionByName(read_lines(spark, paths))
    return lines


def read_impressions(spark: SparkSession, *paths: str) -> DataFrame:
    """vin, impression_type, cnt from header-less CSV files."""
    return spark.read.schema(IMPRESSION_SCHEMA).csv(list(paths))


def read_table(spark: SparkSession, path: str, schema: str | None = None, view: str | None = None) -> DataFrame:
    """CSV with a header line, registered as a temp view if named.

    Without a schema the types are inferred, which reads the files once more; pass one for large inputs.
    """
    reader = spark.read.option("header", True)
    table = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    if view:
        table.createOrReplaceTempView(view)
    return table


def read_sessions(spark: SparkSession, *paths: str, format: str = "parquet") -> DataFrame:
    """user_id, events. ``format="avro"`` needs the spark-avro package on the class path.

    An Avro container of (key, value) pairs is unwrapped to the session record.
    """
    sessions = spark.read.format(format).load(list(paths))
    if set(sessions.columns) == {"key", "value"}:
        sessions = sessions.select("value.*")
    return sessions


def read_statistics(spark: SparkSession, *paths: str) -> DataFrame:
    """Statistics written per session type, as one frame."""
    return spark.read.parquet(*paths)

