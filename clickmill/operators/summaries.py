"""Price, mileage and event summaries of a session table, and counts of its field values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.sessionlog import feature_parts

# The fields whose values are counted; the last one is a ``:``-separated list.
COUNTED_FIELDS = (
    "event_type", "city", "vehicle_condition", "year", "make", "model", "trim", "body_style",
    "cab_style", "free_carfax_report",
)
COUNTED_LISTS = ("features",)


PRICE_TYPE = "decimal(18,4)"


def price_statistics(df: DataFrame) -> DataFrame:
    """make, model, min, max, avg over the distinct non-zero prices of each make and model, sorted.

    Prices are numbers to four decimal places, so 10 and 10.0 are one price, sums are exact, and an average is one division.
    A price that is not a number counts as missing.
    """
    price = F.col("price").try_cast(PRICE_TYPE).alias("price")
    prices = df.select("make", "model", price).filter("price <> 0").distinct()
    exact = F.sum("price").cast("double") / F.count("price")
    return (
        prices.groupBy("make", "model")
        .agg(F.min("price").cast("double").alias("min"), F.max("price").cast("double").alias("max"), exact.alias("avg"))
        .orderBy("make", "model")
    )


def mileage_statistics(df: DataFrame) -> DataFrame:
    """year, min, max, avg over the distinct non-zero mileages (whole numbers) of each year, sorted."""
    mileage = F.col("mileage").try_cast("int").alias("mileage")
    miles = df.select("year", mileage).filter("mileage <> 0").distinct()
    return (
        miles.groupBy("year")
        .agg(F.min("mileage").alias("min"), F.max("mileage").alias("max"), F.avg("mileage").alias("avg"))
        .orderBy("year")
    )


def event_statistics(df: DataFrame) -> DataFrame:
    """vin, action, occurrences: rows per vehicle and first word of the event, sorted."""
    action = F.substring_index("event", " ", 1).alias("action")
    counted = df.select("vin", action).groupBy("vin", "action").agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.orderBy("vin", "action")


def field_value_counts(
    df: DataFrame, fields: Sequence[str] = COUNTED_FIELDS, lists: Sequence[str] = COUNTED_LISTS
) -> DataFrame:
    """field_value (``field:value``), count over the given text columns; list columns count part by part."""

    def pair(field: str, value: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), value.alias("value"))

    no_parts = F.array().cast("array<string>")
    pairs = [F.array(*[pair(c, F.col(c)) for c in fields])] if fields else []
    pairs += [F.transform(F.coalesce(feature_parts(F.col(c)), no_parts), partial(pair, c)) for c in lists]
    values = df.select(F.inline(F.concat(*pairs))).filter(F.col("value").isNotNull())
    counted = values.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.concat_ws(":", "field", "value").alias("field_value"), "count")
