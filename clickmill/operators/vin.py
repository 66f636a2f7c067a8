"""Per-vehicle user metrics and their left join with marketplace impressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.sessionlog import EVENT_SUBTYPES


def _click_flag(subtype: str) -> str:
    return f"click_{subtype.lower()}"


def vin_user_metrics(events: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """vin, unique_users, edit_contact_form, clicks.

    All counts are sessions: that hold the vehicle, that edit its contact form, that click it per subtype. Rows
    without a vin are dropped. Two hash aggregates; only flags per (session, vin) and sums per vin are shuffled.
    """
    event_type, subtype = F.col("event_type"), F.col("event_subtype")
    clicked = [
        F.coalesce(F.bool_or((event_type == "CLICK") & (subtype == s)), F.lit(False)).alias(_click_flag(s))
        for s in EVENT_SUBTYPES
    ]
    edited = F.coalesce(F.bool_or((event_type == "EDIT") & (subtype == "CONTACT_FORM")), F.lit(False))
    visits = events.filter(F.col("vin").isNotNull()).groupBy(*keys, "vin").agg(edited.alias("edited"), *clicked)
    counted = visits.groupBy("vin").agg(
        F.count(F.lit(1)).alias("unique_users"),
        F.count_if("edited").alias("edit_contact_form"),
        *[F.count_if(_click_flag(s)).alias(_click_flag(s)) for s in EVENT_SUBTYPES],
    )
    entries = F.array(
        *[F.struct(F.lit(s).alias("key"), F.col(_click_flag(s)).alias("value")) for s in EVENT_SUBTYPES]
    )
    clicks = F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))
    return counted.select("vin", "unique_users", "edit_contact_form", clicks.alias("clicks"))


def impressions(df: DataFrame) -> DataFrame:
    """vin, marketplace_srps, marketplace_vdps from (vin, impression_type, cnt); other types add nothing."""

    def total(kind: str) -> Column:
        return F.sum(F.when(F.col("impression_type") == kind, F.col("cnt")).otherwise(F.lit(0)))

    return df.groupBy("vin").agg(total("SRP").alias("marketplace_srps"), total("VDP").alias("marketplace_vdps"))


def vin_join(metrics: DataFrame, totals: DataFrame) -> DataFrame:
    """Every vehicle with users, with 0 where there are no impressions. Both sides hold one row per vin."""
    joined = metrics.join(totals, "vin", "left")
    return joined.fillna(0, ["marketplace_srps", "marketplace_vdps"])
