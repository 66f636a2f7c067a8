"""Job counters as aggregate frames: exact under retries and re-evaluation, unlike side effects of a task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.functions.sampling import sampled
from clickmill.operators.classify import SAMPLE_RATES, SHOWER_RATE, session_profile
from clickmill.operators.sessions import MAX_EVENTS


def filter_metrics(
    events: DataFrame,
    keys: Sequence[str] = ("user_id",),
    require_contact_form: bool = True,
    max_events: int = MAX_EVENTS,
    rates: Mapping[str, float] = SAMPLE_RATES,
    seed: int = 42,
) -> DataFrame:
    """metric, value: large sessions discarded, and sessions written and discarded per label."""
    profile = session_profile(events, keys, require_contact_form)
    outcomes = F.when(F.col("n_events") > max_events, F.array(F.lit("large"))).otherwise(F.col("labels"))
    labelled = profile.select(*keys, F.explode(outcomes).alias("session_type"))
    kept = sampled(F.col("session_type"), ["session_type", *keys], rates, seed, inclusive=False)
    kept = kept & (F.col("session_type") != "large")
    metric = F.concat(F.col("session_type"), F.when(kept, "_written").otherwise("_discarded"))
    return labelled.groupBy(metric.alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def session_metrics(
    sessions: DataFrame, keys: Sequence[str], rate: float = SHOWER_RATE, seed: int = 42
) -> DataFrame:
    """metric, value from (keys, n_events, session_type): events and sessions before and after shower sampling."""
    shower = F.col("session_type") == "shower"
    kept = sampled(F.col("session_type"), keys, {"shower": rate}, seed, inclusive=True)
    totals = sessions.agg(
        F.sum("n_events").alias("events_before"),
        F.sum(F.when(kept, F.col("n_events")).otherwise(F.lit(0))).alias("events_after"),
        F.count_if(kept).alias("sessions"),
        F.count_if(shower).alias("shower_sessions"),
        F.count_if(shower & ~kept).alias("shower_sessions_dropped"),
    )
    return totals.unpivot([], totals.columns, "metric", "value").withColumn("value", F.coalesce("value", F.lit(0)))
