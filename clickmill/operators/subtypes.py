"""Statistics of events per session, by session type and event subtype."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.functions.stats import mean, variance
from clickmill.operators.classify import SESSION_TYPES, event_label
from clickmill.operators.sessionlog import EVENT_SUBTYPES
from clickmill.operators.sessions import MAX_EVENTS

# Fixed value: the row over all subtypes (and, if asked for, over all session types).
ANY = "any"


def subtype_statistics(
    events: DataFrame,
    keys: Sequence[str] = ("user_id",),
    require_contact_form: bool = False,
    max_events: int = MAX_EVENTS,
    all_types: bool = False,
) -> DataFrame:
    """session_type, event_subtype, session_count, total_count, sum_of_squares, mean, variance.

    Input: flat distinct events. Each session counts in every type it is labelled with, except ``other``; all
    subtypes give a row, zeros included, and ``any`` counts all events with a subtype. ``all_types`` adds the sums
    over the types. Labels and the twelve counts come from one aggregate per session; the second aggregate has one
    row per type.
    """
    label = event_label(F.col("event_type"), F.col("event_subtype"), require_contact_form)
    reported = [name for name in SESSION_TYPES if name != "other"]
    sessions = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.array_compact(F.array(*[F.when(F.bool_or(label == name), name) for name in reported])).alias("labels"),
        F.count("event_subtype").alias(ANY),
        *[F.count_if(F.col("event_subtype") == s).alias(s) for s in EVENT_SUBTYPES],
    )
    counts = [*EVENT_SUBTYPES, ANY]
    labelled = sessions.filter(F.col("n_events") <= max_events).select(
        F.explode("labels").alias("session_type"), *counts
    )
    grouped = labelled.rollup("session_type") if all_types else labelled.groupBy("session_type")
    sums = grouped.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[F.sum(c).alias(f"{c}_total") for c in counts],
        *[F.sum(F.col(c) * F.col(c)).alias(f"{c}_squares") for c in counts],
    ).filter(F.col("session_count") > 0)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("event_subtype"),
                F.col(f"{c}_total").alias("total_count"),
                F.col(f"{c}_squares").alias("sum_of_squares"),
            )
            for c in counts
        ]
    )
    session_type = F.coalesce("session_type", F.lit(ANY)).alias("session_type")
    flat = sums.select(session_type, "session_count", F.inline(rows))
    n, total, squares = F.col("session_count"), F.col("total_count"), F.col("sum_of_squares")
    return flat.select(
        "session_type",
        "event_subtype",
        "session_count",
        "total_count",
        "sum_of_squares",
        mean(total, n).alias("mean"),
        variance(total, squares, n).alias("variance"),
    )
