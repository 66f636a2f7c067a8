"""Sessions: the events of one user, or of one user in one city, in time order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from clickmill.operators.ordered import (
    PAGE_SIZE,
    SPLIT_ROWS,
    large_keys,
    list_pages,
    place,
    placed_parts,
    run_pages,
    with_keys,
)

BY_TIME = ("event_time", "event_type")
MAX_EVENTS = 100


def _ordered_fields(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """Event fields, the sort fields first; the others break ties."""
    return [*order, *[c for c in events.columns if c not in keys and c not in order]]


def event_runs(
    events: DataFrame, keys: Sequence[str] = ("user_id",), order: Sequence[str] = BY_TIME, dedupe: bool = True
) -> DataFrame:
    """keys, event fields (sort fields first), copies: one row per distinct event of a session.

    Events without a key belong to no session and are left out. Equal events count once with ``dedupe``; without it an event that occurs n times has copies = n.
    """
    rows = with_keys(events, keys).select(*keys, *_ordered_fields(events, keys, order))
    if dedupe:
        return rows.distinct().withColumn("copies", F.lit(1).cast("bigint"))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def _exact_text(name: str, kind: DataType) -> Column:
    """A text that two values of a column share only if they are equal: its length goes before it, and null has none."""
    value = F.col(name)
    if isinstance(kind, (FloatType, DoubleType)):
        # Minus zero equals zero.
        value = value + F.lit(0.0).cast(kind)
    text = F.to_json(value) if isinstance(kind, (ArrayType, MapType, StructType)) else value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def distinct_events(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of the distinct events, one row per event: for readers that do not use its other fields.

    The other fields travel as 16 bytes of their SHA-256, about a third of a whole event, through the shuffle and the
    tables of the aggregate. Two different events of n would count as one with a chance of n^2 / 2^129.
    """
    others = [field for field in events.schema if field.name not in columns]
    digest = F.unhex(F.substring(F.sha2(F.concat(*[_exact_text(f.name, f.dataType) for f in others]), 256), 1, 32))
    # Generated, so that its code is a step of its own: in one with a parser's it would be too long for the JVM to compile.
    return events.select(*columns, F.explode(F.array(digest)).alias("digest")).distinct().drop("digest")


def sessionize(
    runs: DataFrame, keys: Sequence[str] = ("user_id",), dedupe: bool = True, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """The event runs with ``start``, their 0-based position in the session.

    A run of n equal events takes the positions start .. start + n - 1. Give ``dedupe`` as for ``event_runs``.
    """
    order = [c for c in runs.columns if c not in keys and c != "copies"]
    return place(runs, keys, order, None if dedupe else "copies", split_rows)


def session_lists(
    runs: DataFrame,
    keys: Sequence[str] = ("user_id",),
    dedupe: bool = True,
    page_size: int = PAGE_SIZE,
    split_rows: int = SPLIT_ROWS,
    facts: Mapping[str, Column] | None = None,
    kept: Column | None = None,
) -> DataFrame:
    """keys, page, events: each session as sorted arrays of at most ``page_size`` events.

    ``facts`` are named aggregates over the events of a session. With ``dedupe`` they are returned beside the keys.
    Without it ``kept``, a condition on the keys and facts, says which sessions stay: the facts come from where the events
    are sorted, so dropping sessions takes no shuffle or join.
    """
    fields = [c for c in runs.columns if c not in keys and c != "copies"]
    event = F.struct(*fields)
    if dedupe:
        return list_pages(runs.drop("copies"), keys, fields, event, "events", page_size, split_rows, facts)
    parts = placed_parts(runs, keys, fields, "copies", split_rows, facts)
    stay = kept if kept is not None else F.lit(True)
    other, large = (run_pages(part.filter(stay), keys, event, "events", "copies", page_size) for part in parts)
    return other.unionByName(large)


def small_sessions(
    events: DataFrame,
    keys: Sequence[str] = ("user_id",),
    order: Sequence[str] = BY_TIME,
    max_events: int = MAX_EVENTS,
) -> DataFrame:
    """keys, events: the sessions of at most ``max_events`` distinct events, whole, in one sorted array.

    Larger sessions are recognised by their event number max_events + 1 and dropped. Spark applies the row number
    limit also before the shuffle, so a huge session costs each map task at most that many rows; as it does so only up
    to a limit of its own, huge sessions are dropped by their size first where max_events is beyond that.
    """
    fields = _ordered_fields(events, keys, order)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*fields))
    distinct = with_keys(events, keys).select(*keys, *fields).distinct()
    if max_events >= int(events.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        huge = large_keys(distinct, keys, max(max_events, SPLIT_ROWS))
        distinct = distinct.join(F.broadcast(huge), list(keys), "left_anti")
    head = distinct.withColumn("number", number).filter(F.col("number") <= max_events + 1)
    original = [c for c in events.columns if c not in keys]
    listed = F.sort_array(F.collect_list(F.struct("number", F.struct(*original).alias("event"))))
    sessions = head.groupBy(*keys).agg(F.transform(listed, lambda e: e["event"]).alias("events"))
    return sessions.filter(F.size("events") <= max_events)


def explode_sessions(sessions: DataFrame) -> DataFrame:
    """Flat events of nested sessions."""
    keys = [c for c in sessions.columns if c != "events"]
    return sessions.select(*keys, F.inline("events"))


def session_text(events: Column) -> Column:
    """``[<type:subtype,time,vin>, ...]``; a missing part shows as ``null``."""

    def part(event: Column, name: str) -> Column:
        return F.coalesce(event[name], F.lit("null"))

    shown = F.transform(
        events,
        lambda e: F.format_string(
            "<%s:%s,%s,%s>",
            part(e, "event_type"), part(e, "event_subtype"), part(e, "event_time"), part(e, "vin"),
        ),
    )
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
