"""Session labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.sessions import MAX_EVENTS

# The session types, in order, and the labels that are sampled with their rates.
SESSION_TYPES = ("submitter", "clicker", "shower", "visitor", "other")
SAMPLE_RATES = {"clicker": 0.1, "shower": 0.02}
SHOWER_RATE = 0.1


def event_label(event_type: Column, event_subtype: Column, require_contact_form: bool) -> Column:
    """The label one event gives its session; the first rule that matches counts."""
    submits = event_type.isin("CHANGE", "EDIT", "SUBMIT")
    if require_contact_form:
        submits = submits & (event_subtype == "CONTACT_FORM")
    return (
        F.when(submits, "submitter")
        .when(event_type == "CLICK", "clicker")
        .when(event_type.isin("SHOW", "DISPLAY"), "shower")
        .when(event_type == "VISIT", "visitor")
        .otherwise("other")
    )


def drop_large(sessions: DataFrame, max_events: int = MAX_EVENTS) -> DataFrame:
    """Nested sessions with at most ``max_events`` events."""
    return sessions.filter(F.size("events") <= max_events)


def classify_multi(sessions: DataFrame, require_contact_form: bool) -> DataFrame:
    """Nested sessions once per label they have, with ``session_type``."""
    labels = F.array_distinct(
        F.transform("events", lambda e: event_label(e["event_type"], e["event_subtype"], require_contact_form))
    )
    return sessions.select("*", F.explode(labels).alias("session_type"))


def session_profile(events: DataFrame, keys: Sequence[str], require_contact_form: bool) -> DataFrame:
    """keys, n_events, labels: from flat distinct events, in one aggregate without collecting them."""
    label = event_label(F.col("event_type"), F.col("event_subtype"), require_contact_form)
    has = [F.when(F.bool_or(label == name), name) for name in SESSION_TYPES]
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"), F.array_compact(F.array(*has)).alias("labels")
    )


def session_labels(
    events: DataFrame,
    keys: Sequence[str] = ("user_id",),
    require_contact_form: bool = False,
    max_events: int = MAX_EVENTS,
) -> DataFrame:
    """keys, n_events, session_type: one row per session and label, large sessions dropped."""
    profile = session_profile(events, keys, require_contact_form).filter(F.col("n_events") <= max_events)
    return profile.select(*keys, "n_events", F.explode("labels").alias("session_type"))


def _shows(event_type: Column) -> Column:
    return F.lower(event_type).isin("show", "display")


def _engages(event_type: Column, event_subtype: Column) -> Column:
    return (F.lower(event_type) == "click") | (F.lower(event_subtype) == "contact form")


def is_shower(events: Column) -> Column:
    """Nested form: some event shows, and none is a click or about the contact form."""
    return F.exists(events, lambda e: _shows(e["event_type"])) & ~F.exists(
        events, lambda e: _engages(e["event_type"], e["event_subtype"])
    )


def shower_facts() -> dict[str, Column]:
    """Aggregates over the raw events of a session that ``shower_label`` reads."""
    event_type, event_subtype = F.col("event_type"), F.col("event_subtype")
    return {"shows": F.max(_shows(event_type)), "engages": F.max(_engages(event_type, event_subtype))}


def shower_label() -> Column:
    """shower or other, from the facts of a session."""
    return F.when(F.col("shows") & ~F.coalesce("engages", F.lit(False)), "shower").otherwise("other")


def shower_sessions(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n_events, session_type (shower or other) from flat raw events or from their runs."""
    copies = F.col("copies") if "copies" in events.columns else F.lit(1).cast("bigint")
    facts = [fact.alias(name) for name, fact in shower_facts().items()]
    profile = events.groupBy(*keys).agg(F.sum(copies).alias("n_events"), *facts)
    return profile.select(*keys, "n_events", shower_label().alias("session_type"))
