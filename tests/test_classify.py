import hashlib

import pytest
from pyspark.sql import functions as F

from clickmill.functions.sampling import keyed_sample
from clickmill.operators import classify, metrics, sessions
from helpers import events, rows


def labels(spark, *items, **flags):
    found = classify.session_labels(events(spark, *items), **flags)
    return sorted(r["session_type"] for r in found.collect())


def event(kind, subtype="FEATURES", time="t", user="u", vin="V"):
    return (user, kind, subtype, time, vin)


@pytest.mark.parametrize("contact_form, expected", [(True, "other"), (False, "submitter")])
def test_edit_without_contact_form(spark, contact_form, expected):
    assert labels(spark, event("EDIT"), require_contact_form=contact_form) == [expected]
    assert labels(spark, event("EDIT", "CONTACT_FORM"), require_contact_form=contact_form) == ["submitter"]


def test_unknown_type_is_other(spark):
    assert labels(spark, event(None), require_contact_form=False) == ["other"]


def test_a_session_gets_every_label(spark):
    assert labels(spark, event("CLICK"), event("VISIT"), event("SHOW"), event("DISPLAY")) == [
        "clicker", "shower", "visitor"
    ]


def test_large_sessions_have_no_label(spark):
    assert labels(spark, *[event("CLICK", time=str(i)) for i in range(101)]) == []
    assert labels(spark, *[event("CLICK", time=str(i)) for i in range(100)]) == ["clicker"]


def test_nested_and_flat_labels_agree(spark):
    items = [event(k, s, user=f"u{i % 5}", time=str(i)) for i, (k, s) in enumerate(
        (k, s) for k in ("CHANGE", "CLICK", "SHOW", "VISIT", None) for s in ("CONTACT_FORM", "BADGES", None))]
    df = events(spark, *items)
    for contact_form in (True, False):
        flat = classify.session_labels(df, require_contact_form=contact_form).select("user_id", "session_type")
        nested = classify.classify_multi(classify.drop_large(sessions.small_sessions(df)), contact_form)
        assert set(rows(flat)) == set(rows(nested.select("user_id", "session_type")))


SHOW, CLICK, FORM = event("show"), event("Click", time="u"), event("SHOW", "Contact Form", time="v")


@pytest.mark.parametrize(
    "items, expected",
    [((SHOW, CLICK), False), ((SHOW,), True), ((SHOW, FORM), False), ((event("Display"),), True), ((event("visit"),), False)],
)
def test_shower_flat_and_nested(spark, items, expected):
    df = events(spark, *items)
    (flat,) = classify.shower_sessions(df, ["user_id"]).collect()
    assert (flat["session_type"] == "shower") is expected and flat["n_events"] == len(items)
    nested = sessions.small_sessions(df).select(classify.is_shower(F.col("events")))
    assert nested.first()[0] is expected


def draw(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


def test_sample_is_a_function_of_the_key(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("user_id"), F.lit("clicker").alias("session_type"))
    keys = ["session_type", "user_id"]
    found = {r["user_id"] for r in keyed_sample(df.repartition(9), "session_type", keys, {"clicker": 0.1}).collect()}
    assert found == {str(i) for i in range(2000) if draw(f"42:clicker:{i}") < 0.1}
    assert 140 < len(found) < 260
    again = keyed_sample(df.orderBy(F.rand()), "session_type", keys, {"clicker": 0.1}, seed=42)
    assert {r["user_id"] for r in again.collect()} == found
    assert keyed_sample(df, "session_type", keys, {"shower": 0.0}).count() == 2000


def test_filter_metrics_add_up(spark):
    items = [event("CLICK", user=f"u{i}") for i in range(300)] + [event("VISIT", user=f"u{i}") for i in range(10)]
    items += [event("SHOW", user="big", time=str(i)) for i in range(101)]
    found = dict(rows(metrics.filter_metrics(events(spark, *items))))
    assert found["clicker_written"] + found["clicker_discarded"] == 300
    assert found["visitor_written"] == 10 and found["large_discarded"] == 1 and "shower_written" not in found


def test_session_metrics(spark):
    sessions_df = spark.createDataFrame(
        [(f"s{i}", 2, "shower") for i in range(100)] + [("o", 5, "other")],
        "user_id STRING, n_events BIGINT, session_type STRING",
    )
    found = dict(rows(metrics.session_metrics(sessions_df, ["user_id"])))
    left = sum(draw(f"42:s{i}") <= 0.1 for i in range(100))
    assert found == dict(
        events_before=205, events_after=5 + 2 * left, sessions=1 + left, shower_sessions=100,
        shower_sessions_dropped=100 - left,
    )
    empty = dict(rows(metrics.session_metrics(sessions_df.filter("false"), ["user_id"])))
    assert set(empty.values()) == {0}
