from pyspark.sql import functions as F

from clickmill.operators import subtypes, summaries, vin
from clickmill.operators.sessionlog import EVENT_SUBTYPES
from helpers import events, rows


def test_vin_counts_are_sessions(spark):
    df = events(
        spark,
        ("u1", "CLICK", "FEATURES", "1", "V1"),
        ("u1", "CLICK", "FEATURES", "2", "V1"),
        ("u2", "CLICK", "FEATURES", "1", "V1"),
        ("u2", "CLICK", "BADGES", "1", "V1"),
        ("u1", "EDIT", "CONTACT_FORM", "3", "V2"),
        ("u1", "EDIT", "CONTACT_FORM", "4", "V2"),
        ("u1", "SHOW", None, "5", "null"),
        ("u1", None, "BADGES", "6", None),
    )
    found = {r["vin"]: tuple(r)[1:] for r in vin.vin_user_metrics(df).collect()}
    assert found == {"V1": (2, 0, {"BADGES": 1, "FEATURES": 2}), "V2": (1, 1, {}), "null": (1, 0, {})}


def test_vin_join_keeps_vehicles_with_users_only(spark):
    metrics = vin.vin_user_metrics(events(spark, ("u", "SHOW", "BADGES", "1", "V1"), ("u", "CLICK", "BADGES", "1", "V2")))
    shown = spark.createDataFrame(
        [("V2", "SRP", 3), ("V2", "SRP", 4), ("V2", "VDP", 1), ("V2", "X", 9), ("V9", "SRP", 1)],
        "vin STRING, impression_type STRING, cnt BIGINT",
    )
    found = {r["vin"]: tuple(r)[1:] for r in vin.vin_join(metrics, vin.impressions(shown)).collect()}
    assert found == {"V1": (1, 0, {}, 0, 0), "V2": (1, 0, {"BADGES": 1}, 7, 1)}


def statistics(df, **flags):
    found = subtypes.subtype_statistics(df, **flags)
    return {(r["session_type"], r["event_subtype"]): tuple(r)[2:] for r in found.collect()}


def test_subtype_statistics_count_sessions_without_the_subtype(spark):
    badges = [("u2", "VISIT", "BADGES", str(i), "V") for i in range(3)]
    found = statistics(events(spark, ("u1", "VISIT", "FEATURES", "1", "V"), *badges))
    assert len(found) == 13 and {n for n, *_ in found.values()} == {2}
    assert found["visitor", "BADGES"] == (2, 3, 9, 1.5, 2.25)
    assert found["visitor", "PHOTO_MODAL"] == (2, 0, 0, 0.0, 0.0)
    assert found["visitor", "any"] == (2, 4, 10, 2.0, 1.0)


def test_any_squares_the_whole_session_and_skips_missing_subtypes(spark):
    kinds = ["FEATURES", "FEATURES", "BADGES", None]
    found = statistics(events(spark, *[("u", "VISIT", s, str(i), "V") for i, s in enumerate(kinds)]))
    assert found["visitor", "any"][:3] == (1, 3, 9)


def test_other_has_no_statistics_and_all_types_add_up(spark):
    df = events(spark, ("u", "EDIT", "BADGES", "1", "V"), ("v", "VISIT", "BADGES", "1", "V"), ("v", "CLICK", "BADGES", "1", "V"))
    found = statistics(df, require_contact_form=True, all_types=True)
    assert {t for t, _ in found} == {"clicker", "visitor", "any"}
    for subtype in (*EVENT_SUBTYPES, "any"):
        assert found["any", subtype][1] == found["clicker", subtype][1] + found["visitor", subtype][1]
        assert found["any", subtype][0] == 2
    assert statistics(df.filter("user_id = 'none'"), all_types=True) == {}


def test_totals_of_the_subtypes_are_the_total_of_any(spark):
    df = events(spark, *[(f"u{i % 9}", ["CLICK", "SHOW", "VISIT"][i % 3], EVENT_SUBTYPES[i * 7 % 12], str(i), "V") for i in range(300)])
    found = statistics(df)
    for kind in {t for t, _ in found}:
        assert sum(found[kind, s][1] for s in EVENT_SUBTYPES) == found[kind, "any"][1]


def table(spark, *items):
    return spark.createDataFrame(list(items), "make STRING, model STRING, price STRING, year STRING, mileage STRING")


def test_price_statistics_weigh_each_distinct_price_once(spark):
    df = table(spark, *[("b", "m", p, "1", "1") for p in ("1", "1", "4", "0", "abc", None)], ("a", "z", "2", "1", "1"))
    assert rows(summaries.price_statistics(df)) == [("a", "z", 2.0, 2.0, 2.0), ("b", "m", 1.0, 4.0, 2.5)]


def test_mileage_statistics(spark):
    df = table(spark, *[("b", "m", "1", y, m) for y, m in (("2", "5"), ("1", "3"), ("1", "3"), ("1", "6"), ("1", "0"), ("1", "x"))])
    assert rows(summaries.mileage_statistics(df)) == [("1", 3, 6, 4.5), ("2", 5, 5, 5.0)]


def test_event_statistics_count_all_rows_by_first_word(spark):
    df = spark.createDataFrame([("v", "show badges"), ("v", "show badges"), ("v", "click"), ("a", "show x")], "vin STRING, event STRING")
    assert rows(summaries.event_statistics(df)) == [("a", "show", 1), ("v", "click", 1), ("v", "show", 2)]


def test_field_value_counts(spark):
    df = spark.createDataFrame(
        [("show badges", "null", "a:b"), ("show badges", "x", "a:null:"), ("c d", None, ":")],
        "event_type STRING, city STRING, features STRING",
    )
    found = dict(rows(summaries.field_value_counts(df, ["event_type", "city"], ["features"])))
    assert found == {
        "event_type:show badges": 2, "event_type:c d": 1, "city:null": 1, "city:x": 1,
        "features:a": 2, "features:b": 1, "features:null": 1,
    }


def test_variance_is_exact_for_any_partitioning(spark):
    df = events(spark, *[(f"u{i % 50}", "CLICK", EVENT_SUBTYPES[i % 12], str(i), "V") for i in range(1000)])
    first = statistics(df.repartition(1))
    assert statistics(df.repartition(13).orderBy(F.rand())) == first
