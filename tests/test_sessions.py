import random
from collections import defaultdict

from pyspark.sql import functions as F

from clickmill.operators import sessions
from clickmill.plans.queries import USER_CITY, USER_CITY_ORDER
from helpers import events, rows

R1 = ("u1", "SHOW", "BADGES", "2017-01-01", "V1")
R2 = ("u1", "CLICK", "BADGES", "2017-01-02", "V1")
R3 = ("u1", "SHOW", "BADGES", "2017-01-02", "V2")


def test_events_are_distinct_and_in_time_and_type_order(spark):
    found = sessions.sessionize(sessions.event_runs(events(spark, R3, R2, R1, R1))).orderBy("start")
    assert rows(found.select("event_time", "event_type", "start")) == [
        ("2017-01-01", "SHOW", 0),
        ("2017-01-02", "CLICK", 1),
        ("2017-01-02", "SHOW", 2),
    ]


def test_copies_stay_without_dedupe(spark):
    runs = sessions.event_runs(events(spark, R1, R1, R2), dedupe=False)
    (kept,) = sessions.session_lists(runs, dedupe=False).collect()
    (distinct,) = sessions.session_lists(sessions.event_runs(events(spark, R1, R1, R2))).collect()
    assert (len(kept["events"]), len(distinct["events"])) == (3, 2)
    assert rows(sessions.sessionize(runs, dedupe=False).orderBy("start").select("start", "copies")) == [(0, 2), (2, 1)]


def test_events_without_a_user_belong_to_no_session(spark):
    assert sessions.event_runs(events(spark, (None, *R1[1:]), R1)).count() == 1


def test_small_sessions_keep_100_and_drop_101(spark):
    def session(user, n):
        return [(user, "SHOW", "BADGES", f"t{i:04d}", "V1") for i in range(n)]

    found = sessions.small_sessions(events(spark, *session("a", 100), *session("b", 101), *session("c", 5000), R1, R1))
    assert {r["user_id"]: len(r["events"]) for r in found.collect()} == {"a": 100, "u1": 1}
    listed = found.filter(F.col("user_id") == "a").first()["events"]
    assert [e["event_time"] for e in listed] == [f"t{i:04d}" for i in range(100)]


def test_small_sessions_with_a_large_limit(spark):
    data = [("a", "SHOW", "BADGES", f"t{i:04d}", "V1") for i in range(1500)]
    data += [("b", "SHOW", "BADGES", f"t{i:04d}", "V1") for i in range(1501)]
    found = sessions.small_sessions(events(spark, *data), max_events=1500).collect()
    assert [(r["user_id"], len(r["events"])) for r in found] == [("a", 1500)]


def test_explode_returns_the_events(spark):
    nested = sessions.small_sessions(events(spark, R1, R2, R3))
    assert set(rows(sessions.explode_sessions(nested).select("user_id", "event_type", "event_time", "vin"))) == {
        (r[0], r[1], r[3], r[4]) for r in (R1, R2, R3)
    }


def test_session_text(spark):
    nested = sessions.small_sessions(events(spark, R1, ("u1", "SHOW", None, "2017-01-03", "V1")))
    text = nested.select(sessions.session_text(F.col("events"))).first()[0]
    assert text == "[<SHOW:BADGES,2017-01-01,V1>, <SHOW:null,2017-01-03,V1>]"


def city_events(spark, n=2000):
    rng = random.Random(5)
    schema = "user_id STRING, city STRING, event_type STRING, event_subtype STRING, event_time STRING, vin STRING"
    data = []
    for _ in range(n):
        user = "u0" if rng.random() < 0.4 else f"u{rng.randrange(1, 30)}"
        kind = rng.choice(["show", "visit"])
        data.append((user, f"c{rng.randrange(2) if user != 'u0' else 0}", kind, "x", f"t{rng.randrange(200):03d}", "v"))
    return data, spark.createDataFrame(data, schema)


def test_user_city_lists_match_brute_force_with_a_large_session(spark):
    data, df = city_events(spark)
    expected = defaultdict(list)
    for user, city, kind, subtype, time, vin in data:
        if user != "u3":
            expected[user, city].append((time, kind, subtype, vin))
    runs = sessions.event_runs(df, USER_CITY, USER_CITY_ORDER, dedupe=False)
    facts, kept = {"last": F.max("event_time")}, (F.col("user_id") != "u3") & F.col("last").isNotNull()
    for split_rows, page_size in ((20, 50), (10**6, 10**4)):
        pages = sessions.session_lists(runs, USER_CITY, False, page_size, split_rows, facts, kept)
        found = defaultdict(list)
        for r in pages.orderBy("user_id", "city", "page").collect():
            assert len(r["events"]) <= page_size
            found[r["user_id"], r["city"]] += [
                (e["event_time"], e["event_type"], e["event_subtype"], e["vin"]) for e in r["events"]
            ]
        assert found == {k: sorted(v) for k, v in expected.items()}


def test_sum_of_session_lengths_is_the_number_of_distinct_events(spark):
    _, df = city_events(spark)
    runs = sessions.event_runs(df, USER_CITY, USER_CITY_ORDER)
    total = sessions.session_lists(runs, USER_CITY).agg(F.sum(F.size("events"))).first()[0]
    assert total == df.distinct().count()


def test_distinct_events_are_told_apart_by_their_other_fields(spark):
    schema = "user_id STRING, event_type STRING, vin STRING, city STRING, price DOUBLE, features ARRAY<STRING>"
    data = [
        ("u", "SHOW", vin, city, price, features)
        for vin, city in [(None, "-"), ("-", None), ("", "1:a"), ("1:a", ""), ("ab", "c"), ("a", "bc"), (None, None)]
        for price in (0.0, -0.0, float("nan"), None, 950.0)
        for features in (None, [], [None], ["null"], ["a", "b"], ["a,b"], ['a","b'])
    ]
    df = spark.createDataFrame(data + data[::2], schema)
    found = sessions.distinct_events(df, ["user_id", "event_type"])
    assert found.columns == ["user_id", "event_type"]
    assert found.count() == df.distinct().count() == 7 * 4 * 7
