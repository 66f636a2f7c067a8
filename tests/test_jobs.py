"""The jobs end to end on small files."""

import json
import os

import pytest

from clickmill import jobs
from helpers import log_line
from test_io import put


def text(folder, name):
    path = os.path.join(folder, name)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return [line for part in parts for line in open(os.path.join(path, part)).read().splitlines()]


@pytest.fixture
def files(spark, out_dir):
    return lambda name, *lines: put(out_dir, name, *lines), lambda name: os.path.join(out_dir, name)


def test_word_jobs(spark, out_dir, files):
    write, target = files
    source = write("in", "b a a", "B. a")
    jobs.word_count(spark, source, target("count"))
    assert sorted(text(out_dir, "count")) == ["B.\t1", "a\t3", "b\t1"]
    jobs.sorted_word_count(spark, source, target("sorted"))
    assert text(out_dir, "sorted") == ["(B.,1)", "(a,3)", "(b,1)"]
    jobs.word_statistics(spark, source, target("stats"))
    assert sorted(text(out_dir, "stats")) == ["a\t\t2,1.5,0.25", "b\t\t2,1.0,0.0"]
    jobs.word_statistics_minmax(spark, source, target("minmax"))
    records = dict(line.split("\t") for line in text(out_dir, "minmax"))
    assert set(records) == {"a", "b", "b."}
    assert json.loads(records["a"]) == dict(
        document_count=2, total_count=3, min=1, max=2, sum_of_squares=5, mean=1.5, variance=0.25
    )


def test_index_jobs(spark, out_dir, files):
    write, target = files
    first = write("m1", "Message-ID: <2> From: a@x To: b@y X-From: z@z")
    second = write("m2", "Message-ID: <1> From: a@x")
    jobs.email_index(spark, f"{first},{second}", target("mail"))
    assert sorted(text(out_dir, "mail")) == ["From:a@x\t<1>,<2>", "To:b@y\t<2>"]
    verses = write("verses", "g:1:10 in the", "g:1:2 the")
    jobs.verse_index(spark, verses, target("words"), target("counts"))
    assert text(out_dir, "words") == ["(g,[g:1:2, g:1:10])", "(in,[g:1:10])", "(the,[g:1:2, g:1:10])"]
    assert text(out_dir, "counts") == ["(g,[g:1:2, g:1:10])", "(the,[g:1:2, g:1:10])", "(in,[g:1:10])"]


def test_session_jobs_chain(spark, out_dir, files):
    write, target = files
    source = write(
        "log",
        log_line(event="visit features", vin="V1"),
        log_line(event="visit features", vin="V1"),
        log_line(event="edit contact form", vin="V2"),
        log_line(user_id="u2", event="visit badges", vin="V1"),
        log_line(price="call"),
    )
    jobs.user_sessions(spark, source, target("sessions"), target("rejects"))
    assert {r["user_id"]: len(r["events"]) for r in spark.read.parquet(target("sessions")).collect()} == {"u1": 2, "u2": 1}
    assert [r["reason"] for r in spark.read.parquet(target("rejects")).collect()] == ["price is not a number"]

    shown = [write("srp.csv", "V1,SRP,5"), write("vdp.csv", "V1,VDP,2", "V9,VDP,1")]
    jobs.vin_impressions(spark, target("sessions"), shown, target("vins"))
    found = {r["vin"]: tuple(r)[1:] for r in spark.read.parquet(target("vins")).collect()}
    assert found == {"V1": (2, 0, {}, 5, 2), "V2": (1, 1, {}, 0, 0)}

    jobs.session_bins(spark, target("sessions"), target("bins"), target("counters"))
    binned = {(r["session_type"], r["user_id"]) for r in spark.read.parquet(target("bins")).collect()}
    assert binned == {("visitor", "u1"), ("visitor", "u2"), ("submitter", "u1")}
    counters = {r["metric"]: r["value"] for r in spark.read.parquet(target("counters")).collect()}
    assert counters == {"visitor_written": 2, "submitter_written": 1}

    jobs.subtype_statistics(spark, target("sessions"), target("stats"), target("all_bins"))
    stats = spark.read.parquet(target("stats"))
    assert stats.count() == 2 * 13
    row = stats.filter("session_type = 'visitor' AND event_subtype = 'any'").first()
    assert (row["session_count"], row["total_count"], row["sum_of_squares"]) == (2, 3, 5)
    assert spark.read.parquet(target("all_bins")).count() == 3

    jobs.field_value_counts(spark, source, target("fields"))
    counted = dict(line.rsplit("\t", 1) for line in text(out_dir, "fields"))
    assert counted["event_type:visit features"] == "2" and counted["features:null"] == "5"
    assert not any(k.startswith(("price:", "vin:", "user_id:", "mileage:", "event_timestamp:")) for k in counted)


def test_user_city_job(spark, out_dir, files):
    write, target = files
    first = write("l1", "u1\tvisit x\tt2\tc\tV", "u1\tclick y\tt1\tc\tV")
    second = write("l2", "u1\tvisit x\tt2\tc\tV", "u0\tclick contact form\tt\tc\tV")
    jobs.user_city_sessions(spark, first, second, target("out"), target("counters"))
    assert text(out_dir, "out") == [
        "((u0,c),[<click:contact form,t,V>])",
        "((u1,c),[<click:y,t1,V>, <visit:x,t2,V>, <visit:x,t2,V>])",
    ]
    counters = {r["metric"]: r["value"] for r in spark.read.parquet(target("counters")).collect()}
    assert counters["events_before"] == counters["events_after"] == 4 and counters["sessions"] == 2


def test_table_job(spark, out_dir, files):
    write, target = files
    header = "make,model,price,year,mileage,vin,event"
    source = write("t.csv", header, "b,m,2,2010,5,V,show x", "b,m,4,2010,0,V,show y", "a,m,0,2009,1,V,click z")
    jobs.table_statistics(spark, source, target("out"))
    assert text(out_dir, "out/price") == ["b,m,2.0,4.0,3.0"]
    assert text(out_dir, "out/mileage") == ["2009,1,1,1.0", "2010,5,5,5.0"]
    assert text(out_dir, "out/event") == ["V,click,1", "V,show,2"]


def test_shared_frames_are_checkpointed_where_a_folder_is_named(spark):
    df = spark.range(3).selectExpr("id * 2 AS x")
    plan = jobs.shared(df)._jdf.queryExecution().optimizedPlan().toString()
    assert ("LogicalRDD" in plan) is bool(spark.conf.get("spark.checkpoint.dir", None))
    assert sorted(r["x"] for r in jobs.shared(df).collect()) == [0, 2, 4]


def test_a_kept_frame_is_made_once_and_released(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(5).mapInArrow(counted, "id bigint")
    with jobs.kept(df) as frame:
        assert frame.count() == 5 and sorted(r["id"] for r in frame.filter("id > 2").collect()) == [3, 4]
    assert made.value == 5
    assert not frame.is_cached


def test_verse_index_makes_its_lists_once(spark, out_dir, files, monkeypatch):
    write, target = files
    plans = []
    write_lines = jobs.sinks.write_lines
    monkeypatch.setattr(jobs.sinks, "write_lines", lambda df, path: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write_lines(df, path)))
    jobs.verse_index(spark, write("verses", "g:1:10 in the", "g:1:2 the"), target("words"), target("counts"))
    assert len(plans) == 2 and all("InMemoryRelation" in plan or "LogicalRDD" in plan for plan in plans)


def test_observed_counters_equal_the_aggregate(spark, out_dir, files):
    write, target = files
    kinds = ["click features", "show badges", "visit features", "submit contact form", "edit badges"]
    lines = [log_line(user_id=f"u{i % 97}", event=kinds[(i * i) % 5 if i % 97 < 60 else i % 2], vin=f"V{i}") for i in range(700)]
    lines += [log_line(user_id="many", event="click features", vin=f"V{i}") for i in range(130)]
    jobs.user_sessions(spark, write("log", *lines), target("sessions"), target("rejects"))
    assert spark.read.parquet(target("rejects")).count() == 0
    jobs.session_bins(spark, target("sessions"), target("bins"), target("counters"))
    found = {r["metric"]: r["value"] for r in spark.read.parquet(target("counters")).collect()}
    flat = jobs.sessions.explode_sessions(spark.read.parquet(target("sessions")).select("user_id", "events"))
    assert found == {r["metric"]: r["value"] for r in jobs.metrics.filter_metrics(flat).collect()}
    assert found["large_discarded"] == 1 and found["clicker_discarded"] > 0
    written = spark.read.parquet(target("bins")).groupBy("session_type").count().collect()
    assert {f"{r['session_type']}_written": r["count"] for r in written} == {k: v for k, v in found.items() if k.endswith("_written")}


def test_pages_without_their_size_are_refused(spark):
    pages = spark.createDataFrame([("u", 0, ["e"])], "user_id string, page int, events array<string>")
    with pytest.raises(ValueError, match="n_events"):
        jobs.small_stored_sessions(pages)


def test_bucketed_sessions_are_grouped_without_a_shuffle_by_user(spark, out_dir, files):
    write, target = files
    lines = [log_line(user_id=f"u{i % 23}", event="visit features" if i % 3 else "click badges", vin=f"V{i}") for i in range(300)]
    source = write("log", *lines)
    jobs.user_sessions(spark, source, target("plain"))
    jobs.subtype_statistics(spark, target("plain"), target("plain_stats"))
    jobs.user_sessions(spark, source, target("buckets"), table="stored_sessions", buckets=5)
    try:
        jobs.subtype_statistics(spark, None, target("bucket_stats"), table="stored_sessions")
        flat = jobs.sessions.explode_sessions(spark.table("stored_sessions").select("user_id", "events"))
        plan = jobs.subtypes.subtype_statistics(flat)._jdf.queryExecution().executedPlan().toString()
        exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert exchanged and not any("hashpartitioning(user_id" in line for line in exchanged)
    finally:
        spark.sql("DROP TABLE stored_sessions")
    found, wanted = (spark.read.parquet(target(f"{name}_stats")).collect() for name in ("bucket", "plain"))
    assert sorted(map(str, found)) == sorted(map(str, wanted)) and found
