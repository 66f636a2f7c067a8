"""Every registered query against its SQL in DuckDB, and the shape of the plans."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from clickmill.operators import index, sessionlog, sessions
from clickmill.plans import inputs
from clickmill.plans.oracles import ORACLES
from clickmill.plans.queries import REGISTRY as QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{SF_DIR}/{name}')")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    place = [names.index(c) for c in sorted(names)]
    expected = sorted((tuple(plain(r[i]) for i in place) for r in result.fetchall()), key=repr)
    found = sorted((tuple(plain(v) for v in r) for r in df.select(*sorted(names)).collect()), key=repr)
    assert found == expected and found


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_run_in_the_jvm_without_cross_joins(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@needs_data
def test_scans_read_only_the_columns_they_need(spark):
    plan = QUERIES["word_count"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan
    plan = QUERIES["event_statistics"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_orderdate" not in plan


def final_plan(df):
    """The plan that ran, without the initial plans, also those of subqueries."""
    df.collect()
    kept, skipped = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


@needs_data
def test_branches_of_large_keys_share_one_scan_and_their_ranges(spark):
    postings = index.verse_postings(inputs.derive(spark, SF_DIR, inputs.VERSES), "line")
    plan = final_plan(index.verse_index(postings, split_rows=20))
    assert plan.count("Scan parquet") == 1
    # Numbers and offsets of the ranges come from the same shuffle: it is made once and reused.
    assert len(re.findall(r"(?m)^[ :+-]*Exchange rangepartitioning", plan)) == 1
    assert plan.count("ReusedExchange") >= 3
    events, _ = sessionlog.parse_session_log(inputs.derive(spark, SF_DIR, inputs.lines(inputs.LOG)), "line")
    plan = final_plan(sessions.session_lists(sessions.event_runs(events), split_rows=20))
    assert len(re.findall(r"(?m)^[ :+-]*Exchange rangepartitioning", plan)) == 1


@needs_data
def test_without_large_keys_the_branches_vanish(spark):
    postings = index.verse_postings(inputs.derive(spark, SF_DIR, inputs.VERSES), "line")
    plan = final_plan(index.verse_index(postings))
    assert plan.count("Scan parquet") == 1 and "rangepartitioning" not in plan
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) <= 2


@needs_data
def test_row_limit_of_small_sessions_applies_before_the_shuffle(spark):
    plan = QUERIES["small_sessions"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@needs_data
def test_sorted_outputs(spark):
    words = [r["word"] for r in QUERIES["word_count_sorted"](spark, SF_DIR).collect()]
    assert words == sorted(words, key=lambda w: w.encode())
    refs = [(-r["n_refs"], r["word"].encode(), r["page"]) for r in QUERIES["verse_index_by_refs"](spark, SF_DIR).collect()]
    assert refs == sorted(refs)
    pairs = [(r["user_id"], r["city"], r["page"]) for r in QUERIES["user_city_sessions"](spark, SF_DIR).collect()]
    assert pairs == sorted(pairs)
    for name, keys in (("price_statistics", ["make", "model"]), ("mileage_statistics", ["year"]), ("event_statistics", ["vin", "action"])):
        found = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, SF_DIR).collect()]
        assert found == sorted(found)


@needs_data
@pytest.mark.parametrize("name", ["sessionize", "verse_index", "subtype_statistics", "email_index"])
def test_result_does_not_depend_on_the_number_of_partitions(spark, name):
    found = []
    for partitions in (1, 64):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append(sorted(QUERIES[name](spark, SF_DIR).collect(), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert found[0] == found[1]


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0


@needs_data
def test_lines_sent_again_are_those_of_the_sql(spark):
    found = inputs.resent_lines(spark, SF_DIR)
    wanted = inputs.derive(spark, SF_DIR, inputs.lines(inputs.RESENT_LOG))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2
