import os

from pyspark.sql import functions as F

from clickmill.operators import classify, sessions, summaries, words
from clickmill.sources import readers, sinks
from helpers import events, rows


def put(folder, name, *texts):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines(t + "\n" for t in texts)
    return path


def test_lines_of_several_inputs(spark, out_dir):
    a, b = put(out_dir, "a", "x", "y"), put(out_dir, "b", "z")
    assert sorted(rows(readers.read_lines(spark, a))) == [("x",), ("y",)]
    assert sorted(rows(readers.read_lines(spark, f"{a},{b}"))) == [("x",), ("y",), ("z",)]
    assert sorted(rows(readers.read_lines_union(spark, a, [a, b]))) == [("x",), ("x",), ("y",), ("y",), ("z",)]


def test_impressions(spark, out_dir):
    a, b = put(out_dir, "a.csv", "V1,SRP,3"), put(out_dir, "b.csv", "V1,VDP,4")
    assert sorted(rows(readers.read_impressions(spark, a, b))) == [("V1", "SRP", 3), ("V1", "VDP", 4)]


def test_table_with_header_and_view(spark, out_dir):
    path = put(out_dir, "t.csv", "make,price", "Ford,1.5", "Ford,0")
    assert readers.read_table(spark, path, view="session_table").dtypes == [("make", "string"), ("price", "double")]
    assert spark.sql("SELECT count(*) FROM session_table WHERE price != 0").first()[0] == 1
    assert readers.read_table(spark, path, "make STRING, price STRING").dtypes[1] == ("price", "string")


def test_text_forms(spark, lines, out_dir):
    counted = words.word_count(lines("a b a"), "line")
    path = os.path.join(out_dir, "count")
    sinks.write_lines(sinks.key_value_lines(counted, "word", "count"), path)
    assert sorted(rows(spark.read.text(path))) == [("a\t2",), ("b\t1",)]
    stats = words.word_statistics(lines("a a b", "a"), "line")
    shown = sinks.key_value_lines(stats, "word", sinks.word_statistics_text())
    assert ("a\t\t2,1.5,0.25",) in rows(shown)
    assert rows(sinks.pair_lines(lines("k").withColumn("n", F.lit(1)), "line", "n")) == [("(k,1)",)]
    ids = F.array(F.lit("x"), F.lit("y"))
    assert rows(lines("k").select(sinks.bracketed(ids), sinks.comma_joined(ids))) == [("[x, y]", "x,y")]


def test_one_directory_per_label_read_back(spark, out_dir):
    df = events(spark, ("u", "CLICK", "BADGES", "1", "V"), ("u", "VISIT", "BADGES", "1", "V"), ("w", "VISIT", "BADGES", "1", "V"))
    labelled = classify.classify_multi(sessions.small_sessions(df), False)
    path = os.path.join(out_dir, "bins")
    sinks.write_by_label(labelled, path)
    assert {d for d in os.listdir(path) if "=" in d} == {"session_type=clicker", "session_type=visitor"}
    one = readers.read_sessions(spark, os.path.join(path, "session_type=visitor"))
    assert {r["user_id"]: len(r["events"]) for r in one.collect()} == {"u": 2, "w": 1}
    both = readers.read_statistics(spark, *[os.path.join(path, f"session_type={t}") for t in ("clicker", "visitor")])
    assert both.count() == 3


def test_key_value_containers_are_unwrapped(spark, out_dir):
    path = os.path.join(out_dir, "kv")
    value = F.struct(F.lit("u").alias("user_id"), F.array(F.lit(1)).alias("events"))
    sinks.write_records(spark.range(1).select(F.lit("u").alias("key"), value.alias("value")), path)
    assert readers.read_sessions(spark, path).columns == ["user_id", "events"]


def test_csv_in_order(spark, out_dir):
    df = spark.createDataFrame([("b", "m", "1"), ("a", "m", "2"), ("c", "m", "3")], "make STRING, model STRING, price STRING")
    path = os.path.join(out_dir, "csv")
    sinks.write_csv(summaries.price_statistics(df), path, order=["make", "model"], single_file=True)
    (part,) = [f for f in os.listdir(path) if f.startswith("part-")]
    assert open(os.path.join(path, part)).read().splitlines() == ["a,m,2.0,2.0,2.0", "b,m,1.0,1.0,1.0", "c,m,3.0,3.0,3.0"]


def test_layout_by_city_keeps_the_rows(spark):
    df = spark.createDataFrame([(f"c{i % 3}", i) for i in range(30)], "city STRING, n INT")
    laid_out = sinks.by_city(df)
    assert laid_out.rdd.getNumPartitions() == 6 and sorted(rows(laid_out)) == sorted(rows(df))


def test_few_files_are_spread_and_many_left_alone(spark, out_dir):
    cores = spark.sparkContext.defaultParallelism
    for files, spread in ((1, True), (cores + 1, False)):
        path = os.path.join(out_dir, str(files))
        spark.range(100).repartition(files).write.parquet(path)
        df = spark.read.parquet(path)
        assert (readers.spread(df) is not df) == spread
        assert sorted(rows(readers.spread(df))) == [(i,) for i in range(100)]


def test_rebalanced_labels_have_few_files_and_large_ones_are_split(spark, out_dir):
    df = spark.range(20_000, numPartitions=8).selectExpr("id", "concat('l', CASE WHEN id % 10 < 8 THEN 0 ELSE id % 10 END) AS label", "md5(string(id)) AS filler")
    files = {}
    for rebalance in (False, True):
        path = os.path.join(out_dir, f"labels{rebalance}")
        sinks.write_by_label(df, path, "label", rebalance=rebalance)
        assert spark.read.parquet(path).count() == 20_000
        files[rebalance] = len(spark.read.parquet(path).inputFiles())
    assert files[True] < files[False] == 24
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sizes = sinks.balanced(df, "label").groupBy(F.spark_partition_id().alias("p")).count().collect()
        laid_out = sinks.balanced(df, "label").withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    per_task = {}
    for row in laid_out:
        per_task[row["p"]] = per_task.get(row["p"], 0) + 1
    assert sizes and max(per_task.values()) < 0.5 * 20_000
