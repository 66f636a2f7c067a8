"""The jobs end to end: paths in, paths out. Each reads its input, applies the operators and writes the result.

Lists longer than a page take several lines or records, in page order.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickmill.functions.sampling import sampled
from clickmill.functions.text import tokenize_lower
from clickmill.operators import classify, index, metrics, sessionlog, sessions, subtypes, summaries, vin, words
from clickmill.sources import readers, sinks

USER_CITY = ("user_id", "city")
USER_CITY_ORDER = ("event_time", "event_type", "event_subtype", "vin")


def shared(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """A frame that several outputs start from: checkpointed if the cluster names a folder, else kept at a storage level."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    return df.checkpoint() if folder else df.persist(level)


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The shared frame, made once for all outputs of the block and released after the last one."""
    frame = shared(df, level)
    try:
        yield frame
    finally:
        frame.unpersist()


def word_count(spark: SparkSession, source: str, target: str) -> None:
    """Lines ``word<TAB>count``."""
    counted = words.word_count(readers.read_lines(spark, source), "value")
    sinks.write_lines(sinks.key_value_lines(counted, "word", "count"), target)


def sorted_word_count(spark: SparkSession, source: str, target: str) -> None:
    """Lines ``(word,count)`` in word order."""
    counted = words.word_count(readers.read_lines(spark, source), "value", ordered=True)
    sinks.write_lines(sinks.pair_lines(counted, "word", "count"), target)


def word_statistics(spark: SparkSession, source: str, target: str) -> None:
    """Lines ``word<TAB><TAB>documents,mean,variance``."""
    found = words.word_statistics(readers.read_lines(spark, source), "value")
    sinks.write_lines(sinks.key_value_lines(found, "word", sinks.word_statistics_text()), target)


def word_statistics_minmax(spark: SparkSession, source: str, target: str) -> None:
    """Lines ``word<TAB>{json record}``."""
    found = words.word_statistics(readers.read_lines(spark, source), "value", tokenize_lower, min_max=True)
    record = F.to_json(F.struct(*[c for c in found.columns if c != "word"]))
    sinks.write_lines(sinks.key_value_lines(found, "word", record), target)


def email_index(spark: SparkSession, source: str, target: str, rejects: str | None = None) -> None:
    """Lines ``header:address<TAB>id,id``; mails that are not indexed, or not in full, go to ``rejects`` if given."""
    mails = readers.read_lines(spark, source)
    pages = index.email_index(index.email_references(mails, "value"))
    ids = sinks.comma_joined(F.col("message_ids"))
    sinks.write_lines(sinks.key_value_lines(pages, "reference", ids), target)
    if rejects:
        bad = index.mail_faults(mails, "value")
        sinks.write_records(bad, rejects)


def verse_index(spark: SparkSession, source: str, by_word: str, by_count: str, rejects: str | None = None) -> None:
    """Lines ``(word,[id, id])``: in word order, and by descending number of ids; the lists are made once for both."""
    lines = readers.read_lines(spark, source)
    with kept(index.verse_index(index.verse_postings(lines, "value"), n_refs="n_refs")) as pages:
        shown = sinks.bracketed(F.col("verse_ids"))
        ordered = pages.orderBy("word", "page").withColumn("verse_ids", shown)
        sinks.write_lines(sinks.pair_lines(ordered, "word", "verse_ids"), by_word)
        counted = index.by_reference_count(pages).withColumn("verse_ids", shown)
        sinks.write_lines(sinks.pair_lines(counted, "word", "verse_ids"), by_count)
    if rejects:
        sinks.write_records(index.verse_rejects(lines, "value"), rejects)


def user_sessions(
    spark: SparkSession, source: str, target: str, rejects: str | None = None, table: str | None = None, buckets: int = 200
) -> None:
    """Nested sessions by user with their sizes; lines that cannot be parsed go to ``rejects`` if given.

    Lines are parsed once: with rejects, kept and rejected lines are two filters on the same shared frame. With ``table`` the
    sessions are stored at ``target`` as a table of that name in buckets by user, which later jobs group without a shuffle.
    """

    def write(parsed: DataFrame) -> None:
        runs = sessions.event_runs(sessionlog.accepted(parsed))
        pages = sessions.session_lists(runs, facts={"n_events": F.count(F.lit(1))})
        if table:
            sinks.write_buckets(pages, table, target, "user_id", buckets)
        else:
            sinks.write_records(pages, target)

    parsed = sessionlog.parsed_lines(readers.read_lines(spark, source), "value")
    if not rejects:
        write(parsed)
        return
    with kept(parsed) as once:
        write(once)
        sinks.write_records(sessionlog.rejected(once), rejects)


def field_value_counts(spark: SparkSession, source: str, target: str, strict_last_field: bool = False) -> None:
    """Lines ``field:value<TAB>count``; ``strict_last_field`` reads the features from the last field present."""
    fields = F.split(F.rtrim("value", F.lit("\t")) if strict_last_field else F.col("value"), "\t")
    names = ["event_type" if name == "event" else name for name in sessionlog.LOG_FIELDS]
    columns = [F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(names)]
    if strict_last_field:
        columns[-1] = F.get(fields, F.size(fields) - 1).alias(names[-1])
    log = readers.read_lines(spark, source).select(*columns)
    counted = summaries.field_value_counts(log)
    sinks.write_lines(sinks.key_value_lines(counted, "field_value", "count"), target)


def vin_impressions(spark: SparkSession, session_path: str, impression_paths: list[str], target: str) -> None:
    """Per-vehicle records of users, clicks and impressions."""
    events = sessions.explode_sessions(readers.read_sessions(spark, session_path).drop("page"))
    shown = vin.impressions(readers.read_impressions(spark, *impression_paths))
    sinks.write_records(vin.vin_join(vin.vin_user_metrics(events), shown), target)


def stored_size(stored: DataFrame) -> Column:
    """The number of events of a stored session. Pages of a session do not tell it: their table must hold n_events."""
    if "n_events" in stored.columns:
        return F.col("n_events")
    if "page" in stored.columns:
        raise ValueError("sessions stored in pages need the column n_events")
    return F.size("events")


def small_stored_sessions(stored: DataFrame, max_events: int = sessions.MAX_EVENTS) -> DataFrame:
    """user_id, events: the stored sessions of at most ``max_events`` events. Larger ones are known by their size."""
    return stored.filter(stored_size(stored) <= max_events).select("user_id", "events")


def session_bins(spark: SparkSession, session_path: str, target: str, counters: str | None = None) -> None:
    """Sessions of at most 100 events, one directory per label; clickers and showers sampled. No shuffle.

    The counters are observed while the sessions are written: one pass, and a task that is run again counts once, as it is a
    task of the last stage.
    """
    stored = readers.read_sessions(spark, session_path)
    large = stored_size(stored) > sessions.MAX_EVENTS
    first = F.col("page") == 0 if "page" in stored.columns else F.lit(True)
    sizes, labels = Observation(), Observation()
    observed = stored.observe(sizes, F.count_if(large & first).alias("large_discarded"))
    labelled = classify.classify_multi(small_stored_sessions(observed), require_contact_form=True)
    keys = ["session_type", "user_id"]
    stays = sampled(F.col("session_type"), keys, classify.SAMPLE_RATES, 42, inclusive=False)
    counts = [
        F.count_if((F.col("session_type") == name) & (stays if kept_ones else ~stays)).alias(f"{name}_{end}")
        for name in classify.SESSION_TYPES
        for kept_ones, end in ((True, "written"), (False, "discarded"))
    ]
    sinks.write_by_label(labelled.observe(labels, *counts).filter(stays), target)
    if counters:
        found = [(metric, value) for metric, value in (sizes.get | labels.get).items() if value]
        sinks.write_records(spark.createDataFrame(found, "metric string, value bigint"), counters)


def subtype_statistics(
    spark: SparkSession, session_path: str | None, target: str, bins: str | None = None, table: str | None = None
) -> None:
    """Statistics of all session types, one directory per type; the sessions of each type too if asked for.

    Sessions are read from a path, or from the ``table`` that ``user_sessions`` stored in buckets.
    """
    stored = spark.table(table) if table else readers.read_sessions(spark, session_path)
    flat = sessions.explode_sessions(stored.select("user_id", "events"))
    sinks.write_by_label(subtypes.subtype_statistics(flat), target)
    if bins:
        sinks.write_by_label(classify.classify_multi(small_stored_sessions(stored), False), bins)


def user_city_sessions(
    spark: SparkSession, source: str, second_source: str, target: str, counters: str | None = None, rejects: str | None = None
) -> None:
    """Lines ``((user,city),[<type:subtype,time,vin>, ...])`` in key order; one in ten showers kept."""
    lines = readers.read_lines_union(spark, source, second_source)
    events = sessionlog.raw_events(lines, "value")
    stay = sampled(classify.shower_label(), USER_CITY, {"shower": classify.SHOWER_RATE}, 42, inclusive=True)
    with kept(sessions.event_runs(events, USER_CITY, USER_CITY_ORDER, dedupe=False)) as runs:
        pages = sessions.session_lists(runs, USER_CITY, dedupe=False, facts=classify.shower_facts(), kept=stay)
        key = F.concat(F.lit("("), F.concat_ws(",", *USER_CITY), F.lit(")"))
        shown = pages.orderBy(*USER_CITY, "page").select(key.alias("key"), sessions.session_text(F.col("events")).alias("list"))
        sinks.write_lines(sinks.pair_lines(shown, "key", "list"), target)
        if counters:
            sinks.write_records(metrics.session_metrics(classify.shower_sessions(runs, USER_CITY), USER_CITY), counters)
    if rejects:
        sinks.write_records(sessionlog.raw_event_rejects(lines, "value"), rejects)


def table_statistics(spark: SparkSession, source: str, target: str, schema: str | None = None) -> None:
    """CSV files of price, mileage and event statistics below ``target``."""
    table = readers.read_table(spark, source, schema, view="session_table")
    sinks.write_csv(summaries.price_statistics(table), f"{target}/price", ["make", "model"])
    sinks.write_csv(summaries.mileage_statistics(table), f"{target}/mileage", ["year"])
    sinks.write_csv(summaries.event_statistics(table), f"{target}/event", ["vin", "action"])
