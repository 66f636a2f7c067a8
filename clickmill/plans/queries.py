"""The registered queries: each reads the given tables and returns flat columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions.sampling import keyed_sample, sampled
from clickmill.functions.text import tokenize_lower
from clickmill.jobs import USER_CITY, USER_CITY_ORDER
from clickmill.operators import classify, index, metrics, sessionlog, sessions, subtypes, summaries, vin, words
from clickmill.plans import inputs
from clickmill.sources import sinks
from clickmill.sources.readers import spread

# Sizes at which the given tables fill pages and have keys that are sorted in ranges.
SMALL_PAGE, SMALL_SPLIT = 7, 20

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(inputs.table(spark, sf_dir, "documents"))


def _events(spark: SparkSession, sf_dir: str, log: str = inputs.LOG) -> DataFrame:
    lines = inputs.derive(spark, sf_dir, inputs.lines(log))
    return sessionlog.parse_session_log(lines, "line")[0]


def _resent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionlog.parse_session_log(inputs.resent_lines(spark, sf_dir), "line")[0]


def _distinct_events(spark: SparkSession, sf_dir: str, log: str = inputs.LOG) -> DataFrame:
    """What labels and counts read of the distinct events."""
    return sessions.distinct_events(_events(spark, sf_dir, log), ["user_id", "event_type", "event_subtype"])


def _city_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.resent_lines(spark, sf_dir)
    stream = inputs.derive(spark, sf_dir, inputs.STREAM_LINES)
    return sessionlog.raw_events(log.unionByName(stream), "line")


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(_documents(spark, sf_dir), "text")


@query
def word_count_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(_documents(spark, sf_dir), "text", ordered=True)


@query
def word_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``word<TAB>count``."""
    return sinks.key_value_lines(words.word_count(_documents(spark, sf_dir), "text"), "word", "count")


@query
def word_count_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``(word,count)``."""
    return sinks.pair_lines(words.word_count(_documents(spark, sf_dir), "text"), "word", "count")


@query
def word_count_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count_metrics(_documents(spark, sf_dir), "text")


@query
def word_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_statistics(_documents(spark, sf_dir), "text")


@query
def word_statistics_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_statistics(_documents(spark, sf_dir), "text", tokenize_lower, min_max=True)


@query
def email_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.email_references(inputs.derive(spark, sf_dir, inputs.MAIL), "line")


@query
def email_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = index.email_index(email_references(spark, sf_dir))
    return pages.select("reference", "page", sinks.comma_joined(F.col("message_ids")).alias("message_ids"))


@query
def email_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails without a value after the id header, and mails with addresses that no id comes before."""
    return index.mail_faults(inputs.derive(spark, sf_dir, inputs.FAULTY_MAIL), "line")


@query
def email_index_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the faulty mails, in pages of three ids, the large keys sorted in ranges."""
    references = index.email_references(inputs.derive(spark, sf_dir, inputs.FAULTY_MAIL), "line")
    pages = index.email_index(references, page_size=SMALL_PAGE, split_rows=SMALL_SPLIT)
    return pages.select("reference", "page", sinks.comma_joined(F.col("message_ids")).alias("message_ids"))


@query
def verse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.verse_rejects(inputs.derive(spark, sf_dir, inputs.FAULTY_VERSES), "line")


@query
def verse_index_text_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the words of the ids, with empty leading words, in small pages, the large keys sorted in ranges."""
    lines = inputs.derive(spark, sf_dir, inputs.VERSES)
    postings = index.verse_postings(lines, "line", index_id_tokens=False, keep_leading_empty=True)
    pages = index.verse_index(postings, page_size=SMALL_PAGE, split_rows=SMALL_SPLIT)
    return pages.select("word", "page", sinks.bracketed(F.col("verse_ids")).alias("verse_ids"))


@query
def verse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = index.verse_postings(inputs.derive(spark, sf_dir, inputs.VERSES), "line")
    pages = index.verse_index(postings)
    return pages.select("word", "page", sinks.bracketed(F.col("verse_ids")).alias("verse_ids"))


@query
def verse_index_by_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = index.verse_postings(inputs.derive(spark, sf_dir, inputs.VERSES), "line")
    pages = index.by_reference_count(index.verse_index(postings, n_refs="n_refs"))
    return pages.select("word", "n_refs", "page", sinks.bracketed(F.col("verse_ids")).alias("verse_ids"))


@query
def parse_session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.derive(spark, sf_dir, inputs.FAULTY_LINES)
    events, _ = sessionlog.parse_session_log(lines, "line")
    return events.withColumn("features", F.array_join("features", ":"))


@query
def session_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.derive(spark, sf_dir, inputs.FAULTY_LINES)
    _, rejects = sessionlog.parse_session_log(lines, "line")
    return rejects


@query
def raw_event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionlog.raw_event_rejects(inputs.derive(spark, sf_dir, inputs.FAULTY_RAW_LINES), "line")


@query
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionlog.raw_events(inputs.derive(spark, sf_dir, inputs.FAULTY_RAW_LINES), "line")


@query
def field_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.derive(spark, sf_dir, inputs.LOG).withColumnRenamed("event", "event_type")
    return summaries.field_value_counts(log)


@query
def sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions.sessionize(sessions.event_runs(_resent_events(spark, sf_dir)))
    return found.drop("copies").withColumnRenamed("start", "pos").withColumn("features", F.array_join("features", ":"))


@query
def session_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as nested lists, rendered as text."""
    pages = sessions.session_lists(sessions.event_runs(_resent_events(spark, sf_dir)))
    text = sessions.session_text(F.col("events"))
    return pages.select("user_id", "page", F.size("events").alias("n_events"), text.alias("events"))


@query
def session_lists_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions in small pages with their sizes, the large ones sorted in ranges."""
    runs = sessions.event_runs(_resent_events(spark, sf_dir))
    size = {"n_all": F.count(F.lit(1))}
    pages = sessions.session_lists(runs, page_size=SMALL_PAGE, split_rows=SMALL_SPLIT, facts=size)
    text = sessions.session_text(F.col("events"))
    return pages.select("user_id", "n_all", "page", F.size("events").alias("n_events"), text.alias("events"))


@query
def small_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of at most 100 events."""
    found = sessions.small_sessions(_events(spark, sf_dir))
    text = sessions.session_text(F.col("events"))
    return found.select("user_id", F.size("events").alias("n_events"), text.alias("events"))


@query
def session_labels_contact_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _distinct_events(spark, sf_dir, inputs.ORDER_LOG)
    return classify.session_labels(events, require_contact_form=True)


@query
def session_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.session_labels(_distinct_events(spark, sf_dir))


@query
def session_labels_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = session_labels_contact_form(spark, sf_dir)
    return keyed_sample(labels, "session_type", ["session_type", "user_id"], classify.SAMPLE_RATES)


@query
def session_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole small sessions, once per label, as they are written to one directory per label."""
    found = classify.classify_multi(sessions.small_sessions(_events(spark, sf_dir, inputs.ORDER_LOG)), False)
    text = sessions.session_text(F.col("events"))
    return found.select("session_type", "user_id", F.size("events").alias("n_events"), text.alias("events"))


@query
def shower_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions left after sampling the showers."""
    lines = inputs.derive(spark, sf_dir, inputs.lines(inputs.ORDER_LOG))
    labelled = classify.shower_sessions(sessionlog.raw_events(lines, "line"), USER_CITY)
    return keyed_sample(labelled, "session_type", USER_CITY, {"shower": classify.SHOWER_RATE}, inclusive=True)


def _user_city_pages(spark: SparkSession, sf_dir: str, **sizes: int) -> DataFrame:
    runs = sessions.event_runs(_city_events(spark, sf_dir), USER_CITY, USER_CITY_ORDER, dedupe=False)
    kept = sampled(classify.shower_label(), USER_CITY, {"shower": classify.SHOWER_RATE}, 42, inclusive=True)
    facts = classify.shower_facts()
    pages = sessions.session_lists(runs, USER_CITY, dedupe=False, facts=facts, kept=kept, **sizes)
    text = sessions.session_text(F.col("events"))
    return pages.select("user_id", "city", "page", F.size("events").alias("n_events"), text.alias("events"))


@query
def user_city_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two logs as one, sessions by user and city, showers sampled, duplicates kept, sorted by user and city."""
    return _user_city_pages(spark, sf_dir).orderBy("user_id", "city", "page")


@query
def user_city_sessions_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in small pages, the large sessions sorted in ranges."""
    return _user_city_pages(spark, sf_dir, page_size=SMALL_PAGE, split_rows=SMALL_SPLIT)


@query
def session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.derive(spark, sf_dir, inputs.lines(inputs.ORDER_LOG))
    labelled = classify.shower_sessions(sessionlog.raw_events(lines, "line"), USER_CITY)
    return metrics.session_metrics(labelled, USER_CITY)


@query
def filter_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.filter_metrics(_distinct_events(spark, sf_dir))


@query
def vin_user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vin.vin_user_metrics(_events(spark, sf_dir)).drop("clicks")


@query
def vin_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = vin.vin_user_metrics(_events(spark, sf_dir)).select("vin", F.explode("clicks"))
    return clicks.toDF("vin", "event_subtype", "sessions")


@query
def vin_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vin.impressions(inputs.derive(spark, sf_dir, inputs.IMPRESSIONS))


@query
def vin_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = vin.vin_join(
        vin.vin_user_metrics(_events(spark, sf_dir)),
        vin.impressions(inputs.derive(spark, sf_dir, inputs.IMPRESSIONS)),
    )
    entries = F.transform(F.map_entries("clicks"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return joined.withColumn("clicks", F.array_join(entries, ","))


@query
def subtype_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtypes.subtype_statistics(_distinct_events(spark, sf_dir))


@query
def subtype_statistics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short sessions, with the sums over all session types."""
    events = _distinct_events(spark, sf_dir, inputs.ORDER_LOG)
    return subtypes.subtype_statistics(events, require_contact_form=True, all_types=True)


@query
def price_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.price_statistics(inputs.derive(spark, sf_dir, inputs.LOG))


@query
def mileage_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.mileage_statistics(inputs.derive(spark, sf_dir, inputs.LOG))


@query
def event_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.event_statistics(inputs.derive(spark, sf_dir, inputs.LOG))
