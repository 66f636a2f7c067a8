"""Parsing of tab-separated session logs into typed events and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 16 fields of a log line, in order, and the symbols of the coded fields.
LOG_FIELDS = (
    "user_id", "event", "event_timestamp", "city", "vin", "vehicle_condition", "year", "make",
    "model", "trim", "body_style", "cab_style", "price", "mileage", "free_carfax_report", "features",
)
RAW_FIELDS = LOG_FIELDS.index("vin") + 1
EVENT_TYPES = ("CHANGE", "CLICK", "DISPLAY", "EDIT", "SHOW", "SUBMIT", "VISIT")
EVENT_SUBTYPES = (
    "ALTERNATIVE", "BADGES", "BADGE_DETAIL", "CONTACT_BANNER", "CONTACT_BUTTON", "CONTACT_FORM",
    "DEALER_PHONE", "FEATURES", "GET_DIRECTIONS", "MARKET_REPORT", "PHOTO_MODAL", "VEHICLE_HISTORY",
)
CONDITIONS = ("New", "Used", "CPO")
BODY_STYLES = (
    "Chassis", "Convertible", "Coupe", "Hatchback", "Minivan", "Pickup", "SUV", "Sedan", "Van", "Wagon",
)
CAB_STYLES = ("Crew", "Extended", "Regular")

# Numeric types of year, price and mileage in the two versions of the log.
NUMERIC = {"wide": ("bigint", "double", "bigint"), "narrow": ("int", "float", "int")}
WHOLE_NUMBER = r"^[+-]?\d+$"
NULL_TEXT = "null"


def _null_text(value: Column) -> Column:
    return F.nullif(value, F.lit(NULL_TEXT))


def feature_parts(value: Column) -> Column:
    """Parts of a ``:``-separated list without trailing empty parts."""
    ended = F.rtrim(value, F.lit(":"))
    only_colons = (ended == "") & (value != "")
    return F.when(only_colons, F.array().cast("array<string>")).otherwise(F.split(ended, ":"))


def without_null(parts: Column, every: bool = False) -> Column:
    """Sorted parts without the first ``null``, or without every one."""
    if every:
        return F.array_remove(parts, NULL_TEXT)
    found = F.array_position(parts, NULL_TEXT).cast("int")
    rest = F.concat(F.slice(parts, 1, found - 1), F.slice(parts, found + 1, F.size(parts)))
    return F.when(F.array_contains(parts, NULL_TEXT), rest).otherwise(parts)


def carfax_flag(value: Column) -> Column:
    """Each ``t`` is read as ``true`` before parsing: ``t`` is true, ``true`` becomes ``truerue`` and is false."""
    return F.lower(F.replace(value, F.lit("t"), F.lit("true"))) == "true"


def _field(name: str) -> Column:
    return F.get("fields", F.lit(LOG_FIELDS.index(name)))


def _reason() -> Column:
    """Why the line cannot be an event; NULL if it can."""
    event_type, event_subtype = F.col("event_type"), F.col("event_subtype")

    def unknown(value: Column, symbols: tuple[str, ...]) -> Column:
        return (value != NULL_TEXT) & ~value.isin(*symbols)

    def not_whole(name: str) -> Column:
        # A number that is written as in the line is whole; the pattern decides on others.
        other = F.col(name).cast("string") != _field(name)
        return F.col(name).isNull() | (other & ~_field(name).rlike(WHOLE_NUMBER))

    cab_style = _field("cab_style")
    return (
        F.when(F.size("fields") < len(LOG_FIELDS) - 1, "too few fields")
        .when(~_field("event").contains(" "), "event without subtype")
        .when(event_type.isNotNull() & ~event_type.isin(*EVENT_TYPES), "unknown event type")
        .when(event_subtype.isNotNull() & ~event_subtype.isin(*EVENT_SUBTYPES), "unknown event subtype")
        .when(unknown(_field("vehicle_condition"), CONDITIONS), "unknown condition")
        .when(not_whole("year"), "year is not a whole number")
        .when(unknown(_field("body_style"), BODY_STYLES), "unknown body style")
        .when((cab_style != NULL_TEXT) & ~cab_style.contains(" "), "cab style without a space")
        .when(unknown(F.substring_index(cab_style, " ", 1), CAB_STYLES), "unknown cab style")
        .when(F.col("price").isNull(), "price is not a number")
        .when(not_whole("mileage"), "mileage is not a whole number")
    )


def _fields(df: DataFrame, line: str, first: int | None = None) -> DataFrame:
    """line, fields: the tab-separated fields without trailing empty ones, or the ``first`` of them and the rest of the line."""
    fields = F.split(F.rtrim(F.col(line), F.lit("\t")), "\t", first + 1 if first else -1)
    # Generated rather than projected, so that later filters use the array and do not split the line again.
    return df.select(F.col(line).alias("line"), F.explode(F.array(fields)).alias("fields"))


def parsed_lines(
    df: DataFrame, line: str, strict_last_field: bool = False, drop_all_null: bool = False, numeric: str = "wide"
) -> DataFrame:
    """line, reason (why it is no event; NULL if it is one) and the event's fields: one row per line."""
    event = _field("event")
    last = F.get("fields", F.size("fields") - 1) if strict_last_field else _field("features")
    parts = F.sort_array(F.coalesce(feature_parts(last), F.array().cast("array<string>")))
    raw_type = F.substring_index(event, " ", 1)
    raw_subtype = F.substr(event, F.instr(event, " ") + 1)
    event_type = F.upper(_null_text(raw_type))
    event_subtype = F.upper(F.translate(_null_text(raw_subtype), " ", "_"))
    year_type, price_type, mileage_type = NUMERIC[numeric]
    # Generated as the fields are, so that the reason and the filters on it do not repeat any of these.
    read = F.struct(
        event_type.alias("event_type"),
        event_subtype.alias("event_subtype"),
        _field("year").try_cast(year_type).alias("year"),
        _field("price").try_cast(price_type).alias("price"),
        _field("mileage").try_cast(mileage_type).alias("mileage"),
    )
    raw = _fields(df, line).select("line", "fields", F.inline(F.array(read))).withColumn("parts", parts)
    return raw.select(
        "line",
        _reason().alias("reason"),
        _field("user_id").alias("user_id"),
        "event_type",
        "event_subtype",
        _field("event_timestamp").alias("event_time"),
        _field("city").alias("city"),
        _field("vin").alias("vin"),
        _null_text(_field("vehicle_condition")).alias("condition"),
        "year",
        _field("make").alias("make"),
        _field("model").alias("model"),
        _field("trim").alias("trim"),
        _null_text(_field("body_style")).alias("body_style"),
        F.substring_index(_null_text(_field("cab_style")), " ", 1).alias("cab_style"),
        "price",
        "mileage",
        carfax_flag(_field("free_carfax_report")).alias("free_carfax_report"),
        without_null(F.col("parts"), drop_all_null).alias("features"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """The events of parsed lines."""
    return parsed.filter("reason is null").drop("line", "reason")


def rejected(parsed: DataFrame) -> DataFrame:
    """line, reason of the parsed lines that are no events."""
    return parsed.filter("reason is not null").select("line", "reason")


def parse_session_log(
    df: DataFrame,
    line: str,
    strict_last_field: bool = False,
    drop_all_null: bool = False,
    numeric: str = "wide",
    mode: str = "permissive",
) -> tuple[DataFrame, DataFrame]:
    """(events, rejects). Rejects hold line and reason; ``mode="failfast"`` raises on the first one instead.

    ``strict_last_field`` reads the features from the last field present, ``numeric`` picks the number types.
    """
    parsed = parsed_lines(df, line, strict_last_field, drop_all_null, numeric)
    if mode == "failfast":
        failure = F.raise_error(F.concat_ws(": ", "reason", "line")).cast("boolean")
        events = parsed.filter(F.when(F.col("reason").isNotNull(), failure).otherwise(F.lit(True))).drop("line", "reason")
    else:
        events = accepted(parsed)
    return events, rejected(parsed)


def _raw_reason() -> Column:
    """Why a line is no raw event; NULL for good lines. Lines short of the five fields that are read are faulty."""
    event = _field("event")
    return (
        F.when(F.col("fields").isNull() | _field("vin").isNull(), "fewer than five fields")
        .when(~F.contains(event, F.lit(" ")), "event without a subtype")
    )


def raw_events(df: DataFrame, line: str) -> DataFrame:
    """user_id, city, event_type, event_subtype, event_time, vin as written; faulty lines are left to the rejects."""
    event = _field("event")
    return _fields(df, line, RAW_FIELDS).filter(_raw_reason().isNull()).select(
        _field("user_id").alias("user_id"),
        _field("city").alias("city"),
        F.substring_index(event, " ", 1).alias("event_type"),
        F.substr(event, F.instr(event, " ") + 1).alias("event_subtype"),
        _field("event_timestamp").alias("event_time"),
        _field("vin").alias("vin"),
    )


def raw_event_rejects(df: DataFrame, line: str) -> DataFrame:
    """line, reason: the lines that ``raw_events`` leaves out."""
    return _fields(df, line, RAW_FIELDS).select("line", _raw_reason().alias("reason")).filter("reason is not null")
