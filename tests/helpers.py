"""Small builders shared by the tests."""

from clickmill.operators.sessionlog import LOG_FIELDS

GOOD = dict(
    user_id="u1", event="show badge detail", event_timestamp="2017-01-01 10:00:00", city="Austin", vin="V1",
    vehicle_condition="New", year="2010", make="Ford", model="F150", trim="null", body_style="Pickup",
    cab_style="Crew Cab", price="100.5", mileage="12", free_carfax_report="t", features="b:a:null",
)

EVENT_SCHEMA = "user_id STRING, event_type STRING, event_subtype STRING, event_time STRING, vin STRING"


def log_line(**changes):
    return "\t".join({**GOOD, **changes}[name] for name in LOG_FIELDS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def as_set(df):
    found = rows(df)
    assert len(found) == len(set(found))
    return set(found)


def events(spark, *items, schema=EVENT_SCHEMA):
    return spark.createDataFrame(list(items), schema)
