import pytest

from clickmill.operators.sessionlog import parse_session_log, raw_event_rejects, raw_events
from helpers import log_line, rows


def parse(lines, *texts, **flags):
    good, bad = parse_session_log(lines(*texts), "line", **flags)
    return [r.asDict() for r in good.collect()], {r["line"]: r["reason"] for r in bad.collect()}


def one(lines, field, **changes):
    (event,), _ = parse(lines, log_line(**changes))
    return event[field]


def test_well_formed_line(lines):
    (event,), bad = parse(lines, log_line())
    assert bad == {}
    assert event == dict(
        user_id="u1", event_type="SHOW", event_subtype="BADGE_DETAIL", event_time="2017-01-01 10:00:00",
        city="Austin", vin="V1", condition="New", year=2010, make="Ford", model="F150", trim="null",
        body_style="Pickup", cab_style="Crew", price=100.5, mileage=12, free_carfax_report=True, features=["a", "b"],
    )


@pytest.mark.parametrize(
    "raw, every, expected",
    [
        ("b:a:null", False, ["a", "b"]),
        ("null:null", False, ["null"]),
        ("null:null", True, []),
        ("null", False, []),
        ("b:a::", False, ["a", "b"]),
        ("z:null:a", False, ["a", "z"]),
        (":b", False, ["", "b"]),
        (":", False, []),
    ],
)
def test_features(lines, raw, every, expected):
    (event,), _ = parse(lines, log_line(features=raw), drop_all_null=every)
    assert event["features"] == expected


@pytest.mark.parametrize("raw, expected", [("t", True), ("f", False), ("true", False), ("TRUE", True), ("x", False)])
def test_carfax_flag(lines, raw, expected):
    assert one(lines, "free_carfax_report", free_carfax_report=raw) is expected


def test_null_text_is_null_in_five_fields_only(lines):
    changes = dict(city="null", vin="null", make="null", model="null", trim="null")
    nulls = dict(vehicle_condition="null", body_style="null", cab_style="null", event="null null")
    (event,), _ = parse(lines, log_line(**changes, **nulls))
    assert [event[c] for c in ("city", "vin", "make", "model", "trim")] == ["null"] * 5
    assert [event[c] for c in ("condition", "body_style", "cab_style", "event_type", "event_subtype")] == [None] * 5


@pytest.mark.parametrize(
    "changes, reason",
    [
        (dict(event="show"), "event without subtype"),
        (dict(event="unshow badges"), "unknown event type"),
        (dict(event="show nothing"), "unknown event subtype"),
        (dict(event="show "), "unknown event subtype"),
        (dict(vehicle_condition="Old"), "unknown condition"),
        (dict(year="20x0"), "year is not a whole number"),
        (dict(year=" 2010"), "year is not a whole number"),
        (dict(year="99999999999999999999"), "year is not a whole number"),
        (dict(body_style="Boat"), "unknown body style"),
        (dict(cab_style="Crew"), "cab style without a space"),
        (dict(cab_style="Mega Cab"), "unknown cab style"),
        (dict(price="abc"), "price is not a number"),
        (dict(mileage="1.5"), "mileage is not a whole number"),
    ],
)
def test_rejects(lines, changes, reason):
    line = log_line(**changes)
    assert parse(lines, line, log_line())[1] == {line: reason}
    assert len(parse(lines, line, log_line())[0]) == 1


def test_short_line_is_rejected_and_failfast_raises(lines):
    short = "\t".join(log_line().split("\t")[:14])
    assert parse(lines, short) == ([], {short: "too few fields"})
    with pytest.raises(Exception, match="too few fields"):
        parse(lines, short, mode="failfast")
    assert len(parse(lines, log_line(), mode="failfast")[0]) == 1


def test_missing_features_by_position_or_from_the_last_field(lines):
    line = log_line(features="")
    assert parse(lines, line)[0][0]["features"] == []
    assert parse(lines, line, strict_last_field=True)[0][0]["features"] == ["t"]
    assert parse(lines, log_line(), strict_last_field=True)[0][0]["features"] == ["a", "b"]


def test_number_widths(lines):
    big = log_line(mileage="3000000000")
    assert parse(lines, big)[0][0]["mileage"] == 3_000_000_000
    assert parse(lines, big, numeric="narrow")[1] == {big: "mileage is not a whole number"}
    good, _ = parse_session_log(lines(log_line()), "line", numeric="narrow")
    assert {c: t for c, t in good.dtypes if c in ("year", "price", "mileage")} == dict(
        year="int", price="float", mileage="int"
    )


def test_raw_events_keep_the_text_as_written(lines):
    found = rows(raw_events(lines(log_line(event="Show Contact Form"), "u1\tshow", "u2\tclick x\tt\tc\tv"), "line"))
    assert found == [
        ("u1", "Austin", "Show", "Contact Form", "2017-01-01 10:00:00", "V1"),
        ("u2", "c", "click", "x", "t", "v"),
    ]


def test_whole_numbers_however_they_are_written(lines):
    good = ["7", "-7", "+7", "007", "0"]
    bad = [" 7", "7 ", "7.0", "", "x", "+", "99999999999999999999"]
    events, rejects = parse_session_log(lines(*[log_line(mileage=m) for m in good + bad]), "line")
    assert sorted(r["mileage"] for r in events.collect()) == [-7, 0, 7, 7, 7]
    assert sorted(r["line"].split("\t")[13] for r in rejects.collect()) == sorted(bad)
    assert {r["reason"] for r in rejects.collect()} == {"mileage is not a whole number"}


def test_raw_events_read_five_fields_and_no_trailing_empty_ones(lines):
    texts = ["u\tshow x\tt\tc\tv", "u\tshow x\tt\tc\tv\tw\t\t", "u\tshow x\tt\tc\t\tw", "u\tshow x\tt\tc\t\t\t"]
    found = raw_events(lines(*texts), "line")
    assert sorted(r["vin"] for r in found.collect()) == ["", "v", "v"]
    assert [r["line"] for r in raw_event_rejects(lines(*texts), "line").collect()] == texts[3:]
