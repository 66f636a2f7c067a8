"""DuckDB SQL with the same result as each registered query, over the same tables."""

from __future__ import annotations

from clickmill.plans import inputs

PAGE = 10000
SMALL_PAGE = 7
SUBTYPES = [s.upper().replace(" ", "_") for s in inputs.SUBTYPES]


def _quoted(values: list[str] | tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _in(text: str) -> str:
    return inputs.for_duckdb(text)


# ---- words

WS = r"'[ \t\n\r\f]+'"


def _tokens(expression: str) -> str:
    return (
        f"SELECT doc_id, unnest(regexp_split_to_array({expression}, {WS})) AS word FROM documents"
    )


NORM = (
    r"""regexp_replace(regexp_replace(lower(text), '[^a-z\p{L}\d\[\]''*\\1 ]', ' ', 'g'), '\[', ' [', 'g')"""
)


def _word_stats(expression: str, columns: str) -> str:
    return f"""
WITH tokens AS ({_tokens(expression)}),
     freq AS (SELECT doc_id, word, count(*) AS f FROM tokens WHERE word <> '' GROUP BY doc_id, word),
     sums AS (SELECT word, count(*) AS n, CAST(sum(f) AS BIGINT) AS s, CAST(sum(f * f) AS BIGINT) AS q,
                     min(f) AS lo, max(f) AS hi FROM freq GROUP BY word)
SELECT word, {columns}, CAST(s AS DOUBLE) / n AS mean,
       CAST(q AS DOUBLE) / n - (CAST(s AS DOUBLE) / n) * (CAST(s AS DOUBLE) / n) AS variance
FROM sums"""


WORD_COUNT = f"SELECT word, count(*) AS count FROM ({_tokens('text')}) WHERE word <> '' GROUP BY word"
WORD_COUNT_METRICS = f"""
SELECT 'input_lines' AS metric, count(*) AS value FROM documents
UNION ALL SELECT 'words_out', count(*) FROM ({_tokens('text')}) WHERE word <> ''"""

# ---- e-mail and verse indexes

def _email(mails: str) -> str:
    return rf"""
WITH mails AS MATERIALIZED (SELECT row_number() OVER () AS m, line FROM ({_in(mails)})),
     split AS (SELECT m, list_filter(regexp_split_to_array(replace(line, ',', ' '), {WS}), lambda t: t <> '') AS toks
               FROM mails),
     toks AS (SELECT m, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS i FROM split),
     marked AS (
       SELECT m, i, tok, lower(lag(tok) OVER w) = 'message-id:' AS is_id,
              CASE lower(tok) WHEN 'from:' THEN 'From:' WHEN 'to:' THEN 'To:' WHEN 'cc:' THEN 'Cc:'
                              WHEN 'bcc:' THEN 'Bcc:' END AS header,
              lower(tok) = 'x-from:' AS is_end
       FROM toks WINDOW w AS (PARTITION BY m ORDER BY i)),
     state AS (
       SELECT m, i, tok, coalesce(is_id, false) AS is_id, header AS own_header,
              last_value(header IGNORE NULLS) OVER w AS header,
              last_value(CASE WHEN is_id THEN tok END IGNORE NULLS) OVER w AS message_id,
              count(*) FILTER (is_end) OVER w AS ended
       FROM marked WINDOW w AS (PARTITION BY m ORDER BY i)),
     refs AS (
       SELECT concat(coalesce(header, ''), tok) AS reference, message_id FROM state
       WHERE contains(tok, '@') AND NOT is_id AND own_header IS NULL AND ended = 0)"""


EMAIL = _email(inputs.MAIL)
_VALUELESS = f"SELECT line FROM ({inputs.FAULTY_MAIL}) AS f WHERE line LIKE '%message-id:'"
FAULTY_EMAIL = _email(f"SELECT line FROM ({inputs.FAULTY_MAIL}) AS f WHERE NOT line LIKE '%message-id:'")
EMAIL_REJECTS = f"""{FAULTY_EMAIL}
SELECT line, 'address without a message id' AS reason FROM mails WHERE m IN (
  SELECT m FROM state WHERE contains(tok, '@') AND NOT is_id AND own_header IS NULL AND ended = 0 AND message_id IS NULL)
UNION ALL SELECT line, 'message id header without a value' FROM ({_in(_VALUELESS)})"""


def _email_index(mails: str, page: int) -> str:
    return f"""{mails},
     places AS (
       SELECT *, (row_number() OVER (PARTITION BY reference ORDER BY message_id) - 1) // {page} AS page
       FROM (SELECT DISTINCT reference, message_id FROM refs WHERE message_id IS NOT NULL))
SELECT reference, page, string_agg(message_id, ',' ORDER BY message_id) AS message_ids
FROM places GROUP BY reference, page"""


EMAIL_INDEX = _email_index(EMAIL, PAGE)

def _verse(words: str) -> str:
    return rf"""
WITH verses AS (SELECT split_part(line, ' ', 1) AS verse_id, line FROM ({_in(inputs.VERSES)})),
     texts AS (SELECT verse_id, lower(substr(line, length(verse_id) + 2)) AS text FROM verses),
     words AS ({words}),
     postings AS (SELECT DISTINCT word, verse_id, split_part(verse_id, ':', 1) AS book,
                         CAST(split_part(verse_id, ':', 2) AS INT) AS chapter,
                         CAST(split_part(verse_id, ':', 3) AS INT) AS verse
                  FROM words),
     places AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY book, chapter, verse, verse_id) - 1 AS start,
                       count(*) OVER (PARTITION BY word) AS n_refs
                FROM postings)"""


_BREAKS = r"[\d[:punct:]\s\x0B]+"
VERSE = _verse(
    f"""SELECT * FROM (SELECT verse_id, unnest(regexp_split_to_array(lower(line), '{_BREAKS}')) AS word FROM verses)
       WHERE word <> ''"""
)
# The words of the texts; an empty first word stays, unless the text holds nothing else.
TEXT_VERSE = _verse(
    f"""SELECT verse_id, unnest(list_concat(parts[1:1], list_filter(parts[2:], lambda w: w <> ''))) AS word
       FROM (SELECT verse_id, regexp_split_to_array(text, '{_BREAKS}') AS parts FROM texts
             WHERE NOT regexp_full_match(text, '{_BREAKS}'))"""
)

_VERSE_IDS = "concat('[', string_agg(verse_id, ', ' ORDER BY start), ']') AS verse_ids"
VERSE_INDEX_TEXT_WORDS = (
    f"{TEXT_VERSE} SELECT word, start // {SMALL_PAGE} AS page, {_VERSE_IDS} FROM places GROUP BY 1, 2"
)
_CHAPTER, _VERSE_NUMBER = (f"split_part(split_part(line, ' ', 1), ':', {part})" for part in (2, 3))
VERSE_REJECTS = f"""SELECT line, 'id is not book:chapter:verse' AS reason FROM ({_in(inputs.FAULTY_VERSES)})
WHERE try_cast({_CHAPTER} AS INT) IS NULL OR try_cast({_VERSE_NUMBER} AS INT) IS NULL"""
VERSE_INDEX = f"{VERSE} SELECT word, start // {PAGE} AS page, {_VERSE_IDS} FROM places GROUP BY 1, 2"
VERSE_INDEX_BY_REFS = (
    f"{VERSE} SELECT word, n_refs, start // {PAGE} AS page, {_VERSE_IDS} FROM places GROUP BY 1, 2, 3"
)

# ---- session log


def _parsed(lines: str) -> str:
    return f"""
WITH fields AS (SELECT line, string_split(line, chr(9)) AS f FROM ({_in(lines)})),
     events AS (
       SELECT line, len(f) AS n_fields, f[1] AS user_id,
              upper(nullif(split_part(f[2], ' ', 1), 'null')) AS event_type,
              upper(replace(nullif(substr(f[2], strpos(f[2], ' ') + 1), 'null'), ' ', '_')) AS event_subtype,
              f[3] AS event_time, f[4] AS city, f[5] AS vin, nullif(f[6], 'null') AS condition,
              try_cast(f[7] AS BIGINT) AS year, f[8] AS make, f[9] AS model, f[10] AS trim,
              nullif(f[11], 'null') AS body_style, split_part(nullif(f[12], 'null'), ' ', 1) AS cab_style,
              f[12] <> 'null' AND strpos(f[12], ' ') = 0 AS bad_cab,
              try_cast(f[13] AS DOUBLE) AS price, try_cast(f[14] AS BIGINT) AS mileage,
              f[15] = 't' AS free_carfax_report,
              coalesce(array_to_string(list_sort(list_filter(string_split(f[16], ':'), lambda x: x <> 'null')), ':'), '')
                AS features
       FROM fields),
     checked AS (
       SELECT *, CASE WHEN n_fields < 15 THEN 'too few fields'
                      WHEN event_type NOT IN ({_quoted([t.upper() for t in inputs.TYPES])}) THEN 'unknown event type'
                      WHEN bad_cab THEN 'cab style without a space'
                      WHEN price IS NULL THEN 'price is not a number' END AS reason
       FROM events)"""


EVENT_FIELDS = (
    "user_id, event_type, event_subtype, event_time, city, vin, condition, year, make, model, trim, body_style, "
    "cab_style, price, mileage, free_carfax_report, features"
)
ORDER_FIELDS = (
    "event_time, event_type, event_subtype, city, vin, condition, year, make, model, trim, body_style, "
    "cab_style, price, mileage, free_carfax_report, features"
)
NULLS_FIRST = ", ".join(f"{c} NULLS FIRST" for c in ORDER_FIELDS.split(", "))


def _distinct_events(log: str) -> str:
    return f"{_parsed(inputs.lines(log))}, ev AS (SELECT DISTINCT {EVENT_FIELDS} FROM checked WHERE reason IS NULL)"


def _shown(kind: str, subtype: str, time: str) -> str:
    return f"concat('<', {kind}, ':', {subtype}, ',', {time}, ',', vin, '>')"


_EVENT_TEXT = _shown("event_type", "event_subtype", "event_time")
_PLACED = f"""placed AS (
       SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {NULLS_FIRST}) - 1 AS pos,
              count(*) OVER (PARTITION BY user_id) AS n_all FROM ev)"""
_EVENT_LIST = f"concat('[', string_agg({_EVENT_TEXT}, ', ' ORDER BY pos), ']') AS events"

SESSIONIZE = f"{_distinct_events(inputs.RESENT_LOG)}, {_PLACED} SELECT {EVENT_FIELDS}, pos FROM placed"
SESSION_LISTS = f"""{_distinct_events(inputs.RESENT_LOG)}, {_PLACED}
SELECT user_id, pos // {PAGE} AS page, count(*) AS n_events, {_EVENT_LIST} FROM placed GROUP BY 1, 2"""
SESSION_LISTS_PAGED = f"""{_distinct_events(inputs.RESENT_LOG)}, {_PLACED}
SELECT user_id, n_all, pos // {SMALL_PAGE} AS page, count(*) AS n_events, {_EVENT_LIST} FROM placed GROUP BY 1, 2, 3"""
SMALL_SESSIONS = f"""{_distinct_events(inputs.LOG)}, {_PLACED}
SELECT user_id, count(*) AS n_events, {_EVENT_LIST} FROM placed WHERE n_all <= 100 GROUP BY 1"""


def _label(contact_form: bool) -> str:
    submits = "event_type IN ('CHANGE', 'EDIT', 'SUBMIT')"
    if contact_form:
        submits += " AND event_subtype = 'CONTACT_FORM'"
    return (
        f"CASE WHEN {submits} THEN 'submitter' WHEN event_type = 'CLICK' THEN 'clicker' "
        "WHEN event_type IN ('SHOW', 'DISPLAY') THEN 'shower' WHEN event_type = 'VISIT' THEN 'visitor' ELSE 'other' END"
    )


def _labels(log: str, contact_form: bool) -> str:
    return f"""{_distinct_events(log)},
     sized AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n_events FROM ev),
     labels AS (SELECT DISTINCT user_id, n_events, {_label(contact_form)} AS session_type FROM sized)"""


def _draw(*keys: str) -> str:
    return f"CAST(concat('0x', substr(md5(concat_ws(':', '42', {', '.join(keys)})), 1, 8)) AS BIGINT) / 4294967296.0"


_KEPT = f"""CASE session_type WHEN 'clicker' THEN {_draw('session_type', 'user_id')} < 0.1
                              WHEN 'shower' THEN {_draw('session_type', 'user_id')} < 0.02 ELSE true END"""

LABELS_CONTACT_FORM = f"{_labels(inputs.ORDER_LOG, True)} SELECT * FROM labels WHERE n_events <= 100"
LABELS = f"{_labels(inputs.LOG, False)} SELECT * FROM labels WHERE n_events <= 100"
LABELS_SAMPLED = f"{LABELS_CONTACT_FORM} AND {_KEPT}"
SESSION_BINS = f"""{_labels(inputs.ORDER_LOG, False)}, {_PLACED},
     lists AS (SELECT user_id, {_EVENT_LIST} FROM placed GROUP BY user_id)
SELECT session_type, user_id, n_events, events FROM labels JOIN lists USING (user_id) WHERE n_events <= 100"""

FILTER_METRICS = f"""{_labels(inputs.LOG, True)}
SELECT 'large_discarded' AS metric, count(DISTINCT user_id) AS value FROM labels WHERE n_events > 100
UNION ALL
SELECT concat(session_type, CASE WHEN {_KEPT} THEN '_written' ELSE '_discarded' END), count(*)
FROM labels WHERE n_events <= 100 GROUP BY 1"""


def _raw(lines: str) -> str:
    return f"""
WITH fields AS (SELECT string_split(line, chr(9)) AS f FROM ({_in(lines)})),
     raw AS (SELECT f[1] AS user_id, f[4] AS city, split_part(f[2], ' ', 1) AS event_type,
                    substr(f[2], strpos(f[2], ' ') + 1) AS event_subtype, f[3] AS event_time, f[5] AS vin FROM fields),
     labelled AS (
       SELECT user_id, city, count(*) AS n_events,
              CASE WHEN bool_or(lower(event_type) IN ('show', 'display'))
                    AND NOT bool_or(lower(event_type) = 'click' OR lower(event_subtype) = 'contact form')
                   THEN 'shower' ELSE 'other' END AS session_type
       FROM raw GROUP BY user_id, city),
     drawn AS (SELECT *, session_type <> 'shower' OR {_draw('user_id', 'city')} <= 0.1 AS kept FROM labelled)"""


_ORDER_RAW = _raw(inputs.lines(inputs.ORDER_LOG))
_TWO_LOGS = f"{inputs.lines(inputs.RESENT_LOG)} UNION ALL {inputs.STREAM_LINES}"
SHOWER_FILTER = f"{_ORDER_RAW} SELECT user_id, city, n_events, session_type FROM drawn WHERE kept"
SESSION_METRICS = f"""{_ORDER_RAW}
SELECT 'events_before' AS metric, CAST(sum(n_events) AS BIGINT) AS value FROM drawn
UNION ALL SELECT 'events_after', CAST(sum(n_events) AS BIGINT) FROM drawn WHERE kept
UNION ALL SELECT 'sessions', count(*) FROM drawn WHERE kept
UNION ALL SELECT 'shower_sessions', count(*) FROM drawn WHERE session_type = 'shower'
UNION ALL SELECT 'shower_sessions_dropped', count(*) FROM drawn WHERE NOT kept"""


def _user_city(page: int) -> str:
    return f"""{_raw(_TWO_LOGS)},
     placed AS (
       SELECT raw.*, row_number() OVER (PARTITION BY user_id, city
                ORDER BY event_time, event_type, event_subtype, vin) - 1 AS pos
       FROM raw JOIN drawn USING (user_id, city) WHERE kept)
SELECT user_id, city, pos // {page} AS page, count(*) AS n_events, {_EVENT_LIST} FROM placed GROUP BY 1, 2, 3"""


_RAW_REASON = """CASE WHEN len(string_split(line, chr(9))) < 5 THEN 'fewer than five fields'
                      WHEN NOT contains(split_part(line, chr(9), 2), ' ') THEN 'event without a subtype' END"""
_FAULTY_RAW = f"(SELECT line, {_RAW_REASON} AS reason FROM ({_in(inputs.FAULTY_RAW_LINES)}))"
RAW_EVENT_REJECTS = f"SELECT line, reason FROM {_FAULTY_RAW} WHERE reason IS NOT NULL"
RAW_EVENTS = f"""
SELECT f[1] AS user_id, f[4] AS city, split_part(f[2], ' ', 1) AS event_type,
       substr(f[2], strpos(f[2], ' ') + 1) AS event_subtype, f[3] AS event_time, f[5] AS vin
FROM (SELECT string_split(line, chr(9)) AS f FROM {_FAULTY_RAW} WHERE reason IS NULL)"""

# ---- vehicles

_VIN = f"""{_distinct_events(inputs.LOG)},
     users AS (SELECT vin, count(DISTINCT user_id) AS unique_users,
                      count(DISTINCT CASE WHEN event_type = 'EDIT' AND event_subtype = 'CONTACT_FORM' THEN user_id END)
                        AS edit_contact_form
               FROM ev GROUP BY vin),
     clicks AS (SELECT vin, event_subtype, count(DISTINCT user_id) AS sessions FROM ev
                WHERE event_type = 'CLICK' GROUP BY vin, event_subtype)"""
_IMPRESSIONS = f"""
SELECT vin, CAST(sum(CASE WHEN impression_type = 'SRP' THEN cnt ELSE 0 END) AS BIGINT) AS marketplace_srps,
       CAST(sum(CASE WHEN impression_type = 'VDP' THEN cnt ELSE 0 END) AS BIGINT) AS marketplace_vdps
FROM ({_in(inputs.IMPRESSIONS)}) GROUP BY vin"""
VIN_JOIN = f"""{_VIN},
     totals AS ({_IMPRESSIONS}),
     maps AS (SELECT vin, string_agg(concat(event_subtype, '=', CAST(sessions AS STRING)), ',' ORDER BY event_subtype)
                AS clicks FROM clicks GROUP BY vin)
SELECT vin, unique_users, edit_contact_form, coalesce(clicks, '') AS clicks,
       coalesce(marketplace_srps, 0) AS marketplace_srps, coalesce(marketplace_vdps, 0) AS marketplace_vdps
FROM users LEFT JOIN maps USING (vin) LEFT JOIN totals USING (vin)"""

# ---- statistics


def _subtype_statistics(log: str, contact_form: bool, extra: str = "") -> str:
    return f"""{_labels(log, contact_form)},
     small AS (SELECT * FROM labels WHERE n_events <= 100 AND session_type <> 'other'),
     counts AS (SELECT user_id, coalesce(event_subtype, 'any') AS event_subtype, count(*) AS x FROM ev
                GROUP BY GROUPING SETS ((user_id, event_subtype), (user_id))),
     symbols AS (SELECT unnest([{_quoted([*SUBTYPES, 'any'])}]) AS event_subtype),
     filled AS (SELECT session_type, s.event_subtype, coalesce(x, 0) AS x
                FROM small CROSS JOIN symbols s
                LEFT JOIN counts c ON c.user_id = small.user_id AND c.event_subtype = s.event_subtype),
     every AS (SELECT * FROM filled {extra}),
     sums AS (SELECT session_type, event_subtype, count(*) AS session_count, CAST(sum(x) AS BIGINT) AS total_count,
                     CAST(sum(x * x) AS BIGINT) AS sum_of_squares FROM every GROUP BY 1, 2)
SELECT *, CAST(total_count AS DOUBLE) / session_count AS mean,
       CAST(sum_of_squares AS DOUBLE) / session_count
         - (CAST(total_count AS DOUBLE) / session_count) * (CAST(total_count AS DOUBLE) / session_count) AS variance
FROM sums"""


_LOG = _in(inputs.LOG)
PRICE = f"""
SELECT make, model, CAST(min(p) AS DOUBLE) AS min, CAST(max(p) AS DOUBLE) AS max,
       CAST(sum(p) AS DOUBLE) / count(*) AS avg
FROM (SELECT DISTINCT make, model, try_cast(price AS DECIMAL(18, 4)) AS p FROM ({_LOG})) WHERE p <> 0
GROUP BY make, model"""
MILEAGE = f"""
SELECT year, min(m) AS min, max(m) AS max, avg(m) AS avg
FROM (SELECT DISTINCT year, CAST(mileage AS INT) AS m FROM ({_LOG}) WHERE CAST(mileage AS INT) <> 0)
GROUP BY year"""
EVENT_STATISTICS = f"""
SELECT vin, split_part(event, ' ', 1) AS action, count(*) AS occurrences FROM ({_LOG}) GROUP BY 1, 2"""
FIELD_VALUES = (
    f"WITH log AS ({_LOG}) SELECT field_value, count(*) AS count FROM ("
    + " UNION ALL ".join(
        f"SELECT concat('{shown}:', {column}) AS field_value FROM log"
        for shown, column in [("event_type", "event")]
        + [
            (c, c)
            for c in ("city", "vehicle_condition", "year", "make", "model", "trim", "body_style", "cab_style",
                      "free_carfax_report")
        ]
    )
    + " UNION ALL SELECT concat('features:', part) FROM (SELECT unnest(string_split(features, ':')) AS part FROM log)"
    + ") GROUP BY field_value"
)

ORACLES = {
    "word_count": WORD_COUNT,
    "word_count_sorted": WORD_COUNT,
    "word_count_lines": f"SELECT concat(word, chr(9), count) AS value FROM ({WORD_COUNT})",
    "word_count_pairs": f"SELECT concat('(', word, ',', count, ')') AS value FROM ({WORD_COUNT})",
    "word_count_metrics": WORD_COUNT_METRICS,
    "word_statistics": _word_stats(NORM, "n AS doc_count, s AS word_freq, q AS word_freq_squared"),
    "word_statistics_minmax": _word_stats(
        "lower(text)", "n AS document_count, s AS total_count, lo AS min, hi AS max, q AS sum_of_squares"
    ),
    "email_references": f"{EMAIL} SELECT * FROM refs",
    "email_index": EMAIL_INDEX,
    "verse_index": VERSE_INDEX,
    "verse_index_by_refs": VERSE_INDEX_BY_REFS,
    "parse_session_log": f"{_parsed(inputs.FAULTY_LINES)} SELECT {EVENT_FIELDS} FROM checked WHERE reason IS NULL",
    "session_log_rejects": f"{_parsed(inputs.FAULTY_LINES)} SELECT line, reason FROM checked WHERE reason IS NOT NULL",
    "field_value_counts": FIELD_VALUES,
    "sessionize": SESSIONIZE,
    "session_lists": SESSION_LISTS,
    "small_sessions": SMALL_SESSIONS,
    "session_labels_contact_form": LABELS_CONTACT_FORM,
    "session_labels": LABELS,
    "session_labels_sampled": LABELS_SAMPLED,
    "session_bins": SESSION_BINS,
    "shower_filter": SHOWER_FILTER,
    "user_city_sessions": _user_city(PAGE),
    "user_city_sessions_paged": _user_city(SMALL_PAGE),
    "raw_event_rejects": RAW_EVENT_REJECTS,
    "raw_events": RAW_EVENTS,
    "session_lists_paged": SESSION_LISTS_PAGED,
    "verse_rejects": VERSE_REJECTS,
    "verse_index_text_words": VERSE_INDEX_TEXT_WORDS,
    "email_rejects": EMAIL_REJECTS,
    "email_index_faulty": _email_index(FAULTY_EMAIL, SMALL_PAGE),
    "session_metrics": SESSION_METRICS,
    "filter_metrics": FILTER_METRICS,
    "vin_user_metrics": f"{_VIN} SELECT * FROM users",
    "vin_clicks": f"{_VIN} SELECT * FROM clicks",
    "vin_impressions": _IMPRESSIONS,
    "vin_join": VIN_JOIN,
    "subtype_statistics": _subtype_statistics(inputs.LOG, False),
    "subtype_statistics_all": _subtype_statistics(
        inputs.ORDER_LOG, True, "UNION ALL SELECT 'any', event_subtype, x FROM filled"
    ),
    "price_statistics": PRICE,
    "mileage_statistics": MILEAGE,
    "event_statistics": EVENT_STATISTICS,
}
