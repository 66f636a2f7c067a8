"""Inputs derived from the given tables, as SQL text that Spark and DuckDB both run.

Every text reads whole tables. ``{orders}`` and the like stand for the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.sources.readers import spread

TYPES = ("change", "click", "display", "edit", "show", "submit", "visit")
SUBTYPES = (
    "alternative", "badges", "badge detail", "contact banner", "contact button", "contact form",
    "dealer phone", "features", "get directions", "market report", "photo modal", "vehicle history",
)


def pick(number: str, values: tuple[str, ...]) -> str:
    """CASE that names the value for 0, 1, 2, ..."""
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


EVENT = (
    "concat("
    + pick("(l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 7", TYPES)
    + ", ' ', "
    + pick("(l_partkey + l_linenumber) % 12", SUBTYPES)
    + ")"
)


def _log(user: str) -> str:
    return f"""
SELECT {user} AS user_id,
       {EVENT} AS event,
       CAST(o_orderdate AS STRING) AS event_timestamp,
       concat('city', CAST(o_custkey % 20 AS STRING)) AS city,
       concat('V', CAST(l_partkey AS STRING)) AS vin,
       {pick("l_partkey % 3", ("New", "Used", "CPO"))} AS vehicle_condition,
       CAST(1990 + p_size % 30 AS STRING) AS year,
       p_brand AS make,
       p_type AS model,
       CASE WHEN p_size % 5 = 0 THEN 'null' ELSE concat('trim', CAST(p_size % 5 AS STRING)) END AS trim,
       {pick("p_size % 4", ("SUV", "Sedan", "Coupe", "null"))} AS body_style,
       {pick("p_size % 3", ("Crew Cab", "Regular Cab", "null"))} AS cab_style,
       CASE l_partkey % 10 WHEN 0 THEN '0.0' WHEN 1 THEN '950' WHEN 2 THEN '950.0'
            ELSE CAST(p_retailprice AS STRING) END AS price,
       CAST(l_partkey * 7 % 1000 * CAST(l_quantity AS BIGINT) AS STRING) AS mileage,
       CASE WHEN l_discount > 0.05 THEN 't' ELSE 'f' END AS free_carfax_report,
       {pick("p_size % 4", ("Sunroof:ABS:Radio", "null", "GPS", "Radio:GPS"))} AS features
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey
"""


# The session log, one event per line item: by customer pair (long sessions) and by order (short sessions).
LOG = _log("concat('u', CAST(CAST(floor(o_custkey / 2) AS BIGINT) AS STRING))")
ORDER_LOG = _log("concat('o', CAST(l_orderkey AS STRING))")

FIELDS = (
    "user_id, event, event_timestamp, city, vin, vehicle_condition, year, make, model, trim, body_style, "
    "cab_style, price, mileage, free_carfax_report, features"
)


def lines(log: str) -> str:
    """The log as tab-separated text."""
    return f"SELECT concat_ws(chr(9), {FIELDS}) AS line FROM ({log}) AS l"


# Some lines sent a second time, for the removal of duplicates.
RESENT_LOG = f"{LOG} UNION ALL SELECT * FROM ({LOG}) AS again WHERE free_carfax_report = 't'"

# The log once, with a mark on the lines that RESENT_LOG holds a second time; ``resent_lines`` makes its lines of it.
MARKED_LINES = f"SELECT concat_ws(chr(9), {FIELDS}) AS line, free_carfax_report = 't' AS again FROM ({LOG}) AS l"

# Lines with faults: some prices are words, some cab styles have no space, some types are unknown, some are cut.
FAULTY_LINES = f"""
SELECT concat_ws(chr(9), user_id, CASE WHEN year = '1999' THEN concat('un', event) ELSE event END,
       event_timestamp, city, vin, vehicle_condition, year, make, model, trim, body_style,
       CASE WHEN city = 'city3' THEN 'Crew' ELSE cab_style END,
       CASE WHEN city = 'city5' THEN 'call' ELSE price END,
       CASE WHEN city = 'city7' THEN NULL ELSE mileage END,
       CASE WHEN city = 'city7' THEN NULL ELSE free_carfax_report END,
       CASE WHEN city = 'city7' THEN NULL ELSE features END) AS line
FROM ({LOG}) AS l
"""

# Lines with faults, of which the first five fields are read.
FAULTY_RAW_LINES = f"""
SELECT CASE WHEN line LIKE '%city3%' THEN replace(line, ' ', '') WHEN line LIKE '%city5%' THEN split_part(line, chr(9), 2)
            ELSE line END AS line
FROM ({lines(LOG)}) AS l
"""

# A second log, from the event stream; only the first five fields are filled.
STREAM_LINES = """
SELECT concat_ws(chr(9), concat('u', CAST(user_id AS STRING)),
       concat(CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'show' WHEN 'purchase' THEN 'submit'
                   WHEN 'signup' THEN 'visit' ELSE 'change' END, ' ',
              """ + pick("event_id % 12", SUBTYPES) + """),
       CAST(ts AS STRING), concat('city', CAST(user_id % 20 AS STRING)),
       concat('V', CAST(CAST(floor(value) AS BIGINT) AS STRING))) AS line
FROM {events}
"""

MAIL = """
SELECT concat('Message-ID: <', CAST(o_orderkey AS STRING), '@m> Date: x From: c', CAST(o_custkey % 97 AS STRING),
       '@a.com ', CASE WHEN o_orderkey % 4 = 0 THEN 'to: ' ELSE 'To: ' END, 'c', CAST(o_custkey % 89 AS STRING),
       '@b.com, c', CAST(o_orderkey % 83 AS STRING), '@b.com ',
       CASE WHEN o_orderkey % 3 = 0 THEN concat('Cc: c', CAST(o_orderkey % 7 AS STRING), '@c.com ') ELSE '' END,
       'Subject: re x', CASE WHEN o_orderkey % 50 = 0 THEN '@y' ELSE '' END, ' X-From: c1@never.com') AS line
FROM {orders}
"""

# Mails whose id header is the last token (some of them past the end mark), and mails with addresses before or without an id.
FAULTY_MAIL = f"""
SELECT CASE WHEN m % 7 = 0 THEN concat('To: a@x.com ', line, ' Message-ID:')
            WHEN m % 11 = 0 THEN replace(line, 'X-From: c1@never.com', 'message-id:')
            WHEN m % 5 = 0 THEN concat('Bcc: early', CAST(m % 13 AS STRING), '@e.com ', line)
            WHEN m % 3 = 0 THEN replace(line, 'Message-ID:', 'Id:') ELSE line END AS line
FROM (SELECT line, CAST(substr(split_part(line, '@', 1), 14) AS BIGINT) AS m FROM ({MAIL}) AS mails) AS numbered
"""

VERSES = """
SELECT concat('book', chr(CAST(97 + doc_id % 5 AS INT)), ':', CAST(1 + doc_id % 50 AS STRING), ':',
              CAST(doc_id AS STRING), ' ', text) AS line
FROM {documents}
"""

# Some ids are cut, some numbers are words, and some have more parts.
FAULTY_VERSES = """
SELECT CASE doc_id % 6 WHEN 1 THEN concat('book:', CAST(doc_id AS STRING), ' ', text)
                       WHEN 2 THEN concat('book:one:', CAST(doc_id AS STRING), ' ', text)
                       WHEN 3 THEN concat('book:1:', CAST(doc_id AS STRING), ':9 ', text)
                       WHEN 4 THEN concat('book:1:', CAST(doc_id AS STRING)) ELSE text END AS line
FROM {documents}
"""

# Several rows per vehicle, vehicles without rows, rows of unknown vehicles and of unknown types.
IMPRESSIONS = """
SELECT concat('V', CAST(c_custkey AS STRING)) AS vin,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'SRP' WHEN 'BUILDING' THEN 'VDP' WHEN 'FURNITURE' THEN 'SRP'
                         WHEN 'HOUSEHOLD' THEN 'VDP' ELSE 'OTHER' END AS impression_type,
       CAST(c_nationkey + 1 AS BIGINT) AS cnt
FROM {customer}
UNION ALL
SELECT concat('V', CAST(o_custkey AS STRING)), CASE o_orderstatus WHEN 'F' THEN 'SRP' ELSE 'VDP' END,
       CAST(2 AS BIGINT)
FROM {orders}
UNION ALL
SELECT concat('W', CAST(s_suppkey AS STRING)), 'SRP', CAST(1 AS BIGINT) FROM {supplier}
"""

BASE_TABLES = ("customer", "documents", "events", "lineitem", "orders", "part", "supplier")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the texts above on the tables of ``sf_dir``, each dealt out by the one rule of ``spread``."""
    used = {name: spread(table(spark, sf_dir, name)) for name in BASE_TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


def resent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of RESENT_LOG, with the log's tables joined once and not a second time for the lines sent again."""
    marked = derive(spark, sf_dir, MARKED_LINES)
    times = F.when(F.col("again"), F.array(F.col("line"), F.col("line"))).otherwise(F.array(F.col("line")))
    return marked.select(F.explode(times).alias("line"))


def for_duckdb(text: str) -> str:
    """The same text over the tables by name."""
    return text.format(**{name: name for name in BASE_TABLES})
