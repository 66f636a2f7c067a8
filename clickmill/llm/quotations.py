"""Conversations without quotations, ordered by who replies to whom.

Lines that start with ``>`` signs are quoted; the number of signs is the level. Neighbouring lines of one level form a
passage. Passages are normalised (case, punctuation, white space) and hashed. A quoted passage belongs to the latest
earlier message of its conversation that holds the same passage as its own unquoted text: whole, as one block between
quotations, or as a line; a passage that is found nowhere whole is looked up by its longest line. A message replies to the
original of its least deeply quoted passage that has one, otherwise to the message before it. Messages stand in reply
order: each after the one it replies to and before that one's later replies.

Only built-in functions are used. Positions and lookups are made within ranges of sorted rows and carried on from range to
range, so that neither a long conversation nor a line that is quoted everywhere is the work of one task, and quotations
and originals are never paired.

Defined results: a null text counts as empty; rows that are equal in conv_id, turn, role and text are one message; messages
with equal conv_id and turn are ordered by role and text; null conv_ids form no conversation and are left out; null turns
and roles come first; a quoted passage without an original is dropped from the text and stays unlinked; lines of signs only
hold no passage; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import stored

_SIGNS = r"^[ \t]*((?:>[ \t]?)+)"
# The line by which mail programs introduce a quotation.
_INTRODUCTION = r"(?i)^[ \t]*(?:on\b.*\bwrote|.*\b(?:said|wrote)):[ \t]*$"


def normalised(line: Column) -> Column:
    """Lower case, letters and digits only, words separated by single blanks."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _levelled(text: Column) -> Column:
    """level and line (without its signs) of every line."""

    def parsed(line: Column) -> Column:
        signs = F.regexp_extract(line, _SIGNS, 1)
        level = F.length(F.regexp_replace(signs, "[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(line, _SIGNS, "").alias("line"))

    return F.transform(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n", -1), parsed)


def _ranged(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows stored in sorted ranges, with the number of their range."""
    return stored(rows.repartitionByRange(*by).withColumn("range", F.spark_partition_id()), "ranges")


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 1-based place of a row among those with the same keys."""
    ranged = _ranged(rows, keys + order)
    sizes = ranged.groupBy(*keys, "range").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy(*keys, "range").orderBy(*order))
    placed = ranged.withColumn(name, place).join(offsets, [*keys, "range"])
    return placed.withColumn(name, (F.col(name) + F.col("offset")).cast("bigint")).drop("range", "offset")


def latest(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the largest ``value`` among the rows with the same keys up to this one."""
    ranged = _ranged(rows, keys + order)
    tops = ranged.groupBy(*keys, "range").agg(F.max(value).alias("top"))
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*keys, "range", F.max("top").over(earlier).alias("carried"))
    until = Window.partitionBy(*keys, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = ranged.withColumn(name, F.max(value).over(until)).join(carried, [*keys, "range"])
    return within.withColumn(name, F.greatest(name, "carried")).drop("range", "carried")


def parsed_messages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, at (place in the conversation), lines; one row per message."""
    named = messages.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    distinct = named.distinct().withColumn("digest", F.md5("text"))
    placed = numbered(distinct, ["conv_id"], ["turn", "role", "digest"], "at")
    return stored(placed.select("conv_id", "turn", "role", "at", _levelled(F.col("text")).alias("lines")), "messages")


def _own_lines() -> Column:
    """The unquoted lines, without those that introduce the quotation after them."""
    following = F.concat(F.slice("lines", 2, F.size("lines")), F.array(F.lit(None)))
    marked = F.zip_with("lines", following, lambda line, after: F.struct(line.alias("line"), F.coalesce(after["level"], F.lit(0)).alias("after")))
    own = F.filter(marked, lambda m: (m["line"]["level"] == 0) & ~((m["after"] > 0) & m["line"]["line"].rlike(_INTRODUCTION)))
    return F.transform(own, lambda m: m["line"]["line"])


def passages(messages: DataFrame) -> DataFrame:
    """conv_id, at, passage, level, words (normalised lines that are not empty) of every passage."""
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get("lines", i - 1)["level"] != F.get("lines", i)["level"]))
    # Generated rather than projected, so that the starts are not found again for every passage.
    begun = messages.select("*", F.explode(F.array(starts)).alias("starts"))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("starts") - 1),
        lambda i: F.struct(F.get("starts", i).alias("start"), F.coalesce(F.get("starts", i + 1), F.size("lines")).alias("end")),
    )
    cut = begun.select("conv_id", "at", "lines", F.posexplode(spans).alias("passage", "span"))
    held = F.slice("lines", F.col("span.start") + 1, F.col("span.end") - F.col("span.start"))
    words = F.filter(F.transform(held, lambda line: normalised(line["line"])), lambda line: line != "")
    return cut.select("conv_id", "at", "passage", F.get("lines", F.col("span.start"))["level"].alias("level"), words.alias("words"))


def _hash(words: Column) -> Column:
    return F.md5(F.array_join(words, " "))


def originals(messages: DataFrame) -> DataFrame:
    """conv_id, at, passage, level, original: quoted passages, with the message they come from if there is one."""
    cut = stored(passages(messages).filter(F.size("words") > 0), "passages")
    longest = F.array_max(F.transform("words", lambda w: F.struct(F.length(w).alias("n"), w.alias("line"))))["line"]
    quoted = cut.filter("level > 0").select(
        "conv_id", "at", "passage", "level", F.explode(F.array(F.struct(F.lit(0).alias("rank"), _hash(F.col("words")).alias("key")), F.struct(F.lit(1).alias("rank"), F.md5(longest).alias("key")))).alias("look")
    ).select("conv_id", "at", "passage", "level", "look.rank", "look.key")
    own = messages.select("conv_id", "at", F.filter(F.transform(_own_lines(), normalised), lambda line: line != "").alias("words"))
    units = own.filter(F.size("words") > 0).select("conv_id", "at", _hash(F.col("words")).alias("key"))
    blocks = cut.filter("level = 0")
    units = units.unionByName(blocks.select("conv_id", "at", _hash(F.col("words")).alias("key")))
    units = units.unionByName(blocks.select("conv_id", "at", F.explode(F.transform("words", F.md5)).alias("key"))).distinct()
    units = units.join(quoted.select("conv_id", "key").distinct(), ["conv_id", "key"], "left_semi")
    none = F.lit(None).cast("int")
    # A quotation stands before the message's own text, so that no message is its own original.
    sides = quoted.withColumn("side", F.lit(0)).withColumn("found", F.lit(None).cast("bigint")).unionByName(
        units.select("conv_id", "at", none.alias("passage"), none.alias("level"), none.alias("rank"), "key", F.lit(1).alias("side"), F.col("at").alias("found"))
    )
    looked = latest(sides, ["conv_id", "key"], ["at", "side"], "found", "original").filter("side = 0")
    best = F.min(F.when(F.col("original").isNotNull(), F.struct("rank", "original")))
    return looked.groupBy("conv_id", "at", "passage", "level").agg(best["original"].alias("original"))


def _reply_order(linked: DataFrame) -> DataFrame:
    """Add ``position``. ``linked`` has conv_id, at, parent (null for the first message).

    Messages that reply to the one before them form a chain; a chain hangs on the message that its first one replies to,
    and is placed by the path of such messages. Later places come first on the way back, as a chain's end is reached
    before the replies to its earlier messages.
    """
    opens = F.when(F.col("parent").isNull() | (F.col("parent") != F.col("at") - 1), F.col("at"))
    chained = stored(latest(linked.withColumn("opens", opens), ["conv_id"], ["at"], "opens", "chain").drop("opens"), "chains")
    step = F.struct((-F.col("parent")).alias("hung"), F.col("chain").alias("chain"))
    heads = chained.filter("at = chain").select("conv_id", "chain", "parent", F.when(F.col("parent").isNotNull(), F.array(step)).alias("path"))
    above = chained.select("conv_id", F.col("at").alias("parent"), F.col("chain").alias("above"))
    empty = F.array().cast("array<struct<hung:bigint,chain:bigint>>")
    paths = stored(heads.join(above, ["conv_id", "parent"], "left").select("conv_id", "chain", "above", F.coalesce("path", empty).alias("path")), "paths")
    # Each round doubles the number of steps that a path has been followed upwards.
    while not paths.filter("above is not null").isEmpty():
        upper = paths.select("conv_id", F.col("chain").alias("above"), F.col("above").alias("next"), F.col("path").alias("head"))
        joined = paths.join(upper, ["conv_id", "above"], "left")
        paths = stored(joined.select("conv_id", "chain", F.col("next").alias("above"), F.concat(F.coalesce("head", empty), "path").alias("path")), "paths")
    placed = chained.join(paths.select("conv_id", "chain", "path"), ["conv_id", "chain"])
    return numbered(placed, ["conv_id"], ["path", "at"], "position").drop("chain", "path")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """conv_id, position, turn, role, text, reply_to, reply_to_turn, n_quoted, n_linked, formatted: one row per message.

    ``reply_to`` is the position of the message replied to; ``formatted`` is the message as a chat turn.
    """
    parsed = parsed_messages(messages)
    text = F.trim(F.array_join(_own_lines(), "\n"))
    own = parsed.select("conv_id", "turn", "role", "at", F.regexp_replace(text, r"^\s+|\s+$", "").alias("text"))
    if parsed.filter(F.exists("lines", lambda line: line["level"] > 0)).isEmpty():
        # Without any quotation every message replies to the one before it.
        counted = own.withColumn("position", F.col("at")).withColumn("reply_to", F.when(F.col("at") > 1, F.col("at") - 1))
        before = own.select("conv_id", (F.col("at") + 1).alias("at"), F.col("turn").alias("reply_to_turn"))
        zero = F.lit(0).cast("bigint")
        result = counted.join(before, ["conv_id", "at"], "left").withColumn("n_quoted", zero).withColumn("n_linked", zero)
    else:
        quoted = stored(originals(parsed), "originals")
        parent = F.min(F.when(F.col("original").isNotNull(), F.struct("level", "passage", "original")))
        found = quoted.groupBy("conv_id", "at").agg(
            parent["original"].alias("original"), F.count(F.lit(1)).alias("n_quoted"), F.count("original").alias("n_linked")
        )
        linked = own.join(found, ["conv_id", "at"], "left")
        linked = linked.withColumn("parent", F.coalesce("original", F.when(F.col("at") > 1, F.col("at") - 1)))
        ordered = stored(_reply_order(linked.drop("original")), "ordered")
        parents = ordered.select("conv_id", F.col("at").alias("parent"), F.col("position").alias("reply_to"), F.col("turn").alias("reply_to_turn"))
        result = ordered.join(parents, ["conv_id", "parent"], "left")
        for name in ("n_quoted", "n_linked"):
            result = result.withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    return result.select(
        "conv_id", "position", "turn", "role", "text", "reply_to", "reply_to_turn", "n_quoted", "n_linked", formatted.alias("formatted")
    )
