"""Word count and per-word statistics. A document is one input row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions.stats import mean, variance
from clickmill.functions.text import tokenize_norm, tokenize_ws

Tokenizer = Callable[[Column], Column]


def word_count(df: DataFrame, text: str, tokenizer: Tokenizer = tokenize_ws, ordered: bool = False) -> DataFrame:
    """word, count. ``ordered`` sorts the whole result by word."""
    words = df.select(F.explode(tokenizer(F.col(text))).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy("word") if ordered else counted


def word_count_metrics(df: DataFrame, text: str, tokenizer: Tokenizer = tokenize_ws) -> DataFrame:
    """metric, value: the number of input rows and of words in them."""
    totals = df.agg(
        F.count(F.lit(1)).alias("input_lines"),
        F.coalesce(F.sum(F.size(F.coalesce(tokenizer(F.col(text)), F.array()))), F.lit(0)).alias("words_out"),
    )
    return totals.unpivot([], ["input_lines", "words_out"], "metric", "value")


def term_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """word, freq: one row per distinct word of each input row.

    Counted inside the row by sorting its tokens and measuring the runs, so the exploded corpus is never
    shuffled by (document, word); only per-word partial sums leave the map side afterwards.
    """
    ordered = df.select(F.sort_array(tokens).alias("tokens"))
    run_starts = F.transform(
        "tokens", lambda word, i: F.when(~word.eqNullSafe(F.get("tokens", i - 1)), i)
    )
    runs = ordered.select("tokens", F.array_compact(run_starts).alias("starts"))
    run = F.transform(
        "starts",
        lambda start, i: F.struct(
            F.get("tokens", start).alias("word"),
            (F.coalesce(F.get("starts", i + 1), F.size("tokens")) - start).cast("bigint").alias("freq"),
        ),
    )
    return runs.select(F.inline(run))


def word_statistics(
    df: DataFrame, text: str, tokenizer: Tokenizer = tokenize_norm, min_max: bool = False
) -> DataFrame:
    """Per word: documents, total, sum of squared per-document counts, mean and variance.

    ``min_max`` adds the smallest and largest per-document count and uses the column names of that variant.
    """
    freq = F.col("freq")
    counted = term_counts(df, tokenizer(F.col(text))).groupBy("word").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(freq).alias("total"),
        F.sum(freq * freq).alias("squares"),
        F.min(freq).alias("min"),
        F.max(freq).alias("max"),
    )
    docs, total, squares = F.col("docs"), F.col("total"), F.col("squares")
    derived = [mean(total, docs).alias("mean"), variance(total, squares, docs).alias("variance")]
    if min_max:
        return counted.select(
            "word",
            docs.alias("document_count"),
            total.alias("total_count"),
            "min",
            "max",
            squares.alias("sum_of_squares"),
            *derived,
        )
    return counted.select(
        "word", docs.alias("doc_count"), total.alias("word_freq"), squares.alias("word_freq_squared"), *derived
    )
