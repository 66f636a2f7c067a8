"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, of pairs of neighbouring words and of pairs with one word between, hashed to a fixed
number of weights. FTRL-proximal has a learning rate per coordinate and an L1 term that keeps most weights at exactly
zero, so that the model is a short list of weights. Shards of the labelled rows are trained independently and their
weights averaged.

The model is fitted on a sample of about TRAIN_ROWS texts with a label: those of the TRAIN_ROWS labelled doc_ids with the
smallest hashes, and of their different texts, should some ids have many, a share by hash that leaves TRAIN_ROWS. The order of
training follows hashes of doc_id and text, so it is the same in every run. Every row is scored over its whole text.

Defined results: rows whose label is null teach nothing, several labels of one doc_id count as toxic if one does; different
texts of one doc_id teach each by itself, equal ones once; a null
or empty text has no features and gets the score of the intercept; a null doc_id is held out; without any labelled row
all scores are 0.5 (and predicted 1) as nothing is known; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import CACHE_WORDS, hashes, mixed, sampled
from clickmill.llm.tokens import portions, text_bytes

WEIGHT_BITS = 18
TRAIN_ROWS = 20_000
SHARD_ROWS = 4_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.1
FOLDS = 5

_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class PlainWordHash(dict):
    """Hashes of words without case and without the signs around them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.lower().strip(_EDGES))
        return value


_WORDS = PlainWordHash()


def features(text: bytes, bits: int = WEIGHT_BITS) -> np.ndarray:
    """Weight numbers of a text, with repetitions; 0 is left to the intercept."""
    words = hashes(text.split(), _WORDS)
    pairs = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    skips = mixed(words[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + words[2:] + np.uint64(1))
    found = np.concatenate([mixed(words), pairs, skips])
    return ((found >> np.uint64(64 - bits)).astype(np.int64)) | 1


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod FOLDS, is 0; a null id has no label to learn from and is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fitted(rows: list[np.ndarray], labels: np.ndarray, bits: int = WEIGHT_BITS, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal over the rows in the given order; the intercept has no L1 term."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    l1 = np.full(1 << bits, L1)
    l1[0] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * l1[at] - z[at]
        return np.where(np.abs(z[at]) <= l1[at], 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += gradient * gradient
    return weights(np.arange(1 << bits))


def _shard_weights(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["place", "doc_id", "digest"], kind="stable")
    rows = [np.unique(np.append(features((text or "").encode()), 0)) for text in frame["text"]]
    weights = fitted(rows, frame["toxic"].to_numpy(float))
    at = np.flatnonzero(weights)
    return pd.DataFrame({"at": at.astype(np.int64), "weight": weights[at]})


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[DataFrame, int]:
    """doc_id, digest, place, toxic, text, draw of about ``rows`` labelled texts outside of the held-out fold, and their number."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = sampled(known, rows, "doc_id")
    # At most ``rows`` pairs of numbers, so the chosen labels fit a broadcast whatever the size of the table.
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    hashed = texts.withColumns({"place": F.xxhash64("doc_id"), "digest": F.xxhash64(F.coalesce("text", F.lit("")))})
    distinct = hashed.groupBy("doc_id", "digest").agg(*[F.first(c).alias(c) for c in ("place", "toxic", "text")])
    # The number of rows, not of labels, bounds what is learnt from: a doc_id may have any number of texts.
    number = hashed.select("doc_id", "digest").distinct().count()
    draw = F.xxhash64("digest", "doc_id")
    if number > rows:
        distinct = distinct.filter(draw.cast("double") < F.lit((2 * rows / number - 1) * 2.0**63))
    return distinct.withColumn("draw", draw), min(rows, number)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, shard_rows: int = SHARD_ROWS) -> dict[int, float]:
    """The non-zero weights, learnt from ``training_rows`` in shards of about ``shard_rows``."""
    taught, number = training_rows(docs, labels, rows)
    shards = max(1, -(-number // shard_rows))
    dealt = taught.withColumn("shard", F.pmod("draw", F.lit(shards)))
    learnt = dealt.groupBy("shard").applyInPandas(_shard_weights, "at bigint, weight double")
    mean = learnt.groupBy("at").agg((F.sum("weight") / shards).alias("weight"))
    return {row["at"]: row["weight"] for row in mean.collect()}


def _scored(weights: dict[int, float], bits: int):
    at, values = np.array(list(weights), np.int64), np.array(list(weights.values()), float)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits)
        table[at] = values
        used = table != 0
        for batch in portions(batches):
            scores = []
            for text in text_bytes(batch.column(1)):
                found = features(text, bits)
                total = table[np.unique(found[used[found]])].sum() + table[0]
                scores.append(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of doc_id, text."""
    weights = train(docs, labels, rows)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    scored = texts.mapInArrow(_scored(weights, WEIGHT_BITS), "doc_id bigint, score double")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
