"""Secrets: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Two models of character pairs are trained from labelled samples: the values that the fixed patterns find in a bounded
sample of the documents are random strings; the other long words of the same documents, and their words joined as programs
join them, are identifiers. In each run of key characters the stretches are sought whose log-likelihood ratio, less LEAST_MEAN
a character and summed over the pairs, reaches LEAST_TOTAL: a longer one needs less per character, and readable words beside
a key do not hide it. A stretch is widened to the separators around it (/ + _ = -). It is a secret if it is long enough and
has letters, and digits or LEAST_DISTINCT different characters (lines of signs have neither).

Defined results: a null text counts as empty and has no spans; repeated rows get equal results; a null doc_id stays null;
an empty table gives no rows; further columns are ignored. Spans are in code points of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import sampled
from clickmill.llm.spans import Span, free_of, joined, sha256
from clickmill.llm.tokens import portions

KINDS = ("assign", "access", "hex", "random")
# The patterns and least lengths of the base kinds.
_ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{16,}+")
LEAST_VALUE, LEAST_ACCESS = 12, 18

SAMPLE_DOCS = 4_000
LEAST_CANDIDATE = 16
LEAST_RATIO = 1.5  # nats per character, of a whole string
# Nats per character that any stretch must exceed, and by how much in total: no more than 20 characters of LEAST_RATIO have.
LEAST_MEAN, LEAST_TOTAL = 1.0, 9.5
LEAST_STRETCH = 12  # characters of a stretch in a string that is below LEAST_RATIO as a whole
LEAST_DISTINCT = 8
LEAST_WORD = 8
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Pseudo-counts: the random model starts close to even, the identifier model trusts what it has seen.
EVEN_RANDOM, EVEN_WORDS = 20.0, 0.5

_CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{%d,}+" % LEAST_CANDIDATE)
_SEPARATORS = "+/_=-"
_WORD = re.compile("[A-Za-z0-9+/_=-]{%d,}+" % LEAST_WORD)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; those that fail a length are dropped."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


_KEY_CHARACTERS = frozenset(CHARACTERS)
_CODES = np.full(128, -1, np.int64)
_CODES[[ord(c) for c in CHARACTERS]] = np.arange(len(CHARACTERS))
_SIZE = len(CHARACTERS)


def _pairs(word: str) -> np.ndarray:
    """Numbers of the neighbouring pairs of characters."""
    codes = _CODES[np.frombuffer(word.encode("ascii"), np.uint8)]
    return codes[:-1] * _SIZE + codes[1:]


def _joined_words(text: str) -> list[str]:
    """The words of a text as identifiers are made of words: capitals inside, underscores, hyphens, all capitals, some numbers."""
    words = [f"{word}{at % 100}" if at % 3 == 2 else word for at, word in enumerate(re.findall("[A-Za-z]{2,}", text))]
    return ["".join(word.capitalize() for word in words), "_".join(words), "-".join(words).lower(), "_".join(words).upper()]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, pair, n of the labelled strings of the sampled texts."""
    counts = np.zeros((2, _SIZE * _SIZE), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            base = base_spans(text)
            for kind, start, end in base:
                value = _ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
                value = "".join(c for c in value if c in _KEY_CHARACTERS)
                np.add.at(counts[1], _pairs(value), 1)
            words = [("word", m.start(), m.end()) for m in _WORD.finditer(text)]
            for _, start, end in free_of(words, base) if base else words:
                np.add.at(counts[0], _pairs(text[start:end]), 1)
            for word in _joined_words(text):
                np.add.at(counts[0], _pairs(word), 1)
    label, pair = np.nonzero(counts)
    columns = [pa.array(label), pa.array(pair), pa.array(counts[label, pair])]
    yield pa.RecordBatch.from_arrays(columns, ["label", "pair", "n"])


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratio, random to identifier, per pair of characters; learnt from at most ``sample`` documents."""
    chosen = sampled(docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")), sample, "doc_id")
    counted = chosen.select("text").mapInArrow(_pair_counts, "label bigint, pair bigint, n bigint")
    counts = np.zeros((2, _SIZE * _SIZE))
    for row in counted.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        counts[row["label"], row["pair"]] = row["n"]

    def log_model(seen: np.ndarray, even: float) -> np.ndarray:
        table = seen.reshape(_SIZE, _SIZE) + even
        return np.log(table / table.sum(axis=1, keepdims=True)).ravel()

    return log_model(counts[1], EVEN_RANDOM) - log_model(counts[0], EVEN_WORDS)


def ratio(word: str, model: np.ndarray) -> float:
    return float(model[_pairs(word)].mean()) if len(word) > 1 else 0.0


def stretches(scores: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of characters whose pairs sum up to LEAST_TOTAL, from their lowest to their highest running sum.

    One ends where the sum has lost as much again, or all of it.
    """
    total = np.append(0.0, np.cumsum(scores))
    if len(scores) == 0 or (total - np.minimum.accumulate(total)).max() < LEAST_TOTAL:
        return
    total = total.tolist()
    low = high = at = 0
    while at < len(total):
        if total[at] > total[high]:
            high = at
        gain = total[high] - total[low]
        if at == len(total) - 1 or total[at] <= total[low] or total[high] - total[at] >= LEAST_TOTAL:
            if gain >= LEAST_TOTAL:
                yield low, high + 1
                at = high
            low = high = at
        at += 1


def _key_like(key: str) -> bool:
    various = any(c.isdigit() for c in key) or len(set(key)) >= LEAST_DISTINCT
    return len(key) >= LEAST_CANDIDATE and various and any(c.isalpha() for c in key)


def random_spans(text: str, model: np.ndarray) -> Iterator[Span]:
    """The secrets in each run of key characters: widened stretches, or the whole run if it is random only as a whole."""
    for run in _CANDIDATE.finditer(text):
        word, end, found = run[0], 0, False
        scores = model[_pairs(word)]
        for start, stop in stretches(scores - LEAST_MEAN):
            length = stop - start
            while start > end and word[start - 1] not in _SEPARATORS:
                start -= 1
            while stop < len(word) and word[stop] not in _SEPARATORS:
                stop += 1
            start, end = max(start, end), max(stop, end)
            key = word[start:end]
            if _key_like(key) and (length >= LEAST_STRETCH or ratio(key, model) >= LEAST_RATIO):
                found = True
                yield "random", run.start() + start, run.start() + end
        if not found and scores.mean() >= LEAST_RATIO and _key_like(word):
            yield "random", run.start(), run.end()


def found_spans(text: str, model: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the models add beside them."""
    base = base_spans(text)
    return base, free_of(random_spans(text, model), base)


def _scanned(model: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = found_spans(text or "", model)
                kinds = [kind for kind, _, _ in base]
                counts = [kinds.count(kind) for kind in KINDS[:3]]
                rows.append((*counts, sha256(joined(base, KINDS)), joined(base + added, KINDS)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()] * 2, strict=True)]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return scan


def secrets(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per row of doc_id, text."""
    model = train(docs, sample)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    columns = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return texts.mapInArrow(_scanned(model), columns)
