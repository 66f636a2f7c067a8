"""Best-fit packing of token sequences by length patterns.

Only the histogram of piece lengths (at most one count per length up to the capacity) reaches the driver. Patterns of a
few lengths that fill a sequence well are enumerated, the number of times each is used is fitted to the histogram by
non-negative least squares and rounded down; what is left is packed by best fit, again on counts, so that the plan's size
depends on the capacity and not on the number of documents. Each piece then finds its place by its rank among the pieces
of its length.

Defined results: a null text counts as empty (only the end id); an empty table gives no rows; repeated rows are
documents of their own; a null doc_id is kept as null; further columns are ignored. Texts of any length are cut into
pieces of the capacity, of which the first may be shorter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import stored
from clickmill.llm.tokens import encoder, portions, text_bytes

CAPACITY = 2048
# Patterns that leave more than this share of a sequence empty are not enumerated.
WASTE = 0.0
PAIR_PARTNERS = 4
TRIPLE_MIDDLES = 24
ROUNDS = 300
# Parts in which pieces of one length are numbered, so that a common length is numbered by many tasks.
RANK_PARTS = 256


def _pieces_of(path: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path, spaced=True)
        for batch in portions(batches):
            rows: list[list[int | None]] = [[], [], [], [], []]
            ids = codes.encode(text_bytes(batch.column(1)))
            for doc_id, one in zip(batch.column(0).to_pylist(), ids, strict=True):
                one += end
                total = len(one) // 4
                at, length, piece = 0, total % capacity or capacity, 0
                while at < total:
                    part = one[4 * at : 4 * (at + length)]
                    for column, value in zip(rows, (doc_id, piece, at, length, zlib.crc32(part)), strict=True):
                        column.append(value)
                    at, length, piece = at + length, capacity, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    return cut


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids with the end id, cut to the capacity."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    columns = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return texts.mapInArrow(_pieces_of(tokenizer, end_id, capacity), columns)


def length_patterns(counts: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none), longest first, that nearly fill a sequence; ``counts`` is indexed by length."""
    capacity = len(counts) - 1
    least = capacity - int(capacity * WASTE)
    present = np.flatnonzero(counts)
    found = [(length, 0, 0) for length in present if length >= least]
    for first in present[present < least]:
        rest = capacity - first
        partners = present[(present <= min(first, rest)) & (present >= least - first)]
        found += [(first, second, 0) for second in partners[np.argsort(-counts[partners], kind="stable")][:PAIR_PARTNERS]]
        middles = present[(present <= min(first, rest - 1)) & (2 * present >= least - first)]
        for second in middles[np.argsort(-counts[middles], kind="stable")][:TRIPLE_MIDDLES]:
            thirds = present[(present <= min(second, rest - second)) & (present >= least - first - second)]
            if len(thirds):
                found.append((first, second, thirds[np.argmax(counts[thirds])]))
    return np.array(found, np.int64).reshape(-1, 3)


def fitted_repeats(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """How often to use each pattern: min |A x - counts|, x >= 0, by multiplicative steps, which keep x non-negative."""
    used = (patterns > 0).astype(float)
    goal = counts.astype(float)
    goal[0] = 0.0
    wanted = (goal[patterns] * used).sum(axis=1)
    repeats = np.minimum.reduce(np.where(patterns > 0, goal[patterns], np.inf), axis=1) / 8 + 1e-9
    for _ in range(rounds):
        covered = np.bincount(patterns.ravel(), (used * repeats[:, None]).ravel(), len(counts))
        repeats *= wanted / np.maximum((covered[patterns] * used).sum(axis=1), 1e-12)
    return repeats


class Plan:
    """Runs of equal placements: pieces of one length with ranks low .. high - 1 go to consecutive sequences.

    ``width`` pieces of that length stand side by side in each of the run's sequences.
    """

    def __init__(self) -> None:
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []

    def add(self, pattern: list[tuple[int, int]], times: int, next_rank: np.ndarray) -> None:
        offset = 0
        for length, width in pattern:
            self.runs.append((length, int(next_rank[length]), self.sequences, offset, width))
            next_rank[length] += times * width
            offset += length * width
        self.sequences += times


def packing_plan(counts: np.ndarray) -> Plan:
    """Where the pieces go, given how many there are of each length (``counts[length]``)."""
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    next_rank = np.zeros(capacity + 1, np.int64)
    plan = Plan()
    patterns = length_patterns(left)
    if len(patterns):
        repeats = fitted_repeats(patterns, left)
        for at in np.argsort(-repeats, kind="stable"):
            lengths, widths = np.unique(patterns[at][patterns[at] > 0], return_counts=True)
            times = min(int(repeats[at]), int((left[lengths] // widths).min()))
            if times > 0:
                left[lengths] -= times * widths
                plan.add(list(zip(lengths.tolist(), widths.tolist(), strict=True))[::-1], times, next_rank)
    # Best fit of the rest: the longest piece, then always the longest that still fits, as often as the counts allow.
    while left.any():
        pattern: list[tuple[int, int]] = []
        room = longest = capacity
        while len(fits := np.flatnonzero(left[: min(room, longest) + 1])):
            length = int(fits[-1])
            width = min(room // length, int(left[length]))
            pattern.append((length, width))
            room, longest = room - length * width, length - 1
        times = min(int(left[length]) // width for length, width in pattern)
        for length, width in pattern:
            left[length] -= times * width
        plan.add(pattern, times, next_rank)
    return plan


def _placed(runs: np.ndarray):
    """Add sequence_id and offset; ``runs`` is sorted by length and rank."""
    length_at, rank_at = runs[:, 0], runs[:, 1]
    key = (length_at << 44) + rank_at

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = runs[np.searchsorted(key, (length << 44) + rank, side="right") - 1] if batch.num_rows else runs[:0]
            within = rank - run[:, 1]
            sequence = run[:, 2] + within // np.maximum(run[:, 4], 1)
            offset = run[:, 3] + within % np.maximum(run[:, 4], 1) * length
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (stored rows with a length) with sequence_id and offset.

    A piece's rank among those of its length is its number within one of RANK_PARTS parts plus the sizes of the parts
    before; the parts are dealt by a hash of the whole row. Rows that are equal in all columns may swap ranks, which
    changes nothing in the result.
    """
    names = pieces.columns
    part = F.pmod(F.xxhash64(*names), F.lit(RANK_PARTS)).cast("int")
    parted = pieces.withColumn("part", part)
    sizes = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["length"]: row["n"] for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    runs = np.array(sorted(packing_plan(counts).runs), np.int64).reshape(-1, 5)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy(*names)) - 1
    ranked = parted.withColumn("number", number).join(offsets, ["length", "part"])
    rank = (F.col("before") + F.col("number")).cast("bigint").alias("rank")
    fields = pieces.schema.simpleString()[len("struct<") : -1]
    return ranked.select(*names, rank).mapInArrow(_placed(runs), f"{fields},sequence_id:bigint,offset:bigint")


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every document in its place."""
    return pack(stored(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
