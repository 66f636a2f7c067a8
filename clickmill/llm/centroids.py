"""Centroid clustering with a progressive search over Walsh-Hadamard coefficients.

Vectors become whole numbers, floor(64 * x) of each component. A vector and the centroids are transformed by the integer
Walsh-Hadamard transform, whose rows are ordered by their sign changes, coarse to fine. The transform multiplies every squared
distance by exactly 64, and the squared differences of the first coefficients alone never exceed it. So a centroid whose
partial sum is above the full distance of another one is strictly worse and is dropped; the others are carried on, block
by block, to all 64 coefficients. What is left is exact: the nearest centroid, of equal ones the smaller number.

The first centroids are the vectors with the smallest hashes of their ids. Each round sends the centroids to the tasks (16
vectors); every task returns one sum per centroid and component, whatever its number of rows, and Spark adds them up. Sums
travel as signed digits to the base 2**32, so they are exact for components of any size.

Defined results: vectors that are null, have other than 64 components, or hold a null or non-finite one take no part and get
no row. A null vec_id has no hash: its vector is assigned but never a first centroid. Rows with the same vec_id are vectors of
their own, ordered by their components where their hashes tie. With fewer than 16 vectors there are as many centroids as
vectors; an empty table gives no rows. A distance or sum beyond the range of a long is null. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import stored

SIZE = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
# Components up to this size are added and squared in 64 bits without overflow; larger ones as whole numbers of any size.
SMALL = 1 << 24
DIGIT = 1 << 32
LONG_MAX = (1 << 63) - 1
# Ends of the blocks of coefficients, coarse to fine.
BLOCKS = (1, 2, 4, 8, 16, 32, 64)
# The ends after which the leading centroid's full distance is taken as a bound.
BOUNDS = (4, 16)


def _coarse_to_fine(size: int) -> np.ndarray:
    """The rows of the transform by their number of sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort(np.count_nonzero(np.diff(rows), axis=1), kind="stable")


_ORDER = _coarse_to_fine(SIZE)


def walsh_hadamard(vectors: np.ndarray) -> np.ndarray:
    """The integer transform of each row by sums and differences; coefficients coarse to fine."""
    step = 1
    while step < vectors.shape[1]:
        pairs = vectors.reshape(len(vectors), -1, 2, step)
        vectors = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(vectors.shape)
        step *= 2
    return vectors[:, _ORDER]


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(64 * x) of doubles, as 64-bit integers if all are small, else as Python integers."""
    if not values.size or np.abs(values).max() < SMALL / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [SCALE * int(x) if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    difference = left - right
    return (difference * difference).sum(axis=1)


def _leaders(row: np.ndarray, total: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The place of the smallest (total, other) of each row; rows are ascending."""
    if total.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], total[i], other[i])), np.int64)
    else:
        order = np.lexsort((other, total, row))
    return order[np.flatnonzero(np.diff(row[order], prepend=-1))]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row the number of its nearest centroid and the squared distance; and how many coefficients were compared."""
    if object in (vectors.dtype, centroids.dtype):
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    ours, theirs = walsh_hadamard(vectors), walsh_hadamard(centroids)
    n, k = len(ours), len(theirs)
    row, other = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    total = np.zeros(n * k, ours.dtype)
    bound, compared = None, 0
    for start, end in zip((0, *BLOCKS[:-1]), BLOCKS, strict=True):
        total = total + _squares(ours[row, start:end], theirs[other, start:end])
        compared += len(row) * (end - start)
        if end in BOUNDS:
            # The full distance of the centroid that leads so far is a bound for the others.
            full = _squares(ours, theirs[other[_leaders(row, total, other)]])
            bound = full if bound is None else np.minimum(bound, full)
            compared += n * SIZE
        if bound is not None:
            going = (total <= bound[row]).astype(bool)
            row, other, total = row[going], other[going], total[going]
    best = _leaders(row, total, other)
    return other[best].astype(np.int32), total[best] // SIZE, compared


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return whole_numbers(flat.reshape(-1, SIZE))


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """The signed digits of a whole number to the base DIGIT, with their places."""
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        rest, digit = divmod(rest, DIGIT)
        if digit:
            yield place, sign * digit
        place += 1


def _task_sums(centroids: np.ndarray):
    """Sums per centroid and component, and counts at component SIZE: place, digit, value."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = defaultdict(int)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch)
            cluster, _, _ = nearest(vectors, centroids)
            for number in np.unique(cluster).tolist():
                members = vectors[cluster == number]
                for component, value in enumerate([*members.sum(axis=0).tolist(), len(members)]):
                    totals[number * (SIZE + 1) + component] += value
        rows = [(place, digit, value) for place, total in totals.items() for digit, value in _digits(total)]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["place", "digit", "value"])

    return sums


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; empty ones stay."""
    sums = vectors.mapInArrow(_task_sums(centroids), "place int, digit int, value bigint")
    # At most CENTROIDS * (SIZE + 1) numbers of a few digits reach the driver.
    found = defaultdict(int)
    for place, digit, value in sums.groupBy("place", "digit").agg(F.sum("value")).collect():
        found[place] += value * DIGIT**digit
    moved = [list(c) for c in centroids.tolist()]
    for number, centroid in enumerate(moved):
        count = found[number * (SIZE + 1) + SIZE]
        if count:
            centroid[:] = [found[number * (SIZE + 1) + component] // count for component in range(SIZE)]
    return _array(moved)


def _array(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(value) < SMALL for row in rows for value in row)
    return np.array(rows, np.int64 if small else object).reshape(len(rows), SIZE)


def _assigned(centroids: np.ndarray):
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = nearest(_vectors(batch), centroids)
                fitting = [d if d <= LONG_MAX else None for d in distance.tolist()]
                columns = [batch.column(0), pa.array(cluster), pa.array(fitting, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return assigned


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part."""
    infinite = float("inf")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    whole = F.col("embedding").isNotNull() & (F.size("embedding") == SIZE)
    return embeddings.select(F.col("vec_id").cast("bigint"), "embedding").filter(whole).filter(~bad)


def clusters(embeddings: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per vector that takes part."""
    spark = embeddings.sparkSession
    vectors = kept_vectors(embeddings)
    number = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.filter("vec_id is not null").orderBy(number, "embedding").limit(CENTROIDS).select("embedding").collect()
    columns = "vec_id bigint, cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], columns.replace("cluster int", "cluster int, distance bigint"))
    centroids = _array(whole_numbers(np.array([row[0] for row in first], np.float64)).tolist())
    for _ in range(ROUNDS):
        centroids = _moved(vectors, centroids)
    assigned = stored(vectors.mapInArrow(_assigned(centroids), "vec_id bigint, cluster int, distance bigint"), "assigned")
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    found = assigned.groupBy("cluster").agg(F.when(F.count("distance") == F.count(F.lit(1)), whole)).collect()
    inertia = {cluster: None if total is None else int(total) for cluster, total in found}
    every = None if None in inertia.values() else sum(inertia.values())
    rows = [
        (
            number,
            *[x if x is not None and x <= LONG_MAX else None for x in (inertia[number], every)],
            hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest(),
        )
        for number in inertia
    ]
    facts = spark.createDataFrame(rows, columns.removeprefix("vec_id bigint, "))
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
