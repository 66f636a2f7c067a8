"""Exact top-k inner products by a pivot-distance index.

Vectors become whole numbers. With one more component, sqrt(M^2 - |x|^2), all indexed vectors lie on a sphere of radius M,
and the largest inner product belongs to the smallest distance from the query, which has 0 there. Pivots are points of that
sphere; their number grows with the table. Each vector is keyed by its nearest pivot and its ring, an interval of distances from
that pivot. A ring also knows the least and the largest distance of its vectors from every other pivot. By the triangle
inequality each of these intervals bounds the distance of all its vectors from a query, and so their inner product from above;
the tightest bound counts.

A query visits the rings in the order of their bounds: first one, then, wave by wave, WIDER times as many as before. Every wave
raises the query's threshold, its k-th best product so far, and the query is done where the next bound is below it. In a ring,
whose vectors are sorted by their distance from the pivot, only the annulus around the query that the threshold leaves is multiplied.
A ring with many vectors is cut into blocks by a hash, so that a crowded ring is searched by many tasks. Query and ring blocks
are joined by key and multiplied as matrices.

Pivots are chosen from a bounded sample (PIVOT_SAMPLE different vectors of each length); every vector is indexed and the result
does not depend on the pivots. n_compared is the number of vectors that a query was multiplied with.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, neither do null vec_ids;
vectors of different lengths are not compared; a query with fewer candidates than k gets all of them; rows with the same
vec_id are candidates of their own, and as queries are the same query; an empty table gives no rows; further columns are
ignored. Products are exact while they fit 53 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import discard, small_side, stored

TOP = 5
SCALE = 256
# Pivots per length: a quarter of the root of its vectors, between these two numbers.
PIVOTS, MOST_PIVOTS = 16, 128
RINGS = 8
# How many times as many rings each wave visits as the one before.
WIDER = 4
PIVOT_SAMPLE = 2_000
BLOCK_ROWS = 2_048
QUERY_ROWS = 512

_CELL = ["dim", "pivot", "ring"]


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim, x (whole numbers), norm2 of the vectors that take part."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    valid = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("bigint")).alias("x")
    rows = valid.select(F.col("vec_id").cast("bigint"), F.size("embedding").alias("dim"), scaled)
    norm = F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    return rows.withColumn("norm2", norm)


def _lifted(x: np.ndarray, norm2: np.ndarray, radius2: float) -> np.ndarray:
    """The vectors with the component that puts them on the sphere."""
    return np.column_stack([x, np.sqrt(np.maximum(radius2 - norm2, 0.0))])


def chosen_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Farthest-first: each pivot is the sample vector farthest from the pivots before it."""
    chosen = [0]
    distance = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(pivots, len(sample)) and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen].astype(float)


def _chosen(least: int, most: int, sample: int):
    """The pivots of one length as rows, from the sample's vectors with the smallest hashes."""

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("number", kind="stable").head(sample)
        first = frame.iloc[0]
        x = np.array(frame["x"].to_list(), float).reshape(len(frame), first["dim"])
        lifted = _lifted(x, (x**2).sum(axis=1), first["radius2"])
        found = chosen_pivots(lifted, int(np.clip(np.sqrt(first["n"]) / 4, least, max(least, most))))
        return pd.DataFrame({"dim": first["dim"], "radius2": first["radius2"], "point": list(found)})

    return choose


def _distances(lifted: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From lifted vectors to pivots. The whole-numbered components are summed without rounding."""
    x, p = lifted[:, :-1], pivots[:, :-1]
    squares = (x**2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(squares, 0.0) + (lifted[:, -1:] - pivots[:, -1]) ** 2)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dim).astype(float)


def _measured(batches: Iterator[pa.RecordBatch], model: dict[int, tuple[float, np.ndarray]], rings: int):
    """Per batch and length: the length, its rows, their distances from all pivots, the nearest pivot, the ring."""
    for batch in batches:
        for dim in np.unique(batch.column("dim").to_numpy()).tolist():
            rows = batch.filter(pa.compute.equal(batch.column("dim"), dim))
            radius2, pivots = model[dim]
            lifted = _lifted(_matrix(rows.column("x"), dim), rows.column("norm2").to_numpy(), radius2)
            distances = _distances(lifted, pivots)
            nearest = distances.argmin(axis=1)
            # No two points of the sphere are farther apart than twice the radius.
            width = max(2 * np.sqrt(radius2) / rings / np.sqrt(2), 1e-9)
            ring = np.minimum(distances[np.arange(len(nearest)), nearest] / width, rings - 1).astype(np.int32)
            yield dim, rows, distances, nearest, ring


def _keyed(model: dict[int, tuple[float, np.ndarray]], rings: int):
    """Add pivot, ring and distance."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, distances, nearest, ring in _measured(batches, model, rings):
            distance = distances[np.arange(len(nearest)), nearest]
            columns = [rows.column("vec_id"), rows.column("dim"), rows.column("x"), pa.array(nearest, pa.int32()), pa.array(ring), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "x", "pivot", "ring", "distance"])

    return key


def _spans(model: dict[int, tuple[float, np.ndarray]], rings: int):
    """Of each ring in a task: its vectors, and their least and largest distance from every pivot."""
    types = [pa.int32()] * 3 + [pa.int64()] + [pa.list_(pa.float64())] * 2

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for dim, _, distances, nearest, ring in _measured(batches, model, rings):
            pivots = distances.shape[1]
            if dim not in known:
                shape = (pivots * rings, pivots)
                known[dim] = np.zeros(shape[0], np.int64), np.full(shape, np.inf), np.full(shape, -np.inf)
            n, low, high = known[dim]
            cell = nearest * rings + ring
            n += np.bincount(cell, minlength=len(n))
            np.minimum.at(low, cell, distances)
            np.maximum.at(high, cell, distances)
        for dim, (n, low, high) in known.items():
            some = np.flatnonzero(n)
            columns = [np.full(len(some), dim), some // rings, some % rings, n[some], list(low[some]), list(high[some])]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [*_CELL, "n", "low", "high"])

    return span


def _packed(frame: pd.DataFrame) -> pd.DataFrame:
    """A group's vectors as one row of bytes, in the order of their distances."""
    frame = frame.sort_values(["distance", "vec_id"], kind="stable")
    first = frame.iloc[0]
    x = np.stack(frame["x"].to_list()).astype("<i8") if first["dim"] else np.zeros((len(frame), 0), "<i8")
    row = {name: [first[name]] for name in (*_CELL, "block")}
    ids, distances = frame["vec_id"].to_numpy("<i8"), frame["distance"].to_numpy("<f8")
    return pd.DataFrame(row | {"ids": [ids.tobytes()], "matrix": [x.tobytes()], "distances": [distances.tobytes()]})


class Rings:
    """The rings of one length, with the bounds of their inner products with a query."""

    def __init__(self, radius2: float, pivots: np.ndarray, rows: list):
        self.radius2, self.pivots = radius2, pivots
        self.keys = [(row["pivot"], row["ring"], row["blocks"]) for row in rows]
        spans = np.array([[(s["low"], s["high"]) for s in row["spans"]] for row in rows], float)
        self.low, self.high = spans[:, :, 0], spans[:, :, 1]

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per query and ring: no vector of the ring has a larger product. Also the distances from the pivots, and room for rounding."""
        norm2 = (queries**2).sum(axis=1)
        at = _distances(np.column_stack([queries, np.zeros(len(queries))]), self.pivots)
        gap = np.zeros((len(queries), len(self.keys)))
        for pivot in range(len(self.pivots)):
            own = at[:, pivot, None]
            np.maximum(gap, own - self.high[:, pivot], out=gap)
            np.maximum(gap, self.low[:, pivot] - own, out=gap)
        room = 1e-9 * (norm2 + self.radius2) + 1.0
        return (norm2[:, None] + self.radius2 - gap**2) / 2 + room[:, None], at, room

    def reach(self, queries: np.ndarray, least: np.ndarray, room: np.ndarray) -> np.ndarray:
        """The largest distance from the query of a vector whose product is not below ``least``."""
        return np.sqrt(np.maximum((queries**2).sum(axis=1) + self.radius2 - 2 * (least - room), 0.0))


def _asked(rings: dict[int, Rings], start: int, stop: int):
    """Rows of (ring, block, queries): of each query the rings from place ``start`` to ``stop`` by bound that reach its threshold."""
    names = [*_CELL, "block", "ids", "matrix", "least", "nearest", "farthest"]
    schema = pa.schema([(n, t) for n, t in zip(names, [pa.int32()] * 4 + [pa.binary()] * 5, strict=True)])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()).tolist():
                rows = batch.filter(pa.compute.equal(batch.column("dim"), dim))
                for begin in range(0, rows.num_rows, QUERY_ROWS):
                    columns: list[list] = [[] for _ in names]
                    part = rows.slice(begin, QUERY_ROWS)
                    x, ids, own = _matrix(part.column("x"), dim), part.column("vec_id").to_numpy(), rings[dim]
                    least = part.column("least").to_numpy()
                    bounds, at, room = own.bounds(x)
                    reach = own.reach(x, least, room)
                    order = np.argsort(-bounds, axis=1, kind="stable")[:, start:stop]
                    wanted = np.zeros(bounds.shape, bool)
                    np.put_along_axis(wanted, order, np.take_along_axis(bounds, order, axis=1) >= least[:, None], axis=1)
                    for place in np.flatnonzero(wanted.any(axis=0)).tolist():
                        pivot, ring, blocks = own.keys[place]
                        chosen = np.flatnonzero(wanted[:, place])
                        annulus = at[chosen, pivot] - reach[chosen], at[chosen, pivot] + reach[chosen]
                        values = (ids[chosen], "<i8"), (x[chosen], "<i8"), *((a, "<f8") for a in (least[chosen], *annulus))
                        packed = [a.astype(t).tobytes() for a, t in values]
                        for block in range(blocks):
                            for column, value in zip(columns, (dim, pivot, ring, block, *packed), strict=True):
                                column.append(value)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return ask


def _multiplied(top: int):
    """query_id, vec_id, score, compared: of each pair of blocks the ``top`` best per query that reach its threshold.

    One more row per query, without vec_id, has in ``compared`` the number of vectors that it was multiplied with.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found: list[list[np.ndarray]] = [[], [], []]
                query_ids, ids = np.frombuffer(row["query_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                least, nearest, farthest, distances = (np.frombuffer(row[n], "<f8") for n in ("least", "nearest", "farthest", "distances"))
                first, last = np.searchsorted(distances, nearest, "left"), np.searchsorted(distances, farthest, "right")
                low, high = first.min(), max(last.max(), first.min())
                q = np.frombuffer(row["queries"], "<i8").reshape(len(query_ids), row["dim"])
                x = np.frombuffer(row["matrix"], "<i8").reshape(len(ids), row["dim"])[low:high]
                ids = ids[low:high]
                largest = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(row["dim"], 1)
                scores = q.astype(float) @ x.T.astype(float) if largest < 2**53 else q @ x.T
                for query_id, line, threshold in zip(query_ids, scores, least, strict=True):
                    good = np.flatnonzero((ids != query_id) & (line >= threshold))
                    best = good[np.lexsort((ids[good], -line[good]))[:top]]
                    found[0].append(np.full(len(best), query_id))
                    found[1].append(ids[best])
                    found[2].append(line[best].astype(np.int64))
                query, vec, score = (np.concatenate(c) for c in found)
                none = pa.nulls(len(query_ids), pa.int64())
                compared = np.append(np.zeros(len(query), np.int64), np.full(len(query_ids), len(ids)))
                columns = [pa.array(np.append(query, query_ids)), *(pa.concat_arrays([pa.array(c, pa.int64()), none]) for c in (vec, score)), pa.array(compared)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "compared"])

    return multiply


def _search(asked: DataFrame, blocks: DataFrame, top: int) -> DataFrame:
    queries = asked.withColumnsRenamed({"ids": "query_ids", "matrix": "queries"})
    names = ["dim", "query_ids", "queries", "least", "nearest", "farthest", "ids", "matrix", "distances"]
    pairs = queries.join(blocks, [*_CELL, "block"]).select(*names)
    return pairs.mapInArrow(_multiplied(top), "query_id bigint, vec_id bigint, score bigint, compared bigint")


def _pivots(whole: DataFrame, pivots: int, sample: int) -> dict[int, tuple[float, np.ndarray]]:
    """For each length the squared radius and the pivots; to the driver go the pivots alone."""
    counted = whole.groupBy("dim").agg(F.max("norm2").alias("radius2"), F.count(F.lit(1)).alias("n"))
    # A threshold on the hash leaves little more than the sample; equal vectors have one hash and count once.
    share = F.least(F.lit(1.0), 1.5 * (sample + 100) / F.col("n"))
    drawn = whole.select("dim", "x", F.xxhash64("x").alias("number")).join(counted, "dim")
    drawn = drawn.filter(F.col("number").cast("double") <= (2 * share - 1) * 2.0**63).distinct()
    rows = drawn.groupBy("dim").applyInPandas(_chosen(pivots, MOST_PIVOTS, sample), "dim int, radius2 double, point array<double>").collect()
    points: dict[int, list] = {}
    for row in rows:
        points.setdefault(row["dim"], []).append(row["point"])
    return {row["dim"]: (row["radius2"], np.array(points[row["dim"]], float)) for row in rows}


def compared_products(
    vectors: DataFrame, every: int = 50, top: int = TOP, pivots: int = PIVOTS, rings: int = RINGS, sample: int = PIVOT_SAMPLE
) -> DataFrame:
    """query_id, rank, vec_id, score, n_compared: the best inner products of the vectors whose vec_id is divisible by ``every``."""
    whole = stored(whole_vectors(vectors), "vectors")
    model = _pivots(whole, pivots, sample)
    points = whole.select("vec_id", "dim", "x", "norm2")
    # One row per pivot and ring, with one interval per pivot, so bounded by those two parameters.
    spans = points.mapInArrow(_spans(model, rings), "dim int, pivot int, ring int, n bigint, low array<double>, high array<double>")
    each = spans.select(*_CELL, "n", F.posexplode(F.arrays_zip("low", "high")).alias("other", "span"))
    least, largest = F.min("span.low").alias("low"), F.max("span.high").alias("high")
    each = each.groupBy(*_CELL, "other").agg(F.sum("n").alias("n"), least, largest)
    intervals = F.sort_array(F.collect_list(F.struct("other", "low", "high"))).alias("spans")
    sizes = each.groupBy(*_CELL).agg(F.ceil(F.max("n") / BLOCK_ROWS).cast("int").alias("blocks"), intervals)
    sizes = stored(sizes, "rings")
    cells = sizes.collect()
    bounds = {dim: Rings(*model[dim], [c for c in cells if c["dim"] == dim]) for dim in model}

    keyed = points.mapInArrow(_keyed(model, rings), "vec_id bigint, dim int, x array<bigint>, pivot int, ring int, distance double")
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block")
    dealt = keyed.join(small_side(sizes.select(*_CELL, "blocks"), len(cells), 32), _CELL).select("*", block)
    columns = "dim int, pivot int, ring int, block int, ids binary, matrix binary, distances binary"
    blocks = stored(dealt.select(*_CELL, "block", "vec_id", "x", "distance").groupBy(*_CELL, "block").applyInPandas(_packed, columns), "blocks")

    schema = "dim int, pivot int, ring int, block int, ids binary, matrix binary, least binary, nearest binary, farthest binary"
    queries = stored(whole.filter(F.col("vec_id") % every == 0).select("vec_id", "dim", "x").distinct(), "queries")
    by_query = Window.partitionBy("query_id")
    rank = F.row_number().over(by_query.orderBy(F.desc_nulls_last("score"), "vec_id")).cast("int")
    columns = "query_id bigint, rank int, vec_id bigint, score bigint, n_compared bigint"
    best = stored(whole.sparkSession.createDataFrame([], columns), "best")
    start, number = 0, 1
    while start < max((len(own.keys) for own in bounds.values()), default=0):
        least = best.filter((F.col("rank") == top) & F.col("vec_id").isNotNull()).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
        bounded = queries.join(least, "vec_id", "left").withColumn("least", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))))
        asked = bounded.mapInArrow(_asked(bounds, start, start + number), schema)
        if asked.isEmpty():
            break
        # What was compared before stands in the row of rank 1.
        before = best.select("query_id", "vec_id", "score", F.when(F.col("rank") == 1, F.col("n_compared")).otherwise(F.lit(0)).alias("compared"))
        both = before.unionByName(_search(asked, blocks, top))
        ranked = both.withColumn("rank", rank).withColumn("n_compared", F.sum("compared").over(by_query)).filter(F.col("rank") <= top)
        following = stored(ranked.select("query_id", "rank", "vec_id", "score", "n_compared"), "best")
        discard(best)
        best, start, number = following, start + number, WIDER * number
    for frame in (whole, sizes, blocks, queries):
        discard(frame)
    return best.filter(F.col("vec_id").isNotNull())


def top_products(vectors: DataFrame, **options) -> DataFrame:
    """query_id, rank, vec_id, score of ``compared_products``."""
    return compared_products(vectors, **options).drop("n_compared")
