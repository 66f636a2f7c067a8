"""Centroid clustering against plain loops and its SQL."""

import hashlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import centroids
from clickmill.llm.common import importable, table
from clickmill.llm.queries import ORACLES

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def expected(rows):
    """The rows by distances to all centroids, with integers of any size."""
    kept = [
        (vec_id, tuple((64 * Fraction(x)).__floor__() for x in v))
        for vec_id, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    hashed = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [v for _, v in hashed[:16]]

    def assign():
        found = []
        for vec_id, v in kept:
            d, k = min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(middle))
            found.append((vec_id, v, k, d))
        return found

    for _ in range(3):
        found = assign()
        for k in range(len(middle)):
            members = [v for _, v, cluster, _ in found if cluster == k]
            if members:
                middle[k] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    found = assign()
    per = [sum(d for _, _, c, d in found if c == k) for k in range(len(middle))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    fits = lambda x: x if x < 2**63 else None
    return sorted([(i, k, fits(d), fits(per[k]), fits(sum(per)), sha[k]) for i, _, k, d in found], key=str)


def check(spark, rows):
    frame = importable(spark).createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, centroids.clusters(frame).collect()), key=str) == expected(rows)


def noise(rng, center, spread=0.3):
    return (np.asarray(center) + spread * rng.standard_normal(64)).tolist()


def test_clusters_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((9, 64))
    rows = [(i, noise(rng, centers[i % 9])) for i in range(150)]
    rows += [(7, rows[3][1]), (7, rows[4][1]), (None, rows[5][1]), (200, None), (201, [1.0] * 63), (202, []), (203, [None] + [1.0] * 63)]
    rows += [(204, [float("nan")] + [0.0] * 63), (205, [float("inf")] + [0.0] * 63), (206, [0.0] * 64), (207, [-0.0] * 64)]
    check(spark, rows)


def test_few_equal_and_no_vectors(spark):
    check(spark, [(i, [0.25] * 64) for i in range(20)])
    check(spark, [(1, [0.5] * 64), (2, [-0.51] * 64)])
    empty = spark.createDataFrame([(1, None, 0)], SCHEMA)
    found = centroids.clusters(empty)
    assert found.count() == 0
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.clusters(empty.limit(0)).count() == 0


def test_components_of_any_size(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(64) * 10.0 ** (i % 5 * 8)).tolist()) for i in range(40)]
    check(spark, [*rows, (50, [1.7e308] + [0.0] * 63), (51, [-1.7e308] * 64)])


def test_other_columns_may_clash(spark):
    rows = [(i, [float(i)] * 64, 1, 2, 3) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cluster int, distance int, inertia int")
    assert sorted(map(tuple, centroids.clusters(frame).collect()), key=str) == expected([r[:2] for r in rows])


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 20), st.sampled_from([1, 3, 1000, 10**12]))
def test_search_is_exact_under_ties(seed, k, size):
    rng = np.random.default_rng(seed)
    vectors, middle = rng.integers(-size, size + 1, (30, 64)), rng.integers(-size, size + 1, (k, 64))
    middle[-1] = middle[0]
    vectors[0] = middle[0]
    kind = np.int64 if size < centroids.SMALL else object
    cluster, distance, _ = centroids.nearest(vectors.astype(kind), middle.astype(kind))
    plain = ((vectors.astype(object)[:, None] - middle.astype(object)[None]) ** 2).sum(axis=2)
    assert [min((d, j) for j, d in enumerate(row)) for row in plain.tolist()] == list(zip(distance.tolist(), cluster.tolist(), strict=True))


def test_far_centroids_are_dropped_early():
    rng = np.random.default_rng(5)
    middle = rng.integers(-200, 200, (16, 64)) + np.arange(16)[:, None] * 400
    vectors = middle[rng.integers(0, 16, 500)] + rng.integers(-20, 20, (500, 64))
    _, _, compared = centroids.nearest(vectors, middle)
    assert compared < 0.25 * 500 * 16 * 64


def test_table_equals_sql(spark, sf_dir):
    found = centroids.clusters(table(spark, sf_dir, "embeddings"))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
        wanted = db.execute(ORACLES["op13_walsh_centroids"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert len(wanted) == pytest.approx(500)
