"""Operator 12 against plain integer arithmetic and DuckDB."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from tickweave.llm import op12_clustering as op
from tickweave.llm.spark import find_package

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int, label int"


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


def brute(rows, k, rounds, dims, seed):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        to = [j for _, j in assign()]
        for j in range(len(cents)):
            mine = [v for (_, v), t in zip(kept, to) if t == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    final = assign()
    inner = {j: sum(d for d, t in final if t == j) for j in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, j, d, inner[j], sum(inner.values()), sha[j]) for (i, _), (d, j) in zip(kept, final)]


def test_equals_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(9)
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f32(rng.normal(i % 5, 0.6, 4))) for i in range(150)]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0, 3.0]), (904, [1.0, math.nan, 0.0, 0.0]), (905, [math.inf, 0.0, 0.0, 0.0]), (906, [1.0] * 5)]
    rows += [(None, [0.5, 0.25, -3.0, 1.0]), (7, [0.0] * 4), (7, [0.0] * 4), (7, [9.0, 1.0, 1.0, 1.0])]
    rows += [(1000 + i, [2.0, 2.0, 2.0, 2.0]) for i in range(100)]  # a third of all rows alike
    rows += [(2000, [0.5, 0.5, 0.5, 0.5]), (2001, [2000.0, -2000.0, 1e4, -1e4])]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)
    for k, rounds in ((8, 10), (3, 2), (1, 1), (5, 0)):
        got = [tuple(r) for r in op.clusters(df, k, rounds, 4, 3).collect()]
        assert sorted(got, key=str) == sorted(brute(rows, k, rounds, 4, 3), key=str)


def test_fewer_vectors_than_clusters_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0], "x", 1, 2), (2, [1.0, 1.0], "x", 1, 2)], SCHEMA)
    rows = op.clusters(df, 8, 10, 2, 3).collect()
    assert [(r["vec_id"], r["cluster"], r["distance"]) for r in sorted(rows)] == [(1, 0, 0), (2, 0, 0)]
    assert op.clusters(df.limit(0), 8, 10, 2, 3).collect() == []
    assert op.clusters(df, 8, 10, 64, 3).collect() == []


def test_components_beyond_exact_distances_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30, 1.0], "x", 1, 2)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        op.clusters(df, 8, 10, 2, 3).collect()
    for dims in (1, 2, 64, 1000):
        assert dims * (2 * op.largest(dims)) ** 2 < 2**63


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(1)
    for spread in (3, 1000, 10**7):
        x = rng.integers(-spread, spread + 1, (400, 8))
        x[::7] = x[0]
        pivots = op.Pivots(x[:6])
        cents = np.vstack([x[:6], x[100:110]])  # pivots themselves among the centroids
        low = pivots.bounds(pivots.distances(x), pivots.distances(cents))
        assert (low <= ((x[:, None] - cents[None]) ** 2).sum(axis=2)).all()
        best, far, n = op.nearest(x, pivots.distances(x), cents, pivots)
        true = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
        assert (best == true.argmin(axis=1)).all() and (far == true.min(axis=1)).all() and n <= true.size


def test_bounds_spare_distances_where_there_are_clusters():
    rng = np.random.default_rng(2)
    middles = rng.integers(-2000, 2000, (8, 64))
    x = np.repeat(middles, 100, axis=0) + rng.integers(-60, 60, (800, 64))
    pivots = op.Pivots(x[::100])
    _, _, n = op.nearest(x, pivots.distances(x), middles, pivots)
    assert n < 0.3 * len(x) * 8


def test_query_equals_sql(spark):
    duckdb.sql(f"create or replace view embeddings as select * from '{SF}/embeddings.parquet'")
    assert sorted(tuple(r) for r in op.op12_clustering(spark, SF).collect()) == sorted(duckdb.sql(op.OP12_SQL).fetchall())
