"""Operator 12, centroid clustering with Ptolemaic pivots.

Vectors are integers.  Their distances to a few fixed pivots are computed once and
stored with them.  For a pair of pivots p, s Ptolemy's inequality gives a lower
bound of the distance of a vector x to a centroid c:

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)

A vector is compared exactly with the centroid of least bound, and then with every
centroid whose bound, rounded downwards by more than all rounding errors, does not
exceed that distance.  Assignments, sums and means are exact integers; a task adds
up its vectors before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.spark import cut, table

SCALE = 1024
PIVOTS = 8
ROWS = 4096  # vectors whose bounds are computed at once
DOWN = 2.0**-48  # relative allowance for rounding, over ten times the errors of a bound


def largest(dims: int) -> int:
    """The largest absolute component for which squared distances fit a long."""
    return int(((2**63 - 1) / dims) ** 0.5 / 2) - 1


def integers(col: Column, dims: int) -> Column:
    """floor(1024 * x) of every component; components too large for exact distances are an error."""
    limit = largest(dims)

    def one(x: Column) -> Column:
        y = F.floor(F.lit(float(SCALE)) * x.cast("double"))
        return F.when(F.abs(x.cast("double")) * SCALE >= limit, F.raise_error(F.lit(f"a component times {SCALE} is beyond {limit}"))).otherwise(y).cast("bigint")

    return F.transform(col, one)


class Pivots:
    """Fixed pivots and their usable pairs."""

    def __init__(self, points: np.ndarray):
        self.points = np.unique(points, axis=0)
        gaps = self.distances(self.points)
        self.pairs = [(i, j, gaps[i, j]) for i, j in combinations(range(len(self.points)), 2)]

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """Distances of every row to every pivot."""
        out = np.empty((len(rows), len(self.points)))
        for j, p in enumerate(self.points):
            out[:, j] = np.sqrt(((rows - p) ** 2).sum(axis=1).astype(np.float64))
        return out

    def bounds(self, of_rows: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
        """Squared lower bounds, rows x centroids, never above the true squared distance."""
        low = np.zeros((len(of_rows), len(of_centroids)))
        for i, j, gap in self.pairs:
            a = of_rows[:, i, None] * of_centroids[None, :, j]
            b = of_rows[:, j, None] * of_centroids[None, :, i]
            np.maximum(low, (np.abs(a - b) - DOWN * (a + b)) / gap, out=low)
        return low * low * (1 - DOWN)


def nearest(rows: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of every row's nearest centroid (ties: the smaller number),
    and how many distances were computed for it."""
    low = pivots.bounds(to_pivots, pivots.distances(centroids))
    one = np.arange(len(rows))
    guess = low.argmin(axis=1)
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    exact[one, guess] = ((rows - centroids[guess]) ** 2).sum(axis=1)
    low[one, guess] = np.inf
    at, c = np.nonzero(low <= exact[one, guess][:, None])
    exact[at, c] = ((rows[at] - centroids[c]) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[one, best], len(rows) + len(at)


def matrix(lists: pa.ListArray, width: int, dtype) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(lists), width)


def measured(batch: pa.RecordBatch, centroids: np.ndarray, pivots: Pivots) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a batch (columns: id, vector, pivot distances): offset, vectors, clusters, distances."""
    for lo in range(0, batch.num_rows, ROWS):
        part = batch.slice(lo, ROWS)
        rows = matrix(part.column(1), centroids.shape[1], np.int64)
        best, far, _ = nearest(rows, matrix(part.column(2), len(pivots.points), np.float64), centroids, pivots)
        yield lo, rows, best, far


def sums(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots) -> dict[tuple[int, int], tuple[int, int]]:
    """(cluster, dimension) -> (sum, count) over all vectors; clusters x dimensions rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centroids.shape, dtype=np.int64)
        n = np.zeros(len(centroids), dtype=np.int64)
        for b in batches:
            for _, rows, best, _ in measured(b, centroids, pivots):
                n += np.bincount(best, minlength=len(n))
                for c in np.unique(best):
                    total[c] += rows[best == c].sum(axis=0)
        c, d = (x.ravel() for x in np.indices(total.shape))
        some = n[c] > 0
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (c, d, total.ravel(), n[c])], names=["c", "d", "s", "n"])

    added = vectors.select("_id", "_v", "_p").mapInArrow(run, "c long, d long, s long, n long").groupBy("c", "d").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return {(r["c"], r["d"]): (r["s"], r["n"]) for r in added.collect()}


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, cluster int, distance, cluster_inertia, inertia long, centroid_sha256`` of every
    vector with exactly ``dims`` components, none null, NaN or infinite (others take no part).

    Components become floor(1024 x); one beyond the range in which squared distances
    fit a long is an error.  Centroids start as the ``k`` vectors (all, if fewer) with the smallest
    sha256 of ``seed:id`` (a null id reads as empty; equal ids by their components).  Each round
    assigns all vectors to the nearest centroid and moves every non-empty centroid to the
    componentwise floor of its vectors' mean; rounds end early once nothing moves, as
    later ones would not move anything either.  Rows of equal id are vectors of their
    own; an empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    kept = vectors.where((F.size(vec_col) == dims) & finite).select(F.col(id_col).alias("_id"), integers(F.col(vec_col), dims).alias("_v"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    first = np.array([r["_v"] for r in kept.orderBy(key, "_v").limit(max(k, PIVOTS)).collect()], dtype=np.int64).reshape(-1, dims)  # a few rows
    centroids, pivots = first[:k], Pivots(first[:PIVOTS])

    def to_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(pivots.points)
        for b in batches:
            far = pivots.distances(matrix(b.column(1), dims, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(far) + 1, dtype=np.int32) * width), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["_id", "_v", "_p"])

    id_type = kept.schema["_id"].dataType.simpleString()
    stored = cut(kept.mapInArrow(to_pivots, f"_id {id_type}, _v array<bigint>, _p array<double>"), "cluster-vectors")
    for _ in range(rounds if len(first) else 0):
        found = sums(stored, centroids, pivots)
        moved = centroids.copy()
        for (c, d), (s, n) in found.items():
            moved[c, d] = s // n
        if (moved == centroids).all():
            break
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, best, far in measured(b, centroids, pivots):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(best)), pa.array(best.astype(np.int32)), pa.array(far)], names=["_id", "cluster", "distance"])

    assigned = cut(stored.mapInArrow(assign, f"_id {id_type}, cluster int, distance bigint"), "cluster-assigned")
    digests = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())], "cluster int, centroid_sha256 string")
    inner = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = assigned.agg(F.sum("distance").alias("inertia"))
    facts = F.broadcast(inner.join(digests, "cluster").crossJoin(whole))  # one row a cluster; the cross side is one row
    return assigned.join(facts, "cluster").select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def _sql(k: int, rounds: int, dims: int, seed: int) -> str:
    """The rounds as a chain of common table expressions."""
    ctes = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM v ORDER BY h, v LIMIT {k})
)""",
    ]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT i, min({{'d': CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}}) AS best
  FROM v, c{r} c GROUP BY i
)""")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c AS c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM (
      SELECT best.c AS c, d, CAST(sum(v.v[d]) AS BIGINT) AS s, count(*) AS n
      FROM a{r} JOIN v USING (i), (SELECT unnest(range(1, {dims + 1})) AS d) GROUP BY ALL
    ) GROUP BY c
  ) m ON m.c = c{r}.c
)""")
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(list_aggregate(list_transform(c{rounds}.v, lambda x: CAST(x AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (i) JOIN c{rounds} ON c{rounds}.c = best.c"""


OP12_SQL = _sql(8, 10, 64, 3)
