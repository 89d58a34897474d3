"""Operator 5, exact top-k search over an impact-ordered index, score at a time.

Vectors lie in blocks; in a block every dimension's rows are cut into segments
by quantised value (the impact).  A query processes the segments of all its
dimensions by descending impact ``|q| * u`` (u: distance of the value from the
end of its range that is worst for the query), adding each segment's least
impact to its rows' accumulators.  It stops only when the bounds prove that
few rows can still be members (or everything is processed), and rescores these
exactly in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.llm.spark import parts, table

SCALE = 1024
LEVELS = 16
BLOCK_ROWS = 16_384
QUERY_BLOCK = 64
CHECK_EVERY = 32  # segments between two tests of the stopping proof


class ImpactIndex:
    """Posting segments of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        n, dims = self.rows.shape
        self.low, self.high = self.rows.min(axis=0), self.rows.max(axis=0)
        self.segments: list[np.ndarray] = []
        dim, least, most = [], [], []
        for d in range(dims):
            v = self.rows[:, d]
            level = (v - self.low[d]) * LEVELS // (self.high[d] - self.low[d] + 1)
            by = np.argsort(level, kind="stable")
            for part in np.split(by, np.flatnonzero(np.diff(level[by])) + 1):
                self.segments.append(part)
                dim.append(d)
                least.append(v[part].min())
                most.append(v[part].max())
        self.dim, self.least, self.most = (np.array(x, dtype=np.int64) for x in (dim, least, most))

    def top(self, query: np.ndarray, k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` highest inner products (ties to the smaller id), exactly."""
        weight = np.abs(query)
        up = query[self.dim] > 0
        gain_low = weight[self.dim] * np.where(up, self.least - self.low[self.dim], self.high[self.dim] - self.most)
        gain_high = weight[self.dim] * np.where(up, self.most - self.low[self.dim], self.high[self.dim] - self.least)
        live = np.flatnonzero(weight[self.dim] > 0)
        order = live[np.argsort(-gain_high[live], kind="stable")]
        score = np.zeros(len(self.ids), dtype=np.int64)
        own = np.flatnonzero(self.ids == without) if without is not None else np.zeros(0, dtype=np.int64)
        score[own] = np.iinfo(np.int64).min // 2
        few = max(4 * k, len(score) // 16)
        # the widest gap between a row's least and true gain, over all dimensions
        width = np.zeros(len(query), dtype=np.int64)
        np.maximum.at(width, self.dim, gain_high - gain_low)
        slack = int(width.sum())
        ahead = self._ahead(order, gain_high, len(query))
        member = np.arange(len(score))
        for i in range(0, len(order), CHECK_EVERY):
            for s in order[i : i + CHECK_EVERY].tolist():
                if gain_low[s]:
                    score[self.segments[s]] += gain_low[s]
            if len(score) > k:
                kth = np.partition(score, len(score) - k)[len(score) - k]
                member = np.flatnonzero(score + (slack + ahead[min(i + CHECK_EVERY, len(order))]) >= kth)
                if len(member) <= few:
                    break
        member = np.setdiff1d(member, own, assume_unique=True)
        exact = self.rows[member] @ query
        best = np.lexsort((self.ids[member], -exact))[:k]
        return self.ids[member][best], exact[best]

    def _ahead(self, order: np.ndarray, gain: np.ndarray, dims: int) -> np.ndarray:
        """For each number of processed segments, the most that any row can still gain:
        the sum over dimensions of the largest gain not yet processed."""
        drop = np.zeros(len(order) + 1, dtype=np.int64)
        total = 0
        for d in range(dims):
            at = np.flatnonzero(self.dim[order] == d)
            if len(at):
                g = gain[order[at]]
                total += int(g[0])
                drop[at + 1] = g - np.append(g[1:], 0)
        return total - np.cumsum(drop)


def quantised(col: Column) -> Column:
    """floor(1024 * x) of every component, x as double.  A component so large that scores, or the
    bounds on the way to them (up to four times a score), might not fit a long is an error."""
    limit = F.sqrt(F.lit(2.0**61) / F.greatest(F.size(col), F.lit(1)))
    message = F.lit("top_k: a component is too large for scores that fit a long")

    def one(x: Column) -> Column:
        y = F.lit(float(SCALE)) * x.cast("double")
        return F.when(F.abs(y) + 1 >= limit, F.raise_error(message).cast("bigint")).otherwise(F.floor(y))

    return F.transform(col, one)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` highest inner products.

    Queries are the rows where ``is_query`` holds, candidates all rows with another
    id.  Rows with a null id, a null vector, or a null, NaN or infinite component
    take no part; a finite component beyond what scores in a long allow (about 185,000 in
    a vector of 64) is an error; vectors of different lengths are never compared.  Equal ids are
    different candidates, each listed.  Fewer than ``k`` candidates give all.
    Query blocks meet vector blocks (a stated query set against all rows); each
    meeting keeps ``k`` rows a query before the final ranking.
    """
    fine = F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    v = vectors.withColumn("_q", F.coalesce(is_query, F.lit(False))).where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("_id"), quantised(F.col(vec_col)).alias("_v"), "_q", F.size(vec_col).alias("_dim"))
    per = {r["_dim"]: (r["n"], r["q"]) for r in v.groupBy("_dim").agg(F.count("*").alias("n"), F.sum(F.col("_q").cast("long")).alias("q")).collect()}  # one row for a vector length
    blocks = {d: max(parts(vectors), -(-n // BLOCK_ROWS)) for d, (n, _) in per.items()}
    q_blocks = {d: max(1, -(-q // QUERY_BLOCK)) for d, (_, q) in per.items()}
    pick = lambda m: F.coalesce(*[F.when(F.col("_dim") == d, F.lit(x)) for d, x in m.items()], F.lit(1))
    packed = F.collect_list(F.struct("_id", "_v")).alias("rows")
    by_block = v.withColumn("_b", F.pmod(F.xxhash64("_id"), pick(blocks)).cast("int")).groupBy("_dim", "_b").agg(packed)
    asked = v.where("_q").withColumn("_qb", F.pmod(F.xxhash64("_id", F.lit(1)), pick(q_blocks)).cast("int")).groupBy("_dim", "_qb").agg(F.collect_list(F.struct("_id", "_v")).alias("asked"))
    meet = asked.withColumn("_b", F.explode(F.sequence(F.lit(0), pick(blocks) - 1))).join(by_block.hint("merge"), ["_dim", "_b"])

    def matrix(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
        flat = rows.values
        ids = flat.field("_id").to_numpy(zero_copy_only=False)
        values = flat.field("_v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return ids, values.reshape(len(ids), len(values) // len(ids))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if key != last:
                    last, index = key, ImpactIndex(*matrix(batch.column(3)[i]))
                found = [(q, *index.top(x, k, q)) for q, x in zip(*matrix(batch.column(2)[i]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)), pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)), pa.array(np.concatenate([f[2] for f in found]).astype(np.int64))],
                    names=["query_id", "vec_id", "score"],
                )

    rows = meet.select("_dim", "_b", "asked", "rows").mapInArrow(search, "query_id long, vec_id long, score long")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
