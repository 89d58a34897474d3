"""Streaming scoring (S4) and online learning.

The reference's online learner (scaler + logistic regression in 10 bagged
copies, predict-then-learn one row at a time) is re-aimed as mini-batch
learning inside ``foreachBatch``: each micro-batch is first scored with the
current weights (prequential), then the scaler statistics and every bag's
weights are updated from aggregates of that batch.  Row weights per bag are
Poisson(1) draws taken from a hash of the row key, so bagging needs no
random state and replays identically after a restart.

The model state (feature means / variances, bag weights, metric counts) is a
few hundred numbers; it lives on the driver between batches and is written
to the checkpoint folder after every batch.  A restarted query reloads it,
skips micro-batches already learned, and rewrites a re-run batch's
predictions in place (one folder per epoch), so replays do not double count.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.ml import p_up
from tickweave.operators.splits import hash_fraction

def _poisson1_cdf() -> list[float]:
    """Cumulative Poisson(1) probabilities for k = 0, 1, ... up to where a double reads 1."""
    out, term, total, k = [], math.exp(-1.0), 0.0, 0
    while total + term > total:
        total += term
        out.append(total)
        k += 1
        term /= k
    return out


_POISSON1_CDF = _poisson1_cdf()


def stream_score(model: PipelineModel, stream: DataFrame, keep: Sequence[str], high: float = 0.6, low: float = 0.4) -> DataFrame:
    """Score a stream with a fitted model and keep high-confidence rows
    (P(up) >= ``high`` or <= ``low``), ready for an append sink."""
    s = model.transform(stream)
    p = p_up()
    return s.select(*keep, F.col("prediction").cast("int").alias("pred"), p.alias("prob")).filter(
        (F.col("prob") >= F.lit(high)) | (F.col("prob") <= F.lit(low))
    )


def poisson1(u: Column) -> Column:
    """Poisson(1) draw from a uniform number (inverse CDF, as far as doubles reach)."""
    k = F.lit(len(_POISSON1_CDF))
    for i in reversed(range(len(_POISSON1_CDF))):
        k = F.when(u < F.lit(_POISSON1_CDF[i]), F.lit(i)).otherwise(k)
    return k


class OnlineLogisticBag:
    """Bagged online logistic regression with a running standard scaler."""

    def __init__(self, spark: SparkSession, features: Sequence[str], label: str, key: Sequence[str], out_path: str,
                 state_path: str, bags: int = 10, lr: float = 0.5, seed: int = 42):
        self.spark, self.features, self.label, self.key = spark, list(features), label, list(key)
        self.out_path, self.state_path, self.bags, self.lr, self.seed = out_path, state_path, bags, lr, seed
        nf = len(self.features)
        self.n = 0.0
        self.mean = [0.0] * nf
        self.m2 = [0.0] * nf
        self.w = [[0.0] * (nf + 1) for _ in range(bags)]
        self.counts = {"seen": 0, "correct": 0, "tp": 0, "pred_pos": 0, "actual_pos": 0}
        self.last_epoch = -1
        self._load()

    def _load(self) -> None:
        """Resume from the last saved state (a restarted query replays from its
        checkpoint; epochs already learned are skipped)."""
        try:
            rows = self.spark.read.schema("value string, epoch long").option("recursiveFileLookup", False).text(self.state_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return  # no state written yet
        row = rows.orderBy(F.desc("epoch")).first()  # a folder per epoch; files show once they are whole
        if row is None:
            return
        st = json.loads(row["value"])
        self.n, self.mean, self.m2, self.w = st["n"], st["mean"], st["m2"], st["w"]
        self.counts, self.last_epoch = st["counts"], st.get("last_epoch", -1)

    def _rows(self, batch: DataFrame) -> DataFrame:
        """The key, every feature as a double, the label."""
        x = [F.col(f).cast("double").alias(f"x{j}") for j, f in enumerate(self.features)]
        return batch.select(*self.key, *x, F.col(self.label).cast("int").alias("_y"))

    def _bag_probs(self) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
        """What gives the scaled features (feature x row) and every bag's P(1) (bag x row)
        with the current weights, for a task's rows."""
        mean, w, nf = list(self.mean), [list(b) for b in self.w], len(self.features)
        var = [m2 / self.n if self.n > 1 else 0.0 for m2 in self.m2]
        sd = [math.sqrt(v) if v > 0 else 1.0 for v in var]

        def run(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            xs = np.empty((nf, b.num_rows))
            for j in range(nf):
                x = b.column(b.schema.get_field_index(f"x{j}"))
                xs[j] = (x.fill_null(mean[j]).to_numpy(zero_copy_only=False) - mean[j]) / sd[j]
            probs = np.empty((len(w), b.num_rows))
            with np.errstate(over="ignore"):
                for i, weights in enumerate(w):
                    z = np.full(b.num_rows, weights[-1])
                    for j in range(nf):
                        z += weights[j] * xs[j]
                    probs[i] = 1.0 / (1.0 + np.exp(-z))
            return xs, probs

        return run

    def _scored(self, batch: DataFrame) -> DataFrame:
        """Key, ``y`` and ``prob``, the mean of the bags' P(1)."""
        bag_probs, bags, key = self._bag_probs(), self.bags, self.key

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                prob = np.zeros(b.num_rows)
                for p in bag_probs(b)[1]:
                    prob += p
                kept = [b.column(b.schema.get_field_index(c)) for c in (*key, "_y")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(prob / float(bags))], names=[*key, "y", "prob"])

        schema = T.StructType([*[batch.schema[k] for k in key], T.StructField("y", T.IntegerType()), T.StructField("prob", T.DoubleType())])
        return self._rows(batch).mapInArrow(run, schema)

    def _gradients(self, batch: DataFrame) -> DataFrame:
        """``bag, j, g``: every bag's sums over its Poisson-weighted rows; j: a feature, -1 the
        intercept, -2 the weights themselves."""
        bag_probs, bags, nf = self._bag_probs(), self.bags, len(self.features)
        uniform = F.array(*[hash_fraction(*[F.col(k) for k in self.key], F.lit(b), seed=self.seed) for b in range(bags)])
        numbers = self._rows(batch).select(*[f"x{j}" for j in range(nf)], "_y", uniform.alias("u"))
        cdf = np.array(_POISSON1_CDF)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g = np.zeros((bags, nf + 2))  # features, intercept, weights
            for b in batches:
                xs, probs = bag_probs(b)
                u = b.column(b.schema.get_field_index("u")).flatten().to_numpy(zero_copy_only=False)
                k = np.searchsorted(cdf, u, side="right").reshape(-1, bags).T  # as poisson1
                y = b.column(b.schema.get_field_index("_y"))
                told = y.is_valid().to_numpy(zero_copy_only=False)
                y = y.fill_null(0).to_numpy(zero_copy_only=False)
                for i in range(bags):
                    drawn = k[i] > 0
                    g[i, -1] += k[i].sum()
                    drawn &= told
                    err = k[i, drawn] * (probs[i, drawn] - y[drawn])
                    g[i, :nf] += xs[:, drawn] @ err
                    g[i, nf] += err.sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(bags), nf + 2), pa.int32()), pa.array([*range(nf), -1, -2] * bags, pa.int32()), pa.array(g.ravel())],
                names=["bag", "j", "g"],
            )

        return numbers.mapInArrow(run, "bag int, j int, g double").groupBy("bag", "j").agg(F.sum("g").alias("g"))

    def process(self, batch: DataFrame, epoch_id: int) -> None:
        if epoch_id <= self.last_epoch:
            return  # replayed micro-batch: predictions and update already done
        scored = self._scored(batch).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))
        scored = scored.withColumn("epoch", F.lit(epoch_id))
        # One folder per epoch, replaced if the batch is re-run after a failure.
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(self.out_path)

        # Prequential counts (predict first, learn after), of the rows as written.
        m = self.spark.read.schema(scored.schema).parquet(self.out_path).where(F.col("epoch") == epoch_id).agg(
            F.count(F.lit(1)), F.sum((F.col("pred") == F.col("y")).cast("long")), F.sum(((F.col("pred") == 1) & (F.col("y") == 1)).cast("long")),
            F.sum(F.col("pred")), F.sum(F.col("y")),
        ).first()
        for k, v in zip(("seen", "correct", "tp", "pred_pos", "actual_pos"), m):
            self.counts[k] += int(v or 0)

        # Scaler: merge batch mean / M2 (Chan et al.) into the running ones.
        aggs = [F.count(F.lit(1)).alias("n")]
        for j, f in enumerate(self.features):
            aggs += [F.avg(f).alias(f"m{j}"), F.var_pop(f).alias(f"v{j}")]
        st = batch.agg(*aggs).first()
        nb = float(st["n"] or 0)
        # Gradient per bag, with the pre-update scaler (the one used to predict).
        sums = {(r["bag"], r["j"]): float(r["g"]) for r in self._gradients(batch).collect()}  # bags x features
        for b in range(self.bags):
            kw = sums.get((b, -2), 0.0)
            if kw <= 0:
                continue
            for j in range(len(self.features)):
                self.w[b][j] -= self.lr * sums[b, j] / kw
            self.w[b][-1] -= self.lr * sums[b, -1] / kw
        if nb > 0:
            for j in range(len(self.features)):
                mb, vb = st[f"m{j}"], st[f"v{j}"]
                if mb is None:
                    continue
                delta = mb - self.mean[j]
                tot = self.n + nb
                self.mean[j] += delta * nb / tot
                self.m2[j] += (vb or 0.0) * nb + delta * delta * self.n * nb / tot
            self.n += nb
        self.last_epoch = epoch_id
        self._save()

    def _save(self) -> None:
        state = {"n": self.n, "mean": self.mean, "m2": self.m2, "w": self.w, "counts": self.counts, "last_epoch": self.last_epoch}
        self.spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(f"{self.state_path}/epoch={self.last_epoch}")

    def metrics(self) -> dict:
        c = self.counts
        return {
            "seen": c["seen"],
            "accuracy": c["correct"] / c["seen"] if c["seen"] else 0.0,
            "precision": c["tp"] / c["pred_pos"] if c["pred_pos"] else 0.0,
            "recall": c["tp"] / c["actual_pos"] if c["actual_pos"] else 0.0,
        }
