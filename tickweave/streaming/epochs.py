"""Tables written one micro-batch (epoch) at a time, the same after a retry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class EpochTable:
    """Parquet folders ``path/epoch=N``.  A re-run micro-batch overwrites its own folder, so every
    epoch counts once however often it was tried."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def epochs(self) -> list[int]:
        """Finished epochs, in order."""
        fs, path = self._fs()
        if not fs.exists(path):
            return []
        done = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith("epoch=")]
        jvm = self.spark.sparkContext._jvm
        return sorted(int(p.getName()[6:]) for p in done if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def write(self, rows: DataFrame, epoch: int) -> DataFrame:
        """Writes the epoch's rows and gives them back as read."""
        folder = f"{self.path}/epoch={epoch}"
        rows.select(*self.schema.names).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(self.schema).parquet(folder)

    def before(self, epoch: int) -> DataFrame:
        """The rows of the newest epoch before ``epoch`` (none: an empty frame)."""
        past = [e for e in self.epochs() if e < epoch]
        if not past:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/epoch={past[-1]}")

    def read(self, after: int = -1) -> DataFrame:
        """The rows of all epochs later than ``after``."""
        found = [e for e in self.epochs() if e > after]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/epoch={e}" for e in found])

    def forget(self, before: int) -> None:
        """Removes the epochs before ``before``."""
        fs, path = self._fs()
        jvm = self.spark.sparkContext._jvm
        for e in self.epochs():
            if e < before:
                fs.delete(jvm.org.apache.hadoop.fs.Path(path, f"epoch={e}"), True)
