"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only a local
    session (one machine) that names none gets a scratch folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = os.environ.get("TICKWEAVE_SCRATCH") or tempfile.mkdtemp(prefix="tickweave-llm-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared folder and read it back: work is
    done once, and lost executors do not bring the lineage back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (on a cluster it is shipped with ``--py-files`` or installed as usual)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def give_back() -> None:
    """Let Arrow and the C library hand memory that they hold but do not use back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_tidying: list[int] = []  # the process whose memory is tidied in the background


def stay_tidy() -> None:
    """``give_back`` now and every other second from now on: a worker waits for its next task with
    what its last one left, and no function of ours runs then."""
    give_back()
    if _tidying != [os.getpid()]:
        _tidying[:] = [os.getpid()]
        threading.Thread(target=_tidy_up, name="tickweave-tidy", daemon=True).start()


def _tidy_up() -> None:
    while True:
        time.sleep(2)
        give_back()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for mapInArrow, that gives back what the worker's earlier tasks (of any
    stage: workers stay) and its own batches leave unused."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stay_tidy()
        for b in run(batches):
            yield b
            del b
            give_back()

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: Column | str, n: int) -> Column:
    """crc32 of the decimal text of an integer column, modulo n (null reads as empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def parts(df: DataFrame, least: int = 1) -> int:
    """Number of shuffle partitions of the session."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
