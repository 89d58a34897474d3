"""Operator 13 against zlib and a plain brute-force version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import op13_resample as op
from tickweave.llm.spark import find_package

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


def features(text, most):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)], len(words)


def brute(docs, target, percent, most, buckets, least_words, seed):
    """Rows (id, n_features, weight, score, drawn or not) in any order, and the ids by rank."""
    found = [(i, *features(t, most)) for i, t in docs]
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(crc(f) for _, fs, _ in found for f in fs)
    t = Counter(crc(f) for x in target for f in features(x, most)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for i, fs, n in found:
        weight = sum(gain(crc(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    able = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: len(able) * percent // 100]
    return Counter(r[:4] for r in rows), [(r[0], r[3]) for r in drawn]


def check(got, want):
    rows, drawn = want
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == rows
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == drawn


def test_crc_matrix_equals_zlib():
    rng = np.random.default_rng(5)
    for width in (0, 1, 2, 7, 64, 500):
        rows = rng.integers(0, 256, (9, width), dtype=np.uint8)
        assert op.crc_matrix(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


@pytest.mark.parametrize("most", [1, 3])
def test_equals_brute_force(spark, most):
    docs = [(i, t) for i, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(900, None), (901, ""), (902, "Ä ÄB ab\x00cd 日本 x" * 40), (903, "w " * 300_000), (None, "null id " * 30), (904, "Same row here " * 10), (904, "Same row here " * 10), (904, "another text of the id " * 9)]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [None, ""]
    # columns whose names clash with those of the result
    df = spark.createDataFrame([(i, t, 5, "x", 1.0) for i, t in docs], "doc_id long, text string, rank int, weight string, score double")
    got = op.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), 30, most, 1000, 5, 7).collect()
    check(got, brute(docs, target, 30, most, 1000, 5, 7))


def test_hot_ties_are_ranked_apart(spark):
    """A third of all rows with one id and one text: ranks stay 1, 2, 3, ..."""
    docs = [(7, "one text for all of them") for _ in range(300)] + [(i, f"word{i} text number {i % 10} here") for i in range(1000, 1600)]
    got = op.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("one text",)], "text string"), 60, 1, 500, 3).collect()
    check(got, brute(docs, ["one text"], 60, 1, 500, 3, 2024))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10), (2, "d e f " * 10)], "doc_id long, text string")
    assert op.resample(none, some).collect() == []
    rows = op.resample(some, none, 50).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [None, 1]
    assert op.resample(some, none, 50).schema.simpleString() == "struct<doc_id:bigint,n_features:bigint,weight:bigint,score:bigint,rank:bigint>"


def test_query_draws_towards_the_target(spark):
    got = op.op13_resample(spark, SF)
    r = got.agg(F.avg(F.when(F.col("rank").isNotNull(), F.col("weight"))).alias("drawn"), F.avg("weight").alias("all")).first()
    assert r["drawn"] > r["all"]
