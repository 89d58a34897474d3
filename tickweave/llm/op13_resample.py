"""Operator 13, importance resampling towards a target distribution, on length-bucketed CRC matrices.

Features are the runs of consecutive words of a text, hashed to buckets by crc32.
The distinct features of a chunk of texts are grouped by byte length: those of one
length form a two-dimensional uint8 array, whose CRCs are all updated column by
column, and the buckets are scattered back to the occurrences.  Bucket counts of
the raw and the target texts give every bucket a gain; a document's weight is the
mean gain of its features, and weight plus Gumbel noise (from the id) ranks the
documents, so that taking the highest scores samples without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.spark import cut, parts, table
from tickweave.llm.text import chunks, utf8

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def crc_table() -> np.ndarray:
    """The 256 remainders of the reflected CRC-32 polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1)).astype(np.uint32)
    return t


CRC_TABLE = crc_table()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """crc32 of every row of a two-dimensional uint8 array, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
    for column in rows.T:
        crc = CRC_TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def crc_of(features: pa.LargeBinaryArray) -> np.ndarray:
    """crc32 of every value: values of equal length in one matrix, results scattered back."""
    ends = np.frombuffer(features.buffers()[1], np.int64, len(features) + 1, 8 * features.offset)
    data = np.frombuffer(features.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    out = np.zeros(len(features), dtype=np.uint32)
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(group):
            n = int(size[group[0]])
            out[group] = crc_matrix(data[ends[group][:, None] + np.arange(n)])
    return out


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of ``texts`` with one space between the words of each, the
    words' starts and ends in them (and each text's offsets in the words, len + 1)."""
    buf = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    bounds = np.concatenate(([0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))))
    edge = np.flatnonzero(np.diff(IS_WORD[buf], prepend=False, append=False))
    starts, stops = edge[0::2], edge[1::2]
    first = np.searchsorted(starts, bounds)
    size = stops - starts + 1  # a word and the separator behind it
    at = np.cumsum(size) - size
    tight = buf[np.arange(int(size.sum()), dtype=np.int64) + np.repeat(starts - at, size)]
    tight[at + size - 1] = 0x20
    return tight, at, first


def feature_buckets(texts: list[bytes], most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features (runs of 1 to ``most`` words) of ``texts``; the text each
    belongs to; and each text's number of words."""
    tight, at, first = words_of(texts)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n_words)
    ends = np.append(at[1:], len(tight)) - 1
    start, size, of = [], [], []
    for k in range(1, most + 1):
        whole = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :]) if len(owner) >= k else np.zeros(0, dtype=np.int64)
        start.append(at[whole])
        size.append(ends[whole + k - 1] - at[whole])
        of.append(owner[whole])
    start, size, of = (np.concatenate(x) for x in (start, size, of))
    if not len(start):
        return np.zeros(0, dtype=np.int64), of, n_words
    offsets = np.concatenate(([0], np.cumsum(size)))
    data = tight[np.arange(int(offsets[-1]), dtype=np.int64) + np.repeat(start - offsets[:-1], size)]
    features = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = features.dictionary_encode()
    return (crc_of(coded.dictionary).astype(np.int64) % buckets)[coded.indices.to_numpy(zero_copy_only=False)], of, n_words


def bucket_counts(docs: DataFrame, most: int, buckets: int, text_col: str = "text") -> DataFrame:
    """``bucket long, n long``: how often features of each bucket occur over all texts
    (null: none).  A task adds up its texts before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            texts = utf8(b.column(0))
            for lo, hi in chunks(texts):
                n += np.bincount(feature_buckets(texts[lo:hi], most, buckets)[0], minlength=buckets)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found])], names=["bucket", "n"])

    return docs.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, most: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of every bucket, from its count s of
    S raw features and t of T target features, B buckets in all.  The counts collected are
    two numbers a bucket."""
    found = []
    for df in (raw, target):
        n = np.zeros(buckets)
        for r in bucket_counts(df, most, buckets, text_col).collect():  # one row a bucket at most
            n[r["bucket"]] = r["n"]
        found.append(n)
    s, t = found
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def noise(id_col: str, seed: int) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2^32)))``; h: the first 8 hex digits of sha256(seed:id)
    (a null id reads as empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, gain: np.ndarray, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words long, n_features long, weight long``: the floored mean gain of every row's features (none: 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            texts = utf8(b.column(1))
            for lo, hi in chunks(texts):
                bucket, of, n_words = feature_buckets(texts[lo:hi], most, len(gain))
                n = np.bincount(of, minlength=hi - lo)
                total = np.zeros(hi - lo, dtype=np.int64)
                np.add.at(total, of, gain[bucket])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    names=[id_col, "n_words", "n_features", "weight"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, most: int = 1, buckets: int = 10_000, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Draws ``percent`` % of the rows of ``docs`` that have at least ``least_words`` words, by
    weight towards the texts of ``target``.

    Returns one row per row of ``docs``: the id, ``n_features, weight, score, rank`` (all long;
    rank 1, 2, ... by falling score, ties to the smaller id, null ids last; null: not drawn).
    Features are runs of 1 to ``most`` words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
    lower-casing A-Z.  Null and empty texts have no words and weight 0.  Rows of equal id are
    documents of their own with equal noise; equal rows get neighbouring ranks.  Empty
    tables are fine on both sides; other columns are not read.

    Ranks need no single sorted task: rows are dealt out by ranges of (score, id), numbered
    within each range, and shifted by the sizes of the ranges before.
    """
    spark = docs.sparkSession
    scored = weigh(docs, gains(docs, target, most, buckets, text_col), most, id_col, text_col).withColumn("score", F.col("weight") + noise(id_col, seed))
    scored = cut(scored.withColumn("_can", F.col("n_words") >= least_words), "resample-scores")
    able = scored.where("_can").withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))  # splits groups of equal rows
    order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("_tie")]
    sorted_rows = able.repartitionByRange(parts(docs), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = cut(sorted_rows.select(id_col, "n_features", "weight", "score", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_pos")), "resample-ranges")
    sizes = sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect())  # one row a range
    drawn = sum(n for _, n in sizes) * percent // 100
    before, shifts = 0, []
    for part, n in sizes:
        shifts.append((part, before))
        before += n
    shift = spark.createDataFrame(shifts, "_part long, _before long")
    rank = F.col("_before") + F.col("_pos") + 1
    ranked = dealt.join(F.broadcast(shift), "_part").withColumn("rank", F.when(rank <= drawn, rank))  # one row a range
    columns = [id_col, "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(scored.where("not _can").withColumn("rank", F.lit(None).cast("long")).select(*columns))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = """
WITH bits AS (
  SELECT list(CAST(list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS BIGINT) ORDER BY i) AS t
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
), texts AS (
  SELECT doc_id, FALSE AS target, text FROM documents UNION ALL SELECT item_id, TRUE, text FROM benchmark
), words AS (
  SELECT doc_id, target, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM texts
), counted AS (
  SELECT doc_id, target, w, count(*) AS n FROM words GROUP BY ALL
), hexed AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM counted)
), hashed AS (
  SELECT w, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(len(h) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, bits
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (NOT target), 0) AS s, coalesce(sum(n) FILTER (target), 0) AS t
  FROM counted JOIN hashed USING (w) GROUP BY bucket
), totals AS (
  SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t_all FROM buckets
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS g FROM buckets, totals
), weight AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * g) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM counted JOIN hashed USING (w) JOIN gain USING (bucket) WHERE NOT target GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weight USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * able // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
