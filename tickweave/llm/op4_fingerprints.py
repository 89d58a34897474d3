"""Operator 4, document fingerprints by MinHash.

A document's shingles are its five-word windows; the first four windows, cut
short by the start of the text, count too, so that texts of a few words keep
several.  ``PERMUTATIONS`` universal hash permutations ``a * x + b mod 2**32``
(a odd) of all shingles are taken in vectorised numpy; the fingerprint is the
low 16 bits of each minimum, in hex.  The likeness of two fingerprints, the
share of equal positions, estimates the Jaccard similarity of the shingle sets.
``near_duplicates`` joins bands of the signature in Spark and verifies Jaccard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.components import components
from tickweave.llm.spark import cut, parts, table
from tickweave.llm.text import U64, chunks, mix, powers, utf8, word_hashes

PERMUTATIONS = 128
WIDTH = 5
_rng = np.random.Generator(np.random.PCG64(4))
MULTIPLY = (_rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
ADD = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)[:, None]
SPREAD = 3  # centres of a band besides its smallest id
CELLS = 64  # cells of a text's shingle counts, for an upper bound of common shingles
SLICE = 512  # shingles permuted at a time: PERMUTATIONS x SLICE numbers stay in the cache


def shingles(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """64-bit hashes of the windows of up to ``width`` words that end at each word of a
    text (only the first ``width - 1`` are shorter); may repeat."""
    words, first = word_hashes(texts)
    pw = powers(width)
    n = np.diff(first)
    at = np.arange(len(words)) - np.repeat(first[:-1], n)
    full = np.zeros(len(words), dtype=np.uint64)
    for j in range(width):
        back = words[: len(words) - j] * pw[j]
        full[j:] += np.where(at[j:] >= j, back, U64(0))
    full = mix(full + np.minimum(at + 1, width).astype(np.uint64) * U64(0xD1B54A32D192ED03))
    return [full[first[i] : first[i + 1]] for i in range(len(texts))]


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of every permutation; all ones for no shingles."""
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)
    x = (hashes >> U64(32)).astype(np.uint32)
    for i in range(0, len(x), SLICE):
        np.minimum(out, (x[i : i + SLICE] * MULTIPLY + ADD).min(axis=1), out=out)
    return out


def signatures(texts: list[bytes]) -> np.ndarray:
    out = [signature(s) for lo, hi in chunks(texts) for s in shingles(texts[lo:hi])]
    return np.stack(out) if out else np.zeros((0, PERMUTATIONS), dtype=np.uint32)


def fingerprint(sig: np.ndarray) -> str:
    return (sig & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(((a ^ b) & np.uint32(0xFFFF) == 0).mean())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, signature`` of every row (null text: that of the empty text;
    null and repeated ids keep their rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs = signatures(utf8(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(s) for s in sigs], pa.string()), pa.array([s.view(np.int32) for s in sigs], pa.list_(pa.int32()))], names=[id_col, "fingerprint", "signature"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fingerprint string, signature array<int>")


def band_keys(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of every band of the signatures (a clash only makes one more pair to verify)."""
    part = sigs[:, : bands * rows].astype(np.uint64).reshape(len(sigs), bands, rows)
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(sigs), 1))
    for j in range(rows):
        out = mix(out + part[:, :, j] + U64(1))
    return out


def cell_counts(hashes: np.ndarray) -> list[int]:
    """How many of a text's shingles lie in each of ``CELLS`` cells."""
    return np.bincount((hashes >> U64(58)).astype(np.int64), minlength=CELLS).tolist()


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 25, rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, like_id, jaccard``: links (like_id is the smaller id) of a Jaccard similarity
    of at least ``threshold`` that connect whatever the links between all texts that
    share a signature band connect.

    Equal texts are collapsed first (each copy is linked to the smallest id with
    its text, Jaccard 1), so a group of copies makes one signature.  Within a band
    the members are first verified against a few centres (the smallest id and
    ``SPREAD`` others); then all members that are still in different components,
    unless their shingle counts, in all or by cell, rule a link out.  So a text that
    has a partner in a band has a link, while pairs in one component, which the
    squares of large groups are made of, are left alone.  With 25 bands of 5 rows a pair of
    similarity 0.8 shares a band with probability 0.99995.  Different texts of one
    id are texts of their own (linked with each other, both ids are the same).
    Rows with null ids and texts without words are linked with nothing.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")).where("_id is not null")
    kind = docs.schema[id_col].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column(1))
            for lo, hi in chunks(texts):
                sets = [np.unique(s) for s in shingles(texts[lo:hi])]
                used = [i for i, s in enumerate(sets) if len(s)]
                if used:
                    keys = band_keys(np.stack([signature(sets[i]) for i in used]), bands, rows).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).take(pa.array([lo + i for i in used], pa.int64())),
                            pa.array([hashlib.sha256(texts[lo + i]).digest() for i in used], pa.binary()),
                            pa.array(list(keys), pa.list_(pa.int64())),
                            pa.array([len(sets[i]) for i in used], pa.int32()),
                            pa.array([cell_counts(sets[i]) for i in used], pa.list_(pa.int32())),
                        ],
                        names=["_id", "_h", "_keys", "_size", "_cells"],
                    )

    described = cut(d.mapInArrow(describe, f"_id {kind}, _h binary, _keys array<long>, _size int, _cells array<int>"), "fingerprint-texts")
    own = described.groupBy("_h").agg(F.min("_id").alias("_id"), *[F.first(c).alias(c) for c in ("_keys", "_size", "_cells")])
    sig = cut(own.withColumn("_n", F.monotonically_increasing_id()), "fingerprint-signatures")  # written once, so a text keeps its number
    copies = described.select("_id", "_h").distinct().join(sig.select("_h", F.col("_id").alias("_like")), "_h").where("_id <> _like").select("_id", "_like", F.lit(1.0).alias("jaccard"))
    band = sig.select("_n", F.explode("_keys").alias("_k"))
    several = band.groupBy("_k").agg(F.count("*").alias("_c")).where("_c > 1").select("_k")
    met = cut(band.join(several, "_k").join(sig.select("_n", "_id", F.xxhash64("_h").alias("_t")), "_n"), "fingerprint-bands")  # members of bands with several
    centre = [F.min(F.struct("_id", "_t", "_n"))["_n"], *[F.min(F.struct(F.xxhash64("_t", "_k", F.lit(j)), F.col("_n")))["_n"] for j in range(SPREAD)]]
    centres = met.groupBy("_k").agg(F.array_distinct(F.array(*centre)).alias("_m"))
    stars = cut(met.join(centres, "_k").select("_n", F.explode("_m").alias("_m")).where("_n <> _m").select(F.greatest("_n", "_m").alias("a"), F.least("_n", "_m").alias("b")).distinct(), "fingerprint-stars")
    wanted = met.select("_n").distinct().join(sig.select("_n", "_id", "_h"), "_n")
    texts = d.hint("merge").join(wanted.select("_n", "_id", "_h"), "_id").where(F.unhex(F.sha2("_text", 256)) == F.col("_h")).select("_n", "_text")
    reps = cut(texts.dropDuplicates(["_n"]), "fingerprint-met-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, ys = utf8(b.column(2)), utf8(b.column(3))
            got = []
            for x, y in zip(xs, ys):
                s, t = (np.unique(v) for v in shingles([x, y]))
                common = len(np.intersect1d(s, t, assume_unique=True))
                got.append(common / (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.float64())], names=["a", "b", "jaccard"])

    def possible(left: str, right: str, common) -> Column:
        """No link is ruled out by this upper bound of the common shingles (with room for rounding)."""
        return common >= (threshold - 1e-9) * (F.col(left) + F.col(right) - common)

    def by_cell(left: str, right: str) -> Column:
        return F.aggregate(F.zip_with(left, right, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        one = reps.select(F.col("_n").alias("a"), F.col("_text").alias("x")).hint("merge")
        two = reps.select(F.col("_n").alias("b"), F.col("_text").alias("y")).hint("merge")
        return cut(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long, jaccard double").where(F.col("jaccard") >= threshold), name)

    size = sig.select("_n", "_size", "_cells")
    sizes = [size.toDF(c, f"_size_{c}", f"_cells_{c}") for c in "ab"]
    may = possible("_size_a", "_size_b", F.least("_size_a", "_size_b")) & possible("_size_a", "_size_b", by_cell("_cells_a", "_cells_b"))
    first = verified(stars.join(sizes[0], "a").join(sizes[1], "b").where(may).select("a", "b"), "fingerprint-first")
    placed = met.join(components(first).withColumnRenamed("id", "_n"), "_n", "left").select("_k", "_n", F.coalesce("component", "_n").alias("_c"))
    mixed = placed.groupBy("_k").agg(F.min("_c").alias("lo"), F.max("_c").alias("hi")).where("lo <> hi").select("_k")
    left = cut(placed.join(mixed, "_k").join(size, "_n"), "fingerprint-open")
    other = left.toDF(*[f"{c}_b" for c in left.columns])
    meet = (F.col("_k") == F.col("_k_b")) & (F.col("_n") > F.col("_n_b")) & (F.col("_c") != F.col("_c_b"))
    meet &= possible("_size", "_size_b", F.least("_size", "_size_b")) & possible("_size", "_size_b", by_cell("_cells", "_cells_b"))
    apart = left.join(other, meet).select(F.col("_n").alias("a"), F.col("_n_b").alias("b")).distinct()
    second = verified(apart.join(stars, ["a", "b"], "left_anti"), "fingerprint-second")
    ids = sig.select("_n", "_id")
    named = first.unionByName(second).join(ids.toDF("a", "u"), "a").join(ids.toDF("b", "v"), "b")
    found = named.select(F.greatest("u", "v").alias("_id"), F.least("u", "v").alias("_like"), "jaccard")
    return copies.unionByName(found).select(F.col("_id").alias(id_col), F.col("_like").alias("like_id"), "jaccard")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 20_000) -> DataFrame:
    """Rows ``_b, _halo, _id, _text`` dealt by id ranges and sorted, so that a row's successor
    in (id, text) order is the row after it: every range also gets, marked as halo,
    the first row(s) of the next range (the last range those of the first).

    Ranges come from approximate quantiles of the ids; their bounds are at most
    10,000 numbers.  Rows with a null id have no successor and lie in ranges of
    their own (negative numbers, spread by text).
    """
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    n = d.count()
    n_buckets = int(min(10_000, max(4 * parts(docs), n // per_bucket)))
    cuts = sorted(set(d.agg(F.percentile_approx("_id", [i / n_buckets for i in range(1, n_buckets)], 10 * n_buckets).alias("q")).first()["q"] or []))
    splits = F.array(*[F.lit(c) for c in cuts]) if cuts else F.expr("cast(array() as array<bigint>)")
    spread = -1 - F.pmod(F.xxhash64("_text"), F.lit(n_buckets)).cast("int")
    d = d.withColumn("_b", F.when(F.col("_id").isNull(), spread).otherwise(F.size(F.filter(splits, lambda s: s <= F.col("_id")))))
    firsts = sorted((r["_b"], r["f"]) for r in d.where("_id is not null").groupBy("_b").agg(F.min("_id").alias("f")).collect())  # one row for a range
    if firsts:
        before = dict(zip([b for b, _ in firsts], [firsts[-1][0], *[b for b, _ in firsts]]))
        previous = F.element_at(F.array(*[F.lit(before.get(b, -1)) for b in range(max(before) + 1)]), F.col("_b") + 1)
        leads = F.array_contains(F.array(*[F.lit(f) for _, f in firsts]), F.col("_id"))
        here = F.struct(F.col("_b").alias("b"), F.lit(0).alias("h"))
        to = F.when(F.col("_id").isNotNull() & leads, F.array(here, F.struct(previous.alias("b"), F.lit(1).alias("h")))).otherwise(F.array(here))
    else:
        to = F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("h")))
    d = d.select(F.explode(to).alias("_to"), "_id", "_text").select(F.col("_to.b").alias("_b"), F.col("_to.h").alias("_halo"), "_id", "_text")
    return d.repartition(parts(docs), "_b").sortWithinPartitions("_b", "_halo", "_id", "_text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, in which the last quarter of its
    code points gives way to the start of the next document (ascending id).

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  A null text counts as empty.  Rows with equal ids follow each
    other in text order; a single row follows itself; a row with a null id has no
    next document (nothing is put in, near_next is 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row read: bucket, id, text, signature

        def finish(rows: list) -> pa.RecordBatch:
            edits = []
            for (_, _, t, _), nxt in rows:
                k = len(t) // 4
                edits.append((t[: len(t) - k] + (nxt[2][:k] if nxt else "")).encode())
            sigs = signatures(edits)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[1] for r, _ in rows], pa.int64()),
                    pa.array([len(r[2]) for r, _ in rows], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edits], pa.string()),
                    pa.array([fingerprint(r[3]) for r, _ in rows], pa.string()),
                    pa.array([fingerprint(s) for s in sigs], pa.string()),
                    pa.array([likeness(r[3], s) for (r, _), s in zip(rows, sigs)], pa.float64()),
                    pa.array([likeness(r[3], nxt[3]) if nxt else 0.0 for r, nxt in rows], pa.float64()),
                ],
                names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            raw = batch.column(3).to_pylist()
            sigs = signatures([t.encode() for t in raw])
            out, size = [], 0
            for b, halo, i, t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), raw, sigs):
                row = (b, i, t, s)
                if held is not None:
                    out.append((held, row if b == held[0] and b >= 0 else None))
                    size += len(held[2])
                held = None if halo else row
                if size > 1 << 22:
                    yield finish(out)
                    out, size = [], 0
            if out:
                yield finish(out)
        if held is not None:
            yield finish([(held, None)])

    kind = docs.schema[id_col].dataType
    out = with_next(docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn(id_col, F.col(id_col).cast(kind))


def with_classes(prints: DataFrame, links: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``prints`` with ``class_id`` (the smallest id that ``links`` lead to, the own one
    included) and ``n_links`` (the links that the id stands in); a null id has no class."""
    ends = links.select(F.explode(F.array_distinct(F.array(id_col, "like_id"))).alias(id_col)).groupBy(id_col).agg(F.count("*").alias("_links"))
    classes = components(links, id_col, "like_id").withColumnRenamed("id", id_col)
    told = ends.join(classes, id_col, "left").withColumnRenamed("component", "_class")
    out = prints.join(told, id_col, "left")
    return out.select(*prints.columns, F.coalesce("_class", id_col).alias("class_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return with_classes(edited_fingerprints(docs), cut(near_duplicates(docs), "fingerprint-links"))
