"""Operator 9, toxicity from the nearest labelled examples.

A bounded sample of labelled documents (``MAX_TOXIC`` + ``MAX_CLEAN`` rows by
hash order, the documented bound) becomes an inverted index of TF-IDF vectors
over all their words and character 4-grams, each term's weight multiplied by its
association with the labels (plain weights let the subject of a text
decide; no term is left out).  The ``DENSE`` most frequent terms,
which have most of the postings, lie in a matrix of examples x terms; the others
in postings by term.  A document's cosine with every example is the sum of the
matrix part and the postings of its rare terms; the nearest are the highest of these,
exactly.  Distance-weighted
votes are calibrated (isotonic, leave-one-out on the sample) into a score; the
nearest examples are the evidence.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.spark import crc_mod, cut, table, tidy

MAX_TOXIC, MAX_CLEAN = 1500, 3000  # bound of the labelled sample
DENSE = 4096  # most frequent terms, kept as a matrix
FLOOR = 0.01  # least weight factor of a term, however little it is associated with a label
NEIGHBOURS = 15
TOGETHER = 256  # documents multiplied with the matrix at a time
BATCH = 4 * TOGETHER  # documents scored before their evidence is handed out
MEMO_WORDS = 100_000  # about 20 MB a worker
THRESHOLD = 0.7

WORDS = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[str]:
    """A word's index terms: itself and the character 4-grams of ``^word``."""
    marked = "^" + word
    return [word, *{"#" + marked[i : i + 4] for i in range(max(1, len(marked) - 3))}]


class Terms(dict):
    """word -> its terms, as numbers in the vocabulary (32-bit, as bytes), remembered (bounded)."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        out = array("i", [n for n in map(self.vocabulary.get, word_terms(word)) if n is not None]).tobytes()
        self[word] = out
        return out

    def found(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a text, ascending, and how often each stands in it."""
        all_ids = np.sort(np.frombuffer(b"".join(map(self.__getitem__, WORDS.findall(text.lower()))), dtype=np.int32))
        first = np.flatnonzero(np.diff(all_ids, prepend=-1))
        return all_ids[first].astype(np.int64), np.diff(np.append(first, len(all_ids)))

    def counts(self, text: str) -> Counter:
        return Counter(dict(zip(*(x.tolist() for x in self.found(text)))))


@dataclass
class Index:
    """The examples' weights of frequent and rare terms; see ``nearest``."""

    words: pa.Array  # the vocabulary, by falling frequency
    idf: np.ndarray
    ids: list
    labels: np.ndarray
    weights: np.ndarray  # labelled rows that an example stands for
    example: np.ndarray  # postings of the other terms, by term, then example
    weight: np.ndarray
    ptr: np.ndarray
    frequent_ptr: np.ndarray  # every example's part of the matrix, as (term, weight) runs
    frequent_term: np.ndarray
    frequent_weight: np.ndarray
    prior: float
    curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    @cached_property
    def vocabulary(self) -> dict[str, int]:
        """term -> number; made by each worker for itself."""
        return numbered(self.words)

    @cached_property
    def terms(self) -> Terms:
        """Kept with the index, so that all tasks of a worker share what they remember."""
        return Terms(self.vocabulary)

    @cached_property
    def dense(self) -> np.ndarray:
        """The matrix: examples x most frequent terms, filled once per process."""
        out = np.zeros((len(self.ids), min(DENSE, len(self.words))), dtype=np.float32)
        out[np.repeat(np.arange(len(out)), np.diff(self.frequent_ptr)), self.frequent_term] = self.frequent_weight
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("vocabulary", "terms", "dense")}

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        order = np.argsort(terms)
        n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))[order]
        return self.weighted(terms[order], n)

    def weighted(self, terms: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1.0 + np.log(n)) * self.idf[terms]
        norm = np.sqrt((w * w).sum())
        return terms, w / norm if norm else w

    def frequent(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The part of every example's cosine that the matrix terms make, for each vector."""
        q = np.zeros((len(vectors), self.dense.shape[1]), dtype=np.float32)
        for i, (terms, w) in enumerate(vectors):
            n = np.searchsorted(terms, q.shape[1])
            q[i, terms[:n]] = w[:n]
        return q @ self.dense.T

    def nearest(self, terms: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of highest positive cosine (ties to the earlier example), exactly
        up to rounding.  ``base``: what ``frequent`` gives for this vector."""
        if not len(terms) or not len(self.ids):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        base = self.frequent([(terms, w)])[0] if base is None else base
        n = np.searchsorted(terms, self.dense.shape[1])
        terms, w = terms[n:], w[n:]
        lo = self.ptr[terms]
        n = self.ptr[terms + 1] - lo
        first = np.cumsum(n, dtype=n.dtype) - n
        at = np.repeat(lo - first, n)
        at += np.arange(len(at), dtype=at.dtype)
        got = np.bincount(self.example.take(at), weights=self.weight.take(at) * np.repeat(w, n), minlength=len(base)) + base
        if without >= 0:
            got[without] = 0.0
        hit = np.flatnonzero(got > 0)
        if len(hit) > k:
            hit = hit[got[hit] >= np.partition(got[hit], len(hit) - k)[len(hit) - k]]
        best = hit[np.lexsort((hit, -got[hit]))[:k]]
        return best, got[best]

    def all_nearest(self, texts: list[str | None], own: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of every text; ``own``: the examples that the texts are themselves, which are left out."""
        for lo in range(0, len(texts), TOGETHER):
            some = [self.weighted(*self.terms.found(x or "")) for x in texts[lo : lo + TOGETHER]]
            if own is not None:  # as the index has them
                some = [(t, w.astype(np.float32)) for t, w in some]
            for i, (v, base) in enumerate(zip(some, self.frequent(some)), lo):
                yield self.nearest(*v, without=-1 if own is None else own[i], base=base)

    def vote(self, best: np.ndarray, score: np.ndarray) -> float:
        near = self.weights[best] / (1.1 - np.minimum(score, 1.0)) * score
        far = self.weights.mean() if len(self.ids) else 1.0
        return float((near @ self.labels[best] + far * self.prior) / (near.sum() + far))

    def score(self, raw: float) -> float:
        return float(np.interp(raw, *self.curve))


def numbered(words: pa.Array) -> dict[str, int]:
    return dict(zip(words.to_pylist(), range(len(words))))


def build_index(words: pa.Array, df: np.ndarray, examples: list[tuple[object, int, np.ndarray, np.ndarray]], totals: tuple[int, int]) -> Index:
    """The index of (id, label, terms, counts) examples, terms ascending; ``words``: the vocabulary by falling
    frequency; ``totals``: labelled rows with label 0 and 1.  Without its curve, see ``learned``."""
    n = [max(1, sum(1 for e in examples if e[1] == y)) for y in (0, 1)]
    share = [max(totals[y], n[y]) / n[y] for y in (0, 1)]
    rows = sum(totals)
    idf = np.log((1.0 + rows) / (1.0 + df @ np.array(share))) + 1.0 if len(words) else np.zeros(0)
    idf = np.maximum(idf, 1e-3) * relevance(df, n)
    few = min(DENSE, len(words))
    index = Index(words, idf, [], np.zeros(0), np.zeros(0), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32), np.zeros(len(words) + 1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int16), np.zeros(0, dtype=np.float32), (totals[1] + 0.5) / (rows + 1.0))
    vectors = []
    for e in examples:
        terms, w = index.weighted(e[2], e[3].astype(np.float64))
        vectors.append((e, (terms, w.astype(np.float32))))
    # the order settles ties: by label, then heaviest term
    vectors.sort(key=lambda x: (x[0][1], int(x[1][0][np.argmax(x[1][1])]) if len(x[1][0]) else -1, str(x[0][0])))
    rare = [np.searchsorted(t, few) for _, (t, _) in vectors]  # where a vector's postings begin
    if vectors:
        index.frequent_ptr = np.concatenate(([0], np.cumsum(rare)))
        index.frequent_term = np.concatenate([t[:n].astype(np.int16) for n, (_, (t, _)) in zip(rare, vectors)])
        index.frequent_weight = np.concatenate([w[:n] for n, (_, (_, w)) in zip(rare, vectors)])
        term = np.concatenate([t[n:].astype(np.int32) for n, (_, (t, _)) in zip(rare, vectors)])
        order = np.argsort(term, kind="stable")
        index.ptr = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(words))))).astype(np.int32 if len(term) < 1 << 31 else np.int64)
        index.example = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(t) - n for n, (_, (t, _)) in zip(rare, vectors)])[order]
        index.weight = np.concatenate([w[n:] for n, (_, (_, w)) in zip(rare, vectors)])[order]
        del term, order
    index.ids = [e[0] for e, _ in vectors]
    index.labels = np.array([float(e[1]) for e, _ in vectors])
    index.weights = np.array([share[e[1]] for e, _ in vectors])
    return index


def relevance(df: np.ndarray, n: list[int]) -> np.ndarray:
    """Association of every term with the labels, in standard deviations (``FLOOR`` at
    least, so no term is without weight); ``df``: its examples of label 0 and 1, of ``n``."""
    if not len(df):
        return np.zeros(0)
    rate = df.sum(axis=1) / max(1, sum(n))
    spread = np.sqrt(n[0] * n[1] / max(1, sum(n)) * rate * (1 - rate))
    z = np.divide(df[:, 1] - n[1] * rate, spread, out=np.zeros(len(df)), where=spread > 0)
    return np.maximum(np.abs(z), FLOOR)


def isotonic(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Points of a non-decreasing curve from raw votes to label rates (pooled adjacent violators)."""
    if len(raw) == 0:
        return np.array([0.0, 1.0]), np.array([prior, prior])
    pools: list[list[float]] = []  # weight, weighted label sum, weighted raw sum
    values, inverse = np.unique(raw, return_inverse=True)
    w, y = np.bincount(inverse, weights), np.bincount(inverse, weights * labels)
    for v, wi, yi in zip(values.tolist(), w.tolist(), y.tolist()):
        pools.append([wi, yi, wi * v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    xs = np.array([p[2] / p[0] for p in pools])
    ys = np.array([(p[1] + prior) / (p[0] + 1.0) for p in pools])
    return xs, np.maximum.accumulate(ys)


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Index:
    """The index that ``learned`` shares, with its curve."""
    shared, curve = learned(docs, labelled, id_col, text_col, label_col)
    return replace(shared.value, curve=curve)


def learned(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[Broadcast, tuple[np.ndarray, np.ndarray]]:
    """Learn the index from ``labelled`` (id, label 0/1) rows whose document is in ``docs``; the
    index as the workers get it, and the curve of the votes that they give its examples.

    Rows with a null id or label are left out; an id with several labels counts
    as toxic if any is 1; a document that stands several times is one example
    (its largest text).  Class totals are counted over all labelled rows; the
    examples are the ``MAX_TOXIC`` and ``MAX_CLEAN`` first rows in hash order.
    """
    marks = labelled.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y"))
    totals = {r["_y"]: r["n"] for r in marks.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = marks.where("_y = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(marks.where("_y = 0").orderBy(*order).limit(MAX_CLEAN))
    sample = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id")  # at most MAX_TOXIC + MAX_CLEAN ids
    sample = cut(sample.groupBy("_id", "_y").agg(F.max("_text").alias("_text")), "toxicity-sample")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ys = b.column(0).to_pylist(), b.column(1)
            got = [list({t for w in set(WORDS.findall(x.lower())) for t in word_terms(w)}) for x in texts]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.string())), ys], names=["t", "y"])

    seen = sample.select("_text", "_y").mapInArrow(tidy(terms), "t array<string>, y int").select(F.explode("t").alias("t"), "y").groupBy("t").agg(F.sum("y").cast("double").alias("d1"), F.sum(1 - F.col("y")).cast("double").alias("d0"))
    found = seen.toArrow()  # bounded: the terms of the sample
    found = found.append_column("n", pa.compute.add(found["d0"], found["d1"])).sort_by([("n", "descending"), ("t", "ascending")])
    words = found["t"].combine_chunks()  # compact; only workers make strings of it
    df = np.stack([found[c].to_numpy() for c in ("d0", "d1")], axis=1)
    del found

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Terms(numbered(words))
        for b in batches:
            c = [[y.astype(np.int32) for y in memo.found(x)] for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([pair[j] for pair in c], pa.list_(pa.int32())) for j in (0, 1))], names=["_id", "_y", "t", "c"])

    id_type = sample.schema["_id"].dataType.simpleString()
    rows = sample.select("_id", "_y", "_text").mapInArrow(tidy(vectors), f"_id {id_type}, _y int, t array<int>, c array<int>").toArrow()  # bounded by the sample
    pairs = [[x.values.to_numpy() for x in rows[c].combine_chunks()] if rows.num_rows else [] for c in "tc"]
    examples = sorted(zip(rows["_id"].to_pylist(), rows["_y"].to_pylist(), *pairs), key=lambda e: str(e[0]))
    del rows, pairs
    index = build_index(words, df, examples, (totals.get(0, 0), totals.get(1, 0)))
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample and the vocabulary

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        number = {i: n for n, i in enumerate(ix.ids)}
        for b in batches:
            own = [number[i] for i in b.column(0).to_pylist()]
            raw = [ix.vote(*got) for got in ix.all_nearest(b.column(1).to_pylist(), own)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(raw, pa.float64())], names=["n", "raw"])

    told = sample.select("_id", "_text").mapInArrow(tidy(votes), "n int, raw double").toArrow().sort_by("n")  # two numbers an example
    return shared, isotonic(told["raw"].to_numpy(), index.labels, index.weights, index.prior)


def toxicity(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 where score >= threshold) and
    ``evidence`` (the nearest labelled examples: id, label, cosine).

    Every row of ``docs`` is scored from its text alone.  A null or empty text,
    or one without index terms, gets the score of a text without evidence.
    Without labelled rows every score is 0.5.  Columns of ``docs`` named like
    the three new ones are replaced; the others are kept as they are.
    """
    shared, curve = learned(docs, labelled, id_col, text_col, label_col)
    kept = [c for c in docs.columns if c not in ("score", "predicted", "evidence")]
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        ix.curve = curve
        blank = ix.score(ix.vote(np.zeros(0, dtype=np.int64), np.zeros(0)))
        ids = pa.array(ix.ids, pa.int64()) if id_type == "bigint" else pa.array([str(i) for i in ix.ids], pa.string())
        labels = pa.array(ix.labels.astype(np.int32))
        for b in (b.slice(lo, BATCH) for b in batches for lo in range(0, b.num_rows, BATCH)):
            near = list(ix.all_nearest(b.column(b.schema.get_field_index(text_col)).to_pylist()))
            s = np.array([ix.score(ix.vote(best, cos)) if len(best) else blank for best, cos in near])
            ends = np.cumsum([0, *(len(best) for best, _ in near)]).astype(np.int32)
            at = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *(best for best, _ in near)]))
            cosines = pa.array(np.concatenate([np.zeros(0), *(cos for _, cos in near)]))
            evidence = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([ids.take(at), labels.take(at), cosines], names=["id", "label", "cosine"]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32)), evidence],
                names=[*kept, "score", "predicted", "evidence"],
            )

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    ev = "array<struct<id: bigint, label: int, cosine: double>>" if id_type == "bigint" else "array<struct<id: string, label: int, cosine: double>>"
    return docs.select(*kept).mapInArrow(tidy(run), f"{schema}, score double, predicted int, evidence {ev}")


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labelled rows that may be learned from: crc32(id) mod 3 is not 1."""
    return labels.where(crc_mod(id_col, 3) != 1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity(docs, learnable(table(spark, sf_dir, "labels")))
    evidence = F.transform("evidence", lambda e: e["id"]).alias("evidence_ids")
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted", evidence)
