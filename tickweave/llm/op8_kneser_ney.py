"""Operator 8, language-model scores: interpolated modified Kneser-Ney.

A bigram model is counted in Spark and kept as sorted arrays in files of the
shared folder, one set per shard: the vocabulary as sorted 64-bit word hashes
with counts (a word's id is its rank), the bigrams as sorted (context id, word
id) keys with counts and, beside each context, its total and its numbers of
words seen once, twice and more often, and the continuation counts.  Workers
memory-map them to count bigrams and to score texts; nothing whole passes
through the driver, and every task merges one shard.  Counts are combined per
task before each shuffle, so a frequent word costs a row a task and successor.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.spark import crc_mod, cut, fresh_path, parts, table
from tickweave.llm.text import U64, chunks, utf8, word_hashes

MOST_WORDS = (1 << 32) - 1  # a bigram key holds two word numbers
END = U64(0xE17A1465C0FFEE01)  # the end token among the word hashes
SHARD_BYTES = 32 << 20  # text behind one shard
CHUNK = 4 << 20
HELD = 3_000_000  # counts that a task holds before it merges them


# -- arrays in the shared folder ------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write under another name, then rename: a retried task leaves whole files only."""
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    own = f"{path}/{name}.{np.random.default_rng().integers(1 << 62)}"
    with store.open_output_stream(own) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    store.move(own, f"{path}/{name}")


def map_array(folder: str, name: str, dtype) -> np.ndarray:
    """The array, memory-mapped: in place where the shared folder is mounted, else from an unlinked local copy."""
    from pyarrow import fs

    store, path = _open(folder)
    size = store.get_file_info(f"{path}/{name}").size
    if not size:
        return np.zeros(0, dtype=dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype=dtype, mode="r")
    local = tempfile.TemporaryFile()
    with store.open_input_stream(f"{path}/{name}") as src:
        while block := src.read(1 << 24):
            local.write(block)
    local.flush()
    return np.memmap(local, dtype=dtype, mode="r")


# -- counting -------------------------------------------------------------------


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each followed by one end; offsets per text (len + 1)."""
    words, first = word_hashes(texts)
    k = len(texts)
    out = np.empty(len(words) + k, dtype=np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(k), np.diff(first))] = words
    out[first[1:] + np.arange(k)] = END
    return out, first + np.arange(k + 1)


class Tally:
    """Sorted distinct keys with counts, merged now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > 2 * HELD and len(self.parts) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        if len(self.parts) > 1:
            keys = np.concatenate([p[0] for p in self.parts])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], np.concatenate([p[1] for p in self.parts])[order]
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.parts = [(keys[start], np.add.reduceat(counts, start))]
        self.held = len(self.parts[0][0])
        return self.parts[0]


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Keys and counts, after a number that says in how many bytes a count stands (4, or 8 if need be)."""
    width = 4 if not len(counts) or int(counts.max()) < 1 << 32 else 8
    return np.uint64(width).tobytes() + keys.astype(np.uint64).tobytes() + counts.astype(f"u{width}").tobytes()


def unpack(payloads: pa.ChunkedArray) -> Tally:
    out = Tally()
    for p in payloads:
        raw = p.as_buffer()
        if len(raw):
            width = int(np.frombuffer(raw, np.uint64, 1)[0])
            n = (len(raw) - 8) // (8 + width)
            out.add(np.frombuffer(raw, np.uint64, n, 8), np.frombuffer(raw, f"u{width}", n, 8 + 8 * n).astype(np.int64))
    return out


def spread(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """One row per shard of sorted keys (``shard`` is non-decreasing)."""
    at = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(at)).tolist():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack(keys[at[s] : at[s + 1]], counts[at[s] : at[s + 1]])], pa.binary())], names=["shard", "payload"])


def hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so ids by rank ascend through them."""
    return ((hashes >> U64(32)) * U64(shards)) >> U64(32)


@dataclass
class Model:
    """Where the arrays are, and the figures that every worker needs."""

    folder: str
    offsets: np.ndarray  # first word id of each shard, and their number at the end
    total: int  # training tokens
    bigrams: tuple[float, ...] = (0.5, 1.0, 1.5)  # discounts for counts 1, 2, 3+
    words: tuple[float, ...] = (0.5, 1.0, 1.5)
    types: int = 0  # distinct bigrams
    back: float = 1.0  # weight of the uniform distribution

    @property
    def size(self) -> int:
        return int(self.offsets[-1])


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of types counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))


class Lookup:
    """The mapped arrays of a model in one worker."""

    def __init__(self, model: Model, scoring: bool):
        self.m = model
        shards = range(len(model.offsets) - 1)
        get = lambda name, kind: [map_array(model.folder, f"{name}-{s}", kind) for s in shards]
        self.hashes = get("vocab-hash", np.uint64)
        if scoring:
            self.counts, self.cont = get("vocab-count", np.uint64), get("cont", np.uint64)
            self.keys, self.grams = get("gram-key", np.uint64), get("gram-count", np.uint64)
            self.total, self.kinds = get("ctx-total", np.uint64), get("ctx-kinds", np.uint64)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct hashes, -1 where unknown."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        at = np.searchsorted(hash_shard(hashes, len(self.hashes)), np.arange(len(self.hashes) + 1))
        for s, own in enumerate(self.hashes):
            h = hashes[at[s] : at[s + 1]]
            if len(h) and len(own):
                pos = np.minimum(np.searchsorted(own, h), len(own) - 1)
                out[at[s] : at[s + 1]] = np.where(own[pos] == h, pos + self.m.offsets[s], -1)
        return out

    def by_id(self, arrays: list[np.ndarray], ids: np.ndarray, width: int = 1) -> np.ndarray:
        """Entries of per-word arrays for sorted ids (ids of -1 and unfilled entries read 0)."""
        out = np.zeros((len(ids), width))
        at = np.searchsorted(ids, self.m.offsets)
        at[-1] = len(ids)  # the begin mark, one past the last word, lies in the last shard
        for s, a in enumerate(arrays):
            part = ids[at[s] : at[s + 1]] - self.m.offsets[s]
            if len(part) and len(a):
                out[at[s] : at[s + 1]] = a.reshape(-1, width)[part]
        return out if width > 1 else out[:, 0]

    def gram_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct bigram keys."""
        out = np.zeros(len(keys))
        edge = np.searchsorted(keys, self.m.offsets.astype(np.uint64) << U64(32))
        edge[-1] = len(keys)
        for s, own in enumerate(self.keys):
            k = keys[edge[s] : edge[s + 1]]
            if len(k) and len(own):
                pos = np.minimum(np.searchsorted(own, k), len(own) - 1)
                out[edge[s] : edge[s + 1]] = np.where(own[pos] == k, self.grams[s][pos], 0)
        return out


def word_ids(look: Lookup, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct hashes' ids, place of every token among them, every token's id)."""
    known, inverse = np.unique(seq, return_inverse=True)
    ids = look.ids(known)
    return ids, inverse, ids[inverse]


def contexts(ids: np.ndarray, first: np.ndarray, begin: int) -> np.ndarray:
    """The id before each token; the begin mark for the first of a text."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[first[:-1]] = begin
    return out


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the model over all rows of ``docs`` (null texts are empty; no rows: a uniform model)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("t"))
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(parts(docs), -(-size // SHARD_BYTES))
    folder = fresh_path(spark, "kneser-ney")
    spread_schema = "shard int, payload binary"

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for b in batches:
            rows = utf8(b.column(0))
            for lo, hi in chunks(rows, CHUNK):
                k, n = np.unique(tokens(rows[lo:hi])[0], return_counts=True)
                tally.add(k, n)
                if tally.held > HELD:  # many distinct words: hand them on
                    k, n = tally.merge()
                    if len(k) > HELD:
                        yield from spread(hash_shard(k, shards), k, n, shards)
                        tally = Tally()
        k, n = tally.merge()
        yield from spread(hash_shard(k, shards), k, n, shards)

    def merge_words(group: pa.Table) -> pa.Table:
        s = group.column("shard")[0].as_py()
        k, n = unpack(group.column("payload")).merge()
        write_array(folder, f"vocab-hash-{s}", k)
        write_array(folder, f"vocab-count-{s}", n.astype(np.uint64))
        return pa.table({"shard": pa.array([s], pa.int32()), "words": pa.array([len(k)], pa.int64()), "tokens": pa.array([int(n.sum())], pa.int64())})

    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(b"").alias("payload"))  # each shard writes its files, empty ones too
    counted = texts.mapInArrow(count_words, spread_schema).unionByName(every).repartition(shards, "shard").groupBy("shard").applyInArrow(merge_words, "shard int, words long, tokens long").collect()  # one row a shard
    words = [0] * shards
    for r in counted:
        words[r["shard"]] = r["words"]
    model = Model(folder, np.concatenate(([0], np.cumsum(words))).astype(np.int64), sum(r["tokens"] for r in counted))
    if model.size >= MOST_WORDS:
        raise ValueError(f"{model.size} distinct words; a bigram's key holds word numbers below {MOST_WORDS}")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, tally = Lookup(model, False), Tally()
        edges = model.offsets.astype(np.uint64) << U64(32)

        def out(k: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield from spread(np.minimum(np.searchsorted(edges[1:], k, side="right"), shards - 1), k, n, shards)

        for b in batches:
            rows = utf8(b.column(0))
            for lo, hi in chunks(rows, CHUNK):
                seq, first = tokens(rows[lo:hi])
                ids = word_ids(look, seq)[2]
                before = contexts(ids, first, model.size)
                k, n = np.unique((before.astype(np.uint64) << U64(32)) | ids.astype(np.uint64), return_counts=True)
                tally.add(k, n)
                if tally.held > HELD:
                    k, n = tally.merge()
                    if len(k) > HELD:
                        yield from out(k, n)
                        tally = Tally()
        yield from out(*tally.merge())

    def merge_grams(group: pa.Table) -> pa.Table:
        s = group.column("shard")[0].as_py()
        k, n = unpack(group.column("payload")).merge()
        lo = int(model.offsets[s])
        width = int(model.offsets[s + 1]) - lo + (s == shards - 1)
        ctx = (k >> U64(32)).astype(np.int64) - lo
        write_array(folder, f"gram-key-{s}", k)
        write_array(folder, f"gram-count-{s}", n.astype(np.uint64))
        write_array(folder, f"ctx-total-{s}", np.bincount(ctx, n, width).astype(np.uint64))
        kinds = [np.bincount(ctx[m], minlength=width) for m in (n == 1, n == 2, n >= 3)]
        write_array(folder, f"ctx-kinds-{s}", np.stack(kinds, axis=1).astype(np.uint64))
        after, types = np.unique(k & U64(0xFFFFFFFF), return_counts=True)
        to = np.searchsorted(model.offsets[1:], after.astype(np.int64), side="right")
        rows = [*spread(to, after, types, shards)]
        stat = np.array([*(int((n == c).sum()) for c in (1, 2, 3, 4)), len(n)], dtype=np.int64).tobytes()
        rows.append(pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([stat], pa.binary())], names=["shard", "payload"]))
        return pa.Table.from_batches(rows)

    def merge_conts(group: pa.Table) -> pa.Table:
        s = group.column("shard")[0].as_py()
        k, n = unpack(group.column("payload")).merge()
        cont = np.zeros(int(model.offsets[s + 1] - model.offsets[s]), dtype=np.uint64)
        cont[k.astype(np.int64) - model.offsets[s]] = n
        write_array(folder, f"cont-{s}", cont)
        stat = np.array([*(int((n == c).sum()) for c in (1, 2, 3, 4)), len(n)], dtype=np.int64).tobytes()
        return pa.table({"stat": pa.array([stat], pa.binary())})

    grams = texts.mapInArrow(count_grams, spread_schema).unionByName(every).repartition(shards, "shard").groupBy("shard").applyInArrow(merge_grams, spread_schema)
    grams = cut(grams, "kneser-ney-rows")
    sums = lambda rows: np.sum([np.frombuffer(r[0], np.int64) for r in rows], axis=0).tolist()
    g = sums(grams.where("shard = -1").select("payload").collect())  # one row a shard
    c = sums(grams.where("shard >= 0").unionByName(every).repartition(shards, "shard").groupBy("shard").applyInArrow(merge_conts, "stat binary").collect())
    model.bigrams, model.words, model.types = discounts(g), discounts(c), g[4]
    d1, d2, d3 = model.words
    model.back = (d1 * c[0] + d2 * c[1] + d3 * (c[4] - c[0] - c[1])) / model.types if model.types else 1.0
    return model


def discounted(n: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
    return np.maximum(n - np.select([n >= 3, n == 2, n == 1], [d[2], d[1], d[0]], 0.0), 0.0)


def score_texts(look: Lookup, texts: list[bytes]) -> list[tuple[int, int, float, float]]:
    """(tokens, known tokens, base score, model score) of each text."""
    m = look.m
    seq, first = tokens(texts)
    uids, inverse, ids = word_ids(look, seq)
    by = np.argsort(uids, kind="stable")
    count = np.zeros(len(uids))
    count[by] = look.by_id(look.counts, uids[by])
    cont = np.zeros(len(uids))
    cont[by] = look.by_id(look.cont, uids[by])
    uniform = 1.0 / (m.size + 1)
    lower = discounted(cont, m.words) / max(m.types, 1) + m.back * uniform
    base = np.log10((count + 0.5) / (m.total + 0.5 * (m.size + 1)))
    before = contexts(ids, first, m.size)
    known = (before >= 0) & (ids >= 0)
    keys, place = np.unique((before[known].astype(np.uint64) << U64(32)) | ids[known].astype(np.uint64), return_inverse=True)
    gram = np.zeros(len(ids))
    gram[known] = look.gram_counts(keys)[place]
    ctx, where = np.unique(before, return_inverse=True)
    total, kinds = look.by_id(look.total, ctx), look.by_id(look.kinds, ctx, 3)
    gamma = np.divide(kinds @ np.array(m.bigrams), total, out=np.ones(len(ctx)), where=total > 0)
    p = gamma[where] * lower[inverse]
    t = total[where]
    p += np.divide(discounted(gram, m.bigrams), t, out=np.zeros(len(t)), where=t > 0)
    log_p = np.log10(p)
    add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has its end token
    return [*zip(np.diff(first).tolist(), add((count > 0)[inverse].astype(np.int64)).tolist(), add(base[inverse]).tolist(), add(log_p).tolist())]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    A null or empty text is its end token alone; null and repeated ids keep their
    rows.  ``base_score`` is the smoothed unigram log10 probability, ``score``
    the model's, ``perplexity`` 10 ** (-score / n_tokens).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(model, True)
        for b in batches:
            rows = utf8(b.column(1))
            for lo, hi in chunks(rows, CHUNK):
                got = score_texts(look, rows[lo:hi])
                n, known, base, own = (np.array(x) for x in zip(*got))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(n), model.total, dtype=np.int64)), pa.array(base.astype(float)), pa.array(own.astype(float)), pa.array(10.0 ** (-own / n))],
                    names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def held_out(id_col: str = "doc_id") -> Column:
    return crc_mod(id_col, 5) == 1


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs.where(~held_out())))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
