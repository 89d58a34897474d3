"""Operator 3, n-gram Jaccard join by token-combination prefixes.

Tokens are a document's distinct word shingles.  Two sets that link share all
but a few (``slack``) tokens of either.  So in any common order of the tokens
they share, within a prefix of each, one token of a rare class or a combination
of two tokens of one part of the frequent class, if the prefix is long enough:
each rare token counts 1, each part of the frequent class its tokens less one,
and the sum must exceed the slack.

1. Equal sets are collapsed by digest.  Sets with more than ``slack`` tokens that
   no other set has cannot link; a round trip over a hash share of the tokens
   finds them, and in most corpora nearly all documents leave here.
2. For the others the tokens' set counts are gathered.  The order is: tokens of no
   other set, rare ones, frequent ones (each by hash); single tokens index the
   rare class, pairs the frequent one.
3. Members of an index entry are verified against its most central set (the one
   with the fewest tokens of its own); verified links make components; then all
   pairs of an entry that are still in different components are verified, so no
   link is lost.  Pairs whose sizes and own tokens rule a link out are skipped.

Token rows travel packed (numpy arrays in binary rows, one per task and bucket).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.components import components
from tickweave.llm.spark import cut, give_back, parts, table, tidy
from tickweave.llm.text import U64, chunks, mix, shingle_sets, utf8

PROBED = 0.4  # share of the token hashes that step 1 looks at
RARE = 8  # sets that have a rare token, at most
PAIRED = 5  # sets of 2**PAIRED tokens and more pair their frequent tokens
CELLS = 32  # cells of a set's token counts, for an upper bound of common tokens
LEAST = 6  # buckets at least
BUCKET_BYTES = 32 << 20  # text behind one bucket of packed tokens
FLUSH = 3_000_000  # tokens that a task packs at a time


def share(x: float) -> np.uint64:
    return U64(int(x * (1 << 64)))


def slack(n, percent: int):
    """Tokens of a set of ``n`` that a linked set may lack."""
    return n * (100 - percent) // 100


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by a mixed hash, independent of the order of the hashes themselves."""
    return ((mix(hashes) >> U64(32)) * U64(buckets)) >> U64(32)


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def long_key(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


class Packer:
    """Collects (token, owner) pairs and hands them out as one binary row per bucket."""

    def __init__(self, buckets: int, narrow: bool = False):
        """``narrow``: hand out 32 bits of a token (for uses in which a clash does no harm)."""
        self.buckets, self.narrow, self.tokens, self.owners, self.held = buckets, narrow, [], [], 0

    def add(self, owner: int, tokens: np.ndarray) -> None:
        self.tokens.append(tokens)
        self.owners.append(owner)
        self.held += len(tokens)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            tokens = np.concatenate(self.tokens)
            which = np.repeat(np.arange(len(self.tokens), dtype=np.uint32), [len(t) for t in self.tokens])
            owners = np.array(self.owners, dtype=np.int64)
            b = bucket_of(tokens, self.buckets)
            order = np.argsort(b, kind="stable")
            tokens, which, at = tokens[order], which[order], np.searchsorted(b[order], np.arange(self.buckets + 1, dtype=np.uint64))
            for i in np.flatnonzero(np.diff(at)).tolist():
                t, w = tokens[at[i] : at[i + 1]], which[at[i] : at[i + 1]]
                t = (mix(t) & U64(0xFFFFFFFF)).astype(np.uint32) if self.narrow else t
                used, local = np.unique(w, return_inverse=True)
                small = local.astype(np.uint16 if len(used) <= 65536 else np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([t.tobytes()], pa.binary()), pa.array([small.tobytes()], pa.binary()), pa.array([owners[used].tobytes()], pa.binary())], names=["bucket", "tokens", "local", "owners"])
        self.__init__(self.buckets, self.narrow)


PACKED = "bucket int, tokens binary, local binary, owners binary"


def unpack(group: pa.Table, kind=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """All (token, owner) pairs of a bucket."""
    tokens, owners = [], []
    for t, w, o in zip(group.column("tokens").to_pylist(), group.column("local").to_pylist(), group.column("owners").to_pylist()):
        own = np.frombuffer(o, np.int64)
        tokens.append(np.frombuffer(t, kind))
        owners.append(own[np.frombuffer(w, np.uint16 if len(own) <= 65536 else np.uint32)])
    return np.concatenate(tokens), np.concatenate(owners)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.zeros(0, dtype=np.int64)


def pair_parts(level: int, percent: int) -> int:
    """Parts of the frequent class for sets of 2**level tokens and more: a few prefix tokens in each."""
    return max(1, (slack(1 << level, percent) + 1) // 3)


def signatures(n: int, tokens: np.ndarray, df: np.ndarray, percent: int, rare_sets: int = RARE) -> np.ndarray:
    """Index entries (64-bit) of a set of ``n`` tokens.

    ``tokens``/``df``: those that other sets have too, and in how many sets they are.
    """
    need = slack(n, percent) + 1 - (n - len(tokens))
    if need <= 0:
        return np.zeros(0, dtype=np.uint64)
    order = np.argsort(tokens)
    tokens, df = tokens[order], df[order]
    rare, frequent = tokens[df <= rare_sets], tokens[df > rare_sets]
    singles = [rare[:need]]
    need -= len(singles[0])
    out = []
    # Every level that a linked set can have: both sets know the level they share.
    levels = range((-(-n * percent // 100)).bit_length() - 1, (n * 100 // percent).bit_length()) if need > 0 else ()
    for level in levels:
        if level < PAIRED or percent < 50:  # too few tokens to spare any: single tokens
            singles.append(frequent[:need])
            continue
        m = pair_parts(level, percent)
        part = mix(frequent ^ U64(0x5851F42D4C957F2D)) % U64(m)
        by = np.argsort(part, kind="stable")
        first = np.zeros(len(frequent), dtype=bool)
        first[by[runs(part[by])]] = True
        got = np.cumsum(~first)
        stop = int(np.searchsorted(got, need)) + 1
        t, p = frequent[:stop], part[:stop]
        by = np.lexsort((t, p))
        t, p = t[by], p[by]
        size = np.diff(np.append(runs(p), len(p)))
        for k in range(1, int(size.max()) if len(size) else 0):  # tokens k apart in a part: in the end all its pairs
            same = np.flatnonzero(p[k:] == p[:-k])
            out.append(mix(mix(t[same] + U64(level + 1)) ^ t[same + k]))
    out.append(mix(np.concatenate(singles) ^ U64(0xA0761D6478BD642F)))
    return np.unique(np.concatenate(out))


def linked(a: bytes, b: bytes, width: int, percent: int) -> bool:
    s, t = shingle_sets([a, b], width)
    common = len(np.intersect1d(s, t, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(s) + len(t) - common)


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: documents link when the Jaccard
    similarity of their sets of ``width``-word shingles is at least ``percent`` / 100;
    the component is the smallest id that links lead to, the document's own included.

    A text with fewer words is one shingle; a null text or one without words has an
    empty set and links with nothing.  Rows with a null id get a null component
    and link with nothing.  Rows with equal ids are one node of the graph (each
    row keeps its own n_shingles).  Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    size = d.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(LEAST, -(-size // BUCKET_BYTES))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = utf8(b.column(1))
            sets = [s for lo, hi in chunks(rows) for s in shingle_sets(rows[lo:hi], width)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.binary())], names=["_id", "n", "key"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen, limit = Packer(buckets, narrow=True), set(), share(PROBED)
        for b in batches:
            rows = utf8(b.column(1))
            for lo, hi in chunks(rows):
                for s in shingle_sets(rows[lo:hi], width):
                    key = long_key(set_key(s))
                    if key not in seen:
                        seen.add(key)
                        pack.add(key, s[: np.searchsorted(s, limit)])
                if pack.held > FLUSH:
                    yield from pack.flush()
                    seen.clear()
        yield from pack.flush()

    def alone(group: pa.Table) -> pa.Table:
        give_back()
        tokens, owners = unpack(group, np.uint32)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        start = runs(tokens)
        low, high = np.minimum.reduceat(owners, start), np.maximum.reduceat(owners, start)
        keys, n = np.unique(low[low == high], return_counts=True)
        part = (mix(keys.view(np.uint64)) % U64(buckets)).astype(np.int64)
        by = np.argsort(part, kind="stable")  # one row for all answers that meet in a task, not one per set
        at = np.searchsorted(part[by], np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(at))
        answers = [keys[by[at[i] : at[i + 1]]].tobytes() + n[by[at[i] : at[i + 1]]].astype(np.int64).tobytes() for i in some]
        return pa.table({"part": pa.array(some, pa.int32()), "answers": pa.array(answers, pa.binary())})

    def add_up(group: pa.Table) -> pa.Table:
        got = [np.frombuffer(x, np.int64).reshape(2, -1) for x in group.column("answers").to_pylist()]
        keys, n = np.concatenate(got, axis=1)
        by = np.argsort(keys, kind="stable")
        start = runs(keys[by])
        return pa.table({"k": pa.array(keys[by][start], pa.int64()), "u": pa.array(np.add.reduceat(n[by], start), pa.int64())})

    described = cut(d.mapInArrow(tidy(describe), "_id long, n long, key binary"), "jaccard-sets")
    single = d.mapInArrow(tidy(probe), PACKED).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(alone, "part int, answers binary")
    single = single.repartition(buckets, "part").groupBy("part").applyInArrow(add_up, "k long, u long")
    lead = described.where("n > 0 and _id is not null").mapInArrow(tidy(_with_long_key), "_id long, n long, key binary, k long").groupBy("key", "n", "k").agg(F.min("_id").alias("rep"))
    alive = cut(lead.join(single, "k", "left").where(F.expr(f"coalesce(u, 0) <= n * {100 - percent} div 100")).select("rep", "n", "key"), "jaccard-alive")

    def own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, set()
        for b in batches:  # of rows with equal ids, those with the set that is meant, and of repeated rows one
            rows, keep = utf8(b.column(1)), []
            keys = [set_key(s) for lo, hi in chunks(rows) for s in shingle_sets(rows[lo:hi], width)]
            for i, key, wanted in zip(b.column(0).to_pylist(), keys, b.column(3).to_pylist()):
                if i != last:
                    last, seen = i, set()
                keep.append(key == wanted and key not in seen)
                seen.add(key)
            yield b.filter(pa.array(keep, pa.bool_()))

    texts = d.hint("merge").join(alive.withColumnRenamed("rep", "_id"), "_id").select("_id", "_text", "n", "key").mapInArrow(tidy(own_text), "_id long, _text string, n long, key binary")
    node = F.xxhash64("_id", "key")
    cand = cut(texts.select(node.alias("node"), "_id", F.col("n").cast("int").alias("n"), "_text"), "jaccard-texts")
    bytes_left = cand.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    few = max(LEAST, -(-bytes_left // BUCKET_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Packer(few)
        for b in batches:
            nodes, rows = b.column(0).to_pylist(), utf8(b.column(1))
            for lo, hi in chunks(rows):
                for i, s in enumerate(shingle_sets(rows[lo:hi], width), lo):
                    pack.add(nodes[i], s)
                if pack.held > FLUSH:
                    yield from pack.flush()
        yield from pack.flush()

    def count(group: pa.Table) -> pa.Table:
        give_back()
        tokens, owners = unpack(group)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        start = runs(tokens)
        n = np.diff(np.append(start, len(tokens)))
        df = np.repeat(n, n)
        keep = df > 1
        tokens, owners, df = tokens[keep], owners[keep], np.minimum(df[keep], 255).astype(np.uint8)
        by = np.argsort(owners, kind="stable")
        tokens, owners, df = tokens[by], owners[by], df[by]
        at = np.append(runs(owners), len(owners))
        return pa.table({"node": pa.array(owners[at[:-1]], pa.int64()), "t": pa.array([tokens[i:j].tobytes() + df[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())})

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column(2).to_pylist()
            for lo in range(0, len(sizes), 1024):
                out, own, at, cells = [], [], [], []
                for i in range(lo, min(lo + 1024, len(sizes))):
                    got = b.column(1)[i].as_py() or []
                    tokens = np.concatenate([np.frombuffer(x, np.uint64, len(x) // 9) for x in got] or [np.zeros(0, np.uint64)])
                    df = np.concatenate([np.frombuffer(x, np.uint8, len(x) // 9, len(x) // 9 * 8) for x in got] or [np.zeros(0, np.uint8)])
                    sig = signatures(sizes[i], tokens, df, percent, rare)
                    if len(sig):  # one row for the set itself, then its entries
                        out += [None, *sig.view(np.int64).tolist()]
                        at += [i] * (len(sig) + 1)
                        own += [sizes[i] - len(tokens)] * (len(sig) + 1)
                        cells += [np.bincount((mix(tokens) >> U64(59)).astype(np.int64), minlength=CELLS).tolist(), *[None] * len(sig)]
                if out:
                    at = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), b.column(0).take(at), b.column(2).take(at), pa.array(own, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], names=["sig", "node", "n", "alone", "cells"])

    answers = cand.select("node", "_text").mapInArrow(tidy(send), PACKED).repartition(few, "bucket").groupBy("bucket").applyInArrow(count, "node long, t binary").groupBy("node").agg(F.collect_list("t").alias("t"))
    rows = cand.select("node", "n").join(answers, "node", "left").select("node", "t", "n")
    index = cut(rows.mapInArrow(tidy(entries), "sig long, node long, n int, alone int, cells array<int>"), "jaccard-index")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [linked(x, y, width, percent) for x, y in zip(utf8(b.column(2)), utf8(b.column(3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    def possible(a: str, b: str, a_own: str, b_own: str):
        """No link is ruled out by the sizes and by the tokens that only one set has."""
        common = F.least(F.col(a) - F.col(a_own), F.col(b) - F.col(b_own))
        return 100 * common >= percent * (F.col(a) + F.col(b) - common)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        one = cand.select(F.col("node").alias("a"), F.col("_text").alias("x")).hint("merge")
        two = cand.select(F.col("node").alias("b"), F.col("_text").alias("y")).hint("merge")
        return cut(pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y").mapInArrow(tidy(verify), "a long, b long, ok boolean"), name)

    entry, sets = index.where("sig is not null"), index.where("sig is null").drop("sig")
    central = F.shiftleft(F.col("alone").cast("long"), 32) + F.col("node").bitwiseAND(F.lit(0xFFFFFFFF))
    lead_of = entry.groupBy("sig").agg(F.min_by("node", central).alias("b"), F.count("*").alias("m")).where("m > 1").drop("m")
    reach = cut(entry.join(lead_of, "sig").select("node", "b").distinct(), "jaccard-reach")  # the centre of an entry reaches its members and itself
    ends = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("alone").alias("ob"))
    stars = cut(reach.where("node <> b").join(sets, "node").join(ends, "b").where(possible("n", "nb", "alone", "ob")).select(F.col("node").alias("a"), "b"), "jaccard-stars")
    first = verified(stars, "jaccard-first")
    label = components(first.where("ok").select("a", "b"))
    # Sets with a centre in common that are still apart (all pairs with an entry in common are among
    # them): verified unless seen already or ruled out by sizes, own tokens or token counts by cell.
    placed = reach.join(sets, "node").join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    mixed = placed.groupBy("b").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("b")
    left = cut(placed.join(mixed, "b"), "jaccard-open")
    other = left.select(F.col("b").alias("b2"), *[F.col(c).alias(f"{c}2") for c in ("node", "n", "alone", "c", "cells")])
    common = sum((F.least(F.get("cells", F.lit(i)), F.get("cells2", F.lit(i))) for i in range(CELLS)), F.lit(0))
    near = 100 * common >= percent * (F.col("n") + F.col("n2") - common)
    meet = (F.col("b") == F.col("b2")) & (F.col("node") > F.col("node2")) & (F.col("c") != F.col("c2")) & possible("n", "n2", "alone", "alone2") & near
    apart = left.join(other, meet).select(F.col("node").alias("a"), F.col("node2").alias("b"))
    seen = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    again = verified(apart.distinct().join(seen, ["a", "b"], "left_anti"), "jaccard-second")
    links = first.where("ok").unionByName(again.where("ok"))
    return _assemble(described, lead, cand, links, id_col, id_type)


def _with_long_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([long_key(x) for x in b.column(2).to_pylist()], pa.int64())], names=["_id", "n", "key", "k"])


def _assemble(described: DataFrame, lead: DataFrame, cand: DataFrame, links: DataFrame, id_col: str, id_type) -> DataFrame:
    """Components over ids: links between set owners, and between the owners of equal sets."""
    ids = cand.select("node", F.col("_id"))
    between = links.join(ids.select(F.col("node").alias("a"), F.col("_id").alias("u")), "a").join(ids.select(F.col("node").alias("b"), F.col("_id").alias("v")), "b").select("u", "v")
    # Equal sets hang on their smallest id.  Where ids do not repeat, a set's component is its owner's.
    owned = described.where("_id is not null").join(lead.select("key", "n", "rep"), ["key", "n"], "left").select("_id", "n", F.coalesce("rep", "_id").alias("rep"))
    several = owned.groupBy("_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("_id")
    twice = owned.join(several, "_id").select(F.col("rep").alias("u"), F.col("_id").alias("v"))
    comp = components(between.unionByName(twice), "u", "v")
    known = owned.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("_id", "n", F.least("_id", F.coalesce("component", "rep")).alias("component_id"))
    nameless = described.where("_id is null").select("_id", "n", F.lit(None).cast("long").alias("component_id"))
    return known.unionByName(nameless).select(F.col("_id").cast(id_type).alias(id_col), F.col("n").alias("n_shingles"), F.col("component_id").cast(id_type))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
