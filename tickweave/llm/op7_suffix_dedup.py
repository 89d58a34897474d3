"""Operator 7, suffix-array dedup of byte strings repeated across documents.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  Each string (window) picks an anchor, the least
hash of its ``SEED``-byte substrings, so equal windows pick the same anchor; the
consecutive windows of one anchor are its territory.

1. Tasks settle what they can see (equal texts, equal territories) and send the
   rest, packed, to buckets by the anchor's hash.  A bucket settles equal
   territories, and asks for bytes where an anchor occurs in several documents
   with different surroundings.  The first windows of a territory all hold the
   bytes before the anchor too, the others those after it; each half is asked for
   only if these longer strings' hashes meet in several documents as well.
2. These bytes meet by anchor.  Their windows are sorted as suffixes, eight bytes
   at a time, so neighbours that agree over ``LENGTH`` bytes are known by their
   bytes, and each class of equal windows gets the smallest id.  The windows of a
   very frequent half are dealt by their own hash instead.
3. The removed spans meet the texts again, by ranges of a hash of the id.

Bytes are compared in step 2 only.  Territories settled in step 1 are equal by 80
hash bits (32 of the anchor, 48 of the territory); a clash would remove bytes
that stand nowhere else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.op3_jaccard_join import runs
from tickweave.llm.spark import cut, parts, stay_tidy, table, tidy
from tickweave.llm.text import BASE, BYTE_VALUES, U64, chunks, mix, powers

LENGTH = 50
SEED = 20
SLICE = 1 << 20  # longer texts are scanned in overlapping slices
CHUNK = 1 << 18  # bytes of shorter texts that are scanned at a time; a scan takes about 70 bytes each
FLUSH = 400_000  # anchors that a task holds; settling them takes about 100 bytes each
TOGETHER = 512  # texts that are scanned at a time
BUCKET_BYTES = 16 << 20  # text behind one bucket
HOT = 20_000  # halves of one longer string beyond which their windows are dealt one by one
SETTLED = 1 << 18  # territories that a bucket settles at a time, or so
COMPARED = 1 << 19  # windows that are sorted at a time, if no single anchor has more
LOW32 = U64(0xFFFFFFFF)
LEFT, RIGHT = 1, 2  # the halves of a territory
WHOLE, SAME, ASK, ASK_HOT, SPAN = range(5)  # kinds of answers


class Prefix:
    """Polynomial prefix hashes of a buffer: ``of(i, n)`` hashes the n bytes from i."""

    inverse = U64(pow(int(BASE), -1, 1 << 64))
    up = down = np.ones(1, dtype=np.uint64)

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        if len(Prefix.up) <= n:
            Prefix.up, Prefix.down = powers(n + 1), powers(n + 1, Prefix.inverse)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[buf] * Prefix.up[:n], out=self.sums[1:])

    def of(self, i, n) -> np.ndarray:
        return (self.sums[i + n] - self.sums[i]) * Prefix.down[i]


def slices(text: bytes, length: int) -> list[tuple[int, bytes]]:
    """(offset, bytes) of slices that hold every window of ``length`` bytes once."""
    return [(at, text[at : at + SLICE + length - 1]) for at in range(0, max(0, len(text) - length + 1), SLICE)]


class Territories:
    """Territories of the anchors of some texts: text number, first byte, windows, windows of
    the left half, anchor and territory hashes, and the 16-bit hashes of the longer strings
    that all windows of the left (low bits) and of the right half hold (0: no windows)."""

    def __init__(self, texts: list[bytes], length: int):
        cut_up = [(i, at, piece) for i, t in enumerate(texts) for at, piece in slices(t, length)]
        found: list[tuple[np.ndarray, ...]] = []
        lo = 0
        while lo < len(cut_up):
            hi, size = lo, 0
            while hi < len(cut_up) and (hi == lo or size + len(cut_up[hi][2]) <= CHUNK):
                size += len(cut_up[hi][2])
                hi += 1
            found.append(self._scan(cut_up[lo:hi], length))
            lo = hi
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        self.text, self.start, self.windows, self.left, self.seed, self.hash, self.near = (np.concatenate(x) for x in zip(empty, *found))
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    @staticmethod
    def _scan(pieces: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
        seed = min(SEED, length)
        size = np.array([len(p) for _, _, p in pieces])
        buf = np.frombuffer(b"".join(p for _, _, p in pieces) + bytes(length), dtype=np.uint8)
        prefix = Prefix(buf)
        count = len(buf) - seed + 1
        grams = mix((prefix.sums[seed : seed + count] - prefix.sums[:count]) * Prefix.down[:count])
        low = (grams & ~LOW32) | np.arange(count, dtype=np.uint64)  # the leftmost of the least
        have, width = 1, length - seed + 1
        while have < width:
            step = min(have, width - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        end = np.cumsum(size)
        inside = np.ones(int(end[-1]), dtype=bool)
        for j in range(1, length):
            inside[end - j] = False
        window = np.flatnonzero(inside)
        anchor = (low[: len(inside)][inside] & LOW32).astype(np.int64)
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)))
        first = np.flatnonzero(new)
        start, n = window[first], np.diff(np.append(first, len(window)))
        own = mix(prefix.of(start, n - 1 + length) + n.astype(np.uint64)) >> U64(16)
        p = anchor[first]
        before = (length - seed + 1) // 2  # bytes of the left half's string before the anchor
        left = np.clip(p - before - start + 1, 0, n)
        near = np.zeros(len(p), dtype=np.uint64)
        for half, shift, back, more in ((left > 0, 0, before, before), (left < n, 16, 0, length - seed - before + 1)):
            at = p[half] - back
            near[half] |= (mix(prefix.of(at, seed + more)) >> U64(48) | U64(1)) << U64(shift)
        base = np.array([b for _, b, _ in pieces]) - (end - size)
        text = np.array([i for i, _, _ in pieces])
        piece = np.searchsorted(end, start, side="right")
        return text[piece], start + base[piece], n, left, (grams[p] & LOW32).astype(np.uint32), own, near.astype(np.uint32)


# -- packed rows ------------------------------------------------------------------


def small(values: np.ndarray) -> bytes:
    return values.astype(np.uint16 if len(values) == 0 or values.max() < 65536 else np.uint32).tobytes()


def widened(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype(np.int64)


SENT = "bucket int, kind int, seed binary, hash binary, near binary, owner binary, ordinal binary, keys binary, ids binary, dbs binary"
ANSWER = "db int, kind int, n int, owner binary, ordinal binary, stop binary, keys binary"


def packed_owners(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, local = np.unique(keys, return_index=True, return_inverse=True)
    return first, local


def answers(db: np.ndarray, kind: int, key: np.ndarray, ordinal: np.ndarray, stop: np.ndarray | None = None) -> Iterator[dict]:
    """One row per group of texts (``db``) with the answers for them."""
    order = np.argsort(db, kind="stable")
    db, key, ordinal = db[order], key[order], ordinal[order]
    stop = stop[order] if stop is not None else None
    edge = np.append(runs(db), len(db))
    for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
        first, local = packed_owners(key[i:j])
        yield {"db": int(db[i]), "kind": kind, "n": j - i, "owner": small(local), "ordinal": small(ordinal[i:j]), "stop": small(stop[i:j]) if stop is not None else b"", "keys": key[i:j][first].tobytes()}


def read_answers(rows: pa.Table, kinds: tuple[int, ...]) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
    """key -> (kind, ordinals or starts, stops)."""
    out: dict[int, list] = {}
    for r in _each(rows):
        if r["kind"] not in kinds:
            continue
        n = r["n"]
        keys = np.frombuffer(r["keys"], np.int64)
        owner, ordinal = widened(r["owner"], n), widened(r["ordinal"], n)
        stop = widened(r["stop"], n) if r["stop"] else ordinal
        order = np.argsort(owner, kind="stable")
        edge = np.searchsorted(owner[order], np.arange(len(keys) + 1))
        for k, i, j in zip(keys.tolist(), edge[:-1], edge[1:]):
            out.setdefault(k, []).append((r["kind"], ordinal[order[i:j]], stop[order[i:j]]))
    return out


def settle(seed: np.ndarray, own: np.ndarray, owner: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by anchor, territory and id; per ordered row: is an equal territory in a smaller
    id).  Row i is in the document with the id ``ids[owner[i]]``."""
    key = seed.astype(np.uint64)
    key <<= U64(32)
    key |= own >> U64(16)
    order = np.argsort(key)
    key = key[order]
    tied = np.zeros(len(key), dtype=bool)
    tied[1:] = key[1:] == key[:-1]
    del key
    tied[:-1] |= tied[1:]
    some = order[tied]  # only these are not in order yet, and only these can be equal
    some = some[np.lexsort((some, ids[owner[some]], own[some], seed[some]))]
    order[tied] = some
    s, o, d = seed[some], own[some], ids[owner[some]]
    start = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (o[1:] != o[:-1])))) if len(s) else np.zeros(0, np.int64)
    same = np.zeros(len(order), dtype=bool)
    same[tied] = d > np.repeat(d[start], np.diff(np.append(start, len(d))))
    return order, same


class Sender:
    """A task's side of step 1: anchors of the texts it holds (rows of id, key and group, which
    is the key modulo ``buckets``), settled and packed."""

    def __init__(self, buckets: int, length: int):
        self.buckets, self.length = buckets, length
        self.clear()

    def clear(self) -> None:
        self.classes: dict[bytes, list[tuple[int, int, int]]] = {}
        self.found: list[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, texts: list[bytes], rows: list[tuple[int, int, int]]) -> None:
        new, digests = [], []
        for t, row in zip(texts, rows):
            if len(t) < self.length:
                continue
            digest = hashlib.blake2b(t, digest_size=16).digest()
            if digest in self.classes:
                self.classes[digest].append(row)
            else:
                self.classes[digest] = [row]
                new.append(t)
                digests.append(digest)
        got = Territories(new, self.length)
        for i, digest in enumerate(digests):
            a, b = got.first[i], got.first[i + 1]
            self.found.append((digest, got.seed[a:b], got.hash[a:b], got.near[a:b]))
            self.held += int(b - a)

    def flush(self) -> Iterator[dict]:
        if self.found:
            lead = {d: min(rows) for d, rows in self.classes.items()}
            copies = [r for d, rows in self.classes.items() for r in rows if r[0] > lead[d][0]]
            twins = [(r, d) for d, rows in self.classes.items() for r in rows if r[0] == lead[d][0]]  # several rows only where ids repeat
            if copies:
                ids, keys, dbs = (np.array(x, dtype=np.int64) for x in zip(*copies))
                yield from self._direct(dbs, WHOLE, keys, np.zeros(len(keys), np.int64))
            part = {d: arrays for d, *arrays in self.found}
            size = [len(part[d][0]) for _, d in twins]
            seed, own, near = (np.concatenate([part[d][k] for _, d in twins]) for k in range(3))
            which = np.repeat(np.arange(len(twins)), size)
            ordinal = np.arange(len(seed)) - np.repeat(np.cumsum(size) - size, size)
            ids, keys, dbs = (np.array(x, dtype=np.int64) for x in zip(*[r for r, _ in twins]))
            del part
            self.clear()
            order, same = settle(seed, own, which, ids)
            done = order[same]
            if len(done):
                yield from self._direct(dbs[which[done]], SAME, keys[which[done]], ordinal[done])
            send = order[~same]  # by anchor
            bucket = (seed[send].astype(np.uint64) * U64(self.buckets)) >> U64(32)
            edge = np.append(runs(bucket), len(bucket))
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
                at = send[i:j]
                used, local = np.unique(which[at], return_inverse=True)
                h = own[at]
                yield {
                    "bucket": int(bucket[i]), "kind": -1, "seed": seed[at].tobytes(), "hash": (h & LOW32).astype(np.uint32).tobytes() + (h >> U64(32)).astype(np.uint16).tobytes(), "near": near[at].tobytes(),
                    "owner": small(local), "ordinal": small(ordinal[at]), "keys": keys[used].tobytes(), "ids": small(ids[used]) if ids[used].min() >= 0 and ids[used].max() <= LOW32 else ids[used].tobytes(), "dbs": self.buckets.to_bytes(4, "little"),
                }
        self.clear()

    def _direct(self, db: np.ndarray, kind: int, key: np.ndarray, ordinal: np.ndarray) -> Iterator[dict]:
        """Answers that need no bucket's help, passed through one."""
        for r in answers(db, kind, key, ordinal):
            yield {"bucket": int(mix(np.array([r["db"]], np.uint64))[0] % U64(self.buckets)), "kind": kind, "seed": b"", "hash": b"", "near": b"", "owner": r["owner"], "ordinal": r["ordinal"], "keys": r["keys"], "ids": r["n"].to_bytes(8, "little"), "dbs": r["db"].to_bytes(4, "little")}


def _each(table: pa.Table, column: str | None = None) -> Iterator:
    """The rows (or one column's values) of a table, some at a time."""
    for i in range(0, table.num_rows, 16):
        part = table.slice(i, 16)
        yield from part.column(column).to_pylist() if column else part.to_pylist()


def settle_bucket(group: pa.Table, hot_size: int = HOT) -> Iterator[dict]:
    """A bucket's answers: settled territories, and those whose bytes are wanted (ordinals by
    four, with the halves)."""
    total, least, most, groups = 0, 1 << 32, 0, 1
    for r in _each(group):
        if r["kind"] >= 0:
            yield {"db": int.from_bytes(r["dbs"], "little"), "kind": r["kind"], "n": int.from_bytes(r["ids"], "little"), "owner": r["owner"], "ordinal": r["ordinal"], "stop": b"", "keys": r["keys"]}
        elif r["seed"]:
            seed = np.frombuffer(r["seed"], np.uint32)  # in order
            total, least, most, groups = total + len(seed), min(least, int(seed[0])), max(most, int(seed[-1])), int.from_bytes(r["dbs"], "little")
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {SAME: [], ASK: [], ASK_HOT: []}
    edge = np.linspace(least, most + 1, 2 + total // SETTLED).astype(np.int64).tolist() if total else []
    for lo, hi in zip(edge[:-1], edge[1:]):
        for kind, key, ordinal in _settle_range(group, lo, hi, hot_size):
            found[kind].append((key, ordinal))
    for kind, some in found.items():
        if some:
            key, ordinal = (np.concatenate(x) for x in zip(*some))
            yield from answers(key % groups, kind, key, ordinal)


def _settle_range(group: pa.Table, lo: int, hi: int, hot_size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, keys, ordinals) of a bucket's answers for the anchors from ``lo`` to below ``hi``."""
    parts_: list[tuple[np.ndarray, ...]] = []
    ids_, keys_, owners = [], [], 0
    for r in _each(group):
        if r["kind"] >= 0:
            continue
        seed = np.frombuffer(r["seed"], np.uint32)
        n = len(seed)
        part = slice(*np.searchsorted(seed, (lo, hi)).tolist())
        own = np.frombuffer(r["hash"], np.uint32, n)[part].astype(np.uint64) | (np.frombuffer(r["hash"], np.uint16, n, 4 * n)[part].astype(np.uint64) << U64(32))
        key = np.frombuffer(r["keys"], np.int64)
        used, owner = np.unique(widened(r["owner"], n)[part], return_inverse=True)
        keys_.append(key[used])
        ids_.append((np.frombuffer(r["ids"], np.int64) if len(r["ids"]) == 8 * len(key) else widened(r["ids"], len(key)))[used])
        parts_.append((seed[part].copy(), own, np.frombuffer(r["near"], np.uint32)[part].copy(), (owner + owners).astype(np.int32), widened(r["ordinal"], n)[part].astype(np.int32)))
        owners += len(used)
    if not owners:
        return
    seed, own, near, owner, ordinal = (np.concatenate(x) for x in zip(*parts_))
    ids, keys = np.concatenate(ids_), np.concatenate(keys_)
    del parts_, ids_, keys_
    order, same = settle(seed, own, owner, ids)
    done = order[same]
    if len(done):
        yield SAME, keys[owner[done]], ordinal[done].astype(np.int64)
    # Anchors whose territories first occur in different documents, and of these the halves whose
    # longer strings do: their bytes must be compared.
    heads = order[~same]
    s = seed[heads]
    several = np.zeros(len(s), dtype=bool)
    several[1:] = s[1:] == s[:-1]
    several[:-1] |= several[1:]
    heads = heads[several]
    at = heads[_differ(seed[heads], own[heads], ids[owner[heads]])[0]]
    halves = {ASK: np.zeros(len(at), np.int64), ASK_HOT: np.zeros(len(at), np.int64)}
    for half, string in ((LEFT, near[at] & np.uint32(0xFFFF)), (RIGHT, near[at] >> np.uint32(16))):
        some = np.flatnonzero(string)
        key = (seed[at[some]].astype(np.uint64) << U64(16)) | string[some]
        by = np.argsort(key, kind="stable")  # equal territories stay side by side
        some, key = some[by], key[by]
        wanted, size = _differ(key, own[at[some]], ids[owner[at[some]]])
        halves[ASK][some[wanted & (size <= hot_size)]] |= half
        halves[ASK_HOT][some[wanted & (size > hot_size)]] |= half
    for kind, which in halves.items():
        x = at[which > 0]
        if len(x):
            yield kind, keys[owner[x]], 4 * ordinal[x].astype(np.int64) + which[which > 0]


def _differ(group: np.ndarray, own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(per row, does its group have different territories of different ids; the group's size),
    for rows in the order of groups and territories."""
    if not len(group):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    first = runs(group)
    size = np.diff(np.append(first, len(group)))
    found = (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)) & (np.maximum.reduceat(_rank(own, group), first) > 0)
    return np.repeat(found, size), np.repeat(size, size)


def _rank(own: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """1 where a row's territory differs from the one before of the same anchor, else 0."""
    out = np.zeros(len(own), dtype=np.int64)
    out[1:] = (own[1:] != own[:-1]) & (seed[1:] == seed[:-1])
    return out


# -- suffix sorting -----------------------------------------------------------------


def suffix_order(buf: np.ndarray, at: np.ndarray, group: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``at`` by (group, first ``limit`` bytes), and for each in
    that order whether it agrees with the one before over ``limit`` bytes.  Suffixes that
    still agree are sorted by their next eight bytes; ``buf`` has seven bytes after the last."""
    words = np.ndarray((max(0, len(buf) - 7),), dtype=">u8", buffer=buf, strides=(1,))

    def word(of: np.ndarray, done: int) -> np.ndarray:
        return words[of + done].astype(np.uint64) >> U64(8 * max(0, done + 8 - limit))

    key = word(at, 0)
    order = np.lexsort((key, group))
    k, g = key[order], group[order]
    same = np.zeros(len(at), dtype=bool)  # agrees with the one before as far as looked at
    same[1:] = (k[1:] == k[:-1]) & (g[1:] == g[:-1])
    for done in range(8, limit, 8):
        live = same.copy()
        live[:-1] |= same[1:]
        live = np.flatnonzero(live)
        if not len(live):
            break
        which = np.cumsum(~same[live])  # the class of equals
        some = order[live]
        key = word(at[some], done)
        by = np.lexsort((key, which))
        order[live], key = some[by], key[by]
        same[live[1:]] &= key[1:] == key[:-1]
    return order, same


def repeated_windows(seed: np.ndarray, ids: np.ndarray, windows: np.ndarray, data: bytes, length: int) -> np.ndarray:
    """For the windows of all territories in turn: does a territory of the same anchor and
    of a smaller id hold the same window?"""
    buf = np.frombuffer(data + bytes(8), dtype=np.uint8)
    size = windows + length - 1
    byte, number = np.cumsum(size) - size, np.cumsum(windows) - windows
    out = np.zeros(int(windows.sum()), dtype=bool)
    by_anchor = np.argsort(seed, kind="stable")
    ends = np.cumsum(windows[by_anchor])
    edge = np.append(runs(seed[by_anchor]), len(seed))
    lo = 0
    while lo < len(edge) - 1:  # some anchors at a time
        before = ends[edge[lo] - 1] if edge[lo] else 0
        hi = max(lo + 1, int(np.searchsorted(ends[edge[lo + 1 :] - 1], before + COMPARED, side="right")) + lo)
        part = by_anchor[edge[lo] : edge[hi]]
        lo = hi
        n = windows[part]
        head = np.repeat(part, n)
        local = np.arange(len(head)) - np.repeat(np.cumsum(n) - n, n)
        order, same = suffix_order(buf, byte[head] + local, seed[head], length)
        start = np.flatnonzero(~same)
        d = ids[head[order]]
        least = np.repeat(np.minimum.reduceat(d, start), np.diff(np.append(start, len(d))))
        out[(number[head] + local)[order]] = d > least
    return out


WANTED = "bucket int, seed binary, ids binary, keys binary, dbs binary, start binary, windows binary, data binary"


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in fields]))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_size: int = HOT) -> DataFrame:
    """``docs`` with ``kept`` (binary: the UTF-8 bytes that stay, joined), ``kept_text`` (the same
    as text: a code point stays if any of its bytes does), ``spans`` (the maximal
    removed byte ranges, [start, stop)) and ``n_removed``.

    A byte goes if a ``length``-byte string that covers it also starts in a row with
    a strictly smaller id; strings are judged on the input and never cross rows.
    Null texts are empty; texts under ``length`` bytes lose nothing and take nothing.
    Rows with a null id take no part and lose nothing; rows with equal ids do not
    affect each other.  Other columns are kept; those named like the new ones are
    replaced.
    """
    base = [c for c in docs.columns if c not in ("kept", "kept_text", "spans", "n_removed")]
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(parts(docs), -(-size // BUCKET_BYTES))
    d = docs.select(*base).withColumn("__id", F.col(id_col).cast("long")).withColumn("__key", F.xxhash64("__id", text_col))
    d = d.withColumn("__db", F.pmod("__key", F.lit(buckets)).cast("int"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets, length)
        for b in (b.slice(i, TOGETHER) for b in batches for i in range(0, b.num_rows, TOGETHER)):
            sender.add(b.column(3).cast(pa.binary()).to_pylist(), list(zip(*(b.column(i).to_pylist() for i in range(3)))))
            if sender.held > FLUSH:
                yield from _table(list(sender.flush()), SENT).to_batches()
        yield from _table(list(sender.flush()), SENT).to_batches()

    def settle_group(group: pa.Table) -> pa.Table:
        stay_tidy()
        return _table(list(settle_bucket(group, hot_size)), ANSWER)

    sent = d.where(F.col("__id").isNotNull() & F.col(text_col).isNotNull()).select("__id", "__key", "__db", text_col).mapInArrow(tidy(send), SENT)
    told = cut(sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(settle_group, ANSWER), "suffix-answers")
    texts = d.groupBy("__db")

    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        """The bytes that were asked for of one group of texts."""
        stay_tidy()
        asked = read_answers(right, (ASK, ASK_HOT))
        docs_: dict[int, tuple[int, str]] = {}  # of rows with equal id and text one is enough
        for i, key in enumerate(left.column("__key").to_pylist() if asked else []):
            if key in asked and key not in docs_:
                docs_[key] = (left.column("__id")[i].as_py(), left.column(text_col)[i].as_py())
        keys = list(docs_)
        rows: list[tuple] = []  # seed, id, key, start, windows, bytes
        for lo, hi in chunks([t for _, t in docs_.values()], CHUNK):
            raws = [docs_[key][1].encode() for key in keys[lo:hi]]
            mine = Territories(raws, length)
            for i in range(lo, hi):
                key, raw, doc = keys[i], raws[i - lo], docs_[keys[i]][0]
                for kind, ordinal, _ in asked[key]:
                    o, which = mine.first[i - lo] + (ordinal >> 2), ordinal & 3
                    at, n, seed = mine.start[o], mine.windows[o], mine.seed[o]
                    at, n = at + np.where(which == RIGHT, mine.left[o], 0), np.where(which == LEFT, mine.left[o], np.where(which == RIGHT, n - mine.left[o], n))
                    if kind == ASK_HOT:  # each window on its own, dealt by its own hash
                        at = np.repeat(at, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                        n = np.ones_like(at)
                        seed = mix(Prefix(np.frombuffer(raw, np.uint8)).of(at, length)) & LOW32
                    rows += [(s, doc, key, a, m, raw[a : a + m + length - 1]) for s, a, m in zip(seed.tolist(), at.tolist(), n.tolist())]
        if not rows:
            return _table([], WANTED)
        rows.sort(key=lambda r: r[0])
        db = left.column("__db")[0].as_py()
        seed = np.array([r[0] for r in rows], dtype=np.uint32)
        bucket = (seed.astype(np.uint64) * U64(buckets)) >> U64(32)
        edge = np.append(runs(bucket), len(rows)).tolist()
        out = []
        for i, j in zip(edge[:-1], edge[1:]):
            part = rows[i:j]
            out.append({
                "bucket": int(bucket[i]), "seed": seed[i:j].tobytes(), "ids": np.array([r[1] for r in part], np.int64).tobytes(), "keys": np.array([r[2] for r in part], np.int64).tobytes(),
                "dbs": np.full(len(part), db, np.int32).tobytes(), "start": np.array([r[3] for r in part], np.uint32).tobytes(), "windows": np.array([r[4] for r in part], np.uint16).tobytes(), "data": b"".join(r[5] for r in part),
            })
        return _table(out, WANTED)

    def compare(group: pa.Table) -> pa.Table:
        stay_tidy()
        col = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in _each(group, name)])
        seed, ids, keys, dbs, start = col("seed", np.uint32), col("ids", np.int64), col("keys", np.int64), col("dbs", np.int32), col("start", np.uint32).astype(np.int64)
        windows = col("windows", np.uint16).astype(np.int64)
        hit = repeated_windows(seed, ids, windows, b"".join(_each(group, "data")), length)
        which = np.arange(int(windows.sum()))[hit]  # windows, numbered through all heads
        ends = np.cumsum(windows)
        h = np.searchsorted(ends, which, side="right")
        p = start[h] + which - (ends - windows)[h]
        if not len(h):
            return _table([], ANSWER)
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (p[1:] != p[:-1] + 1)))
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(p)) - 1
        return _table(list(answers(dbs[h[at]].astype(np.int64), SPAN, keys[h[at]], p[at], p[last] + length)), ANSWER)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        """The texts of one group without their removed bytes, some at a time."""
        stay_tidy()
        told_ = read_answers(right, (WHOLE, SAME, SPAN))
        size = pa.compute.fill_null(pa.compute.binary_length(left.column(text_col)), 0).to_numpy().astype(np.int64)
        edge = np.append(runs(np.cumsum(size) // (4 * CHUNK)), len(size)).tolist()
        return pa.concat_tables([finish_some(left.slice(i, j - i), told_) for i, j in zip(edge[:-1], edge[1:])] or [finish_some(left, told_)])

    def finish_some(left: pa.Table, told_: dict) -> pa.Table:
        kept, chars, spans, removed = [], [], [], []
        texts_ = left.column(text_col).to_pylist()
        raws = [(t or "").encode() for t in texts_]
        answered = [None if doc is None else told_.get(key) for key, doc in zip(left.column("__key").to_pylist(), left.column("__id").to_pylist())]
        use = [i for i, a in enumerate(answered) if a and any(kind == SAME for kind, _, _ in a)]
        scan, place = Territories([raws[i] for i in use], length), {i: j for j, i in enumerate(use)}
        for i, (raw, text, mine) in enumerate(zip(raws, texts_, answered)):
            if not mine:
                kept.append(raw)
                chars.append(text or "")
                spans.append([])
                removed.append(0)
                continue
            if any(kind == WHOLE for kind, _, _ in mine):
                starts, stops = np.zeros(1, np.int64), np.full(1, len(raw))
            else:
                same = [o for kind, o, _ in mine if kind == SAME]
                starts = [x for kind, x, _ in mine if kind == SPAN]
                stops = [y for kind, _, y in mine if kind == SPAN]
                if same:
                    o = scan.first[place[i]] + np.concatenate(same)
                    starts.append(scan.start[o])
                    stops.append(scan.start[o] + scan.windows[o] + length - 1)
                starts, stops = np.concatenate(starts), np.concatenate(stops)
            cover = np.zeros(len(raw) + 1, dtype=np.int32)
            np.add.at(cover, starts, 1)
            np.add.at(cover, stops, -1)
            gone = np.cumsum(cover)[:-1] > 0
            edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            spans.append([{"start": s, "stop": e} for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist())])
            data = np.frombuffer(raw, np.uint8)
            kept.append(data[~gone].tobytes())
            lead = (data & 0xC0) != 0x80
            if len(data) and not lead.all():
                lost = np.logical_and.reduceat(gone, np.flatnonzero(lead))
                chars.append(data[~lost[np.cumsum(lead) - 1]].tobytes().decode())
            else:
                chars.append(kept[-1].decode())
            removed.append(int(gone.sum()))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        out = left.select(base)
        return out.append_column("kept", pa.array(kept, pa.binary())).append_column("kept_text", pa.array(chars, pa.string())).append_column("spans", pa.array(spans, kind)).append_column("n_removed", pa.array(removed, pa.int64()))

    wanted = texts.cogroup(told.where(F.col("kind").isin(ASK, ASK_HOT)).groupBy("db")).applyInArrow(fetch, WANTED)
    compared = wanted.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(compare, ANSWER)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in base)
    every = told.where(F.col("kind").isin(WHOLE, SAME)).unionByName(compared)
    return texts.cogroup(every.groupBy("db")).applyInArrow(finish, f"{schema}, kept binary, kept_text string, spans array<struct<start: bigint, stop: bigint>>, n_removed bigint")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", n.alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
