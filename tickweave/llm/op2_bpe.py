"""Operator 2, byte-level BPE encoding and decoding.

Spark splits the corpus into its distinct words (matches of the split pattern)
and folds the ranked merges over the byte arrays of the ``FOLDED_WORDS`` most
frequent of them with higher-order functions, looking ranks up in a rank map
(bytes in hex, hashed into small maps) that lies in a table of one row.  These
words cover nearly all of a corpus and go to the workers with the vocabulary; a
worker merges the rarer words of some texts together, by the same ranked merges,
one merge of every word at a time (remembered, bounded).  Decoding concatenates the tokens' bytes; ``round_trip``
does both in one pass.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.spark import cut, table, tidy
from tickweave.llm.text import chunks, mix

FOLDED_WORDS = 32_768  # bound of the table of folded words that goes to the workers
FOLDED_BYTES = 64  # longer words are left to the workers
MEMO_WORDS = 250_000
TOGETHER_BYTES = 1 << 19  # text whose rarer words are merged together
ROWS = 1024  # texts that are Python strings at a time
MERGED_BYTES = 64  # longer words are merged one by one
NO_PAIR = 1 << 40  # beyond every id
RANK_BUCKETS = 16_384

#: Fixed: the split pattern of the rank files, restated for code points up to U+024F.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = " \\t\\n\\x0b\\x0c\\r\\x85\\xa0"
LATIN_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
BEYOND_LATIN = re.compile("[^\\x00-ɏ]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def rank_buckets(ranks: dict[bytes, int]) -> str:
    """The ranks as JSON: an array of small maps from hex bytes to rank."""
    buckets: list[dict[str, int]] = [{} for _ in range(RANK_BUCKETS)]
    for piece, rank in ranks.items():
        h = piece.hex().upper()
        buckets[crc32(h.encode()) % RANK_BUCKETS][h] = rank
    return json.dumps(buckets, separators=(",", ":"))


def rank_map(ranks: dict[bytes, int]) -> Column:
    """``rank_buckets`` as one constant."""
    return F.from_json(F.lit(rank_buckets(ranks)), "array<map<string,int>>")


def rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """``rank_buckets`` in the one row of a table: as a constant they would stand in every copy
    of a plan, and of its description, that the driver keeps."""
    one = spark.createDataFrame([(rank_buckets(ranks),)], "j string")
    return cut(one.select(F.from_json("j", "array<map<string,int>>").alias("ranks")), "bpe-ranks")


def folded(word: Column, ranks: Column) -> Column:
    """Token ids of a word of at least one byte: its bytes folded by ranked merges."""

    def rank(hexed: Column) -> Column:
        return F.element_at(F.get(ranks, F.pmod(F.crc32(hexed.cast("binary")), F.lit(RANK_BUCKETS)).cast("int")), hexed)

    def merge(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.concat(F.get(parts, i - 1), F.get(parts, i)))
        # the best pair: lowest rank, then leftmost; null ranks sort out
        scored = F.filter(F.transform(pairs, lambda x, i: F.struct(rank(x).alias("r"), i.alias("i"), x.alias("x"))), lambda s: s["r"].isNotNull())
        best = F.array(F.array_min(scored))
        joined = F.transform(best, lambda s: F.when(s.isNull(), parts).otherwise(F.concat(F.slice(parts, F.lit(1), s["i"]), F.array(s["x"]), F.slice(parts, s["i"] + 3, F.size(parts)))))
        return F.when(F.size(parts) < 2, parts).otherwise(F.get(joined, F.lit(0)))

    hexed = F.hex(F.encode(word, "UTF-8"))
    n = (F.length(hexed) / 2).cast("int")
    single = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(hexed, i * 2 - 1, F.lit(2)))
    steps = F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.aggregate(steps, single, merge), rank)


def fold(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``w, ids`` of every row of ``words`` (``w``).  A row with the rank map gets many words, so
    that the map is not copied for each."""
    spark = words.sparkSession
    n = 4 * spark.sparkContext.defaultParallelism
    lists = words.groupBy(F.pmod(F.xxhash64("w"), F.lit(n)).cast("int").alias("g")).agg(F.collect_list("w").alias("ws")).repartition(n, "g")
    rows = lists.crossJoin(F.broadcast(rank_table(spark, ranks)))  # one row, a few MB
    ids = F.transform("ws", lambda w: F.struct(w.alias("w"), folded(w, F.col("ranks")).alias("ids")))
    return rows.select(F.explode(ids).alias("f")).select("f.w", "f.ids")


def folded_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str) -> dict[str, list[int]]:
    """Ids of the corpus' most frequent words that are no vocabulary entries, folded in Spark."""
    words = docs.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit("(?U)" + pattern), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    known = cut(docs.sparkSession.createDataFrame(pa.table({"piece": pa.array(list(ranks), pa.binary())})), "bpe-vocabulary")
    rest = words.where(F.octet_length("w").between(2, FOLDED_BYTES)).join(F.broadcast(known), F.col("w").cast("binary") == F.col("piece"), "left_anti")  # the vocabulary's entries
    top = cut(rest.orderBy(F.desc("n"), "w").limit(FOLDED_WORDS).select("w"), "bpe-words")
    return {r["w"]: list(r["ids"]) for r in fold(top, ranks).collect()}  # at most FOLDED_WORDS rows


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranked merges of one word, with a heap over its linked pairs."""
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here; 0: not a start any more
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if mid == 0 or mid >= n or end[mid] != stop or stop - i < 2:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        b = before[i]
        if b >= 0 and (r := ranks.get(word[b:stop])) is not None:
            heapq.heappush(heap, (r, b, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class PairTable:
    """Ids of all pairs of vocabulary entries that join to one, hashed by the two ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.usable = self.bytes.min() >= 0 and len(set(ranks.values())) == len(ranks) and min(ranks.values()) >= 0 and max(ranks.values()) < 1 << 31
        pairs = [(x, y, r) for piece, r in ranks.items() for i in range(1, len(piece)) if (x := ranks.get(piece[:i])) is not None and (y := ranks.get(piece[i:])) is not None]
        left, right, joined = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else [np.zeros(0, np.int64)] * 3
        self.bits = np.uint64(64 - max(4, (2 * len(pairs)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.bits)), -1, np.int64)
        self.ids = np.zeros(len(self.keys), np.int32)
        key = left << 32 | right
        slot = self._slot(key)
        while len(key):  # the first of those that meet in a free slot takes it, the others move on
            first = np.zeros(len(key), dtype=bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.keys[slot] == -1
            self.keys[slot[first]], self.ids[slot[first]] = key[first], joined[first]
            key, joined, slot = key[~first], joined[~first], (slot[~first] + 1) % len(self.keys)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.astype(np.uint64)) >> self.bits).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of each pair's joined bytes (``NO_PAIR``: no entry)."""
        key = left << 32 | right
        out = np.full(len(key), NO_PAIR)
        at, slot = np.arange(len(key)), self._slot(key)
        while len(at):
            there = self.keys[slot]
            hit = there == key[at]
            out[at[hit]] = self.ids[slot[hit]]
            on = ~hit & (there != -1)
            at, slot = at[on], (slot[on] + 1) % len(self.keys)
        return out


def merge_words(words: list[bytes], pairs: PairTable) -> list[bytes]:
    """``merge_word`` of many words of at least one byte (ids as int32 bytes), a merge of every word at a time."""
    size = np.array([len(w) for w in words], np.int64)
    part = pairs.bytes[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), size)
    rank = np.full(len(part), NO_PAIR)  # of a part with the next one of its word
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner] = pairs.joined(part[inner], part[inner + 1])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(part):
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        size = np.diff(np.append(first, len(part)))
        best = np.minimum.reduceat(rank, first)
        ready = best == NO_PAIR
        if ready.any():
            out = np.repeat(ready, size)
            done.append((word[out], part[out]))
            part, word, rank, best, size = part[~out], word[~out], rank[~out], best[~ready], size[~ready]
        at = np.flatnonzero(rank == np.repeat(best, size))
        at = at[np.concatenate(([True], word[at[1:]] != word[at[:-1]]))] if len(at) else at  # the leftmost of the least
        part[at] = best
        gone = np.zeros(len(part), dtype=bool)
        gone[at + 1] = True
        new = np.zeros(len(part), dtype=bool)
        new[at] = True
        new[at[at > 0] - 1] = True
        part, word, rank, new = part[~gone], word[~gone], rank[~gone], np.flatnonzero(new[~gone])
        rank[new] = NO_PAIR
        new = new[new < len(part) - 1]
        new = new[word[new] == word[new + 1]]
        rank[new] = pairs.joined(part[new], part[new + 1])
    word, part = (np.concatenate([x[k] for x in done]) if done else np.zeros(0, np.int64) for k in (0, 1))
    order = np.argsort(word, kind="stable")
    raw = part[order].astype(np.int32).tobytes()
    edge = (4 * np.searchsorted(word[order], np.arange(len(words) + 1))).tolist()
    return [raw[i:j] for i, j in zip(edge[:-1], edge[1:])]


class _Words(dict):
    """word -> ids (as int32 bytes): vocabulary entries, folded words, and remembered merges of the rest."""

    def __init__(self, ranks: dict[bytes, int], folded_ids: dict[str, list[int]]):
        super().__init__()
        self.ranks, self.folded, self.pairs = ranks, folded_ids, PairTable(ranks)
        self._fill()

    def _fill(self) -> None:
        self.update({w: np.array(ids, np.int32).tobytes() for w, ids in self.folded.items()})
        self.fixed = len(self)

    def learn(self, found: set[str]) -> None:
        """Take in the words of some texts."""
        if len(self) > self.fixed + MEMO_WORDS:
            self.clear()
            self._fill()
        rest: list[tuple[str, bytes]] = []
        for w in found.difference(self):
            raw = w.encode()
            if (whole := self.ranks.get(raw)) is not None:
                self[w] = whole.to_bytes(4, "little")
            elif self.pairs.usable and len(raw) <= MERGED_BYTES:
                rest.append((w, raw))
            else:
                self[w] = np.array(merge_word(raw, self.ranks), np.int32).tobytes()
        if rest:
            self.update(zip([w for w, _ in rest], merge_words([raw for _, raw in rest], self.pairs)))


class _Encoder:
    """Encodes the texts of one worker."""

    def __init__(self, ranks_path: str, pattern: str, folded_ids: dict[str, list[int]]):
        import regex

        self.any_text, self.words = regex.compile(pattern), _Words(read_ranks(ranks_path), folded_ids)

    def lists(self, texts: list[str | None]) -> pa.ListArray:
        rows: list[bytes] = []
        texts = [t or "" for t in texts]
        for lo, hi in chunks(texts, TOGETHER_BYTES):
            found = [(self.any_text if BEYOND_LATIN.search(text) else LATIN_PATTERN).findall(text) for text in texts[lo:hi]]
            self.words.learn(set().union(*found))
            rows += [b"".join(map(self.words.__getitem__, f)) for f in found]
        offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _pieces(ranks_path: str) -> pa.LargeBinaryArray:
    """The bytes of every id (null: no such id)."""
    by_id = {i: p for p, i in read_ranks(ranks_path).items()}
    return pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_binary())


def _joined(pieces: pa.LargeBinaryArray, lists: pa.ListArray) -> list[bytes | None]:
    """For every list of ids its pieces' bytes, one after the other (null: null)."""
    joined = pieces.take(lists.flatten())
    if joined.null_count:
        raise ValueError("decode: an id is not in the vocabulary")
    ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, 8 * joined.offset)
    data = joined.buffers()[2]
    at = ends[np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)]
    valid = lists.is_valid().to_pylist()
    if data is None:
        return [b"" if v else None for v in valid]
    return [data[i:j].to_pybytes() if v else None for i, j, v in zip(at[:-1].tolist(), at[1:].tolist(), valid)]


def _schema(df: DataFrame, kept: list[str], made: dict[str, str]) -> str:
    return ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), *(f"{c} {t}" for c, t in made.items())])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>``: every whole text's tokens, each match of ``pattern``
    (the split pattern of the rank files) merged separately, no special tokens.

    A null text counts as empty (no ids).  Repeated and null ids keep their rows;
    other columns are kept, one named ``ids`` is replaced.  ``ranks_path`` is a
    file that every worker can read; it must hold all single bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(folded_words(docs, read_ranks(ranks_path), pattern, text_col))  # at most FOLDED_WORDS words
    kept = [c for c in docs.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(ranks_path, pattern, shared.value)
        for b in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            lists = encoder.lists(b.column(b.schema.get_field_index(text_col)).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), lists], names=[*kept, "ids"])

    return docs.select(*kept).mapInArrow(tidy(run), _schema(docs, kept, {"ids": "array<int>"}))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded binary``: the concatenated bytes of the ids (null ids: null).
    An id outside the vocabulary is an error."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(ranks_path)
        for b in batches:
            got = _joined(pieces, b.column(b.schema.get_field_index(ids_col)))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(got, pa.binary())], names=[*kept, "decoded"])

    return encoded.select(*kept).mapInArrow(tidy(run), _schema(encoded, kept, {"decoded": "binary"}))


#: What ``round_trip`` can return beside ``n_tokens``.
MADE = {"ids": "array<int>", "ids_text": "string", "decoded": "binary", "same": "boolean"}


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, returns: Sequence[str] = ("ids_text", "decoded"), text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: ``docs`` without the text, with
    ``n_tokens long`` and those of ``returns``: ``ids array<int>``, ``ids_text string`` (decimal
    ids joined by commas), ``decoded binary``, ``same boolean`` (decoding gives the text's
    bytes).  Null texts, ids and clashing names as in ``encode``."""
    shared = docs.sparkSession.sparkContext.broadcast(folded_words(docs, read_ranks(ranks_path), pattern, text_col))  # at most FOLDED_WORDS words
    made = {"n_tokens": "bigint"} | {c: MADE[c] for c in returns}
    kept = [c for c in docs.columns if c not in made and c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces = _Encoder(ranks_path, pattern, shared.value), _pieces(ranks_path)
        digits = pa.array([f"{i},".encode() for i in range(len(pieces))], pa.large_binary())
        for b in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            texts = [t or "" for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            for lo, hi in chunks(texts):
                lists = encoder.lists(texts[lo:hi])
                raw = _joined(pieces, lists)
                new = {"n_tokens": lambda: lists.value_lengths().cast(pa.int64()), "ids": lambda: lists}
                new["ids_text"] = lambda: pa.array([x[:-1].decode() for x in _joined(digits, lists)], pa.string())
                new |= {"decoded": lambda: pa.array(raw, pa.binary()), "same": lambda: pa.array([x == t.encode() for x, t in zip(raw, texts[lo:hi])], pa.bool_())}
                old = [b.column(b.schema.get_field_index(c)).slice(lo, hi - lo) for c in kept]
                yield pa.RecordBatch.from_arrays([*old, *(new[c]() for c in made)], names=[*kept, *made])

    return docs.mapInArrow(tidy(run), _schema(docs, kept, made))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
