"""Operator 11, SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are code points in one flat numpy array, cut into words wherever the two
neighbouring characters stand side by side in no vocabulary piece (no merge can
cross such a place; the place before a word's space mark is one).  The distinct
words of a chunk of texts become flat symbol arrays.  A round finds the minimum
pair rank of every word (a segmented minimum), merges its leftmost occurrences
at once and compacts the arrays; words without a pair leave, and the rounds end
when none is left.  Occurrences are merged together only up to the first one
whose merge creates a pair of no worse rank, so the result is that of one merge
at a time.  Characters outside the vocabulary become byte pieces.

Decoding takes the pieces' bytes by id and concatenates them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.spark import table
from tickweave.llm.text import chunks

MARK = "▁"  # the visible space of pieces
NO_PAIR = np.int32(2**31 - 1)
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in a model file


class Model:
    """The tables of a SentencePiece BPE model file: identity normalisation, a space mark
    before the text, byte fallback.  Files with other settings are refused."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, train = spec.normalizer_spec, spec.trainer_spec
        kinds = {p.type for p in spec.pieces}
        if train.model_type != 2 or not train.byte_fallback or train.treat_whitespace_as_suffix or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: not a BPE model with byte fallback and plain pieces")
        if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError(f"{path}: normalisation other than identity with a space before the text")
        self.size, self.end = len(spec.pieces), train.eos_id
        normal = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i, p in enumerate(spec.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
        self._characters(normal)
        self._pairs(normal, {i: -p.score for i, p in enumerate(spec.pieces)})
        self._texts(spec.pieces, train.unk_surface)

    def _characters(self, normal: dict[str, int]) -> None:
        letters = sorted({c for p in normal for c in p})
        self.kind_of = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        self.kind_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        outside = (self.size + k for k in range(len(letters)))  # a letter of longer pieces only is a symbol too
        self.symbol = {c: normal[c] if c in normal else next(outside) for c in letters}
        self.letter = {s: c for c, s in self.symbol.items() if s >= self.size}
        self.symbol_of = np.array([-1, *(self.symbol[c] for c in letters)], dtype=np.int64)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        kind = {c: i + 1 for i, c in enumerate(letters)}
        for p in normal:
            for a, b in pairwise(p):
                self.joined[kind[a], kind[b]] = True

    def _pairs(self, normal: dict[str, int], cost: dict[int, float]) -> None:
        order = {c: r for r, c in enumerate(sorted({cost[i] for i in normal.values()}))}
        whole = normal | self.symbol
        self.base = self.size + len(self.letter) + 1
        found = sorted(
            (whole[p[:i]] * self.base + whole[p[i:]], order[cost[to]], to)
            for p, to in normal.items()
            for i in range(1, len(p))
            if p[:i] in whole and p[i:] in whole
        )
        keys, ranks, made = zip(*found) if found else ((-1,), (int(NO_PAIR),), (0,))
        self.keys, self.ranks, self.made = np.array(keys, np.int64), np.array(ranks, np.int32), np.array(made, np.int64)

    def _texts(self, pieces, unknown: str) -> None:
        raw = []
        for p in pieces:
            if p.type == BYTE:
                raw.append(bytes([int(p.piece[3:5], 16)]))
            else:
                raw.append({CONTROL: "", UNKNOWN: unknown}.get(p.type, p.piece.replace(MARK, " ")).encode())
        self.raw = pa.array(raw, pa.large_binary())
        self.silent = np.array([p.type == CONTROL for p in pieces])
        self.is_byte = np.array([p.type == BYTE for p in pieces])
        self.opens = np.array([p.type == NORMAL and p.piece.startswith(MARK) for p in pieces])
        self.digits = pa.array([f"{i} ".encode() for i in range(self.size)], pa.large_binary())

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that two neighbouring symbols make (``NO_PAIR``: none), and its id."""
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR), self.made[at]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes start .. start + size - 1 of every range, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(starts - before, sizes)


def merge_rounds(m: Model, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges all words at once.  ``sym``: their symbols one word after the other, ``sizes``:
    symbols of each word (one at least).  Returns the same of the merged words."""
    sym = sym.copy()
    word = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.append(word[1:] == word[:-1], False)
    rank, made = m.pair(sym, np.append(sym[1:], 0))
    rank = np.where(inner, rank, NO_PAIR)
    over = []
    while len(sym):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        n = np.diff(first, append=len(word))
        least = np.minimum.reduceat(rank, first)
        if (least == NO_PAIR).any():
            live = np.repeat(least != NO_PAIR, n)
            over.append((sym[~live], word[~live]))
            sym, word, rank, made = sym[live], word[live], rank[live], made[live]
            n, least = n[least != NO_PAIR], least[least != NO_PAIR]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(least, n))
        run = np.append(True, np.diff(at) != 1)  # overlapping occurrences stand side by side
        place = np.arange(len(at))
        at = at[(place - place[run][np.cumsum(run) - 1]) % 2 == 0]
        at = together(m, at, sym, word, rank, made)
        sym[at] = made[at]
        stay = np.ones(len(sym), dtype=bool)
        stay[at + 1] = False
        moved = (np.cumsum(stay) - 1)[at]
        sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
        touched = np.zeros(len(sym), dtype=bool)
        touched[moved] = True
        touched[moved[moved > 0] - 1] = True
        again = np.flatnonzero(touched)
        nxt = np.minimum(again + 1, len(sym) - 1)
        r, to = m.pair(sym[again], sym[nxt])
        rank[again] = np.where((word[again] == word[nxt]) & (nxt > again), r, NO_PAIR)
        made[again] = to
    sym, word = (np.concatenate(x) for x in zip(*over)) if over else (sym, word)
    return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(sizes))


def together(m: Model, at: np.ndarray, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, made: np.ndarray) -> np.ndarray:
    """The occurrences of each word that may be merged at once: all up to the first one
    whose merge makes a pair, with the symbol now left or right of it, of no worse rank."""
    w = word[at]
    same = w[1:] == w[:-1]
    several = np.append(same, False) | np.append(False, same)
    if not several.any():
        return at
    here = at[several]
    new = made[here]
    left, right = np.maximum(here - 1, 0), np.minimum(here + 2, len(sym) - 1)
    touching = np.append(False, here[1:] == here[:-1] + 2) & (word[np.maximum(here - 2, 0)] == word[here])
    before = np.where(touching, np.roll(new, 1), sym[left])
    bad = (m.pair(before, new)[0] <= rank[here]) & (word[left] == word[here]) & (here > 0)
    bad |= (m.pair(new, sym[right])[0] <= rank[here]) & (word[right] == word[here]) & (here + 2 < len(sym))
    seen = np.cumsum(bad) - bad  # bad ones before this, over all words
    start = np.flatnonzero(np.diff(word[here], prepend=-1))
    fine = seen == np.repeat(seen[start], np.diff(start, append=len(here)))
    keep = np.ones(len(at), dtype=bool)
    keep[np.flatnonzero(several)[~fine]] = False
    return at[keep]


def encode_texts(m: Model, texts: list[str], end: bool = True) -> pa.ListArray:
    """Ids of every text, followed by the end id if ``end``."""
    marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
    length = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    bounds = np.concatenate(([0], np.cumsum(length)))
    kind = m.kind_of[points]
    start = np.ones(len(points) + 1, dtype=bool)
    if len(points):
        start[1:-1] = ~m.joined[kind[:-1], kind[1:]]
        start[bounds] = True
    starts = np.flatnonzero(start) if len(points) else np.zeros(1, dtype=np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts * 4), pa.py_buffer(points)])
    coded = words.dictionary_encode()
    which, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    ids, sizes = word_ids(m, distinct)
    offset = np.cumsum(sizes) - sizes
    flat = ids[spread(offset[which], sizes[which])]
    per_word = np.concatenate(([0], np.cumsum(sizes[which])))
    ends = per_word[np.searchsorted(starts, bounds)]
    if end:
        flat = np.insert(flat, ends[1:], m.end)
        ends = ends + np.arange(len(ends))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))


def word_ids(m: Model, distinct: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words (code points as bytes), one word after the other, and their numbers."""
    if not len(distinct):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1, 8 * distinct.offset) // 4
    points = np.frombuffer(distinct.buffers()[2], np.uint32)[at[0] : at[-1]].astype(np.int64)
    sym = m.symbol_of[m.kind_of[points]]
    sym = np.where(sym < 0, -1 - points, sym)  # a character of no piece is a word of its own
    sym, sizes = merge_rounds(m, sym, np.diff(at))
    odd = np.flatnonzero((sym < 0) | (sym >= m.size))
    if not len(odd):
        return sym, sizes
    bytes_of = {int(s): m.byte_id[list((chr(-1 - s) if s < 0 else m.letter[s]).encode())] for s in np.unique(sym[odd]).tolist()}
    wide = np.ones(len(sym), dtype=np.int64)
    wide[odd] = [len(bytes_of[s]) for s in sym[odd].tolist()]
    out = np.repeat(sym, wide)
    out[spread((np.cumsum(wide) - wide)[odd], wide[odd])] = np.concatenate([bytes_of[s] for s in sym[odd].tolist()])
    return out, np.add.reduceat(wide, np.cumsum(sizes) - sizes)


def joined(pieces: pa.LargeBinaryArray, lists: pa.ListArray) -> list[bytes | None]:
    """For every list of ids the pieces' bytes, concatenated (null: null)."""
    values = lists.flatten()
    if len(values) and (values.null_count or int(values.to_numpy().min()) < 0 or int(values.to_numpy().max()) >= len(pieces)):
        raise ValueError("an id is not in the vocabulary")
    taken = pieces.take(values)
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
    at = ends[np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)].tolist()
    data = memoryview(taken.buffers()[2]) if taken.buffers()[2] is not None else memoryview(b"")
    return [bytes(data[i:j]) if ok else None for i, j, ok in zip(at[:-1], at[1:], lists.is_valid().to_pylist())]


def readable(raw: bytes) -> str:
    """UTF-8 text; every byte that starts no valid character reads as U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        good = raw[: e.start].decode()
        return good + "�" + readable_rest(raw, e.start + 1)


def readable_rest(raw: bytes, i: int) -> str:
    out = []
    while i < len(raw):
        try:
            out.append(raw[i:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[i : i + e.start].decode() + "�")
            i += e.start + 1
    return "".join(out)


def decode_ids(m: Model, lists: pa.ListArray) -> list[str | None]:
    """The text of every list of ids: control pieces are silent, byte pieces are bytes, and the
    space that was put before the text goes."""
    raw = joined(m.raw, lists)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(values):
        quiet = np.flatnonzero(m.silent[values])
        between = quiet[(quiet > 0) & (quiet < len(values) - 1)]
        if (m.is_byte[values[between - 1]] & m.is_byte[values[between + 1]]).any():
            return [None if x is None else decode_parts(m, x) for x in lists.to_pylist()]
    heard = np.flatnonzero(~m.silent[values]) if len(values) else np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
    begins = np.concatenate(([0], ends[:-1]))
    k = np.searchsorted(heard, begins)
    first = np.append(heard, len(values))[k]
    opens = np.zeros(len(raw), dtype=bool)
    has = first < ends
    opens[has] = m.opens[values[first[has]]]
    return [None if b is None else readable(b[1:] if o else b) for b, o in zip(raw, opens.tolist())]


def decode_parts(m: Model, ids: list[int]) -> str:
    """One list of ids with control pieces between byte pieces: bytes on both sides of a
    control piece make no character together."""
    parts, fresh = [], True
    for quiet, run in groupby(ids, key=m.silent.__getitem__):
        if not quiet:
            piece = list(run)
            raw = b"".join(m.raw.take(pa.array(piece)).to_pylist())
            parts.append(readable(raw[1:] if fresh and m.opens[piece[0]] else raw))
            fresh = False
    return "".join(parts)


def id_texts(m: Model, lists: pa.ListArray) -> list[str | None]:
    """Decimal ids joined by one space."""
    return [None if b is None else b[:-1].decode() for b in joined(m.digits, lists)]


def _with(df: DataFrame, made: dict[str, str], fill) -> DataFrame:
    """``df`` with the columns ``made`` (name -> type; one of the same name is replaced),
    which ``fill`` computes from a batch."""
    kept = [c for c in df.columns if c not in made]
    read = list(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(read.index(c)) for c in kept]
            for lo, hi, new in fill(b, read):
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in cols), *new], names=[*kept, *made])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), *(f"`{c}` {t}" for c, t in made.items())])
    return df.mapInArrow(run, schema)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of a batch of bounded text size, with their texts (null: empty)."""
    texts = [t or "" for t in batch.column(column).to_pylist()]
    for lo, hi in chunks(texts):
        yield lo, hi, texts[lo:hi]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", end: bool = True) -> DataFrame:
    """``docs`` with ``ids array<int>``: every whole text's piece ids, then the end id.

    A null text counts as empty (the end id alone).  Rows with null or repeated ids
    keep one result each, an empty table gives none; other columns are kept, one
    named ``ids`` is replaced.  ``model_path`` is a SentencePiece BPE file that every
    worker can read.
    """

    def fill(b: pa.RecordBatch, read: list[str]):
        m = model(model_path)
        for lo, hi, texts in _texts(b, read.index(text_col)):
            yield lo, hi, [encode_texts(m, texts, end)]

    return _with(docs, {"ids": "array<int>"}, fill)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded string``: the text of the ids (null ids: null); a column of
    that name is replaced.  An id outside the vocabulary is an error."""

    def fill(b: pa.RecordBatch, read: list[str]):
        lists = b.column(read.index(ids_col))
        yield 0, b.num_rows, [pa.array(decode_ids(model(model_path), lists), pa.string())]

    return _with(encoded, {"decoded": "string"}, fill)


def round_trip(docs: DataFrame, model_path: str, text_col: str = "text", end: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: ``docs`` without the text, with
    ``n_tokens long``, ``ids_text string`` (decimal ids joined by one space) and
    ``decoded string``.  Rows and clashing names as in ``encode``."""

    def fill(b: pa.RecordBatch, read: list[str]):
        m = model(model_path)
        for lo, hi, texts in _texts(b, read.index(text_col)):
            lists = encode_texts(m, texts, end)
            yield lo, hi, [lists.value_lengths().cast(pa.int64()), pa.array(id_texts(m, lists), pa.string()), pa.array(decode_ids(m, lists), pa.string())]

    return _with(docs, {"n_tokens": "bigint", "ids_text": "string", "decoded": "string"}, fill).drop(text_col)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
