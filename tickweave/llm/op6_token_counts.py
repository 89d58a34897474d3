"""Operator 6, token counts by the whole-token shortcut.

The vocabulary's strings that the merges turn into one single token are proved
once ("offline", on the driver, by running the merges on each of them).  A text
is normalised and split into pre-tokens; a pre-token in the proved set counts
one, and only the others are merged (memoised per worker, bounded).  Counts are
those of the tokenizers library without begin, end or other added tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickweave.llm.spark import table

MEMO_WORDS = 500_000  # bound of a worker's memo of merged pre-tokens; it is emptied when full

#: Fixed: the split pattern of word_bpe_49k.json, restated for the letters and digits up to U+024F.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = " \t\n\x0b\x0c\r\x85\xa0"
LATIN_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
BEYOND_LATIN = re.compile("[^\\x00-ɏ]")


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


def whole_tokens(path: str) -> set[str]:
    """Pre-tokens (as text) that provably encode alone as one token: every vocabulary
    string with the word end mark is merged from its bytes and kept if one token is left."""
    tok = load(path)
    mark = tok.model.end_of_word_suffix or ""
    back = {c: b for b, c in byte_letters().items()}
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    out = set()
    for piece in tok.get_vocab(with_added_tokens=True):
        if piece in special or not piece.endswith(mark) or len(piece) == len(mark):
            continue
        letters = piece[: len(piece) - len(mark)]
        if all(c in back for c in letters) and len(tok.model.tokenize(letters)) == 1:
            try:
                out.add(bytes(back[c] for c in letters).decode())
            except UnicodeDecodeError:
                pass  # no text has these bytes as a pre-token
    return out


class _Counts(dict):
    """Token count of a pre-token; those not proved single are merged and remembered."""

    def __init__(self, single: set[str], model):
        super().__init__(dict.fromkeys(single, 1))
        self.model, self.fixed = model, len(single)
        self.single, self.letters = single, byte_letters()

    def __missing__(self, word: str) -> int:
        if len(self) > self.fixed + MEMO_WORDS:
            self.clear()
            self.update(dict.fromkeys(self.single, 1))
        n = len(self.model.tokenize("".join(map(self.letters.__getitem__, word.encode()))))
        self[word] = n
        return n


def counter(path: str, single: set[str]):
    """A function text -> number of tokens."""
    import regex

    tok = load(path)
    counts = _Counts(single, tok.model)
    special = [t.content for t in tok.get_added_tokens_decoder().values() if t.special]
    cut = re.compile("|".join(map(re.escape, special))) if special else None
    any_split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    normal = tok.normalizer.normalize_str

    def plain(text: str) -> int:
        lower = text.lower()
        if BEYOND_LATIN.search(text) or BEYOND_LATIN.search(lower):  # some letters leave the range when lowered
            words = any_split.findall(normal(text))
        else:  # such text is NFC already, and every kind of space only splits
            words = LATIN_SPLIT.findall(lower)
        return sum(map(counts.__getitem__, words))

    def count(text: str) -> int:
        if cut is None or "<|" not in text and not cut.search(text):
            return plain(text)
        pieces = cut.split(text)  # each special string in a text is one token
        return len(pieces) - 1 + sum(map(plain, pieces))

    return count


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` (n_tokens > limit) of every row.

    A null text counts as empty (0 tokens), rows with a null or repeated id keep
    one result row each, an empty table gives none; other columns are not read.
    ``tokenizer`` is the path of a byte-level BPE ``tokenizers`` file with word
    ends, readable on every worker.
    """
    single = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))  # at most the vocabulary
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer, single.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
