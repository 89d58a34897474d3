"""Operator 11 against the sentencepiece library."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tickweave.llm import op11_sentencepiece as op
from tickweave.llm.spark import find_package

SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " ", "a", "\x00a", "▁▁", "  x\n\n", "�", "<s></s><0x41>", "a" * 5000, "🙂🙂 x日本語123", " " * 1000, "ab" * 777, "\n\n\n" * 99, "a﻿b", "tabs\t\tx", "İß ﬁ",
    "word " * 30_000, "x" * 100_001,
]


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


@pytest.fixture(scope="module")
def path():
    import public_tokenizers as P

    return P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib(path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def test_encode_and_decode_equal_the_library(spark, path, lib):
    odd = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(ODD)] + [(None, "no id", 1, None), (3, "same id", 1, "x"), (3, "same id", 1, "x")], "doc_id long, text string, ids int, decoded string")
    docs = odd.unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1).alias("ids"), F.lit("y").alias("decoded")))
    rows = op.decode(op.encode(docs, path), path).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["ids"] == lib.encode(r["text"] or "", add_eos=True)
        assert r["decoded"] == lib.decode(r["ids"])
    assert op.encode(docs.limit(0), path).count() == 0


def test_query_digests(spark, path, lib):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op.op11_sentencepiece(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = lib.encode(docs[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_hostile_strings(path, lib):
    """Strings whose pieces overlap in every way: random letters and chains of vocabulary pieces."""
    rnd = random.Random(3)
    pieces = [lib.id_to_piece(i) for i in range(259, lib.get_piece_size())]
    texts = ["".join(rnd.choice("aeionstr lh\n▁中é🙂0") for _ in range(rnd.randint(1, 300))) for _ in range(800)]
    texts += ["".join(rnd.choice(pieces) for _ in range(50)).replace("▁", rnd.choice([" ", "▁", ""])) for _ in range(800)]
    m = op.model(path)
    got = op.encode_texts(m, texts)
    want = lib.encode(texts, add_eos=True)
    assert got.to_pylist() == want
    assert op.decode_ids(m, got) == [lib.decode(i) for i in want]
    assert op.encode_texts(m, texts[:5], end=False).to_pylist() == [lib.encode(t) for t in texts[:5]]


def test_decode_any_ids(path, lib):
    import pyarrow as pa

    rnd = random.Random(4)
    rows = [[rnd.randrange(0, 400) for _ in range(rnd.randint(0, 8))] for _ in range(3000)]
    m = op.model(path)
    assert op.decode_ids(m, pa.array(rows, pa.list_(pa.int32()))) == [lib.decode(r) for r in rows]
    assert op.decode_ids(m, pa.array([None, []], pa.list_(pa.int32()))) == [None, ""]
    with pytest.raises(ValueError, match="vocabulary"):
        op.decode_ids(m, pa.array([[m.size]], pa.list_(pa.int32())))


def test_other_models_are_refused(tmp_path, path):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(open(path, "rb").read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="normalisation"):
        op.Model(str(tmp_path / "m.model"))
