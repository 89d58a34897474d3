"""The pipeline's stages, each against a plain version on its own input."""

import corpus_pipeline as pipe
from pyspark.sql import functions as F

from test_pairs import brute_components, brute_repeats
from test_texts import SF


def test_stages(spark):
    import public_tokenizers as P
    import tiktoken

    from tickweave.llm.op2_bpe import read_ranks

    assert [n for n, _ in pipe.STAGES] == ["toxicity", "jaccard_join", "suffix_dedup", "mixing", "bpe"]
    docs = pipe.table(spark, SF, "documents")
    inputs = {}
    for name, stage in pipe.STAGES:
        inputs[name] = docs.toPandas()
        out = pipe.cut(stage(spark, docs, SF), f"test-{name}")
        if name != "bpe":
            assert out.columns == pipe.COLUMNS
        docs = out
    inputs["end"] = docs.toPandas()

    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    kept = set(inputs["jaccard_join"].doc_id)
    clean = [i for i in inputs["toxicity"].doc_id if labels.get(i) == 0]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)

    rows = list(zip(inputs["jaccard_join"].doc_id.tolist(), inputs["jaccard_join"].text.tolist()))
    firsts = {i for i, _, c in brute_components(rows, 5, 80) if i == c}
    assert set(inputs["suffix_dedup"].doc_id) == firsts and len(inputs["suffix_dedup"]) == len(firsts)

    rows = list(zip(inputs["suffix_dedup"].doc_id.tolist(), inputs["suffix_dedup"].text.tolist()))
    gone = {r[0]: r for r in brute_repeats(rows, 50)}
    after = dict(zip(inputs["mixing"].doc_id, inputs["mixing"].text))
    assert set(after) == set(gone)
    for i, t in rows:
        left = gone[i][1] - gone[i][2]
        assert 0 <= len(after[i].encode()) - left <= 6 * gone[i][3]
    assert (inputs["mixing"].n_chars == inputs["mixing"].text.str.len()).all()

    assert set(inputs["bpe"].doc_id) == set(after)
    assert inputs["bpe"].doc_id.value_counts().max() <= 4
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert len(inputs["end"]) == len(inputs["bpe"]) and inputs["end"].round_trip.all()
    for i, ids in zip(inputs["end"].doc_id, inputs["end"].ids):
        assert list(ids) == lib.encode_ordinary(after[i])


def test_run_and_odd_rows(spark, tmp_path):
    base = pipe.table(spark, SF, "documents").select(*pipe.COLUMNS).limit(60)
    odd = spark.createDataFrame([(5000, None, None, None, None), (5001, "", "en", "s", 0), (None, "no id at all", "en", "s", 12), (5002, "twice", "en", "s", 5), (5002, "twice", "en", "s", 5)], base.schema)
    base.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipe.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert {5000, 5001, 5002, None} <= ids and out.where(~F.col("round_trip")).count() == 0
    base.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert pipe.run(spark, f"{tmp_path}/none").count() == 0


def test_distinct_decides_by_text(spark):
    """Of two texts under one id only the near duplicate goes."""
    x, y, z = (" ".join(f"{c}{i}" for i in range(120)) for c in "xyz")
    near = [t.replace("60 ", "q ") for t in (x, y)]
    rows = [(1, x), (5, near[0]), (5, y), (7, near[1]), (8, z), (8, z), (9, ""), (9, None), (None, x)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(pipe.distinct(spark, docs, SF).select("doc_id", "text").collect(), key=str)
    ids = [(r["doc_id"], r["text"]) for r in got if r["text"]]
    assert sorted(ids, key=str) == sorted([(1, x), (5, y), (8, z), (None, x)], key=str)
