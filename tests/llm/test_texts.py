"""Tokenizers, language model, toxicity, HTML and mixing against brute force, libraries and SQL."""

import math
import pathlib
import pickle
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import op1_mixing as mixing
from tickweave.llm import op2_bpe as bpe
from tickweave.llm import op6_token_counts as counts
from tickweave.llm import op8_kneser_ney as lm
from tickweave.llm import op9_toxicity as tox
from tickweave.llm.op10_html_text import extract_text, render
from tickweave.llm.spark import find_package

DOC = "doc_id long, text string"
SF = "/root/testdata/sf0.001"
ODD = [
    "", None, "a<|endoftext|>b <|startoftext|>", "İstanbul ΑΣ ς ﬁ é x y 日本語123 ½²", "it's we'LL I'M  \x85 \x1c\x1d q", "a" * 5000, "🙂🙂 x", "K Å ǅ ß ẞ", "<|end <|x|>",
    "tabs\t\tand\n\n\nlines  \r\n end   ", "don't DON'T 's", "  lead", "trail  ", "  nb　sp", "1234567 12 ³", " sep ",
]


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


def test_bpe_equals_the_library_and_round_trips(spark):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], "doc_id long, text string, ids int").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1).alias("ids")))
    rows = bpe.decode(bpe.encode(docs, path, P.PATTERN), path).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["ids"] == lib.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(docs.limit(0), path, P.PATTERN).count() == 0


def test_bpe_round_trip_in_one_pass(spark):
    import hashlib

    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(ODD)] + [(None, "word " * 60_000, 1, "x"), (3, "same", 1, None)], "doc_id long, text string, n_tokens int, decoded string")
    rows = bpe.round_trip(docs, path, P.PATTERN, ("ids", "ids_text", "decoded", "same")).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == len(ODD) + 3  # id 3 stands twice on both sides
    for r in rows:
        if r["doc_id"] != 3:
            ids = lib.encode_ordinary(r["text"] or "")
            assert (r["ids"], r["n_tokens"], r["ids_text"], bytes(r["decoded"]), r["same"]) == (ids, len(ids), ",".join(map(str, ids)), (r["text"] or "").encode(), True)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in bpe.op2_bpe(spark, SF).collect():
        ids = lib.encode_ordinary(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_restated_split_pattern_equals_the_real_one():
    import public_tokenizers as P
    import regex

    real, rnd = regex.compile(P.PATTERN), random.Random(7)
    letters = [chr(c) for c in range(0x250)]
    for _ in range(4000):
        text = "".join(rnd.choice(letters if rnd.random() < 0.5 else " \n'stRe19ld.é\xa0\x85") for _ in range(rnd.randint(0, 40)))
        assert bpe.LATIN_PATTERN.findall(text) == real.findall(text)


def test_bpe_folds_in_spark(spark):
    import public_tokenizers as P

    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    words = [" thandredle", "ouxié", "aaaaaaaaaaab", " q", "zzxyqq", "日本", "a"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", bpe.folded(F.col("w"), bpe.rank_map(ranks)).alias("ids")).collect()
    assert {r["w"]: r["ids"] for r in got} == {w: bpe.merge_word(w.encode(), ranks) for w in words}


def test_bpe_rank_map_is_no_part_of_a_plan(spark):
    """The driver keeps plans and their descriptions: the vocabulary stands in none of them."""
    import public_tokenizers as P

    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    words = [f" thand{a}{b}le" for a in "abcdefgh" for b in "qrstuvxz"] + ["日本", "a"]
    out = bpe.fold(spark.createDataFrame([(w,) for w in words], "w string"), ranks)
    assert len(out._jdf.queryExecution().toString()) < 200_000
    assert {r["w"]: list(r["ids"]) for r in out.collect()} == {w: bpe.merge_word(w.encode(), ranks) for w in words}


def test_bpe_merges_the_rarer_words_of_some_texts_together(monkeypatch):
    import public_tokenizers as P

    path, r = P.path("byte_bpe_multi_50k.tiktoken"), random.Random(21)
    ranks, one = bpe.read_ranks(path), bpe.merge_word
    words = ["".join(r.choices("aerntioß hs日", k=r.randrange(1, 20))).strip() or "x" for _ in range(3000)] + ["a" * n for n in range(1, 80)] + ["日" * 30, "thandredle" * 20]
    got = bpe.merge_words([w.encode() for w in words], bpe.PairTable(ranks))
    assert [np.frombuffer(g, np.int32).tolist() for g in got] == [one(w.encode(), ranks) for w in words]
    alone = []
    monkeypatch.setattr(bpe, "merge_word", lambda word, ranks: alone.append(word) or one(word, ranks))
    monkeypatch.setattr(bpe, "MEMO_WORDS", 500)
    monkeypatch.setattr(bpe, "TOGETHER_BYTES", 2000)
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)] + ["", None]
    found = bpe._Encoder(path, P.PATTERN, {}).lists(texts).to_pylist()
    assert alone and all(len(w) > bpe.MERGED_BYTES for w in alone)
    import regex

    split = regex.compile(P.PATTERN)
    assert found == [[i for w in split.findall(t or "") for i in ([ranks[w.encode()]] if w.encode() in ranks else one(w.encode(), ranks))] for t in texts]


def test_bpe_with_any_vocabulary():
    """Pairs of every kind, ties and overlaps included; one that lacks bytes goes word by word."""
    r = random.Random(4)
    for n in (0, 5, 60):
        ranks = {bytes([i]): i for i in range(256)}
        for _ in range(n):
            piece = r.choice([p for p in ranks if p.isalpha() and len(p) < 6 and p[:1] in b"abc"]) + r.choice(b"abc").to_bytes(1, "big")
            ranks.setdefault(piece, len(ranks))
        words = ["".join(r.choices("abc", k=r.randrange(1, 30))).encode() for _ in range(500)]
        got = bpe.merge_words(words, bpe.PairTable(ranks))
        assert [np.frombuffer(g, np.int32).tolist() for g in got] == [bpe.merge_word(w, ranks) for w in words]
    few = bpe._Words({b"a": 0, b"b": 1, b"ab": 2}, {})
    few.learn({"abab", "ba"})
    assert {w: np.frombuffer(x, np.int32).tolist() for w, x in few.items()} == {"abab": [2, 2], "ba": [1, 0]}


def test_token_counts_equal_the_library(spark):
    import public_tokenizers as P

    path = P.path("word_bpe_49k.json")
    lib = counts.load(path)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "same id")], DOC).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = Counter(tuple(r) for r in counts.token_counts(docs, path).collect())
    want = Counter()
    for r in docs.collect():
        t = r["text"] or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        want[(r["doc_id"], len(t.encode()), n, n > 2048)] += 1
    assert got == want
    assert counts.token_counts(docs.limit(0), path).count() == 0


def test_token_counts_of_letters_that_leave_the_range_when_lowered():
    import public_tokenizers as P

    path = P.path("word_bpe_49k.json")
    lib, count = counts.load(path), counts.counter(path, counts.whole_tokens(path))
    odd = [c for c in map(chr, range(0x250)) if any(ord(x) > 0x24F for x in c.lower())]
    assert len(odd) >= 20
    for c in odd:
        for w in (c, f"wor{c}king", f"information{c} {c}a", f"{c}1{c}", f"x'{c} don't{c}"):
            assert count(w) == len(lib.encode(w, add_special_tokens=False).ids), w


def test_whole_tokens_are_proved():
    import public_tokenizers as P

    path = P.path("word_bpe_49k.json")
    lib, single = counts.load(path), counts.whole_tokens(path)
    assert len(single) > 30_000
    for w in random.Random(1).sample(sorted(single), 500):
        if len(counts.LATIN_SPLIT.findall(w)) == 1 and w == w.lower():
            assert len(lib.encode(w, add_special_tokens=False).ids) == 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def brute_model(train):
    uni, grams = Counter(), Counter()
    for t in train:
        w = words(t)
        uni.update(w)
        grams.update(zip(["<s>", *w], w))
    cont = Counter(b for _, b in grams)
    ctx = {}
    for (a, _), n in grams.items():
        ctx.setdefault(a, []).append(n)
    kinds = lambda c: [sum(1 for n in c if n == k) for k in (1, 2, 3, 4)]
    d2, d1 = lm.discounts(kinds(grams.values())), lm.discounts(kinds(cont.values()))
    disc = lambda n, d: max(n - d[min(n, 3) - 1], 0) if n else 0
    size, types, total = len(uni), len(grams), sum(uni.values())
    back = sum(d1[min(n, 3) - 1] for n in cont.values()) / types if types else 1.0

    def p(a, b):
        low = (disc(cont[b], d1) / types if types else 0) + back / (size + 1)
        if a not in ctx:
            return low
        t = sum(ctx[a])
        return disc(grams[a, b], d2) / t + sum(d2[min(n, 3) - 1] for n in ctx[a]) / t * low

    def score(text):
        w = words(text)
        base = sum(math.log10((uni[x] + 0.5) / (total + 0.5 * (size + 1))) for x in w)
        return len(w), sum(uni[x] > 0 for x in w), total, base, sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], w))

    return score, p, uni


def test_kneser_ney_equals_brute_force(spark):
    r = random.Random(4)
    texts = [" ".join(r.choices(["The", "the", "of", "a", "cat", "dog", "sat", "é", "on"], weights=range(9, 0, -1), k=r.randrange(25))) for _ in range(120)] + ["", None, "unseen words here", "the\tof\n"]
    rows = list(enumerate(texts)) + [(None, "the cat")]
    docs = spark.createDataFrame(rows, DOC)
    model = lm.train(docs.where(~lm.held_out()))
    got = lm.score(docs, model).collect()
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    score, p, uni = brute_model(train)
    want = {i: score(t) for i, t in rows}
    assert len(got) == len(rows)
    for g in got:
        n, known, total, base, own = want[g["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (n, known, total)
        assert g["base_score"] == pytest.approx(base, rel=1e-9) and g["score"] == pytest.approx(own, rel=1e-9)
    for a in ("the", "<s>", "cat", "never"):  # a distribution over the vocabulary and one unknown word
        assert sum(p(a, b) for b in uni) + p(a, "never seen") == pytest.approx(1.0)


def test_kneser_ney_counts_beyond_32_bits():
    import pyarrow as pa

    keys, small, large = np.array([3, 9], np.uint64), np.array([1, 2]), np.array([2**32 + 5, 2**40])
    rows = pa.chunked_array([pa.array([lm.pack(keys, small), b"", lm.pack(keys, large), lm.pack(keys[:0], small[:0])], pa.binary())])
    k, n = lm.unpack(rows).merge()
    assert k.tolist() == [3, 9] and n.tolist() == [2**32 + 6, 2**40 + 2]
    assert len(lm.pack(keys, small)) == 8 + 2 * 12


def test_kneser_ney_without_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOC)
    got = {r["doc_id"]: r for r in lm.score(docs, lm.train(docs.limit(0))).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["score"] == 0.0 and got[2]["n_tokens"] == 1


def test_toxicity_learns_and_nearest_is_exact(spark):
    r = random.Random(8)
    plain = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        w = r.choices(plain, k=40)
        for _ in range(r.randrange(3, 6) if bad else 0):
            w[r.randrange(40)] = "grublek" + r.choice(["en", "ia", "or", "us"])
        rows.append((i, " ".join(w), "x"))
        if i < 200:
            labels.append((i, int(bad)))
    rows += [(900, "", "x"), (901, None, "x"), (902, "1234 !!", "x"), (None, "word1 word2", "x")]
    labels += [(7, None), (None, 1), (99_999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = tox.toxicity(docs, lab)
    assert out.columns == ["doc_id", "text", "score", "predicted", "evidence"]
    got = out.collect()
    assert len(got) == len(rows)
    for g in got:
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.7)
        if g["doc_id"] is not None and 200 <= g["doc_id"] < 900:
            assert g["predicted"] == int(g["doc_id"] % 4 == 0)
    index = tox.fit(docs.drop("score"), lab)
    memo = tox.Terms(index.vocabulary)
    dense = np.zeros((len(index.ids), len(index.vocabulary)))
    for e in range(len(index.ids)):
        counted = memo.counts(rows[index.ids[e]][1])
        t, w = index.vector(counted)
        dense[e, t] = w
    for i in range(200, 260):
        t, w = index.vector(memo.counts(rows[i][1]))
        best, cos = index.nearest(t, w)
        full = dense[:, t] @ w
        want = np.lexsort((np.arange(len(full)), -np.round(full, 9)))[: tox.NEIGHBOURS]
        assert np.allclose(cos, full[want][: len(cos)]) and (len(cos) == tox.NEIGHBOURS or (full > 0).sum() == len(cos))


def test_toxicity_kind_with_few_labels(spark):
    """Words that stand in a handful of labelled toxic rows are evidence too."""
    r = random.Random(12)
    plain = [f"word{i}" for i in range(400)]
    kinds = [([f"grub{c}" for c in "abcdef"], 40), ([f"zyxo{c}" for c in "abcdef"], 6)]
    rows, labels = [], []

    def add(extra, label):
        rows.append((len(rows), " ".join(r.sample(plain, 20) + r.sample(extra, min(5, len(extra))))))
        if label is not None:
            labels.append((rows[-1][0], label))

    for words, n in kinds:
        for _ in range(n):
            add(words, 1)
    for _ in range(150):
        add([], 0)
    first = len(rows)
    for _ in range(10):
        add(kinds[1][0], None)
        add([], None)
    out = tox.toxicity(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = dict(out.select("doc_id", "predicted").collect())
    assert [got[i] for i in range(first, len(rows))] == [1, 0] * 10
    index = tox.fit(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"zyxoa", "#^zyx", "word"} <= set(index.vocabulary)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOC)
    got = tox.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert [g["score"] for g in got] == [0.5, 0.5] and tox.toxicity(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


HTML = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two <b>bold</b>er", "one\n\ntwo bolder"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>x<li>y</ol>z", "9. x\n10. y\n\nz"),
    ("<table><tr><th>Name<th>N<tr><td>abc<td>10</table>", "Name  N\nabc   10"),
    ("<table><tr><td>a<br>b<td>c<tr><td colspan=2>wide<td>d</table>", "a     c\nb\nwide     d"),
    ("<head><title>t</title></head><body>x<script>if (a < b) '</p>'</script><style>p{}</style>y", "xy"),
    ("<div hidden>n</div><div style='display:none'>n</div><div style='visibility:hidden'>n<i style='visibility:visible'>v</i></div>", "v"),
    ("a<br>b<hr>c", "a\nb\n\nc"),
    ("<pre> x\n  y</pre>z", " x\n  y\n\nz"),
    ("<!-- c -->t<!doctype html><?pi?>u", "tu"),
    ("a < b > c <3", "a < b > c <3"),
    ("<td>no table</td>", "no table"),
    ("<table>before<tr><td>in</table>", "before\n\nin"),
    ("<p title='a>b'>q</p><p class=\"open>r", "q\n\n"),
    ("<blockquote>q</blockquote><dl><dt>t<dd>d</dl>", "    q\n\nt\n    d"),
    ("<textarea>a\n b</textarea><input type=hidden value=v>", "a\n b"),
    ("<b><p>x</b>y</p>z", "xy\n\nz"),
    ("</div></p>x</br>y", "x\ny"),
]


@pytest.mark.parametrize("html,text", HTML)
def test_render(html, text):
    got = render(html)
    assert got.strip("\n") == text.strip("\n") or html.endswith('open>r') and got.startswith("q")


def test_render_deep_and_hostile_pages_in_bounded_time():
    assert render("<div>" * 30_000 + "x").strip() == "x"
    assert render("<a " + '"' * 20_000).strip().startswith("<a")
    assert render("<" * 20_000 + "x").endswith("x")


def test_extract_text_rows(spark):
    rows = [(1, "<p>a", 1), (1, "<p>a", 2), (2, None, 3), (None, "x", 4)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, html string, text int")).collect()
    assert Counter(map(tuple, got)) == Counter([(1, "a"), (1, "a"), (2, ""), (None, "x")])
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_extract_text_keeps_every_visible_word(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    from html import unescape

    for r in extract_text(pages).join(pages, "page_id").collect():
        body = re.sub(r"(?is)<!--.*?-->|<(script|style|title|head)\b.*?</\1>", " ", r["html"] or "")
        want = Counter(re.findall(r"\w+", unescape(re.sub(r"<[^>]*>", " ", body))))
        got = Counter(re.findall(r"\w+", r["text"]))
        assert sum((want - got).values()) <= 0.02 * sum(want.values())


def test_mixing_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.execute(mixing.OP1_SQL).fetchall()
    assert sorted(map(tuple, mixing.op1_mixing(spark, SF).collect())) == sorted(want)


def test_mixing_meets_its_targets(spark):
    rows = [(i, "w " * 50, "big" if i % 10 else "small") for i in range(1000)] + [(2000 + i, "v " * 7, None) for i in range(40)] + [(3000, None, "void"), (None, "w w", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_copy", F.lit("clash"))
    out = mixing.mix_sources(docs, target_entropy=0.9, max_repeat=None, cover=True)
    assert out.columns == ["doc_id", "text", "source", "mix_tokens", "mix_copy", "mix_block", "mix_rank"]
    got = out.groupBy("source").agg(F.sum("mix_tokens").alias("t"), F.max("mix_copy").alias("c"), F.countDistinct("doc_id").alias("d")).collect()
    by = {r["source"]: r for r in got}
    total = sum(r["t"] for r in got)
    entropy = -sum(r["t"] / total * math.log(r["t"] / total) for r in got if r["t"])
    assert entropy >= 0.9 * math.log(3) - 0.01
    assert (by["big"]["d"], by["small"]["d"], by[None]["d"], by["void"]["c"]) == (900, 100, 40, 1)
    limited = mixing.mix_sources(docs, target_entropy=1.0, max_repeat=2.0)
    most = limited.groupBy("source").agg(F.max("mix_copy").alias("c"), F.sum("mix_tokens").alias("t")).collect()
    assert max(r["c"] for r in most) == 2 and sum(r["t"] for r in most) <= 50 * 1000 + 7 * 40 + 2
    fixed = mixing.mix_sources(docs, budget=1000)
    assert fixed.agg(F.sum("mix_tokens")).first()[0] <= 1002
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert sorted(map(str, mixing.mix_sources(docs).collect())) == sorted(map(str, mixing.mix_sources(docs.repartition(7)).collect()))


def test_toxicity_index_has_flat_postings_and_a_compact_vocabulary(spark):
    """Whoever builds the index makes no strings of its vocabulary, and its size does not grow with
    examples x terms: a pointer per term, a posting per example and rare term."""
    rows = [(i, " ".join(f"{a}{b}{c}" for a, b, c in zip(("ab", "cd", "ef")[i % 3] * 9, "abcdefghijklmnopqr", "x" * 18)) + " " + "".join(chr(97 + int(d)) for d in str(i * 7919))) for i in range(1200)]
    index = tox.fit(spark.createDataFrame(rows, DOC), spark.createDataFrame([(i, i % 2) for i in range(1200)], "doc_id long, toxic int"))
    assert "vocabulary" not in vars(index) and len(index.ptr) == len(index.words) + 1
    assert index.ptr[-1] == len(index.example) == len(index.weight)
    again = pickle.loads(pickle.dumps(index))
    assert len(again.vocabulary) == len(index.words) and again.words[again.vocabulary["aax"]].as_py() == "aax"


def test_toxicity_votes_of_the_examples_are_cast_in_tasks(spark):
    """The driver makes no matrix of the examples; the curve is that of their leave-one-out votes."""
    r = random.Random(5)
    rows = [(i, " ".join(r.choices([f"word{j}" for j in range(90)], k=30) + ["grublek"] * (i % 3 == 0))) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC)
    shared, curve = tox.learned(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int"))
    index = shared.value
    assert "dense" not in vars(index) and "vocabulary" not in vars(index)
    raw = []
    for n, i in enumerate(index.ids):
        t, w = index.weighted(*index.terms.found(rows[i][1]))
        raw.append(index.vote(*index.nearest(t, w.astype(np.float32), without=n)))
    want = tox.isotonic(np.array(raw), index.labels, index.weights, index.prior)
    assert all(len(a) == len(b) and np.allclose(a, b, atol=1e-4) for a, b in zip(curve, want))


def test_toxicity_worker_remembers_a_bounded_part_of_the_words(spark):
    """A corpus of many rare words does not fill a worker: 25 MB of words and terms at most;
    a document is scored once, whatever batches the texts come in."""
    memo = tox.Terms({"#^wor": 0, "#word": 1})
    most = 0
    for lo in range(0, 300_000, 50_000):
        memo.found(" ".join("word" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(lo, lo + 50_000)))
        most = max(most, sys.getsizeof(memo) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in memo.items()))
    assert most <= 25_000_000
    docs = spark.range(3 * tox.BATCH + 7, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat(F.lit("some word"), F.col("id")).alias("text"))
    out = tox.toxicity(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert sorted(g["doc_id"] for g in out.collect()) == list(range(3 * tox.BATCH + 7))


def test_workers_give_back_what_their_tasks_leave(spark):
    """Workers stay for the next stages: memory that an earlier task freed is returned first."""
    from tickweave.llm.spark import tidy

    held = [bytearray(100_000) for _ in range(2000)]  # 200 MB below the size that is mapped apart
    keep = held[-1]
    del held[:-1]

    def resident():
        return int(re.search(r"Pss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024

    def run(batches):
        after.append(resident())
        yield from batches

    before, after = resident(), []
    assert list(tidy(run)(iter([1, 2]))) == [1, 2] and len(keep) == 100_000
    assert before - after[0] >= 100


def test_idle_workers_give_back_what_their_last_task_left():
    """Memory freed after the last call of a function of ours goes back to the system too."""
    import subprocess

    code = """
import re, sys, time
from tickweave.llm.spark import stay_tidy

def resident():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024

stay_tidy()
stay_tidy()
held = [bytearray(100_000) for _ in range(2000)]
keep = held[-1]
most = resident()
del held[:-1]
end = time.time() + 30
while most - resident() < 100 and time.time() < end:
    time.sleep(0.5)
sys.exit(most - resident() < 100)
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=pathlib.Path(bpe.__file__).parents[2]).returncode == 0
