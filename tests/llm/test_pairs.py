"""Joins, fingerprints, search and dedup against brute force on small tables."""

import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import op3_jaccard_join as jaccard
from tickweave.llm import op4_fingerprints as prints
from tickweave.llm import op5_topk as topk
from tickweave.llm import op7_suffix_dedup as suffix
from tickweave.llm.components import components
from tickweave.llm.spark import find_package

DOC = "doc_id long, text string"


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


def corpus(seed, n=60, words=300):
    """Random texts with groups of near copies, exact copies and shared passages."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    passage = " ".join(r.choices(vocab, k=30))
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.45:
            w = r.choice(out[: 1 + len(out) // 4]).split(" ")
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                if len(w) > 1:
                    w[r.randrange(len(w))] = r.choice(vocab)
            out.append(" ".join(w))
        else:
            t = " ".join(r.choices(vocab, k=r.choice([1, 3, 7, 20, 60, 120])))
            out.append(t + " " + passage if kind > 0.8 else t)
    return out


def sets(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute_components(rows, width, percent):
    s = [(i, sets(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            (i, x), (j, y) = s[a], s[b]
            if i is None or j is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                u, v = find(i), find(j)
                parent[max(u, v)] = min(u, v)
    return sorted(((i, len(x), None if i is None else find(i)) for i, x in s), key=str)


@pytest.mark.parametrize("width,percent,rare", [(4, 85, 8), (4, 85, 1), (5, 80, 2), (3, 50, 1)])
def test_jaccard_components(spark, width, percent, rare):
    rows = list(enumerate(corpus(width * percent + rare)))
    rows += [(900, ""), (901, None), (902, "  \t"), (None, rows[3][1]), (903, rows[5][1].upper()), (5, rows[5][1]), (904, "One"), (905, "one")]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, DOC), width, percent, rare=rare)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows, width, percent)


def test_jaccard_chain_is_one_component(spark):
    base = [f"t{i}" for i in range(200)]
    rows = []
    for k in range(30):  # neighbours link, the ends do not
        rows.append((k, " ".join(base[k * 3 : k * 3 + 100])))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, DOC), rare=1)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows, 4, 85)


def test_jaccard_empty_and_clashing(spark):
    empty = spark.createDataFrame([], DOC)
    assert jaccard.jaccard_components(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b c d e", 7, 8), (2, "a b c d e", 7, 8)], "doc_id long, text string, component_id long, node long")
    assert sorted(map(tuple, jaccard.jaccard_components(clash).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(None, 3), (4, 4)]
    got = {x["id"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            u, v = find(a), find(b)
            parent[max(u, v)] = min(u, v)
    assert got == {x: find(x) for x in parent}


def brute_repeats(rows, length):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1) if i is not None else ():
            if first[b[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,hot,alphabet", [(1, 20_000, "abé \n"), (2, 2, "ab "), (3, 20_000, "xyzäöü 0123456789")])
def test_suffix_dedup(spark, seed, hot, alphabet):
    r = random.Random(seed)
    pool = ["".join(r.choices(alphabet, k=r.choice([30, 49, 50, 51, 80, 300]))) for _ in range(12)]
    rows = [(i * 3 % 97, "".join(r.choice(pool) if r.random() < 0.6 else "".join(r.choices(alphabet, k=r.randrange(40))) for _ in range(r.randrange(6)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, rows[4][1]), (203, rows[4][1] * 3), (None, rows[4][1]), (202, rows[5][1]), (3, rows[6][1]), (-5, pool[5]), (204, pool[5][1:])]
    got = suffix.remove_repeats(spark.createDataFrame(rows, DOC), hot_size=hot)
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    flat = got.select("doc_id", n, "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted([tuple(x) for x in flat], key=str) == brute_repeats(rows, 50)
    for x in got.collect():  # the text keeps a code point if any of its bytes stays
        assert x["kept_text"].encode() == bytes(x["kept"]) or not (x["text"] or "").isascii()


def test_suffix_long_text_slices(spark):
    r = random.Random(9)
    long = "".join(r.choices("abcdefgh ", k=(1 << 20) + 5000))
    rows = [(1, long), (2, "zz" + long[(1 << 20) - 400 : (1 << 20) + 400] + "yy"), (3, long[:100] + "q" * 60)]
    got = suffix.remove_repeats(spark.createDataFrame(rows, DOC)).orderBy("doc_id").collect()
    assert [x["n_removed"] for x in got] == [0, 800, 100]
    assert [tuple(s) for s in got[1]["spans"]] == [(2, 802)]


def test_suffix_order_sorts_suffixes():
    r = random.Random(3)
    data = "".join(r.choices("ab", k=400)) * 3 + "".join(r.choices("abc", k=300))
    buf = np.frombuffer(data.encode() + bytes(60), np.uint8)
    at = np.arange(len(data) - 50)
    group = at % 3
    order, same = suffix.suffix_order(buf, at, group, 50)
    keys = [(int(group[i]), data[i : i + 50]) for i in order]
    assert keys == sorted(keys)
    assert [bool(x) for x in same[1:]] == [a == b for a, b in zip(keys, keys[1:])]


def test_suffix_task_holds_a_bounded_part_of_its_anchors():
    """12 MB of text go through a task's side of step 1 in less than 65 MB."""
    r = np.random.default_rng(4)
    texts = [bytes(t) for t in r.integers(97, 123, (4096, 3000), dtype=np.uint8)]
    sender, sent = suffix.Sender(40, 50), 0
    tracemalloc.start()
    for lo in range(0, len(texts), suffix.TOGETHER):
        sender.add(texts[lo : lo + suffix.TOGETHER], [(i, i, i % 40) for i in range(lo, lo + suffix.TOGETHER)])
        if sender.held > suffix.FLUSH:
            sent += sum(len(row["seed"]) // 4 for row in sender.flush())
    sent += sum(len(row["seed"]) // 4 for row in sender.flush())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent > 500_000 and most < 65_000_000


def asked(texts, hot=20_000):
    """kind -> number of territories whose bytes one bucket asks for."""
    sender = suffix.Sender(1, 50)
    sender.add([t.encode() for t in texts], [(i, i, 0) for i in range(len(texts))])
    told = suffix.settle_bucket(suffix._table(list(sender.flush()), suffix.SENT), hot)
    out = {}
    for row in told:
        out[row["kind"]] = out.get(row["kind"], 0) + row["n"]
    return out


def test_suffix_asks_only_for_strings_that_can_repeat():
    """Texts that share 30 bytes have anchors in common, but no bytes need to be compared; with 50 they do."""
    r = random.Random(8)
    noise = lambda n: "".join(r.choices("abcdefghijklmnop", k=n))
    short, long = noise(30), noise(80)
    assert not asked([noise(200) + short + noise(200) for _ in range(30)])
    assert asked([noise(200) + long + noise(200) for _ in range(30)])[suffix.ASK] >= 30
    assert asked([noise(200) + long + noise(200) for _ in range(30)], 2)[suffix.ASK_HOT] >= 30


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_overlaps_around_the_length(spark, hot):
    """Shared strings of 20 to 80 bytes in all surroundings, short texts and text edges included."""
    r = random.Random(12)
    noise = lambda n: "".join(r.choices("abcdefghé", k=n))
    pool = [noise(80) for _ in range(3)] + ["ab" * 40]
    rows = []
    for i in range(150):
        p, n = r.choice(pool), r.randrange(20, 81)
        at = r.randrange(0, 81 - n)
        rows.append((i % 120, noise(r.choice([0, 1, 14, 15, 16, 40])) + p[at : at + n] + noise(r.choice([0, 1, 14, 15, 16, 40]))))
    got = suffix.remove_repeats(spark.createDataFrame(rows, DOC), hot_size=hot)
    flat = got.select("doc_id", F.octet_length("text").cast("long"), "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted([tuple(x) for x in flat], key=str) == brute_repeats(rows, 50)


def test_suffix_compares_some_anchors_at_a_time(monkeypatch):
    r = random.Random(6)
    pool = ["".join(r.choices("ab", k=90)) for _ in range(20)]
    texts = [r.choice(pool)[r.randrange(10) : r.randrange(62, 90)].encode() for _ in range(300)]
    seed, ids, windows = np.array([r.randrange(9) for _ in texts], np.uint32), np.array([r.randrange(40) for _ in texts]), np.array([len(t) - 49 for t in texts])
    first = {}
    for s, i, t in zip(seed, ids, texts):
        for p in range(len(t) - 49):
            first[s, t[p : p + 50]] = min(i, first.get((s, t[p : p + 50]), i))
    want = [bool(first[s, t[p : p + 50]] < i) for s, i, t in zip(seed, ids, texts) for p in range(len(t) - 49)]
    sizes, sort = [], suffix.suffix_order
    monkeypatch.setattr(suffix, "suffix_order", lambda buf, at, group, limit: sizes.append(len(at)) or sort(buf, at, group, limit))
    assert suffix.repeated_windows(seed, ids, windows, b"".join(texts), 50).tolist() == want and len(sizes) == 1
    monkeypatch.setattr(suffix, "COMPARED", 600)
    assert suffix.repeated_windows(seed, ids, windows, b"".join(texts), 50).tolist() == want and len(sizes) > 5


def test_suffix_empty_and_clashing(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], DOC)).count() == 0
    t = "a passage of more than fifty bytes that stands in two documents "
    clash = spark.createDataFrame([(1, t, 5, 6), (2, "x" + t, 5, 6)], "doc_id long, text string, kept long, db long")
    got = {x["doc_id"]: (x["n_removed"], x["db"]) for x in suffix.remove_repeats(clash).collect()}
    assert got == {1: (0, 6), 2: (len(t), 6)}


def test_edited_fingerprints(spark):
    texts = corpus(11, 40) + ["", "né", "ünï çödé wörds ánd möre", "x"]
    rows = [(i * 7 - 20, t) for i, t in enumerate(texts)] + [(1000, None), (None, "no id"), (15, "twice"), (15, "again")]
    got = {}
    for x in prints.edited_fingerprints(spark.createDataFrame(rows, DOC)).collect():
        got.setdefault(x["doc_id"], []).append(x)
    ordered = sorted(((i, t or "") for i, t in rows if i is not None))
    by_text = {}
    for k, (i, t) in enumerate(ordered):
        n = len(t) // 4
        edited = t[: len(t) - n] + ordered[(k + 1) % len(ordered)][1][:n]
        want = hashlib.sha256(edited.encode()).hexdigest()
        match = [x for x in got[i] if x["edited_sha256"] == want and x["n_chars"] == len(t)]
        assert match, (i, t)
        assert by_text.setdefault(t, match[0]["fingerprint"]) == match[0]["fingerprint"]
        assert 0 <= match[0]["near_edited"] <= 1
        if edited == t:
            assert match[0]["near_edited"] == 1.0
    assert sum(map(len, got.values())) == len(rows)
    assert got[None][0]["near_next"] == 0.0


def test_fingerprint_likeness_estimates_jaccard():
    base = [f"w{i}" for i in range(400)]
    other = base[:320] + [f"v{i}" for i in range(80)]
    a, b = (" ".join(x).encode() for x in (base, other))
    s, t = (set(x.tolist()) for x in prints.shingles([a, b]))
    sa, sb = prints.signatures([a, b])
    assert abs(prints.likeness(sa, sb) - len(s & t) / len(s | t)) < 0.15


def test_edited_fingerprints_small(spark):
    assert prints.edited_fingerprints(spark.createDataFrame([], DOC)).count() == 0
    one = prints.edited_fingerprints(spark.createDataFrame([(3, "abcd efgh")], DOC)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest() and one["near_next"] == 1.0


def test_near_duplicates(spark):
    base = [" ".join(f"{c}{i}" for i in range(120)) for c in "abc"]
    near = base[0].replace("a60 ", "zz ")
    rows = [(1, base[0]), (2, base[1]), (3, near), (4, base[1]), (5, base[2]), (6, ""), (7, None), (8, ""), (None, base[0])]
    got = {(x["doc_id"], x["like_id"]): x["jaccard"] for x in prints.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert set(got) == {(3, 1), (4, 2)} and got[(4, 2)] == 1.0
    s, t = (set(x.tolist()) for x in prints.shingles([base[0].encode(), near.encode()]))
    assert got[(3, 1)] == pytest.approx(len(s & t) / len(s | t))


def test_near_duplicates_without_a_near_centre(spark):
    """The small ids are about 0.72 alike to all others: links between larger ids are found all the same."""
    r = random.Random(21)
    base = [f"t{i}" for i in range(400)]

    def edited(words, n, tag):
        w = list(words)
        for at in r.sample(range(len(w)), n):
            w[at] = f"{tag}x{at}"
        return w

    rows = [(i, " ".join(edited(base, 13, f"a{i}"))) for i in range(60)]
    for g in range(4):
        one = edited(base, 13, f"g{g}")
        rows += [(100 + 10 * g + j, " ".join(edited(one, 1, f"g{g}{j}"))) for j in range(3)]
    x, y = ([f"{c}{i}" for i in range(120)] for c in "xy")  # two texts of one id
    rows += [(200, " ".join(x)), (200, " ".join(y)), (201, " ".join(edited(x, 1, "u"))), (202, " ".join(edited(y, 1, "v")))]
    sets = [(i, set(s.tolist())) for (i, t), s in zip(rows, prints.shingles([t.encode() for _, t in rows]))]
    alike = [(i, j, len(s & t) / len(s | t)) for k, (j, s) in enumerate(sets) for i, t in sets[k + 1 :]]
    links = [(i, j) for i, j, v in alike if v >= 0.8]
    assert max(v for i, j, v in alike if j < 100) < 0.8  # no link to a small id
    got = prints.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert {(g["doc_id"], g["like_id"]) for g in got} <= set(links)

    def groups(pairs):
        of = {i: i for i, _ in rows}
        for _ in rows:
            for i, j in pairs:
                of[i] = of[j] = min(of[i], of[j])
        return of

    assert groups([(g["doc_id"], g["like_id"]) for g in got]) == groups(links)


def test_fingerprints_query_tells_classes(spark, tmp_path):
    base = [" ".join(f"{c}{i}" for i in range(120)) for c in "ab"]
    rows = [(4, base[0]), (2, base[1]), (9, base[0].replace("a60 ", "zz ")), (5, base[0]), (6, ""), (None, base[0])]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in prints.op4_fingerprints(spark, str(tmp_path)).collect()}
    assert got == {4: (4, 2), 2: (2, 0), 9: (4, 1), 5: (4, 1), 6: (6, 0), None: (None, 0)}


def test_top_k(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(0, 0.15, 16)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(2000, None), (2100, [float("nan")] + [0.0] * 15), (2200, [None] + [0.0] * 15), (None, rows[1][1]), (2300, [float("inf")] * 16), (2400, [0.0] * 16), (2500, [1.0, 2.0]), (2501, [1.0, -2.0]), (2600, [])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0)
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, x in ok:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(y) == len(x))[:10]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_empty(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>, score long"), F.lit(True)).count() == 0


def test_top_k_refuses_components_beyond_a_long(spark):
    df = spark.createDataFrame([(100, [4e6, 4e9]), (1, [4e6, 4e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk.top_k(df, F.col("vec_id") == 100).collect()
    most = 2.0**30 / 1024 - 2  # just inside, for two components
    got = topk.top_k(spark.createDataFrame([(100, [most, -most]), (1, [most, -most]), (2, [-most, most])], df.schema), F.col("vec_id") == 100).collect()
    v = int(1024 * most)
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 2 * v * v), (2, -2 * v * v)]
