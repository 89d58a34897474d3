"""Operator 1, mixing sources to target weights (DataFrame functions only).

Source weights are token shares raised to an exponent between 0 (uniform) and 1
(as found) and normalised.  The exponent is bisected on a grid of 2**-30: the
largest that still has the target entropy, raised if need be to the smallest
that repeats no source more than the limit.  Each source's share of the token
budget is then realised as whole epochs and a part of one more: its documents
lie in hash blocks, every epoch permutes the blocks, and the part takes whole
blocks in that order and, of the block where the budget ends, documents in
hash order as far as they fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.llm.spark import cut, table

GRID = 1 << 30
SECTIONS = 64  # exponents that one pass over the sources evaluates: six bisections at a time
MAX_BLOCKS = 4096  # blocks of a source; more tokens make larger blocks
BLOCK_TOKENS = 65_536
WORD = r"[^\x20\x09-\x0D]+"


def n_words(col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(col), F.lit("")), F.lit(WORD)).cast("long")


def hashed(*what: Column | str) -> Column:
    """The first 32 bits of an md5 as a number, and as SQL text ``hash32`` in the oracle."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *what).cast("binary")), 1, 8), 16, 10).cast("long")


def _last(shares: DataFrame, holds) -> int:
    """The largest grid point i in [0, GRID) at which ``holds(i / GRID, S, L)`` is true (it is
    true up to some point), or -1; S = sum p**a, L = sum p**a ln p."""
    lo, step = -1, GRID
    p = F.log("p")
    while step > 1:
        step //= SECTIONS
        at = [max(lo, 0) + j * step for j in range(0 if lo < 0 else 1, SECTIONS)]
        sums = shares.agg(*[F.struct(F.sum(F.exp(F.lit(i / GRID) * p)), F.sum(F.exp(F.lit(i / GRID) * p) * p)) for i in at]).first()
        good = [i for i, (s, t) in zip(at, sums) if holds(i / GRID, s, t)]
        if not good:
            if lo < 0:
                return -1
            continue
        lo = max(good)
    return lo


def exponent(shares: DataFrame, target_entropy: float, max_repeat: float | None, cover: bool) -> float:
    """The exponent for ``shares`` (column p > 0, summing to 1).  ``target_entropy`` is a
    fraction of ln(number of sources); ``max_repeat`` bounds the epochs of a source."""
    n, least, most, entropy = shares.agg(F.count("*"), F.min("p"), F.max("p"), -F.sum(F.col("p") * F.log("p"))).first()
    if n < 2:
        return 1.0
    target = target_entropy * math.log(n)
    a = 1.0 if entropy >= target else max(0, _last(shares, lambda x, s, t: math.log(s) - x * t / s >= target)) / GRID
    if max_repeat is not None:
        repeats = (lambda x, s, t: (most / least) ** (1 - x) > max_repeat) if cover else (lambda x, s, t: least ** (x - 1) / s > max_repeat)
        over = _last(shares, repeats)
        a = max(a, (over + 1) / GRID)
    return min(a, 1.0)


def mix_sources(
    docs: DataFrame, target_entropy: float = 0.95, max_repeat: float | None = 4.0, budget: int | None = None, cover: bool = False, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``docs`` repeated and sampled to the mixed weights, with ``mix_tokens`` (words of the
    text), ``mix_copy`` (epoch, from 1), ``mix_block`` and ``mix_rank`` (place of the
    block in its epoch's permutation of the source).

    ``budget`` is the number of tokens to realise (default: those of ``docs``), each
    source's share to the nearest token; with
    ``cover`` it is instead the least for which every source has a whole epoch, so
    nothing is left out.  A null source is a source of its own.  Null and empty
    texts count no tokens and follow their block.  A source without any token has
    no weight and is passed through once (it costs nothing).  Rows with equal ids
    in a source stand or fall together; null ids hash as the empty text.  An
    empty table gives no rows.  Columns of ``docs`` named like the new ones are
    replaced.
    """
    new = ["mix_tokens", "mix_copy", "mix_block", "mix_rank"]
    kept = [c for c in docs.columns if c not in new]
    d = docs.select(*kept, n_words(text_col).alias("mix_tokens"))
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("__s")  # null apart from every text
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    lean = d.select(key, ident.alias("__i"), "mix_tokens")
    # Fine hash blocks, MAX_BLOCKS a source, then the number that the source's tokens ask for.
    fine = F.pmod(hashed(F.lit(f"block{seed}"), F.col("__i")), F.lit(MAX_BLOCKS))
    cells = cut(lean.groupBy("__s", fine.alias("__f")).agg(F.sum("mix_tokens").alias("t")), "mix-cells")
    sources = cut(cells.groupBy("__s").agg(F.sum("t").alias("t")), "mix-sources")
    total = sources.agg(F.sum("t")).first()[0] or 0
    weighed = sources.where("t > 0").withColumn("p", F.col("t") / F.lit(float(max(total, 1))))
    a = exponent(weighed, target_entropy, max_repeat, cover) if total else 1.0
    power = F.exp(F.lit(a) * F.log("p"))
    norm = weighed.agg(F.sum(power)).first()[0] or 1.0
    weight = power / F.lit(norm)
    if cover:
        tokens = float(total) * (weighed.agg(F.max(F.col("p") / weight)).first()[0] or 1.0) * (1 + 1e-12)
    else:
        tokens = float(total if budget is None else budget)
    goal = F.round(weight * F.lit(tokens)).cast("long")  # to the nearest token: found shares (exponent 1) give back every source whole
    plan = weighed.select("__s", F.col("t").alias("__t"), goal.alias("__g")).withColumn("__e", F.expr("__g div __t")).withColumn("__r", F.expr("__g % __t"))
    plan = plan.unionByName(sources.where("t = 0").select("__s", F.lit(0).cast("long").alias("__t"), F.lit(0).cast("long").alias("__g"), F.lit(1).cast("long").alias("__e"), F.lit(0).cast("long").alias("__r")))
    plan = plan.withColumn("__n", F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("__t") / BLOCK_TOKENS))))
    # Blocks of every epoch in permuted order; the last epoch only as far as the rest of the budget goes.
    blocks = cells.join(plan, "__s").groupBy("__s", "__e", "__r", F.pmod("__f", "__n").alias("__b")).agg(F.sum("t").alias("t"))
    epochs = blocks.withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("__e") + F.when(F.col("__r") > 0, 1).otherwise(0)))).where("__c > 0")
    order = hashed(F.lit(f"epoch{seed}"), F.col("__s"), F.col("__c"), F.col("__b"))
    w = Window.partitionBy("__s", "__c").orderBy("__o", "__b")  # at most MAX_BLOCKS rows
    epochs = epochs.withColumn("__o", order).withColumn("mix_rank", F.row_number().over(w)).withColumn("__before", F.sum("t").over(w) - F.col("t"))
    room = F.when(F.col("__c") <= F.col("__e"), F.col("t")).otherwise(F.col("__r") - F.col("__before"))
    epochs = epochs.withColumn("__room", room).where("__room > 0 or (__c <= __e)")
    chosen = cut(epochs.select("__s", "__b", F.col("__c").alias("mix_copy"), "mix_rank", "__room", (F.col("__room") >= F.col("t")).alias("__whole")), "mix-plan")
    whole = chosen.where("__whole").select("__s", "__b", "mix_copy", "mix_rank")
    cut_block = chosen.where("not __whole").select("__s", "__b", "mix_copy", "mix_rank", "__room")
    placed = d.withColumns({"__s": key, "__i": ident}).join(plan.select("__s", "__n"), "__s").withColumn("__b", F.pmod(F.pmod(hashed(F.lit(f"block{seed}"), F.col("__i")), F.lit(MAX_BLOCKS)), "__n"))
    out = [F.col(c) for c in kept] + [F.col("mix_tokens"), F.col("mix_copy").cast("int"), F.col("__b").cast("int").alias("mix_block"), F.col("mix_rank").cast("int")]
    full = placed.join(whole, ["__s", "__b"]).select(*out)
    inside = Window.partitionBy("__s").orderBy("__k", "__i")  # one block of a source; equal ids stand or fall together
    last = placed.join(cut_block, ["__s", "__b"]).withColumn("__k", hashed(F.lit(f"doc{seed}"), F.col("mix_copy"), F.col("__i")))
    last = last.withColumn("__sum", F.sum("mix_tokens").over(inside)).where("__sum <= __room").select(*out)
    return full.unionByName(last)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_copy").alias("copy"), F.col("mix_block").alias("block"), F.col("mix_rank").alias("block_rank"))


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS s, coalesce(CAST(doc_id AS VARCHAR), '') AS i,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n
  FROM documents
), h AS (
  SELECT *, CAST('0x' || substr(md5('block0:' || i), 1, 8) AS BIGINT) % 4096 AS f FROM d
), src AS (
  SELECT s, CAST(sum(n) AS BIGINT) AS t FROM d GROUP BY s
), tot AS (
  SELECT CAST(sum(t) AS DOUBLE) AS total FROM src
), shr AS (
  SELECT s, t, t / total AS p FROM src, tot WHERE t > 0
), ps AS (
  SELECT list(p ORDER BY s) AS ps, count(*) AS n, min(p) AS least FROM shr
), best AS (
  SELECT 0 AS k, CAST(0 AS BIGINT) AS lo, CAST(1073741824 AS BIGINT) AS hi, CAST(0 AS BIGINT) AS rlo, CAST(1073741824 AS BIGINT) AS rhi
  UNION ALL
  SELECT k + 1,
    CASE WHEN he >= 0.95 * ln(n) THEN (lo + hi) // 2 ELSE lo END, CASE WHEN he >= 0.95 * ln(n) THEN hi ELSE (lo + hi) // 2 END,
    CASE WHEN rep > 4.0 THEN (rlo + rhi) // 2 ELSE rlo END, CASE WHEN rep > 4.0 THEN rhi ELSE (rlo + rhi) // 2 END
  FROM (
    SELECT best.*, n,
      ln(list_sum(list_transform(ps, lambda x: exp((lo + hi) // 2 / 1073741824 * ln(x)))))
        - (lo + hi) // 2 / 1073741824 * list_sum(list_transform(ps, lambda x: exp((lo + hi) // 2 / 1073741824 * ln(x)) * ln(x)))
        / list_sum(list_transform(ps, lambda x: exp((lo + hi) // 2 / 1073741824 * ln(x)))) AS he,
      pow(least, (rlo + rhi) // 2 / 1073741824 - 1) / list_sum(list_transform(ps, lambda x: exp((rlo + rhi) // 2 / 1073741824 * ln(x)))) AS rep
    FROM best, ps WHERE k < 30
  )
), ex AS (
  SELECT CASE WHEN n < 2 THEN 1.0 ELSE least(1.0, greatest(
      CASE WHEN -list_sum(list_transform(ps, lambda x: x * ln(x))) >= 0.95 * ln(n) THEN 1.0 ELSE lo / 1073741824 END,
      CASE WHEN pow(least, -1) / n > 4.0 THEN (rlo + 1) / 1073741824 ELSE 0 END)) END AS a
  FROM best, ps WHERE k = 30
), w AS (
  SELECT s, t, exp(a * ln(p)) / (SELECT sum(exp(a * ln(p))) FROM shr, ex) AS w FROM shr, ex
), pl AS (
  SELECT s, t, CAST(round(w * total) AS BIGINT) AS g FROM w, tot
), plan AS (
  SELECT s, t, g // t AS e, g % t AS r, greatest(1, least(4096, CAST(ceil(t / 65536) AS BIGINT))) AS nb FROM pl
  UNION ALL SELECT s, 0, 1, 0, 1 FROM src WHERE t = 0
), pd AS (
  SELECT h.*, h.f % plan.nb AS b, plan.e, plan.r FROM h JOIN plan USING (s)
), bl AS (
  SELECT s, b, e, r, CAST(sum(n) AS BIGINT) AS t FROM pd GROUP BY s, b, e, r
), ep AS (
  SELECT *, unnest(range(1, e + CASE WHEN r > 0 THEN 2 ELSE 1 END)) AS c FROM bl
), eo AS (
  SELECT *, CAST('0x' || substr(md5('epoch0:' || s || ':' || c || ':' || b), 1, 8) AS BIGINT) AS o FROM ep
), er AS (
  SELECT *, row_number() OVER (PARTITION BY s, c ORDER BY o, b) AS rk, sum(t) OVER (PARTITION BY s, c ORDER BY o, b) - t AS before FROM eo
), rm AS (
  SELECT *, CASE WHEN c <= e THEN t ELSE r - before END AS room FROM er
), lst AS (
  SELECT pd.*, rm.c, rm.rk, rm.room, CAST('0x' || substr(md5('doc0:' || rm.c || ':' || i), 1, 8) AS BIGINT) AS k
  FROM pd JOIN rm ON pd.s = rm.s AND pd.b = rm.b WHERE rm.room > 0 AND rm.room < rm.t
), cum AS (
  SELECT *, sum(n) OVER (PARTITION BY s ORDER BY k, i) AS run FROM lst
)
SELECT doc_id, source, n AS n_tokens, CAST(c AS INTEGER) AS copy, CAST(b AS INTEGER) AS block, CAST(rk AS INTEGER) AS block_rank FROM cum WHERE run <= room
UNION ALL
SELECT pd.doc_id, pd.source, pd.n, CAST(rm.c AS INTEGER), CAST(pd.b AS INTEGER), CAST(rm.rk AS INTEGER)
FROM pd JOIN rm ON pd.s = rm.s AND pd.b = rm.b WHERE (rm.room > 0 OR rm.c <= rm.e) AND rm.room >= rm.t
"""
