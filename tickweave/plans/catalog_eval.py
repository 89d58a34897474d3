"""Registered queries: labels (D), splits (F1-F4), signals (E4-E11),
metrics (G1-G8) and quality / leakage (G9-G13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions.core import rounded
from tickweave.operators import labels as lab
from tickweave.operators import metrics as met
from tickweave.operators import quality as qual
from tickweave.operators import signals as sig
from tickweave.operators import splits as spl
from tickweave.operators.bars import latest_per_series, regularise
from tickweave.operators.clean import union_all
from tickweave.operators.indicators import indicators, lags, atr
from tickweave.plans import sqlbits as q
from tickweave.plans.catalog import _BACKTEST_SQL, _BUNDLE_SQL, KEYS_SQL, backtest_sql, delta_sql, out, query, with_bars
from tickweave.plans.inputs import bars_cte, event_bars, table
from tickweave.schema import INDICATOR_COLS, KEYS, PRICE_COLS, TS

# ---------------------------------------------------------------- labels


@query("d1_next_bar_up", with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, coalesce(CAST({q.lead('close')} > close AS INTEGER), 0) AS target FROM o"))
def d1_next_bar_up(spark, sf):
    return lab.next_bar_up(event_bars(spark, sf), last_row="zero").select(*KEYS, TS, "target")


@query("d2_future_return", with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, {q.r(f'{q.lead('close', 5)} / NULLIF(close, 0) - 1.0', 'future_return')} FROM o"))
def d2_future_return(spark, sf):
    return out(lab.future_return(event_bars(spark, sf), 5), ["future_return"])


_D3_SQL = f"""a AS (SELECT *, {q.lead('close', 5)} / NULLIF(close, 0) - 1.0 AS future_return FROM bars),
s AS (SELECT *, {", ".join(f"avg({c}) OVER ({q.SERIES}) AS m_{c}, stddev_samp({c}) OVER ({q.SERIES}) AS s_{c}" for c in PRICE_COLS)} FROM a)
SELECT {KEYS_SQL}, {", ".join(q.r(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END", c) for c in PRICE_COLS)},
  {q.r('future_return', 'future_return')}, CAST(future_return > 0 AS INTEGER) AS target
FROM s WHERE future_return IS NOT NULL"""


@query("d3_binary_target", with_bars(_D3_SQL))
def d3_binary_target(spark, sf):
    """Horizon-5 target, z-scored price columns, tail dropped."""
    return out(lab.binary_target(event_bars(spark, sf), 5, 0.0), [*PRICE_COLS, "future_return"], ["target"])


_D4_BARS = f"WITH {bars_cte('15m', 'b15')}, {bars_cte('1h', 'b60')}, {bars_cte('4h', 'b240')},\nbars AS (SELECT * FROM b15 UNION ALL SELECT * FROM b60 UNION ALL SELECT * FROM b240),"
_D4_SQL = f"""{_D4_BARS}
f AS (SELECT *, CASE timeframe WHEN '15m' THEN {q.lead('close', 4)} / NULLIF(close, 0) - 1.0
                               ELSE {q.lead('close', 4)} / NULLIF(close, 0) - 1.0 END AS fr,
                CASE timeframe WHEN '15m' THEN 0.0015 ELSE 0.003 END AS thr FROM bars),
l AS (SELECT *, CASE WHEN fr > thr THEN 1 WHEN fr < -thr THEN -1 ELSE 0 END AS label FROM f)"""


def _d4(spark, sf):
    b = union_all([event_bars(spark, sf, tf) for tf in ("15m", "1h", "4h")])
    return lab.ternary_label(b)


@query("d4_ternary_label", f"{_D4_SQL}\nSELECT {KEYS_SQL}, label FROM l")
def d4_ternary_label(spark, sf):
    """15m, 1h and 4h bars in one job; 15m and 1h have settings of their own, 4h takes the default."""
    return _d4(spark, sf).select(*KEYS, TS, "label")


@query("d5_label_encode", f"{_D4_SQL}\nSELECT {KEYS_SQL}, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx FROM l")
def d5_label_encode(spark, sf):
    return lab.encode_labels(_d4(spark, sf)).select(*KEYS, TS, "label", "label_idx")


@query(
    "d6_class_weight",
    f"""{_D4_SQL},
c AS (SELECT label, count(*) AS nc FROM l GROUP BY label),
w AS (SELECT label, sum(nc) OVER () / (count(*) OVER () * nc) AS weight FROM c)
SELECT {KEYS_SQL}, label, round(weight, 6) + 0.0 AS weight FROM l JOIN w USING (label)""",
)
def d6_class_weight(spark, sf):
    d = lab.class_weights(_d4(spark, sf))
    return d.select(*KEYS, TS, "label", rounded("weight").alias("weight"))


# ---------------------------------------------------------------- splits

_NUM = f"n AS (SELECT *, row_number() OVER ({q.ORDER}) - 1 AS i, count(*) OVER ({q.SERIES}) AS n FROM bars)"


@query("f1_holdout", with_bars(f"{_NUM}\nSELECT {KEYS_SQL}, CASE WHEN i < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM n"))
def f1_holdout(spark, sf):
    return spl.holdout(event_bars(spark, sf), 0.2).select(*KEYS, TS, "split")


@query(
    "f3_walk_forward",
    with_bars(
        f"""{_NUM},
k AS (SELECT *, floor(n / 6) AS size, floor(i / floor(n / 6)) AS block FROM n WHERE floor(n / 6) >= 20),
folds AS (SELECT unnest(generate_series(1, 5)) AS fold)
SELECT {KEYS_SQL}, CAST(fold AS INTEGER) AS fold, CASE WHEN block < fold THEN 'train' ELSE 'test' END AS role
FROM k JOIN folds ON block <= fold"""
    ),
)
def f3_walk_forward(spark, sf):
    return spl.walk_forward(event_bars(spark, sf), 5).select(*KEYS, TS, "fold", "role")


@query(
    "f4_time_series_folds",
    with_bars(
        f"""{_NUM},
k AS (SELECT *, floor(n / 6) AS size FROM n WHERE floor(n / 6) > 0),
folds AS (SELECT unnest(generate_series(1, 5)) AS fold),
j AS (SELECT *, n - size * 5 + size * (fold - 1) AS start FROM k JOIN folds ON true)
SELECT {KEYS_SQL}, CAST(fold AS INTEGER) AS fold, CASE WHEN i < start THEN 'train' ELSE 'test' END AS role
FROM j WHERE i < start + size"""
    ),
)
def f4_time_series_folds(spark, sf):
    return spl.time_series_folds(event_bars(spark, sf), 5).select(*KEYS, TS, "fold", "role")


_U_SQL = "CAST('0x' || substr(md5('42|' || symbol || '|' || timeframe || '|' || CAST(timestamp AS VARCHAR)), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


@query(
    "f2_random_split",
    f"""{_D4_SQL},
u AS (SELECT *, {_U_SQL} AS u FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, symbol, timeframe, timestamp) - 1 AS rk, count(*) OVER (PARTITION BY label) AS n FROM u)
SELECT {KEYS_SQL}, label, CASE WHEN u < CAST(0.2 AS DOUBLE) THEN 'test' ELSE 'train' END AS split,
  CASE WHEN rk < ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split_stratified FROM k""",
)
def f2_random_split(spark, sf):
    """Repeatable hash split (20 % test) and a stratified one on the D4 label."""
    d = spl.random_split(_d4(spark, sf), 0.2, out="split")
    d = spl.random_split(d, 0.2, stratify="label", out="split_stratified")
    return d.select(*KEYS, TS, "label", "split", "split_stratified")


# ---------------------------------------------------------------- signals

_SCORE_SQL = f"""{_BACKTEST_SQL},
sc AS (SELECT *, coalesce(CAST({q.lead('close')} > close AS INTEGER), 0) AS y_zero, {q.lead('close')} AS nxt,
  CASE signal WHEN 'BUY' THEN 1 ELSE 0 END AS pred,
  CASE signal WHEN 'BUY' THEN confidence WHEN 'SELL' THEN 1.0 - confidence ELSE 0.5 END AS score FROM bt),
ev AS (SELECT *, CAST(nxt > close AS INTEGER) AS y FROM sc WHERE nxt IS NOT NULL)"""


def scored(spark, sf):
    """E2 rows with ``y`` (next bar up, last row dropped), ``pred`` (BUY = 1)
    and ``score`` (the rule's confidence turned into P(up))."""
    bt = sig.ema_rsi_backtest(event_bars(spark, sf))
    bt = lab.next_bar_up(bt, out="y", last_row="drop")
    return bt.select(
        "*",
        (F.col("signal") == "BUY").cast("int").alias("pred"),
        F.when(F.col("signal") == "BUY", F.col("confidence")).when(F.col("signal") == "SELL", 1.0 - F.col("confidence")).otherwise(F.lit(0.5)).alias("score"),
    )


@query("e4_gate_by_confidence", with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, CASE WHEN confidence >= 0.3 THEN signal ELSE 'NoSignal' END AS action FROM bt"))
def e4_gate_by_confidence(spark, sf):
    return sig.gate_by_confidence(sig.ema_rsi_backtest(event_bars(spark, sf)), 0.3).select(*KEYS, TS, "action")


@query(
    "e5_model_or_rule",
    f"""WITH {bars_cte('1h')},
{_BACKTEST_SQL},
{delta_sql('m_')},
m AS (SELECT *, CASE WHEN delta IS NOT NULL THEN {q.ema('up', 1 / 14, True)} END AS au,
                CASE WHEN delta IS NOT NULL THEN {q.ema('dn', 1 / 14, True)} END AS ad FROM m_g),
ms AS (SELECT symbol, timeframe, timestamp, coalesce(100.0 - 100.0 / (1.0 + au / NULLIF(ad, 0)), 50.0) AS rsi14 FROM m),
mp AS (SELECT symbol, timeframe, timestamp, CASE WHEN rsi14 < 50 THEN 1 ELSE 0 END AS pred, 1.0 - rsi14 / 100.0 AS prob FROM ms
       WHERE timestamp < TIMESTAMP '2024-01-20 00:00:00')
SELECT {KEYS_SQL},
  CASE WHEN mp.pred IS NOT NULL THEN CASE WHEN mp.pred = 1 THEN 'BUY' ELSE 'SELL' END ELSE bt.signal END AS signal,
  round(CASE WHEN mp.pred IS NOT NULL THEN mp.prob ELSE bt.confidence END, 6) + 0.0 AS confidence,
  CASE WHEN mp.pred IS NOT NULL THEN 'model' ELSE 'rule' END AS source
FROM bt LEFT JOIN mp USING (symbol, timeframe, timestamp)""",
)
def e5_model_or_rule(spark, sf):
    """Scores from an earlier scoring run (a Wilder-RSI classifier) exist for
    bars before 2024-01-20; later bars fall back to the EMA/RSI rule."""
    from tickweave.operators.indicators import rsi_wilder

    b = event_bars(spark, sf)
    rule = sig.ema_rsi_backtest(b).drop("_i")
    m = rsi_wilder(b).filter(F.col(TS) < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    scores = m.select(*KEYS, TS, (F.col("rsi14") < 50).cast("int").alias("pred"), (1.0 - F.col("rsi14") / 100.0).alias("prob"))
    d = sig.model_or_rule(rule, scores, [*KEYS, TS])
    return d.select(*KEYS, TS, "signal", rounded("confidence").alias("confidence"), "source")


@query("e6_class_to_action", with_bars(f"o AS (SELECT * FROM bars)\nSELECT {KEYS_SQL}, CASE WHEN coalesce(CAST({q.lead('close')} > close AS INTEGER), 0) = 1 THEN 'BUY' ELSE 'SELL' END AS action FROM o"))
def e6_class_to_action(spark, sf):
    d = lab.next_bar_up(event_bars(spark, sf), last_row="zero")
    return d.select(*KEYS, TS, sig.class_to_action(F.col("target")).alias("action"))


@query(
    "e7_band",
    with_bars(f"{_BACKTEST_SQL}\nSELECT {KEYS_SQL}, CASE WHEN confidence > 0.8 THEN 'BUY' WHEN confidence < 0.2 THEN 'SELL' ELSE 'HOLD' END AS band3, "
              "CASE WHEN confidence >= 0.8 THEN 'BUY' END AS band2 FROM bt"),
)
def e7_band(spark, sf):
    bt = sig.ema_rsi_backtest(event_bars(spark, sf))
    return bt.select(*KEYS, TS, sig.band(F.col("confidence")).alias("band3"), sig.band(F.col("confidence"), two_way=True).alias("band2"))


@query(
    "e8_high_confidence",
    with_bars(f"{_SCORE_SQL}\nSELECT {KEYS_SQL}, CASE WHEN score > 0.9 THEN 'LONG' WHEN score < 0.1 THEN 'SHORT' END AS side, "
              "CAST(score > 0.9 OR score < 0.1 AS INTEGER) AS saturated FROM sc"),
)
def e8_high_confidence(spark, sf):
    bt = sig.ema_rsi_backtest(event_bars(spark, sf))
    p = F.when(F.col("signal") == "BUY", F.col("confidence")).when(F.col("signal") == "SELL", 1.0 - F.col("confidence")).otherwise(F.lit(0.5))
    side, sat = sig.high_confidence(p)
    return bt.select(*KEYS, TS, side.alias("side"), sat.alias("saturated"))


_E9_FEATS = list(PRICE_COLS) + list(INDICATOR_COLS)


@query(
    "e9_snapshot",
    f"""WITH {bars_cte('1h')},
{_BUNDLE_SQL},
{backtest_sql('x_')},
j AS (SELECT f.*, CASE bt.signal WHEN 'BUY' THEN 1 ELSE 0 END AS pred,
        CASE bt.signal WHEN 'BUY' THEN bt.confidence WHEN 'SELL' THEN 1.0 - bt.confidence ELSE 0.5 END AS prob
      FROM f JOIN bt USING (symbol, timeframe, timestamp)
      QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY timestamp DESC) = 1)
SELECT symbol, timeframe, timestamp AS row_timestamp, pred, round(prob, 6) + 0.0 AS prob, round(close, 6) + 0.0 AS price,
  'ema_rsi_rule' AS model, {", ".join(q.r(c, c) for c in _E9_FEATS)} FROM j""",
)
def e9_snapshot(spark, sf):
    """Latest row per series with pred, prob, price and the first 16 of the
    indicator table's features (it has 16 of the 20 the reference logs)."""
    b = event_bars(spark, sf)
    feats = indicators(b).drop("_i")
    bt = sig.ema_rsi_backtest(b).select(*KEYS, TS, "signal", "confidence")
    j = feats.join(bt, [*KEYS, TS])
    j = j.select("*", (F.col("signal") == "BUY").cast("int").alias("pred"),
                 F.when(F.col("signal") == "BUY", F.col("confidence")).when(F.col("signal") == "SELL", 1.0 - F.col("confidence")).otherwise(F.lit(0.5)).alias("prob"))
    s = sig.snapshot(j, _E9_FEATS, model="ema_rsi_rule")
    return s.select(*KEYS, "row_timestamp", "pred", rounded("prob").alias("prob"), rounded("price").alias("price"), "model", *[rounded(c).alias(c) for c in _E9_FEATS])


@query(
    "e10_position_size",
    f"""WITH {bars_cte('1h')},
{_BACKTEST_SQL},
tr AS (SELECT *, greatest(high - low, abs(high - {q.lag('close')}), abs(low - {q.lag('close')})) AS tr FROM bars),
a AS (SELECT symbol, timeframe, timestamp, avg(tr) OVER {q.frame(14)} AS atr14 FROM tr),
t AS (SELECT * FROM (SELECT a.*, bt.signal FROM a JOIN bt USING (symbol, timeframe, timestamp))
      QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY timestamp DESC) = 1),
u AS (SELECT user_id, arg_max(event_type, ts) AS symbol FROM events GROUP BY user_id)
SELECT u.user_id, t.symbol, t.signal, round(c.c_acctbal, 6) + 0.0 AS balance, round(t.atr14, 6) + 0.0 AS stop,
  round(c.c_acctbal * 0.01 / NULLIF(t.atr14, 0), 6) + 0.0 AS position
FROM u JOIN customer c ON c.c_custkey = u.user_id JOIN t ON t.symbol = u.symbol""",
)
def e10_position_size(spark, sf):
    """Each user (a customer account) sizes a position in the symbol of their
    latest event: balance x 1 % risk / ATR14 stop of that symbol's last bar."""
    b = event_bars(spark, sf)
    a = atr(b).select(*KEYS, TS, "atr14")
    bt = sig.ema_rsi_backtest(b).select(*KEYS, TS, "signal")
    last = latest_per_series(a.join(bt, [*KEYS, TS]))
    users = table(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_type", "ts").alias("symbol"))
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance"))
    j = users.join(cust, "user_id").join(last, "symbol")
    return j.select(
        "user_id", "symbol", "signal", rounded("balance").alias("balance"), rounded("atr14").alias("stop"),
        rounded(sig.position_size(F.col("balance"), F.lit(0.01), F.col("atr14"))).alias("position"),
    )


@query(
    "e11_multi_horizon",
    f"""WITH {bars_cte('15m', 'b15')}, {bars_cte('1h', 'b60')}, {bars_cte('4h', 'b240')},
bars AS (SELECT * FROM b15 UNION ALL SELECT * FROM b60 UNION ALL SELECT * FROM b240),
{_BACKTEST_SQL}
SELECT {KEYS_SQL}, signal, {q.r('confidence', 'confidence')}, {q.r('close', 'close')} FROM bt
QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY timestamp DESC) = 1""",
)
def e11_multi_horizon(spark, sf):
    """Latest rule signal for every symbol at 15m, 1h and 4h in one job."""
    b = union_all([event_bars(spark, sf, tf) for tf in ("15m", "1h", "4h")])
    return out(sig.latest_signal(b), ["confidence", "close"], ["signal"])


# ---------------------------------------------------------------- metrics


@query("g1_accuracy", with_bars(f"{_SCORE_SQL}\nSELECT symbol, timeframe, round(avg(CAST(pred = y AS DOUBLE)), 6) + 0.0 AS accuracy, count(*) AS n FROM ev GROUP BY 1, 2"))
def g1_accuracy(spark, sf):
    d = met.accuracy(scored(spark, sf), by=KEYS)
    return d.select(*KEYS, rounded("accuracy").alias("accuracy"), "n")


@query(
    "g2_precision_recall",
    with_bars(f"""{_SCORE_SQL}
SELECT symbol, timeframe,
  round(coalesce(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) / NULLIF(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END), 0), 0.0), 6) + 0.0 AS precision,
  round(coalesce(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) / NULLIF(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END), 0), 0.0), 6) + 0.0 AS recall
FROM ev GROUP BY 1, 2"""),
)
def g2_precision_recall(spark, sf):
    d = met.precision_recall(scored(spark, sf), by=KEYS)
    return d.select(*KEYS, rounded("precision").alias("precision"), rounded("recall").alias("recall"))


@query(
    "g3_classification_report",
    with_bars(f"""{_SCORE_SQL},
ex AS (SELECT CAST(y AS VARCHAR) AS cls, 1 AS t, 0 AS p, CAST(y = pred AS INTEGER) AS tp FROM ev
      UNION ALL SELECT CAST(pred AS VARCHAR), 0, 1, 0 FROM ev),
per AS (SELECT cls, sum(t) AS support, sum(p) AS predicted, sum(tp) AS tp FROM ex GROUP BY cls),
pc AS (SELECT cls, coalesce(tp / NULLIF(predicted, 0), 0.0) AS precision, coalesce(tp / NULLIF(support, 0), 0.0) AS recall, support, tp FROM per),
pf AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM pc),
tot AS (SELECT avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
   sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf,
   sum(support) AS n, sum(tp) / sum(support) AS acc FROM pf),
rep AS (SELECT cls AS class, precision, recall, f1, support FROM pf
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, n FROM tot
  UNION ALL SELECT 'weighted avg', wp, wr, wf, n FROM tot)
SELECT class, {q.r('precision', 'precision')}, {q.r('recall', 'recall')}, {q.r('f1', 'f1')}, CAST(support AS BIGINT) AS support FROM rep"""),
)
def g3_classification_report(spark, sf):
    d = met.classification_report(scored(spark, sf), by=())
    return d.select("class", *[rounded(c).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long").alias("support"))


@query(
    "g4_confusion_matrix",
    with_bars(f"""{_SCORE_SQL}
SELECT symbol, timeframe, y, count(*) FILTER (WHERE pred = 0) AS "0", count(*) FILTER (WHERE pred = 1) AS "1" FROM ev GROUP BY 1, 2, 3"""),
)
def g4_confusion_matrix(spark, sf):
    return met.confusion(scored(spark, sf), by=KEYS)


@query(
    "g4_confusion_other_class",
    with_bars(f"""{_SCORE_SQL},
x AS (SELECT symbol, timeframe, y, CASE WHEN signal = 'NoSignal' THEN 2 ELSE pred END AS p FROM ev),
sq AS (SELECT DISTINCT x.symbol, x.timeframe, c.y FROM x, (VALUES (0), (1), (2)) c(y))
SELECT sq.symbol, sq.timeframe, sq.y, count(*) FILTER (WHERE p = 0) AS "0", count(*) FILTER (WHERE p = 1) AS "1", count(*) FILTER (WHERE p = 2) AS "2"
FROM sq LEFT JOIN x ON x.symbol = sq.symbol AND x.timeframe = sq.timeframe AND x.y = sq.y GROUP BY 1, 2, 3"""),
)
def g4_confusion_other_class(spark, sf):
    """Predictions of a class that never occurs keep their column, and the class its row."""
    d = scored(spark, sf).withColumn("pred", F.when(F.col("signal") == "NoSignal", 2).otherwise(F.col("pred")))
    return met.confusion(d, by=KEYS)


@query(
    "g6_pr_curve",
    with_bars(f"""{_SCORE_SQL},
t AS (SELECT symbol, timeframe, score * 7 - 3 AS score, sum(y) AS pos, sum(1 - y) AS neg FROM ev GROUP BY 1, 2, 3),
c AS (SELECT *, sum(pos) OVER (PARTITION BY symbol, timeframe ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (PARTITION BY symbol, timeframe ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
               sum(pos) OVER (PARTITION BY symbol, timeframe) AS P FROM t)
SELECT symbol, timeframe, round(score, 6) + 0.0 AS threshold, round(coalesce(tp / NULLIF(tp + fp, 0), 0.0), 6) + 0.0 AS precision, round(coalesce(tp / NULLIF(P, 0), 0.0), 6) + 0.0 AS recall FROM c"""),
)
def g6_pr_curve(spark, sf):
    """The whole precision-recall curve, over scores outside [0, 1]."""
    d = met.pr_curve(scored(spark, sf).withColumn("score", F.col("score") * 7 - 3), by=KEYS)
    return d.select(*KEYS, *[rounded(c).alias(c) for c in ("threshold", "precision", "recall")])


@query(
    "g10_strict_leakage_found",
    with_bars(f"""lf AS (SELECT *, {q.lead('close')} AS fc FROM bars),
agg AS (SELECT symbol, timeframe, corr(2 * fc + 1, fc) AS leaky, corr(volume, fc) AS volume FROM lf WHERE fc IS NOT NULL GROUP BY 1, 2),
lng AS (UNPIVOT agg ON leaky, volume INTO NAME feature VALUE corr)
SELECT symbol, timeframe, feature, round(corr, 6) + 0.0 AS corr FROM lng WHERE abs(corr) > 0.9"""),
)
def g10_strict_leakage_found(spark, sf):
    """A feature made of the next close is found; the volume is not."""
    d = indicators(event_bars(spark, sf), next_close=True).withColumn("leaky", 2 * F.col("future_close") + 1)
    return qual.strict_leakage(d, ["leaky", "volume"]).select(*KEYS, "feature", rounded("corr").alias("corr"))


@query("b5_regularise_other_timeframe", f"WITH {bars_cte('1h', 'b60')}\nSELECT {KEYS_SQL.replace('timeframe', chr(39) + '2h' + chr(39) + ' AS timeframe')}, " + ", ".join(q.r(c, c) for c in PRICE_COLS) + " FROM b60")
def b5_regularise_other_timeframe(spark, sf):
    """Series of a timeframe without a known length keep their bars."""
    return out(regularise(event_bars(spark, sf).withColumn("timeframe", F.concat(F.lit("2"), F.substring("timeframe", 2, 1)))), PRICE_COLS)


_AUC_SQL = f"""{_SCORE_SQL},
t AS (SELECT symbol, timeframe, score, sum(y) AS pos, sum(1 - y) AS neg FROM ev GROUP BY 1, 2, 3),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY symbol, timeframe ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM t)"""


@query(
    "g5_roc_auc",
    with_bars(f"""{_AUC_SQL}
SELECT symbol, timeframe, round(sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) + 0.0 AS roc_auc FROM c GROUP BY 1, 2"""),
)
def g5_roc_auc(spark, sf):
    d = met.roc_auc(scored(spark, sf), by=KEYS)
    return d.select(*KEYS, rounded("roc_auc").alias("roc_auc"))


@query(
    "g6_best_f1_threshold",
    with_bars(f"""{_SCORE_SQL},
t AS (SELECT symbol, timeframe, score, sum(y) AS pos, sum(1 - y) AS neg FROM ev GROUP BY 1, 2, 3),
c AS (SELECT *, sum(pos) OVER (PARTITION BY symbol, timeframe ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (PARTITION BY symbol, timeframe ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
               sum(pos) OVER (PARTITION BY symbol, timeframe) AS P FROM t),
p AS (SELECT *, coalesce(tp / NULLIF(tp + fp, 0), 0.0) AS pr, coalesce(tp / NULLIF(P, 0), 0.0) AS rc FROM c),
f AS (SELECT *, 2.0 * pr * rc / (pr + rc + {q.d(1e-12)}) AS f1 FROM p)
SELECT symbol, timeframe, round(arg_max(score, (f1, -score)), 6) + 0.0 AS best_threshold, round(max(f1), 6) + 0.0 AS best_f1 FROM f GROUP BY 1, 2"""),
)
def g6_best_f1_threshold(spark, sf):
    d = met.best_f1_threshold(scored(spark, sf), by=KEYS)
    return d.select(*KEYS, rounded("best_threshold").alias("best_threshold"), rounded("best_f1").alias("best_f1"))


@query(
    "g8_prequential",
    with_bars(f"""{_SCORE_SQL},
rr AS (SELECT symbol, timeframe, timestamp, row_number() OVER ({q.ORDER}) AS seen,
  sum(CAST(y = pred AS DOUBLE)) OVER {q.frame()} AS ok, sum(CAST(y = 1 AND pred = 1 AS DOUBLE)) OVER {q.frame()} AS tp,
  sum(CAST(pred = 1 AS DOUBLE)) OVER {q.frame()} AS pp, sum(CAST(y = 1 AS DOUBLE)) OVER {q.frame()} AS ap FROM ev)
SELECT symbol, timeframe, timestamp, seen, round(ok / seen, 6) + 0.0 AS accuracy,
  round(coalesce(tp / NULLIF(pp, 0), 0.0), 6) + 0.0 AS precision, round(coalesce(tp / NULLIF(ap, 0), 0.0), 6) + 0.0 AS recall
FROM rr WHERE seen % 50 = 0"""),
)
def g8_prequential(spark, sf):
    d = met.prequential(scored(spark, sf))
    return d.select(*KEYS, TS, F.col("seen").cast("long").alias("seen"), *[rounded(c).alias(c) for c in ("accuracy", "precision", "recall")])


# ---------------------------------------------------------------- quality and leakage

_LEAK_FEATS = [c for c in (*PRICE_COLS, *INDICATOR_COLS) if c != "close"]


def _corr_sql(f: str) -> str:
    a = f"CASE WHEN {f} IS NOT NULL AND fc IS NOT NULL THEN {f} END"
    b = f"CASE WHEN {f} IS NOT NULL AND fc IS NOT NULL THEN fc END"
    return f"covar_samp({a}, {b}) / NULLIF(stddev_samp({a}) * stddev_samp({b}), 0)"


_LEAK_SQL = f"""{_BUNDLE_SQL},
lf AS (SELECT *, {q.lead('close')} AS fc FROM f),
agg AS (SELECT symbol, timeframe, {", ".join(f"{_corr_sql(f)} AS {f}" for f in _LEAK_FEATS)} FROM lf GROUP BY 1, 2),
lng AS (UNPIVOT agg ON {", ".join(_LEAK_FEATS)} INTO NAME feature VALUE corr)"""
_LEAK_SQL_NULLS = _LEAK_SQL.replace(
    f'lng AS (UNPIVOT agg ON {", ".join(_LEAK_FEATS)} INTO NAME feature VALUE corr)',
    f'lng AS (SELECT * FROM agg UNPIVOT INCLUDE NULLS (corr FOR feature IN ({", ".join(_LEAK_FEATS)})))',
)


@query(
    "g9_leakage_correlation",
    with_bars(f"""{_LEAK_SQL_NULLS}
SELECT symbol, timeframe, feature, round(corr, 6) + 0.0 AS corr,
  row_number() OVER (PARTITION BY symbol, timeframe ORDER BY abs(corr) DESC NULLS LAST, feature) AS rank FROM lng
QUALIFY rank <= 30"""),
)
def g9_leakage_correlation(spark, sf):
    d = qual.leakage_correlations(indicators(event_bars(spark, sf), next_close=True), _LEAK_FEATS)
    return d.select(*KEYS, "feature", rounded("corr").alias("corr"), F.col("rank").cast("long").alias("rank"))


@query(
    "g10_strict_leakage",
    with_bars(f"{_LEAK_SQL}\nSELECT symbol, timeframe, feature, round(corr, 6) + 0.0 AS corr FROM lng WHERE abs(corr) > 0.9"),
)
def g10_strict_leakage(spark, sf):
    d = qual.strict_leakage(indicators(event_bars(spark, sf), next_close=True), _LEAK_FEATS)
    return d.select(*KEYS, "feature", rounded("corr").alias("corr"))


_SHIFT_FEATS = ["open", "close_lag_1", "close_lag_2", "close_lag_3", "future_close"]
_SHIFTS = [k for k in range(-5, 6) if k != 0]


@query(
    "g11_shift_matches",
    with_bars(f"""a AS (SELECT *, {q.lag('close', 1)} AS close_lag_1, {q.lag('close', 2)} AS close_lag_2, {q.lag('close', 3)} AS close_lag_3,
  {q.lead('close', 1)} AS future_close, {", ".join(f"{q.lag('close', k) if k > 0 else q.lead('close', -k)} AS sh{k + 5}" for k in _SHIFTS)} FROM bars),
agg AS (SELECT symbol, timeframe, {", ".join(f"bool_and({f} IS NOT DISTINCT FROM sh{k + 5}) AS \"{f}|{k}\"" for f in _SHIFT_FEATS for k in _SHIFTS)} FROM a GROUP BY 1, 2),
lng AS (UNPIVOT agg ON {", ".join(f'"{f}|{k}"' for f in _SHIFT_FEATS for k in _SHIFTS)} INTO NAME pair VALUE equal)
SELECT symbol, timeframe, split_part(pair, '|', 1) AS feature, CAST(split_part(pair, '|', 2) AS INTEGER) AS shift FROM lng WHERE equal"""),
)
def g11_shift_matches(spark, sf):
    """Which of open, three close lags and the next close equal close shifted by k."""
    b = lags(event_bars(spark, sf), "close", (1, 2, 3))
    from tickweave.operators.indicators import lead as lead_, windowed

    b = windowed(b, [[("future_close", lead_("close", 1))]], fwd=1)
    return qual.shift_matches(b, _SHIFT_FEATS)


_Q_SQL = """SELECT symbol, timeframe, count(*) AS rows, CAST(17 AS BIGINT) AS cols, 0.0 AS missing_ratio,
  round(avg(rsi14), 6) + 0.0 AS rsi_mean, round(avg(macd), 6) + 0.0 AS macd_mean, round(stddev_samp(return1), 6) + 0.0 AS return_std"""


def _qout(d):
    return d.select(*KEYS, "rows", "cols", rounded("missing_ratio").alias("missing_ratio"), *[rounded(c).alias(c) for c in ("rsi_mean", "macd_mean", "return_std")])


@query("g12_quality_stats", with_bars(f"{_BUNDLE_SQL}\n{_Q_SQL} FROM f GROUP BY 1, 2"))
def g12_quality_stats(spark, sf):
    return _qout(qual.quality_stats(indicators(event_bars(spark, sf)).drop("_i")))


@query(
    "g13_quality_summary",
    f"""WITH {bars_cte('15m', 'b15')}, {bars_cte('1h', 'b60')}, {bars_cte('4h', 'b240')},
bars AS (SELECT * FROM b15 UNION ALL SELECT * FROM b60 UNION ALL SELECT * FROM b240),
{_BUNDLE_SQL}
{_Q_SQL} FROM f GROUP BY 1, 2""",
)
def g13_quality_summary(spark, sf):
    """Quality stats for every series at three timeframes in one job."""
    b = union_all([event_bars(spark, sf, tf) for tf in ("15m", "1h", "4h")])
    return _qout(qual.quality_stats(indicators(b).drop("_i")))
