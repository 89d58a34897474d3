"""Headline benchmark: prints one JSON line.

indicator bundle, ternary label, backtest, leakage scan, quality summary) at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.

Two bar sets: 1-minute bars from ``events`` (5 symbols) and daily bars from
``lineitem`` (one series per supplier, regularised onto a full daily grid;
2.5M rows at sf0.1).  Each query is forced with a ``noop`` write, so the whole
plan runs and nothing is collected.  Times are the median of ``$BENCH_RUNS``
(default 1) runs, after every query ran once on the sf0.001 tables (warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickweave.operators import indicators as ind  # noqa: E402
from tickweave.operators import labels as lab  # noqa: E402
from tickweave.operators import quality as qual  # noqa: E402
from tickweave.operators import signals as sig  # noqa: E402
from tickweave.operators.bars import regularise, resample_bars  # noqa: E402
from tickweave.plans.inputs import event_bars, lineitem_bars  # noqa: E402
from tickweave.schema import INDICATOR_COLS, PRICE_COLS  # noqa: E402
from tickweave.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")


def filled_grid(bars):
    """The reference's gap handling, ``asfreq().ffill().bfill()``, in one pass."""
    return regularise(bars, fill="ffill_bfill")


def build(spark, sf=None):
    sf = sf or SF_DIR
    ev1m = lambda: event_bars(spark, sf, "1m")
    daily = lambda: lineitem_bars(spark, sf, "1d")
    feats = [c for c in (*PRICE_COLS, *INDICATOR_COLS) if c != "close"]
    return {
        "resample_1m": lambda: ev1m(),
        "resample_1m_to_4h": lambda: resample_bars(ev1m(), "4h"),
        "regularise_fill_daily": lambda: filled_grid(daily()),
        "indicators_daily": lambda: ind.indicators(filled_grid(daily()), gaps=False),
        "indicators_1m": lambda: ind.indicators(filled_grid(ev1m()), gaps=False),
        "ternary_label_daily": lambda: lab.ternary_label(filled_grid(daily()).withColumn("timeframe", F.lit("1h"))),
        "backtest_daily": lambda: sig.ema_rsi_backtest(filled_grid(daily()), gaps=False),
        "backtest_1m": lambda: sig.ema_rsi_backtest(ev1m(), gaps=False),
        "leakage_scan_daily": lambda: qual.leakage_correlations(ind.indicators(filled_grid(daily()), next_close=True, gaps=False), feats),
        "quality_summary_daily": lambda: qual.quality_stats(ind.indicators(filled_grid(daily()), gaps=False).drop("_i")),
    }


def run(spark, make):
    t = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t
    spark.catalog.clearCache()
    return dt


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2, app="tickweave-bench")
    qs = build(spark)
    # Warm-up on the smallest tables: JIT, code generation caches, Python
    # workers.  The timed runs then measure steady-state work at SF_DIR.
    if os.path.isdir(WARM_DIR) and os.path.abspath(WARM_DIR) != os.path.abspath(SF_DIR):
        for make in build(spark, WARM_DIR).values():
            run(spark, make)
    else:
        run(spark, qs["backtest_1m"])
    times = {}
    for name, make in qs.items():
        times[name] = round(statistics.median(run(spark, make) for _ in range(RUNS)), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf, "cpus": CPUS}))


if __name__ == "__main__":
    main()
