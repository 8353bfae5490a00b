"""Headline queries on the bench tables; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.catalog import load  # noqa: E402
from tickloom.session import build_session  # noqa: E402

HEADLINE = ["a03_roll_up", "a02_gap_fill", "i02_atr", "i05_adx", "i06_bollinger", "i07_cci", "i09_macd", "i10_obv", "i11_rsi_wilder",
            "j01_asof_last_n_pattern", "j02_asof_latest", "j04_forward_range", "j05_backward_range", "j06_interval_join",
            "a04_max_gain_loss", "a07_trailing_ranges", "a10_market_state_row", "d02_history_pattern", "d01_live_pattern",
            "a11_inventory", "a36_symbol_freshness", "w02_spread_anomaly", "s18_update_incomplete", "k02_pattern_limits",
            "v02_vector_backfill", "v05_knn_join", "t04_stream_bars", "m09_metrics"]


def main():
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    only = sys.argv[1:]
    names = [n for n in HEADLINE if not only or n in only] or only
    spark.range(1000).selectExpr("sum(id)").collect()
    times, rows = {}, {}
    for name in names:
        start = time.time()
        rows[name] = queries[name](spark, path).count() if name.startswith("t") else _run(queries[name](spark, path))
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}s {rows[name]} rows", file=sys.stderr, flush=True)
    docs = times.get("d02_history_pattern")
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": os.path.basename(path.rstrip("/")).replace("sf", "")}
    if docs:
        out["documents_per_sec"] = round(rows["d02_history_pattern"] / docs, 1)
    ind = [n for n in times if n.startswith("i")]
    if ind:
        out["indicator_rows_per_sec"] = round(sum(rows[n] for n in ind) / sum(times[n] for n in ind), 1)
    print(json.dumps(out))


def _run(df):
    """Compute every column of every row (a bare count would prune the columns away)."""
    from pyspark.sql import functions as F
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns) % 1000)).first()[0]


if __name__ == "__main__":
    main()
