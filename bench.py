"""Headline benchmark: prints one JSON line with per-query seconds.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is timed end to end (plan + all jobs + collect of the result); rule
generation includes mining, the forest query includes split and training.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "q0_state_profile",        # clean + features + grouped stats (flagship)
    "e13_export_summary",      # cleaning, validation and both products
    "g1_mode_table",           # stacked mode table
    "g17_concentration_index", # value-count compression, closed form R
    "g9_kde",                  # density on a grid from the value-count table
    "h2_pearson_matrix",       # pairwise-complete correlation
    "h3_flag_category_correlation",
    "i7_apriori",              # Apriori on weighted baskets, min_support 0.02, k <= 3
    "i8_apriori_bitmaps",      # Apriori on vertical bitmaps, same thresholds
    "i9_fp_growth",            # pattern growth on projected baskets, same thresholds
    "i13_generate_rules",      # all-split rules (includes mining)
    "j4_stratified_split",     # exact stratified split
    "j8_classification_report",
    "j6_train_forest",         # 100 trees, split and encoding included
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from regmine.session import get_session
    from regmine.plans import catalog
    spark = get_session(f"local[{cpus}]", app="regmine-bench", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM start, class loading, first parquet footers
    catalog.raw(spark, sf_dir).count()
    times, rows = {}, {}
    for name in HEADLINE:
        t = time.perf_counter()
        out = catalog.QUERIES[name](spark, sf_dir).collect()
        times[name] = round(time.perf_counter() - t, 3)
        rows[name] = len(out)
    core = core_mining(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "core_mining": core,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))


def core_mining(spark, sf_dir) -> dict:
    """Mining on an already prepared transaction table (checkpointed), the
    setting of the reference's published timings (min_support 0.02, k <= 3,
    min_confidence 0.70)."""
    from regmine.operators import itemsets as I, rules as R, vertical as V
    from regmine.plans import catalog
    out = {}
    t = time.perf_counter()
    tx = I._checkpoint(catalog.transactions(spark, sf_dir).select("items"))
    out["n_transactions"] = tx.count()
    out["prepare_transactions"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    ap = I.apriori(tx, 0.02, 3)
    n_sets = len(ap.itemsets.collect())
    out["apriori"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    V.apriori_bitmaps(tx, 0.02, 3).itemsets.collect()
    out["apriori_bitmaps"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    fp = I.fp_growth(tx, 0.02, 3)
    fp.itemsets.collect()
    out["fp_growth"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    n_rules = len(R.generate_rules(ap.itemsets, ap.n_transactions, 0.70).collect())
    out["rules"] = round(time.perf_counter() - t, 3)
    out["itemsets"], out["rules_count"] = n_sets, n_rules
    return out


if __name__ == "__main__":
    main()
