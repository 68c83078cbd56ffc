"""Run registered queries against their SQL oracles (DuckDB) and report.

usage: python check_oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import json
import sys
import time
import traceback


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    from regmine.session import get_session
    from regmine.plans.catalog import QUERIES, ORACLE
    from regmine.plans.verify import duck_connect, compare
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf)
    results = {}
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in ORACLE:
                r = compare(df, ORACLE[name], con)
            else:
                r = {"spark_rows": df.count(), "oracle": None, "match": None}
        except Exception as e:  # report and continue
            r = {"error": f"{type(e).__name__}: {str(e)[:400]}"}
            traceback.print_exc(limit=3)
        r["sec"] = round(time.time() - t, 2)
        results[name] = r
        status = "ERR" if "error" in r else ("ok" if r.get("match") else
                                             ("rows" if r.get("match") is None else "MISMATCH"))
        print(f"{status:8s} {name:40s} {json.dumps(r, default=str)[:600]}", flush=True)
    bad = [n for n, r in results.items() if "error" in r or r.get("match") is False]
    print(f"\n{len(results)} queries, {len(bad)} failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
