"""Write PLANS.md: physical-plan summaries of the headline queries.

usage: python plan_report.py [sf_dir]
"""

from __future__ import annotations

import json
import sys


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from regmine.session import get_session
    from regmine.plans.catalog import QUERIES
    from regmine.plans.inspect import plan_summary
    from bench import HEADLINE
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `plan_report.py` on `{sf}` (initial AQE plans; eager one-row "
           "statistics and checkpoints already run). Scans list the columns read "
           "(`ReadSchema`) and filters pushed to Parquet.", ""]
    for name in HEADLINE:
        s = plan_summary(QUERIES[name](spark, sf))
        out += [f"## {name}", "", "```json", json.dumps(s, indent=1, ensure_ascii=False), "```", ""]
    open("PLANS.md", "w").write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
