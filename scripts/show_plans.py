"""Write PLANS.md: final physical plans (tree part) of the headline operators.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmart import queries as Q  # noqa: E402
from tripmart.operators.curate import curate_trips  # noqa: E402
from tripmart.operators.quality import validate_trips  # noqa: E402
from tripmart.session import builder  # noqa: E402
from tripmart.sources.tables import scan_curated, scan_raw, scan_target_month  # noqa: E402


def tree(df) -> str:
    df.collect()  # run this DataFrame itself, so its adaptive plan is final (tiny results)
    jvm = df.sparkSession._jvm
    s = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    top = s.split("\n\n")[0]
    details = [line for line in s.splitlines()
               if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    return top + "\n\n" + "\n".join(d[:400] for d in details)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = builder("local[*]", 8).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    landed = Q.landed_root(spark, sf)
    cur = Q.curated_root(spark, sf)
    z = Q.zones(spark, sf)
    plans = {
        "validate over the landed raw scan": validate_trips(curate_trips(scan_raw(spark, landed))),
        "daily_borough over the curated table": Q.marts.daily_borough(scan_curated(spark, cur), z),
        "daily_zone over the curated table": Q.marts.daily_zone(scan_curated(spark, cur), z),
        "daily_service over the curated table": Q.marts.daily_service(scan_curated(spark, cur)),
        "target month scan": scan_target_month(spark, cur, "1998", "02"),
    }
    out = ["# PLANS", "", f"Final adaptive plans (after execution) at `{sf}`, from `scripts/show_plans.py`.", ""]
    for title, df in plans.items():
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
