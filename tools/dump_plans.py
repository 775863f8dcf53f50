"""Write the physical plan of every report query to PLANS.md.

Plans are taken at sf0.01 with the package's session settings (plan-time
broadcast off, so joins appear as they would between large tables; AQE
may still turn a join into a broadcast at run time).  Jobs that write
tables are left out: their returned frame is a plain table scan.

    python tools/dump_plans.py /root/testdata/sf0.01 PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.plans import registry  # noqa: E402
from ledgerlens.session import get_session  # noqa: E402

SKIP = {"load_normalized_table", "load_all_tables", "monthly_status_loaded", "script_to_table", "script_run_log", "append_rows",
        "table_roundtrip", "csv_roundtrip", "incremental_load", "replace_after_failed_load", "append_batches_once",
        "quarantined_rows", "types_over_arriving_files", "script_with_month_values"}


def main(sf_dir: str, out: str) -> None:
    spark = get_session(shuffle_partitions=8)
    parts = ["# Physical plans\n",
             "Generated by `tools/dump_plans.py` at sf0.01 (plan-time broadcast off; "
             "AQE may re-plan at run time).  Exchanges are the shuffles; `PushedFilters` and "
             "`ReadSchema` show what reaches the Parquet scan.\n"]
    for name, fn in registry.QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln[:200] for ln in plan.splitlines()]
        parts.append(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
