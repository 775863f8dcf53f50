"""A k-times larger copy of a test folder, derived from its tables: orders,
line items, customers and events are repeated k times with their keys
offset (so joins and sequences stay consistent); the other tables are
copied unchanged.

    python tools/scale_copy.py /root/testdata/sf0.1 /tmp/scale-XXXX/sf1.0 10
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlens.session import get_session  # noqa: E402
from ledgerlens.tables import TABLES  # noqa: E402

KEYS = {"orders": {"o_orderkey": "orders", "o_custkey": "customer"},
        "lineitem": {"l_orderkey": "orders"},
        "customer": {"c_custkey": "customer"},
        "events": {"event_id": "events"}}
SPAN = {"orders": ("orders", "o_orderkey"), "customer": ("customer", "c_custkey"),
        "events": ("events", "event_id")}


def main(src: str, dst: str, k: int) -> None:
    spark = get_session()
    span = {name: spark.read.parquet(f"{src}/{t}.parquet").agg(F.max(c)).first()[0] + 1
            for name, (t, c) in SPAN.items()}
    for t in TABLES:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in KEYS:
            df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            for col, kind in KEYS[t].items():
                df = df.withColumn(col, F.col(col) + F.col("_copy") * span[kind])
            df = df.drop("_copy")
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
