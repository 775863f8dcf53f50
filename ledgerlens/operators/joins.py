"""Join helpers with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension side up to this many rows and bytes is shipped to every task.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 32 << 20


def is_small(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True when ``df`` has at most so many rows and bytes (of its rows as JSON).

    At most ``max_rows + 1`` rows are looked at, on the executors; two numbers
    reach the driver.  The answer is never kept: the files may have grown.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")) if df.columns else F.lit(0)
    n, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return n <= max_rows and (held or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a check of rows and bytes; otherwise the planner
    (shuffle join, or AQE's runtime broadcast once sizes are measured) decides."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
