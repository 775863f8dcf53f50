"""Top-k per group and the positional crosstab."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                    k: int, rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..k inside each group by ``order_cols``.

    ``row_number() <= k`` on an integer rank lets Spark put a partial
    group limit before the shuffle: each map task sends at most k rows per
    group, so a group with few keys but much data (a month) stays cheap.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def positional_pivot(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[Column],
                     value_col: str, names: Sequence[str]) -> DataFrame:
    """Crosstab by position: per key, values in ``order_cols`` order fill the
    output columns ``names`` left to right; missing positions are NULL and
    values past the last column are not shown.  The category value itself
    does not pick the column (a key that only has its second category still
    fills the first column)."""
    n = len(names)
    ranked = top_k_per_group(df, key_cols, order_cols, n, "_pos")
    wide = ranked.groupBy(*key_cols).pivot("_pos", list(range(1, n + 1))).agg(F.first(value_col))
    return wide.select(*key_cols, *[F.col(str(i + 1)).alias(name) for i, name in enumerate(names)])
