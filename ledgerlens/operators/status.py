"""Counts and amounts per status code as fixed columns (one-hot + sum)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.money import money_units, sum_units, units_to_double
from ledgerlens.functions.status import STATUS_CODES


def status_breakdown(df: DataFrame, keys: Sequence[str], status_col: str = "status",
                     amount_col: str = "totaldue", codes=STATUS_CODES) -> DataFrame:
    """One row per ``keys``: a count column and an amount column per code.

    Rows are first aggregated per (keys, status) -- two aggregates per row
    instead of one CASE per code and column -- and that small result is
    pivoted over the fixed code list.  Both aggregates are partial-then-
    final, so each map task ships one row per group whatever the skew.
    Codes absent from a group give 0; amounts are exact whole units (see
    ``functions.money``).
    """
    return status_columns(status_partials(df, keys, status_col, amount_col), keys, codes)


def status_partials(df: DataFrame, keys: Sequence[str], status_col: str = "status", amount_col: str = "totaldue") -> DataFrame:
    """Rows (n) and whole amount units (u) per keys and status (``_status``): partial
    results that may be added up with those of other rows."""
    return (df.select(*keys, F.col(status_col).alias("_status"), money_units(amount_col).alias("_units"))
            .groupBy(*keys, "_status")
            .agg(F.count(F.lit(1)).alias("n"), sum_units(F.col("_units")).alias("u")))


def merged_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials of several sets of rows added up."""
    return partials.groupBy(*keys, "_status").agg(F.sum("n").alias("n"), F.sum("u").cast("decimal(38,0)").alias("u"))


def status_columns(per_status: DataFrame, keys: Sequence[str], codes=STATUS_CODES) -> DataFrame:
    """Partials, one for each keys and status, as a count and an amount column per code."""
    values = [code for code, _, _, _ in codes]
    wide = per_status.groupBy(*keys).pivot("_status", values).agg(F.first("n").alias("n"),
                                                                   F.first("u").alias("u"))
    counts = [F.coalesce(F.col(f"{code}_n"), F.lit(0)).cast("bigint").alias(cnt)
              for code, _, cnt, _ in codes]
    amounts = [units_to_double(F.coalesce(F.col(f"{code}_u"), F.lit(0))).alias(amt)
               for code, _, _, amt in codes]
    return wide.select(*keys, *counts, *amounts)


def status_pivot(df: DataFrame, keys: Sequence[str], status_col: str = "status",
                 codes=STATUS_CODES) -> DataFrame:
    """Counts per code with ``pivot`` over the fixed code list (no extra pass
    to discover values); missing codes give 0."""
    values = [code for code, _, _, _ in codes]
    wide = df.groupBy(*keys).pivot(status_col, values).agg(F.count(F.lit(1)))
    # Pivot columns are named after the codes; rename by map (absent names
    # are ignored), then absent counts become 0.
    wide = wide.withColumnsRenamed({str(code): cnt for code, _, cnt, _ in codes})
    return wide.select(*keys, *[F.coalesce(F.col(cnt), F.lit(0)).cast("bigint").alias(cnt)
                                for _, _, cnt, _ in codes])
