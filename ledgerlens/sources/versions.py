"""Crash-safe replacement of catalog tables: staged write, then one catalog swap.

A replaceable table is a view over one of its versions.  ``replace_table`` writes
the rows into a new version under a name of its own and then points the view to it
with one ``CREATE OR REPLACE VIEW``: until that moment, and if the write fails or
the driver dies, every reader sees the version before, whole.  Schema and layout
(partitions, buckets) belong to the version, so both may change.

Queries planned before a swap go on reading their version's files; ``KEPT`` earlier
versions stay for them and older ones are dropped after the swap.  What a failed
run left behind is dropped by the next successful one: a version that is not
registered at the swap's time was never shown to anybody.  Two replacements of one
name at once each write a version of their own; the later swap wins, whole.

A plain table of that name becomes the first version (a rename in the catalog, the
only moment without the name; ``recover_name`` finishes what a crash there began).
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

#: Earlier versions kept for readers that planned before the swap.
KEPT = 1
MARK = "__v"
PROPERTY = "ledgerlens.version"


def split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """Database and table of a name; the current database if it names none."""
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def versions(spark: SparkSession, name: str) -> list[str]:
    """The registered versions of a name, oldest first."""
    database, table = split_name(spark, name)
    found = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}{MARK}*'").collect()]
    own = re.compile(re.escape(table + MARK) + r"[0-9]{20}_[0-9a-f]{8}", re.IGNORECASE)
    return [f"{database}.{t}" for t in sorted(found) if own.fullmatch(t)]


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version a replaceable table shows; None for plain tables and unknown names."""
    if not is_view(spark, name):
        return None
    database, table = split_name(spark, name)
    for row in spark.sql(f"SHOW TBLPROPERTIES {database}.{table}").collect():
        if row["key"] == PROPERTY:
            return row["value"]
    return None


def physical_table(spark: SparkSession, name: str) -> str:
    """The table that holds the rows of ``name`` (for inserts)."""
    return current_version(spark, name) or name


def new_version(spark: SparkSession, name: str, stamp: int | None = None) -> str:
    """An unused version name; names sort by the time they were made (or ``stamp``)."""
    database, table = split_name(spark, name)
    return f"{database}.{table}{MARK}{time.time_ns() if stamp is None else stamp:020d}_{uuid.uuid4().hex[:8]}"


def show_version(spark: SparkSession, name: str, version: str, rows: str = "SELECT * FROM {version}") -> None:
    """The swap: from here on ``name`` shows ``version`` (or what ``rows`` selects of it)."""
    database, table = split_name(spark, name)
    if spark.catalog.tableExists(f"{database}.{table}") and not is_view(spark, f"{database}.{table}"):
        spark.sql(f"ALTER TABLE {database}.{table} RENAME TO {new_version(spark, name, stamp=0)}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} TBLPROPERTIES ('{PROPERTY}' = '{version}') AS {rows.format(version=version)}")


def recover_name(spark: SparkSession, name: str) -> str | None:
    """If a crash left a renamed plain table without its name, show it again."""
    if spark.catalog.tableExists(name):
        return None
    plain = [v for v in versions(spark, name) if f"{MARK}{0:020d}_" in v.lower()]
    if plain:
        show_version(spark, name, plain[-1])
    return plain[-1] if plain else None


def drop_old_versions(spark: SparkSession, name: str, kept: int = KEPT) -> list[str]:
    """Drop all but the shown version and the ``kept`` registered just before it.
    Later ones are left alone: they belong to a replacement under way."""
    shown = current_version(spark, name)
    before = [v for v in versions(spark, name) if shown is not None and v.lower() < shown.lower()]
    gone = before[:len(before) - kept] if kept else before
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    return gone


def replace_table(rows: DataFrame, name: str, layout: Callable[[DataFrameWriter], DataFrameWriter] | None = None,
                  kept: int = KEPT, views: dict[str, str] | None = None,
                  before_swap: Callable[[], None] | None = None) -> int:
    """Replace ``name`` with the rows, which may read its present version; the rows written.

    ``views`` gives several names, each with its select over ``{version}``, that show
    parts of one version (each is swapped by itself, ``name`` last).  ``before_swap`` is
    called once the version is written; if it raises, nothing is shown.  ``layout`` may add partitions or buckets to the writer.  If the write fails, ``name``
    is as it was and the exception goes on to the caller."""
    spark = rows.sparkSession
    version = new_version(spark, name)
    counted = Observation()
    writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("error")
    try:
        (layout(writer) if layout else writer).saveAsTable(version)
        if before_swap:
            before_swap()
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for view, select in (views or {}).items():
        if view != name:
            show_version(spark, view, version, select)
    show_version(spark, name, version, (views or {}).get(name, "SELECT * FROM {version}"))
    drop_old_versions(spark, name, kept)
    return int(counted.get.get("rows") or 0)


def drop_replaceable(spark: SparkSession, name: str) -> None:
    """Drop a table, replaceable or plain, with all its versions."""
    if is_view(spark, name):
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for version in versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {version}")
