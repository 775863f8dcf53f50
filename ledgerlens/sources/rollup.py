"""Status reports kept up to date by adding partial results, without reading old rows.

A rollup holds, per keys and status, the rows and the exact amount so far, and the
batches they came from.  Taking in a batch aggregates that batch only, adds the result
to the rollup's partials and replaces the rollup in one catalog swap
(``sources.versions``): partials and batches change together or not at all, so a batch
counts once, however often it is sent and wherever a run before it ended.

The rollup has a row for each keys and status and one for each batch; it never grows
with the rows.  Two batches taken in at once: the later swap would lose the earlier
one's, which is noticed before the swap and raises; the batch is then sent again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.status import merged_partials, status_partials
from ledgerlens.sources.versions import current_version, replace_table

BATCH = "_batch"


class ConcurrentBatch(RuntimeError):
    """The rollup changed while a batch was being added."""


def taken_batches(spark: SparkSession, name: str) -> list[str]:
    """The batches in the rollup."""
    if not spark.catalog.tableExists(name):
        return []
    return [r[0] for r in spark.table(name).where(F.col(BATCH).isNotNull()).select(BATCH).collect()]


def partials(spark: SparkSession, name: str, keys: Sequence[str]) -> DataFrame:
    """The rollup's partial results: keys, ``_status``, ``n``, ``u``."""
    return spark.table(name).where(F.col(BATCH).isNull()).select(*keys, "_status", "n", "u")


def with_batch(rows: DataFrame, name: str, keys: Sequence[str], batch: str, status_col: str, amount_col: str) -> DataFrame:
    """The rollup's rows after the batch: reads the batch and the rollup, nothing else."""
    spark = rows.sparkSession
    both = status_partials(rows, keys, status_col, amount_col)
    batches = spark.createDataFrame([(batch,)], f"{BATCH} string")
    if spark.catalog.tableExists(name):
        both = both.unionByName(partials(spark, name, keys))
        batches = batches.unionByName(spark.table(name).where(F.col(BATCH).isNotNull()).select(BATCH))
    return merged_partials(both, keys).unionByName(batches, allowMissingColumns=True)


def add_batch(rows: DataFrame, name: str, keys: Sequence[str], batch: str, status_col: str = "status",
              amount_col: str = "totaldue") -> bool:
    """Add a batch of rows to the rollup; False if it is in there already."""
    spark = rows.sparkSession
    before = current_version(spark, name)
    if batch in taken_batches(spark, name):
        return False

    def unchanged() -> None:
        if current_version(spark, name) != before:
            raise ConcurrentBatch(f"{name} changed while batch {batch!r} was added")

    replace_table(with_batch(rows, name, keys, batch, status_col, amount_col).coalesce(1), name, before_swap=unchanged)
    return True
