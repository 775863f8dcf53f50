"""Joins whose hot keys are spread by design, whatever the file layout.

AQE splits a skewed join partition by ranges of map outputs; an input that arrives
in one file, or with all rows of a key in one task, cannot be split that way.  Here
the hot keys are found first and their rows dealt to several parts by a hash of the
row; the other side's rows of these keys are copied to every part.

Hot keys come from a bounded sketch: rows are counted in ``CELLS`` cells by a hash of
the key (each task ships at most that many counts), and only keys of cells with
enough rows are then counted one by one.  A key with ``least`` rows fills its cell
by itself, so none is missed; there are at most rows / ``least`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of the sketch.
CELLS = 1 << 14
#: A key is hot when it holds more than this share of a shuffle partition's even part.
HOT_SHARE = 0.25
#: Parts of a hot key hold about this share of a shuffle partition's even part.
PART_SHARE = 1 / 16
#: Join types that the copied side's rows do not outlive.
TYPES = ("inner", "left", "leftouter", "left_outer", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti")


def hot_keys(rows: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """The keys with at least ``least`` rows, and their ``rows``; null keys join nothing and are left out."""
    keyed = rows.select(*[F.col(f"`{k}`") for k in keys]).where(present(keys)).withColumn(
        "__cell", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(CELLS)).cast("int"))
    full = keyed.groupBy("__cell").count().where(F.col("count") >= least).select("__cell")
    return (keyed.join(F.broadcast(full), "__cell", "left_semi").groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least))


def present(keys: Sequence[str]):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"`{k}`").isNotNull()
    return out


def parted_keys(rows: DataFrame, keys: Sequence[str], partitions: int, hot_share: float = HOT_SHARE,
                part_share: float = PART_SHARE) -> tuple[list[tuple], int]:
    """(key columns..., parts) of the hot keys, at most ``partitions / hot_share`` of them, and
    the parts of the rows with a null key."""
    total, without = rows.agg(F.count(F.lit(1)), F.count_if(~present(keys))).first()
    even = max(1.0, total / partitions)
    size = max(1, int(even * part_share))
    found = hot_keys(rows, keys, max(2, int(even * hot_share))).collect()
    return [(*r[:-1], max(2, -(-int(r["rows"]) // size))) for r in found], max(1, -(-int(without) // size))


def spread_join(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", *,
                partitions: int | None = None, hot_share: float = HOT_SHARE, part_share: float = PART_SHARE) -> DataFrame:
    """``rows.join(other, keys, how)`` with the hot keys of ``rows`` in parts.

    ``partitions`` is the parallelism to aim at (default: the session's shuffle
    partitions).  Right and full joins raise: copied rows without a match would come
    out once for each part.  Equal rows of a hot key go to one part; what tells rows
    apart (an id) spreads them.  Rows with a null key, which match nothing, are dealt to
    parts too where the join keeps them.  Columns of map type cannot be hashed and raise."""
    keys = list(keys)
    if how not in TYPES:
        raise ValueError(f"{how} join: only the rows of the copied side that match may be returned")
    spark = rows.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found, null_parts = parted_keys(rows, keys, partitions, hot_share, part_share)
    if not found and null_parts == 1:
        return rows.join(other, keys, how)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    # a row for each hot key: their number is bounded by the sketch's threshold
    hot = F.broadcast(spark.createDataFrame(found, f"{kinds}, __parts int"))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    dealt = (rows.join(hot, keys, "left")
             .withColumn("__parts", F.when(~present(keys), null_parts).otherwise(F.col("__parts")))
             .withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(
                 F.pmod(F.xxhash64(F.lit("part"), *columns), F.col("__parts")).cast("int"))).drop("__parts"))
    copied = (other.join(hot, keys, "left")
              .withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1))).drop("__parts"))
    out = dealt.join(copied, [*keys, "__part"], how).drop("__part")
    rest = [c for c in rows.columns if c not in keys]
    if "semi" in how or "anti" in how:
        return out.select(*[F.col(f"`{c}`") for c in [*keys, *rest]])
    return out
