"""Runs of equal codes along an ordered key.

Two readings of "the same code several times in a row":

* by key arithmetic (``run_counts_by_key``, ``spaced_runs``): positions k,
  k-step, k-2*step, ... must all exist; a gap breaks the run and duplicate keys
  multiply;
* by ordering (``ordered_run_counts``): the rows sorted by key, gaps do not
  matter; duplicate keys are ordered by code.

All of them first collapse the rows to (key, code) with a count: duplicates and
hot keys meet before the shuffle and cannot swell a task.  The collapsed rows are
cut into ranges of the key, windows run inside a range, and the few rows of a
range that its neighbour needs are copied over.  The plan is the same for every
size.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Key values in a range of ``run_counts_by_key``.
RANGE_WIDTH = 16_384


def run_counts_by_key(df: DataFrame, order_col: str, code_col: str, length: int = 3, step: int = 1,
                      count_col: str = "cantidad_veces_seguidos", width: int = RANGE_WIDTH) -> DataFrame:
    """Per code: how many row chains k-(length-1)*step, ..., k-step, k of whole-number
    positions carry that code throughout.

    A code is listed (with 0) when it has any complete chain of positions, whatever
    the codes there; duplicates of a key multiply; NULL keys are in no chain.  A
    range holds ``width`` positions, so at most that many times the codes; the last
    (length-1)*step positions are copied to the next range, where they only look on.
    """
    reach = (length - 1) * step
    width = max(width, reach)
    key = F.col("_k")
    rows = (df.where(F.col(order_col).isNotNull()).groupBy(F.col(order_col).cast("bigint").alias("_k"), F.col(code_col).alias("_c"))
            .agg(F.count(F.lit(1)).alias("_n")))
    own = F.floor(key / F.lit(width)).cast("bigint")
    copies = F.when(F.pmod(key, F.lit(width)) >= width - reach, F.array(own, own + 1)).otherwise(F.array(own))
    ranged = rows.withColumn("_b", F.explode(copies)).repartition("_b")
    at = Window.partitionBy("_b").orderBy("_k")
    same = Window.partitionBy("_b", "_c").orderBy("_k")
    back = [(r * step) for r in range(1, length)]
    there = reduce(lambda a, b: a & b, [F.count(F.lit(1)).over(at.rangeBetween(-d, -d)) > 0 for d in back])
    chains = reduce(lambda a, b: a * b, [F.coalesce(F.sum("_n").over(same.rangeBetween(-d, -d)), F.lit(0)) for d in back])
    counted = ranged.select("_b", "_k", "_c", (F.col("_n") * chains).alias("_runs"), there.alias("_there"))
    return (counted.where(F.col("_there") & (own == F.col("_b")))
            .groupBy(F.col("_c").alias(code_col)).agg(F.sum("_runs").cast("bigint").alias(count_col)))


def ordered_run_counts(df: DataFrame, order_col: str, code_col: str, length: int = 3,
                       count_col: str = "cantidad_veces_seguidos", ranges: int | None = None) -> DataFrame:
    """Per code that occurs at least ``length`` times in a row when the rows are sorted
    by (order_col, code_col): how many rows end such a run (a maximal run of L rows
    counts L - length + 1).  Gaps in the key do not break a run; NULL keys come first.

    The ranges are cut at quantiles of the (numeric) key, as many as there are
    shuffle partitions unless ``ranges`` is given.  Every cut is a key that occurs, so
    no range is empty, and the ``length - 1`` groups before a range's first one lie in
    the ``length - 1`` ranges before it: their last groups are copied over.
    """
    need = length - 1
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(df.approxQuantile(order_col, [i / n for i in range(n)], 0.2 / n)))
    groups = df.groupBy(F.col(order_col).alias("_k"), F.col(code_col).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    if len(cuts) > 1:
        # range of a key by binary search; the first range starts with the least key
        splits = [-math.inf, *map(float, cuts[1:]), math.inf]
        groups = Bucketizer(splits=splits, inputCol="_d", outputCol="_r", handleInvalid="keep").transform(
            groups.withColumn("_d", F.col("_k").cast("double"))).drop("_d")
    else:
        groups = groups.withColumn("_r", F.lit(0.0))
    groups = groups.withColumn("_b", F.when(F.col("_k").isNull(), F.lit(-1)).otherwise(F.col("_r").cast("int"))).drop("_r")
    order = [F.asc_nulls_first("_k"), F.asc_nulls_first("_c")]
    inside = Window.partitionBy("_b").orderBy(*order)
    numbered = (groups.repartition("_b")
                .withColumn("_first", F.row_number().over(inside))
                .withColumn("_last", F.row_number().over(Window.partitionBy("_b").orderBy(F.desc_nulls_last("_k"), F.desc_nulls_last("_c")))))

    def ending(rows: DataFrame, window) -> DataFrame:
        """Rows of each group that end a run, from the groups before it."""
        before, same = F.lit(0).cast("bigint"), F.lit(True)
        for r in range(1, length):
            same = same & F.coalesce(F.lag("_c", r).over(window) == F.col("_c"), F.lit(False))
            before = before + F.when(same, F.lag("_n", r).over(window)).otherwise(F.lit(0))
        return rows.withColumn("_runs", F.greatest(F.lit(0), F.col("_n") - F.greatest(F.lit(0), need - before)))

    # the first groups of a range look at the last ones of the ranges before it:
    # at most length - 1 rows of a range on either side
    whole = ending(numbered, inside).where(F.col("_first") > need).select("_c", "_runs")
    heads = numbered.where(F.col("_first") <= need).select("_b", "_k", "_c", "_n", F.lit(True).alias("_own"))
    tails = (numbered.where(F.col("_last") <= need)
             .select(F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + need)).alias("_b"), "_k", "_c", "_n", F.lit(False).alias("_own")))
    edge = ending(heads.unionByName(tails), inside).where("_own").select("_c", "_runs")
    return (whole.unionByName(edge).groupBy(F.col("_c").alias(code_col))
            .agg(F.sum("_runs").cast("bigint").alias(count_col))
            .where(F.col(count_col) > 0))


def spaced_runs(df: DataFrame, order_col: str, code_col: str, step: int = 2,
                names=("first", "middle", "last")) -> DataFrame:
    """All columns of the row triples (k-2*step, k-step, k) that share one code, oldest
    first, columns named ``first_...``, ``middle_...``, ``last_...``, ordered by the last
    row, then by all columns.

    Equal rows are collapsed to one with a count, so a joined pair stands for all
    their combinations; these are spread over the tasks by their number before
    they are written out, and the sort has that number as its last key.
    """
    cols = df.columns
    rows = df.where(F.col(order_col).isNotNull() & F.col(code_col).isNotNull()).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    side = {p: rows.select(*[F.col(c).alias(f"{p}_{c}") for c in cols], F.col("_n").alias(f"_n_{p}"),
                           (F.col(order_col) + d * step).alias("_at"), F.col(code_col).alias("_code"))
            for d, p in zip((2, 1, 0), names)}
    first, middle, last = (side[p] for p in names)
    triples = last.join(middle, ["_at", "_code"]).join(first, ["_at", "_code"])
    out_cols = [f"{p}_{c}" for p in names for c in cols]
    many = triples.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"_n_{names[2]}"))))
    many = many.repartition("_at", "_code", "_i")
    for j, p in (("_j", names[1]), ("_h", names[0])):
        many = many.withColumn(j, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"_n_{p}"))))
    return many.orderBy(f"{names[2]}_{order_col}", *out_cols, "_i", "_j", "_h").select(*out_cols)
