"""Hot keys in parts: equal to the plain join, and no task far above the others."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.operators.hotkeys import hot_keys, parted_keys, spread_join
from tests.conftest import SF_CHECK

OFF = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def plain(spark):
    """Without AQE, so that tasks are those the plan deals out."""
    old = {k: spark.conf.get(k) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def skewed(spark):
    """Orders of which one customer has a third, another a tenth, in one partition as from one file."""
    return (T.sales_header(spark, SF_CHECK)
            .withColumn("customerid", F.when(F.col("salesorderid") % 3 == 0, F.lit(1).cast("long"))
                        .when(F.col("salesorderid") % 10 == 1, F.lit(2).cast("long")).otherwise(F.col("customerid")))
            .coalesce(1))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_largest_task_within_twice_the_median(plain):
    orders, customers = skewed(plain), T.customer(plain, SF_CHECK)
    def sizes(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    before = sizes(orders.join(customers, "customerid"))
    after = sizes(spread_join(orders, customers, ["customerid"]))
    assert max(before) > 4 * median(before)
    assert max(after) <= 2 * median(after) and sum(after) == sum(before)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equal_to_the_plain_join(spark, how):
    orders = skewed(spark)
    customers = T.customer(spark, SF_CHECK).where("customerid % 7 <> 2")  # customer 2, hot, has no row
    got, want = spread_join(orders, customers, ["customerid"], how), orders.join(customers, ["customerid"], how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_two_keys_many_to_many_nulls_and_clashing_columns(spark):
    left = spark.range(600).select(F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id")).cast("int").alias("a"),
                                   (F.col("id") % 2).cast("string").alias("b"), "id", F.lit(3).alias("parts"), F.lit("x").alias("cell"))
    right = spark.range(40).select((F.col("id") % 4).cast("int").alias("a"), F.lit("0").alias("b"), F.col("id").alias("other"), F.lit(4).alias("rows"))
    for how in ("inner", "left"):
        assert rows(spread_join(left, right, ["a", "b"], how)) == rows(left.join(right, ["a", "b"], how))


def test_sketch_finds_every_hot_key_and_no_other(spark):
    data = spark.range(5_000).select(F.when(F.col("id") < 700, F.lit(-1)).when(F.col("id") < 1000, F.lit(-2)).when(F.col("id") < 1200, F.lit(None)).otherwise(F.col("id")).alias("k"))
    assert {(r.k, r.rows) for r in hot_keys(data, ["k"], 300).collect()} == {(-1, 700), (-2, 300)}
    assert parted_keys(data.limit(0), ["k"], 8) == ([], 1)


def test_null_keys_are_spread_where_they_are_kept(plain):
    orders = T.sales_header(plain, SF_CHECK).withColumn("customerid", F.when(F.col("salesorderid") % 3 > 0, F.col("customerid"))).coalesce(1)
    customers = T.customer(plain, SF_CHECK)
    for how in ("left", "left_anti", "inner"):
        got, want = spread_join(orders, customers, ["customerid"], how), orders.join(customers, ["customerid"], how)
        assert rows(got) == rows(want)
    def sizes(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    after = sizes(spread_join(orders, customers, ["customerid"], "left"))
    assert max(sizes(orders.join(customers, ["customerid"], "left"))) > 4 * median(after) and max(after) <= 2 * median(after)


def test_no_hot_key_and_refused_types(spark):
    left, right = spark.range(50), spark.range(20).withColumn("v", F.lit(1))
    assert rows(spread_join(left, right, ["id"], partitions=2)) == rows(left.join(right, "id"))
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            spread_join(left, right, ["id"], how)
