"""Literal rows through SQL, column parsing, lookups, CSV sink order, bucketed
publication, checked broadcasts, exact amounts."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.functions.dates import month_num, month_text, parse_timestamps
from ledgerlens.functions.money import money_units, sum_units, units_to_double
from ledgerlens.operators.joins import broadcast_if_small, is_small
from ledgerlens.operators.lookup import lookup
from ledgerlens.sources.catalog import publish_table
from ledgerlens.sources.files import read_csv, write_csv


def test_literal_rows_table_and_positional_pivot_in_sql(spark):
    spark.sql("DROP TABLE IF EXISTS example")
    spark.sql("CREATE TABLE example (id STRING, key STRING, value STRING) USING parquet")
    spark.sql("""INSERT INTO example VALUES
        ('b7', 'brand', 'Acme'), ('b7', 'colour', 'red'), ('c2', 'brand', 'Orbit'),
        ('c2', 'colour', 'blue'), ('d9', 'colour', 'green')""")
    out = spark.sql("""
        SELECT id, max(CASE WHEN pos = 1 THEN value END) AS one, max(CASE WHEN pos = 2 THEN value END) AS two
        FROM (SELECT id, value, row_number() OVER (PARTITION BY id ORDER BY key) AS pos FROM example)
        WHERE pos <= 2 GROUP BY id ORDER BY id""").collect()
    # a key without its first category fills the first column with its second
    assert [tuple(r) for r in out] == [("b7", "Acme", "red"), ("c2", "Orbit", "blue"), ("d9", "green", None)]


def test_parse_timestamps_and_month(spark):
    df = spark.createDataFrame([("2011-05-31 10:00:00", "x")], "d string, bad string")
    out = parse_timestamps(df, ["d"]).select(month_text(month_num("d")).alias("m")).collect()
    assert out[0].m == "2011-05"
    tolerant = parse_timestamps(df, ["bad"], tolerant=True).collect()
    assert tolerant[0].bad is None
    with pytest.raises(Exception):
        parse_timestamps(df, ["bad"]).collect()


def test_amounts_are_exact_or_fail(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,), (-7.1234,)], "x double")
    assert df.select(units_to_double(sum_units(money_units("x"))).alias("s")).first().s == -6.1234
    assert spark.createDataFrame([(9e14,)] * 3, "x double").select(
        units_to_double(sum_units(money_units("x")))).first()[0] == 2.7e15   # over a bigint in units
    with pytest.raises(Exception, match="four decimals"):
        spark.createDataFrame([(0.00004,)] * 3, "x double").select(sum_units(money_units("x"))).collect()


def test_broadcast_check_is_not_remembered(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(10).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    assert is_small(read(), 100, 10_000)
    spark.range(1000).write.mode("append").parquet(path)
    assert not is_small(read(), 100, 1_000_000) and not is_small(read(), 10_000, 1000)
    plan = broadcast_if_small(read(), 100)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan


def test_a_table_is_read_as_its_files_are_now(spark, tmp_path):
    spark.range(100).selectExpr("id AS event_id", "'a' AS event_type").write.parquet(f"{tmp_path}/events.parquet")
    assert T.sequence(spark, str(tmp_path)).count() == 100
    spark.range(100, 200).selectExpr("id AS event_id", "'a' AS event_type").write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert T.sequence(spark, str(tmp_path)).count() == 200


def test_lookup_forms(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert lookup(df, "k", 7).count() == 1
    assert lookup(df, "k", [1, 2, 300]).count() == 2
    keys = spark.range(95, 105).withColumnRenamed("id", "k")
    assert sorted(r.k for r in lookup(df, "k", keys).collect()) == [95, 96, 97, 98, 99]


def test_publish_table_prunes_buckets(spark):
    df = spark.range(1000).withColumnRenamed("id", "c_custkey").withColumn("v", F.col("c_custkey") * 2)
    publish_table(df, "published_keyed", "c_custkey", buckets=8)
    t = spark.table("published_keyed")
    plan = lookup(t, "c_custkey", 42)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_custkey,42)" in plan          # pushed to the sorted bucket files
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")                     # bucketed scan kept: one bucket read
    try:
        plan = lookup(t, "c_custkey", 42)._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 8" in plan
    finally:
        spark.conf.unset(key)
    assert lookup(t, "c_custkey", 42).collect()[0].v == 84


def test_csv_sink_sorted_and_typed_read(spark, tmp_path):
    df = spark.createDataFrame([("2011-06", "B", 2), ("2011-05", "Z", 1), ("2011-05", "A", 3)],
                               "Mes string, Name string, n bigint")
    path = str(tmp_path / "out")
    write_csv(df, path, sort_by=["Mes", "Name"])
    lines = []
    for f in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        lines += open(f, encoding="utf-8").read().splitlines()[1:]
    assert lines == ["2011-05,A,3", "2011-05,Z,1", "2011-06,B,2"]
    back = read_csv(spark, path, "Mes string, Name string, n bigint")
    assert dict(back.dtypes)["Mes"] == "string"
    assert back.count() == 3


def test_append_and_drop_tables(spark):
    from ledgerlens.sources.catalog import append_table, drop_table
    df = spark.range(5).select(F.col("id").alias("k"), (F.col("id") % 2).alias("part"))
    append_table(df, "catalog_demo")
    append_table(df.select("part", "k"), "catalog_demo")   # matched by name
    t = spark.table("catalog_demo")
    assert t.count() == 10 and t.where("part = 1").count() == 4 and t.agg(F.max("k")).first()[0] == 4
    drop_table(spark, "catalog_demo")
    assert not spark.catalog.tableExists("catalog_demo")


def test_publication_writes_a_file_for_each_bucket(spark):
    df = spark.range(0, 1000, 1, 16).withColumnRenamed("id", "k")
    publish_table(df, "published_files", "k", buckets=8)
    assert len(spark.table("published_files").inputFiles()) == 8


def test_quoted_values_make_the_round_trip(spark, tmp_path):
    values = ['say "hi"', 'a,b;c', "C:\\dir\\", '"', 'line\nbreak']
    path = str(tmp_path / "quoted")
    write_csv(spark.createDataFrame(list(enumerate(values)), "i int, v string"), path)
    back = read_csv(spark, path, "i int, v string", multi_line=True).orderBy("i").collect()
    assert [r.v for r in back] == values
    with pytest.raises(Exception):
        read_csv(spark, path, "v string, i int", multi_line=True).collect()


def test_bucketed_tables_join_without_shuffle(spark):
    from tests.conftest import SF_SMALL
    publish_table(T.sales_header(spark, SF_SMALL), "orders_by_customer", "customerid", buckets=8)
    publish_table(T.customer(spark, SF_SMALL), "customers_by_key", "customerid", buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("orders_by_customer").join(spark.table("customers_by_key"), "customerid")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == T.sales_header(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
