"""Small hand-made inputs for the report operators (NULL names, ties,
short months, equal averages, status codes)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.averages import group_and_overall_avg, indicator
from ledgerlens.operators.status import status_breakdown, status_pivot
from ledgerlens.operators.topk import positional_pivot, top_k_per_group


def test_positional_pivot_example(spark):
    # id d9 has its second category only
    rows = [("b7", "brand", "Acme"), ("b7", "colour", "red"), ("c2", "brand", "Orbit"),
            ("c2", "colour", "blue"), ("d9", "colour", "green")]
    df = spark.createDataFrame(rows, "id string, key string, value string")
    out = positional_pivot(df, ["id"], [F.col("key")], "value", ["one", "two"])
    assert sorted(tuple(r) for r in out.collect()) == [("b7", "Acme", "red"), ("c2", "Orbit", "blue"), ("d9", "green", None)]


def test_month_with_fewer_than_three_names_and_tie_at_three(spark):
    rows = [("2020-01", "b", 5.0), ("2020-01", "a", 5.0), ("2020-01", "c", 9.0), ("2020-01", "d", 1.0),
            ("2020-02", "x", 2.0)]
    df = spark.createDataFrame(rows, "mes string, name string, qty double")
    order = [F.col("qty").desc(), F.col("name").asc_nulls_last()]
    out = {r.mes: tuple(r)[1:] for r in
           positional_pivot(df, ["mes"], order, "name", ["n1", "n2", "n3"]).collect()}
    assert out["2020-01"] == ("c", "a", "b")       # tie at 5.0 decided by name
    assert out["2020-02"] == ("x", None, None)     # short month -> NULL columns


def test_null_name_group_can_win(spark):
    rows = [("m", None, 10.0), ("m", None, 10.0), ("m", "z", 15.0), ("m", "y", 1.0)]
    df = spark.createDataFrame(rows, "mes string, cliente string, amt double")
    agg = df.groupBy("mes", "cliente").agg(F.sum("amt").alias("total"))
    order = [F.col("total").desc_nulls_first(), F.col("cliente").asc_nulls_last()]
    r = positional_pivot(agg, ["mes"], order, "cliente", ["c1", "c2", "c3"]).collect()[0]
    assert (r.c1, r.c2, r.c3) == (None, "z", "y")  # NULL names merged: 20 > 15


def test_top_k_keeps_k_per_group(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, ["g"], [F.col("v").desc()], 3)
    counts = {r.g: r["count"] for r in out.groupBy("g").count().collect()}
    assert set(counts.values()) == {3}


def test_indicator_equal_and_null(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-2.0,), (None,)], "d double")
    got = [r.i for r in df.select(indicator(F.col("d")).alias("i")).collect()]
    assert got == ["Above", "Equal", "Below", "Below"]


def test_group_and_overall_avg_equal_label(spark):
    rows = [("m", "A", 10.0), ("m", "A", 20.0), ("m", "B", 15.0), ("m", None, 100.0)]
    df = spark.createDataFrame(rows, "mes string, g string, x double")
    got = {r.g: (r.group_avg, r.overall_avg) for r in group_and_overall_avg(df, "mes", "g", "x").collect()}
    assert got["A"] == (15.0, 36.25)
    assert got[None] == (100.0, 36.25)
    # Without the NULL group both groups equal the organisation.
    got2 = {r.g: (r.group_avg, r.overall_avg)
            for r in group_and_overall_avg(df.where(F.col("g").isNotNull()), "mes", "g", "x").collect()}
    assert got2["A"] == got2["B"] == (15.0, 15.0)


def test_status_breakdown_absent_code_is_zero(spark):
    rows = [("m", 1, 10.5), ("m", 5, 1.25), ("m", 5, 2.0), ("n", 2, 3.0)]
    df = spark.createDataFrame(rows, "mes string, status int, totaldue double")
    out = {r.mes: r for r in status_breakdown(df, ["mes"]).collect()}
    m = out["m"]
    assert (m.trproceso, m.trenviadas, m.trcanceladas) == (1, 2, 0)
    assert (m.mntproceso, m.mntenviadas, m.mntcanceladas) == (10.5, 3.25, 0.0)
    piv = {r.mes: r for r in status_pivot(df, ["mes"]).collect()}
    assert (piv["m"].trenviadas, piv["n"].traprobadas, piv["n"].trenviadas) == (2, 1, 0)


def test_filter_and_sort_rows_of_an_explicit_schema(spark):
    schema = T.StructType([
        T.StructField("station", T.StringType(), False),
        T.StructField("day", T.DateType(), False),
        T.StructField("rain", T.IntegerType(), False),
    ])
    d = dt.date
    data = [("north", d(2020, 6, 1), 4), ("north", d(2020, 6, 2), 9), ("south", d(2020, 6, 1), 7),
            ("south", d(2020, 6, 2), 2), ("west", d(2020, 6, 2), 5)]
    df = spark.createDataFrame(data, schema)
    out = df.where((F.col("station") != "north") & (F.col("day") > "2020-06-01")).orderBy(F.col("rain").desc()).collect()
    assert [tuple(r) for r in out] == [("west", d(2020, 6, 2), 5), ("south", d(2020, 6, 2), 2)]
