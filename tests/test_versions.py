"""Crash-safe replacement: readers see the old rows or the new ones, whole."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.loading import stage_db
from ledgerlens.sources import versions as V
from ledgerlens.sources.catalog import append_table, drop_table
from ledgerlens.sources.csv_loader import is_misfit, load_table


@pytest.fixture
def name(spark):
    return f"{stage_db(spark)}.things"


def ids(spark, name):
    return sorted(r.id for r in spark.table(name).collect())


def broken(spark, at, n=1000):
    return spark.range(n).repartition(4).select(F.when(F.col("id") == at, F.raise_error(F.lit("lost midway")).cast("long")).otherwise(F.col("id")).alias("id"))


def test_failed_replace_leaves_the_table(spark, name):
    assert V.replace_table(spark.range(10), name) == 10
    before = V.versions(spark, name)
    with pytest.raises(Exception, match="lost midway"):
        V.replace_table(broken(spark, 777), name)
    assert ids(spark, name) == list(range(10)) and V.versions(spark, name) == before
    assert V.replace_table(spark.range(5).withColumn("more", F.lit("x")), name) == 5
    assert spark.table(name).columns == ["id", "more"] and ids(spark, name) == list(range(5))


def test_failed_first_load_makes_no_table(spark, name):
    with pytest.raises(Exception, match="lost midway"):
        V.replace_table(broken(spark, 3), name)
    assert not spark.catalog.tableExists(name) and V.versions(spark, name) == []


def test_driver_lost_between_write_and_swap(spark, name, monkeypatch):
    V.replace_table(spark.range(4), name)
    with monkeypatch.context() as m:
        m.setattr(V, "show_version", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            V.replace_table(spark.range(9), name)
    assert ids(spark, name) == list(range(4))  # the orphan is not shown
    assert len(V.versions(spark, name)) == 2
    V.replace_table(spark.range(6), name)
    V.replace_table(spark.range(7), name)
    assert ids(spark, name) == list(range(7)) and len(V.versions(spark, name)) == 2  # shown and one before


def test_running_readers_keep_their_version(spark, name):
    V.replace_table(spark.range(8), name)
    reader = spark.table(name)
    V.replace_table(spark.range(3), name)
    assert reader.count() == 8 and spark.table(name).count() == 3


def test_replacing_from_itself_and_layouts(spark, name):
    V.replace_table(spark.range(6).withColumn("part", F.col("id") % 2), name, lambda w: w.partitionBy("part"))
    V.replace_table(spark.table(name).where("id > 1"), name, lambda w: w.bucketBy(2, "id"))
    assert ids(spark, name) == [2, 3, 4, 5]


def test_plain_tables_become_versions(spark, name):
    spark.range(3).write.saveAsTable(name)
    V.replace_table(spark.range(5), name)
    assert ids(spark, name) == list(range(5)) and len(V.versions(spark, name)) == 2
    V.replace_table(spark.range(6), name)
    assert len(V.versions(spark, name)) == 2


def test_name_lost_in_the_first_swap_comes_back(spark, name):
    spark.range(3).write.saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {V.new_version(spark, name, stamp=0)}")
    assert not spark.catalog.tableExists(name)
    assert V.recover_name(spark, name) and ids(spark, name) == [0, 1, 2]
    assert V.recover_name(spark, name) is None


def test_append_and_drop_reach_the_version(spark, name):
    V.replace_table(spark.range(2), name)
    append_table(spark.range(2, 4), name)
    assert ids(spark, name) == [0, 1, 2, 3]
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and V.versions(spark, name) == []
    drop_table(spark, name)


def test_names_alike_are_not_mixed_up(spark, name):
    V.replace_table(spark.range(2), name)
    V.replace_table(spark.range(3), name + "__v")
    V.replace_table(spark.range(3), name + "__v")
    V.replace_table(spark.range(1), name)
    assert ids(spark, name) == [0] and ids(spark, name + "__v") == [0, 1, 2]


def test_only_misfits_try_the_next_separator(spark, name, tmp_path, monkeypatch):
    from ledgerlens.sources import csv_loader
    path = tmp_path / "both.csv"
    path.write_text("a;b,c\n1;2,3\n4;5,6\n")
    tried = []
    real = csv_loader.load_with_separator

    def lost(spark, path, table, sep, **opts):
        tried.append(sep)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(csv_loader, "load_with_separator", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        load_table(spark, str(path), name)
    assert tried == [","]
    monkeypatch.setattr(csv_loader, "load_with_separator", real)
    wrong = tmp_path / "wrong.csv"
    wrong.write_text("a,x;b\n1;2\n3;4\n")
    got = load_table(spark, str(wrong), name)
    assert got["separator"] == ";" and got["rows"] == 2
    assert not is_misfit(RuntimeError("executor lost"))
