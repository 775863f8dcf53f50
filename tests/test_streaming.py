"""Incremental load: files present at start, then a new file; each row is
taken in exactly once across runs."""

import pytest

from ledgerlens.sources.runlog import RunLog


def write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_incremental_load_appends_new_files_once(spark, tmp_path):
    from ledgerlens.streaming import run_incremental_load

    src = tmp_path / "in"
    src.mkdir()
    write(src / "part1.csv", "Order ID;Customer Name;Order Date;Total\n1;ann;2020-01-01;1.5\n2;bob;2020-01-02;NULL\n")
    ckpt = str(tmp_path / "ckpt")
    table = "streamed_orders"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    assert run_incremental_load(spark, str(src), table, ckpt) == 2
    write(src / "part2.csv", "Order ID;Customer Name;Order Date;Total\n3;cy;bad date;4\n")
    with pytest.raises(Exception):
        run_incremental_load(spark, str(src), table, ckpt)      # strict: a bad value fails
    log = RunLog(spark)
    assert run_incremental_load(spark, str(src), table, ckpt, log=log, tolerant=True) == 1
    assert "misses={'orderdate': 1}" in log.entries[-1][-1]
    assert run_incremental_load(spark, str(src), table, ckpt) == 0
    df = spark.table(table)
    assert df.columns == ["orderid", "customername_t", "orderdate", "total"]
    rows = sorted(tuple(r) for r in df.collect())
    assert [r[0] for r in rows] == [1, 2, 3]
    assert rows[1][3] is None and rows[2][2] is None   # NULL token, tolerant bad date


def test_incremental_load_counts_rows_over_many_batches(spark, tmp_path):
    from ledgerlens.streaming import run_incremental_load

    src = tmp_path / "in"
    src.mkdir()
    for i in range(6):
        write(src / f"part{i}.csv", f"Key;Value\n{i};{i * 1.5}\n{i + 100};1\n")
    table = "streamed_many"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = run_incremental_load(spark, str(src), table, str(tmp_path / "ck"), max_files_per_trigger=1)
    assert rows == 12 == spark.table(table).count()


def test_values_and_headers_that_do_not_fit_fail(spark, tmp_path):
    from ledgerlens.streaming import run_incremental_load

    src, table, ckpt = tmp_path / "in", "streamed_strict", str(tmp_path / "ck")
    src.mkdir()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    write(src / "a.csv", 'Id;Qty;Label\n1;10;"say ""hi"" bob"\n2;20;"C:\\dir\\"\n')
    assert run_incremental_load(spark, str(src), table, ckpt) == 2
    assert [r.label for r in spark.table(table).orderBy("id").collect()] == ['say "hi" bob', "C:\\dir\\"]
    write(src / "b.csv", "Id;Qty;Label\n3;3.5;x\n4;12 units;y\n")
    with pytest.raises(Exception):
        run_incremental_load(spark, str(src), table, ckpt)
    log = RunLog(spark)
    assert run_incremental_load(spark, str(src), table, ckpt, log=log, tolerant=True) == 2
    assert "misses={'qty': 2}" in log.entries[-1][-1]
    write(src / "c.csv", "Qty;Id;Label\n77;2;y\n")
    with pytest.raises(Exception):
        run_incremental_load(spark, str(src), table, ckpt, tolerant=True)
    assert spark.table(table).count() == 4


def test_rows_of_another_run_are_not_counted(spark, tmp_path, monkeypatch):
    from ledgerlens.streaming import incremental_load as I

    src = tmp_path / "in"
    src.mkdir()
    write(src / "a.csv", "Key;Value\n1;1\n2;2\n3;3\n")
    table = "streamed_beside"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    real = I.start_incremental_load
    other = tmp_path / "other"
    other.mkdir()
    write(other / "b.csv", "Key;Value\n7;1\n8;2\n")

    def beside(spark, source_dir, name, checkpoint, **opts):
        query = real(spark, source_dir, name, checkpoint, **opts)
        query.awaitTermination()
        real(spark, str(other), name, str(tmp_path / "ck2"), available_now=True).awaitTermination()
        return query

    monkeypatch.setattr(I, "start_incremental_load", beside)
    assert I.run_incremental_load(spark, str(src), table, str(tmp_path / "ck1")) == 3
