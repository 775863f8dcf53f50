"""Good rows are loaded, bad ones set aside with their text, file and reasons."""

import os

import pytest

from ledgerlens.plans.loading import stage_db
from ledgerlens.sources.quarantine import load_split


@pytest.fixture
def table(spark):
    return f"{stage_db(spark)}.split"


def folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def read(spark, table):
    good = sorted(map(tuple, spark.table(table).collect()), key=repr)
    bad = sorted((r.raw, os.path.basename(r.file), r.reason) for r in spark.table(table + "__rejected").collect())
    return good, bad


def test_rows_in_are_good_or_rejected(spark, tmp_path, table):
    path = folder(tmp_path, a="Id;Name;OrderDate;Ok\n1;x;2024-01-02;true\n2;y;someday;false\n3;z\n4;w;2024-01-03;maybe\n",
                  b='Id;Name;OrderDate;Ok\n5;"q;r";2024-02-01;NA\nsix;s;;true\n7;t;2024-01-01;true;more\n')
    got = load_split(spark, path, table, types={"Id": "bigint", "Ok": "boolean"})
    assert (got["rows"], got["rejected"], got["separator"]) == (2, 5, ";")
    good, bad = read(spark, table)
    assert [(g[0], g[1], str(g[2])[:10], g[3]) for g in good] == [(1, "x", "2024-01-02", True), (5, "q;r", "2024-02-01", None)]
    assert spark.table(table).schema.simpleString() == "struct<id:bigint,name_t:string,orderdate:timestamp_ntz,ok:boolean>"
    assert bad == [("2;y;someday;false", "a.csv", "orderdate: not a date"),
                   ("3;z", "a.csv", "row does not fit the columns"),
                   ("4;w;2024-01-03;maybe", "a.csv", "ok: not a boolean"),
                   ("7;t;2024-01-01;true;more", "b.csv", "row does not fit the columns"),
                   ("six;s;;true", "b.csv", "id: not a bigint")]


def test_few_misfits_do_not_widen_a_column(spark, tmp_path, table):
    values = [str(i) for i in range(300)] + ["n.n.", "12a"]
    path = folder(tmp_path, a="k,v\n" + "".join(f"{i},{v}\n" for i, v in enumerate(values)))
    got = load_split(spark, path, table)
    assert (got["rows"], got["rejected"]) == (300, 2) and spark.table(table).schema["v"].dataType.simpleString() == "bigint"
    got = load_split(spark, path, table, misfit_share=0.0)
    assert (got["rows"], got["rejected"]) == (302, 0) and spark.table(table).schema["v"].dataType.simpleString() == "string"


def test_no_rejected_rows_no_rows_and_reload(spark, tmp_path, table):
    path = folder(tmp_path, a="k,v\n1,2\n")
    assert load_split(spark, path, table)["rejected"] == 0
    assert read(spark, table) == ([(1, 2)], [])
    (tmp_path / "a.csv").write_text("k,v\n")
    assert load_split(spark, path, table)["rows"] == 0 and read(spark, table) == ([], [])


def test_separator_with_fewest_misfits(spark, tmp_path, table):
    path = folder(tmp_path, a="a,x;b\n1;2\n3;4\n5,6;7\n")
    got = load_split(spark, path, table)
    assert got["separator"] == ";" and got["rows"] == 3


def test_failed_reload_keeps_both_tables(spark, tmp_path, table):
    load_split(spark, folder(tmp_path, a="k,v\n1,2\n3\n"), table)
    before = read(spark, table)
    (tmp_path / "b.csv").write_text("other,v\n1,2\n")  # another header fails the load
    with pytest.raises(Exception):
        load_split(spark, str(tmp_path), table)
    assert read(spark, table) == before
