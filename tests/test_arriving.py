"""Types widen over arriving files; earlier files are not read again."""

import pytest

from ledgerlens.plans.loading import stage_db
from ledgerlens.sources import arriving as A


@pytest.fixture
def table(spark):
    return f"{stage_db(spark)}.arrived"


def rows(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=repr)


def test_lattice():
    kinds = [None, "bigint", "double", "boolean", "string"]
    for a in kinds:
        assert A.joined_type(a, a) == a and A.joined_type(None, a) == a and A.joined_type(a, "string") == "string"
        for b in kinds:
            assert A.joined_type(a, b) == A.joined_type(b, a)
            for c in kinds:
                assert A.joined_type(a, A.joined_type(b, c)) == A.joined_type(A.joined_type(a, b), c)
    assert A.joined_type("bigint", "double") == "double" and A.joined_type("boolean", "bigint") == "string"


def test_columns_widen_without_reading_old_files(spark, tmp_path, table):
    (tmp_path / "a.csv").write_text("Id,V,Empty,OrderDate\n1,10,,2024-01-01\n2,20,,\n")
    got = A.load_arriving(spark, str(tmp_path), table)
    assert (got["files"], got["rows"]) == (1, 2) and got["types"]["v"] == "bigint"
    (tmp_path / "b.csv").write_text("Id,V,Empty,OrderDate\n3,1.5,7,2024-02-01\n")
    # what is known of a.csv is its summary and its segment
    (tmp_path / "a.csv").write_text("Id,V,Empty,OrderDate\nbroken\n")
    got = A.load_arriving(spark, str(tmp_path), table)
    assert (got["files"], got["rows"]) == (1, 1)
    assert got["types"] == {"id": "bigint", "v": "double", "empty": "bigint", "orderdate": "timestamp_ntz"}
    assert [(r[0], r[1], r[2]) for r in rows(spark, table)] == [(1, 10.0, None), (2, 20.0, None), (3, 1.5, 7)]
    (tmp_path / "c.csv").write_text("Id,V,Empty,OrderDate\n4,true,x,\n")
    (tmp_path / "d.csv").write_text("Id,V,Empty,OrderDate\n5,30,,\n")
    got = A.load_arriving(spark, str(tmp_path), table)
    assert got["types"]["v"] == "string" and got["types"]["empty"] == "string"
    assert [(r[0], r[1], r[2]) for r in rows(spark, table)] == [
        (1, "10", None), (2, "20", None), (3, "1.5", "7"), (4, "true", "x"), (5, "30", None)]
    assert len(A.segments(spark, table)) == 3  # d has the types of a
    assert A.load_arriving(spark, str(tmp_path), table)["files"] == 0


def test_crash_before_the_summary_is_repeated(spark, tmp_path, table, monkeypatch):
    (tmp_path / "a.csv").write_text("k,v\n1,1\n2,2\n")
    with monkeypatch.context() as m:
        m.setattr(A, "show_segments", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            A.load_arriving(spark, str(tmp_path), table)
    (tmp_path / "b.csv").write_text("k,v\n3,0.5\n")
    got = A.load_arriving(spark, str(tmp_path), table)
    assert got["files"] == 2 and rows(spark, table) == [(1, 1.0), (2, 2.0), (3, 0.5)]


def test_other_headers_and_no_files(spark, tmp_path, table):
    with pytest.raises(Exception):
        A.load_arriving(spark, str(tmp_path / "none"), table)
    (tmp_path / "a.csv").write_text("k,v\n1,1\n")
    A.load_arriving(spark, str(tmp_path), table)
    (tmp_path / "b.csv").write_text("k,w\n1,1\n")
    with pytest.raises(Exception):
        A.load_arriving(spark, str(tmp_path), table)
    assert rows(spark, table) == [(1, 1)]
