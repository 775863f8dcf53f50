"""Run counts against brute force on small inputs (gaps, duplicate keys, a hot
key, several ranges)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators.runs import ordered_run_counts, run_counts_by_key, spaced_runs


def brute_by_key(rows, length=3, step=1):
    """Self-join semantics: per s.code over all (s, d, f...) chains."""
    by_key = {}
    for k, c in rows:
        by_key.setdefault(k, []).append(c)
    out = Counter()
    present = set()
    for k, c in rows:
        chains = 1
        ok = True
        for r in range(1, length):
            prev = by_key.get(k - r * step, [])
            if not prev:
                ok = False
                break
        if not ok:
            continue
        present.add(c)
        n = 1
        for r in range(1, length):
            n *= sum(1 for x in by_key[k - r * step] if x == c)
        out[c] += n
    return {c: out[c] for c in present}


def brute_ordered(rows, length=3):
    seq = [c for _, c in sorted(rows, key=lambda t: (t[0], t[1]))]
    out = Counter()
    for i in range(length - 1, len(seq)):
        if all(seq[i - j] == seq[i] for j in range(length)):
            out[seq[i]] += 1
    return dict(out)


def as_df(spark, rows):
    return spark.createDataFrame(rows, "secuencial long, codigo string")


def test_by_key_gaps_and_duplicates(spark):
    rows = [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (6, "a"), (7, "a"), (8, "a"),
            (8, "b"), (9, "b"), (10, "b"), (10, "b"), (11, "c"), (20, "d")]
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in run_counts_by_key(as_df(spark, rows), "secuencial", "codigo").collect()}
    assert got == brute_by_key(rows)


def test_by_key_hot_key(spark):
    # One key holds a third of the rows: counts multiply, rows do not.
    rows = [(i, "x") for i in range(60)] + [(30, "x")] * 30 + [(31, "y")] * 5
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in run_counts_by_key(as_df(spark, rows), "secuencial", "codigo").collect()}
    assert got == brute_by_key(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 25), st.sampled_from("abc")), min_size=0, max_size=60))
def test_by_key_random(spark, rows):
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in run_counts_by_key(as_df(spark, rows), "secuencial", "codigo").collect()}
    assert got == brute_by_key(rows)


def test_ordered_runs_ignore_gaps(spark):
    # Sorted by (key, code): a a a b b a b b b b
    rows = [(1, "a"), (5, "a"), (9, "a"), (10, "b"), (30, "b"), (31, "a"), (31, "b"), (40, "b"),
            (50, "b"), (60, "b")]
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in ordered_run_counts(as_df(spark, rows), "secuencial", "codigo").collect()}
    assert got == brute_ordered(rows) == {"a": 1, "b": 2}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-20, 40), st.sampled_from("ab")), min_size=0, max_size=80), st.sampled_from([1, 7, 40]))
def test_ordered_runs_random_many_ranges(spark, rows, ranges):
    df = as_df(spark, rows)
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in ordered_run_counts(df, "secuencial", "codigo", ranges=ranges).collect()}
    assert got == brute_ordered(rows)


def test_ordered_runs_with_null_keys_and_hot_key(spark):
    rows = [(None, "x")] * 2 + [(3, "x")] * 50 + [(i, "x") for i in range(4, 9)] + [(8, "y"), (9, "x")]
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in ordered_run_counts(as_df(spark, rows), "secuencial", "codigo", ranges=6).collect()}
    seq = [c for _, c in sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))]
    assert got == {"x": sum(seq[i - 2:i + 1] == ["x"] * 3 for i in range(2, len(seq)))}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-20, 40), st.sampled_from("abc")), min_size=0, max_size=80), st.sampled_from([3, 8]))
def test_by_key_random_narrow_ranges(spark, rows, width):
    got = {r.codigo: r.cantidad_veces_seguidos
           for r in run_counts_by_key(as_df(spark, rows), "secuencial", "codigo", width=width).collect()}
    assert got == brute_by_key(rows)


def test_plans_have_few_exchanges_and_no_single_partition(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")

    def plan(out):
        out.collect()
        return out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]

    by_key = plan(run_counts_by_key(df, "event_id", "event_type"))
    assert by_key.count("Exchange ") <= 3 and "SinglePartition" not in by_key
    assert "SinglePartition" not in plan(ordered_run_counts(df, "event_id", "event_type"))


def test_spaced_runs_rows(spark):
    rows = [(1, "a"), (3, "a"), (5, "a"), (7, "a"), (2, "b"), (4, "c"), (6, "b")]
    out = spaced_runs(as_df(spark, rows), "secuencial", "codigo", step=2)
    assert out.columns == [f"{p}_{c}" for p in ("first", "middle", "last") for c in ("secuencial", "codigo")]
    assert [tuple(r) for r in out.collect()] == [(1, "a", 3, "a", 5, "a"), (3, "a", 5, "a", 7, "a")]


def test_spaced_runs_multiply_duplicates_over_several_tasks(spark):
    rows = [(2, "a")] * 30 + [(4, "a")] * 5 + [(6, "a")] * 40 + [(8, "b")]
    out = spaced_runs(as_df(spark, rows), "secuencial", "codigo", step=2)
    assert out.count() == 30 * 5 * 40
    key = "spark.sql.adaptive.coalescePartitions.enabled"   # so few rows would be put together again
    spark.conf.set(key, "false")
    try:
        parts = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set(key, "true")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 30 * 5 * 40
