"""Purchase recency on customers with 1, 2 and several purchases."""

import datetime as dt

from ledgerlens.operators.recency import purchase_recency, recency_days


def test_recency_short_histories_and_same_day(spark):
    t = dt.datetime
    rows = [
        (1, 10, t(2020, 1, 5)),                          # one purchase
        (2, 20, t(2020, 1, 5)), (2, 21, t(2020, 3, 1)),  # two purchases, two months
        (3, 30, t(2020, 1, 1)), (3, 31, t(2020, 1, 10)), (3, 32, t(2020, 1, 10)),  # same day
        (3, 33, t(2020, 2, 2)),
        (4, 40, t(2020, 1, 1)), (4, 41, t(2020, 2, 1)), (4, 42, t(2020, 3, 1)), (4, 43, t(2020, 4, 1)),
    ]
    df = spark.createDataFrame(rows, "customerid long, salesorderid long, orderdate timestamp_ntz")
    out = {(r.mes, r.customerid): (r.last_date.isoformat(), r.diasuc_pc, r.diaspc_apc)
           for r in recency_days(purchase_recency(df, "customerid", "orderdate", "salesorderid")).collect()}
    assert out[("2020-01", 1)] == ("2020-01-05", None, None)
    assert out[("2020-01", 2)] == ("2020-01-05", None, None)
    assert out[("2020-03", 2)] == ("2020-03-01", 56, None)
    assert out[("2020-01", 3)] == ("2020-01-10", 0, 9)     # 31 and 32 on one day
    assert out[("2020-02", 3)] == ("2020-02-02", 23, 0)
    assert out[("2020-04", 4)] == ("2020-04-01", 31, 29)   # history spans three months
    assert len(out) == 9


def brute_recency(rows):
    """Per (month, customer): last purchase of the month and the two before it
    in the customer's whole history, ordered by (date, key)."""
    out = {}
    by_cust = {}
    for c, k, d in rows:
        by_cust.setdefault(c, []).append((d, k))
    for c, hist in by_cust.items():
        hist.sort()
        for i, (d, k) in enumerate(hist):
            m = d.strftime("%Y-%m")
            nxt = hist[i + 1][0].strftime("%Y-%m") if i + 1 < len(hist) else None
            if nxt != m:  # last purchase of its month
                p1 = hist[i - 1][0] if i >= 1 else None
                p2 = hist[i - 2][0] if i >= 2 else None
                out[(m, c)] = (d.date(), (d - p1).days if p1 else None,
                               (p1 - p2).days if p2 else None)
    return out


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 120)), min_size=1, max_size=60))
def test_recency_matches_brute_force(spark, picks):
    base = dt.datetime(2020, 1, 1)
    rows = [(c, i, base + dt.timedelta(days=day)) for i, (c, day) in enumerate(picks)]
    df = spark.createDataFrame(rows, "customerid long, salesorderid long, orderdate timestamp_ntz")
    got = {(r.mes, r.customerid): (r.last_date, r.diasuc_pc, r.diaspc_apc)
           for r in recency_days(purchase_recency(df, "customerid", "orderdate", "salesorderid")).collect()}
    assert got == brute_recency(rows)
