import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import mixing as M


def targets(sizes):
    """Share by weight, stop at twice the size, share the excess anew."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, open_, budget = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if budget * weight[s] / total > 2 * sizes[s]]
        if not over:
            out.update({s: budget * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            open_.remove(s)
        budget = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


def test_targets_equal_the_stated_rule(llm):
    for sizes in ({"a": 10, "b": 1000, "c": 500, None: 40, "é": 7}, {"x": 5}, {"a": 0, "b": 3}, {c: i * i for i, c in enumerate("qwertzuiop")}):
        df = llm.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in M.source_targets(df).collect()}
        want = targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def reachable(sizes, counts, budget):
    sums = {0}
    for s, c in zip(sizes, counts):
        sums = {a + k * s for a in sums for k in range(c + 1) if a + k * s <= budget}
    return max(sums)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 4)), max_size=6, unique_by=lambda t: t[0]), st.integers(0, 200))
def test_knapsack_is_exact(items, budget):
    sizes, counts = (np.array([t[i] for t in items], np.int64) for i in (0, 1))
    take = M.fit_remainder(sizes, counts, budget)
    assert ((take >= 0) & (take <= counts)).all()
    assert (take * sizes).sum() == reachable(sizes.tolist(), counts.tolist(), budget)


def test_budget_beyond_the_table():
    sizes, counts = np.array([3, 1000, 70_000]), np.array([10, 5000, 50])
    take = M.fit_remainder(sizes, counts, 4_000_009)
    assert (take * sizes).sum() == 4_000_009 and (take <= counts).all()


def test_fit_of_a_source():
    rows = pd.DataFrame({"source": "s", "size": [0, 3, 10], "n": [2, 5, 5], "target": 100.0})
    got = M.fit_source(rows)
    assert (got["size"] * (got["n"] * got["whole"] + got["more"])).sum() == 100


def test_mix_and_its_documents(llm, docs, odd_docs, no_docs):
    for df in (docs, odd_docs.unionByName(odd_docs)):
        mix = M.mix_report(df)
        rows = mix.collect()
        assert len(rows) == df.count()
        assert sorted(map(str, rows)) == sorted(map(str, M.mix_report(df.repartition(5)).collect()))
        sizes = {}
        for r in rows:
            assert r.taken == r.copies * r["size"] <= 2 * r["size"]
            sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        want = targets(sizes)
        for source in sizes:
            taken = sum(r.taken for r in rows if r.source == source)
            assert {r.source_size for r in rows if r.source == source} == {sizes[source]}
            assert want[source] - max(r["size"] for r in rows if r.source == source) <= taken <= want[source] + 1e-6
        mixed = M.mixed_documents(df)
        words = mixed.agg(F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
        assert words == sum(r.taken for r in rows) and mixed.columns == df.columns
    assert M.mix_report(no_docs).count() == 0


def test_large_groups_are_ranked_in_parts(llm, monkeypatch):
    monkeypatch.setattr(M, "RANKED", 4)
    df = llm.createDataFrame([(i, "a b", "s") for i in range(60)] + [(i, "a b c", "t") for i in range(60)], "doc_id long, text string, source string")
    got = M.mix_report(df).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(r.t - 3 < r.n <= r.t for r in got)
