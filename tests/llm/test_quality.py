import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import quality as Q


def test_minimiser_finds_the_least_risk():
    rng = np.random.default_rng(3)
    pos = np.c_[np.ones(400), rng.normal(1, 1, 400)]
    neg = np.c_[np.ones(400), rng.normal(-1, 1, 400)]
    unl = np.concatenate((pos[:240], neg[:160]))
    args = (unl.mean(0), unl.T @ unl / len(unl), pos.mean(0), pos.T @ pos / len(pos))

    def risk(w, prior=0.6):
        loss = lambda z: ((1 - z) ** 2).mean() / 4
        return prior * loss(pos @ w) + max(0.0, loss(-(unl @ w)) - prior * loss(-(pos @ w)))

    w = Q.minimise_risk(0.6, 1e-6, *args)
    assert all(risk(w) <= risk(w + d) + 1e-4 for d in rng.normal(0, 0.1, (50, 2)))
    assert (pos @ w > 0).mean() > 0.75 and (neg @ w < 0).mean() > 0.75


def test_prior_is_bounded_by_the_ratio():
    unlabelled, positive = np.zeros(200), np.zeros(200)
    positive[150:] = 100
    unlabelled[150:] = 70
    unlabelled[:50] = 30
    assert abs(Q.estimate_prior(unlabelled, positive) - 0.7) < 0.1


@pytest.fixture(scope="module")
def tables(llm):
    d = "/root/testdata/sf0.01"
    return llm.read.parquet(f"{d}/documents.parquet"), llm.read.parquet(f"{d}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = Q.quality_scores(docs, labels).join(labels, "doc_id").where("held_out")
    rate = {r.quality: r.a for r in got.groupBy("quality").agg(F.avg("predicted").alias("a")).collect()}
    assert rate[1] > 0.95 and rate[0] < 0.3


def test_odd_rows(tables, odd_docs, no_docs):
    _, labels = tables
    got = Q.quality_scores(odd_docs, labels)
    assert got.count() == odd_docs.count() and got.where("score is null").count() == 0
    assert Q.quality_scores(no_docs, labels).count() == 0
    assert {r.score for r in Q.quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert Q.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_features_do_not_depend_on_the_rows_beside():
    def of(*texts):
        raw = [t.encode() for t in texts]
        return Q.features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))

    symbols, words = "### $$$ !!! |||", "Some words stand here, and more of them."
    alone, beside = of(symbols), of(words, symbols, "")
    assert alone.shape == (1, len(Q.FEATURES)) and (alone[0] == beside[1]).all() and alone.any()
    assert (of("", "")[0] == 0).all() and (beside[2] == 0).all()
    assert (of(words)[0] == beside[0]).all()
