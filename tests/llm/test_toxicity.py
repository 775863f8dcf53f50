import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import toxicity as X


def brute_segments(scores):
    """Maximal segments by their definition: best segment, then left and right of it."""
    if not scores:
        return []
    best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    if best[0] <= 0:
        return []
    a, n = -best[2], -best[1]
    left = brute_segments(scores[:a])
    right = brute_segments(scores[a + n:])
    return left + [(a, a + n, best[0])] + [(x + a + n, y + a + n, s) for x, y, s in right]


def test_one_scan_finds_all_maximal_segments():
    rng = random.Random(2)
    for _ in range(200):
        runs = [rng.randint(1, 9) + rng.random() for _ in range(rng.randint(1, 7))]
        gaps = [0.0] + [-(rng.randint(1, 9) + rng.random()) for _ in runs[1:]]
        flat = [v for pair in zip(gaps, runs) for v in pair][1:]
        got = [(a, b, round(s, 6)) for a, b, s in X.maximal_segments(runs, gaps)]
        want = [(a // 2, (b + 1) // 2, round(s, 6)) for a, b, s in brute_segments(flat)]
        assert sorted(got) == sorted(want)


def test_extreme_value_rate_solves_its_equation():
    import numpy as np

    centres, p = np.array([-1.0, 2.0]), np.array([0.8, 0.2])
    rate = X.extreme_value_rate(p, centres)
    assert abs(p @ np.exp(rate * centres) - 1) < 1e-6


@pytest.fixture(scope="module")
def planted(llm):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    bad = ["vilexx", "vileyy", "grobaa", "grobbb"]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(8, 60))]
        toxic = int(rng.random() < 0.2)
        for _ in range(2 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic, 1))
    return llm.createDataFrame(rows, "doc_id long, text string"), llm.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_rows_are_told_apart(planted):
    docs, labels = planted
    got = X.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right > 0.98
    row = got.where("predicted = 1").first()
    assert row.passages and all(p.end > p.start for p in row.passages)


def test_held_out_labels_teach_nothing(planted):
    docs, labels = planted
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(X.toxicity_scores(docs, x).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert a == b


def test_words_keep_their_odds_in_a_large_vocabulary(llm):
    """Toxic and clean words share their prefixes, next to three million other words."""
    rng = random.Random(8)
    ends = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(24)]
    bad, good = ([rng.choice(("vile", "grob")) + e for e in part] for part in (ends[:8], ends[8:]))
    rows, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.3)
        text = [rng.choice("klmnopqr") * rng.randint(5, 9) for _ in range(rng.randint(8, 40))] + [rng.choice(good) for _ in range(3)]
        for _ in range(3):
            text.insert(rng.randrange(len(text)), rng.choice(bad if toxic else good))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic, 1))
    labels = llm.createDataFrame(labels, "doc_id long, toxic int, quality int")
    other = llm.range(1000, 4000).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 1000), x -> substr(hex(xxhash64(id, x)), 1, 9)))").alias("text"))
    docs = llm.createDataFrame(rows, "doc_id long, text string").union(other)
    got = X.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0] > 0.95


def test_one_of_near_copies_teaches_for_each_label(llm):
    """Long texts of common words share their least hashes, but are no copies of one another."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    unlike = [(str(i), i % 2, " ".join(rng.choice(words) for _ in range(300))) for i in range(60)]
    base = [rng.choice(words) for _ in range(300)]
    copies = [(f"c{i}", int(i > 3), " ".join([*base[:150], f"new{i}", *base[150:]])) for i in range(8)]
    empty = [("e1", 0, ""), ("e2", 0, None), ("e3", 1, "...")]
    rows = llm.createDataFrame(unlike + copies + empty, "doc_id string, label int, t string")
    got = {(r.doc_id, r.label) for r in X.one_of_copies(rows.select("doc_id", "t"), rows.select("doc_id", "label")).collect()}
    assert got == {(i, y) for i, y, _ in unlike} | {("c0", 0), ("c4", 1), ("e1", 0), ("e3", 1)}


def test_odd_rows(planted, odd_docs, no_docs):
    _, labels = planted
    got = X.toxicity_scores(odd_docs, labels.union(labels.limit(3)))
    assert got.count() == odd_docs.count()
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    assert X.toxicity_scores(no_docs, labels).count() == 0
    assert X.toxicity_scores(odd_docs, labels.limit(0)).where("predicted = 1").count() == 0
