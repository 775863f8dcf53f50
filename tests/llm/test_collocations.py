import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import collocations as C
from tests.conftest import SF_CHECK

LOWER = {i: i + 32 for i in range(65, 91)}


def phrases(rows):
    """(lang, words) -> [count, with a word on the left, on the right], and words by language."""
    found, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    c = found.setdefault((lang, tuple(w[i:i + size])), [0, 0, 0])
                    c[0] += 1
                    c[1] += i > 0
                    c[2] += i + size < len(w)
    return found, total


def brute(rows, least=10, top=2000):
    found, total = phrases(rows)
    f = {k: v[0] for k, v in found.items()}
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in candidates.items():
        if len(w) == 2 and any(100 * b >= 50 * a for (other, x), b in near(candidates, lang, w)):
            continue
        score, k, left, right = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), left, right, *(found[lang, w][1:] if len(w) == 3 else (None, None))))
    got, rank = [], Counter()
    for lang, score, a, phrase, left, right, before, after in sorted(out, key=lambda r: r[:4]):
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score, before, after))
    return got


_NEAR = {}


def near(candidates, lang, w):
    """The candidates of three words that hold the pair."""
    key = id(candidates)
    if key not in _NEAR:
        _NEAR.clear()
        by = {}
        for (l, x), b in candidates.items():
            if len(x) == 3:
                for pair in (x[:2], x[1:]):
                    by.setdefault((l, pair), []).append(((l, x), b))
        _NEAR[key] = by
    return _NEAR[key].get((lang, w), [])


def result(frame):
    return sorted(map(tuple, frame.collect()))


def rows_of(frame):
    return [(r.lang, r.text) for r in frame.select("lang", "text").collect()]


@pytest.mark.parametrize("options", [{}, {"shard_words": 3_000, "max_bits": 1 << 16}])
def test_every_document_against_brute_force(llm, options):
    docs = llm.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert result(C.collocations(docs, **options)) == sorted(brute(rows_of(docs)))


def test_ties_covered_phrases_and_small_limits(llm):
    rng = random.Random(4)
    words = ["a", "b", "c", "É", "é", "z_"]
    rows = [(rng.choice(["x", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", ",", " ", " "]) for _ in range(60)))
            for _ in range(150)]
    docs = llm.createDataFrame(rows, "lang string, text string").repartition(3)
    for least, top in ((10, 7), (2, 2000)):
        assert result(C.collocations(docs, least=least, top=top, shard_words=500)) == sorted(brute(rows, least, top))


def test_intervals_extend_both_ways():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 7, 4_000)
    index = C.WordIndex(text, 7)
    plain = "".join(map(str, text))
    pairs = index.right(index.words())
    for got in (pairs, index.left(index.words()), index.right(pairs), index.left(pairs)):
        size = got.words.shape[1]
        want = Counter(plain[i:i + size] for i in range(len(plain) - size + 1) if "1" not in plain[i:i + size])
        assert {"".join(map(str, w)): n for w, n in zip(got.words, got.count)} == want
        left, right = index.extended(got)
        for w, a, b in zip(got.words, left, right):
            p = "".join(map(str, w))
            assert a == sum(plain.startswith(p, i) and i > 0 and plain[i - 1] != "1" for i in range(len(plain)))
            assert b == sum(plain.startswith(p, i) and i + size < len(plain) and plain[i + size] != "1" for i in range(len(plain)))
    # equal phrases reached both ways have the same intervals
    by_right, by_left = index.right(pairs), index.left(pairs)
    intervals = lambda p: {tuple(w): (f, b) for w, f, b in zip(p.words, p.forward, p.backward)}
    assert intervals(by_right) == intervals(by_left)


def test_wide_alphabets_are_ordered_alike():
    rng = np.random.default_rng(5)
    text = rng.integers(1, 40, 500)
    narrow, wide = C.WordIndex(text, 40), C.WordIndex(text, 1 << 22)
    a, b = narrow.right(narrow.right(narrow.words())), wide.right(wide.right(wide.words()))
    assert (a.words == b.words).all() and (a.count == b.count).all()


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.range(1).select(C.cut_score(F.lit(big), F.lit(big + 1), F.lit(big + 7)).alias("s")).first()
    assert row.s == 1_000_000 * big * big // ((big + 1) * (big + 7))


def test_odd_rows(llm, odd_docs, no_docs):
    assert result(C.collocations(odd_docs, least=2)) == sorted(brute(rows_of(odd_docs), least=2))
    assert C.collocations(no_docs).count() == 0
    assert C.collocations(odd_docs.where("text is null or text = ''")).count() == 0


class Tasks:
    """Stands for a table of documents: runs what its tasks would run."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def groupBy(self, *_):
        return self

    def agg(self, *_):
        return self


def written(batch, shard_words, second):
    """The record batches of a task of the first or second pass (all pairs in the bitmap)."""
    tasks = Tasks()
    if second:
        C.phrase_rows(tasks, SimpleNamespace(value=np.full(1 << 10, -1)), shard_words)
    else:
        C.word_and_pair_counts(tasks, shard_words)
    return tasks.run(iter([batch]))


def some_texts(n):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(1_500)]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.9 else "often" for _ in range(500)) for _ in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(["en"] * n), pa.array(texts)], names=["lang", "t"])


@pytest.mark.parametrize("second", [False, True])
def test_a_task_holds_one_shard_at_a_time(llm, second):
    batch = some_texts(1_800)  # three shards of about 2 MB
    list(written(batch.slice(0, 40), 10_000, second))  # tables that are kept

    def peak(rows):
        tracemalloc.start()
        try:
            for _ in written(rows, 300_000, second):
                pass
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(batch) < 1.25 * peak(batch.slice(0, 600))


@pytest.mark.parametrize("second", [False, True])
def test_rows_are_written_in_parts_and_stay_the_same(llm, second, monkeypatch):
    batch = some_texts(60)

    def rows():
        found = list(written(batch, 100_000, second))
        return max(b.num_rows for b in found), Counter(tuple(r.values()) for b in found for r in b.to_pylist())

    _, whole = rows()
    monkeypatch.setattr(C, "PART", 5_000, raising=False)
    most, parts = rows()
    assert parts == whole and most <= 5_000
