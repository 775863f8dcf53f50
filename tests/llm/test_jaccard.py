import random
import re
from collections import Counter

import pytest

from ledgerlens.llm import jaccard as J
from ledgerlens.llm.graph import components


def shingle_set(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(texts):
    """Group representative and number of links of each document (ids are places)."""
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))
    links = [0] * len(texts)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            common = len(sets[a] & sets[b])
            if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(find(i), links[i]) for i in range(len(texts))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.choice([1, 2, 5, 30])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own).upper() if rng.random() < 0.2 else " ".join(own))
    return out


@pytest.mark.parametrize("block,group_block", [(1024, 256), (5, 4)])
def test_links_and_groups_equal_all_pairs(llm, texts, monkeypatch, block, group_block):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "GROUP_BLOCK", group_block)
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.similarity_join(df).collect()}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert max(n for _, n in want) > 5


def test_one_of_each_group_stays(llm, texts):
    df = llm.createDataFrame([*enumerate(texts), (0, texts[0]), (900, ""), (901, None)], "doc_id long, text string")
    kept = sorted(r.doc_id for r in J.one_of_each_group(df).collect())
    assert kept == sorted({g for g, _ in brute(texts)} | {900, 901})


def test_pruning_keeps_pairs_at_the_threshold():
    least = J.least_matches(0.8)
    assert all(m < n * 0.8 for m, n in zip(least, range(16, 129, 16))) and least[-1] > 64


def test_components_of_a_path(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_odd_rows(odd_docs, no_docs):
    got = J.similarity_join(odd_docs).collect()
    assert len(got) == odd_docs.count()
    same = Counter(r.class_id for r in got if r.copies == 4)
    assert same == {1: 4} and all(r.n_links == 3 for r in got if r.copies == 4)
    assert {r.class_id for r in got if r.doc_id == 8} == {8}
    assert J.similarity_join(no_docs).count() == 0
    assert J.one_of_each_group(odd_docs).columns == odd_docs.columns
