import hashlib
import random
import re

import numpy as np

from ledgerlens.llm import decontaminate as D


def words(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i:i + k])]
        sha = hashlib.sha256(",".join(sorted(str(f) for f in found if f is not None)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def report(df, items, **options):
    got = D.contamination_report(df, items, **options).drop("spans").collect()
    return sorted(map(tuple, got), key=str)


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(6)
    text = rng.integers(1, 5, 300)
    index = D.FMIndex(text, 4)
    phrases = rng.integers(1, 5, (60, 4))
    which, low, high = index.search(phrases)
    found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
    for i, p in enumerate(phrases):
        want = [x for x in range(297) if (text[x:x + 4] == p).all()]
        assert found.get(i, []) == want


def test_suffix_order():
    text = np.array([2, 1, 2, 1, 2, 2, 0])
    assert D.suffix_order(text).tolist() == sorted(range(7), key=lambda i: text[i:].tolist())


def test_windows_equal_a_plain_search(llm):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ñ1", "Ab"]
    phrase = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, phrase(rng.choice([12, 15, 30]))) for i in range(25)] + [(50, "W1 w2"), (51, "Ab"), (52, ""), (53, None), (3, phrase(11)), (None, phrase(14))]
    docs = []
    for i in range(120):
        parts = [phrase(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 8))
            parts += [" ".join(w[a:a + rng.randint(5, 20)]).upper(), phrase(rng.randint(0, 8))]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(200, None), (200, ""), (None, docs[3][1]), (None, docs[3][1])]
    df = llm.createDataFrame(docs, "doc_id long, text string")
    table = llm.createDataFrame(items, "item_id long, text string")
    want = sorted(brute(docs, items), key=str)
    assert report(df, table) == want
    assert report(df.repartition(3), table, block_windows=7) == want
    kept = D.drop_contaminated(df.withColumn("k0", D.F.lit(1)), table)
    assert kept.columns == ["doc_id", "text", "k0"] and kept.count() == sum(not w[5] for w in want)


def test_spans_cover_the_hit_words(llm):
    item = "one two three four five six seven eight nine ten eleven"
    df = llm.createDataFrame([(1, f"É before, {item.upper()} after")], "doc_id long, text string")
    row = D.contamination_report(df, llm.createDataFrame([(1, item)], "item_id long, text string")).first()
    (span,) = row.spans
    assert f"É before, {item.upper()} after".encode()[span.start:span.end].decode() == item.upper()


def test_odd_rows(llm, odd_docs, no_docs):
    items = llm.createDataFrame([(1, "The same words stand here twice and nothing else is in")], "item_id long, text string")
    got = D.contamination_report(odd_docs, items)
    assert got.count() == odd_docs.count() and got.where("contaminated").count() == 4
    assert D.contamination_report(no_docs, items).count() == 0
    assert D.contamination_report(odd_docs, items.limit(0)).where("contaminated").count() == 0
