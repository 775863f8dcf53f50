import hashlib
import random

import numpy as np
import pytest

from ledgerlens.llm import suffixdedup as S


def brute(texts, size):
    seen = {}
    for t in texts:
        for x in range(len(t) - size + 1):
            seen[t[x:x + size]] = seen.get(t[x:x + size], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for x in range(len(t) - size + 1):
            if seen[t[x:x + size]] > 1:
                gone[x:x + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    out = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                parts.append(p[a:a + rng.randint(10, 400)])
            elif kind < 0.5:
                parts.append((rng.choice(words) + " ") * rng.randint(1, 40))
            else:
                parts.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))))
        out.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    return [*out, (100, None), (100, ""), (102, "x" * 250), (103, out[5][1]), (None, out[5][1]), (None, out[6][1])]


@pytest.mark.parametrize("seed,size", [(1, 40), (2, 97), (3, 40)])
def test_all_repeated_strings_go(llm, seed, size, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(S, "GROUP_ROWS", 8)
    data = rows(seed)
    df = llm.createDataFrame(data, "doc_id long, text string").repartition(4)
    order = lambda r: (r[0] is not None, *r)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df, min_bytes=size).collect()), key=order)
    want = sorted(((i, *b) for (i, _), b in zip(data, brute([(t or "").encode() for _, t in data], size))), key=order)
    assert got == want


def test_whole_documents_table(llm, docs):
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    want = dict(zip(texts, brute(list(texts.values()), 400)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs).collect()}
    assert got == want


def test_sliding_minimum():
    values = np.random.default_rng(1).integers(0, 1 << 60, 500, dtype=np.uint64)
    got = S.sliding_min(values, 37)
    assert all(got[i] == values[i:i + 37].min() for i in range(500))


def test_odd_rows(odd_docs, no_docs):
    got = S.remove_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.n_removed for r in got if r.n_bytes < 400} == {0}
    # the two long texts differ in their last bytes only
    assert all(r.n_bytes - r.n_removed <= 4 for r in got if r.n_bytes > 400)
    assert S.remove_repeats(no_docs).count() == 0
