import hashlib
import random
import re

import xxhash

from ledgerlens.llm import fingerprints as P


def paragraphs(text, coarser=0):
    words = re.findall(P.WORD, text)
    k = P.ONE_IN[level(text) + coarser]
    out, start = set(), 0
    for i in range(1, len(words) + 1):
        if i == len(words) or xxhash.xxh64(words[i].encode(), seed=xxhash.xxh64(words[i - 1].encode(), seed=42).intdigest()).intdigest() % k == 0:
            out.add("".join(words[start:i]))
            start = i
    return out


def level(text):
    return sum(len(text) >= n for n in P.CLASSES)


def like(text, other):
    a = paragraphs(text, level(text) < level(other))
    b = paragraphs(other, level(other) < level(text))
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def expected(rows):
    place = lambda t: xxhash.xxh64((t or "").encode(), seed=42).intdigest() >> 32
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, place(r[1]), r[1] or ""), reverse=True)
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    round(like(text, edited), 9), round(like(text, after), 9)))
    return out


def key(row):
    return (row[0] is not None, *row)


def check(df, rows, **options):
    got = P.fingerprint_report(df, **options).collect()
    mine = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(mine, key=key) == sorted(expected(rows), key=key)
    return got


def test_whole_table_with_many_ranges(llm, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(docs, rows, range_rows=2)


def test_odd_rows(llm, odd_docs, no_docs):
    got = check(odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()], range_rows=1)
    by_text = {}
    texts = {(r.doc_id, len(r.text or "")): r.text or "" for r in odd_docs.collect()}
    for r in got:
        by_text.setdefault(texts[r.doc_id, r.n_chars], set()).add(r.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert P.fingerprint_report(no_docs).count() == 0


def test_many_rows_without_an_id(llm):
    rows = [(None, f"Text number {i % 40}.") for i in range(90)] + [(1, "One."), (7, "Seven.")]
    check(llm.createDataFrame(rows, "doc_id long, text string"), rows, range_rows=7)
    check(llm.createDataFrame(rows[:90], "doc_id long, text string"), rows[:90], range_rows=7)


def test_one_row_follows_itself(llm):
    row = P.fingerprint_report(llm.createDataFrame([(3, "One. Two. Three. Four.")], "doc_id long, text string")).first()
    assert row.near_next == 1.0


def test_differing_digests_are_recovered(llm):
    rows = [(2, "A first. Second here. Third one. Fourth."), (1, "Xy.")]
    got = {r.doc_id: r for r in P.fingerprints(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    text, after = rows[0][1], rows[1][1]
    edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
    signs = sorted(d.sign for d in got[2].differing_edited)
    assert signs == [-1] * len(paragraphs(edited) - paragraphs(text)) + [1] * len(paragraphs(text) - paragraphs(edited))


def test_short_one_line_texts_are_like_their_edited_texts(llm):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80))[:12 + i] + "." * (i % 2)) for i in range(400)]
    got = check(llm.createDataFrame(rows, "doc_id long, text string"), rows)
    assert all(r.near_edited > r.near_next for r in got)


def test_likeness_does_not_depend_on_the_place_of_an_edit(llm, docs):
    """Kept first half, kept second half, kept ends, words put in front: all near one another."""
    texts = [r.text for r in docs.select("text").collect() if r.text and len(r.text) > 100]
    other = " ".join(reversed(" ".join(texts[:20]).split()))

    def mean(edit):
        return sum(like(t, edit(t, len(t) // 2)) for t in texts) / len(texts)

    first = mean(lambda t, h: t[:len(t) - h] + other[:h])
    second = mean(lambda t, h: other[:h] + t[h:])
    ends = mean(lambda t, h: t[:h // 2] + other[:h] + t[h // 2 + h:])
    assert max(first, second, ends) - min(first, second, ends) < 0.15 and min(first, second, ends) > 0.3
    assert mean(lambda t, h: "Two words " + t) > 0.8


def test_texts_of_neighbouring_classes_compare_by_common_cuts(llm):
    rng = random.Random(4)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(900))
    rows = [(2, long), (1, "x")]
    got = check(llm.createDataFrame(rows, "doc_id long, text string"), rows)
    edited = {r.doc_id: r.near_edited for r in got}
    assert level(long) != level(long[:len(long) // 2 + 2]) and edited[2] > 0.3


def test_scripts_without_spaces_have_paragraphs(llm):
    rng = random.Random(6)
    rows = [(i, "".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(300))) for i in range(4)]
    assert all(r.near_edited > 0.3 > r.near_next for r in check(llm.createDataFrame(rows, "doc_id long, text string"), rows))
