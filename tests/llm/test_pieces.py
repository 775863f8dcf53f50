import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerlens.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.model_of(pieces.read_model(PATH))


def same(model, library, text):
    ids = library.encode(text)
    assert model.encode(text) == ids, text[:200]
    assert model.decode(ids) == library.decode(ids), text[:200]
    assert model.ids_and_text(text) == (",".join(map(str, ids)), library.decode(ids)), text[:200]


def test_ids_and_texts_are_the_library_s(model, library):
    rng = random.Random(7)
    alphabets = ["ab ", " ▁a", "aeiounrst ", "aAbB.,\n \t", "éè ñ日本a\r\n", "<s>/0x41 ", "=-_*# ", "\x00\x1f  a", "🙂a‍ "]
    for _ in range(8_000):
        same(model, library, "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(40))))
        same(model, library, "".join(rng.choice(alphabets[rng.randrange(9)]) for _ in range(rng.randrange(40))))
    for _ in range(4_000):
        same(model, library, library.decode([rng.randrange(259, 32000) for _ in range(rng.randrange(8))]))
    for _ in range(500):
        same(model, library, "".join(chr(rng.choice([rng.randrange(32, 0xd800), rng.randrange(0xe000, 0x110000)])) for _ in range(20)))
    for text in ("", " ", "  ", "▁", "\n", "a" * 5_000, " " * 3_000, "ab" * 4_000 + " end", "日" * 2_000):
        same(model, library, text)


def test_decoding_any_ids(model, library):
    rng = random.Random(8)
    for _ in range(4_000):
        ids = [rng.randrange(0, rng.choice([300, 32000])) for _ in range(rng.randrange(7))]
        assert model.decode(ids) == library.decode(ids), ids


def test_backtracking_is_needed_and_forgetting_is_harmless(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    small = pieces.PieceModel(pieces.read_model(PATH))
    greedy = 0
    rng = random.Random(9)
    for _ in range(2_000):
        text = "".join(rng.choice("etaoinshr") for _ in range(12))
        same(small, library, text)
        longest = [small.ids_of[p][0] for _, p in small.automaton.iter_long(pieces.MARK + text)]
        greedy += longest != library.encode(text)
    assert greedy > 200


def test_every_document(llm, docs, library):
    got = {r.doc_id: r for r in pieces.encoding_report(docs, PATH).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        ids = library.encode(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows_and_round_trip(llm, odd_docs, no_docs, library):
    encoded = pieces.encode_documents(odd_docs, PATH, keep=["doc_id", "t", "score"])
    rows = encoded.collect()
    want = sorted((str(r.doc_id), library.encode(r.text or "")) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == want
    back = pieces.decode_documents(encoded, PATH, keep=["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    report = pieces.encoding_report(odd_docs, PATH)
    assert report.where("n_tokens = 0").count() == odd_docs.where(F.coalesce("text", F.lit("")) == "").count()
    assert pieces.encoding_report(no_docs, PATH).count() == 0
    nulls = llm.createDataFrame([(1, None), (2, [None, 28705]), (3, [])], "doc_id int, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in pieces.decode_documents(nulls, PATH).collect()) == [(1, ""), (2, ""), (3, "")]
