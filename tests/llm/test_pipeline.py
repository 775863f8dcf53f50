import corpus_pipeline
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as groups

from ledgerlens.llm import mixing, quality


def test_stages_take_effect_in_turn(llm):
    d = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(llm, seen[-1], d).checkpoint())
    assert all(s.columns == columns for s in seen[:-1]) and seen[-1].columns == [*columns, "slot", "shard"]
    ids = [[r.doc_id for r in s.select("doc_id").collect()] for s in seen]

    labels = llm.read.parquet(f"{d}/labels.parquet")
    good = quality.quality_scores(docs, labels).where("predicted = 1").select("doc_id").collect()
    assert sorted(ids[1]) == sorted(r.doc_id for r in good)

    rows = sorted((r.doc_id, r.text) for r in seen[1].select("doc_id", "text").collect())
    assert sorted(ids[2]) == sorted({rows[g][0] for g, _ in groups([t for _, t in rows])})

    items = [tuple(r) for r in llm.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in seen[2].select("doc_id", "text").collect()]
    assert sorted(ids[3]) == sorted(x[0] for x in contaminated(rows, items) if not x[5])

    mix = mixing.mix_report(seen[3]).collect()
    assert sorted(ids[4]) == sorted(r.doc_id for r in mix for _ in range(r.copies))
    assert sorted(ids[5]) == sorted(ids[4])


def test_run_gives_the_last_stage(llm):
    out = corpus_pipeline.run(llm, "/root/testdata/sf0.001")
    assert out.columns[-2:] == ["slot", "shard"] and out.count() > 0


def test_stages_on_odd_rows(llm, odd_docs, no_docs):
    """Null, empty, long, tied and repeated rows, and columns named slot and shard."""
    d = "/root/testdata/sf0.001"
    odd = odd_docs.withColumnRenamed("size", "slot").withColumnRenamed("key", "shard")
    for docs in (odd, no_docs):
        whole = {tuple(r) for r in docs.collect()}
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(llm, docs, d)
            assert kept.columns == docs.columns
            assert {tuple(r) for r in kept.collect()} <= whole
        placed = corpus_pipeline.sharding_stage(llm, docs, d)
        assert placed.columns == [*(c for c in docs.columns if c not in ("slot", "shard")), "slot", "shard"]
        assert placed.count() == docs.count() and placed.where("slot is null or shard is null").count() == 0
