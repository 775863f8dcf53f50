from collections import Counter

import duckdb
import pytest

from ledgerlens.llm import sharding as S


def brute_table(names, slots):
    import hashlib

    lists = []
    for n in names:
        h = hashlib.md5(n.encode()).digest()
        offset, skip = int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:], "big") % (slots - 1) + 1
        lists.append([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for i, order in enumerate(lists):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = i
    return [table[s] for s in range(slots)]


def test_shards_claim_slots_in_turn():
    names = S.shard_names(7)
    table = S.lookup_table(names, 101)
    assert table == brute_table(names, 101)
    count = Counter(table)
    assert max(count.values()) - min(count.values()) <= 1


def test_removing_a_shard_moves_few_slots():
    names = S.shard_names(20)
    a, b = S.lookup_table(names, 4099), S.lookup_table(names[:-1], 4099)
    moved = sum(x != y for x, y in zip(a, b) if x != 19)
    assert moved < 0.15 * 4099


def test_table_size_must_be_prime():
    with pytest.raises(ValueError):
        S.lookup_table(S.shard_names(3), 100)


def test_sql_gives_the_same(llm):
    from tests.conftest import SF_CHECK

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    df = S.shard_report(llm.read.parquet(f"{SF_CHECK}/documents.parquet"))
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(S.oracle_sql()).fetchall())


def test_odd_rows(odd_docs, no_docs):
    got = S.place(odd_docs)
    assert got.count() == odd_docs.count() and got.columns == [*odd_docs.columns, "slot", "shard"]
    again = S.place(got)
    assert again.columns == got.columns and again.count() == got.count()
    assert S.place(no_docs).count() == 0
