import hashlib
import re

import duckdb
import pytest

from ledgerlens.llm import secrets as S

RULES = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def base(text):
    found = sorted((m.start(), k, m.end(), name) for k, (name, rx, group, least) in enumerate(RULES)
                   for m in rx.finditer(text or "") if len(m[group]) >= least)
    joined = ",".join(f"{n}:{a}:{b}" for a, _, b, n in found)
    return [sum(f[1] == k for f in found) for k in range(3)] + [hashlib.sha256(joined.encode()).hexdigest()]


TRICKY = [None, "", "token: token: abcdef", "secret=é\"password = 'abcdefg' PASSWD:abc token=secret=abcdef12", "AKIA" + "A" * 16 + " AKIA" + "B" * 3,
          "AKIAAKIA" + "C" * 13, "api_key:0123456789abcdef0123456789", "😀 apikey = \"abc.def-12345\" 😀 " + "a" * 24 + "g" + "0" * 23,
          "ghp_" + "a1" * 20 + " xoxb-12345678901 -----BEGIN RSA PRIVATE KEY-----", "password" * 3 + "=xxxxxxx", "token=a " * 300 + "token=abcdefg"]


def test_spans_equal_a_plain_scan(llm):
    df = llm.createDataFrame([(i, t) for i, t in enumerate(TRICKY)] + [(0, TRICKY[3]), (None, TRICKY[3])], "doc_id long, text string")
    got = {}
    for r in S.secret_report(df).collect():
        got.setdefault(r.doc_id, []).append([r.n_assign, r.n_access, r.n_hex, r.base_sha256])
    for i, t in enumerate(TRICKY):
        assert base(t) in got[i], t
    assert got[None] == [base(TRICKY[3])] and len(got[0]) == 2


def test_added_kinds_join_the_spans(llm):
    row = S.secret_report(llm.createDataFrame([(1, TRICKY[8])], "doc_id long, text string")).first()
    assert row.spans == "github:0:44,hex:4:44,slack:45:61,private_key:62:93"


@pytest.mark.parametrize("rule", S.RULES, ids=lambda r: r.kind)
def test_every_match_holds_a_clause(rule):
    samples = {"assign": "Api_Key='abcdef'", "access": "AKIA" + "A" * 16, "hex": "a" * 24, "github": "ghs_" + "x" * 36,
               "slack": "xoxp-" + "1" * 10, "private_key": "-----BEGIN EC PRIVATE KEY-----"}
    text = samples[rule.kind]
    assert re.search(rule.pattern, text)
    clauses = S.trigram_query(rule.pattern)
    assert not clauses if rule.kind == "hex" else any(all(g in text.lower() for g in c) for c in clauses)


def test_sql_gives_the_same(llm, docs):
    from tests.conftest import SF_CHECK

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    want = sorted(con.execute(S.oracle_sql()).fetchall())
    got = sorted(map(tuple, S.secret_report(llm.read.parquet(f"{SF_CHECK}/documents.parquet")).collect()))
    assert got == want and sum(r[1] for r in got) > 0


def test_odd_rows(odd_docs, no_docs):
    assert S.secret_report(odd_docs).count() == odd_docs.count()
    assert S.secret_report(no_docs).count() == 0
