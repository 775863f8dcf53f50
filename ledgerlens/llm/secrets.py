"""Secret scans over a trigram inverted index.

For every rule a Boolean trigram query is derived from its regular expression:
an OR of ANDs of the trigrams that every match must hold.  The index has a
posting (trigram, text) for each trigram that a rule asks for; postings are
intersected by a join and a count, and only the texts left are verified with the
rule's expression.  A rule without mandatory trigrams is verified on every text.
All of it is DataFrame expressions; trigrams and texts are compared in lower
case, which can only add candidates.

The texts travel to the postings' result once; equal texts share their postings.

Defined results: null counts as the empty text, which has no spans; positions
are code points, end exclusive; matches of a kind are leftmost and do not
overlap, and one whose value is too short is dropped without being retried;
repeated rows each get their row and ids are passed through, null or not.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``pattern`` must hold for Java, RE2 and Python alike; ``group`` is the value
    and must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


KEYWORDS = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])

#: The kinds in order; the first three are the base kinds.
RULES = (
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run that is long enough, from where it starts: the same as any run, dropped if short
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")
#: Strings that a stretch of a pattern may spell out before it counts as open.
SPELLED = 64


def spelled(parsed) -> list[set[str] | None]:
    """The parts of a pattern in order: the lower-case strings a part can match, or
    None for a part that is not spelled out."""
    parts: list[set[str] | None] = []
    for kind, value in parsed:
        if kind is sre.LITERAL:
            parts.append({chr(value).lower()})
        elif kind is sre.IN:
            chars = {chr(c).lower() for k, v in value for c in ([v] if k is sre.LITERAL else range(v[0], v[1] + 1) if k is sre.RANGE else range(200))}
            parts.append(chars if len(chars) <= 8 and value[0][0] is not sre.NEGATE else None)
        elif kind is sre.SUBPATTERN:
            parts += spelled(value[3])
        elif kind is sre.BRANCH:
            options = [whole(spelled(option)) for option in value[1]]
            parts.append(None if None in options else set().union(*options))
        elif kind is sre.MAX_REPEAT:
            low, high, inner = value
            own = whole(spelled(inner))
            if own is not None and high <= 2:
                parts.append({"".join(p) for n in range(low, high + 1) for p in itertools.product(own, repeat=n)})
            else:
                parts += [own] * min(low, 3) + [None]
        else:
            parts.append(None)
    return parts


def whole(parts: list[set[str] | None]) -> set[str] | None:
    """All strings of consecutive parts, if they are spelled out and not too many."""
    out = {""}
    for part in parts:
        if part is None or len(out) * len(part) > SPELLED:
            return None
        out = {a + b for a in out for b in part}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The ORed clauses of trigrams that a match must hold; empty if there are none."""
    parts = spelled(sre_parser.parse(pattern))
    best: list[frozenset[str]] = []
    for a in range(len(parts)):
        for b in range(a + 1, len(parts) + 1):
            strings = whole(parts[a:b])
            if strings is None:
                break
            if min(map(len, strings)) >= 3:
                clauses = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
                clauses = [c for c in clauses if not any(o < c for o in clauses)]
                if not best or min(map(len, clauses)) > min(map(len, best)):
                    best = clauses
    return sorted(best, key=sorted)


def spans(text: Column, rule: Rule, number: int) -> Column:
    """The spans of a rule in a text: structs of start, kind number, end."""
    before = F.transform(F.split(text, rule.pattern, -1), F.length)
    match = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
    found = F.arrays_zip(F.slice(before, 1, F.size(match)).alias("before"), match.alias("match"), value.alias("value"))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    step = lambda at, m: F.struct(
        (at["at"] + m["before"] + m["match"]).alias("at"),
        F.when(m["value"] >= rule.least, F.array_append(at["spans"], F.struct(
            (at["at"] + m["before"]).alias("start"), F.lit(number).alias("kind"), (at["at"] + m["before"] + m["match"]).alias("end"))))
        .otherwise(at["spans"]).alias("spans"))
    walked = F.aggregate(found, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), step, lambda at: at["spans"])
    # most texts have no match: they are looked through once
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), walked).otherwise(nothing)


def joined(spans_: Column, rules) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, rules=RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``found``: the spans (start, kind number, end) of all rules in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    grams = sorted({g for q in queries for clause in q for g in clause})
    number = {g: i for i, g in enumerate(grams)}
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"), F.lower(text).alias("low"), F.xxhash64(text).alias("key"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for g, i in number.items()])) if grams else F.array().cast("array<int>")
    rows = rows.withColumn("grams", held)
    everywhere = [spans(F.col("t"), r, i) for i, r in enumerate(rules) if not queries[i]]
    scanned = F.flatten(F.array(*everywhere)) if everywhere else F.array().cast("array<struct<start:int,kind:int,end:int>>")

    # postings and their intersection: the clauses of which a text has every trigram
    postings = rows.select("key", F.explode("grams").alias("gram")).distinct()
    clauses = [F.struct(F.lit(number[g]).alias("gram"), F.lit(i).alias("rule"), F.lit(k).alias("clause"), F.lit(len(c)).alias("need"))
               for i, q in enumerate(queries) for k, c in enumerate(q) for g in c]
    if not clauses:
        return rows.select("doc_id", F.array_sort(scanned).alias("found"))
    wanted = docs.sparkSession.range(1).select(F.explode(F.array(*clauses)).alias("c")).select("c.*")
    candidates = (postings.join(F.broadcast(wanted), "gram").groupBy("key", "rule", "clause").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"))
                  .where("n = need").groupBy("key").agg(F.collect_set("rule").alias("rules")))

    kept = rows.select("doc_id", "key", scanned.alias("scanned"), "t")
    verified = [F.when(F.array_contains("rules", i), spans(F.col("t"), r, i)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
                for i, r in enumerate(rules) if queries[i]]
    return kept.join(candidates, "key", "left").select(
        "doc_id", F.array_sort(F.flatten(F.array(F.col("scanned"), *verified))).alias("found"))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of the secret scan."""
    found = scan_secrets(docs, RULES, **options)
    of_kind = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select("doc_id", *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
                        F.sha2(joined(base, RULES), 256).alias("base_sha256"), joined(F.col("found"), RULES).alias("spans"))


def oracle_sql() -> str:
    """DuckDB SQL of ``secret_report`` over the table ``documents``: every rule on every text."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(RULES):
        parts.append(f"""
    SELECT row, {i} AS kind, '{r.kind}' AS name,
           unnest(list_transform(range(1, len(m) + 1), lambda i: {{'start': list_sum(list_transform(b[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'len': length(m[i]), 'value': length(v[i])}})) AS s
    FROM (SELECT row, string_split_regex(t, {quoted(r.pattern)}) AS b, regexp_extract_all(t, {quoted(r.pattern)}, 0) AS m,
                 regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) AS v FROM texts)""")
    keep = " OR ".join(f"kind = {i} AND s.value >= {r.least}" for i, r in enumerate(RULES))
    joined_ = "coalesce(string_agg(name || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind) {}, '')"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
all_spans AS ({" UNION ALL ".join(parts)}),
spans AS (SELECT row, kind, name, s.start AS start, s.start + s.len AS stop FROM all_spans WHERE {keep})
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate(BASE_KINDS))},
       sha256({joined_.format(f"FILTER (kind < {len(BASE_KINDS)})")}) AS base_sha256, {joined_.format("")} AS spans
FROM texts LEFT JOIN spans USING (row) GROUP BY row, doc_id
"""


