"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a budget of words.  Whole copies of the source fill most of it
(one document is taken twice at most); of the rest, the same share of the
documents of every length is taken, and what then remains is filled exactly, or
as nearly as the lengths allow, by bounded-knapsack dynamic programming over the
counts of documents by length.  Which documents of a length are taken follows
from a seeded hash of their content, so reruns agree.

Only (source, length, number of documents) is brought together by source: a
table of different lengths, not of documents.  Documents are chosen by hash
range within (source, length), so that no group is ranked as a whole.

Defined results: size is the number of runs of characters other than space and
``\\t \\n \\v \\f \\r``; null and empty texts have size 0 and take 0 words; a null
source is a source of its own, last in order; repeated rows are taken
separately; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import scratch_root

#: Weights of the sources in code point order, repeating; share of all words to take; copies at most.
WEIGHTS, SHARE, MOST_COPIES = (5.0, 2.0, 1.0), 1.5, 2
SEED = 17
#: Largest remaining budget, in words, that dynamic programming fits at once.
KNAPSACK = 1 << 20
#: Documents of one source and length that are ranked together.
RANKED = 512


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size and a hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
                       F.xxhash64(text).alias("content"))


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> with ``target``.  A target that would exceed ``most``
    times its source's size stops there and the excess goes to the others by weight
    until none exceeds; that is the level v with sum(min(most * size, v * weight))
    equal to the budget.  The table has a row per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1))
    # sources in the order in which they reach their limit
    ranked = ranked.withColumn("level", most * F.col("source_size") / F.col("weight"))
    full = Window.orderBy("level", F.col("source").isNull(), "source")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (ranked.withColumn("stopped", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
              .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("budget", F.sum("source_size").over(everything) * share)
              .withColumn("reached", (F.col("budget") - F.col("stopped")) / F.col("open_weight")))
    # stopping a source that need not stop lowers the level, so the highest valid one holds
    ranked = ranked.withColumn("v", F.max(F.when(F.col("reached") <= F.col("level"), F.col("reached"))).over(everything))
    return ranked.select("source", "source_size",
                         F.coalesce(F.least(most * F.col("source_size").cast("double"), F.col("v") * F.col("weight")),
                                    most * F.col("source_size").cast("double")).alias("target"))


def fit_remainder(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size (at most ``counts``) to take so that their sizes
    add up to the budget or as little less as possible."""
    take = np.zeros(len(sizes), np.int64)
    if budget <= 0 or not len(sizes):
        return take
    # what exceeds the table is filled from the longest documents down
    for at in np.argsort(-sizes):
        if budget <= KNAPSACK:
            break
        use = int(min(counts[at], max(0, (budget - KNAPSACK // 2) // sizes[at])))
        take[at] += use
        budget -= use * int(sizes[at])
    if budget > KNAPSACK:  # everything is taken
        return take
    # reached[w]: number of the step that first reached w; a step adds up to 2**k documents of one size
    reached = np.full(budget + 1, -1, np.int32)
    reached[0] = 0
    steps: list[tuple[int, int]] = [(-1, 0)]
    for at in np.argsort(-sizes):
        size, left = int(sizes[at]), int(min(counts[at] - take[at], budget // sizes[at]))
        part = 1
        while left > 0:
            n = min(part, left)
            left -= n
            part *= 2
            jump = n * size
            if jump > budget:
                continue
            steps.append((at, n))
            new = np.flatnonzero((reached[:budget + 1 - jump] >= 0) & (reached[:budget + 1 - jump] < len(steps) - 1) & (reached[jump:] < 0))
            reached[new + jump] = len(steps) - 1
            if reached[budget] >= 0:
                break
        if reached[budget] >= 0:
            break
    w = int(np.flatnonzero(reached >= 0)[-1])
    while w:
        at, n = steps[reached[w]]
        take[at] += n
        w -= n * int(sizes[at])
    return take


def fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of every document of a source (``whole``) and documents of each size to take once more."""
    rows = rows.sort_values("size", kind="stable")
    sizes, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    total, target = int((sizes * counts).sum()), int(np.floor(rows["target"].iloc[0] + 1e-6))
    whole = min(target // total, MOST_COPIES) if total else 0
    rest = target - whole * total if whole < MOST_COPIES else 0
    more = np.zeros(len(sizes), np.int64)
    some = sizes > 0
    if rest > 0:
        even = counts[some] * rest // total
        more[some] = even
        rest -= int((even * sizes[some]).sum())
        more[some] += fit_remainder(sizes[some], counts[some] - even, rest)
    return pd.DataFrame({"source": rows["source"], "size": sizes, "n": counts, "whole": whole, "more": more})


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (times the document is taken) and taken (words)."""
    rows = sized(docs, id_col, text_col, source_col)
    # the place of a document among those of its source and size, as a whole number from 0 to 2**32 - 1
    rows = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), "content"), 32))
    # several steps read these few columns; the texts are read once
    scratch_root(docs.sparkSession)
    return chosen(rows.checkpoint())


def chosen(rows: DataFrame) -> DataFrame:
    by_size = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    targets = source_targets(by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    fitted = (by_size.alias("h").join(targets.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")))
              .select("h.source", "h.size", "h.n", "s.target")
              .groupBy("source").applyInPandas(fit_source, "source string, size long, n long, whole long, more long"))
    # documents of one source and size are told apart by ranges of their place
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / RANKED)).cast("long")
    plan = (fitted.withColumn("parts", parts).alias("p")
            .join(targets.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
            .select("p.*", "s.source_size", "s.target"))
    own = (rows.alias("r").join(plan.alias("q"), F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r.size") == F.col("q.size")))
           .select("r.doc_id", "r.source", "r.size", "r.content", "r.place", "q.whole", "q.more", "q.parts", "q.source_size", "q.target")
           .withColumn("part", F.shiftright(F.col("place") * F.col("parts"), 32)))
    filled = own.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("m"))
    earlier = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.withColumn("earlier", F.coalesce(F.sum("m").over(earlier), F.lit(0)))
    ranked = (own.alias("o").join(filled.alias("f"), F.col("o.source").eqNullSafe(F.col("f.source")) & (F.col("o.size") == F.col("f.size"))
                                  & (F.col("o.part") == F.col("f.part")))
              .select("o.*", "f.earlier")
              .withColumn("rank", F.col("earlier") + F.row_number().over(
                  Window.partitionBy("source", "size", "part").orderBy("place", "content", "doc_id"))))
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("whole") + (F.col("rank") <= F.col("more")).cast("long"))
    return ranked.select("doc_id", "source", "content", "size", "source_size", "target", copies.cast("long").alias("copies"),
                         (copies * F.col("size")).cast("long").alias("taken"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    return mix_sources(docs, **options).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The documents of the mix, a row for each time one is taken, with all columns."""
    plan = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    # repeated rows may be taken differently often: they are paired up by their number
    content = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = ["__id", "__source", "__content"]
    nth = Window.partitionBy(*same).orderBy(F.lit(1))
    left = docs.withColumns({"__id": F.col(id_col), "__source": F.col(source_col), "__content": content})
    summed = (plan.groupBy(F.col("doc_id").alias("__i"), F.col("source").alias("__s"), F.col("content").alias("__c"))
              .agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")))
    on = (F.col("__id").eqNullSafe(F.col("__i")) & F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__content") == F.col("__c")))
    one = left.join(summed, on)
    # rows that agree in id, source and text share their copies evenly, the first ones taking what is left over
    extra = F.when(F.col("__rows") == 1, 1).otherwise(F.row_number().over(nth))
    times = (F.floor(F.col("__copies") / F.col("__rows")) + (extra <= F.col("__copies") % F.col("__rows")).cast("long")).cast("int")
    taken = one.withColumn("__times", times).where("__times > 0").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
