"""Toxicity by maximum-scoring segments.

Every word scores the log-odds of the toxic against the clean class under
Dirichlet priors, in two levels: its first four bytes (prior: the prefix's share
of the whole corpus) and the word given that prefix.  A level whose class shares
do not differ significantly (likelihood ratio) scores 0.  One linear scan over a document
finds all maximal-scoring segments; each is judged by extreme-value statistics
(lambda and K of the clean documents), the significant ones are its toxic
passages, and their evidence is turned into a probability.

Words and prefixes are counted exactly, by 64-bit hash, where the labelled rows
are; only those that stand out reach the driver and are broadcast (words of the
other documents cannot have odds of their own).  There may be ``MAX_ODDS`` of
them; more are an error, never left out.  Corpus counts of these prefixes cover
all documents; the labelled rows that teach are bounded by ``MAX_LABELS`` (lowest
hash of the id first).  Of near duplicates among them one teaches for each label.

Defined results: null and empty texts have no words and get the score of a
document without evidence; repeated rows are scored each; null labels and ids
teach nothing; without labels of both classes every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.folds import held_out, training_labels
from ledgerlens.llm.jaccard import similarity_classes
from ledgerlens.llm.textops import prefix_hash, row_starts, slice_hash, text_chunks, words
from ledgerlens.session import scratch_root

#: Words, and prefixes, that may stand out (12 bytes each in the broadcast).
MAX_ODDS = 1 << 22
#: Bytes of a word that make its prefix.
PREFIX = 4
#: Labelled rows that may teach.
MAX_LABELS = 200_000
#: Strength of the prior, and the log-likelihood ratio statistic from which a level counts.
STRENGTH, STAND_OUT = 100.0, 20.0
#: Score of a word that says nothing, and what every word must make up for: one less than 1.6 times
#: as frequent in toxic documents does not speak for a passage (significant or not).
DRIFT = -0.5
#: Expected number of chance segments as good, below which a passage is significant.
E_VALUE = 0.05
#: Width of the bins of the token score histogram.
SCORE_BIN = 0.05
SCORE_CLIP = 20.0


def token_hashes(data: np.ndarray, offsets: np.ndarray):
    """Row, start, end, hash and prefix hash of each word."""
    low, start, end, row, h = words(data, offsets)
    prefix = slice_hash(prefix_hash(low), start, np.minimum(end, start + PREFIX)) if len(start) else h
    return row, start, end, h.view(np.int64), prefix.view(np.int64)


def one_of_copies(rows: DataFrame, taught: DataFrame) -> DataFrame:
    """(doc_id, label) of one labelled document for each label of each group of near duplicates (the
    least id's): copies would make the words they happen to hold look toxic or clean.  Groups
    are those of five-word shingles with a similarity of 0.8; documents without words are one group."""
    own, found = similarity_classes(rows.select("doc_id", "t"), text_col="t")
    grouped = own.join(found.select("cid", "root"), "cid", "left").join(F.broadcast(taught), "doc_id")
    return grouped.groupBy("root", "label").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "label")


#: What an entry of the counts is for.
WORDS, PREFIXES, DOCUMENTS = 0, 1, 2


def count_training(taught: DataFrame) -> DataFrame:
    """kind, h, p (prefix of a word), t, c: toxic and clean documents that have a word or
    prefix, from rows (t: text, label); kind ``DOCUMENTS`` counts them all."""

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                row, _, _, word, prefix = token_hashes(data, offsets)
                own = label[lo:hi]
                parts = [([DOCUMENTS], [0], [0], [(own == 1).sum()], [(own == 0).sum()])]
                for kind, h in ((WORDS, word), (PREFIXES, prefix)):
                    if not len(h):
                        continue
                    order = np.lexsort((row, h))
                    h, in_row, p = h[order], row[order], prefix[order]
                    new = np.concatenate(([True], h[1:] != h[:-1]))
                    once = new | np.concatenate(([True], in_row[1:] != in_row[:-1]))
                    first = np.flatnonzero(new)
                    toxic = np.add.reduceat((once & (own[in_row] == 1)).astype(np.int64), first)
                    clean = np.add.reduceat((once & (own[in_row] == 0)).astype(np.int64), first)
                    parts.append((np.full(len(first), kind), h[first], p[first], toxic, clean))
                columns = [np.concatenate([np.asarray(part[i], np.int64) for part in parts]) for i in range(5)]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0].astype(np.int32)), *map(pa.array, columns[1:])], names=["kind", "h", "p", "t", "c"])

    parts = taught.select("t", "label").mapInArrow(run, "kind int, h long, p long, t long, c long")
    return parts.groupBy("kind", "h", "p").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).checkpoint()


def standing_out(counts: DataFrame) -> dict[str, np.ndarray]:
    """h, t, c, of_t, of_c of the rows whose class shares differ significantly, by hash."""
    names = ["h", "t", "c", "of_t", "of_c"]

    def run(batches):
        for batch in batches:
            _, t, c, of_t, of_c = (column.to_numpy().astype(float) for column in batch.columns)
            yield batch.filter(pa.array(stands_out(np.ones(len(t)), t, of_t, c, of_c) > 0))

    found = counts.select(*[F.col(n).cast("long") for n in names]).mapInArrow(run, ", ".join(f"{n} long" for n in names)).checkpoint()
    n = found.count()
    if n > MAX_ODDS:
        raise ValueError(f"{n} words or prefixes stand out, more than MAX_ODDS = {MAX_ODDS}")
    table = found.toArrow()
    out = {name: table.column(name).to_numpy() for name in names}
    order = np.argsort(out["h"])
    return {name: values[order] for name, values in out.items()}


def count_corpus(rows: DataFrame, prefixes: np.ndarray) -> tuple[np.ndarray, int]:
    """How often all documents have each of some prefixes (hashes in order), and their words in all."""
    shared = rows.sparkSession.sparkContext.broadcast(prefixes)

    def run(batches):
        n, keys = np.zeros(len(shared.value) + 1, np.int64), shared.value
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                prefix = token_hashes(data, offsets)[4]
                n[-1] += len(prefix)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, prefix), len(keys) - 1)
                    n[:-1] += np.bincount(at[keys[at] == prefix], minlength=len(keys))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], names=["at", "n"])

    got = rows.select("t").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(prefixes) + 1)
    if got.num_rows:
        out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    shared.unpersist()
    return out[:-1], int(out[-1])


def stands_out(odds: np.ndarray, t, n_t, c, n_c) -> np.ndarray:
    """The log-odds where t of n_t and c of n_c differ significantly, else 0."""
    share = (t + c) / np.maximum(n_t + n_c, 1)
    g = np.zeros(np.shape(odds))
    for seen, of in ((t, n_t), (c, n_c)):
        expected = np.maximum(of * share, 1e-12)
        g += 2 * seen * np.log(np.maximum(seen, 1e-12) / expected)
    return np.where(g >= STAND_OUT, odds, 0.0)


@dataclass
class Odds:
    """Log-odds by hash (in order); hashes that it does not hold have 0."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(h), np.float32)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.values[at], np.float32(0))


@dataclass
class ToxicityModel:
    #: Log-odds of a prefix; of a word given its prefix.
    prefix_odds: Odds = field(default_factory=Odds)
    word_odds: Odds = field(default_factory=Odds)
    rate: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, float] = (-30.0, 0.0)

    def token_scores(self, word: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return np.clip((self.prefix_odds.of(prefix) + self.word_odds.of(word)).astype(np.float64), -SCORE_CLIP, SCORE_CLIP) + DRIFT

    def evidence(self, segment_scores: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """ln of 1 / E-value of segments in documents of so many words."""
        return self.rate * segment_scores - self.log_k - np.log(np.maximum(n_words, 1))

    def probability(self, total: np.ndarray) -> np.ndarray:
        a, b = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(total), -40, 40)))


def maximal_segments(scores: list[float], gaps: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a sequence given as
    positive runs and the sums between them (``gaps[i]`` comes before run i), in
    one pass over the runs."""
    found: list[list[float]] = []  # first run, end run, sum before it, sum up to its end
    total = 0.0
    for i, score in enumerate(scores):
        total += gaps[i]
        first, left, right = i, total, total + score
        total = right
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                found.append([first, i + 1, left, right])
                break
            first, left = int(found[j][0]), found[j][2]
            del found[j:]
    return [(int(a), int(b), right - left) for a, b, left, right in found]


def scan(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray, significant_only: bool):
    """Words of each row, its segments as (start byte, end byte, score), and all token scores by row.
    With ``significant_only``, rows whose positive words together would not make a significant
    segment have none looked for."""
    n = len(offsets) - 1
    row, start, end, word, prefix = token_hashes(data, offsets)
    first = row_starts(row, n)
    score = model.token_scores(word, prefix) if len(row) else np.zeros(0)
    segments: list[list[tuple[int, int, float]]] = [[] for _ in range(n)]
    if len(row):
        up = score > 0
        change = np.flatnonzero(np.concatenate(([True], (up[1:] != up[:-1]) | (row[1:] != row[:-1]))))
        run_sum = np.add.reduceat(score, change)
        run_end = np.concatenate((change[1:], [len(score)]))
        run_row, run_up = row[change], up[change]
        some = np.unique(run_row[run_up])
        if significant_only:
            together = np.bincount(run_row[run_up], run_sum[run_up], minlength=n)[some]
            some = some[model.evidence(together, np.diff(first)[some]) > -np.log(E_VALUE)]
        for doc in some:
            at = np.arange(*np.searchsorted(run_row, (doc, doc + 1)))
            ups = at[run_up[at]]
            before = np.concatenate(([0.0], np.cumsum(np.where(run_up[at], 0.0, run_sum[at]))))
            gap_to = before[ups - at[0]]
            gaps = np.diff(np.concatenate(([0.0], gap_to))).tolist()
            for a, b, s in maximal_segments(run_sum[ups].tolist(), gaps):
                segments[doc].append((int(start[change[ups[a]]] - offsets[doc]), int(end[run_end[ups[b - 1]] - 1] - offsets[doc]), s))
    return np.diff(first), segments, row, score


def token_model(rows: DataFrame, taught: DataFrame) -> ToxicityModel | None:
    """Word scores from the texts (t) and the labels of some of them; None without both classes."""
    counts = count_training(rows.join(F.broadcast(taught), "doc_id"))
    n_t, n_c = counts.where(F.col("kind") == DOCUMENTS).agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    if not n_t or not n_c:
        return None
    prefixes = counts.where(F.col("kind") == PREFIXES).drop("kind", "p")
    p = standing_out(prefixes.withColumns({"of_t": F.lit(n_t), "of_c": F.lit(n_c)}))
    used, total = count_corpus(rows, p["h"])
    prior = STRENGTH * used / max(total, 1) + 0.5
    odds = np.log((p["t"] + prior) / (n_t + STRENGTH)) - np.log((p["c"] + prior) / (n_c + STRENGTH))
    # share of the word among documents with its prefix, under a symmetric prior; the statistic is
    # at most twice as many as have the word by ln of all documents, so rarer words need no look
    enough = STAND_OUT / (2 * np.log(n_t + n_c))
    w = standing_out(counts.where((F.col("kind") == WORDS) & (F.col("t") + F.col("c") >= float(enough) * 0.999)).drop("kind")
                     .join(prefixes.select(F.col("h").alias("p"), F.col("t").alias("of_t"), F.col("c").alias("of_c")), "p"))
    own = np.log((w["t"] + 0.5) / (w["of_t"] + 1.0)) - np.log((w["c"] + 0.5) / (w["of_c"] + 1.0))
    return ToxicityModel(Odds(p["h"], odds.astype(np.float32)), Odds(w["h"], own.astype(np.float32)))


def extreme_value_rate(histogram: np.ndarray, centres: np.ndarray) -> float:
    """lambda > 0 with sum p(s) exp(lambda s) = 1 over the clean documents' token scores."""
    p = (histogram + 0.0) / max(histogram.sum(), 1)
    if not (p[centres > 0] > 0).any() or p @ centres >= 0:
        return 1.0
    low, high = 0.0, 50.0 / SCORE_CLIP
    if p @ np.exp(high * centres) < 1:
        return high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if p @ np.exp(middle * centres) < 1 else (low, middle)
    return (low + high) / 2


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope of a ridge logistic regression on one input."""
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -40, 40)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([(y - p).sum() - ridge * a, ((y - p) * x).sum() - ridge * b])
        curve = np.array([[w.sum() + ridge, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + ridge]])
        step = np.clip(np.linalg.solve(curve, gradient), -5, 5)
        a, b = a + step[0], b + step[1]
    return float(a), float(b)


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", max_labels: int = MAX_LABELS) -> ToxicityModel:
    """Learn word scores, extreme-value parameters and the final calibration."""
    spark = docs.sparkSession
    scratch_root(spark)
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("t"))
    # bounded by max_labels, so it may be broadcast
    taught = (training_labels(labels, label_col).select(F.col("doc_id").cast("string").alias("doc_id"), "label")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).checkpoint())
    taught = one_of_copies(rows.join(F.broadcast(taught.select("doc_id")), "doc_id"), taught).checkpoint()
    model = token_model(rows, taught)
    if model is None:
        return ToxicityModel()
    shared = spark.sparkContext.broadcast(model)
    bins = int(2 * (SCORE_CLIP + 1) / SCORE_BIN)

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                n_words, segments, row, score = scan(shared.value, data, offsets, False)
                clean = (label[lo:hi] == 0)[row]
                at = np.clip(((score[clean] + SCORE_CLIP + 1) / SCORE_BIN).astype(int), 0, bins - 1)
                hist = np.bincount(at, minlength=bins)
                some = np.flatnonzero(hist)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((label[lo:hi], np.full(len(some), -1))).astype(np.int32)),
                    pa.array(np.concatenate((n_words, some)).astype(np.int64)),
                    pa.array([[s for _, _, s in own] for own in segments] + [[float(v)] for v in hist[some]], pa.list_(pa.float64()))],
                    names=["label", "n", "s"])

    # the rows of the labelled documents (label 0 or 1), and histogram entries (label -1)
    got = (rows.join(F.broadcast(taught), "doc_id").select("t", "label")
           .mapInArrow(run, "label int, n long, s array<double>").checkpoint())
    hist = np.zeros(bins)
    for r in got.where("label = -1").groupBy("n").agg(F.sum(F.col("s")[0]).alias("v")).collect():
        hist[r["n"]] = r["v"]
    model.rate = extreme_value_rate(hist, (np.arange(bins) + 0.5) * SCORE_BIN - SCORE_CLIP - 1)
    best = F.coalesce(F.array_max("s"), F.lit(0.0))
    # K is the location of the best scores of clean documents, whose scale is 1 / lambda (a Gumbel law)
    location = (got.where("label = 0 and n > 0")
                .agg(F.avg(F.lit(model.rate) * best - F.log("n"))).first()[0])
    model.log_k = float(location if location is not None else 0.0) - 0.5772156649
    final = spark.sparkContext.broadcast(model)

    def totals(batches):
        for batch in batches:
            own = [significant(final.value, np.array(x), n) for x, n in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.float64())], names=["label", "total"])

    # two numbers for each labelled document, at most max_labels
    table = got.where("label >= 0").select("label", "n", "s").mapInArrow(totals, "label int, total double").toArrow()
    model.weights = fit_logistic(np.log1p(table.column("total").to_numpy()), table.column("label").to_numpy().astype(float))
    final.unpersist()
    shared.unpersist()
    return model


def significant(model: ToxicityModel, scores: np.ndarray, n_words: int) -> float:
    """Summed evidence of a document's significant segments."""
    if not len(scores):
        return 0.0
    evidence = model.evidence(scores, np.full(len(scores), n_words))
    return float(evidence[evidence > -np.log(E_VALUE)].sum())


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``keep``, ``score`` and ``passages``: the significant segments
    as byte ranges with their evidence (ln of 1 / E-value)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("t"))
    passage = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                            T.StructField("evidence", T.DoubleType())])
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("score", T.DoubleType()),
                           T.StructField("passages", T.ArrayType(passage))])
    arrow_passages = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))

    def run(batches):
        own_model = shared.value
        for batch in batches:
            last = batch.num_columns - 1
            for lo, hi, data, offsets in text_chunks(batch.column(last)):
                n_words, segments, _, _ = scan(own_model, data, offsets, True)
                totals, passages = np.zeros(hi - lo), []
                for i, own in enumerate(segments):
                    evidence = own_model.evidence(np.array([s for _, _, s in own]), np.full(len(own), n_words[i]))
                    passages.append([{"start": a, "end": b, "evidence": float(e)} for (a, b, _), e in zip(own, evidence) if e > -np.log(E_VALUE)])
                    totals[i] = sum(p["evidence"] for p in passages[-1])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, hi - lo) for i in range(last)], pa.array(own_model.probability(totals)), pa.array(passages, arrow_passages)],
                    names=schema.names)

    return source.mapInArrow(run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "score", "passages")


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted (score of 0.7 or more), passages of every document."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, **options), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "passages")
