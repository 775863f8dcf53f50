"""Quality classifier by positive-unlabelled learning.

Trusted positives are the training documents labelled 1; the unlabelled set is
every document.  The classifier is additive over quantile bins of text
features.  With squared loss the non-negative unbiased risk

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])

depends on the data only through first and second moments of the basis, so one
Spark pass gathers them over all documents and the minimisation itself runs on
a matrix whose size does not depend on the data.  The class prior is estimated
from the unlabelled-to-positive ratio above score thresholds.

Defined results: null and empty texts have all features 0 and are scored as
such; a text of symbols alone has its symbols' features, whatever rows stand beside it; repeated rows are scored each; repeated label rows count once; null
labels and ids teach nothing; with no positives every score is 0.5.  Columns
other than the id and the text are never read by the score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.folds import held_out, training_labels
from ledgerlens.llm.textops import mix, row_starts, text_chunks, words
from ledgerlens.session import scratch_root

FEATURES = ("log_words", "same_as_last", "same_as_second_last", "distinct", "upper", "shout", "symbols",
            "bars", "mean_length", "stops", "lines", "digits", "punctuation", "distinct_pairs")
#: Quantile bins of a feature.
BINS = 10
#: Ridge term of the risk (this over the number of positives, this at least), and steps of its minimisation.
RIDGE_OVER_POSITIVES, LEAST_RIDGE, STEPS = 20.0, 1e-4, 300
#: Bins of the score histograms that the prior is estimated from, and estimates made (each with the last one's weights).
PRIOR_BINS, PRIOR_ROUNDS = 200, 2
#: Least share of the positives above a threshold that may bound the prior.
PRIOR_MASS = 0.7


def class_of(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


UPPER, DIGIT = class_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), class_of("0123456789")
SHOUT, SYMBOL, BAR, STOP, LINE = class_of("!"), class_of("#$%&*@^~<>{}[]\\=_+"), class_of("|"), class_of(".,;:?"), class_of("\n")
PUNCTUATION = class_of("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()))


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Set bytes of each row."""
    total = np.concatenate(([0], np.cumsum(mask)))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def distinct_per_row(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Different values of each row (40 bits of each value and its row together)."""
    key = (row.astype(np.uint64) << np.uint64(40)) | (mix(values) >> np.uint64(24))
    return np.bincount((np.unique(key) >> np.uint64(40)).astype(np.int64), minlength=n).astype(np.float64)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per document."""
    n = len(offsets) - 1
    _, start, end, row, h = words(data, offsets)
    first = row_starts(row, n)
    count = np.diff(first).astype(np.float64)
    per_word = 1 / np.maximum(count, 1)
    size = np.maximum(np.diff(offsets), 1)

    def repeats(distance: int) -> np.ndarray:
        same = (h[distance:] == h[:-distance]) & (row[distance:] == row[:-distance])
        return np.bincount(row[distance:][same], minlength=n) * per_word

    pair = h[1:] * np.uint64(3) + h[:-1]
    inside = row[1:] == row[:-1]
    # distinct counts fall with length in any text; the power takes most of that out
    scale = np.maximum(count, 1) ** 0.9
    return np.stack([
        np.log1p(count), repeats(1), repeats(2), distinct_per_row(h, row, n) / scale,
        per_row(UPPER[data], offsets) / size, per_row(SHOUT[data], offsets) * per_word,
        per_row(SYMBOL[data], offsets) * per_word, per_row(BAR[data], offsets) * per_word,
        np.bincount(row, end - start, minlength=n) * per_word, per_row(STOP[data], offsets) * per_word,
        per_row(LINE[data], offsets) * per_word, per_row(DIGIT[data], offsets) / size,
        per_row(PUNCTUATION[data], offsets) / size,
        distinct_per_row(pair[inside], row[1:][inside], n) / scale,
    ], axis=1)


@dataclass
class QualityModel:
    edges: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    prior: float = 0.5

    def basis(self, x: np.ndarray) -> np.ndarray:
        """A constant, and for each feature which bin it is in."""
        parts = [np.ones((len(x), 1), np.float32)]
        for j, edges in enumerate(self.edges):
            parts.append(np.eye(len(edges) + 1, dtype=np.float32)[np.searchsorted(edges, x[:, j], side="right")])
        return np.concatenate(parts, axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.basis(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip((1 + self.margin(x).astype(np.float64)) / 2, 0.0, 1.0)


def minimise_risk(prior: float, ridge_term: float, mean_u, second_u, mean_p, second_p) -> np.ndarray:
    """Weights of least non-negative risk.  It starts from the least unbiased risk
    (closed form); while the negative part is below 0, steps undo that part."""
    d = len(mean_u)
    ridge = ridge_term * np.eye(d)
    w = np.linalg.solve(second_u + ridge, 2 * prior * mean_p - mean_u)
    rate = 0.5 / max(np.linalg.eigvalsh(second_u)[-1], 1e-9)
    best, best_risk = w, np.inf
    for _ in range(STEPS):
        positive = (1 - 2 * w @ mean_p + w @ second_p @ w) / 4
        negative = ((1 + 2 * w @ mean_u + w @ second_u @ w) - prior * (1 + 2 * w @ mean_p + w @ second_p @ w)) / 4
        risk = prior * positive + max(0.0, negative) + ridge_term * w @ w / 4
        if risk < best_risk:
            best, best_risk = w, risk
        grad_negative = (mean_u + second_u @ w - prior * (mean_p + second_p @ w)) / 2
        if negative < 0:
            w = w + rate * grad_negative
        else:
            w = w - rate * (prior * (second_p @ w - mean_p) / 2 + grad_negative + ridge_term * w / 2)
    return best


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    schema = T.StructType([source.schema.fields[0], T.StructField("x", T.ArrayType(T.FloatType()))])

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                x = features(data, offsets).astype(np.float32)
                flat = pa.array(x.ravel())
                ends = np.arange(0, len(flat) + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "x"])

    return source.mapInArrow(run, schema)


def gather(rows: DataFrame, sums) -> dict[str, np.ndarray]:
    """Add up what ``sums(x, positive)`` gives for each batch: name -> vector.  The
    vectors have a fixed length; Spark adds them entry by entry."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
            positive = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for key, value in sums(x, positive).items():
                total[key] = total.get(key, 0) + value
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["key", "v"])

    parts = rows.mapInArrow(run, "key string, v array<double>")
    added = parts.select("key", F.posexplode("v").alias("at", "v")).groupBy("key", "at").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    table = added.toArrow().to_pandas()
    for key, own in table.groupby("key"):
        out[key] = np.zeros(int(own["at"].max()) + 1)
        out[key][own["at"].to_numpy()] = own["v"].to_numpy()
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", bins: int = BINS) -> QualityModel:
    """Fit on all documents (unlabelled) and the training positives among them."""
    spark = docs.sparkSession
    scratch_root(spark)
    positives = training_labels(labels, label_col).where("label = 1").select("doc_id", F.lit(True).alias("positive"))
    rows = (feature_table(docs, id_col, text_col).join(positives, "doc_id", "left")
            .select("x", F.coalesce("positive", F.lit(False)).alias("positive"))).checkpoint()
    columns = [F.col("x")[j].cast("double").alias(f) for j, f in enumerate(FEATURES)]
    quantiles = rows.select(columns).stat.approxQuantile(list(FEATURES), [i / bins for i in range(1, bins)], 0.002)
    if not quantiles or not quantiles[0]:
        return QualityModel()
    # a bin starts above its edge's value, so a value that many documents share (0) has one of its own
    model = QualityModel(edges=[np.unique(np.nextafter(np.float32(q), np.float32(np.inf))).astype(np.float64) for q in quantiles])

    def moments(x, positive):
        phi = model.basis(x).astype(np.float64)
        own = phi[positive]
        return {"n_u": np.array([float(len(phi))]), "m_u": phi.sum(0), "s_u": (phi.T @ phi).ravel(),
                "n_p": np.array([float(len(own))]), "m_p": own.sum(0), "s_p": (own.T @ own).ravel()}

    got = gather(rows, moments)
    if not got or not got["n_p"][0]:
        return QualityModel()
    d = len(got["m_u"])
    n_u, n_p = got["n_u"][0], got["n_p"][0]
    args = (max(LEAST_RIDGE, RIDGE_OVER_POSITIVES / n_p), got["m_u"] / n_u, got["s_u"].reshape(d, d) / n_u, got["m_p"] / n_p, got["s_p"].reshape(d, d) / n_p)
    model.weights = minimise_risk(0.5, *args)

    def histogram(x, positive):
        at = np.clip(((model.margin(x) + 2) / 4 * PRIOR_BINS).astype(int), 0, PRIOR_BINS - 1)
        return {"u": np.bincount(at, minlength=PRIOR_BINS).astype(float),
                "p": np.bincount(at[positive], minlength=PRIOR_BINS).astype(float)}

    for _ in range(PRIOR_ROUNDS):
        got = gather(rows, histogram)
        model.prior = estimate_prior(got["u"], got["p"])
        model.weights = minimise_risk(model.prior, *args)
    return model


def estimate_prior(unlabelled: np.ndarray, positive: np.ndarray) -> float:
    """Least ratio of unlabelled to positive mass above a threshold, each with its
    sampling error added, over thresholds that enough positives exceed."""
    u = np.cumsum(unlabelled[::-1]) / unlabelled.sum()
    p = np.cumsum(positive[::-1]) / positive.sum()
    enough = p >= PRIOR_MASS
    error_u = 2 * np.sqrt(u * (1 - u) / unlabelled.sum())
    error_p = 2 * np.sqrt(p * (1 - p) / positive.sum())
    ratio = (u + error_u)[enough] / np.maximum(p - error_p, 1e-9)[enough]
    return float(np.clip(ratio.min(), 0.01, 0.99))


def score_quality(docs: DataFrame, model: QualityModel, *, keep: list[str], text_col: str = "text",
                  score_name: str = "score") -> DataFrame:
    """The columns in ``keep`` and the score of each document."""
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("t"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("s", T.DoubleType())])

    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            for lo, hi, data, offsets in text_chunks(batch.column(last)):
                x = features(data, offsets).astype(np.float32).astype(np.float64)
                own = [batch.column(i).slice(lo, hi - lo) for i in range(last)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(model.score(x))], names=schema.names)

    return source.mapInArrow(run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("s").alias(score_name))


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted (score of 0.5 or more) of every document."""
    scored = score_quality(docs, fit_quality(docs, labels, **options), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The documents scored at or above the threshold, with all their columns."""
    model = fit_quality(docs, labels, **options)
    scored = score_quality(docs, model, keep=docs.columns, score_name="__quality")
    return scored.where(F.col("__quality") >= threshold).drop("__quality")
