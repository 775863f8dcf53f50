"""The registered queries of this package: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import collocations, decontaminate, fingerprints, jaccard, licenses, mixing, pieces, prepare, quality, secrets, sharding, suffixdedup, toxicity, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document (trigram inverted index)."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and toxic passages of every document (maximum-scoring segments)."""
    prepare(spark)
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document (Bayesian pruning)."""
    prepare(spark)
    return jaccard.similarity_join(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document (positive-unlabelled learning)."""
    prepare(spark)
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invertible sketch of every document and of its edited text, and their likeness."""
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken for the sources' target weights (subset-sum fit)."""
    prepare(spark)
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document (permutation-filled lookup table)."""
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that occur again."""
    prepare(spark)
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document (FM-index per shard)."""
    prepare(spark)
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every document (conditional compression)."""
    prepare(spark)
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language (FM-index per shard over word ids)."""
    prepare(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"))


#: The model file of the encoding query, from the installed tokenizer files.
PIECE_MODEL = "piece_bpe_32k.model"


def op12_sentencepiece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to (backtracking)."""
    import public_tokenizers

    prepare(spark)
    return pieces.encoding_report(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings on their largest components (contour integration)."""
    prepare(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_source_mixing": op6_source_mixing,
    "op7_sharding": op7_sharding,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_license_scan": op10_license_scan,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_sentencepiece_encoding": op12_sentencepiece_encoding,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": secrets.oracle_sql(),
    "op7_sharding": sharding.oracle_sql(),
}
