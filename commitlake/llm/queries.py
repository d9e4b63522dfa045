"""Queries of the operators on text and code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commitlake.llm import generated, leakage, mixture, names, quality
from commitlake.session import read


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each pair of users whose typed names stand for the same person or organisation."""
    return names.same_pairs(names.linked_users(read(spark, d, "users_metadata")))


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each user with its class of names."""
    return names.linked_users(read(spark, d, "users_metadata"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Each file version nobody wrote by hand."""
    return p2_reasons(spark, d).select("path_id", "hash_id")


def p2_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The same with the reason: generated, minified, vendored or data."""
    return generated.unwritten(read(spark, d, "commits_info"), read(spark, d, "path_strings"), read(spark, d, "contents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Each document with each evaluation item of which it holds a passage."""
    return leakage.leaks(read(spark, d, "documents"), read(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p8_matches(spark: SparkSession, d: str) -> DataFrame:
    """The longest verbatim match and its location for each leak."""
    return leakage.leaks(read(spark, d, "documents"), read(spark, d, "eval_items"))


def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    """The ids of the documents without any leak."""
    documents = read(spark, d, "documents")
    return leakage.decontaminated(documents, leakage.leaks(documents, read(spark, d, "eval_items"))).select("doc_id")


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Inclusion of the fractional copies is proportional to the size of a document."""
    return mixture.mixture(mixture.token_counts(read(spark, d, "documents")), read(spark, d, "mix_targets"), weight="tokens")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture with their copies."""
    return _mixture(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share each source was to reach and the one it reached."""
    return _mixture(spark, d)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Each document that is for the most part no natural prose."""
    return quality.text_types(read(spark, d, "documents"), read(spark, d, "common_words")).filter("text_type <> 'prose'").select("doc_id")


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The statistics, type posteriors and type of every document."""
    return quality.text_types(read(spark, d, "documents"), read(spark, d, "common_words"))


QUERIES = {f.__name__: f for f in (p1_found, p1_classes, p2_found, p2_reasons, p8_found, p8_matches, p8_clean, p9_mixture, p9_shares, p10_found, p10_statistics)}

from commitlake.llm.sql import SQL  # noqa: E402, F401
