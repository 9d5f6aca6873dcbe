"""A corpus from raw documents: filtered, deduplicated, redacted, mixed and encoded.

Each stage works on all that its predecessor kept and is written to the shared folder before the
next one reads it, so a lost executor costs the running stage only.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, jaccard_join, mixing, pii, quality_rules
from shelfcast.llm.queries import VOCABULARY
from shelfcast.llm.tables import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def filter_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the strict policy of the quality rules keeps."""
    return quality_rules.keep_passing(docs.select(*COLUMNS), quality_rules.STRICT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return jaccard_join.keep_one(docs).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows the new text."""
    clean = pii.redact(docs.select(*COLUMNS), pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the balanced mix of their sources takes them."""
    return mixing.mixed(docs).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text they decode to."""
    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), ("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", filter_by_rules),
    ("ngram_jaccard_join", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe_encoding", encode_tokens),
]

#: The mix and the merge list are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
