"""The corpus pipeline: toxicity, near-duplicates, secrets, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitepulse.llm import jaccard, mixing, pieces, secrets, toxicity
from sitepulse.llm.catalog import TARGETS
from sitepulse.llm.common import stored

#: Documents are repeated to reach the target weights, never dropped, and so many times at most.
MOST_COPIES = 4.0
#: Near-duplicates share this percentage of their shingles of so many words.
SHINGLE_WORDS, NEAR_PERCENT = 5, 80
#: Toxic documents are gone by then, so only the other domains have a weight.
CLEAN_TARGETS = {name: weight for name, weight in TARGETS.items() if name.endswith("_toxic0")}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier flags by the threshold of their language go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of linked documents the one with the smallest id stays."""
    return jaccard.keep_one(docs, words=SHINGLE_WORDS, percent=NEAR_PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact_documents(docs, secrets.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that the expected tokens of the domains come close to their targets.

    Each stays at least once; the fitted rate, at most MOST_COPIES, says how often it is there.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mixed = mixing.mix_documents(docs, labels, CLEAN_TARGETS, least=1.0, most=MOST_COPIES, upsample=True)
    return mixing.repeat_documents(docs, mixed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return pieces.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix),
    ("piece_encoding", encode),
]

#: The classifiers are fitted, so SQL can't state the rows; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the table between two of them is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
