"""From raw documents to token ids: toxic documents go, one of each group of near copies
stays, secrets are replaced, sources are mixed to their weights, texts become token ids.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` with
``docs`` all that the stage before kept, and all but the last return the columns
of ``documents``. Between stages the rows are written as Parquet to the shared folder and
read again, so a lost executor costs one stage's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritab.llm import jaccard, mixing, pieces, secret_scan, toxicity
from veritab.llm.common import table
from veritab.sources.files import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more are dropped; the field is learned from the labelled
    documents of the whole table that are not held out."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by shingles of five words and a Jaccard
    similarity of 0.8 or more."""
    return jaccard.keep_one(docs, words=5, percent=80)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets become ``[kind]``."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes their documents, whole ones only (0 to 3 times)."""
    mixed = mixing.mix(docs, mixing.quality_weight(table(spark, sf_dir, "labels")), split_last=False)
    return mixing.repeat_rows(docs, mixed)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the check that they decode to its text."""
    return pieces.report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", replace_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# The field's marginals, the union of links and the search for pieces are beyond SQL;
# tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
