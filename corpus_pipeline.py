"""Corpus cleaning pipeline: named stages over the ``documents`` table.

``run`` applies the stages in order; each result is written to the shared
folder as Parquet and read again as the next stage's input.  All but the last
stage return the columns of ``documents``; the last one returns token ids.

Every stage takes null ids and texts, empty texts, repeated rows and an empty
table.  A row with a null id is never dropped by a decision on ids; null and
empty texts have no toxic passage, line, shingle or token and stay.  Line dedup
drops a row only where the deletion of its runs leaves no word.  Rows repeated
with one id share the other stages' decisions on that id.  Columns besides
``doc_id``, ``text`` and ``n_chars`` are carried unchanged up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux.llm import decontam, line_dedup, near_dup, sentencepiece_tok, toxicity
from rideflux.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows whose id is not among ``rejected.doc_id``; null ids stay."""
    return docs.join(rejected.select("doc_id").distinct(), "doc_id", "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts toxic go."""
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scored.where("predicted = 1")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of 50 words or more go, and documents that have no
    word left; ``n_chars`` follows the text."""
    runs = line_dedup.repeated_runs(docs.select("doc_id", F.col("text").cast("string").alias("text")), 50)
    out = line_dedup.without_runs(docs, runs, keep_emptied=False).select(*docs.columns)
    if "n_chars" in docs.columns:
        n = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.coalesce(n, F.col("n_chars")))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: one document of each group stays."""
    groups = near_dup.near_duplicates(docs, shingle=5, num=80, den=100)
    return _without(docs, groups.where("NOT kept")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item (five-word shingles, 0.8; an item
    of fewer words anywhere in the document) go."""
    found = decontam.contained_items(docs, table(spark, sf_dir, "benchmark"), within=True)
    return _without(docs, found).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document, checked by decoding them."""
    return sentencepiece_tok.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

#: Learning, signatures and tokenisation are not SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
