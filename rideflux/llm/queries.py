"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rideflux.llm import (
    ann, chat_quotes, decontam, fim, html_extract, line_dedup, lm, near_dup, oracle, runs, secret_scan, sentencepiece_tok,
    toxicity, warc)
from rideflux.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_tok.encode(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85, den=100)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op7_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.threads(table(spark, sf_dir, "conversations"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(runs.repeat_tail(table(spark, sf_dir, "documents")), least=12))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.interpolated_scores(table(spark, sf_dir, "documents"), order=2)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50))


def queries() -> dict[str, QueryFn]:
    return {
        "op1_nearest_neighbours": op1_nearest_neighbours,
        "op2_decontaminate": op2_decontaminate,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_toxicity": op4_toxicity,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_secrets": op6_secrets,
        "op7_chat_threads": op7_chat_threads,
        "op8_warc": op8_warc,
        "op9_line_dedup": op9_line_dedup,
        "op10_html_extract": op10_html_extract,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_lm_scores": op12_lm_scores,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontaminate": oracle.OP2,
        "op5_near_duplicates": oracle.OP5,
        "op8_warc": oracle.OP8,
        "op9_line_dedup": oracle.OP9,
        "op13_fill_in_middle": oracle.OP13,
    }
