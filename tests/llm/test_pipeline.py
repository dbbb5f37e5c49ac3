from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rideflux.llm import sentencepiece_tok, toxicity
from tests.conftest import SF_SMALL
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_equal_brute_force(spark):
    """Each stage against its definition, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]

    clean = cp.stored(stages["toxicity"](spark, docs, SF_SMALL), "t")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert clean.columns == docs.columns == COLUMNS
    assert {d for d, _ in _pairs(clean)} == {d for d, _ in _pairs(docs)} - bad

    lines = cp.stored(stages["line_dedup"](spark, clean, SF_SMALL), "t")
    want = brute.line_dedup(_pairs(clean), 50)
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {
        d: (t, len(t)) for d, (t, _, n) in want.items() if not n or t.split()}
    assert lines.columns == COLUMNS and any(n for _, _, n in want.values())

    single = cp.stored(stages["near_dedup"](spark, lines, SF_SMALL), "t")
    groups = brute.near_dups(_pairs(lines), 5, 80, 100)
    assert {d for d, _ in _pairs(single)} == {d for d, (_, c) in groups.items() if c == d}

    left = cp.stored(stages["decontamination"](spark, single, SF_SMALL), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    hit = {d for d, _ in brute.contained(_pairs(single), items)}
    assert {d for d, _ in _pairs(left)} == {d for d, _ in _pairs(single)} - hit

    tokens = stages["sentencepiece"](spark, left, SF_SMALL)
    assert {r.doc_id: r.text for r in sentencepiece_tok.decode(tokens).collect()} == dict(_pairs(left))


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stage_edge_tables(spark, name):
    """Null in any column, empty and repeated rows, clashing extra columns, no rows."""
    rows = [(1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "en", None, 0), (3, "x y", "en", "s", 3),
            (3, "x y", "en", "s", 3), (4, "w " * 100_000, "en", "s", 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("th", "runs", "sig", "score", "predicted", "item_id", "ids", "n_removed", "kept"):
        docs = docs.withColumn(c, F.lit("clash"))
    stage = dict(cp.STAGES)[name]
    got = stage(spark, docs, SF_SMALL).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "3", "4", "None"]
    if name != "sentencepiece":
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
    assert stage(spark, docs.limit(0), SF_SMALL).count() == 0


def test_planted_cases(spark):
    """Copies, near copies, benchmark and repeated passages go; clean ones stay."""
    rng = random.Random(7)
    w = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first().text
    base, passage = w(300), w(60)
    near = base.split()
    near[10] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, f"{w(100)}\n{passage}\n{w(20)}"), (5, f"{w(90)}\n{passage}"),
            (6, f"{w(200)} {item} {w(200)}"), (7, w(50)), (8, w(5))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES[1:4]:
        docs = cp.stored(stage(spark, docs, SF_SMALL), "t")
    got = dict(_pairs(docs))
    assert sorted(got) == [1, 4, 5, 7, 8]
    assert passage in got[4] and passage not in got[5] and got[7] == rows[6][1]
