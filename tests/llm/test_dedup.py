from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rideflux.llm import decontam, graph, line_dedup, near_dup
from rideflux.llm.queries import op2_decontaminate, op5_near_duplicates, op9_line_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _table(spark, name="documents"):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def _plain(df, a="doc_id", b="text"):
    return [(r[a], r[b]) for r in df.select(a, b).collect()]


def test_op5_equals_brute_force(spark):
    docs = _plain(_table(spark))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op5_near_duplicates(spark, SF_SMALL).collect()}
    assert got == brute.near_dups(docs, 3, 85, 100)


def _edited(rng, base, n_edits):
    w = list(base)
    for i in rng.sample(range(len(w)), n_edits):
        w[i] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def test_families_with_links_that_no_star_has(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for _ in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(40):
            rows.append((n, _edited(rng, base, rng.randrange(0, 8))))
            n += 1
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dup.near_duplicates(_docs(spark, rows), 3, 85, 100).collect()}
    want = brute.near_dups(rows, 3, 85, 100)
    assert got == want
    assert 4 < len({c for _, c in want.values()}) < len(rows)


def test_blocks_find_all_links_without_stars(monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    sets = [np.unique(np.array([hash(s) & (2**63 - 1) for s in brute.shingles(_edited(rng, base, k % 9), 3)], np.uint64))
            for k in range(30)]
    own = np.repeat(np.arange(30), [len(s) for s in sets])
    sig = near_dup.superminhash(np.concatenate(sets), own, 30)
    import pyarrow as pa
    t = pa.table({"chunk": [0] * 30, "sig": [s.tobytes() for s in sig], "rep": list(range(30)),
                  "comp": list(range(30)), "elements": [s.tobytes() for s in sets]})
    key = (pa.scalar(1), pa.scalar(0), pa.scalar(0))
    out = near_dup._across(key, t, near_dup.min_matches(0.85), 85, 100)
    parent = list(range(30))
    for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist()):
        parent = [parent[a] if p == parent[b] else p for p in parent]
    for a in range(30):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                assert parent[a] == parent[b]


def test_superminhash_estimates_and_is_a_function_of_the_set():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(30):
        u = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = u[:220], u[80:]
        sig = near_dup.superminhash(np.r_[a, b, a[::-1]], np.repeat([0, 1, 2], [220, 220, 220]), 3)
        assert (sig[0] == sig[2]).all()
        errors.append((sig[0] == sig[1]).mean() - 140 / 300)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    one = near_dup.superminhash(np.array([7], np.uint64), np.array([0]), 1)
    assert len(set(one[0].tolist())) > 100  # a single element fills every slot


def test_band_rows_keep_the_miss_bound():
    for share in (0.8, 0.85, 0.9):
        r = near_dup.band_rows(share)
        assert (1 - share ** r) ** (near_dup.SLOTS // r) <= near_dup.MISS


def test_near_dup_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Ä b c"), (8, "ä b c"),
            (9, long), (10, long + " tail"), (None, long), (9, long), (11, "a b c a b c a b c")]
    df = _docs(spark, rows).withColumn("component_id", F.lit("clash")).withColumn("sig", F.lit(1))
    got = sorted((tuple(r) for r in near_dup.near_duplicates(df, 3, 85, 100).collect()), key=str)
    want = {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
            (7, 1, 7, True), (8, 1, 8, True), (9, 59_998, 9, True), (10, 59_999, 9, False),
            (None, 59_998, None, True), (11, 3, 11, True)}
    assert set(got) == want and len(got) == len(rows)
    assert near_dup.near_duplicates(_docs(spark, rows).limit(0), 3, 85, 100).count() == 0


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(40)]
    got = {r.node: r.comp for r in graph.components(
        spark.createDataFrame(pairs + [(1, None)], "a long, b long")).collect()}
    parent = {x: x for p in pairs for x in p}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}


def test_op9_equals_brute_force(spark):
    docs = _plain(_table(spark))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in op9_line_dedup(spark, SF_SMALL).collect()}
    assert got == brute.line_dedup(docs, 50)
    assert any(v[2] for v in got.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_of_short_lines_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 6))) for _ in range(14)]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", " ", "\t"]) for _ in range(rng.randrange(0, 40))))
            for i in range(40)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(_docs(spark, rows), 7).collect()}
    assert got == brute.line_dedup(rows, 7)


def test_line_dedup_edge_rows(spark):
    p = " ".join(f"w{i}" for i in range(55))
    rows = [(1, None), (2, ""), (3, f"{p}\nown"), (4, f"head\n  {p}\t\n\nrest"), (5, p), (5, p), (None, p), (6, f"{p}\n{p}")]
    df = _docs(spark, rows).withColumn("runs", F.lit(1)).withColumn("th", F.lit("x"))
    got = [tuple(r) for r in line_dedup.dedup_lines(df, 50).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, None, 0, 0), (2, "", 1, 0), (3, "own", 2, 1), (4, "head\n\nrest", 4, 1), (5, "", 1, 1), (5, "", 1, 1),
         (None, p, 1, 0), (6, "", 2, 2)], key=str)
    assert line_dedup.dedup_lines(_docs(spark, rows).limit(0)).count() == 0
    runs = line_dedup.repeated_runs(_docs(spark, rows), 50)
    assert line_dedup.without_runs(df, runs).columns == df.columns


def test_line_dedup_plan_has_no_python(spark):
    plan = op9_line_dedup(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_op2_equals_brute_force(spark):
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in op2_decontaminate(spark, SF_SMALL).collect()}
    want = brute.contained(_plain(_table(spark)), _plain(_table(spark, "benchmark"), "item_id"))
    assert got == want and want


def test_items_with_edits_inside_long_documents(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.choice([5, 9, 33, 64, 65, 200])))) for i in range(40)]
    docs = []
    for d in range(30):
        text = [f"z{rng.randrange(10**6)}" for _ in range(rng.choice([0, 50, 8000]))]
        for _, item in rng.sample(items, 3):
            w = item.split()
            for k in rng.sample(range(len(w)), rng.randrange(0, max(1, len(w) // 20) + 1)):
                w[k] = "edit"
            at = rng.randrange(len(text) + 1)
            text[at:at] = w
        docs.append((d, " ".join(text)))
    want = brute.contained(docs, items)
    for words in (decontam.BLOCK_WORDS, 500):  # one block, several blocks
        monkeypatch.setattr(decontam, "BLOCK_WORDS", words)
        found = decontam.contained_items(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
        assert {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in found.collect()} == want
    assert len(want) > 40


@pytest.mark.parametrize("words", [decontam.BLOCK_WORDS, 4])
def test_short_items_inside_long_documents(spark, monkeypatch, words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", words)
    items = spark.createDataFrame([(1, "B"), (2, "a b c"), (3, "c d e f"), (4, "a b c d e f"), (5, "")], "item_id long, text string")
    docs = _docs(spark, [(1, "x A b  c y z w"), (2, "c d e"), (3, "a b c d e f g"), (4, "b"), (5, None), (6, "ab cd")])
    found = decontam.contained_items(docs, items, within=True).collect()
    assert {tuple(r)[:4] for r in found} == {(1, 1, 1, 1), (1, 2, 1, 1), (3, 1, 1, 1), (3, 2, 1, 1), (3, 3, 1, 1), (3, 4, 2, 2), (4, 1, 1, 1)}


def test_pipeline_drops_documents_with_a_short_item(spark, tmp_path):
    spark.createDataFrame([(1, "b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = _docs(spark, [(1, "a b c d e f g h"), (2, "a c b d e f g h")])
    assert [r.doc_id for r in dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, str(tmp_path)).collect()] == [2]


def test_containment_edge_rows(spark):
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b"), (3, None), (4, ""), (None, "k l m n o")],
                                  "item_id long, text string").withColumn("doc_id", F.lit(9))
    docs = _docs(spark, [(1, "x A B C D E F y"), (1, "x A B C D E F y"), (2, "A  B"), (3, None), (4, ""), (None, "k l m n o p")])
    docs = docs.withColumn("item_id", F.lit("clash"))
    got = {tuple(r)[:4] for r in decontam.contained_items(docs, items).collect()}
    assert got == {(1, 1, 2, 2), (2, 2, 1, 1), (None, None, 1, 1)}
    assert decontam.contained_items(docs.limit(0), items).count() == 0
    assert decontam.contained_items(docs, items.limit(0)).count() == 0


def _thue_morse(n):
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_words_of_mirrored_letters_are_different(spark):
    rows = []
    for k in (9, 10, 11, 12):
        word = _thue_morse(k)
        for tail in ("", " in the same four"):
            rows += [(len(rows), word + tail), (len(rows) + 1, word.translate(str.maketrans("ab", "ba")) + tail)]
    got = near_dup.near_duplicates(_docs(spark, rows), shingle=3, num=85, den=100).collect()
    # The common words behind make one equal shingle of three: far below the share.
    assert all(r.component_id == r.doc_id and r.kept for r in got)
