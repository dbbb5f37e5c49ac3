"""Queries with DuckDB SQL on the given tables, and texts that cost time."""

from __future__ import annotations

import time

import pytest

from rideflux.llm import html_extract as hx
from rideflux.llm import line_dedup, near_dup, queries
from tests.conftest import SF_SMALL, _key, _norm

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    rel = con.sql(SQL[name])
    df = queries.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    want = [tuple(_norm(r[i]) for i in at) for r in rel.fetchall()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_line_of_a_million_blanks(spark):
    long = "a" + " " * 1_000_000 + "b"
    docs = spark.createDataFrame([(1, f"{long}\n" + " \t" * 500_000), (2, long)], "doc_id long, text string")
    line_dedup.dedup_lines(docs).collect()  # a warm session
    started = time.perf_counter()
    rows = line_dedup.dedup_lines(docs).collect()
    assert time.perf_counter() - started < 20 and all(r.n_removed == 0 for r in rows)


@pytest.mark.parametrize("html", [
    "<b>" * 330_000, "<i><div>" + "<b>" * 120_000 + "</i>" * 120_000, "<b>" * 120_000 + "</x>" * 120_000,
    "<article>" * 100_000, "<p>" * 300_000, "<article>" + "<div class=notice>" * 50_000 + "w " * 60,
    "<li><ul>" * 100_000, "<" * 1_000_000, "&" * 1_000_000])
def test_malformed_page_of_a_megabyte(html):
    started = time.process_time()
    hx.main_text(hx.parse(html + "end"))
    assert time.process_time() - started < 10


def test_names_support_but_do_not_decide_inside_articles():
    def text(inner):
        return hx.main_text(hx.parse(f"<body><article><p>start</p>{inner}</article></body>"))

    assert text('<p class="related-work">We build on x.</p>') == "start\nWe build on x."
    assert text('<section id="search-results">Found y</section>') == "start\nFound y"
    assert text('<section class="notice-period">Three months</section>') == "start\nThree months"
    assert text('<div class="page-header"><h1>Title</h1></div>') == "start\nTitle"
    assert text('<div class="notice">' + "long text " * 40 + "</div>").count("long") == 40
    assert text('<div class="ad-box">Buy now</div><div class="share buttons">a</div><p class="cookie notice">ok</p>') == "start"
    assert text('<div id="comments">' + "some words " * 80 + "</div>") == "start"


def test_template_blocks_go_by_recurrence_alone(spark):
    """Pages without an article element or telling names: only the counts tell."""
    rows = []
    for i in range(12):
        body = "".join(f"<p>{w} text of page {i} number {k}</p>" for k, w in enumerate(("first", "second", "third")))
        rows.append((i, f"http://h.example/{i}", f"<body><div><p>Our shop, open daily</p><a href=/>Start</a></div>{body}"
                                                 "<div>All rights with us</div></body>"))
    rows.append((99, "http://other.example/", "<body><div>All rights with us</div><p>alone</p></body>"))
    got = {r.page_id: r.text for r in hx.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == "\n".join(f"{w} text of page {i} number {k}" for k, w in enumerate(("first", "second", "third")))
    assert got[99] == "All rights with us\nalone"


def test_strays_in_a_large_family(spark, monkeypatch):
    """Near copies in many blocks, and documents that only a few members resemble."""
    import random

    from tests.llm import brute
    monkeypatch.setattr(near_dup, "BLOCK_ELEMENTS", 400)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(60), rng.choice((0, 1, 2, 3, 6, 9))):
            words[k] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, 3, 70, 100).collect()}
    assert got == brute.near_dups(rows, 3, 70, 100)
