from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rideflux.llm import ann, chat_quotes, html_extract, warc
from rideflux.llm.queries import (op1_nearest_neighbours, op7_chat_threads, op8_warc, op10_html_extract)
from tests.conftest import SF_MID, SF_SMALL


# --- nearest neighbours ---------------------------------------------------

def _exact(rows, k, every):
    """{query: [(score, id)]} by brute force over (id, vector) rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = (x * x[q]).sum(axis=1)
        score[ids == ids[q]] = -np.inf
        best = np.lexsort((ids, -score))
        out[int(ids[q])] = [(score[i], int(ids[i])) for i in best if score[i] > -np.inf][:k]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_op1_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    want, got = _exact(rows, 20, 20), _found(op1_nearest_neighbours(spark, SF_MID))
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    by_id = dict(rows)
    for q, found in got.items():
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
        for s, i in found:
            assert s == pytest.approx(np.dot(np.float64(by_id[q]), np.float64(by_id[i])), rel=1e-12)


def test_op1_small_lists_still_give_all_ranks(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_SIZE", 8)
    monkeypatch.setattr(ann.Index, "_enough", lambda *a: 1)  # what a mean recall may choose
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 8)))], "vec_id long, embedding array<double>")
    found = ann.nearest(df, 20, 10).groupBy("query_id").count().collect()
    assert len(found) == 40 and {r["count"] for r in found} == {20}


@pytest.mark.parametrize("coarse", [1024, 6])
def test_many_lists_probe_few_and_keep_recall(spark, monkeypatch, coarse):
    monkeypatch.setattr(ann, "COARSE", coarse)  # 6: lists are pairs of a coarse and a fine centroid
    monkeypatch.setattr(ann, "LIST_SIZE", 50)
    seen = []
    fit = ann.Index.fit_probes
    monkeypatch.setattr(ann.Index, "fit_probes", lambda self, *a: (fit(self, *a), seen.append(self)))
    monkeypatch.setattr(ann, "BLOCK", 32)
    monkeypatch.setattr(ann, "CHUNK", 16)
    monkeypatch.setattr(ann, "BLOCK_LISTS", 4)
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((30, 24)) * 3
    x = centres[rng.integers(0, 30, 1500)] + rng.standard_normal((1500, 24))
    x *= rng.uniform(0.5, 2, (1500, 1))  # norms differ: inner product, not angle
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = _exact(rows, 10, 10), _found(ann.nearest(df, 10, 10))
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    index, = seen
    assert (len(index.fine) > 1) == (coarse == 6) and index.lists == 30 and index.probes < 30


def test_scan_abandons_and_finds_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 128)).astype(np.float32)
    q = x[:5] + 0.1 * rng.standard_normal((5, 128)).astype(np.float32)
    scored = []

    def exact(j, rows):
        scored.append(len(rows))
        return -((x[rows] - q[j]) ** 2).sum(axis=1)

    for j, rows, score, _ in ann.scan(ann.columns(x), q, lambda j: np.arange(len(x)), exact, 5):
        truth = np.argsort(((x - q[j]) ** 2).sum(axis=1))[:5]
        assert set(truth) <= set(rows)
    assert max(scored) < 1000
    # A distance known from elsewhere: nothing beyond it is scored, nothing within it lost.
    r = np.sort(((x - q[:, None]) ** 2).sum(axis=2), axis=1)[:, 4]
    for j, rows, score, _ in ann.scan(ann.columns(x), q, lambda j: np.arange(len(x)), exact, 5, r):
        assert len(rows) <= 8 and set(rows) >= set(np.argsort(((x - q[j]) ** 2).sum(axis=1))[:5])


def test_vectors_that_take_no_part_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.5, 0.5]), (4, [0.5, -0.5]),
            (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (140, [1.0]),
            (None, [1.0, 1.0]), (-20, [-1.0, 0.0])]
    rows += [(1000 + i, [0.9, 0.1]) for i in range(1, 20)] + [(1020 + i, [0.9, 0.1]) for i in range(1, 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = _found(ann.nearest(df.withColumn("rank", F.lit(1)), 20, 20))
    usable = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 2 and None not in v
                     and np.isfinite(v).all() and any(v)})
    want = _exact([(i, list(v)) for i, v in usable], 20, 20)
    assert {q: [i for _, i in f] for q, f in got.items()} == {q: [i for _, i in f] for q, f in want.items()}
    assert set(got) == {0, 20, -20}
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0


def test_vectors_of_several_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(4)
    groups = [[(i, rng.standard_normal(3).tolist()) for i in range(0, 90, 3)], [(i, rng.standard_normal(5).tolist()) for i in range(1, 90, 3)],
              [(140, [2.0])]]
    df = spark.createDataFrame([r for g in groups for r in g], "vec_id long, embedding array<double>")
    got = _found(ann.nearest(df, 20, 20))
    want = {q: f for g in groups[:2] for q, f in _exact(g, 20, 20).items()}
    assert {q: [i for _, i in f] for q, f in got.items()} == {q: [i for _, i in f] for q, f in want.items()}


# --- chat -----------------------------------------------------------------

def _chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_quotes_are_linked_and_removed(spark):
    rows = [(1, 0, "user", "Hello there my good friend.\nSecond line of mine here."),
            (1, 1, "assistant", "Alice wrote:\n> Hello there my good friend.\n>> deep quote nobody has seen\nI agree."),
            (1, 2, "user", ">  i AGREE.\nno"), (5, 0, "user", "> Second line of   mine here.\nfrom elsewhere"),
            (5, 1, "assistant", None), (None, 0, "user", "x"), (7, None, "user", "y"), (7, 0, None, "")]
    df = _chat(spark, rows).withColumn("thread_id", F.lit(1)).withColumn("position", F.lit(1))
    got = [tuple(r)[:8] for r in chat_quotes.ordered_messages(df).orderBy("thread_id", "position").collect()]
    assert got == [
        (None, 0, None, 0, "user", "x", None, None),
        (1, 0, 1, 0, "user", "Hello there my good friend.\nSecond line of mine here.", None, None),
        (1, 1, 1, 1, "assistant", "I agree.", 1, 0), (1, 2, 1, 2, "user", "no", 1, 1),
        (1, 3, 5, 0, "user", "from elsewhere", 1, 0), (1, 4, 5, 1, "assistant", None, None, None),
        (7, 0, 7, 0, None, "", None, None), (7, 1, 7, None, "user", "y", None, None)]
    assert chat_quotes.threads(df.limit(0)).count() == 0


def test_nested_levels():
    body, passages = chat_quotes.split_quotes("On Monday B wrote:\n> b1\n> b2\n> > a1\n>\n> b3\n\nmine\n>b4")
    assert body == "mine"
    assert passages == [(1, "b1\nb2"), (2, "a1"), (1, "\nb3"), (1, "b4")]


def test_repeated_sentences_link_to_the_first(spark):
    line = "this sentence is said by very many people"
    rows = [(i, 0, "user", line) for i in range(50)] + [(90, 0, "user", f"> {line}\nyes")]
    links = chat_quotes.reply_links(chat_quotes._messages(_chat(spark, rows))).collect()
    assert [tuple(r) for r in links] == [(90, 0, 0, 0)]


def test_originals_with_larger_ids_are_linked(spark):
    a, b = "this sentence is said by somebody else", "and this one is said by two others"
    rows = [(1, 0, "user", f"> {a}\nyes"), (2, 0, "user", b), (4, 0, "user", f"{b}\n> {a}"), (9, 3, "user", a), (7, 1, "user", f"> {b}"),
            (2, 1, "user", f"> {b}\nmine")]
    links = chat_quotes.reply_links(chat_quotes._messages(_chat(spark, rows))).collect()
    assert {tuple(r) for r in links} == {(1, 0, 9, 3), (4, 0, 9, 3), (7, 1, 2, 0), (2, 1, 2, 0)}
    only = [(2, 0, "user", f"> {b}\n{b}"), (5, 0, "user", b)]
    assert [tuple(r) for r in chat_quotes.reply_links(chat_quotes._messages(_chat(spark, only))).collect()] == [(2, 0, 5, 0)]


def _preorder(rows, links):
    """{thread: [(conv, turn)]}: the reply tree walked message by message."""
    turns = {}
    for c, t, _, _ in rows:
        turns.setdefault(c, set()).add(t)
    links = dict(links)
    thread = {c: c for c in turns}
    while True:
        low = [(max(thread[c], thread[o]), min(thread[c], thread[o])) for (c, _), (o, _) in links.items() if thread[c] != thread[o]]
        if not low:
            break
        thread = {c: low[0][1] if k == low[0][0] else k for c, k in thread.items()}
    before = {(c, t): (c, max((s for s in turns[c] if s < t), default=None)) for c in turns for t in turns[c]}
    parent = {m: links.get(m, before[m] if before[m][1] is not None else None) for m in before}
    opened = {m for m in parent if parent[m] is None}
    for m in sorted(parent):  # a circle starts at its first message that quotes
        seen, at = [], m
        while at is not None and at not in seen:
            seen.append(at)
            at = parent[at]
        if at is not None:
            parent[min(x for x in seen[seen.index(at):] if x in links and links[x] != before[x])] = None
    children = {}
    for m, p in parent.items():
        if p is not None:
            children.setdefault(p, []).append(m)
    out = {}
    # A conversation's opening messages sort before a head of it that lost its original.
    for root in sorted((m for m in parent if parent[m] is None), key=lambda m: (m[0], m not in opened, m[1])):
        stack = [root]
        while stack:
            m = stack.pop()
            out.setdefault(thread[m[0]], []).append(m)
            kids = children.get(m, [])
            # What continues the message first, then the other replies.
            stack += sorted(kids, key=lambda k: (before[k] != m, k), reverse=True)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_threads_are_reply_trees_in_preorder(spark, monkeypatch, seed):
    import random
    monkeypatch.setattr(chat_quotes, "BUCKET", 3)
    rng = random.Random(seed)
    convs = 12
    said = {(c, t): f"unique sentence number {c} point {t} here" for c in range(convs) for t in range(rng.randrange(1, 9))}
    links, rows = {}, []
    for c, t in said:
        text = said[c, t]
        if rng.random() < 0.5:
            of = rng.choice([m for m in said if m[0] // 4 == c // 4])
            if of[0] != c or of[1] < t:
                links[c, t] = of
                text = f"> {said[of]}\n{text}"
        rows.append((c, t, "user", text))
    rows.append((0, 0, "user", dict(((c, t), x) for c, t, _, x in rows)[0, 0]))
    found = chat_quotes.reply_links(chat_quotes._messages(_chat(spark, rows))).collect()
    assert {((r.conv_id, r.turn), (r.reply_conv, r.reply_turn)) for r in found} == set(links.items())
    got, places = {}, {}
    for r in chat_quotes.ordered_messages(_chat(spark, rows)).orderBy("thread_id", "position").collect():
        got.setdefault(r.thread_id, []).append((r.conv_id, r.turn))
        places.setdefault(r.thread_id, []).append(r.position)
    assert all(p == list(range(len(p))) for p in places.values())
    assert {k: list(dict.fromkeys(v)) for k, v in got.items()} == _preorder(rows, links)
    assert sum(map(len, got.values())) == len(rows)


def test_positions_and_segments_of_a_long_thread(spark, monkeypatch):
    monkeypatch.setattr(chat_quotes, "BUCKET", 7)
    monkeypatch.setattr(chat_quotes, "SEGMENT", 10)
    rows = [(3, i, "user", f"m{i}") for i in range(45)] + [(3, 4, "user", "m4")]
    got = [r.text for r in chat_quotes.ordered_messages(_chat(spark, rows)).orderBy("position").collect()]
    assert got == [t for _, _, _, t in sorted(rows)]
    parts = chat_quotes.threads(_chat(spark, rows)).orderBy("segment").collect()
    assert [p.n_messages for p in parts] == [10, 10, 10, 10, 6]


def test_op7_keeps_every_message(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    want = {}
    for r in sorted(table, key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append(f"<|{r.role}|>\n{r.text}")
    got = {r.thread_id: r.text for r in op7_chat_threads(spark, SF_SMALL).collect()}
    assert got == {k: "\n".join(v) for k, v in want.items()}


# --- WARC -----------------------------------------------------------------

def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _captures(pages, least=0):
    best = {}
    for i, _, h in pages:
        d = (h or "").encode()
        if i is not None and len(d) >= least:
            best[d] = max(best.get(d, i), i)
    out = set()
    for i, _, h in pages:
        d = (h or "").encode()
        of = best.get(d)
        first = of is None or of == i
        out.add((i, len(d), _digest(d), "response" if first else "revisit", None if first else of))
    return out


def test_op8_equals_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert {tuple(r) for r in op8_warc(spark, SF_SMALL).collect()} == _captures(pages)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_edge_pages(spark, least):
    pages = [(1, None, None), (2, "u", "a\r\n\r\nb\r\n\r\n"), (3, "u\r\nX: y", "a\r\n\r\nb\r\n\r\n"), (4, "u", ""), (None, "u", "zz"),
             (6, "u", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (7, "é", "é😀"), (8, None, "\r\n\r\n"),
             (8, None, "\r\n\r\n"), (9, "u", "zz"), (10, "u", "x" * 3_000_000 + "\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("type", F.lit(1))
    got = [tuple(r) for r in warc.round_trip(df.withColumn("payload_digest", F.lit("x")), least).collect()]
    assert set(got) == _captures(pages, least) and len(got) == len(set(pages))
    assert warc.round_trip(df.limit(0)).count() == 0


def _warc(headers, block, length=None):
    lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block) if length is None else length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_dir):
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
    one = [_warc({"WARC-Type": "warcinfo", "WARC-Record-ID": "<i>"}, b"software: x\r\n"),
           _warc({"WARC-Type": "response", "WARC-Record-ID": "<r>", "WARC-Concurrent-To": "<q>",
                  "Content-Type": "application/http; msgtype=response"}, http + b"\xff\x00\r\n\r\nbin\r\n"),
           _warc({"WARC-Type": "request", "WARC-Record-ID": "<q>", "Content-Type": "application/http"}, b"GET / HTTP/1.1\r\n\r\n"),
           _warc({"WARC-Type": "metadata", "WARC-Record-ID": "<m1>", "WARC-Concurrent-To": "<r>"}, b"a: 1\r\n"),
           _warc({"WARC-Type": "metadata", "WARC-Record-ID": "<m2>", "WARC-Concurrent-To": "<r>"}, b""),
           _warc({"WARC-Type": "response", "WARC-Record-ID": "<bad>"}, b"abc", length=2),
           _warc({"WARC-Type": "resource", "WARC-Record-ID": "<z>"}, b"end")]
    with open(f"{tmp_dir}/a.warc.gz", "wb") as f:  # one gzip member per record
        f.writelines(gzip.compress(r) for r in one)
    with gzip.open(f"{tmp_dir}/b.warc.gz", "wb") as f:
        f.write(_warc({"WARC-Type": "response", "WARC-Record-ID": "<cut>"}, b"abcdef")[:-6])
    records = warc.read_archives(spark, tmp_dir)
    got = {r.record_id: r for r in records.collect()}
    assert set(got) == {"<i>", "<r>", "<q>", "<m1>", "<m2>", "<z>"}
    assert bytes(got["<r>"].payload) == b"\xff\x00\r\n\r\nbin\r\n" and got["<r>"].http_header == "HTTP/1.1 200 OK\r\nA: b"
    assert got["<r>"].payload_digest == _digest(b"\xff\x00\r\n\r\nbin\r\n")
    capture = warc.assemble(records).collect()
    assert [(c.capture_id, c.request.record_id, c.metadata.record_id, c.n_requests, c.n_metadata) for c in capture] == [
        ("<r>", "<q>", "<m1>", 1, 2)]


# --- HTML -----------------------------------------------------------------

def _article(page):
    m = re.search("<article>(.*?)</article>", page or "", re.S)
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", m[1] if m else ""))
    return "\n".join(b for b in blocks if b)


def test_op10_equals_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    rows = op10_html_extract(spark, SF_MID).collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = _article(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


@pytest.mark.parametrize("page, want", [
    ("", ""), ("just text &amp; more", "just text & more"),
    ("<article><p>a\n b</p>c<div>d<b>e</b></div><p>f<p>g", "a b\nc\nde\nf\ng"),
    ("<body><header>H</header><article><header><h1>T</h1></header><p>x&nbsp;y &lt;z&gt; &#233; &am</p></article><footer>F</footer>",
     "T\nx y <z> é &am"),
    ("<article><p>a</p><aside>s</aside><form><p>f</p></form><script>'</p>'</script><style>p{}</style><!-- c --><p>b</p></article>", "a\nb"),
    ("<article><p>a</p><section class='comments'><article class='comment'><p>no</p></article></section></article>", "a"),
    ("<div class='page has-sidebar'><article><p>a</p></article><div id=sidebar>s</div></div>", "a"),
    ("<body><nav>m</nav><div class='cookieNotice'>c</div><div><p>a</p><ul><li>b<li>c</ul></div><div class=ad>d</div>", "a\nb\nc"),
    ("<main><p>a</main><p>after", "a"), ("<p>x</b></i></div>y</p><p hidden>h</p><p style='display: none'>n</p>", "xy"),
    ("<article><p><b>a<br>b<p>c</article>d", "a b\nc"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
])
def test_extraction_cases(page, want):
    assert html_extract.main_text(html_extract.parse(page)) == want


def test_templates_are_removed_and_copies_count_once(spark):
    box = "<div><p>Follow us</p><p>on all channels</p></div>"
    rows = [(i, "http://a.example/x", f"<body>{box}<div><p>text {i}</p><p>shared by two {i // 2}</p></div>") for i in range(10)]
    rows += [(100 + i, "http://b.example/x", "<body><div><p>a copy</p></div>") for i in range(10)]
    rows += [(200, None, None), (201, "nonsense", ""), (201, "nonsense", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("template", F.lit(0))
    got = {(r.page_id, r.text) for r in html_extract.extract(df.withColumn("host", F.lit("x"))).collect()}
    assert got == ({(i, f"text {i}\nshared by two {i // 2}") for i in range(10)} | {(100 + i, "a copy") for i in range(10)}
                   | {(200, ""), (201, "")})
    assert html_extract.extract(df.limit(0)).count() == 0


def test_op10_template_inside_articles_and_bodies_with_a_teaser(spark):
    def words(i, n):
        return " ".join(f"w{i}x{k}" for k in range(n))

    box = "<div><p>Read also</p><p>our letter</p></div>"
    rows = [(i, "http://a.example/x", f"<article><h2>Facts</h2><p>{words(i, 20)}</p>{box}<p>shared {i // 2}</p></article>") for i in range(10)]
    want = {(i, f"Facts\n{words(i, 20)}\nshared {i // 2}") for i in range(10)}
    # A sentence that half of the articles share stays; so do hosts of near copies and of few articles.
    rows += [(20 + i, "http://b.example/x", f"<article><p>{words(i, 9)}</p>{'<p>by many</p>' * (i % 2)}</article>") for i in range(10)]
    want |= {(20 + i, words(i, 9) + "\nby many" * (i % 2)) for i in range(10)}
    rows += [(40 + i, "http://c.example/x", f"<article><p>{words('', 30)}</p><p>copy {i}</p></article>") for i in range(10)]
    want |= {(40 + i, f"{words('', 30)}\ncopy {i}") for i in range(10)}
    rows += [(60 + i, "http://d.example/x", f"<article><p>{words(i, 20)}</p>{box}</article>") for i in range(3)]
    want |= {(60 + i, f"{words(i, 20)}\nRead also\nour letter") for i in range(3)}
    # The article is a teaser only: the text is in the body.
    rows += [(80 + i, "http://e.example/x", f"<body>{box}<article><p>teaser {i}</p></article><div><p>{words(i, 80)}</p></div>") for i in range(5)]
    want |= {(80 + i, f"teaser {i}\n{words(i, 80)}") for i in range(5)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {(r.page_id, r.text) for r in html_extract.extract(df).collect()} == want


def test_op10_blocks_on_many_pages_of_a_large_host(spark):
    def page(i):
        box = "<div><p>Section</p><p>notice</p></div>" if i % 5 == 0 else ""
        few = "<div><p>by a few</p></div>" if i % 40 == 1 else ""
        return f"<body>{box}<div><p>text {i}</p><ul><li>kind {i % 6}</li><li>no {i}</li></ul></div>{few}</body>"

    rows = [(i, "http://a.example/x", page(i)) for i in range(600)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"text {i}\nkind {i % 6}\nno {i}" + "\nby a few" * (i % 40 == 1) for i in range(600)}
