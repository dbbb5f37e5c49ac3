"""Operators 11 to 13 against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from rideflux.llm import fim, lm, oracle, runs
from rideflux.llm.queries import op11_periodic_runs, op12_lm_scores, op13_fill_in_middle
from tests.conftest import SF_SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _all(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def _crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


# --- periodic runs ---------------------------------------------------------

def _longest_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def _brute_runs(words, least):
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        same = np.r_[False, w[:-q] == w[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = b - a + q
            # A stretch of two periods or more with a smaller period is that period's run.
            if length >= max(least, 2 * q) and not any(
                    s <= a and a + length <= s + m for (s, m), p in out.items()):
                out[a, length] = q
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_grouping_gives_longest_lyndon_words():
    rng = random.Random(3)
    for _ in range(1500):
        s = [rng.randrange(rng.randrange(1, 5)) for _ in range(rng.randrange(0, 45))]
        assert runs.lyndon(s) == _longest_lyndon(s)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(600):
        n, k = rng.randrange(0, 60), rng.randrange(1, 5)
        s = [rng.randrange(k) for _ in range(n)]
        if n > 4 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 2 + 1))
            s = [s[a + (i - a) % p] if i >= a else s[i] for i in range(n)]
        number: dict = {}
        ids = [number.setdefault(x, len(number)) for x in s]
        assert [tuple(r) for r in runs.find_runs(ids, least).tolist()] == _brute_runs(s, least)


def test_runs_of_long_repetitive_texts_take_little_time():
    import time
    a, b = [0], [0, 1]
    while len(b) < 100_000:
        a, b = b, b + a
    for ids in ([0] * 200_000, b, [i % 1000 for i in range(200_000)]):
        started = time.process_time()
        found = runs.find_runs(ids, 12)
        assert len(found) and time.process_time() - started < 20


def test_op11_equals_brute_force(spark):
    got = {r.doc_id: r for r in op11_periodic_runs(spark, SF_SMALL).collect()}
    docs = _all(spark)
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = WORDS.findall(text or "")
        h, n = _crc(doc_id), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
            planted += 1
        found = _brute_runs(words, 12)
        r = got[doc_id]
        assert r.n_runs == len(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_collapsed(words, found).encode()).hexdigest()
    assert planted > 5


def test_op11_edge_rows(spark):
    rep = " ".join("ab" for _ in range(20))
    docs = _docs(spark, [(1, None), (2, ""), (3, " \t\n"), (None, rep), (4, "A a " * 8), (4, "A a " * 8), (5, "x" * 100_000)])
    docs = docs.selectExpr("*", "1 AS runs", "'k' AS n_words", "2 AS _h", "3 AS collapsed")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 20, [(0, 20, 1)], "ab"),
        (4, 16, [(0, 16, 2)], "A a"), (4, 16, [(0, 16, 2)], "A a"), (5, 1, [], "x" * 100_000)], key=str)
    assert runs.digest(runs.periodic_runs(runs.repeat_tail(docs))).count() == 7
    chosen = next(i for i in range(1000) if _crc(i) % 10 == 0)
    assert runs.repeat_tail(_docs(spark, [(chosen, " "), (chosen, ""), (chosen, None), (chosen, "a")])).count() == 4
    assert [r.n_runs for r in runs.digest(runs.periodic_runs(runs.repeat_tail(_docs(spark, [(chosen, " ")])))).collect()] == [0]
    empty = runs.digest(runs.periodic_runs(runs.repeat_tail(_docs(spark, []))))
    assert empty.count() == 0 and len(empty.columns) == 8


# --- language model --------------------------------------------------------

def _tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORDS.findall(lowered), None]


def _grams(tokens, order):
    padded = [0] * (order - 1) + tokens
    return [[tuple(padded[i - k + order:i + order]) for i in range(len(tokens))] for k in range(1, order + 1)]


class _Counts:
    def __init__(self, texts, order):
        self.tables = [Counter() for _ in range(order + 1)]
        self.tables[0][()] = 0
        for t in texts:
            tokens = _tokens(t)
            self.tables[0][()] += len(tokens)
            for k, grams in enumerate(_grams(tokens, order), 1):
                self.tables[k].update(grams)
        self.starts = len(texts)

    def estimates(self, tokens, order):
        """Per token: bucket and estimates of each order."""
        grams = _grams(tokens, order)
        for i in range(len(tokens)):
            bucket, ratios = -1, []
            for k in range(1, order + 1):
                gram = grams[k - 1][i]
                if k == 1:
                    context = self.tables[0][()]
                else:
                    context = self.starts if i == 0 else self.tables[k - 1][grams[k - 2][i - 1]]
                    if context:
                        bucket = (k << 6) + int(math.log2(context))
                ratios.append(self.tables[k][gram] / context if context else 0.0)
            yield bucket, ratios


def _brute_scores(docs, order):
    train = [(d, t) for d, t in docs if d is not None and _crc(d) % 10]
    dev = [t for d, t in train if _crc(d) // 10 % 10 == 0]
    kept = _Counts([t for d, t in train if _crc(d) // 10 % 10], order)
    whole = _Counts([t for _, t in train], order)
    vocabulary = len(whole.tables[1])
    floor = 1 / (vocabulary + 1)
    events = [e for t in dev for e in kept.estimates(_tokens(t), order)]
    weights = {b: [1 / (max(1, b >> 6) + 1)] * (max(1, b >> 6) + 1) for b, _ in events}
    for _ in range(lm.ROUNDS):
        sums = {b: [1.0] * len(w) for b, w in weights.items()}
        for b, ratios in events:
            parts = [w * r for w, r in zip(weights[b], [floor, *ratios])]
            for k, x in enumerate(parts):
                sums[b][k] += x / sum(parts)
        new = {b: [x / sum(s) for x in s] for b, s in sums.items()}
        change = max((abs(x - y) for b in new for x, y in zip(new[b], weights[b])), default=0)
        weights = new
        if change < lm.TOLERANCE:
            break
    n = whole.tables[0][()]
    out = []
    for d, t in docs:
        tokens = _tokens(t)
        known = [whole.tables[1][(x,)] for x in tokens]
        score = 0.0
        for b, ratios in whole.estimates(tokens, order):
            score += math.log10(sum(w * r for w, r in zip(lm.weights_of(b, weights), [floor, *ratios])))
        out.append((d, len(tokens), sum(c > 0 for c in known), n,
                    sum(math.log10((c + 0.1) / (n + 0.1 * (vocabulary + 1))) for c in known), score))
    return out


def _compare(got, want):
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=str)
    want = sorted(want, key=str)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)


def test_op12_equals_brute_force(spark):
    got = op12_lm_scores(spark, SF_SMALL).collect()
    docs = _all(spark)
    _compare(got, _brute_scores(docs, 2))
    assert all(r.held_out == (_crc(r.doc_id) % 10 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_many_blocks_and_shards(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(lm, "SHARD_NGRAMS", 2000)
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choice("the The a cat dog sat on mat big red".split()) for _ in range(rng.randrange(0, 60))))
            for i in range(300)]
    docs += [(7, "the cat"), (7, "the cat"), (None, "the zebra"), (11, None), (12, ""), (13, "x" * 5000)]
    df = _docs(spark, docs).selectExpr("*", "1 AS part", "'b' AS block", "2 AS kind", "3 AS n")
    got = lm.interpolated_scores(df, order=order).collect()
    _compare(got, _brute_scores(docs, order))
    assert [r.held_out for r in got if r.doc_id is None] == [None]


def test_lm_empty_and_untrained(spark):
    assert lm.interpolated_scores(_docs(spark, [])).collect() == []
    held = next(i for i in range(1000) if _crc(i) % 10 == 0)
    (r,) = lm.interpolated_scores(_docs(spark, [(held, "a b")])).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
    assert r.base_score == 0 and r.score < 0


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for kind in (np.uint64, np.int64, np.uint32):
        for n in (1, 2, 1000):
            x = rng.integers(0, np.iinfo(kind).max, n, dtype=kind)
            assert (lm.unpack(lm.pack(x), n, kind) == x).all()


# --- fill in the middle ----------------------------------------------------

def _brute_fim(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = [x for x in re.split(r"(?<=\n)", text) if x]
    if doc_id is None or not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    x = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    if h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_ROWS = [
    (1, "a\nb\nc\n"), (2, "a\nb\nc"), (3, "\n\n\n"), (4, ""), (5, None), (None, "a\nb"), (6, "x<P>\ny"), (7, "no break"),
    (8, "<\n>P>\n<S\n>\n<"), (9, "P>\nS>\nM>\n"), (10, "ä\U0001f600\r\n b\n\x00c"), (11, "l\n" * 50_000), (12, "y" * 300_000),
    (13, "<\n<\n<\n<"), (1, "a\nb\nc\n"), (-5, "q\nr\n\ns"), (14, "a\\n%_'\"\n")]


def test_op13_equals_sql_and_brute_force(spark, tmp_path):
    rows = FIM_ROWS + [(100 + i, "".join(random.Random(i).choice("ab<PSM>\n") for _ in range(40))) for i in range(300)]
    docs = _docs(spark, rows)
    made = fim.fill_in_middle(docs)
    got = [tuple(r) for r in made.collect()]
    want = [(d, *_brute_fim(d, t)) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    docs.write.parquet(f"{tmp_path}/d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet/*.parquet'")
    rel = con.sql(oracle.OP13)
    digest = fim.digest(made)
    assert digest.columns == rel.columns
    assert sorted((tuple(r) for r in digest.collect()), key=str) == sorted(rel.fetchall(), key=str)


def test_op13_on_given_tables(spark):
    got = {r.doc_id: r for r in op13_fill_in_middle(spark, SF_SMALL).collect()}
    for doc_id, text in _all(spark):
        n, form, p, m, out = _brute_fim(doc_id, text)
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op13_parameters_empty_table_and_clashing_columns(spark):
    docs = _docs(spark, FIM_ROWS).selectExpr("*", "1 AS n", "2 AS form", "3 AS output")
    got = [tuple(r) for r in fim.fill_in_middle(docs, seed=3, rate=40, spm=10).collect()]
    assert sorted(got, key=str) == sorted([(d, *_brute_fim(d, t, 3, 40, 10)) for d, t in FIM_ROWS], key=str)
    assert fim.digest(fim.fill_in_middle(_docs(spark, []))).count() == 0


def test_unit_ends_of_a_long_text_take_linear_time():
    import time
    for text in ("a" * 5_000_000, "\n" * 2_000_000, "ab\n" * 1_000_000):
        started = time.process_time()
        ends = fim.unit_ends(text)
        assert ends[-1] == len(text) and time.process_time() - started < 10
