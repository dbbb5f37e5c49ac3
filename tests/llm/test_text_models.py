from __future__ import annotations

import math
import os
import pickle
import random
import re
import struct
import time
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rideflux.llm import secret_scan as ss
from rideflux.llm import sentencepiece_tok as st
from rideflux.llm import toxicity as tx
from rideflux.llm.queries import op3_sentencepiece, op4_toxicity, op6_secrets
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- toxicity -------------------------------------------------------------

def test_segments_equal_their_definition():
    rng = random.Random(4)
    for _ in range(400):
        n = rng.randrange(1, 14)
        dense = [rng.choice([-0.5, rng.uniform(-4, 4)]) for _ in range(n)]
        listed = [(i, s) for i, s in enumerate(dense) if s != -0.5]
        got = tx.segments(listed, 0.5)
        want = brute.best_segments(dense)
        assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in want))
        assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in want), default=0))
        assert [s for *_, s in got] == pytest.approx([sum(dense[a:b]) for a, b, _ in got])


def test_segments_take_linear_time():
    for falling in (1.0, 0.5, 0.01):  # sums that fall, with and without an early minimum
        scores = [(0, -50_000.0), (1, 1.0)] + [(2 + i, 0.4 if i % 2 else -0.4 - falling) for i in range(200_000)]
        started = time.process_time()
        assert len(tx.segments(scores, 0.5)) == 100_001
        assert time.process_time() - started < 5


def test_op4_calibration_uses_all_segments(spark):
    model = tx.Model(base=0.5, counts={"bad": (50, 0)})
    train = spark.createDataFrame([(" ".join(["bad"] + ["w"] * 20) + " " + " ".join(["bad " + "w " * 20] * 300), k) for k in (0, 1)],
                                  "text string, label int")
    rows = tx._calibration_rows(train, model, {0: 1, 1: 1}).collect()
    assert sorted((r.label, len(r.scores)) for r in rows) == [(0, 301), (1, 301)]


def test_op4_held_out_accuracy(spark):
    got = op4_toxicity(spark, SF_MID).join(
        spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.toxic is not None]
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.9
    # Most held-out rows are clean, so the toxic ones are asked for by themselves.
    bad, good = ([r for r in held if r.toxic == t] for t in (1, 0))
    wins = sum((b.score > g.score) + 0.5 * (b.score == g.score) for b in bad for g in good)
    assert bad and wins / (len(bad) * len(good)) > 0.95
    assert sum(r.predicted for r in bad) / len(bad) >= 0.6
    assert sum(r.predicted for r in good) == 0


def test_stems_carry_over_to_unseen_words(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        w = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(40)]
        if i % 5 == 0:
            w[rng.randrange(40)] = "zorgu" + "".join(rng.choice("abcdefgh") for _ in range(3))
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    model = tx.fit(_docs(spark, docs), spark.createDataFrame(labels, "doc_id long, label int"))
    new = [(1000, "aaa bbb zorguxyz ccc"), (1001, "aaa bbb ccc ddd"), (1002, None), (1003, "")]
    got = {r.doc_id: r for r in tx.score(_docs(spark, new), model).collect()}
    assert got[1000].predicted == 1 and [(p.first_token, p.end_token) for p in got[1000].passages] == [(2, 3)]
    assert [got[k].predicted for k in (1001, 1002, 1003)] == [0, 0, 0]


def test_toxicity_edge_tables(spark):
    docs = _docs(spark, [(1, None), (None, "a b"), (2, "a " * 300_000), (2, "x")]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, 1)], "doc_id long, toxic int, quality int")
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == 4 and {r.held_out for r in got if r.doc_id is None} == {False}
    assert len({r.score for r in tx.toxicity(docs, labels.limit(0)).collect()}) == 1
    assert tx.toxicity(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("held", [1, 40])
def test_op4_scores_do_not_depend_on_what_the_driver_holds(spark, monkeypatch, held):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic")
    docs = docs.unionByName(_docs(spark, [(None, "x y"), (None, None), (1, "twice")]))

    def rows():
        return sorted(map(repr, tx.toxicity(docs, labels).collect()))

    want = rows()
    assert len(set(r.split("score=")[1] for r in want)) > 1
    monkeypatch.setattr(tx, "MAX_FEATURES", held)
    assert rows() == want


def test_op4_tail_and_packed_features_give_the_same_scores(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic")

    def fitted():
        return tx.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))

    def rows(model):
        return sorted(map(repr, tx.score(docs, model).collect()))

    whole = fitted()
    want, n = rows(whole), len(whole.counts)
    monkeypatch.setattr(tx, "MAX_FEATURES", 1)
    packed = fitted()
    assert isinstance(packed.counts, tx.Packed) and len(packed.counts) == n and packed.tail is None
    assert all(packed.counts.get(f) == c for f, c in whole.counts.items())
    assert rows(packed) == want
    for most in (1, n // 2):
        monkeypatch.setattr(tx, "MAX_PACKED", most)
        model = fitted()
        assert len(model.counts) <= most and len(model.counts) + model.tail.count() == n
        assert rows(model) == want


def test_packed_counts_are_found_by_whole_names():
    rng = random.Random(5)
    names = sorted({"".join(rng.choice("aébç😀z*") for _ in range(rng.randrange(1, 9))) for _ in range(3000)} | {"plumless", "buckeroo"})
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    counts = {f: (i, 10**12 - i) for i, f in enumerate(names)}
    y, z = (np.array([c[k] for c in counts.values()]) for k in (0, 1))
    crc = np.array([zlib.crc32(f.encode()) for f in names])
    packed = pickle.loads(pickle.dumps(tx.Packed(pa.array(names), y, z, crc)))
    assert {f: packed.get(f) for f in names} == counts
    assert all(packed.get(f + "q") is None for f in names) and packed.get("") is None
    assert tx.Packed(pa.array([], pa.string()), *[np.array([], np.int64)] * 3).get("a") is None


def test_op4_words_of_many_toxic_documents_only_have_a_score(spark):
    """The clean share behind five such stems is about 1e-18."""
    chain = tx.features("zorgublat")
    for y in (20_000, 10**9):
        model = tx.Model(base=0.1, counts={f: (y, 0) for f in chain}, weights=(-2.0, 1.0, 1.0))
        toxic, clean = Fraction(1, 10), Fraction(9, 10)
        for _ in chain:
            toxic, clean = (y + 4 * toxic) / (y + 4), 4 * clean / (y + 4)
        want = math.log(toxic) - math.log(clean) - math.log(1 / 9) - tx.DRIFT
        assert model.odds("zorgublat") == pytest.approx(want)
        assert model.odds("zorgublat", (1, 0)) == pytest.approx(want, rel=1e-3)
    got = {r.doc_id: r for r in tx.score(_docs(spark, [(1, "aa zorgublat bb"), (2, "aa bb")]), model).collect()}
    assert [(p.first_token, p.end_token) for p in got[1].passages] == [(1, 2)] and got[1].predicted == 1 and got[2].predicted == 0


# --- sentencepiece --------------------------------------------------------

def _library(data):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=data)


@pytest.fixture(scope="module")
def bpe():
    if not os.path.exists(st.DEFAULT_MODEL):
        pytest.skip("no vocabulary file")
    with open(st.DEFAULT_MODEL, "rb") as f:
        return f.read()


TRICKY = ["", " ", "  a  b ", "a\n\n b\t\x00<s></s><0x0A> 😀 　é", "\nabc", "end.\nStart, x.,y . ,", "日本語 текст ²."]


def test_whole_tokenizer_and_segments_have_parity(bpe):
    lib, codec = _library(bpe), st.Codec(bpe)
    for text in TRICKY:
        want = lib.encode(text)
        assert codec.tok.encode(text, add_special_tokens=False).ids == want
        assert next(codec.encode([text]))[0].tolist() == want
        assert codec.decode(next(codec.encode([text]))[0]) == text == lib.decode(want)
        assert codec.tok.decode(want, skip_special_tokens=True) == text


def test_op3_parity_round_trip_and_decoding(spark, bpe):
    lib = _library(bpe)
    got = op3_sentencepiece(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == len(texts) and all(r.parity and r.round_trip for r in rows)
    assert all(r.ids == lib.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in rows)
    assert {r.doc_id: r.text for r in st.decode(got).collect()} == texts


def test_slices_and_full_cache_change_nothing(bpe, monkeypatch):
    lib = _library(bpe)
    monkeypatch.setattr(st, "SLICE", 40)
    monkeypatch.setattr(st, "CACHE", 5)
    monkeypatch.setattr(st, "LINES", 16)
    codec = st.Codec(bpe)
    text = "The quick  brown fox,\njumps over.  " * 30
    assert [i.tolist() for i, _ in codec.encode_group([text, "", text])] == [lib.encode(text), [], lib.encode(text)]


def test_encode_edge_rows(spark, bpe):
    df = _docs(spark, [(1, None), (2, ""), (None, "a b"), (3, "x " * 200_000), (3, "x")]).withColumn("ids", F.lit(0))
    got = {(r.doc_id, r.n_tokens > 0, r.round_trip) for r in st.encode(df).collect()}
    assert got == {(1, False, True), (2, False, True), (None, True, True), (3, True, True)}
    assert st.encode(df.limit(0)).count() == 0


def _varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _bytes_field(number, data):
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _model(pieces, kind, fallback, extra=b""):
    out = b""
    for text, score, typ in pieces:
        out += _bytes_field(1, _bytes_field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _varint(3 << 3) + _varint(typ))
    spec = _varint(3 << 3) + _varint(kind) + _varint(35 << 3) + _varint(int(fallback))
    return out + _bytes_field(2, spec) + _bytes_field(3, extra)


def test_unigram_scores_and_byte_fallback():
    control = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    bytes_ = [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    plain = [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("ab", -4.0, 1), ("▁ab", -4.5, 1), ("aba", -6.0, 1), ("▁▁", -5.0, 1)]
    identity = _bytes_field(1, b"identity") + _varint(3 << 3) + _varint(1) + _varint(4 << 3) + _varint(0)
    data = _model(control + bytes_ + plain, st.UNIGRAM, True, identity)
    lib, codec = _library(data), st.Codec(data)
    rng = random.Random(0)
    for _ in range(200):
        text = "".join(rng.choice("ab  \né😀") for _ in range(rng.randrange(12)))
        want = lib.encode(text)
        assert next(codec.encode([text]))[0].tolist() == want
        assert codec.decode(next(codec.encode([text]))[0]) == text


def test_extra_spaces_are_normalised():
    control = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    plain = [("▁", -2.0, 1), ("a", -3.0, 1), ("▁a", -3.1, 1), ("aa", -3.2, 1)]
    data = _model(control + plain, st.UNIGRAM, False, _bytes_field(1, b"identity") + _varint(4 << 3) + _varint(1))
    lib, codec = _library(data), st.Codec(data)
    for text in ("a a", "  a   a ", "aaa a", "a?b"):
        assert next(codec.encode([text]))[0].tolist() == lib.encode(text)


@pytest.mark.parametrize("fallback, squeeze", [(False, 0), (False, 1), (True, 1)])
def test_op3_parity_compares_whole_texts_where_segments_do_not_show_it(fallback, squeeze):
    control = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    bytes_ = [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    plain = [("▁", -2.0, 1), ("a", -3.0, 1), ("▁a", -3.1, 1), ("aa", -3.2, 1)]
    spec = _bytes_field(1, b"identity") + _varint(4 << 3) + _varint(squeeze)
    texts = ["a  a", "", " aa a "]
    codec = st.Codec(_model(control + bytes_ + plain, st.UNIGRAM, fallback, spec))
    assert [good for _, good in codec.encode_group(texts)] == [True] * 3
    codec.normalise = lambda text: "▁a" + text.replace(" ", "▁")  # a normaliser that the library does not have
    assert [good for _, good in codec.encode_group(texts)] == [False] * 3
    assert [good for _, good in codec.encode(texts)] == [False] * 3


def test_op3_model_at_hand_is_checked_by_segments(bpe):
    codec = st.Codec(bpe)
    assert codec.verify and not codec.whole


# --- secrets --------------------------------------------------------------

ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def _base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(ss.BASE[k], a, b) for a, k, b in sorted(out)]


@pytest.fixture(scope="module")
def scanner():
    return ss.scanner(ss.RULES)


def test_base_rules_equal_regexes(scanner):
    rng = random.Random(8)
    parts = ["password", "passwd", "secret", "token", "api_key", "apikey", "API_KEY", "ToKeN", ":", "=", " ", '"', "'", "abc", "AKIA",
             "AKIAAKIA", "ABCDEF0123456789", "deadbeefdeadbeefdeadbeef", "0", "f", "é", "😀", "xyz12", "-", "secret=token:", "\n",
             "ſecret", "toKen", "ghp_" + "a" * 36]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(15)))
        data = text.encode()
        got = [s for s in ss.in_code_points(data, scanner.spans(data)) if s[0] in ss.BASE]
        assert got == _base(text), text


def test_further_rules(scanner):
    data = ("ghp_" + "A1" * 18 + " ghp_short -----BEGIN RSA PRIVATE KEY----- postgres://me:s3cr3tpw@host/ xoxb-1234567890-a").encode()
    assert [k for k, *_ in scanner.spans(data)] == ["github", "private_key", "url_password", "slack"]


@pytest.mark.parametrize("pattern", ["a(b|c)*d", "(ab|abcd)(x?)", "x{2,3}y", "[^a-c]+z", "(?i:Ab)+"])
def test_automata_equal_regexes(pattern):
    s = ss.Scanner((ss.Rule("r", pattern),))
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice("abcdxyzAB") for _ in range(rng.randrange(12)))
        got = [(a, b) for _, a, b in s.spans(text.encode())]
        full = re.compile(pattern)
        want, at = [], 0
        while at < len(text):
            ends = [e for e in range(len(text), at, -1) if full.fullmatch(text, at, e)]
            if ends:
                want.append((at, ends[0]))
                at = ends[0]
            else:
                at += 1
        assert got == want, text


def test_automaton_is_minimal():
    # a(b|c) and (ab|ac): same language, same number of states
    sizes = [len(ss.Scanner((ss.Rule("r", p),)).forward[0].accepts) for p in ("a(b|c)", "(ab|ac)")]
    assert sizes[0] == sizes[1] == 4


def test_op6_equals_brute_force(spark):
    import hashlib
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = op6_secrets(spark, SF_MID).collect()
    assert len(rows) == len(texts) and any(r.n_assign for r in rows)
    for r in rows:
        want = _base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == b for k, *_ in want) for b in ss.BASE)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert set(f"{k}:{a}:{b}" for k, a, b in want) <= set(r.spans.split(","))


def test_secret_edge_rows(spark):
    import hashlib
    long = "é" * 100_000 + " token=abcdef123"
    df = _docs(spark, [(1, None), (2, ""), (None, "x"), (3, long), (3, long)]).withColumn("found", F.lit(1))
    got = ss.digest(ss.find_secrets(df)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((str(r.doc_id), r.n_assign, r.spans) for r in got) == [
        ("1", 0, ""), ("2", 0, ""), ("3", 1, "assign:100001:100016"), ("3", 1, "assign:100001:100016"), ("None", 0, "")]
    assert {r.base_sha256 for r in got if not r.n_assign} == {empty}
    assert ss.find_secrets(df.limit(0)).count() == 0
