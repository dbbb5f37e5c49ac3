"""Toxic passages: maximum-scoring segments over token log-odds.

*Tokens* are lower-cased runs of letters.  Each token has a chain of features:
its prefixes of ``PREFIXES`` letters, then the word itself.  From labelled
documents every feature gets a toxic share with a Dirichlet (two classes:
beta) prior centred on the share of the feature before it in the chain, down
to the share of toxic documents; an unseen word so inherits its stem's score.
A token's score is the log-odds of that share against the base rate, less
``DRIFT``, so that ordinary text scores below zero.

*Segments*: a linear scan finds all maximal segments, the disjoint passages
none of whose extensions scores higher.  The best score of a document without
toxic text follows an extreme-value law in the number of its tokens; its two
parameters are fitted on clean labelled documents, scored without their own
counts.  The excess of each segment over that law is what counts: the best
excess and the sum over all significant segments feed a two-parameter-per-input
logistic curve, fitted on the same bounded sample.

*Size*: features are counted, joined and filtered by their log-odds in Spark.
The driver and the Python workers hold up to ``MAX_FEATURES`` of the model by
name, up to ``MAX_PACKED`` in flat arrays.  Where the model has more, those in
most documents are held and the others stay a stored table that is joined to
the features of the documents, so every feature counts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import hashed_share, ship, small_enough, stored, with_broadcast

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)
#: Weight of the prior, in documents.
PRIOR = 4.0
#: Subtracted from every token's log-odds.
DRIFT = 0.5
#: A feature needs that many toxic documents and that log-odds to raise scores.
MIN_TOXIC = 3
MIN_ODDS = 1.0
#: Bounds of what the driver holds: features by name, features of the model in
#: flat arrays (about 40 bytes each; the others are a stored table), labelled
#: documents that calibrate it (those with the smallest hashes of their text).
MAX_FEATURES = 200_000
MAX_PACKED = 2_000_000
MAX_CALIBRATION = 6_000
#: Most labels that are broadcast (12 bytes each); beyond, texts are shuffled to them.
MAX_BROADCAST = 2_000_000
#: Pairs of document and feature that a worker returns at once.
MAX_PAIRS = 100_000
#: Longest text slice tokenised at once; a token never spans two slices.
SLICE = 1 << 20


def tokens(text: str) -> Iterator[str]:
    text = text or ""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end].isalpha():
            end += 1
        yield from TOKEN.findall(text[at:end].lower())
        at = end


def features(word: str) -> list[str]:
    """Prefixes ending in ``*``, shortest first, then the word."""
    return [word[:k] + "*" for k in PREFIXES if len(word) > k] + [word]


def segments(scores: Iterable[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)``, end exclusive.

    ``scores`` has (position, score) of tokens in order; tokens not listed
    score ``-gap``.  Linear time: each candidate joins earlier ones at most
    once (Ruzzo and Tompa), and each knows the last earlier one whose sum
    before is smaller, so that none is passed twice.
    """
    out: list[list[float]] = []  # start, end, sum before, sum through, last earlier one with a smaller sum before
    total, last = 0.0, 0
    for pos, s in scores:
        total -= gap * (pos - last)
        last = pos + 1
        if s <= 0:
            total += s
            continue
        new = [pos, pos + 1, total, total + s]
        total += s
        j = len(out) - 1
        while j >= 0 and out[j][2] >= new[2]:
            j = out[j][4]
        while j >= 0 and out[j][3] < new[3]:
            new = [out[j][0], new[1], out[j][2], new[3]]
            at, j = j, out[j][4]
            del out[at:]
        out.append([*new, j])
    return [(int(a), int(b), hi - lo) for a, b, lo, hi, _ in out]


class Packed:
    """Counts by feature in flat arrays; ``get`` as of a dict.

    Features are ordered by their CRC; ``starts`` has where each range of CRCs
    begins, and what is found there is compared with the whole name.
    """

    def __init__(self, names: pa.Array, y: np.ndarray, z: np.ndarray, crc: np.ndarray):
        bits = max(len(names), 1).bit_length()
        order = np.argsort(crc, kind="stable")
        names = names.cast(pa.large_binary()).take(pa.array(order))
        ends = np.frombuffer(names.buffers()[1], np.int64)[names.offset:names.offset + len(names) + 1]
        starts = np.searchsorted(crc[order] >> (32 - bits), np.arange((1 << bits) + 1)).astype(np.int32)
        data = names.buffers()[2]
        self.__setstate__((bits, starts, ends.copy(), b"" if data is None else data.to_pybytes(), y[order], z[order]))

    def __getstate__(self) -> tuple:
        return self.arrays

    def __setstate__(self, arrays: tuple) -> None:
        self.arrays = arrays
        bits, starts, ends, self.data, y, z = arrays
        self.shift = 32 - bits
        self.starts, self.ends, self.y, self.z = map(memoryview, (starts, ends, y, z))

    def __len__(self) -> int:
        return len(self.y)

    def get(self, feature: str) -> tuple[int, int] | None:
        name = feature.encode()
        at = zlib.crc32(name) >> self.shift
        for i in range(self.starts[at], self.starts[at + 1]):
            if self.data[self.ends[i]:self.ends[i + 1]] == name:
                return self.y[i], self.z[i]
        return None


@dataclass
class Model:
    base: float = 0.5
    counts: dict[str, tuple[int, int]] | Packed = field(default_factory=dict)
    lam: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)
    #: ``feature, y, z`` of what ``counts`` leaves out; None where it has all.
    tail: DataFrame | None = field(default=None, repr=False)
    _scores: dict[str, float | None] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tail": None, "_scores": {}}

    def odds(self, word: str, less: tuple[int, int] = (0, 0), extra: dict[str, tuple[int, int]] | None = None) -> float | None:
        """Score of a word; None for one that has no feature in the model.
        ``extra``: counts of features from the model's ``tail``."""
        # Both shares are carried: behind a few stems of toxic documents only,
        # the clean one is too small to be told from one less the other.
        toxic, clean, seen = self.base, 1 - self.base, False
        for f in features(word):
            c = self.counts.get(f) or (extra and extra.get(f))
            if c:
                seen = True
                y, z = max(0, c[0] - less[0]), max(0, c[1] - less[1])
                toxic, clean = (y + PRIOR * toxic) / (y + z + PRIOR), (z + PRIOR * clean) / (y + z + PRIOR)
        if not seen:
            return None
        return math.log(toxic / clean) - math.log(self.base / (1 - self.base)) - DRIFT

    def spans(self, text: str, own: int | None = None, extra: dict[str, tuple[int, int]] | None = None,
              ) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens and the maximal segments.  ``own``: the label of a
        document that the counts include; its own part is taken out.
        ``extra``: counts of its features that are in the model's ``tail``."""
        scores = self._scores if own is None and not extra else {}
        if len(scores) > 500_000:
            scores.clear()
        less = (0, 0) if own is None else ((1, 0) if own else (0, 1))
        found, n = [], 0
        for n, w in enumerate(tokens(text), 1):
            try:
                s = scores[w]
            except KeyError:
                s = scores[w] = self.odds(w, less, extra)
            if s is not None:
                found.append((n - 1, s))
        return n, segments(found, DRIFT)

    def excesses(self, n: int, segs: list[tuple[int, int, float]]) -> list[float]:
        """Each segment's score above what ``n`` clean tokens reach by chance."""
        chance = self.log_k + math.log(max(n, 1))
        return [self.lam * s - chance for _, _, s in segs]

    def inputs(self, n: int, segs: list[tuple[int, int, float]]) -> tuple[float, float]:
        x = self.excesses(n, segs)
        best = min(max(x, default=-8.0), 8.0)
        return max(best, -8.0), math.log1p(sum(v for v in x if v > 0))

    def score(self, n: int, segs: list[tuple[int, int, float]]) -> float:
        a, b = self.inputs(n, segs)
        w = self.weights
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, w[0] + w[1] * a + w[2] * b))))


def _count(batches: Iterator[pa.RecordBatch], only: frozenset[str] | None, below: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have a feature, combined for up to about
    ``MAX_FEATURES`` of them: all features, those in ``only``, or those of words
    with a prefix in ``below``."""
    for batch in batches:
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for text, label in zip(batch.column(0), batch.column(1)):
            words = set(tokens(text.as_py()))
            if below is None:
                found = {f for w in words for f in features(w)}
            else:
                found = {f for w in words for f in _under(features(w), below)}
            counts[1 if label.as_py() else 0].update(found if only is None else found & only)
            if sum(map(len, counts)) >= MAX_FEATURES:
                yield _counts(*counts)
                counts = (Counter(), Counter())
        yield _counts(*counts)


def _counts(clean: Counter[str], toxic: Counter[str]) -> pa.RecordBatch:
    names = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([toxic[k] for k in names], pa.int64()),
         pa.array([clean[k] for k in names], pa.int64())], ["feature", "y", "z"])


def _under(chain: list[str], below: frozenset[str]) -> list[str]:
    """The features behind the first one of the chain that is in ``below``."""
    return next((chain[i + 1:] for i, f in enumerate(chain) if f in below), [])


def _counted(train: DataFrame, only: frozenset[str] | None = None, below: frozenset[str] | None = None) -> DataFrame:
    return (train.select("text", "label").mapInArrow(partial(_count, only=only, below=below), "feature string, y long, z long")
            .groupBy("feature").agg(F.sum("y").alias("y"), F.sum("z").alias("z")))


def _names(table: DataFrame) -> frozenset[str] | None:
    """Its features; None when they are more than the driver holds."""
    return frozenset(r.feature for r in table.select("feature").collect()) if small_enough(table, MAX_FEATURES) else None


def _below(train: DataFrame, stems: DataFrame) -> DataFrame:
    """Counts of all features behind a stem of ``stems`` in their chain."""
    names = _names(stems)
    if names is not None:
        return _counted(train, below=names).where(f"y + z >= {MIN_TOXIC}")
    ks = ", ".join(map(str, PREFIXES))
    above = F.expr(f"transform(filter(array({ks}), k -> k < length(rtrim('*', feature))), k -> concat(left(feature, k), '*'))")
    counted = stored(_counted(train).where(f"y + z >= {MIN_TOXIC}"), "tox-all")
    chained = counted.select("feature", F.explode(above).alias("stem")).join(
        stems.select(F.col("feature").alias("stem")), "stem", "left_semi").select("feature").distinct()
    return counted.join(chained, "feature", "left_semi")


def _hold(model: Model, known: DataFrame) -> None:
    """The features in most documents go into ``counts``, the others stay ``tail``."""
    if small_enough(known, MAX_FEATURES):
        model.counts = {r.feature: (r.y, r.z) for r in known.collect()}
        return
    held, n = known, F.col("y") + F.col("z")
    if not small_enough(known, MAX_PACKED):
        total, most = 0, 0
        for r in sorted(known.groupBy(n.alias("n")).agg(F.count("*").alias("rows")).collect(), reverse=True):
            most, total = r.n, total + r.rows
            if total > MAX_PACKED:
                break
        held, model.tail = known.where(n > most), known.where(n <= most)
    rows = held.select("feature", "y", "z", F.crc32("feature").alias("crc")).toArrow()
    names = rows["feature"].cast(pa.large_binary()).combine_chunks()
    model.counts = Packed(names, *(rows[c].to_numpy() for c in ("y", "z", "crc")))


def _pairs(batches: Iterator[pa.RecordBatch], held: dict[str, tuple[int, int]] | Packed) -> Iterator[pa.RecordBatch]:
    """Each document's features that are not ``held``."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(names, pa.string())], ["row", "feature"])

    for b in batches:
        rows, names = [], []
        for row, text in zip(b.column(0).to_pylist(), b.column(1)):
            found = [f for f in {f for w in set(tokens(text.as_py())) for f in features(w)} if held.get(f) is None]
            rows += [row] * len(found)
            names += found
            if len(rows) >= MAX_PAIRS:
                yield batch()
                rows, names = [], []
        yield batch()


def _with_tail(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` and, where the model has a tail, the counts ``extra`` of the
    features of their ``text`` in it."""
    if model.tail is None:
        return rows
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "tox-rows")
    pairs = rows.select("row", "text").mapInArrow(partial(_pairs, held=model.counts), "row long, feature string")
    extra = pairs.join(model.tail, "feature").groupBy("row").agg(F.collect_list(F.struct("feature", "y", "z")).alias("extra"))
    return rows.join(extra, "row", "left").drop("row")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str | None, dict[str, tuple[int, int]] | None]]:
    """Each row's text and ``extra``, one row at a time."""
    extras = batch.column("extra") if "extra" in batch.schema.names else [None] * batch.num_rows
    for text, extra in zip(batch.column("text"), extras):
        found = None if extra is None else extra.as_py()
        yield text.as_py(), found and {e["feature"]: (e["y"], e["z"]) for e in found}


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from ``docs (doc_id, text)`` and ``labels (doc_id, label)``.

    Counts cover all labelled documents given, in three passes: features of
    toxic documents, how many clean ones have those, and the features below
    prefixes that raise scores, which may say otherwise.  A pass is restricted
    to the features (or stems) that matter where these are at most
    ``MAX_FEATURES``, otherwise it counts all and joins.
    Without labels of both classes the model finds every text clean.
    """
    marked = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label"))
    marked = with_broadcast(stored(marked, "tox-labels"), MAX_BROADCAST)
    train = docs.where("text IS NOT NULL").join(marked, "doc_id").select("text", "label")
    n = {r.label: r.n for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Model(base=0.5, weights=(-2.0, 0.0, 0.0))
    base = n[1] / (n[0] + n[1])
    toxic = stored(_counted(train.where("label = 1")).where(f"y >= {MIN_TOXIC}").select("feature", "y"), "tox-features")
    clean = _counted(train.where("label = 0"), only=_names(toxic)).select("feature", "z")
    share = (F.col("y") + PRIOR * base) / (F.col("y") + F.col("z") + PRIOR)
    risky = stored(toxic.join(clean, "feature", "left").select("feature", "y", F.coalesce("z", F.lit(0)).alias("z")).where(
        F.log(share / (1 - share)) - math.log(base / (1 - base)) >= MIN_ODDS), "tox-risky")
    below = _below(train, risky.where("feature LIKE '%*'"))
    known = risky.unionByName(below).groupBy("feature").agg(F.max("y").alias("y"), F.max("z").alias("z"))
    model = Model(base=base)
    _hold(model, stored(known, "tox-model"))
    found = _calibration_rows(train, model, n)
    _chance(model, found.select("label", "n", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("best")).collect())
    inputs = found.mapInArrow(partial(_inputs, model=model), "label int, best double, total double").collect()
    _calibrate(model, sorted((r.label, r.best, r.total) for r in inputs), n)
    return model


def _calibration_rows(train: DataFrame, model: Model, n: dict[int, int]) -> DataFrame:
    """``label, n, scores``: tokens and scores of all segments of the texts with
    the smallest hashes, about half of ``MAX_CALIBRATION`` from each class."""
    order = F.xxhash64("text")
    chosen = [(F.col("label") == k) & hashed_share(order, MAX_CALIBRATION / 2 / n[k]) for k in (0, 1)]
    sample = train.where(chosen[0] | chosen[1])
    sample = sample.withColumn("o", order).dropDuplicates(["o", "label"])  # a text may be repeated many times
    return stored(_with_tail(sample.select("text", "label"), model).mapInArrow(
        partial(_spans, model=model), "label int, n long, scores array<double>"), "tox-calibration")


def _spans(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        labels = b.column("label").to_pylist()
        found = [model.spans(t, own=y, extra=x) for (t, x), y in zip(_texts(b), labels)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array([n for n, _ in found], pa.int64()),
             pa.array([[s for *_, s in segs] for _, segs in found], pa.list_(pa.float64()))],
            ["label", "n", "scores"])


def _inputs(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [model.inputs(n, [(0, 0, s) for s in scores])
                 for n, scores in zip(b.column("n").to_pylist(), b.column("scores").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column("label"), pa.array([x for x, _ in found], pa.float64()), pa.array([x for _, x in found], pa.float64())],
            ["label", "best", "total"])


def _chance(model: Model, rows: list) -> None:
    """Extreme-value law from the clean rows ``(label, n, best)``.

    For best scores S of clean documents of n tokens, P(S >= s) is
    1 - exp(-K n exp(-lambda s)).  lambda comes from the mean excess of the
    best scores over their median (exponential tail), K from the share of
    clean documents that reach it.
    """
    clean = sorted((r.best, r.n) for r in rows if r.label == 0)
    best = np.array([s for s, _ in clean], float)
    size = np.array([max(n, 1) for _, n in clean], float)
    if len(best) and (best > 0).any():
        cut = np.median(best[best > 0])
        over = best[best >= cut]
        model.lam = float(np.clip(1 / max((over - cut).mean(), 1e-3), 0.2, 3.0))
        model.log_k = float(math.log(len(over) / size.sum()) + model.lam * cut)


def _calibrate(model: Model, rows: list[tuple[int, float, float]], n_class: dict[int, int]) -> None:
    """The logistic curve from rows of label and inputs."""
    x = np.array([(1.0, a, b) for _, a, b in rows])
    y = np.array([r[0] for r in rows], float)
    got = {k: max(1.0, float((y == k).sum())) for k in (0, 1)}
    weight = np.where(y == 1, n_class[1] / got[1], n_class[0] / got[0])
    weight /= weight.mean()
    w = np.zeros(3)
    ridge = np.diag([1e-4, 1e-2, 1e-2]) * len(y)
    for _ in range(60):  # Newton steps of a ridge-penalised logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge @ w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.weights = tuple(map(float, w))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        score, passages = [], []
        for t, x in _texts(b):
            n, segs = model.spans(t, extra=x)
            score.append(model.score(n, segs))
            passages.append([{"first_token": a, "end_token": e, "excess": x}
                             for (a, e, _), x in zip(segs, model.excesses(n, segs)) if x > 0])
        kind = pa.list_(pa.struct([("first_token", pa.int64()), ("end_token", pa.int64()), ("excess", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(score, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted, passages`` for every row of ``docs``.

    ``passages`` lists every significant segment: token range and excess over
    chance.  Null and empty texts have no token and score like any text
    without a segment.  Ids are only carried: null and repeated ones are fine.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    out = _with_tail(rows, model).mapInArrow(partial(_score, model=model), f"doc_id {kind}, score double, "
                          "passages array<struct<first_token: long, end_token: long, excess: double>>")
    return out.select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "passages")


def held_out() -> F.Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all ``docs`` by a model learned from the labels that are not
    held out: ``doc_id, held_out, score, predicted, passages``.

    Labels of null ids and null labels are ignored; of repeated labels for one
    id the larger counts.  Without usable labels of both classes all scores
    are equal and below one half.  An empty ``docs`` gives no rows.
    """
    ship(docs.sparkSession)
    seen = labels.select("doc_id", F.col("toxic").alias("label")).where(~held_out())
    model = fit(docs.select("doc_id", F.col("text").cast("string").alias("text")), seen)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "passages")
