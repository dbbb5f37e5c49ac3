"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood estimates of
all orders, ``sum_k w[b, k] * c(last k tokens) / c(last k - 1 tokens)`` and a
uniform share ``w[b, 0] / (V + 1)``.  The weights depend on the bucket b of
the longest context that the training texts know: its length and the power of
two of its frequency.  They are learned by expectation-maximisation on the
counts of held-out training texts, whose estimates come from the rest.

Counting at scale: texts are packed into blocks of about ``BLOCK_TOKENS``
tokens, stored once.  A block asks for the counts of its distinct n-grams, one
request per shard of the 64-bit n-gram hash; a shard (about ``SHARD_NGRAMS``
entries whatever the data, as a frequent n-gram is one entry per block) adds
them up and answers every request in its order; answers meet their block
again.  So each distinct n-gram of a block crosses the network once in each
direction, as some bytes of a packed column.  There are at most blocks x
shards requests, and never more than n-grams.  Nothing is pruned: the model is
all n-grams of all training texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm import text_hash as th
from rideflux.llm.common import ship, stored

BLOCK_TOKENS = 1_500_000
SHARD_NGRAMS = 4_000_000
#: Kinds of texts: scored only, counted, counted except while weights are learned.
HELD, KEPT, DEV = 0, 1, 2
#: Hash of the token that ends a text, and of the ones before its first word.
END, START = np.uint64(0x1D8AF066F0C41DB5), np.uint64(0x7C3F9A2B5E6D1807)
#: Expectation-maximisation stops at this change of every weight, or after so many rounds.
TOLERANCE, ROUNDS = 1e-3, 30
#: Added to each token count of the base score, and to the vocabulary's share of it.
ADD = 0.1
_ZSTD = pa.Codec("zstd", 1)


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes; equal high bytes cost next to nothing."""
    return _ZSTD.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T), asbytes=True)


def unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_ZSTD.decompress(data, n * size, asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# --- blocks -----------------------------------------------------------------

_BLOCK = "block long, kind int, n_tokens long, n_docs long, ids array<long>, sizes array<int>, texts binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``part, doc_id, kind, text`` packed by kind into blocks."""
    open_blocks: dict[int, list] = {}
    made = 0

    def row(part: int, kind: int, ids: list, texts: list, n_tokens: int) -> pa.RecordBatch:
        nonlocal made
        made += 1
        whole = b"".join(texts)
        return pa.RecordBatch.from_arrays([
            pa.array([(part << 32) + made], pa.int64()), pa.array([kind], pa.int32()), pa.array([n_tokens], pa.int64()),
            pa.array([len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int32())), pa.array([_ZSTD.compress(whole, asbytes=True)], pa.binary())],
            ["block", "kind", "n_tokens", "n_docs", "ids", "sizes", "texts"])

    part = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0)[0].as_py()
        kinds = batch.column(2).to_pylist()
        tokens = th.word_counts(batch.column(3)) + 1
        for i, (doc_id, text) in enumerate(zip(batch.column(1), batch.column(3))):
            held = open_blocks.setdefault(kinds[i], [[], [], 0])
            held[0].append(doc_id.as_py())
            held[1].append(text.as_buffer().to_pybytes() if text.is_valid else b"")
            held[2] += int(tokens[i])
            if held[2] >= BLOCK_TOKENS:
                yield row(part, kinds[i], *open_blocks.pop(kinds[i]))
    for kind, held in open_blocks.items():
        yield row(part, kind, *held)


def _ngrams(sizes: list[int], texts: bytes, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the 1- to ``order``-grams that end at each token of a block,
    and the tokens per document (its words and the end)."""
    size = np.array(sizes, np.int64)
    whole = np.frombuffer(_ZSTD.decompress(texts, int(size.sum()), asbytes=True), np.uint8)
    ends = np.cumsum(size)
    words, owner = th.word_hashes(whole, ends - size, ends)
    count = np.bincount(owner, minlength=len(size)) + 1
    pad = order - 1
    # Every document becomes: start tokens, words, end.
    total = np.full(int(count.sum()) + pad * len(size), START)
    last = np.cumsum(count + pad) - 1
    total[last] = END
    total[np.arange(len(words)) + owner * (pad + 1) + pad] = words
    token = np.ones(len(total), bool)
    for k in range(pad):
        token[last - count - k] = False
    at = np.flatnonzero(token)
    return [th.combine([total[at - m] for m in range(k - 1, -1, -1)]) for k in range(1, order + 1)], count


# --- counting ---------------------------------------------------------------

_REQUEST = "shard int, block long, kind int, level int, n int, keys binary, counts binary"
_REPLY = "shard int, block long, level int, n int, total binary, kept binary"


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _requests(batches: Iterator[pa.RecordBatch], order: int, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            grams, _ = _ngrams(block["sizes"], block["texts"], order)
            rows: list[tuple] = []
            for level, h in enumerate(grams, 1):
                keys, counts = np.unique(h, return_counts=True)
                cut = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
                for shard in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
                    a, b = cut[shard], cut[shard + 1]
                    rows.append((shard, block["block"], block["kind"], level, b - a,
                                 pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(counts[a:b].astype(np.uint32))))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             ["shard", "block", "kind", "level", "n", "keys", "counts"])


def _counted(asked: pa.Table) -> pa.Table:
    """Answers of one shard: the counts in all training texts and, for blocks
    that weights are learned from, in the kept ones; and, without a block,
    how many different tokens the training texts hold."""
    rows = asked.to_pylist()
    out: list[tuple] = []
    for level in sorted({r["level"] for r in rows}):
        mine = [r for r in rows if r["level"] == level]
        keys = np.concatenate([np.cumsum(unpack(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in mine])
        found, at = np.unique(keys, return_inverse=True)
        total, kept = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        cut = np.cumsum([0] + [r["n"] for r in mine])
        for r, a in zip(mine, cut):
            if r["kind"] != HELD:
                counts = unpack(r["counts"], r["n"], np.uint32)
                total[at[a:a + r["n"]]] += counts
                if r["kind"] == KEPT:
                    kept[at[a:a + r["n"]]] += counts
        for r, a in zip(mine, cut):
            here = at[a:a + r["n"]]
            out.append((r["shard"], r["block"], level, r["n"], pack(total[here]),
                        pack(kept[here]) if r["kind"] == DEV else None))
        if level == 1:
            out.append((rows[0]["shard"], None, level, int((total > 0).sum()), None, None))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                ["shard", "block", "level", "n", "total", "kept"])


def _estimates(block: dict, replies: list[dict], order: int, column: str, n_docs: int,
               n_tokens: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Per token of a block: its training count, the bucket of its context and
    its estimate of each order; and the tokens per document."""
    grams, count = _ngrams(block["sizes"], block["texts"], order)
    first = np.cumsum(count) - count
    tokens = np.zeros(0, np.int64)
    bucket = np.full(len(grams[0]), -1, np.int64)
    context = np.full(len(grams[0]), n_tokens, np.int64)
    ratios = []
    for level, h in enumerate(grams, 1):
        _, at = np.unique(h, return_inverse=True)
        mine = sorted((r for r in replies if r["level"] == level), key=lambda r: r["shard"])
        c = np.concatenate([unpack(r[column], r["n"], np.int64) for r in mine])[at]
        if level == 1:
            tokens = c
        else:
            seen = context > 0
            bucket[seen] = (level << 6) + np.log2(context[seen]).astype(np.int64)
        ratios.append(np.divide(c, context, out=np.zeros(len(c)), where=context > 0))
        # The context of the next order is what this order ends with at the token before.
        context = np.empty_like(c)
        context[1:] = c[:-1]
        context[first] = n_docs
    return tokens, bucket, ratios, count


# --- weights ----------------------------------------------------------------

def _held_out(left: pa.Table, right: pa.Table, order: int, n_docs: int, n_tokens: int) -> pa.Table:
    names = ["bucket", *(f"r{k}" for k in range(1, order + 1)), "n"]
    parts = []
    for block in left.to_pylist():
        _, bucket, ratios, _ = _estimates(block, right.to_pylist(), order, "kept", n_docs, n_tokens)
        by = np.lexsort((*ratios, bucket))
        cols = [bucket[by], *(r[by] for r in ratios)]
        new = np.ones(len(by), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        at = np.flatnonzero(new)
        parts.append(pa.table([*(c[at] for c in cols), np.diff(np.r_[at, len(by)])], names=names))
    return pa.concat_tables(parts) if parts else pa.table({c: pa.array([], pa.float64()) for c in names})


def _known(bucket: int) -> int:
    """The highest order that has an estimate in a bucket."""
    return max(1, bucket >> 6)


def learn_weights(events: DataFrame, order: int, floor: float) -> dict[int, list[float]]:
    """Mixture weights per bucket by expectation-maximisation.

    ``events`` holds ``bucket, r1.., n``: a held-out token's estimates and how
    often they occur.  Each round is one aggregation of that table; a bucket's
    sums, two hundred rows at most, reach the driver.  One occurrence is added
    to every order that the bucket knows, so no weight is ever zero.
    """
    buckets = [r.bucket for r in events.select("bucket").distinct().collect()]
    weights = {b: [1 / (_known(b) + 1)] * (_known(b) + 1) for b in buckets}
    spark = events.sparkSession
    for _ in range(ROUNDS if buckets else 0):
        rows = [(b, [*w, *[0.0] * (order + 1 - len(w))]) for b, w in weights.items()]
        known = F.broadcast(spark.createDataFrame(rows, "bucket long, w array<double>"))
        share = [F.col("w")[0] * F.lit(floor), *(F.col("w")[k] * F.col(f"r{k}") for k in range(1, order + 1))]
        whole = sum(share[1:], share[0])
        sums = events.join(known, "bucket").groupBy("bucket").agg(
            *(F.sum(F.col("n") * s / whole).alias(f"s{k}") for k, s in enumerate(share))).collect()
        change = 0.0
        for r in sums:
            got = [r[f"s{k}"] + 1 for k in range(_known(r.bucket) + 1)]
            new = [x / sum(got) for x in got]
            change = max(change, *(abs(x - y) for x, y in zip(new, weights[r.bucket])))
            weights[r.bucket] = new
        if change < TOLERANCE:
            break
    return weights


def weights_of(bucket: int, weights: dict[int, list[float]]) -> list[float]:
    """Weights of a bucket; one without held-out tokens takes those of the
    nearest bucket of its order, or equal ones."""
    if bucket not in weights:
        near = [b for b in weights if _known(b) == _known(bucket)]
        if not near:
            return [1 / (_known(bucket) + 1)] * (_known(bucket) + 1)
        bucket = min(near, key=lambda b: (abs(b - bucket), b))
    return weights[bucket]


# --- scores -----------------------------------------------------------------

_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scored(left: pa.Table, right: pa.Table, order: int, n_docs: int, n_tokens: int, n_types: int,
            weights: dict[int, list[float]]) -> pa.Table:
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    parts = []
    for block in left.to_pylist():
        tokens, bucket, ratios, count = _estimates(block, right.to_pylist(), order, "total", n_docs, n_tokens)
        which, at = np.unique(bucket, return_inverse=True)
        table = np.zeros((len(which), order + 1))
        for i, b in enumerate(which.tolist()):
            w = weights_of(b, weights)
            table[i, :len(w)] = w
        p = table[at, 0] / (n_types + 1)
        for k, r in enumerate(ratios, 1):
            p += table[at, k] * r
        base = np.log10((tokens + ADD) / (n_tokens + ADD * (n_types + 1)))
        first = np.cumsum(count) - count
        parts.append(pa.table([
            pa.array(block["ids"], pa.int64()), pa.array(count), pa.array(np.add.reduceat((tokens > 0).astype(np.int64), first)),
            pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(np.log10(p), first))], names=names))
    return pa.concat_tables(parts) if parts else pa.table(
        {"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()),
         "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})


def interpolated_scores(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``,
    a row per row of ``docs``.

    Words are runs of bytes other than space, tab, LF, VT, FF and CR, with A-Z
    lower-cased; each text has its words and one end token.  Texts whose
    crc32(id as text) is divisible by 10 are held out, the others are learned
    from; of those, a tenth by the next decimal digit serves to learn the
    weights.  ``n_known`` counts tokens that the training texts hold,
    ``train_tokens`` all of theirs; ``base_score`` is the smoothed unigram
    model's, ``score`` the mixture's log10 probability of the text.

    Null and empty texts have the end token only.  A row without an id is
    scored, ``held_out`` null, and not learned from.  Rows repeated with one id
    each count and get equal results.  Without training texts every token is
    unknown.  Other columns are not read; an empty table gives no rows.  A text
    is never split, so a task holds one block, or one longer text.
    """
    ship(docs.sparkSession)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    kind = (F.when(crc.isNull() | (crc % 10 == 0), F.lit(HELD))
            .when(F.floor(crc / 10) % 10 == 0, F.lit(DEV)).otherwise(F.lit(KEPT)))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .select(F.spark_partition_id().alias("part"), "doc_id", kind.alias("kind"), "text"))
    blocks = stored(rows.mapInArrow(_blocks, _BLOCK), "lm-blocks")
    sizes = {r.kind: (r.docs, r.tokens) for r in blocks.groupBy("kind").agg(
        F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens")).collect()}
    everything = sum(t for _, t in sizes.values())
    kept_docs, kept_tokens = sizes.get(KEPT, (0, 0))
    dev_docs, dev_tokens = sizes.get(DEV, (0, 0))
    n_docs, n_tokens = kept_docs + dev_docs, kept_tokens + dev_tokens

    shards = max(1, math.ceil(order * everything / SHARD_NGRAMS))
    asked = blocks.mapInArrow(partial(_requests, order=order, shards=shards), _REQUEST)
    replies = stored(asked.groupBy("shard").applyInArrow(_counted, _REPLY), "lm-counts")
    n_types = replies.where("block IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    answers = replies.where("block IS NOT NULL").select("block", "shard", "level", "n", "total", "kept")
    slim = blocks.select("block", "kind", "ids", "sizes", "texts")

    def held_out(left: pa.Table, right: pa.Table) -> pa.Table:
        return _held_out(left, right, order, kept_docs, kept_tokens)

    columns = ", ".join(["bucket long", *(f"r{k} double" for k in range(1, order + 1)), "n long"])
    dev = slim.where(f"kind = {DEV}").groupBy("block").cogroup(answers.where("kept IS NOT NULL").groupBy("block"))
    events = stored(dev.applyInArrow(held_out, columns).groupBy("bucket", *(f"r{k}" for k in range(1, order + 1)))
                    .agg(F.sum("n").alias("n")), "lm-events")
    weights = learn_weights(events, order, 1 / (n_types + 1))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, order, n_docs, n_tokens, n_types, weights)

    out = slim.groupBy("block").cogroup(answers.drop("kept").groupBy("block")).applyInArrow(scored, _SCORES)
    return out.select("doc_id", (crc % 10 == 0).alias("held_out"), "n_tokens", "n_known",
                      F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
