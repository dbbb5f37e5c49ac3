"""Near-duplicate documents: SuperMinHash signatures, banding, verification
on full shingle sets, connected components.

Steps, all on Spark:

1. One pass over the texts gives each document its number of distinct
   shingles, a 128-bit digest of the set and a SuperMinHash signature.
2. Documents with equal sets form a class; its smallest id stands for it.
3. Classes that agree on a whole band meet in a bucket.  Each bucket links its
   members to its smallest one (a star, never all pairs); pairs whose
   signatures are far apart are dropped, the rest is verified on full sets.
4. Buckets chained together form a family.  Members of one family that the
   stars left in different components are compared in square blocks of bounded
   size, first by size and signature, then on full sets: no link is lost
   because a bucket's smallest member was not the one that is similar.  Members
   of a family's largest component are not compared with one another, so a
   stray document costs a large family one more pass and no more.
5. Connected components of the verified links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm import text_hash as th
from rideflux.llm.common import ship, stored, with_broadcast
from rideflux.llm.graph import components

SLOTS = 128
#: Members of a family (or of a star) that one task row group holds at a time.
BLOCK = 256
#: ... and the set elements that it holds, about: long documents make smaller blocks.
BLOCK_ELEMENTS = 1 << 20
STAR = 64
#: Most class ids that are broadcast (8 bytes each); beyond, ids are shuffled.
MET_BROADCAST = 1_000_000
#: Largest accepted chance that no band of a pair exactly at the threshold agrees.
MISS = 1e-6
#: Standard deviations below the mean at which a signature match count rules a pair out.
SIGMAS = 6.5


def superminhash(h: np.ndarray, owner: np.ndarray, n: int, m: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, (n, m) uint32, of the elements of n sets.

    Element x visits the slots in its own random permutation; its j-th slot
    gets the value j + r with r uniform in [0, 1), and a slot keeps its
    minimum.  Values at rank j exceed all values at lower ranks, so a set is
    finished at the first rank at which all its slots are filled.  The ranks
    run one after the other over all unfinished sets at once.
    """
    top = np.iinfo(np.uint64).max
    sig = np.full(n * m, top, np.uint64)
    order = None
    for j in range(m):
        seed = np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        z = th.mix64(h ^ seed)
        k = j + ((z >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = k
        else:
            rows = np.arange(len(h))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
            order[:, j] = slot
        value = (np.uint64(j) << np.uint64(56)) | (th.mix64(z + seed) >> np.uint64(8))
        np.minimum.at(sig, owner * m + slot, value)
        open_sets = (sig.reshape(n, m) == top).any(axis=1)
        keep = open_sets[owner]
        if not keep.any():
            break
        if order is None:
            h, owner, k = h[keep], owner[keep], k[keep]
            order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(h), 1))
            order[np.arange(len(h)), k] = 0
            order[:, 0] = k
        elif not keep.all():
            h, owner, order = h[keep], owner[keep], order[keep]
    sig ^= sig >> np.uint64(29)
    return (sig & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(n, m)


def band_rows(share: float, m: int = SLOTS) -> int:
    """Most rows a band may have so that a pair at ``share`` is missed with at
    most ``MISS`` probability."""
    fits = [r for r in range(1, 17) if (1 - share ** r) ** (m // r) <= MISS]
    return max(fits, default=1)


def min_matches(share: float, m: int = SLOTS) -> int:
    return max(1, math.floor(m * share - SIGMAS * math.sqrt(m * share * (1 - share))))


def _sketch(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column(1)
        n = len(col)
        sizes = np.zeros(n, np.int64)
        d1, d2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        sigs: list[bytes | None] = [None] * n
        pending: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if not pending:
                return
            own = np.repeat(np.arange(len(pending)), [len(u) for _, u in pending])
            sig = superminhash(np.concatenate([u for _, u in pending]), own, len(pending))
            for (row, _), s in zip(pending, sig):
                sigs[row] = s.tobytes()
            pending.clear()

        held = 0
        for row, h in th.doc_shingles(col, shingle):
            u = np.unique(h)
            sizes[row] = len(u)
            d1[row], d2[row] = np.frombuffer(hashlib.blake2b(u.tobytes(), digest_size=16).digest(), np.int64)
            pending.append((row, u))
            held += len(u)
            if held > 150_000:
                flush()
                held = 0
        flush()
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes), pa.array(d1), pa.array(d2), pa.array(sigs, pa.binary())],
            ["doc_id", "n_shingles", "d1", "d2", "sig"])


def _bands(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        sig = _signatures(b.column(1))
        n = len(sig)
        keys = []
        for band in range(SLOTS // rows):
            acc = np.full(n, np.uint64(band + 1), np.uint64)
            for c in range(band * rows, (band + 1) * rows):
                acc = th.mix64(acc * np.uint64(0x9FB21C651E98DF25) + sig[:, c])
            keys.append(acc.view(np.int64))
        ids = b.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), pa.array(np.tile(ids, len(keys)))], ["key", "rep"])


def _signatures(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), SLOTS)


def _alike(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            ok = (_signatures(b.column(2)) == _signatures(b.column(3))).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))], ["a", "b"])


def _set_bytes(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets: list[bytes] = [b""] * b.num_rows
        for row, h in th.doc_shingles(b.column(1), shingle):
            sets[row] = np.unique(h).tobytes()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["rep", "elements"])


def _across(key, t: pa.Table, least: int, num: int, den: int) -> pa.Table:
    """Links of one block pair of a family between its components.

    A pair is compared on full sets unless its signatures rule it out or links
    found in this block pair already join the two components.
    """
    own = t.column("chunk").to_numpy()
    sig = _signatures(t.column("sig").combine_chunks())
    ids, comp = t.column("rep").to_numpy(), t.column("comp").to_numpy().copy()
    sets = [np.frombuffer(x, np.uint64) for x in t.column("elements").to_pylist()]
    size = np.array([len(x) for x in sets])
    _, i, j = (k.as_py() for k in key)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    a, b = [], []
    for x in left:
        y = right[(comp[right] != comp[x]) & ((ids[right] > ids[x]) | (i != j))]
        y = y[den * np.minimum(size[y], size[x]) >= num * np.maximum(size[y], size[x])]
        y = y[(sig[y] == sig[x]).sum(axis=1) >= least]
        if not len(y):
            continue
        found = np.isin(np.concatenate([sets[k] for k in y]), sets[x])
        both = np.add.reduceat(found, np.r_[0, np.cumsum(size[y])[:-1]], dtype=np.int64)
        for k in y[den * both >= num * (size[x] + size[y] - both)]:
            if comp[k] != comp[x]:
                a.append(ids[x])
                b.append(ids[k])
                comp[comp == comp[k]] = comp[x]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verified(batches: Iterator[pa.RecordBatch], shingle: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted so that a pivot's text precedes its members'."""
    pivot, pivot_set = None, None
    for b in batches:
        sets = dict(th.doc_shingles(b.column(4), shingle))
        keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        is_member, ids = b.column(2).to_pylist(), b.column(3).to_pylist()
        out_a, out_b = [], []
        for row, key in enumerate(keys):
            mine = np.unique(sets.get(row, np.empty(0, np.uint64)))
            if not is_member[row]:
                pivot, pivot_set = key, mine
            elif key == pivot and len(mine) and len(pivot_set):
                both = len(np.intersect1d(mine, pivot_set, assume_unique=True))
                if den * both >= num * (len(mine) + len(pivot_set) - both):
                    out_a.append(key[0])
                    out_b.append(ids[row])
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def verify(pairs: DataFrame, texts: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets satisfy
    ``den * |A & B| >= num * |A | B|``.

    ``texts`` has ``doc_id, text``.  Each pivot ``a`` is shipped once for
    every ``STAR`` of its members, so a large star spreads over many tasks.
    """
    chunks = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("n")), "nd-chunks")
    dealt = pairs.join(chunks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).alias("chunk"), "b")
    members = dealt.join(texts, dealt.b == texts.doc_id).select(
        "a", "chunk", F.lit(True).alias("member"), F.col("b").alias("id"), "text")
    heads = dealt.select("a", "chunk").distinct()
    pivots = heads.join(texts, heads.a == texts.doc_id).select(
        "a", "chunk", F.lit(False).alias("member"), F.col("a").alias("id"), "text")
    rows = members.unionByName(pivots).repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member")
    return rows.mapInArrow(partial(_verified, shingle=shingle, num=num, den=den), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs of bytes other than space, tab, LF, VT, FF and CR, with A-Z
    lower-cased; a document's set holds its distinct ``shingle``-word
    shingles, or its whole word sequence if that is shorter.  Documents are
    linked when ``den * |A & B| >= num * |A | B|``.  ``component_id`` is the
    smallest id reachable over links, ``kept`` marks the row that has it.

    Null and wordless texts have ``n_shingles`` 0 and are linked with nothing.
    A null id takes no part: component null, kept.  Rows repeated with one id
    are one document and all get its result.  Other columns are not read; an
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    share = num / den
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = stored(base.mapInArrow(
        partial(_sketch, shingle=shingle),
        "doc_id long, n_shingles long, d1 long, d2 long, sig binary"), "nd-sets")
    linked = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(linked.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "nd-classes")
    reps = stored(
        linked.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
        .select(F.col("doc_id").alias("rep"), "n_shingles", "sig"), "nd-reps")

    # Tables are stored before their aggregates are joined back to them: the join
    # then reads plain shuffles, and Spark splits a bucket that very many share.
    bands = stored(reps.select("rep", "sig").mapInArrow(
        partial(_bands, rows=band_rows(share)), "key long, rep long"), "nd-bands")
    heads = stored(bands.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1")
                   .select("key", "a"), "nd-heads")
    stars = stored(bands.join(heads, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct(),
                   "nd-stars")
    # Only classes that meet another one are looked at further; up to
    # MET_BROADCAST of them are found by a scan without a shuffle of the texts.
    met = stored(stars.select(F.col("b").alias("rep")).union(stars.select("a")).distinct(), "nd-met")
    met = with_broadcast(met, MET_BROADCAST)
    known = stored(reps.join(met, "rep", "left_semi"), "nd-known")
    texts = stored(base.join(met.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi"), "nd-texts")
    sig_a = known.select(F.col("rep").alias("a"), F.col("sig").alias("sa"))
    sig_b = known.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    least = min_matches(share)
    close = stars.join(sig_b, "b").join(sig_a, "a").select("a", "b", "sa", "sb").mapInArrow(
        partial(_alike, least=least), "a long, b long")
    links = stored(verify(stored(close, "nd-close"), texts, shingle, num, den), "nd-links")
    first = components(links)

    # A member has an edge to its smallest head, its other heads one to that head.
    nearest = stored(stars.groupBy("b").agg(F.min("a").alias("m")), "nd-nearest")
    beside = stars.join(nearest, "b").where("a <> m").select("a", F.col("m").alias("b")).distinct()
    family = components(nearest.toDF("a", "b").union(beside)).withColumnRenamed("comp", "family")
    placed = stored(family.join(first, "node", "left").select(
        "family", F.col("node").alias("rep"), F.coalesce("comp", "node").alias("comp")), "nd-placed")
    weights = (placed.join(known.select("rep", "n_shingles"), "rep").groupBy("family", "comp")
               .agg(F.sum(F.col("n_shingles") + BLOCK_ELEMENTS // BLOCK).alias("w")))
    # Chunks 0 to major - 1 hold the largest component, the next ones the others.
    open_families = stored(
        weights.groupBy("family").agg(F.max(F.struct("w", "comp")).alias("top"), F.sum("w").alias("w"), F.count("*").alias("n"))
        .where("n > 1").select("family", F.col("top.comp").alias("largest"),
                               F.ceil(F.col("top.w") / BLOCK_ELEMENTS).cast("int").alias("major"),
                               F.ceil((F.col("w") - F.col("top.w")) / BLOCK_ELEMENTS).cast("int").alias("minor")),
        "nd-families")
    open_members = stored(placed.join(open_families, "family"), "nd-open")
    elements = (texts.join(open_members.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
                .select("doc_id", "text").mapInArrow(partial(_set_bytes, shingle=shingle), "rep long, elements binary"))
    of = F.xxhash64("rep")
    chunk = F.when(F.col("comp") == F.col("largest"), F.pmod(of, "major")).otherwise(F.col("major") + F.pmod(of, "minor"))
    split = (open_members.withColumn("chunk", chunk.cast("int"))
             .join(known.select("rep", "sig"), "rep").join(elements, "rep")
             .withColumn("other", F.explode(F.expr("sequence(IF(chunk < major, major, 0), major + minor - 1)")))
             .select("family", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                     "chunk", "rep", "comp", "sig", "elements"))

    def across(key, t):
        return _across(key, t, least, num, den)

    more = stored(split.groupBy("family", "i", "j").applyInArrow(across, "a long, b long"), "nd-more")
    # Links between components found so far, then one more pass over those.
    named = first.select(F.col("node"), F.col("comp"))
    ends = (more.join(named.toDF("a", "ca"), "a", "left").join(named.toDF("b", "cb"), "b", "left")
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct())
    second = components(ends).toDF("comp", "top")
    whole = (placed.join(second, "comp", "left")
             .select("rep", F.coalesce("top", "comp").alias("comp")))

    by_class = classes.join(whole, "rep", "left").select(
        "d1", "d2", F.coalesce("comp", "rep").alias("component"))
    out = sets.select("doc_id", "n_shingles", "d1", "d2").join(by_class, ["d1", "d2"], "left")
    comp = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    comp = F.when(F.col("doc_id").isNotNull(), comp)
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))
