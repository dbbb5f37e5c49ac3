"""Nearest neighbours by inner product: adaptive dimension scan over an
inverted-list index.

*Reduction*: with M the largest norm, a vector x gets one more component
sqrt(M^2 - |x|^2) and a query a zero; then the squared distance is
M^2 + |q|^2 - 2 q.x, so the nearest are those of largest inner product.

*Index*: a random rotation spreads each vector's energy evenly over the
dimensions; centroids are fitted by k-means on a bounded sample
(about ``SAMPLE`` vectors, those with the smallest hashes); every vector is indexed.
Beyond ``COARSE`` lists the centroids have two levels: coarse ones, and fine
ones fitted on what the coarse ones leave over; a list is a pair of them, so
that the number of lists grows with the table while the model stays small.
How many lists a query probes is fitted on ``SAMPLE_QUERIES`` vectors of the
sample and their true neighbours, which one pass over all vectors finds: the
smallest number whose recall reaches ``SAMPLE_RECALL``.  A query whose probed lists hold
fewer ids than it needs probes further ones.

*Scan*: within each probed list a query adds squared differences column block
by column block.  After d of D columns, a candidate whose distance so far,
scaled by D / d, exceeds the current k-th distance r by the factor
(1 + EPSILON / sqrt(d))^2 is abandoned: under the random rotation the
hypothesis "its distance is within r" is then rejected.  Survivors are scored
exactly: inner product of the original vectors in double precision.

Equal vectors are one candidate that carries its smallest k + 1 ids (more can
never be among k nearest), so a vector repeated any number of times stays one
row.  Neighbouring lists share a block of bounded size (a list larger than that
is split).  Queries are sent to the blocks: first each to the block of its
nearest list, which gives a first k-th distance, then with that distance to the
other blocks it probes.  A task holds one block and reads its queries as they
come; a block is copied only for every ``CHUNK`` queries, which are as large as it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideflux.llm.common import hashed_share, ship, stored

SAMPLE = 16_384
SAMPLE_QUERIES = 256
SAMPLE_RECALL = 0.97
#: Vectors a list should hold, and the most coarse and fine centroids.
LIST_SIZE = 1_024
COARSE = 1_024
FINE = 1_024
#: Lists of one block, the candidates that a task holds, the queries that share a
#: copy of them, and the queries scanned at once.
BLOCK_LISTS = 8
BLOCK = 8_192
CHUNK = 8_192
STEP = 256
#: Columns added between two tests, and the strictness of the test.
COLUMNS = 16
EPSILON = 2.1
SEED = 7


def _means(x: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of ``count`` clusters of ``x``."""
    c = x[rng.choice(len(x), count, replace=False)]
    for _ in range(12):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.bincount(near, minlength=count)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c


def _gaps(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centre, but for the row's own square."""
    return (c * c).sum(axis=1) - 2 * x @ c.T


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_gaps(x[a:a + 2048], c).argmin(axis=1) for a in range(0, len(x), 2048)])


class Index:
    """Rotation, centroids and probe counts; small enough for every worker.

    List ``i * fine + j`` belongs to coarse centroid i and fine centroid j.
    """

    def __init__(self, sample: np.ndarray, largest_norm: float, n: int, k: int):
        dim = sample.shape[1]
        rng = np.random.default_rng(SEED)
        q, r = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))
        self.rotation = q * np.sign(np.diag(r))
        self.top = largest_norm
        lists, fitted = max(1, round(n / LIST_SIZE)), max(1, len(sample) // 8)
        x = self.place(sample)
        c = _means(x, min(COARSE, lists, fitted), rng)
        # Numbered along their widest direction: neighbours share blocks.
        self.coarse = c[np.argsort(c @ np.linalg.svd(c - c.mean(axis=0))[2][0], kind="stable")]
        fine = min(FINE, -(-lists // len(c)), fitted)
        left = x - self.coarse[_nearest(x, self.coarse)]
        self.fine = _means(left, fine, rng) if fine > 1 else np.zeros((1, dim + 1), np.float32)
        self.cross = 2 * self.coarse @ self.fine.T
        self.lists = len(self.coarse) * len(self.fine)
        self.reach, self.probes = len(self.coarse), self.lists  # coarse centroids and lists that a query looks at
        self.held = np.zeros(self.lists, np.int64)  # ids in each list, once they are counted
        self.need = k + 2  # k + 1 besides the query's own

    def place(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rotated vectors with the extra component, float32."""
        x = x.astype(np.float64)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.top ** 2 - (x * x).sum(axis=1)))
        return (np.c_[x, rest] @ self.rotation).astype(np.float32)

    def assign(self, placed: np.ndarray) -> np.ndarray:
        i = _nearest(placed, self.coarse)
        return i * len(self.fine) + (_nearest(placed - self.coarse[i], self.fine) if len(self.fine) > 1 else 0)

    def ordered(self, placed: np.ndarray, reach: int) -> Iterator[np.ndarray]:
        """For each row the lists of its ``reach`` nearest coarse centroids, nearest first."""
        near, rest = _gaps(placed, self.coarse), _gaps(placed, self.fine)
        j = np.arange(len(self.fine))
        for d, e in zip(near, rest):
            i = np.argsort(d, kind="stable")[:reach]
            lists = (i[:, None] * len(j) + j).ravel()
            yield lists[np.argsort((d[i, None] + e + self.cross[i]).ravel(), kind="stable")]

    def probed(self, placed: np.ndarray) -> list[np.ndarray]:
        """Lists that each query probes: ``probes``, or more until they hold enough ids."""
        out = []
        for row, lists in enumerate(self.ordered(placed, self.reach)):
            lists = lists[:self.probes]
            if self.held[lists].sum() < self.need:
                order = next(self.ordered(placed[row:row + 1], len(self.coarse)))
                enough = int(np.searchsorted(np.cumsum(self.held[order]), self.need)) + 1
                lists = order[:max(enough, self.probes)]
            out.append(lists.astype(np.int32))
        return out

    def fit_probes(self, placed: np.ndarray, found: list[list[int]]) -> None:
        """Set how much a query probes from queries and the lists of their neighbours."""
        if not any(found):
            return
        order = np.argsort(np.argsort(_gaps(placed, self.coarse), axis=1, kind="stable"), axis=1)
        at = np.array([order[q, n // len(self.fine)] for q, lists in enumerate(found) for n in lists])
        two = len(self.fine) > 1
        self.reach = self._enough(at, (1 + SAMPLE_RECALL) / 2 if two else SAMPLE_RECALL, len(self.coarse))
        if two:
            at = []
            for order, lists in zip(self.ordered(placed, self.reach), found):
                position = np.full(self.lists, self.lists, np.int64)
                position[order] = np.arange(len(order))
                at.extend(position[lists])
        self.probes = self._enough(np.array(at), SAMPLE_RECALL, self.reach * len(self.fine))

    @staticmethod
    def _enough(at: np.ndarray, share: float, most: int) -> int:
        """The smallest count that covers a share of the positions ``at``."""
        return min(most, int(np.sort(at)[int(np.ceil(share * len(at))) - 1]) + 1)


def columns(x: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Column blocks ``(from, to, values, squared lengths)`` of placed vectors."""
    dim = x.shape[1]
    cuts = [*range(0, dim, COLUMNS), dim]
    if len(cuts) > 2 and cuts[-1] - cuts[-2] < COLUMNS // 2:
        del cuts[-2]
    parts = [(a, b, np.ascontiguousarray(x[:, a:b])) for a, b in zip(cuts, cuts[1:])]
    return [(a, b, v, (v * v).sum(axis=1)) for a, b, v in parts]


def scan(parts: list, q: np.ndarray, rows_of, exact, k: int,
         within: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """For each query: the candidates that survive, their exact scores, and the
    k-th distance known; the k nearest are among them unless a test rejected one.

    ``parts`` are the ``columns`` of the placed vectors, ``q`` placed queries;
    ``rows_of(j)`` names a query's candidates and ``exact(j, rows)`` scores
    them.  ``within`` holds distances that k candidates seen elsewhere keep to
    (infinite or NaN: none).  Distances come from products; ``slack`` covers their
    rounding, so that it abandons no candidate.
    """
    dim = parts[-1][1]
    square = (q * q).sum(axis=1)
    slack = 1e-5 * (square + max(float(sum(n for *_, n in parts).max(initial=0)), 0))
    a, b, v, n = parts[0]
    first = n + (q[:, a:b] ** 2).sum(axis=1)[:, None] - 2 * q[:, a:b] @ v.T

    def distances(j, rows):
        return sum(((v[rows] - q[j, a:b]) ** 2).sum(axis=1) for a, b, v, _ in parts)

    for j in range(len(q)):
        alive = rows_of(j)
        if not len(alive):
            continue
        part = first[j, alive]
        r, lead = np.inf if within is None else within[j], alive[:0]
        if not np.isfinite(r):
            # The first threshold: full distances of the candidates nearest so far.
            keep = min(k, len(alive))
            lead = alive[np.argpartition(part, min(4 * keep, len(alive)) - 1)[:4 * keep]]
            r = np.partition(distances(j, lead), keep - 1)[keep - 1]
        for i, (a, b, v, n) in enumerate(parts):
            if i:
                part = part + (n[alive] + (q[j, a:b] ** 2).sum() - 2 * (v[alive] @ q[j, a:b]))
            strict = (1 + EPSILON / np.sqrt(b)) ** 2 * b / dim if b < dim else 1 + 1e-4
            ok = part <= r * strict + slack[j]
            alive, part = alive[ok], part[ok]
            if not len(alive):
                break
        alive = np.union1d(alive, lead)
        if len(alive):
            full = distances(j, alive)
            yield j, alive, exact(j, alive), float(np.partition(full, k - 1)[k - 1]) if len(full) >= k else np.inf


def _matrix(col: pa.Array, dtype=np.float32) -> np.ndarray:
    """Rows of equal-length binary values."""
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), -1)


def _vectors(col: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls whose lists have one length."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _binary(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def _place(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        x = _vectors(b.column(2))
        placed = index.place(x)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(index.assign(placed).astype(np.int32)), _binary(placed), _binary(x)],
            ["uid", "ids", "list", "placed", "vector"])


def _truth(batches: Iterator[pa.RecordBatch], asked: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The k + 1 best rows of these batches for each of the few vectors ``asked``."""
    score = np.empty((len(asked), 0))
    of = np.empty((len(asked), 0), np.int32)
    for b in batches:
        if not b.num_rows:
            continue
        more = asked @ _matrix(b.column(1), np.float64).T
        score = np.c_[score, more]
        of = np.c_[of, np.broadcast_to(b.column(0).to_numpy(), more.shape)]
        if score.shape[1] > k + 1:
            best = np.argpartition(-score, k, axis=1)[:, :k + 1]
            score, of = np.take_along_axis(score, best, 1), np.take_along_axis(of, best, 1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.arange(len(asked), dtype=np.int32), score.shape[1])), pa.array(-score.ravel()), pa.array(of.ravel())],
        ["q", "s", "list"])


def _ask(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        x = _vectors(b.column(1))
        placed = index.place(x, query=True)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(index.probed(placed), pa.list_(pa.int32())), _binary(placed), _binary(x)],
            ["quid", "lists", "q_placed", "q_vector"])


_NEAR = pa.list_(pa.struct([("s", pa.float64()), ("uid", pa.int64()), ("ids", pa.list_(pa.int64()))]))
_FOUND = "quid long, near array<struct<s: double, uid: long, ids: array<long>>>, r double"


class _Held:
    """The candidates of one block (and split and chunk), which its queries meet."""

    def __init__(self, key: tuple):
        self.key, self.parts = key, []

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def _close(self) -> None:
        t = pa.Table.from_batches(self.parts).combine_chunks()
        self.uid, self.ids = t.column("id").to_numpy(), t.column("ids").combine_chunks()
        self.columns = columns(_matrix(t.column("placed").combine_chunks()))
        self.v = _matrix(t.column("vector").combine_chunks(), np.float64)
        of = t.column("lists").combine_chunks().flatten().to_numpy()
        order = np.argsort(of, kind="stable")
        names, at = np.unique(of[order], return_index=True)
        self.rows = dict(zip(names.tolist(), np.split(order, at[1:])))
        self.parts = None

    def meet(self, queries: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        """One row per query: its k best candidates of the block, s = -score."""
        if self.parts == []:
            return
        if self.parts:
            self._close()
        none = np.empty(0, np.int64)
        for a in range(0, queries.num_rows, STEP):
            some = queries.slice(a, STEP)
            lists, quid = some.column("lists").to_pylist(), some.column("id").to_pylist()
            q, qv = _matrix(some.column("placed")), _matrix(some.column("vector"), np.float64)
            found = scan(self.columns, q, lambda j: np.concatenate([self.rows.get(n, none) for n in lists[j]]),
                         lambda j, at: (self.v[at] * qv[j]).sum(axis=1), k, some.column("r").to_numpy(zero_copy_only=False))
            quids, nears, rs = [], [], []
            for j, at, score, r in found:
                best = np.lexsort((self.uid[at], -score))[:k]
                ids = self.ids.take(pa.array(at[best])).to_pylist()
                quids.append(quid[j])
                nears.append([{"s": -score[i], "uid": self.uid[at[i]], "ids": m} for i, m in zip(best, ids)])
                rs.append(r)
            yield pa.RecordBatch.from_arrays(
                [pa.array(quids, pa.int64()), pa.array(nears, _NEAR), pa.array(rs, pa.float64())], ["quid", "near", "r"])


def _compare(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by block, split, chunk and side: candidates (side 0)
    precede the queries of their block."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(i).to_numpy() for i in range(4)], axis=1)
        starts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
        for a, z in zip(starts.tolist(), starts[1:].tolist()):
            key, rows = tuple(keys[a, :3].tolist()), b.slice(a, z - a)
            if held is None or held.key != key:
                held = _Held(key)
            if keys[a, 3] == 0:
                held.add(rows)
            else:
                yield from held.meet(rows, k)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part: an id, no null or
    non-finite component, not all zero."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    return v.where("""vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0
        AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))
        AND exists(embedding, x -> x <> 0)""")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible
    by ``every`` its ``k`` nearest other rows found, by inner product.

    An inner product exists between vectors of one length: each length is
    searched within itself, with an index of its own.  Ranks start at 1, ties
    go to the smaller id.  Rows that ``usable`` leaves
    out take no part; rows repeated with one id and vector count once, and a
    query never lists its own id.  With fewer than ``k`` others all are
    listed; an empty table gives no rows.  Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors)
    lengths = sorted(r.n for r in rows.select(F.size("embedding").alias("n")).distinct().collect())
    found = [_nearest_of_one_length(rows.where(F.size("embedding") == n), k, every) for n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _search(placed: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """``quid, near, r``: the best candidates of each query in each block it probes.

    ``probes`` has ``quid, block, lists, q_placed, q_vector, r``.
    """
    # One row per block is broadcast, at most COARSE * FINE / BLOCK_LISTS.
    sizes = F.broadcast(placed.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("splits")))
    chunks = F.broadcast(probes.groupBy("block").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")))
    left = (placed.join(sizes, "block").join(chunks, "block")
            .withColumn("split", F.pmod(F.xxhash64("uid"), F.col("splits")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("block", "split", "chunk", F.lit(0).alias("side"), F.col("uid").alias("id"), "ids",
                    F.array("list").alias("lists"), "placed", "vector", F.lit(None).cast("double").alias("r")))
    right = (probes.join(sizes, "block").join(chunks, "block")
             .withColumn("chunk", F.pmod(F.xxhash64("quid"), F.col("chunks")).cast("int"))
             .withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
             .select("block", "split", "chunk", F.lit(1).alias("side"), F.col("quid").alias("id"),
                     F.lit(None).cast("array<long>").alias("ids"), "lists", F.col("q_placed").alias("placed"),
                     F.col("q_vector").alias("vector"), "r"))
    return (left.union(right).repartition("block", "split", "chunk")
            .sortWithinPartitions("block", "split", "chunk", "side")
            .mapInArrow(partial(_compare, k=k), _FOUND))


def _nearest_of_one_length(rows: DataFrame, k: int, every: int) -> DataFrame:
    same = Window.partitionBy("embedding").orderBy("vec_id")
    classes = stored(
        rows.withColumn("r", F.dense_rank().over(same)).where(F.col("r") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("uid"), "ids", "embedding"), "ann-classes")
    asked = stored(
        rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
        .join(classes.select("embedding", F.col("uid").alias("quid")), "embedding")
        .select(F.col("vec_id").alias("query_id"), "quid"), "ann-asked")

    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    total = classes.agg(F.count("*").alias("n"), F.max(norm).alias("top")).first()
    sample = classes.where(hashed_share(F.xxhash64("uid"), SAMPLE / total.n)).select("embedding").collect()
    sample = np.array([r.embedding for r in sample or classes.limit(1).select("embedding").collect()])
    index = Index(sample, total.top, total.n, k)

    placed = stored(classes.select("uid", "ids", "embedding").mapInArrow(
        partial(_place, index=index), "uid long, ids array<long>, list int, placed binary, vector binary")
        .withColumn("block", F.floor(F.col("list") / BLOCK_LISTS).cast("int")), "ann-placed")
    if index.lists > 1:
        few = sample[:: max(1, len(sample) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
        best = (placed.select("list", "vector").mapInArrow(partial(_truth, asked=few, k=k), "q int, s double, list int")
                .withColumn("p", F.row_number().over(Window.partitionBy("q").orderBy("s", "list"))))
        # The best one is left out: mostly the vector itself.
        truth = best.where(F.col("p").between(2, k + 1)).groupBy("q").agg(F.collect_list("list").alias("lists")).collect()
        by_q = {r.q: r.lists for r in truth}
        index.fit_probes(index.place(few, query=True), [by_q.get(q, []) for q in range(len(few))])
    held = placed.groupBy("list").agg(F.sum(F.size("ids")).alias("n")).toArrow()  # at most COARSE * FINE rows
    index.held[held.column("list").to_numpy()] = held.column("n").to_numpy()

    queries = classes.join(asked.select(F.col("quid").alias("uid")).distinct(), "uid", "left_semi")
    blocks = F.expr(f"array_distinct(transform(lists, x -> int(floor(x / {BLOCK_LISTS}))))")
    probes = stored(
        queries.select("uid", "embedding").mapInArrow(
            partial(_ask, index=index), "quid long, lists array<int>, q_placed binary, q_vector binary")
        .select("*", F.posexplode(blocks).alias("home", "block"))
        .withColumn("lists", F.expr(f"filter(lists, x -> int(floor(x / {BLOCK_LISTS})) = block)")), "ann-probes")
    at_home = stored(_search(placed, probes.where("home = 0").withColumn("r", F.lit(None).cast("double")), k + 1), "ann-home")
    known = at_home.groupBy("quid").agg(F.min("r").alias("r"))
    beyond = stored(_search(placed, probes.where("home > 0").join(known, "quid", "left"), k + 1), "ann-beyond")
    merged = (at_home.union(beyond).groupBy("quid")
              .agg(F.expr(f"slice(array_sort(flatten(collect_list(near))), 1, {k + 1})").alias("c")))
    near = merged.select("quid", F.expr(f"""slice(array_sort(flatten(transform(c,
        x -> transform(x.ids, i -> struct(x.s AS s, i AS vec_id))))), 1, {k + 1})""").alias("near"))
    return (asked.join(near, "quid")
            .select("query_id", F.posexplode(F.expr(f"slice(filter(near, x -> x.vec_id <> query_id), 1, {k})")).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score")))
