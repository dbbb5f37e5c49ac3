"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is contained in a document when at least ``num / den`` of the item's
distinct shingles occur in it.  Items are short and documents may be a hundred
times longer, so their resemblance is tiny and two equal-sized signatures
would miss most pairs.  The search therefore keeps the item's side only:

* items are partitioned by size (powers of two of their shingle count), and
  each partition has one sketch length: the bottom-k MinHash values of an item,
  k = ``SPARE`` + the number of shingles that the largest item of the partition
  may miss;
* a document probes the sketches with all its shingle hashes.  An item of q
  shingles that is contained misses at most m = q - ceil(q * num / den) of
  them, so at least k - m of its k sketch values must be hit.  Nothing that is
  contained can fail this, whatever the lengths;
* what passes is verified on the full shingle sets.

Items go in blocks of bounded size; each block is one pass over the documents
without a shuffle of their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm import text_hash as th
from rideflux.llm.common import ship

#: Sketch values beyond those that a contained item may miss.
SPARE = 3
#: Words of benchmark text that one block holds (and sends to the executors).
BLOCK_WORDS = 2_000_000


class Sketches:
    """Bottom-k sketches of one block of items, sorted for probing."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.sets, self.num, self.den = sets, num, den
        values, owners = [], []
        self.need = np.zeros(len(sets), np.int64)
        for i, s in enumerate(sets):
            q = len(s)
            largest = 1 << max(0, (q - 1).bit_length())  # of its size partition
            k = min(q, SPARE + largest - -(-largest * num // den))
            may_miss = q - -(-q * num // den)
            values.append(np.sort(s)[:k])
            owners.append(np.full(k, i))
            self.need[i] = max(1, k - may_miss)
        v = np.concatenate(values) if values else np.empty(0, np.uint64)
        o = np.concatenate(owners) if owners else np.empty(0, np.int64)
        by = np.argsort(v, kind="stable")
        self.values, self.owners = v[by], o[by]
        self.coarse = np.zeros(1 << 16, bool)
        self.coarse[(self.values >> np.uint64(48)).astype(np.int64)] = True

    def candidates(self, h: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, item) whose sketch is hit often enough; ``h`` by row."""
        at = np.flatnonzero(self.coarse[(h >> np.uint64(48)).astype(np.int64)])
        lo = np.searchsorted(self.values, h[at], "left")
        n = np.searchsorted(self.values, h[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            return
        each = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hits = np.unique(np.stack([np.repeat(row[at], n), self.owners[each], each]), axis=1)
        pair, count = np.unique(hits[:2], axis=1, return_counts=True)
        for r, i, c in zip(*pair.tolist(), count.tolist()):
            if c >= self.need[i]:
                yield r, i


def _probe(batches: Iterator[pa.RecordBatch], ids: list, sketches: Sketches, shingle: int,
           also: tuple[int, ...], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, items, shared = [], [], []
        for h, own in th.group_shingles(b.column(1), shingle, also):
            for r, i in sketches.candidates(h, own):
                lo, hi = np.searchsorted(own, [r, r + 1])
                both = int(np.isin(sketches.sets[i], h[lo:hi]).sum())
                if sketches.den * both >= sketches.num * len(sketches.sets[i]):
                    rows.append(r)
                    items.append(i)
                    shared.append(both)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(rows, pa.int64())),
             pa.array([ids[i] for i in items], schema.field("item_id").type), pa.array(shared, pa.int64()),
             pa.array([len(sketches.sets[i]) for i in items], pa.int64())], schema=schema)


def contained_items(docs: DataFrame, items: DataFrame, shingle: int = 5, num: int = 80, den: int = 100,
                    within: bool = False) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` for every document
    (``doc_id, text``) that contains an item (``item_id, text``).

    Words are runs of bytes other than white space, A-Z lower-cased; sets hold
    the distinct ``shingle``-word shingles, or the whole sequence of a shorter
    text.  Such an item is found only where a document is that sequence, as in
    the SQL of op2; ``within``: also inside longer documents, which then give
    windows of the lengths that occur among short items.
    Items and documents without words take no part.  Null ids are carried like
    any value; a pair repeated by repeated rows is returned once.  Other
    columns are not read; an empty side gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    bench = items.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    words = bench.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = -(-int(words) // BLOCK_WORDS) or 1
    out_schema = StructType([rows.schema["doc_id"], bench.schema["item_id"],
                             StructField("n_shared", LongType()), StructField("n_item", LongType())])
    arrow = to_arrow_schema(out_schema)
    parts = []
    for k in range(blocks):
        block = bench.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()  # one block, bounded
        texts = pa.array([r.text for r in block], pa.string())
        sizes = th.word_counts(texts) if within else np.empty(0, np.int64)
        also = tuple(np.unique(sizes[(sizes > 0) & (sizes < shingle)]).tolist())
        sets = {i: np.unique(h) for i, h in th.doc_shingles(texts, shingle)}
        sketches = Sketches(list(sets.values()), num, den)
        parts.append(rows.mapInArrow(
            partial(_probe, ids=[block[i].item_id for i in sets], sketches=sketches, shingle=shingle, also=also, schema=arrow),
            out_schema))
    found = reduce(DataFrame.unionByName, parts)
    # A text repeated under one id would list its pairs twice.
    found = found.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))
