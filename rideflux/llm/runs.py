"""Periodic runs of words: Lyndon roots from Baier's grouping, extended by LCE.

A run is a stretch of words with smallest period q and at least 2 q words that
no neighbouring word extends.  For one of the two orders of the alphabet
(ascending or descending) every run has a position within its first q + 1
words whose longest Lyndon word is exactly q words long.  So:

1. ``lyndon`` gives the length of the longest Lyndon word at every position by
   the first phase of Baier's suffix sorter, once for each order.
2. Each position with its length is a candidate root; it is extended to both
   sides by longest common extensions (``Extension``), and kept if the whole
   holds two periods.

Each document is one row of work; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import ship

#: Bytes of text that one output batch holds, about.
BATCH_BYTES = 1 << 22
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lyndon(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position.

    Groups hold the positions whose suffixes start with the same word found so
    far (the group's context), in ascending order; groups are linked in the
    order of their contexts.  They are taken from the largest down.  A group's
    members leave the chain of open positions; the nearest open position before
    a member has a smaller context that the member's context follows directly,
    so its own context grows by it, once for each member that points there.
    Positions of one group that grew equally often form a new group right
    behind their old one.  When a group is taken, its context is the longest
    Lyndon word of its members.
    """
    n = len(ranks)
    if not n:
        return []
    first: dict[int, list[int]] = {}
    for i, r in enumerate(ranks):
        first.setdefault(r, []).append(i)
    members = [first[r] for r in sorted(first)]
    top = len(members)
    lower, upper = list(range(-1, top - 1)), list(range(1, top + 1))
    length = [1] * top
    of = [0] * n
    for g, positions in enumerate(members):
        for i in positions:
            of[i] = g
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    g = top - 1
    while g >= 0:
        size = length[g]
        grown: list[int] = []  # open positions that members point to, ascending
        times: list[int] = []
        last = -1
        for i in members[g]:
            if of[i] != g:  # moved on to a later group
                continue
            out[i] = size
            b, a = before[i], after[i]
            if a < n:
                before[a] = b
            if b >= 0:
                after[b] = a
                if b == last:
                    times[-1] += 1
                else:
                    grown.append(b)
                    times.append(1)
                    last = b
        members[g] = []
        split: dict[int, dict[int, list[int]]] = {}
        for j, t in zip(grown, times):
            old = of[j]
            if len(members[old]) == 1:  # the whole group grew: its place stays
                length[old] += t * size
            else:
                split.setdefault(old, {}).setdefault(t, []).append(j)
        for old, parts in split.items():
            for t in sorted(parts, reverse=True):  # each right behind the old one
                new = len(members)
                members.append(parts[t])
                length.append(length[old] + t * size)
                for j in parts[t]:
                    of[j] = new
                above = upper[old]
                lower.append(old)
                upper.append(above)
                lower[above] = upper[old] = new
        g = lower[g]
    return out


class Extension:
    """Longest common extensions of the positions of one sequence.

    ``levels[k]`` numbers the windows of 2**k words by content, equal windows
    alike.  Levels end where no window occurs twice: no extension is longer.
    """

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.levels = [ids.astype(np.int64)]
        while len(last := self.levels[-1]) > (w := 1 << (len(self.levels) - 1)):
            found, number = np.unique(last[:-w] * self.n + last[w:], return_inverse=True)
            if len(found) == len(number):
                break
            self.levels.append(number)

    def longest(self) -> int:
        """No extension of two different positions is longer than this."""
        return (1 << len(self.levels)) - 1

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the equal stretch from ``a`` and from ``b > a`` on."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                at = np.flatnonzero(b + done + (1 << k) <= self.n)
                at = at[level[a[at] + done[at]] == level[b[at] + done[at]]]
                done[at] += 1 << k
        return done

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the equal stretch that ends before ``a`` and before ``b > a``."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                start = a - done - (1 << k)
                at = np.flatnonzero(start >= 0)
                at = at[level[start[at]] == level[start[at] + b[at] - a[at]]]
                done[at] += 1 << k
        return done


def find_runs(ids: list[int], least: int) -> np.ndarray:
    """``(start, length, period)`` rows, by start, then period, of the runs of
    ``least`` words or more in a sequence of numbers from 0 on."""
    n = len(ids)
    half = -(-max(least, 2) // 2)  # a run repeats that many words one period on, at least
    word = np.array(ids, np.int64)
    same = Extension(word) if n >= least else None
    if same is None or same.longest() < half:
        return np.empty((0, 3), np.int64)
    top = max(ids)
    size = np.concatenate([lyndon(ids), lyndon([top - r for r in ids])]).astype(np.int64)
    start = np.tile(np.arange(n), 2)
    # Both extensions together hold ``half`` words, so one of them holds half of those.
    keep = np.zeros(2 * n, bool)
    for sign in (1, -1):
        good = np.ones(2 * n, bool)
        for k in range(-(-half // 2)):
            x = start + k if sign > 0 else start - 1 - k
            inside = (x >= 0) & (x + size < n)
            good &= inside
            good[inside] &= word[x[inside]] == word[x[inside] + size[inside]]
        keep |= good
    start, size = start[keep], size[keep]
    begin = start - same.left(start, start + size)
    end = start + size + same.right(start, start + size)
    good = end - begin >= np.maximum(least, 2 * size)
    found = np.stack([begin[good], (end - begin)[good], size[good]], axis=1)
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _found(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        for a, b in _parts(batch.column(1)):
            n_words, runs, kept = [], [], []
            for cell in batch.column(1)[a:b]:
                words = WORD.findall(cell.as_py() or "")
                number: dict[str, int] = {}
                got = find_runs([number.setdefault(w, len(number)) for w in words], least)
                n_words.append(len(words))
                runs.append([{"start": s, "length": m, "period": q} for s, m, q in got.tolist()])
                if len(got):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, got[:, 0] + got[:, 2], 1)
                    np.add.at(edge, got[:, 0] + got[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive rows of together about ``BATCH_BYTES`` bytes (one at least)."""
    a, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held > BATCH_BYTES:
            yield a, k + 1
            a, held = k + 1, 0
    if a < len(texts):
        yield a, len(texts)


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed``, a row per row of ``docs``.

    Words are runs of characters other than space, tab, LF, VT, FF and CR,
    compared exactly, numbered from 0.  ``runs`` lists ``start, length,
    period`` of every run of ``least`` words or more, by start, then period;
    ``collapsed`` joins by one space the words that no run holds after its
    first ``period`` words.

    Null, empty and wordless texts have no run and an empty ``collapsed``.
    Ids are only carried; rows repeated with one id each get their own result.
    Other columns are not read; an empty table gives no rows.  A text's work is
    n log n in its words, its memory some 300 bytes a word.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_found, least=least),
                           f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, "
                           "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and
    SHA-256 digests of the run list and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def repeat_tail(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col`` of ``docs``, with a periodic tail in a tenth of the texts.

    With h the CRC-32 of the decimal id, g = h / 10, texts whose h ends in 0
    and that have n > 0 words keep a = g % n words; from there on their next
    p = 1 + (n - a) / (3 + g % 8) words repeat up to n words, all joined by
    one space.  Texts of null ids stay.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(id_col, F.col(text_col).cast("string").alias(text_col))
    chosen = rows.withColumn("_h", h).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    parts = (chosen.withColumn("_g", F.floor(F.col("_h") / 10)).withColumn("_n", F.expr("nullif(size(_words), 0)"))
             .withColumn("_a", F.expr("int(_g % _n)"))
             .withColumn("_p", F.expr("int(1 + floor((_n - _a) / (3 + _g % 8)))")))
    tail = F.expr("slice(flatten(array_repeat(slice(_words, _a + 1, _p), int(ceil((_n - _a) / _p)))), 1, _n - _a)")
    made = F.array_join(F.concat(F.expr("slice(_words, 1, _a)"), tail), " ")
    return parts.withColumn(text_col, F.when(F.col("_n") > 0, made).otherwise(F.col(text_col))).select(id_col, text_col)
