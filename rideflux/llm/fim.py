"""Fill-in-the-middle transformation of whole texts at line boundaries.

A text is a repetition of units (a line with its line feed, or a last line
without one).  One ``fullmatch`` of ``(unit)*`` with the ``regex`` library
keeps every repetition of the group, so ``match.ends(1)`` holds the end of
each unit: its length is the number of units, and two of its entries are the
offsets of both cuts.  Which units are cut, and how the parts are arranged,
follows from a SHA-256 digest of the seed and the document's id, so that any
task gives the same result for a row, in any run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Possessive, so that no way back is kept: a unit can be matched in one way only.
_UNITS = regex.compile(r"([^\n]*+\n|[^\n]++)*+")
#: Characters of text that one output batch holds, about.
BATCH_CHARS = 1 << 22


def unit_ends(text: str) -> list[int]:
    """End offset of every unit of ``text``, in order."""
    return _UNITS.fullmatch(text).ends(1)


def transform(text: str, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix length, middle length, output)`` of one text."""
    ends = unit_ends(text)
    n = len(ends)
    if doc_id is None or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))
    if h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    ends.insert(0, 0)
    a, b = ends[low], ends[high]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


def _transformed(batches: Iterator[pa.RecordBatch], seed: int, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            key, value = doc_id.as_py(), text.as_py() or ""
            rows.append((key, *transform(value, key, seed, rate, spm)))
            held += len(value)
            if held > BATCH_CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, a row per row of ``docs``.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of those with the
    suffix first.  ``n`` counts units; ``form`` is ``plain`` (the text itself,
    both lengths null), ``psm`` or ``spm``; lengths are in code points.

    A null text is an empty one, an empty text and one that holds a marker are
    plain.  A null id has no digest: plain.  Rows repeated with one id and text
    get equal results.  Other columns are not read; an empty table gives no
    rows.  A very long text is matched whole; work and memory grow with it.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_transformed, seed=seed, rate=rate, spm=spm),
                           "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.

    A transformed text holds no marker of its own, and no marker can begin
    inside another, so the first occurrence of each marker is the real one.
    """
    size = F.lit(len(PREFIX))

    def after(marker: str) -> Column:
        return F.locate(marker, output) + size

    def between(start: Column, marker: str) -> Column:
        return F.substring(output, start, F.locate(marker, output) - start)

    middle = F.substring(output, after(MIDDLE), F.length(output))
    first = F.lit(1) + size
    psm = F.concat(between(first, SUFFIX), middle, between(after(SUFFIX), MIDDLE))
    spm = F.concat(between(after(PREFIX), MIDDLE), middle, between(first, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(made: DataFrame) -> DataFrame:
    """The columns of ``fill_in_middle`` with SHA-256 digests of the output and
    of the text rebuilt from it instead of the output."""
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
