"""Line deduplication by winnowing over line hashes (DataFrame functions only).

A line is compared without surrounding white space; lines without words are
skipped.  A *window* is the shortest sequence of lines, from a line forward or
from a line backward, that has ``min_words`` words or more.  Each window
selects its smallest line hash (the last one on ties) as a fingerprint: two
equal windows select the same one, so every repeated run of ``min_words``
words has a fingerprint at both places.

Fingerprints that occur at one place only are dropped; that settles nearly all
of a corpus.  What is left is matched on whole windows: equal windows are
equal runs of ``min_words`` words, and the forward and backward windows around
a fingerprint extend the match both ways to the ends of the run, because each
line of a repeated run lies in a forward or in a backward window inside it.
The first place (by id, then line) stays; the lines of later ones go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideflux.llm.common import stored

_BLANK = r"[ \\t\\n\\x0B\\f\\r]+"
_BLANKS = " \t\n\x0b\f\r"


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with words: two independent hashes and its words."""
    lines = docs.where("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return (lines.select("doc_id", "th", "pos", F.btrim("line", F.lit(_BLANKS)).alias("t"))
            .where("t <> ''")
            .select("doc_id", "th", "pos", F.xxhash64("t").alias("h"), F.xxhash64(F.lit(1), "t").alias("g"),
                    F.expr(f"size(split(t, '{_BLANK}'))").alias("w"))
            .repartition("doc_id", "th").dropDuplicates(["doc_id", "th", "pos"]))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Every window: its lines ``lo`` to ``hi``, content key and fingerprint."""
    doc = Window.partitionBy("doc_id", "th")
    ends = lines.withColumn("e", F.sum("w").over(doc.orderBy("pos"))).withColumn("s", F.expr("e - w"))
    ends = ends.withColumn("total", F.max("e").over(doc))

    def content(frame):
        return [F.min(F.struct("h", F.expr("-pos"))).over(frame), F.collect_list("h").over(frame),
                F.collect_list("g").over(frame)]

    fwd = doc.orderBy("s").rangeBetween(0, min_words - 1)
    bwd = doc.orderBy("e").rangeBetween(1 - min_words, 0)
    f, b = content(fwd), content(bwd)
    both = ends.select(
        "doc_id", "th", "pos", "s", "e", "total",
        f[0].alias("f_fp"), f[1].alias("f_h"), f[2].alias("f_g"), F.max("pos").over(fwd).alias("f_hi"),
        b[0].alias("b_fp"), b[1].alias("b_h"), b[2].alias("b_g"), F.min("pos").over(bwd).alias("b_lo"))
    # A line that is a window by itself is listed once.
    return both.selectExpr("doc_id", "th", f"""explode(filter(array(
        IF(total - s >= {min_words}, struct(pos AS lo, f_hi AS hi, f_fp.h AS fp, -f_fp.col2 AS at,
            xxhash64(f_h) AS k1, xxhash64(1, f_g) AS k2), NULL),
        IF(e >= {min_words} AND NOT (b_lo = pos AND f_hi = pos), struct(b_lo AS lo, pos AS hi, b_fp.h AS fp,
            -b_fp.col2 AS at, xxhash64(b_h) AS k1, xxhash64(1, b_g) AS k2), NULL)), x -> x IS NOT NULL)) AS x""").select(
        "doc_id", "th", "x.*")


def repeated_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, th, runs``: the line ranges to delete, merged and sorted.

    ``th`` is the hash of the text; rows repeated with one id and text are one
    document.  Places are ordered by id (null first), text hash and line.
    """
    windows = stored(_windows(_lines(docs), min_words), "ld-windows")
    # The aggregates are stored before they are joined back: the join then reads
    # two plain shuffles, and Spark splits a fingerprint or passage that very
    # many documents share over several tasks.
    shared = stored(windows.groupBy("fp").agg(
        F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min("th").alias("t0"), F.max("th").alias("t1"),
        F.min("at").alias("a0"), F.max("at").alias("a1"), F.count("doc_id").alias("ids"), F.count("*").alias("n"))
        .where("d0 <> d1 OR t0 <> t1 OR a0 <> a1 OR (ids > 0 AND ids < n)").select("fp"), "ld-shared")
    matched = stored(windows.join(shared, "fp", "left_semi").select("doc_id", "th", "lo", "hi", "k1", "k2"),
                     "ld-matched")
    place = F.struct("doc_id", "th", "lo")
    firsts = stored(matched.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"),
                    "ld-firsts")
    later = matched.join(firsts, ["k1", "k2"]).where(place > F.col("first")).select("doc_id", "th", "lo", "hi")
    doc = Window.partitionBy("doc_id", "th")
    upto = F.max("hi").over(doc.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    apart = later.withColumn("new", F.when(F.col("lo") > upto + 1, 1).otherwise(0))
    merged = (apart.withColumn("run", F.sum("new").over(doc.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("doc_id", "th", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return merged.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"))


def without_runs(docs: DataFrame, runs: DataFrame, counts: bool = False, keep_emptied: bool = True) -> DataFrame:
    """``docs`` (any columns, with ``doc_id`` and ``text``) less the lines in
    ``runs``; with ``counts`` also ``n_lines`` (of the original text) and
    ``n_removed``.  Rows that lost all their words go unless ``keep_emptied``."""
    names = docs.columns
    th, lo_hi = (_free(names, n) for n in ("th", "runs"))
    rid = _free(names, "run_id")
    runs = runs.select(F.col("doc_id").alias(rid), F.col("th").alias(th + "_r"), F.col("runs").alias(lo_hi))
    keyed = docs.withColumn(th, F.xxhash64(F.col("text").cast("string")))
    joined = keyed.join(runs, keyed["doc_id"].eqNullSafe(runs[rid]) & (keyed[th] == runs[th + "_r"]), "left")
    # The kept lines are the slices between runs; the text is split once.
    kept = f"""element_at(transform(array(split(text, '\\n')), ls -> array_join(flatten(transform(
        arrays_zip(concat(array(-1), {lo_hi}.hi), concat({lo_hi}.lo, array(size(ls)))),
        x -> slice(ls, x.`0` + 2, greatest(0, x.`1` - x.`0` - 1)))), '\\n')), 1)"""
    if not keep_emptied:
        joined = joined.where(F.expr(f"{lo_hi} IS NULL OR {kept} RLIKE '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'"))
    out = [
        *[F.expr(f"IF({lo_hi} IS NULL, text, {kept})").alias("text") if n == "text" else joined[n] for n in names]]
    if counts:
        out += [F.expr("coalesce(size(split(text, '\\n')), 0)").cast("long").alias("n_lines"),
                F.expr(f"coalesce(aggregate({lo_hi}, 0L, (a, x) -> a + x.hi - x.lo + 1), 0L)").alias("n_removed")]
    return joined.select(*out)


def _free(names: list[str], name: str) -> str:
    """``name``, lengthened until no column of ``names`` is called that."""
    taken = {n.lower() for n in names}
    while name in taken or name + "_r" in taken:
        name += "_"
    return name


def dedup_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later repeated runs of ``min_words`` words or more deleted.

    Returns ``doc_id, text, n_lines, n_removed`` (lines of the original text,
    and deleted ones).  Null and empty texts come back as they are with 0
    removed (null: 0 lines, empty: 1); a text all of whose lines are repeated
    becomes empty, its row stays.  Blank lines go only where the lines on both
    sides go.  Rows repeated with one id and text each get that document's
    result; a null id is an id like any other, ordered first.  Other columns
    are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return without_runs(base, repeated_runs(base, min_words), counts=True)
