"""Chat formatting by quotation linking.

Quoted lines start with one ``>`` per quote level.  Each message is parsed
into its own text and its quoted passages, one for every run of lines of one
level.  Normalised passages, their paragraphs and their lines are hashed and
joined to the messages that first said them:

* in the same conversation, the first earlier message with that unit;
* otherwise, for units of ``MIN_WORDS`` words or more, the first such message
  of the other conversation with the smallest id (ids are no clock: it may be
  larger than that of the reply).

A message replies to the original that its quotes share most characters with.
Conversations linked that way form a thread.  Its messages form a reply tree:
one with a known original stands below that, any other below the message
before it in its conversation.  Threads list the tree in preorder: a message,
then what continues it, then the later replies to it by conversation and turn,
each with all that hangs from it.  So originals precede their replies and
branches are not interleaved; of messages that quote each other in a circle
the first by conversation and turn starts the thread as if it quoted nothing.
Texts come without quotes and attribution lines.  Threads are emitted in
segments of ``SEGMENT`` messages, so no thread is held whole.

Messages that continue one another form a run, and only runs are ordered: an
Euler tour of the tree of runs is ranked by pointer jumping, in as many rounds
as the logarithm of its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideflux.llm.common import ship, stored
from rideflux.llm.graph import components

MIN_WORDS = 5
SEGMENT = 256
#: Turns, and conversation ids, ordered together.
BUCKET = 1_000
MARKS = re.compile(r"^[ \t]*(?:>[ \t]*)+")
ATTRIBUTION = re.compile(r"^.{0,200}\b(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.I)


def split_quotes(text: str) -> tuple[str, list[tuple[int, str]]]:
    """Own text, and the quoted passages as (level, text) in order."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in text.split("\n"):
        m = MARKS.match(line)
        level = m[0].count(">") if m else 0
        if level:
            if last == 0:
                while own and not own[-1].strip():
                    own.pop()
                if own and ATTRIBUTION.match(own[-1]):
                    own.pop()
            if last != level:
                passages.append((level, []))
            passages[-1][1].append(line[m.end():])
        else:
            own.append(line)
        last = level
    body = "\n".join(own).strip("\n") if passages else text
    return body, [(n, "\n".join(p)) for n, p in passages]


def units(text: str) -> dict[int, int]:
    """Hash -> length of the normalised text, its paragraphs and its lines.

    Normalised: lower-case, white space as one space, no marks of an ellipsis.
    """
    out: dict[int, int] = {}
    parts = {text, *re.split(r"\n\s*\n", text), *text.split("\n")}
    for part in parts:
        t = " ".join(part.lower().replace("…", " ").replace("...", " ").split())
        if t:
            h = xxhash.xxh64_intdigest(t.encode("utf-8", "replace"), seed=5)
            out[h - (1 << 64) if h >= 1 << 63 else h] = len(t) if len(t.split()) >= MIN_WORDS else -len(t)
    return out


_UNIT = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bodies, said, quoted, count = [], [], [], []
        for text in b.column(3).to_pylist():
            body, passages = split_quotes(text or "")
            bodies.append(body if text is not None else None)
            said.append([{"h": h, "n": n} for h, n in units(body).items()])
            marks = {}
            for _, p in passages:
                marks |= units(p)
            quoted.append([{"h": h, "n": n} for h, n in marks.items()])
            count.append(len(passages))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(bodies, pa.string()), pa.array(said, _UNIT),
             pa.array(quoted, _UNIT), pa.array(count, pa.int64())],
            ["conv_id", "turn", "role", "text", "said", "quoted", "n_quotes"])


def _messages(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    unit = "array<struct<h: long, n: long>>"
    return rows.mapInArrow(_parse, f"conv_id long, turn long, role string, text string, said {unit}, quoted {unit}, n_quotes long")


def reply_links(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, reply_conv, reply_turn``: one original for each
    message (id and turn not null) with a quote whose origin is found."""
    asked = (messages.where("n_quotes > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL")
             .select("conv_id", "turn", F.explode("quoted").alias("u")).select("conv_id", "turn", "u.h", "u.n").distinct())
    wanted = asked.select("h").distinct()
    said = (messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
            .select("conv_id", "turn", F.explode("said").alias("u")).select("conv_id", "turn", "u.h")
            .join(wanted, "h", "left_semi"))
    # First places only, combined before the shuffle: a line said anywhere any number of times is one row.
    here = stored(said.groupBy("h", "conv_id").agg(F.min("turn").alias("first_turn")), "chat-here")
    least = F.min(F.struct("conv_id", "first_turn"))
    there = stored(here.groupBy("h").agg(least.alias("first")), "chat-first")
    # The first conversation's own messages look at the one after it.
    after = (here.join(there, "h").where("conv_id <> first.conv_id").groupBy("h").agg(least.alias("next")))
    there = stored(there.join(after, "h", "left"), "chat-there")
    same = (asked.join(here, ["h", "conv_id"]).where("first_turn < turn")
            .select("conv_id", "turn", "h", "n", F.col("conv_id").alias("reply_conv"), F.col("first_turn").alias("reply_turn")))
    other = (asked.where("n > 0").join(there, "h")
             .withColumn("o", F.when(F.col("first.conv_id") == F.col("conv_id"), F.col("next")).otherwise(F.col("first")))
             .where("o IS NOT NULL")
             .select("conv_id", "turn", "h", "n", F.col("o.conv_id").alias("reply_conv"), F.col("o.first_turn").alias("reply_turn")))
    found = same.withColumn("near", F.lit(1)).unionByName(other.withColumn("near", F.lit(0)))
    score = found.groupBy("conv_id", "turn", "near", "reply_conv", "reply_turn").agg(F.sum(F.abs("n")).alias("shared"))
    best = F.max(F.struct("near", "shared", -F.col("reply_conv"), -F.col("reply_turn"), "reply_conv", "reply_turn"))
    return score.groupBy("conv_id", "turn").agg(best.alias("b")).select("conv_id", "turn", "b.reply_conv", "b.reply_turn")


def _jump(steps: DataFrame, combine, length: int, label: str) -> DataFrame:
    """``node, next, v``: ``v`` combined along the whole path from each node.

    ``next`` is null at ends; after the rounds that a path of ``length`` nodes
    takes, only nodes that lead into a circle still have one.
    """
    for _ in range(max(1, math.ceil(math.log2(max(length, 2))) + 1)):
        far = steps.toDF("next", "far", "more")
        moved = (steps.where("next IS NOT NULL").join(far, "next")
                 .select("node", F.col("far").alias("next"), combine(F.col("v"), F.col("more")).alias("v")))
        steps = stored(steps.where("next IS NULL").select("node", "next", "v").unionByName(moved), label)
        if not steps.where("next IS NOT NULL").limit(1).count():
            break
    return steps


def _without_circles(runs: DataFrame, n: int) -> DataFrame:
    """``runs`` where the first run of each circle of parents has no parent."""
    own = F.struct(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("run").alias("run"))
    ends = _jump(runs.select(F.col("run").alias("node"), F.col("parent").alias("next"), own.alias("v")), F.least, n, "chat-circles")
    on = ends.where("next IS NOT NULL").select(F.col("next").alias("node")).distinct()
    cut = stored(ends.join(on, "node").select(F.col("v.run").alias("run")).distinct().withColumn("cut", F.lit(True)), "chat-cut")
    return (runs.join(cut, "run", "left").withColumn("parent", F.when(F.col("cut").isNull(), F.col("parent")))
            .withColumn("below", F.when(F.col("cut").isNull(), F.col("below")).otherwise(0)).drop("cut"))


def _run_offsets(runs: DataFrame) -> DataFrame:
    """``run, offset``: the messages of its thread before each run, in preorder.

    ``runs``: ``run, thread_id, conv_id, turn`` (null: it opens its
    conversation), ``parent`` (run, or null), ``below`` (the larger, the
    earlier the parent's message), ``n`` messages.  A run's children start with
    those of its last message, so that a branch follows what it hangs from.
    """
    n = runs.count()
    runs = stored(_without_circles(runs, n), "chat-runs").withColumn(
        "family", F.coalesce(F.concat(F.lit("run "), "parent"), F.concat(F.lit("thread "), F.col("thread_id").cast("string"))))
    # Siblings in buckets of conversation ids, so that no task orders all replies to one message.
    key = ["family", "below", "group"]
    runs = runs.withColumn("group", F.floor(F.col("conv_id") / BUCKET))
    first = F.min(F.struct(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("run").alias("run")))
    groups = runs.groupBy(*key).agg(first.alias("f"))
    groups = stored(groups.select(*key, F.lead("f.run").over(Window.partitionBy("family").orderBy("below", "group")).alias("later")),
                    "chat-siblings")
    beside = F.lead("run").over(Window.partitionBy(*key).orderBy("conv_id", "turn"))
    placed = stored(runs.withColumn("beside", beside).join(groups, key)
                    .select("run", "thread_id", "parent", "n", F.coalesce("beside", "later").alias("sibling"),
                            "below", "conv_id", "turn"), "chat-placed")
    child = (placed.where("parent IS NOT NULL").groupBy(F.col("parent").alias("run"))
             .agg(F.min(F.struct("below", "conv_id", "turn", "run")).getField("run").alias("child")))
    down, up = (lambda c, d=d: F.concat(F.lit(d), F.col(c)) for d in ("down ", "up "))
    tour = placed.join(child, "run", "left").select(
        down("run").alias("node"), F.coalesce(down("child"), up("run")).alias("next"), F.col("n").alias("v")
    ).unionByName(placed.select(up("run").alias("node"), F.coalesce(down("sibling"), up("parent")).alias("next"), F.lit(0).cast("long").alias("v")))
    ranked = _jump(stored(tour, "chat-tour"), lambda a, b: a + b, 2 * n, "chat-ranks")
    total = stored(placed.groupBy("thread_id").agg(F.sum("n").alias("total")), "chat-totals")
    return (placed.select("run", "thread_id", down("run").alias("node")).join(ranked, "node").join(total, "thread_id")
            .select("run", (F.col("total") - F.col("v")).alias("offset")))


def ordered_messages(conversations: DataFrame) -> DataFrame:
    """``thread_id, position, conv_id, turn, role, text, reply_conv,
    reply_turn, n_quotes`` for every row.

    ``text`` has no quotes; a null text stays null.  ``reply_conv`` and
    ``reply_turn`` name the quoted original (null: none found; such a message
    follows the one before it).  ``thread_id`` is the smallest conversation id
    of the thread; rows with a null id form a thread of their own, null.  Null
    turns come last; rows repeated with one turn all stay, ordered by role and
    text.  Other columns are not read; an empty table gives no rows.
    """
    ship(conversations.sparkSession)
    messages = stored(_messages(conversations), "chat-messages")
    links = stored(reply_links(messages), "chat-links")
    joined = components(links.where("reply_conv <> conv_id").select(F.col("conv_id").alias("a"), F.col("reply_conv").alias("b")))
    follows = "reply_conv = conv_id AND reply_turn = try_subtract(turn, 1)"
    # Order is a matter of ids, turns and numbers of rows; texts are moved once, at the end.
    turns = stored(
        messages.groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
        .join(links.withColumn("head", F.expr(f"IF({follows}, NULL, turn)")), ["conv_id", "turn"], "left")
        .join(joined.withColumnRenamed("node", "conv_id"), "conv_id", "left")
        .withColumn("thread_id", F.coalesce("comp", "conv_id")).drop("comp")
        .withColumn("bucket", F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit(2**53))), "chat-turns")
    # The run of a turn starts at the last head up to it: in its bucket of turns, or carried from those before.
    marks = turns.groupBy("conv_id", "bucket").agg(F.max("head").alias("last"))
    carried = F.max("last").over(Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    marks = stored(marks.select(F.col("conv_id").alias("m_conv"), F.col("bucket").alias("m_bucket"), carried.alias("carried")), "chat-marks")
    here = F.max("head").over(Window.partitionBy("conv_id", "bucket").orderBy(F.asc_nulls_last("turn")))
    turns = stored(
        turns.withColumn("here", here)
        .join(marks, F.col("conv_id").eqNullSafe(F.col("m_conv")) & (F.col("bucket") == F.col("m_bucket")))
        .withColumn("start", F.coalesce("here", "carried"))
        .withColumn("run", F.concat_ws(" ", F.col("conv_id").cast("string"), F.col("start").cast("string")))
        .drop("here", "carried", "m_conv", "m_bucket"), "chat-in-runs")
    # Positions in a run from counts of buckets, so that no task ranks a whole conversation.
    counts = stored(turns.groupBy("thread_id", "conv_id", "run", "start", "bucket").agg(F.sum("n").alias("n")), "chat-counts")
    earlier = (Window.unboundedPreceding, -1)
    before = F.sum("n").over(Window.partitionBy("run").orderBy("bucket").rowsBetween(*earlier))
    offsets = counts.select(F.col("run").alias("o_run"), F.col("bucket").alias("o_bucket"), F.coalesce(before, F.lit(0)).alias("offset"))
    # Only threads with heads have more than one run.
    heads = turns.where("head IS NOT NULL").select("thread_id", "conv_id", "turn", "run", "reply_conv", "reply_turn")
    asked = heads.select(F.col("reply_conv").alias("conv_id"), F.col("reply_turn").alias("turn")).distinct()
    said = stored(turns.select("conv_id", "turn", "run").join(asked, ["conv_id", "turn"], "left_semi")
                  .toDF("reply_conv", "reply_turn", "parent"), "chat-originals")
    parents = heads.join(said, ["reply_conv", "reply_turn"]).select("run", "parent", F.bitwise_not("reply_turn").alias("below"))
    runs = (counts.join(heads.select("thread_id").distinct(), "thread_id", "left_semi")
            .groupBy("thread_id", "conv_id", "run", F.col("start").alias("turn")).agg(F.sum("n").alias("n"))
            .join(parents, "run", "left").withColumn("below", F.coalesce("below", F.lit(0).cast("long"))))
    starts = stored(_run_offsets(stored(runs, "chat-forest")), "chat-offsets").toDF("run", "thread_offset")
    within = F.sum("n").over(Window.partitionBy("conv_id", "run", "bucket").orderBy(F.asc_nulls_last("turn")).rowsBetween(*earlier))
    base = F.coalesce("thread_offset", F.lit(0)) + F.col("offset") + F.coalesce("within", F.lit(0))
    # One key without nulls, so that the join and the numbering of repeated turns share a shuffle.
    place = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("conv_id", "turn")])
    places = stored(
        turns.withColumn("within", within)
        .join(offsets, (F.col("run") == F.col("o_run")) & (F.col("bucket") == F.col("o_bucket"))).join(starts, "run", "left")
        .select(place.alias("place"), "thread_id", base.alias("base"), "reply_conv", "reply_turn"), "chat-places")
    nth = F.row_number().over(Window.partitionBy("place").orderBy("role", "text"))
    return (messages.select(place.alias("place"), "conv_id", "turn", "role", "text", "n_quotes").join(places, "place")
            .withColumn("nth", nth)
            .select("thread_id", (F.col("base") + F.col("nth") - 1).alias("position"), "conv_id", "turn", "role", "text",
                    "reply_conv", "reply_turn", "n_quotes"))


def threads(conversations: DataFrame) -> DataFrame:
    """``thread_id, segment, n_messages, n_replies, text``: the formatted
    messages of each thread in order, ``SEGMENT`` of them a row.

    A message reads ``<|role|>``, line break, its text; null roles and texts
    are empty.
    """
    rows = ordered_messages(conversations)
    turn = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")))
    return (rows.withColumn("segment", F.floor(F.col("position") / SEGMENT).cast("long"))
            .groupBy("thread_id", "segment")
            .agg(F.count("*").alias("n_messages"), F.count("reply_conv").alias("n_replies"),
                 F.sort_array(F.collect_list(F.struct("position", turn.alias("t")))).alias("m"))
            .select("thread_id", "segment", "n_messages", "n_replies", F.expr("array_join(m.t, '\n')").alias("text")))
