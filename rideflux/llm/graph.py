"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)``: the smallest node id reachable from each node.

    ``edges`` has long columns ``a`` and ``b``; loops and repeated edges are
    harmless, edges with a null end are ignored, an empty table gives no rows.

    Each round merges every node into the first of its neighbours and itself
    and keeps the distinct edges between what is left, so the edge table only
    shrinks: a star is done after one round.  The first round takes the order
    of ids, later ones an order by hash that differs from round to round, so
    that long chains too lose a share of their nodes each time.  A node with
    very many edges is combined map-side; tables that are joined back are
    stored first, so that Spark can split a hot one.
    """
    e = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
               .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = None
    rounds = 0
    while e.limit(1).count():
        def rank(c: str) -> F.Column:
            return F.struct(F.xxhash64(F.lit(rounds), c).alias("r") if rounds else F.lit(0).alias("r"), F.col(c).alias("id"))

        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        into = stored(both.groupBy("a").agg(F.min(rank("b")).alias("m"))
                      .select(F.col("a").alias("node"), F.least("m", rank("a")).getField("id").alias("into")), "cc-into")
        left, right = into.toDF("a", "x"), into.toDF("b", "y")
        e = stored(e.join(left, "a").join(right, "b").where("x <> y")
                   .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
        step = into.toDF("comp", "into")
        labels = into.toDF("node", "comp") if labels is None else stored(
            labels.join(step, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), "cc-labels")
        rounds += 1
    if labels is None:
        return e.toDF("node", "comp")
    least = stored(labels.groupBy("comp").agg(F.min("node").alias("least")), "cc-least")
    return stored(labels.join(least, "comp").select("node", F.col("least").alias("comp")), "cc-components")
