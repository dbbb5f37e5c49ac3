"""Table layout jobs: create, conform, cluster (Z-order), compact.

All of them read a table and write a *new* directory; none rewrites files
in place (the streaming sink's batch partitions stay replayable).  The
target is derived data, so it is written in overwrite mode: a job re-run
after a failure replaces whatever a failed attempt left there.  The target
must therefore never be the source directory.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from rideflux import schemas as S
from rideflux.session import shared_dir

REJECT_COL = "reject_reason"


# --- create / read ---------------------------------------------------------------

def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a gold table with its declared schema, in declared column order.

    The schema is passed, not inferred: an empty (just created) table has no
    data files to infer from, and partition columns would otherwise come
    back last and typed by guesswork.
    """
    schema = S.GOLD_SCHEMAS[table]
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("x string").parquet(path)
        return True
    except AnalysisException:
        return False


def create_table(spark: SparkSession, table: str, path: str) -> bool:
    """Create the empty gold table with its partition layout unless present.

    Returns True when it was created.
    """
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], S.GOLD_SCHEMAS[table]).write.mode("errorifexists").partitionBy(
        *S.GOLD_SPECS[table].partition_cols).parquet(path)
    return True


# --- conform -------------------------------------------------------------------

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape ``df`` to ``schema`` and tag rows that break it.

    Columns come out in declared order with declared types (``try_cast``:
    a value that does not convert becomes null and is reported); a missing
    column is null.  ``reject_reason`` lists the broken rules, empty when
    the row is accepted.  Use :func:`accepted` / :func:`rejected` on the
    result, or write it once partitioned by acceptance.
    """
    present = set(df.columns)
    cols: list[Column] = []
    problems: list[Column] = []
    for f in schema.fields:
        if f.name in present:
            src = F.col(f.name)
            cast = src.try_cast(f.dataType)
            problems.append(F.when(src.isNotNull() & cast.isNull(), F.lit(f"bad {f.name}")))
        else:
            cast = F.lit(None).cast(f.dataType)
        if not f.nullable:
            problems.append(F.when(cast.isNull(), F.lit(f"null {f.name}")))
        cols.append(cast.alias(f.name))
    reason = F.concat_ws(", ", F.array_compact(F.array(*problems))) if problems else F.lit("")
    return df.select(*cols, reason.alias(REJECT_COL))


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col(REJECT_COL) == "").drop(REJECT_COL)


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col(REJECT_COL) != "")


# --- Z-order clustering ---------------------------------------------------------------

def _as_number(df: DataFrame, c: str) -> Column:
    """Order-preserving numeric view of a temporal or numeric column."""
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return F.col(c).cast("double")
    raise TypeError(f"Z-order needs numeric or temporal columns; {c} is {t.simpleString()}")


def z_value(df: DataFrame, cols: list[str], bits: int = 8, rel_error: float = 0.001) -> DataFrame:
    """Add ``_z``: bits of the columns' quantile ranks interleaved.

    Each column is mapped to a rank bucket in [0, 2^bits) using approximate
    quantiles (a bounded list of 2^bits cut points reaches the driver), by a
    binary-search bucketizer; the buckets' bits are then interleaved, so rows
    close in every column get close ``_z``.
    """
    n = 1 << bits
    probs = [i / n for i in range(1, n)]
    nums = [f"_zn{i}" for i in range(len(cols))]
    tmp = df.withColumns({
        num: F.coalesce(_as_number(df, c), F.lit(float("-inf"))) for num, c in zip(nums, cols)
    })
    # one pass computes the cut points of every column
    all_cuts = tmp.approxQuantile(nums, probs, rel_error)
    all_cuts = all_cuts or [[] for _ in nums]
    bucket_cols = []
    for i, (num, cuts) in enumerate(zip(nums, all_cuts)):
        inner = sorted({x for x in cuts if x not in (float("-inf"), float("inf"))})
        if inner:
            b = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol=num, outputCol=f"_zb{i}",
                           handleInvalid="keep")
            tmp = b.transform(tmp).withColumn(f"_zb{i}", F.col(f"_zb{i}").cast("long"))
        else:  # an empty table, a constant or an all-null column has no inner cut
            tmp = tmp.withColumn(f"_zb{i}", F.lit(0).cast("long"))
        bucket_cols.append(f"_zb{i}")
    k = len(bucket_cols)
    terms = [
        F.shiftleft(F.shiftright(F.col(bc), bit).bitwiseAND(F.lit(1)), bit * k + j)
        for bit in range(bits)
        for j, bc in enumerate(bucket_cols)
    ]
    z = terms[0]
    for t in terms[1:]:
        z = z.bitwiseOR(t)
    helper = [f"_zn{i}" for i in range(k)] + bucket_cols
    return tmp.withColumn("_z", z).drop(*helper)


def zorder_cluster(df: DataFrame, cols: list[str], path: str, *, partition_cols=(), n_files: int | None = None,
                   bits: int = 8, materialize: bool = False) -> None:
    """Rewrite ``df`` into ``path`` clustered on a Z-curve over ``cols``.

    Range partitioning on (partition columns, z) gives each task one slice
    of the curve, and the sort inside it keeps row groups tight, so Parquet
    min/max statistics skip files for predicates on any of the columns.

    The input is read three times (quantiles, range-bound sampling, the
    write).  For a plain table scan that is cheap; for a derived input pass
    ``materialize=True``: it is computed once into a reliable checkpoint in
    the shared checkpoint folder, which also cuts the lineage a lost
    executor would otherwise have to recompute.
    """
    if materialize:
        shared_dir(df.sparkSession)  # make sure a checkpoint folder is set
        df = df.checkpoint(eager=True)
    zdf = z_value(df, list(cols), bits)
    keys = [*partition_cols, "_z"]
    parts = zdf.repartitionByRange(n_files, *keys) if n_files else zdf.repartitionByRange(*keys)
    (
        parts.sortWithinPartitions(*keys)
        .drop("_z")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


# --- compaction ---------------------------------------------------------------------

def compact(df: DataFrame, path: str, *, partition_cols=(), sort_cols=()) -> None:
    """Rewrite many small files as few large ones into ``path``.

    ``rebalance`` lets AQE size the output partitions
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): small inputs are
    coalesced and a skewed partition value is split over several files
    instead of landing in one task.
    """
    out = df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_cols).parquet(path)


def compact_new_batches(spark: SparkSession, sink_path: str, out_path: str, table: str,
                        committed: int | None, after_batch: int = -1) -> int | None:
    """Incremental compaction of a streaming sink table.

    Reads only the sink's batches with ``after_batch < batch_id <= committed``
    (partition pruning on ``batch_id``), and writes them, rebalanced into few
    files, as run ``run=<after_batch>`` of ``out_path`` (partitioned by run and
    the table's own partition columns), each row with the batch that its run
    reaches up to.  ``committed`` is the largest batch with an audit row
    (``jobs.committed_batch``): a batch's folders appear one by one while it is
    written, its audit row comes last, and batches of a query commit in order,
    so nothing up to it is still to come.  Dynamic partition overwrite makes a
    retried run replace itself.  Returns ``committed``, the mark to pass as
    ``after_batch`` next time, or None when there was nothing new.  Readers of
    ``out_path`` see a few files per run instead of a directory per batch, and
    follow the runs from the first one on: a run that a longer one has replaced
    is not read, so starting over without a mark doubles nothing.
    """
    if committed is None or committed <= after_batch:
        return None
    schema = S.GOLD_SCHEMAS[table]
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    new = spark.read.schema(full).parquet(sink_path).where(
        (F.col("batch_id") > F.lit(after_batch)) & (F.col("batch_id") <= F.lit(committed)))
    part = S.GOLD_SPECS[table].partition_cols
    out = (
        new.drop("batch_id")
        .withColumn("up_to", F.lit(committed).cast("long"))
        .withColumn("run", F.lit(after_batch).cast("long"))
        .hint("rebalance", *part)
        .sortWithinPartitions(*S.GOLD_SPECS[table].cluster_cols)
    )
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", *part).parquet(out_path)
    return committed


def compacted_runs(spark: SparkSession, out_path: str, table: str) -> list[tuple[int, int]]:
    """``(run, up to batch)`` of the runs that follow one another from the first on.

    A run without rows leaves nothing behind; the next one is then the first
    that begins at or after the batch reached.
    """
    full = T.StructType([*S.GOLD_SCHEMAS[table].fields, T.StructField("up_to", T.LongType()), T.StructField("run", T.LongType())])
    found = spark.read.schema(full).parquet(out_path).groupBy("run").agg(F.coalesce(F.max("up_to"), F.col("run")).alias("up_to")).collect()
    chain: list[tuple[int, int]] = []
    for run, up_to in sorted((r.run, r.up_to) for r in found):
        if not chain or run >= chain[-1][1]:
            chain.append((run, up_to))
    return chain


def read_compacted(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    """The valid runs of an incrementally compacted table, in declared column order."""
    schema = S.GOLD_SCHEMAS[table]
    full = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    runs = [run for run, _ in compacted_runs(spark, out_path, table)]
    return spark.read.schema(full).parquet(out_path).where(F.col("run").isin(runs)).select(*schema.fieldNames())
