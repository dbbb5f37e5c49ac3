"""Bronze readers: a topic of JSON records as a DataFrame with a ``value`` column.

Kafka is used when a bootstrap address is given (the connector must be on
the class path); otherwise the topic is a directory of JSON-lines files,
which yields exactly the same ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPICS = {
    "ride_requests": "ride-requests",
    "ride_completed": "ride-completed",
    "driver_locations": "driver-locations",
}

DEFAULT_MAX_PER_TRIGGER = 1000


def read_topic_stream(
    spark: SparkSession,
    stream: str,
    *,
    path: str | None = None,
    bootstrap_servers: str | None = None,
    max_per_trigger: int | None = DEFAULT_MAX_PER_TRIGGER,
    starting_offsets: str = "latest",
) -> DataFrame:
    """Streaming DataFrame of one topic.

    Admission control: ``max_per_trigger`` offsets per micro-batch on Kafka;
    on a file topic it becomes ``maxFilesPerTrigger`` (None = everything
    available).  A file topic has no "latest": it starts from all files and
    the checkpoint takes over from there.
    """
    if bootstrap_servers:
        r = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", TOPICS[stream])
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", "false")
        )
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return r.load()
    if path is None:
        raise ValueError("either path or bootstrap_servers is required")
    r = spark.readStream.schema("value string")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.text(path)


def read_topic_batch(spark: SparkSession, path: str) -> DataFrame:
    """The same topic directory read as a bounded batch (backfill, tests)."""
    return spark.read.schema("value string").text(path)


def write_topic_files(bronze: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    """Write ``value`` records as JSON-lines files (a file-backed topic).

    With ``partitions``, exactly that many files are written, like the
    partitions of a topic; the stream then reads them in parallel.
    """
    df = bronze.select("value")
    if partitions:
        df = df.repartition(partitions)
    df.write.mode(mode).text(path)
