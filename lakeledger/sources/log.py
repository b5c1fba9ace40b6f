"""The keyed message log: batch and streaming readers, and a writer.

With the Kafka connector on the classpath the log is a topic; without it (as
here) the log is a directory of Parquet files holding the same six columns, read
as a file stream whose admission cap is ``maxFilesPerTrigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions.wire import kafka_key
from lakeledger.schemas import LOG_PARTITIONS, LOG_SCHEMA, RAW_TOPIC


def read_log(spark: SparkSession, path: str | None = None, *, bootstrap_servers: str | None = None, topic: str = RAW_TOPIC,
             starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """Static log frame (S2): a folder, or a topic between two offsets ('earliest' and
    'latest', or the JSON that names an offset for each partition; the end is not read).
    A lost range is an error here: an audit must not pass over it."""
    if bootstrap_servers:
        reader = spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic)
        reader = reader.option("startingOffsets", starting_offsets).option("endingOffsets", ending_offsets)
        return reader.option("failOnDataLoss", "true").load().select(*LOG_SCHEMA.names)
    if path is None:
        raise ValueError("a file log needs a path")
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def read_log_stream(
    spark: SparkSession,
    path: str | None = None,
    *,
    bootstrap_servers: str | None = None,
    topic: str = RAW_TOPIC,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Unbounded log (S1). Offsets live in the query checkpoint; no consumer group.

    ``max_per_trigger`` caps one micro-batch (offsets for Kafka, files for a file
    log). It decides where batch boundaries fall, which the idempotent append keys
    on, so keep it fixed for the life of a checkpoint. For a long-lived file log,
    ``clean_source`` ("archive" with ``archive_dir``, or "delete") moves committed
    files out of the listed folder, so each trigger's listing stays small.
    """
    if bootstrap_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", "false")
        )
        if max_per_trigger is not None:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()
    if path is None:
        raise ValueError("a file log needs a path")
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.parquet(path)


def _log_rows(payloads: DataFrame, key, topic: str, partitions: int, sequence: str, timestamp: str) -> DataFrame:
    """partition = hash of the key (of the sequence without one), so one account stays on
    one partition; offset = the sequence id: unique, increasing, not dense."""
    dealt = F.pmod(F.when(key.isNull(), F.hash(F.col(sequence))).otherwise(F.hash(key)), F.lit(partitions))
    return payloads.select(
        key.alias("key"), "value", F.lit(topic).alias("topic"), dealt.cast("int").alias("partition"),
        F.col(sequence).cast("long").alias("offset"), F.col(timestamp).cast("timestamp").alias("timestamp"))


def keyed_log(payloads: DataFrame, *, topic: str = RAW_TOPIC, partitions: int = LOG_PARTITIONS, sequence: str = "seq",
              timestamp: str = "produced") -> DataFrame:
    """Log rows of model messages: keyed by their account (none: no key)."""
    return _log_rows(payloads, kafka_key("account_id"), topic, partitions, sequence, timestamp)


def keyless_log(payloads: DataFrame, *, topic: str = RAW_TOPIC, partitions: int = LOG_PARTITIONS, sequence: str = "seq",
                timestamp: str = "produced") -> DataFrame:
    """Log rows of raw payload bytes from an untrusted producer: no key is read out of
    them, so they spread over all partitions."""
    return _log_rows(payloads, F.lit(None).cast("binary"), topic, partitions, sequence, timestamp)


def write_log(log: DataFrame, path: str | None = None, *, bootstrap_servers: str | None = None, topic: str = RAW_TOPIC,
              max_records_per_file: int | None = None) -> int:
    """Publish log rows (S10); returns the delivered count, observed on the write itself.

    To Kafka when a broker is given (key and value columns). Otherwise Parquet files are
    appended as the tasks of ``log`` hold the rows, in the order of arrival inside each
    task: no exchange, and the input is evaluated once. File count follows the data;
    ``max_records_per_file`` cuts larger ones (a file is what a file stream admits)."""
    if not bootstrap_servers and path is None:
        raise ValueError("a file log needs a path")
    seen = Observation("log_write")
    rows = log.observe(seen, F.count(F.lit(1)).alias("rows"))
    if bootstrap_servers:
        writer = rows.select("key", "value").write.format("kafka")
        writer.option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save()
    else:
        writer = rows.sortWithinPartitions("timestamp", "partition", "offset").write.mode("append")
        (writer.option("maxRecordsPerFile", max_records_per_file) if max_records_per_file else writer).parquet(path)
    return int(seen.get["rows"])
