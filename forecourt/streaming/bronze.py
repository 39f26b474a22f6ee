"""Messages to Bronze with Structured Streaming (S6, P11-P13, K3, ST1-ST6).

The job is stateless: no watermark, no state store, append output. Progress and
file commits are tracked by the checkpoint and the sink's commit log, so a run
that is restarted on another machine neither loses nor repeats records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from forecourt import spec


class StreamTimeout(Exception):
    """The available input was not drained in the time given."""


def read_topic(
    spark: SparkSession, servers: str, topic: str = spec.TOPIC, **options: str
) -> DataFrame:
    """Topic from the earliest offset, tolerating expired offsets (S6, ST4).

    ``minPartitions`` or ``maxRecordsPerPartition`` among the options split a topic
    partition that holds far more than its share over several tasks.
    """
    kafka = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **options,
    }
    return spark.readStream.format("kafka").options(**kafka).load()


def read_message_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """One message per line in a directory that grows: the same ``value`` column as a topic."""
    return spark.readStream.options(**options).text(path)


def read_keyed_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``key`` and ``value`` of messages sent to files, as a topic has them."""
    return spark.readStream.schema("key string, value string").options(**options).json(path)


def parse_messages(raw: DataFrame, schema: T.StructType = spec.WIRE) -> DataFrame:
    """``value`` to typed columns, arrival time, and the text of records that did not fit.

    A wrong-typed field is NULL by itself; text that is not JSON gives a row of
    NULLs. Both keep the original text in the corrupt-record column (T6).
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(spec.CORRUPT, T.StringType())])
    record = F.from_json(
        F.col("value").cast("string"),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": spec.CORRUPT},
    )
    return raw.select(record.alias("record")).select(
        "record.*", F.current_timestamp().alias(spec.INGESTED)
    )


def usable(bronze: DataFrame, key: str = "id") -> DataFrame:
    """Bronze records that can be told apart, i.e. have a key."""
    return bronze.filter(F.col(key).isNotNull()).drop(spec.CORRUPT)


def unreadable(bronze: DataFrame, key: str = "id") -> DataFrame:
    """The quarantined rest."""
    return bronze.filter(F.col(key).isNull())


def start_bronze(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a parquet location, then stop (K3, ST2, ST3, ST5)."""
    return (
        records.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def wait(query: StreamingQuery, what: str, timeout: int | None) -> StreamingQuery:
    """Until the input is drained; without a timeout as long as it takes."""
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise StreamTimeout(f"{what}: input not drained after {timeout} s")
    return query


def drain_batches(
    rows: DataFrame, merge: Callable[[DataFrame, dict[str, int]], None], checkpoint: str,
    timeout: int | None = None,
) -> StreamingQuery:
    """Hand everything available now to ``merge`` in batches (ST3).

    A batch comes with its mark, the name of the stream and the number of the batch. After a
    loss the last batch may come again with the same mark: what ``merge`` stores must
    hold the mark, so that it can tell (``sinks.merge_into``, ``commits.add``).
    """

    def handle(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge(batch, {f"stream {stream}": number})

    query = (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return wait(query, checkpoint, timeout)


def drain_to_bronze(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    schema: T.StructType = spec.WIRE,
    timeout: int | None = None,
) -> StreamingQuery:
    """Parse, append and wait; the finished query is returned for its progress (ST1, ST6)."""
    return wait(start_bronze(parse_messages(raw, schema), path, checkpoint), path, timeout)
