"""Publishing listings as keyed JSON messages (K6, P20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import sources, spec
from forecourt.functions import wire_json
from forecourt.operators.validate import REASON

# Records repeat their field names, so they shrink to a seventh. A file is read by one task, and
# there are as many as tasks that wrote them.
COMPRESSION = "gzip"


def keyed_messages(listings: DataFrame) -> DataFrame:
    """``key``: listing id, ``value``: the JSON record."""
    return listings.select(F.col("id").cast("string").alias("key"), wire_json().alias("value"))


def routed_messages(judged: DataFrame) -> DataFrame:
    """Accepted rows for the listings topic, rejected ones (with reason) for their own.

    Both leave in one write, so the raw input is read and parsed once. The text of a
    malformed row goes with its message.
    """
    ok = F.col(REASON).isNull()
    text = [spec.CORRUPT] if spec.CORRUPT in judged.columns else []
    with_reason = F.to_json(
        F.struct(*spec.WIRE.fieldNames(), REASON, *text), {"ignoreNullFields": "false"}
    )
    return judged.select(
        F.when(ok, F.lit(spec.TOPIC)).otherwise(F.lit(spec.REJECTED_TOPIC)).alias("topic"),
        F.col("id").alias("key"),
        F.when(ok, wire_json()).otherwise(with_reason).alias("value"),
    )


def send_kafka(messages: DataFrame, servers: str, **options: str) -> None:
    """Send from the executors; needs the Kafka connector on the classpath.

    Messages without a ``topic`` column need the ``topic`` option.
    """
    kafka = {"kafka.bootstrap.servers": servers, "kafka.acks": "all", **options}
    messages.write.format("kafka").options(**kafka).save()


def send_files(messages: DataFrame, path: str) -> None:
    """Append one JSON record per line, one directory per topic: the stand-in for a broker."""
    if "topic" in messages.columns:
        writer = messages.select("topic", "value").write.partitionBy("topic")
    else:
        writer = messages.select("value").write
    writer.mode("append").text(path, compression=COMPRESSION)


def send_keyed_files(messages: DataFrame, path: str, run: str) -> None:
    """Messages with their keys as files under ``path``, a folder per topic, once per ``run``.

    They are written aside first and moved in when all are there. A run that is started again
    after a loss goes on moving where it stopped, and sends no message twice.
    """
    spark = messages.sparkSession
    if not sources.path_exists(spark, f"{_aside(path, run)}/_SUCCESS"):
        write_aside(messages, path, run)
    move_in(spark, path, run)


def _aside(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/_sending/{run}"


def write_aside(messages: DataFrame, path: str, run: str) -> None:
    """The first half of ``send_keyed_files``: where no reader looks. Again means anew."""
    keyed = messages.select("topic", "key", "value")
    writer = keyed.write.partitionBy("topic").mode("overwrite")
    writer.json(_aside(path, run), compression=COMPRESSION)


def move_in(spark: SparkSession, path: str, run: str) -> None:
    """The second half: files that have arrived before stay. Again means the rest."""
    aside, path = _aside(path, run), path.rstrip("/")
    for topic in sources.list_names(spark, aside):
        if topic.startswith("topic="):
            sources.make_folder(spark, f"{path}/{topic}")
            for file in sources.list_names(spark, f"{aside}/{topic}"):
                sources.move_new(spark, f"{aside}/{topic}/{file}", f"{path}/{topic}/{run}-{file}")
