from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from forecourt import sinks, spec, streaming
from forecourt.operators import classify
from tests.conftest import rows


def listings(spark, n=10):
    return spark.createDataFrame(
        [(str(i), "toyota", None, 2018, 12000.5, i, "ca", None) for i in range(n)], spec.WIRE
    )


def test_one_message_per_listing(spark):
    messages = sinks.keyed_messages(listings(spark)).collect()
    assert sorted(m.key for m in messages) == [str(i) for i in range(10)]
    assert all(json.loads(m.value)["id"] == m.key for m in messages)


def test_parse_undoes_encode(spark):
    parsed = streaming.parse_messages(sinks.keyed_messages(listings(spark)))
    assert rows(parsed.select(*spec.WIRE.fieldNames())) == rows(listings(spark))


def test_rejected_rows_go_to_their_own_topic(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "Ford", "2015", "9000"), ("2", "Ford", "2015", "0")],
        "id string, manufacturer string, year string, price string",
    )
    sinks.send_files(sinks.routed_messages(classify(raw)), str(tmp_path / "m"))
    sent = spark.read.text(str(tmp_path / "m"))
    got = {r.topic: json.loads(r.value) for r in sent.collect()}
    assert got[spec.TOPIC]["id"] == "1" and "error" not in got[spec.TOPIC]
    assert got[spec.REJECTED_TOPIC]["error"] == "price_not_positive"


def test_count_comes_with_the_write(spark, tmp_path):
    path = str(tmp_path / "m")
    sent = sinks.counted(
        sinks.keyed_messages(listings(spark)), lambda df: sinks.send_files(df, path)
    )
    assert sent == 10 == spark.read.text(path).count()


def test_observed_metrics(spark, tmp_path):
    path = str(tmp_path / "m")
    got = sinks.observed(
        listings(spark),
        lambda df: df.write.parquet(path),
        low=F.count_if(F.col("mileage") < 3),
        top=F.max("mileage"),
    )
    assert got == {"low": 3, "top": 9}


def test_topic_needs_the_connector(spark):
    """Without the connector on the classpath both ends fail at once, with Spark's own message."""
    with pytest.raises(PySparkException, match="(?i)kafka"):
        streaming.read_topic(spark, "broker:9092")
    with pytest.raises(PySparkException, match="(?i)kafka"):
        sinks.send_kafka(sinks.keyed_messages(listings(spark)), "broker:9092", topic=spec.TOPIC)


def test_message_files_are_compressed(spark, tmp_path):
    plain, keyed = str(tmp_path / "plain"), str(tmp_path / "keyed")
    many = listings(spark, 2000)
    sinks.send_files(sinks.keyed_messages(many), plain)
    judged = many.withColumn("error", F.lit(None).cast("string"))
    sinks.send_keyed_files(sinks.routed_messages(judged), keyed, run="one")
    sent = sinks.keyed_messages(many)
    size = sent.agg(F.sum(F.length("value"))).first()[0]
    for root, pattern in ((tmp_path / "plain", "part-*"), (tmp_path / "keyed", "topic=*/one-part-*")):
        files = list(root.glob(pattern))
        assert files and sum(x.stat().st_size for x in files) < size / 4
    assert rows(spark.read.text(plain)) == rows(sent.select("value"))
    assert rows(spark.read.json(f"{keyed}/topic={spec.TOPIC}").select("key", "value")) == rows(sent)
