from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forecourt import spec, streaming
from tests.conftest import rows

LINES = [
    '{"id":"1","make":"ford","model":"f","year":2015,"price":9000.5,"mileage":10,"state":"ca","condition":null}',
    "this is not json",
    '{"id":"2","year":"twenty","price":1.0}',
    '{"id":"3","extra":{"a":1},"price":2}',
    '{"make":"bmw"}',
    "{}",
]


@pytest.fixture
def box(tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def drop(name, lines):
        (inbox / name).write_text("\n".join(lines) + "\n")

    paths = {"inbox": str(inbox), "bronze": str(tmp_path / "b"), "checkpoint": str(tmp_path / "c")}
    return drop, paths


def drain(spark, paths, timeout=120):
    raw = streaming.read_message_files(spark, paths["inbox"])
    return streaming.drain_to_bronze(raw, paths["bronze"], paths["checkpoint"], timeout=timeout)


def test_columns_and_quarantine(spark, box):
    drop, paths = box
    drop("a.txt", LINES)
    drain(spark, paths)
    bronze = spark.read.parquet(paths["bronze"])
    assert bronze.columns == [*spec.WIRE.fieldNames(), spec.CORRUPT, spec.INGESTED]
    good = streaming.usable(bronze)
    assert rows(good.select("id", "year", "price")) == [
        ("1", 2015, 9000.5),
        ("2", None, 1.0),
        ("3", None, 2.0),
    ]
    assert good.columns == [*spec.WIRE.fieldNames(), spec.INGESTED]
    bad = streaming.unreadable(bronze)
    assert bad.count() == 3
    assert "this is not json" in [r[0] for r in bad.select(spec.CORRUPT).collect()]
    wrong_type = bronze.filter("id = '2'").first()
    assert "twenty" in wrong_type[spec.CORRUPT]


def test_restart_reads_each_file_once(spark, box):
    drop, paths = box
    drop("a.txt", LINES[:1])
    drain(spark, paths)
    drain(spark, paths)
    assert spark.read.parquet(paths["bronze"]).count() == 1
    drop("b.txt", LINES[2:4])
    query = drain(spark, paths)
    assert not query.isActive and query.exception() is None
    assert rows(spark.read.parquet(paths["bronze"]).select("id")) == [("1",), ("2",), ("3",)]


def test_files_in_small_batches(spark, box):
    drop, paths = box
    for i in range(5):
        drop(f"{i}.txt", ['{"id":"%d"}' % i])
    raw = streaming.read_message_files(spark, paths["inbox"], maxFilesPerTrigger="2")
    query = streaming.drain_to_bronze(raw, paths["bronze"], paths["checkpoint"])
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert spark.read.parquet(paths["bronze"]).count() == 5


def test_arrival_time_is_set(spark, box):
    drop, paths = box
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(minutes=1)
    drop("a.txt", LINES[:1])
    drain(spark, paths)
    stamps = spark.read.parquet(paths["bronze"]).select(F.min(spec.INGESTED).cast("timestamp_ntz"))
    assert stamps.first()[0] > before


def test_timeout_stops_the_query(spark, box):
    drop, paths = box
    drop("a.txt", LINES)
    slow = streaming.read_message_files(spark, paths["inbox"]).filter(
        F.expr("java_method('java.lang.Thread', 'sleep', 3000L) IS NULL")
    )
    with pytest.raises(streaming.StreamTimeout):
        streaming.drain_to_bronze(slow, paths["bronze"], paths["checkpoint"], timeout=1)
    assert not spark.streams.active
