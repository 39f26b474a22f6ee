from __future__ import annotations

import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt import sinks, sources
from forecourt.operators import upsert
from tests.conftest import executed_plan, rows

SCHEMA = "id string, v int"

keys = st.sampled_from([str(i) for i in range(12)])
tables = st.dictionaries(keys, st.integers(0, 99), max_size=12)


def frame(spark, table, keyless=()):
    return spark.createDataFrame([*table.items(), *((None, v) for v in keyless)], SCHEMA)


@settings(max_examples=8, deadline=None)
@given(tables, tables, st.lists(st.integers(0, 9), max_size=3), st.lists(st.integers(0, 9), max_size=3))
def test_against_a_dict(spark, target, source, old_keyless, new_keyless):
    merged = upsert(frame(spark, target, old_keyless), frame(spark, source, new_keyless))
    expected = [*(target | source).items(), *((None, v) for v in old_keyless + new_keyless)]
    assert rows(merged) == sorted(expected, key=repr)


def test_twice_is_once(spark):
    target, source = frame(spark, {"1": 1, "2": 2}), frame(spark, {"2": 20, "3": 30})
    once = upsert(target, source)
    assert rows(upsert(once, source)) == rows(once)


def test_new_columns_are_null_for_old_rows(spark):
    source = spark.createDataFrame([("2", 20, "x")], "id string, v int, w string")
    assert rows(upsert(frame(spark, {"1": 1, "2": 2}), source)) == [("1", 1, None), ("2", 20, "x")]


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    old, new = str(tmp_path / "target"), str(tmp_path / "source")
    as_table = [F.col("id").cast("string"), F.col("id").cast("int").alias("v")]
    spark.range(20000).select(*as_table).write.parquet(old)
    frame(spark, {"5": -5, "x": 1}).write.parquet(new)
    merged = upsert(spark.read.parquet(old), spark.read.parquet(new))
    plan = executed_plan(merged)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert merged.count() == 20001


@pytest.fixture
def table(spark, tmp_path):
    name = f"listings_{uuid.uuid4().hex}"
    return name, str(tmp_path / "silver")


def test_table_is_created_then_merged(spark, table):
    name, root = table
    assert sinks.upsert_table(frame(spark, {"1": 1, "2": 2}, [7]), name, root) == 3
    assert sinks.upsert_table(frame(spark, {"2": 20, "3": 30}, [8]), name, root) == 3
    assert rows(spark.table(name)) == sorted(
        [("1", 1), ("2", 20), ("3", 30), (None, 7), (None, 8)], key=repr
    )


def test_source_may_read_the_table_it_is_merged_into(spark, table):
    name, root = table
    sinks.upsert_table(frame(spark, {"1": 1, "2": 2}), name, root)
    doubled = spark.table(name).filter("id = '2'").select("id", (F.col("v") * 2).alias("v"))
    sinks.upsert_table(doubled, name, root)
    assert rows(spark.table(name)) == [("1", 1), ("2", 4)]


def test_table_grows_a_column(spark, table):
    name, root = table
    sinks.upsert_table(frame(spark, {"1": 1, "2": 2}), name, root)
    wider = spark.createDataFrame([("2", 20, "x")], "id string, v int, w string")
    sinks.upsert_table(wider, name, root)
    assert rows(spark.table(name)) == [("1", 1, None), ("2", 20, "x")]


def test_ambiguous_source_is_refused_and_changes_nothing(spark, table):
    name, root = table
    sinks.upsert_table(frame(spark, {"1": 1}), name, root)
    twice = spark.createDataFrame([("1", 5), ("1", 6)], SCHEMA)
    with pytest.raises(sinks.DuplicateKeys):
        sinks.upsert_table(twice, name, root)
    assert rows(spark.table(name)) == [("1", 1)]


def test_target_is_found_without_its_catalog_name(spark, table):
    name, root = table
    sinks.upsert_table(frame(spark, {"1": 1, "2": 2}), name, root)
    sources.forget(spark, name)
    assert not sources.table_exists(spark, name)
    sinks.upsert_table(frame(spark, {"2": 20, "3": 30}), name, root)
    assert rows(spark.table(name)) == [("1", 1), ("2", 20), ("3", 30)]


def test_changed_type_is_refused_and_changes_nothing(spark, table):
    name, root = table
    sinks.upsert_table(frame(spark, {"1": 1}), name, root)
    with pytest.raises(sinks.TypeClash):
        sinks.upsert_table(spark.createDataFrame([("1", 1.5)], "id string, v double"), name, root)
    assert rows(spark.table(name)) == [("1", 1)]
