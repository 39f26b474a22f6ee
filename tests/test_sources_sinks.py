from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException

from forecourt import scratch, sinks, sources
from tests.conftest import rows

CSV = """id,manufacturer,model,year,price,odometer,state,condition,paint
1,  FORD ,F-150 ,2015.0,12000,80000,ca,good,red
2,,civic,2010,abc,,ny,,
"""


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_keeps_text_and_all_columns(spark, csv):
    df = sources.read_raw_csv(spark, csv)
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert df.columns[-1] == "paint"
    first, second = df.orderBy("id").collect()
    assert (first.manufacturer, first.model, first.year) == ("  FORD ", "F-150 ", "2015.0")
    assert (second.manufacturer, second.odometer, second.price) == (None, None, "abc")


def test_csv_with_a_fixed_schema(spark, tmp_path):
    (tmp_path / "two.csv").write_text("id,price\n1,2.5\n2,x\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("price", T.DoubleType())])
    df = sources.read_raw_csv(spark, str(tmp_path / "two.csv"), schema)
    assert rows(df) == [(1, 2.5), (2, None)]


def test_missing_input_is_an_error_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sources.read_raw_csv(spark, str(tmp_path / "absent.csv"))


def test_overwrite_keeps_earlier_columns(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert sinks.overwrite_bronze(spark.createDataFrame([("1", 5)], "id string, a int"), path) == 1
    later = spark.createDataFrame([("2", "x"), ("3", "y")], "id string, b string")
    assert sinks.overwrite_bronze(later, path) == 2
    assert rows(sources.read_layer(spark, path).select("id", "a", "b")) == [
        ("2", None, "x"),
        ("3", None, "y"),
    ]


def test_overwrite_refuses_another_type(spark, tmp_path):
    path = str(tmp_path / "bronze")
    sinks.overwrite_bronze(spark.createDataFrame([("1", 5)], "id string, a int"), path)
    with pytest.raises(ValueError, match="column a"):
        sinks.overwrite_bronze(spark.createDataFrame([("1", "5")], "id string, a string"), path)
    assert rows(sources.read_layer(spark, path)) == [("1", 5)]


def test_append_unions_columns(spark, tmp_path):
    path = str(tmp_path / "bronze")
    sinks.append_bronze(spark.createDataFrame([("1", 5)], "id string, a int"), path)
    sinks.append_bronze(spark.createDataFrame([("2", "x")], "id string, b string"), path)
    merged = sources.read_layer(spark, path, merge_schema=True)
    assert rows(merged.select("id", "a", "b")) == [("1", 5, None), ("2", None, "x")]


def test_register_and_load(spark, tmp_path):
    path, database = str(tmp_path / "s"), f"silver_{uuid.uuid4().hex}"
    spark.createDataFrame([("1", 5)], "id string, a int").write.parquet(path)
    table = f"{database}.listings"
    assert not sources.table_exists(spark, table)
    sources.register_location(spark, table, path)
    sources.register_location(spark, table, path)
    assert sources.table_exists(spark, table)
    assert rows(sources.load_mart(spark, table)) == [("1", 5)]


def test_view_and_full_refresh(spark, tmp_path):
    name = f"mart_{uuid.uuid4().hex}"
    for n in (3, 2):
        assert sinks.save_table(spark.range(n), name, str(tmp_path)).count() == n
        assert spark.table(name).count() == n
    sinks.publish_view(spark.range(4), f"{name}_view")
    assert spark.table(f"{name}_view").count() == 4


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get(scratch.SETTING)
    one, two = scratch.new_dir(spark, "x"), scratch.new_dir(spark, "x")
    assert one.startswith(f"{shared}/x-") and one != two


def test_quoted_text_stays_in_its_column(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text('id,text,state\n1,"he said ""hi"", ok",ca\n')
    assert rows(sources.read_raw_csv(spark, str(file))) == [("1", 'he said "hi", ok', "ca")]


def test_files_with_columns_in_another_order_fail(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("id,state\n1,ca\n")
    (tmp_path / "raw" / "b.csv").write_text("state,id\nca,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        sources.read_raw_csv(spark, str(tmp_path / "raw")).collect()


def test_append_refuses_another_type(spark, tmp_path):
    path = str(tmp_path / "bronze")
    sinks.append_bronze(spark.createDataFrame([("1", 5)], "id string, a int"), path)
    with pytest.raises(ValueError, match="column a"):
        sinks.append_bronze(spark.createDataFrame([("2", 5.0)], "id string, a double"), path)
    assert rows(sources.read_layer(spark, path, merge_schema=True)) == [("1", 5)]


def test_overwrite_keeps_a_column_that_only_one_append_had(spark, tmp_path):
    path = str(tmp_path / "bronze")
    sinks.append_bronze(spark.range(8).selectExpr("string(id) as id").repartition(4), path)
    sinks.append_bronze(spark.createDataFrame([("9", "x")], "id string, b string"), path)
    sinks.overwrite_bronze(spark.createDataFrame([("1",)], "id string"), path)
    assert sources.existing_schema(spark, path).fieldNames() == ["id", "b"]


def test_overwrite_of_an_empty_folder(spark, tmp_path):
    path = tmp_path / "bronze"
    path.mkdir()
    assert sinks.overwrite_bronze(spark.createDataFrame([("1",)], "id string"), str(path)) == 1


def test_rows_that_do_not_fit_the_header_are_told_apart(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text("id,model,price\n1,a,5\n2,a, b,6\n3,a\n4,\"c, d\",7\n")
    df = sources.read_checked_csv(spark, str(file))
    assert rows(df) == sorted(
        [("1", "a", "5", None), ("4", "c, d", "7", None), (None, None, None, "2,a, b,6"), (None, None, None, "3,a")],
        key=repr,
    )
    # also where few columns are asked for
    assert df.filter("id is null").select("id").count() == 2


def test_clustered_silver_reads_fewer_rows(spark, tmp_path):
    """A filter on the clustering column skips row groups; on other layouts it cannot."""
    rows_ = spark.range(200_000).selectExpr(
        "string(id) as id", "concat('S', id % 50) as state", "concat('M', id % 7) as make"
    ).repartition(2)
    scanned = {}
    with_small_groups = spark.conf.get("parquet.block.size", None)
    spark._jsc.hadoopConfiguration().setInt("parquet.block.size", 64 * 1024)
    try:
        for name, columns in (("plain", ()), ("clustered", ("state", "make"))):
            path = str(tmp_path / name)
            sinks.overwrite_silver(rows_, path, cluster_by=columns)
            found = sources.read_layer(spark, path).filter("state = 'S7'")
            assert found.collect() and found.count() == 4000
            plan = found._jdf.queryExecution().executedPlan()
            assert "PushedFilters: [IsNotNull(state), EqualTo(state,S7)]" in plan.toString()
            leaf = plan.collectLeaves().head()
            scanned[name] = leaf.metrics().apply("numOutputRows").value()
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
        assert with_small_groups is None
    assert scanned["plain"] == 200_000 and scanned["clustered"] < 50_000


def test_listings_csv_is_compressed_and_read_back(spark, tmp_path):
    from datetime import datetime

    from forecourt.registry import queries

    day = datetime(1998, 5, 1)
    lines = [(o, 7, 3, n, 2.0, 100.5, 0.0, 0.0, "N", "O", day) for o in range(300) for n in (1, 2)]
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(o, o % 5, 9000.0) for o in range(300)], "o_orderkey long, o_custkey long, o_totalprice double"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(
        [(7, " a, b ", "Brand#1")], "p_partkey long, p_name string, p_brand string"
    ).write.parquet(str(tmp_path / "part.parquet"))
    path = queries._csv(spark, str(tmp_path))
    files = [x for x in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert files and all(x.path.endswith(".csv.gz") for x in files)
    back = sources.read_raw_csv(spark, path)
    assert back.count() == 600 and back.select("model").distinct().collect()[0][0] == " a, b  "
