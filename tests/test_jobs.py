from __future__ import annotations

import csv
import uuid

import pytest

from forecourt import commits, sinks, sources, spec
from forecourt.operators import ChecksFailed, checks, enforce, staging
from forecourt.plans import gold, jobs, serving
from tests.conftest import rows

HEADER = ["id", "url", "manufacturer", "model", "year", "price", "odometer", "state", "condition"]


def raw_rows():
    """60 listings per make for two makes, 10 of a third, plus rows every stage must drop."""
    data = []
    for make, count in (("  FORD", 60), ("bmw ", 60), ("kia", 10)):
        for i in range(count):
            data.append(
                [f"{make.strip()}-{i}", "http", make, "m", f"{2000 + i % 3}.0", 1000 + i, 5000, "ca ", ""]
            )
    data.append([*data[0]])  # a second copy of one id
    data.append(["cheap", "http", "ford", "m", 2001, 400, 5000, "ca", ""])
    data.append(["free", "http", "ford", "m", 2001, 0, 5000, "ca", ""])
    data.append(["text", "http", "ford", "m", 2001, "call me", 5000, "ca", ""])
    data.append(["dc", "http", "ford", "m", 2001, 5000, 5000, "dc", ""])
    data.append(["nomake", "http", "", "m", 2001, 5000, 5000, "ca", ""])
    return data


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "vehicles.csv"
    with path.open("w", newline="") as out:
        csv.writer(out).writerows([HEADER, *raw_rows()])
    return str(path)


@pytest.fixture
def lake(spark, tmp_path):
    unique = uuid.uuid4().hex
    names = (f"bronze_{unique}.listings", f"silver_{unique}.listings", f"gold_{unique}")
    return jobs.Lake(str(tmp_path / "lake"), *names)


def marts(spark, lake):
    return {
        name: sources.load_mart(spark, lake.mart(name))
        for name in (
            "mart_price_by_make",
            "mart_price_by_state",
            "mart_price_by_year",
            "mart_listings_summary",
        )
    }


def check_marts(found):
    assert rows(found["mart_price_by_make"].select("make", "listing_count", "median_price")) == [
        ("bmw", 60, 1030.0),
        ("ford", 60, 1030.0),
    ]
    assert rows(found["mart_price_by_state"].select("state", "listing_count")) == [("CA", 130)]
    assert rows(found["mart_price_by_year"].select("make", "year", "listing_count")) == [
        (make, year, 20) for make in ("bmw", "ford") for year in (2000, 2001, 2002)
    ]
    summary = found["mart_listings_summary"].first()
    assert (summary.total_listings, summary.unique_makes, summary.states_covered) == (130, 3, 1)
    assert (summary.oldest_year, summary.newest_year) == (2000, 2002)


def test_batch_job(spark, csv_file, lake):
    report = jobs.run_batch(spark, csv_file, lake)
    assert report.rows == {"bronze": 136, "silver": 131}
    assert set(report.checks.values()) == {0}
    found = marts(spark, lake)
    check_marts(found)

    silver = sources.load_mart(spark, lake.silver_table)
    assert {"url", "manufacturer", "make", "odometer", "log_price"} <= set(silver.columns)
    assert spark.table("stg_listings").columns == [*spec.WIRE.fieldNames(), spec.INGESTED]

    assert serving.kpi_tiles(found["mart_listings_summary"]).columns == [
        "total_listings",
        "unique_makes",
        "states_covered",
        "overall_median_price",
    ]
    assert [r.make for r in serving.top_makes(found["mart_price_by_make"], 1).collect()] == ["bmw"]
    assert len(serving.depreciation_curve(found["mart_price_by_year"]).collect()) == 6
    assert serving.state_map(found["mart_price_by_state"]).first().state == "CA"


def test_batch_job_again_replaces_everything(spark, csv_file, lake):
    jobs.run_batch(spark, csv_file, lake)
    jobs.run_batch(spark, csv_file, lake)
    check_marts(marts(spark, lake))


def test_a_new_csv_column_reaches_the_named_tables(spark, csv_file, lake, tmp_path):
    jobs.run_batch(spark, csv_file, lake)
    wider = tmp_path / "wider.csv"
    with wider.open("w", newline="") as out:
        csv.writer(out).writerows([[*HEADER, "paint"], *([*r, "red"] for r in raw_rows())])
    jobs.run_batch(spark, str(wider), lake)
    for table in (lake.bronze_table, lake.silver_table):
        assert spark.table(table).select("paint").distinct().count() == 1
    check_marts(marts(spark, lake))


def test_batch_job_without_input(spark, tmp_path, lake):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_batch(spark, str(tmp_path / "none.csv"), lake)


def test_stream_job_twice(spark, csv_file, lake):
    """A second day sends everything again: Bronze doubles, Silver and the marts do not."""
    first = jobs.run_stream(spark, csv_file, lake)
    assert first.rows == {"produced": 134, "failed": 2, "silver": 131}
    check_marts(marts(spark, lake))
    second = jobs.run_stream(spark, csv_file, lake)
    assert second.rows == first.rows
    assert sources.read_layer(spark, lake.stream_bronze).count() == 2 * 134
    assert sources.load_mart(spark, lake.stream_silver_table).count() == 131
    check_marts(marts(spark, lake))
    rejected = spark.read.text(lake.topic(spec.REJECTED_TOPIC))
    assert rejected.count() == 4


def test_both_jobs_share_a_lake(spark, csv_file, lake):
    assert jobs.run_batch(spark, csv_file, lake).rows["silver"] == 131
    assert jobs.run_stream(spark, csv_file, lake).rows["silver"] == 131
    assert jobs.run_batch(spark, csv_file, lake).rows["silver"] == 131
    assert "odometer" in spark.table(lake.silver_table).columns
    assert "mileage" in spark.table(lake.stream_silver_table).columns
    assert spark.table(lake.stream_silver_table).count() == 131
    check_marts(marts(spark, lake))


def test_failed_check_stops_the_job(spark, csv_file, lake):
    raw = sources.read_raw_csv(spark, csv_file).withColumnRenamed("url", spec.INGESTED)
    with pytest.raises(ChecksFailed, match="unique_id"):
        enforce(checks(staging(raw), staging(raw)))


def test_ties_for_the_largest_makes_go_by_name(spark):
    by_make = spark.createDataFrame([("c", 5), ("a", 5), ("b", 9)], "make string, listing_count long")
    assert [r.make for r in gold.largest_makes(by_make, 2).collect()] == ["b", "a"]


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "make string, state string, year int, price double")
    assert tuple(gold.listings_summary(empty).first()) == (0, 0, 0, None, None, None, None)


def test_stream_job_with_nothing_accepted(spark, lake, tmp_path):
    path = tmp_path / "rejected.csv"
    path.write_text(",".join(HEADER) + "\nfree,http,ford,m,2001,0,5000,ca,\n")
    report = jobs.run_stream(spark, str(path), lake)
    assert report.rows == {"produced": 0, "failed": 1, "silver": 0}
    assert spark.table(lake.mart("mart_price_by_make")).count() == 0


def test_stream_job_with_ends_of_its_own(spark, csv_file, lake, tmp_path):
    """A sender and a reader take the place of the files, keys included."""
    sent = str(tmp_path / "broker")
    spark.createDataFrame([], "topic string, key string, value string").write.parquet(sent)
    messages = spark.readStream.schema("topic string, key string, value string").parquet(sent)
    report = jobs.run_stream(
        spark,
        csv_file,
        lake,
        send=lambda m: m.write.mode("append").parquet(sent),
        messages=messages.filter(f"topic = '{spec.TOPIC}'"),
    )
    assert report.rows["silver"] == 131
    keys = spark.read.parquet(sent).filter("topic like '%' and key is not null")
    assert keys.count() == report.rows["produced"] + report.rows["failed"]


class Killed(Exception):
    pass


def die_after(monkeypatch, module, name):
    """The function does its work, but whoever called it does not live to see it."""
    real = getattr(module, name)

    def once(*args, **options):
        monkeypatch.setattr(module, name, real)
        real(*args, **options)
        raise Killed

    monkeypatch.setattr(module, name, once)


@pytest.mark.parametrize("stage", ["ingest_csv", "build_silver", "build_gold"])
def test_a_batch_job_goes_on_after_each_stage(spark, csv_file, lake, monkeypatch, stage):
    die_after(monkeypatch, jobs, stage)
    with pytest.raises(Killed):
        jobs.run_batch(spark, csv_file, lake, run="monday")
    # another job replaces Bronze meanwhile: the run keeps to its own
    if stage == "build_silver":
        sinks.overwrite_bronze(sources.read_layer(spark, lake.batch_bronze).limit(0), lake.batch_bronze)
    report = jobs.run_batch(spark, csv_file, lake, run="monday")
    assert report.rows == {"bronze": 136, "silver": 131}
    assert jobs.run_batch(spark, "no such file", lake, run="monday") == report
    check_marts(marts(spark, lake))


@pytest.mark.parametrize("stage", ["produce", "stream_bronze", "upsert_silver"])
def test_a_stream_job_goes_on_after_each_stage(spark, csv_file, lake, monkeypatch, stage):
    die_after(monkeypatch, jobs, stage)
    with pytest.raises(Killed):
        jobs.run_stream(spark, csv_file, lake, run="monday")
    report = jobs.run_stream(spark, csv_file, lake, run="monday")
    assert (report.rows["produced"], report.rows["failed"]) == (134, 2)
    # no message was sent, and no record stored, twice
    assert spark.read.json(lake.topic(spec.TOPIC)).count() == 134
    assert sources.read_layer(spark, lake.stream_bronze).count() == 134
    assert sources.load_mart(spark, lake.stream_silver_table).count() == 131
    check_marts(marts(spark, lake))


def test_sending_that_dies_half_way_is_finished_by_the_next_try(spark, lake, monkeypatch):
    messages = spark.createDataFrame([(spec.TOPIC, str(i), "{}") for i in range(40)], "topic string, key string, value string")
    real, left = sources.move_new, [2]

    def tired(*args):
        if not left:
            raise Killed
        left.pop()
        real(*args)

    monkeypatch.setattr(sources, "move_new", tired)
    with pytest.raises(Killed):
        sinks.send_keyed_files(messages.repartition(4), lake.messages, "monday")
    monkeypatch.setattr(sources, "move_new", real)
    sinks.send_keyed_files(messages.repartition(3), lake.messages, "monday")
    assert rows(spark.read.json(lake.topic(spec.TOPIC)).select("key")) == sorted((str(i),) for i in range(40))


def test_silver_of_the_stream_reads_only_what_is_new(spark, csv_file, lake, monkeypatch):
    jobs.run_stream(spark, csv_file, lake)
    seen, real = [], sinks.merge_into

    def watched(source, *args, **options):
        seen.append(source.count())
        return real(source, *args, **options)

    monkeypatch.setattr(sinks, "merge_into", watched)
    assert jobs.upsert_silver(spark, lake) == 0 and seen == []
    record = '{"id":"new","make":"kia","model":"m","year":2001,"price":900.0,"mileage":5,"state":"ca","condition":null}'
    one = spark.createDataFrame([(spec.TOPIC, "new", record)], "topic string, key string, value string")
    sinks.send_keyed_files(one, lake.messages, "tuesday")
    jobs.stream_bronze(spark, lake)
    assert jobs.upsert_silver(spark, lake) == 1 and seen == [1]
    assert spark.table(lake.stream_silver_table).count() == 132


def test_a_batch_that_comes_again_changes_nothing(spark, csv_file, lake, monkeypatch):
    jobs.produce(spark, csv_file, lake)
    jobs.stream_bronze(spark, lake)
    die_after(monkeypatch, sinks, "merge_into")  # after the commit, before the stream knows
    with pytest.raises(Exception, match="Killed"):
        jobs.upsert_silver(spark, lake)
    before = commits.latest(spark, lake.stream_silver)
    assert jobs.upsert_silver(spark, lake) == 0
    assert commits.latest(spark, lake.stream_silver) == before
    assert spark.table(lake.stream_silver_table).count() == 131


def test_the_staging_view_outlives_the_session(spark, csv_file, lake):
    jobs.run_batch(spark, csv_file, lake)
    other = spark.newSession().table(lake.mart("stg_listings"))
    assert rows(other) == rows(spark.table("stg_listings")) and other.columns[-1] == spec.INGESTED
    jobs.run_batch(spark, csv_file, lake)
    assert spark.newSession().table(lake.mart("stg_listings")).count() == 131


def test_malformed_rows_stay_in_bronze_and_go_no_further(spark, lake, tmp_path):
    path = tmp_path / "raw.csv"
    good = "1,http,ford,f,2010,9000,50000,ca,good\n"
    path.write_text(",".join(HEADER) + "\n" + good + "2,http,ford,f, x,2010,9000,50000,ca,good\n3,http\n")
    assert jobs.run_batch(spark, str(path), lake).rows == {"bronze": 3, "silver": 1}
    bronze = spark.table(lake.bronze_table)
    bad = bronze.filter(f"{spec.CORRUPT} is not null")
    assert {r[spec.CORRUPT] for r in bad.collect()} == {"2,http,ford,f, x,2010,9000,50000,ca,good", "3,http"}
    assert bad.filter("id is not null or price is not null").count() == 0
    assert jobs.run_stream(spark, str(path), lake).rows == {"produced": 1, "failed": 2, "silver": 1}
    rejected = spark.read.json(lake.topic(spec.REJECTED_TOPIC)).filter("value like '%row_malformed%'")
    assert rejected.count() == 2


def test_failing_rows_are_stored_when_checks_fail(spark, lake):
    data = [("1", "ford"), ("1", "bmw"), (None, "kia"), ("2", None), ("3", "kia")]
    rows_ = spark.createDataFrame(data, "id string, make string").selectExpr(
        "id", "make", "'m' as model", "2010 as year", "900.0D as price", "5 as mileage", "'CA' as state",
        "'x' as condition", "timestamp'2020-01-01' as ingested_at",
    )
    with pytest.raises(ChecksFailed):
        jobs.build_gold(rows_, lake, spec.WIRE_LAYOUT)
    found = spark.table(lake.mart("quality_failures")).select("check_name", "id", "make")
    assert rows(found) == sorted([("unique_id", "1", "ford"), ("unique_id", "1", "bmw"), ("not_null_id", None, "kia")], key=repr)
