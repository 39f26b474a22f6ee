"""One named query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import adapter, commits, scratch, sinks, sources, spec, streaming
from forecourt.adapter import RAW_COLUMNS, TIEBREAK
from forecourt.functions import (
    clean_string,
    double_column,
    int_column,
    plausible_year,
    price_label,
    price_per_mile,
)
from forecourt.operators import (
    accepted,
    checks,
    classify,
    clean,
    distinct_estimates,
    distinct_sketches,
    exact_medians,
    failing_rows,
    gold_valid,
    produce_metrics,
    quarantine,
    silver_valid,
    staging,
    staging_sql,
    upsert,
    with_log_price,
)
from forecourt.plans import cells, gold, jobs, serving
from forecourt.plans.ledger import Ledger
from forecourt.operators.sketch import ERROR as SKETCH_ERROR
from forecourt.plans.silver import deduped, gold_input, silver
from forecourt.spec import WIRE_LAYOUT

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Upsert: rows ingested before this instant are the target, the rest the source.
SPLIT = "1999-01-01 00:00:00"

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the marts read of Gold input, stored: joins and dedup run once."""
    path = scratch.new_dir(spark, "valid")
    gold_listings(spark, sf_dir).select("make", "state", "year", "price").write.parquet(path)
    return sources.read_layer(spark, path)


def _lake(spark: SparkSession, purpose: str) -> jobs.Lake:
    """A lake of its own for one run: fresh folder, fresh catalog names."""
    root, run = scratch.new_dir(spark, purpose), uuid.uuid4().hex
    bronze, silver_, gold_ = (f"{layer}_{run}" for layer in ("bronze", "silver", "gold"))
    for database in (bronze, silver_, gold_):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{database}'")
    return jobs.Lake(root, f"{bronze}.listings", f"{silver_}.listings", gold_)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(adapter.domain_listings(spark, sf_dir))


# --- projections -------------------------------------------------------------


@query
def clean_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P6, P9, F3."""
    return staging(adapter.listings(spark, sf_dir))


@query
def log_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7."""
    rows = with_log_price(clean(adapter.listings(spark, sf_dir)))
    return rows.select("id", "price", F.round("log_price", 6).alias("log_price"))


@query
def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10."""
    return adapter.table(spark, sf_dir, "part").select(
        "p_partkey",
        clean_string(F.col("p_name")).alias("name"),
        clean_string(F.col("p_brand")).alias("brand"),
    )


@query
def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price per mile, plausible year, price label of every cleaned record."""
    record = clean_listings(spark, sf_dir)
    return record.select(
        "id",
        price_per_mile(F.col("price"), F.col("mileage")).alias("price_per_mile"),
        plausible_year(F.col("year")).alias("plausible_year"),
        price_label(F.col("price")).alias("price_label"),
    )


# --- dedup and filters -------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1."""
    rows = deduped(adapter.listings(spark, sf_dir), tiebreak=TIEBREAK)
    return rows.select("id", "make", "model", "year", "price", "odometer", "state", *TIEBREAK)


@query
def silver_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, dedup, F1."""
    rows = silver(adapter.listings(spark, sf_dir), tiebreak=TIEBREAK)
    return rows.select(
        *["id", "make", "model", "year", "price", "odometer", "state", "condition"],
        spec.INGESTED,
        F.round("log_price", 6).alias("log_price"),
    )


@query
def gold_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    return gold_input(silver(adapter.listings(spark, sf_dir), tiebreak=TIEBREAK))


# --- validation --------------------------------------------------------------


@query
def domain_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted rows."""
    return accepted(_judged(spark, sf_dir))


@query
def domain_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: the rejected rows and the first rule each broke."""
    return quarantine(_judged(spark, sf_dir))


@query
def produced_and_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12."""
    return produce_metrics(_judged(spark, sf_dir))


# --- marts and serving -------------------------------------------------------


@query
def mart_price_by_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, F7, O1."""
    return gold.by_price(gold.price_by_make(_valid(spark, sf_dir)), "make")


@query
def mart_price_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, O1."""
    return gold.by_price(gold.price_by_state(_valid(spark, sf_dir)), "state")


@query
def mart_price_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, J2, O2, O3."""
    return gold.by_make_and_year(gold.price_by_year(_valid(spark, sf_dir)))


@query
def mart_listings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A6."""
    return gold.listings_summary(_valid(spark, sf_dir))


@query
def kpi_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1."""
    return serving.kpi_tiles(gold.listings_summary(_valid(spark, sf_dir)))


@query
def top_makes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, O4."""
    return serving.top_makes(gold.price_by_make(_valid(spark, sf_dir)))


@query
def depreciation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3."""
    return serving.depreciation_curve(gold.price_by_year(_valid(spark, sf_dir)))


@query
def state_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4."""
    return serving.state_map(gold.price_by_state(_valid(spark, sf_dir)))


# --- upsert ------------------------------------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = adapter.listings(spark, sf_dir)
    early = F.col(spec.INGESTED) < F.lit(SPLIT).cast("timestamp_ntz")
    columns = ["id", "make", "model", "year", "price", "odometer", "state", spec.INGESTED]
    old, new = (
        deduped(half, tiebreak=TIEBREAK).select(*columns)
        for half in (rows.filter(early), rows.filter(~early))
    )
    return old, new


@query
def upsert_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, J1 as one relational expression."""
    return upsert(*_halves(spark, sf_dir))


@query
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load, then merge, through a table made of snapshots."""
    root = scratch.new_dir(spark, "silver")
    name = f"listings_{uuid.uuid4().hex}"
    for half in _halves(spark, sf_dir):
        sinks.upsert_table(half, name, root)
    return sources.load_mart(spark, name)


@query
def upsert_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third merge, of one id, writes one folder anew and lists all others as they are."""
    root = scratch.new_dir(spark, "silver")
    for half in _halves(spark, sf_dir):
        sinks.merge_into(half, root)
    table = commits.read(spark, root)
    first = table.agg(F.min("id").alias("id"))
    touched = sinks.merge_into(table.join(first, "id", "left_semi"), root)
    return commits.read(spark, root).withColumn(
        "folders_rewritten", F.lit(len(touched.rewritten)).cast("long")
    )


@query
def marts_after_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A4, K8: all four marts read off cells that followed two upserts of Silver."""
    root, counts = scratch.new_dir(spark, "silver"), scratch.new_dir(spark, "cells")
    rows = adapter.listings(spark, sf_dir)
    early = F.col(spec.INGESTED) < F.lit(SPLIT).cast("timestamp_ntz")
    for half in (rows.filter(early), rows.filter(~early)):
        sinks.merge_into(silver(half, tiebreak=TIEBREAK).drop(*TIEBREAK), root)
        cells.refresh_cells(spark, root, counts)
    listings = cells.stored_cells(spark, counts)
    marts = {
        "make": gold.price_by_make(listings, weight=cells.COUNT),
        "state": gold.price_by_state(listings, cells.COUNT),
        "year": gold.price_by_year(listings, weight=cells.COUNT),
        "summary": gold.listings_summary(listings, cells.COUNT),
    }
    named = [mart.withColumn("mart", F.lit(name)) for name, mart in marts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@query
def upsert_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge finds its target though the catalog has lost the name."""
    root = scratch.new_dir(spark, "silver")
    name = f"listings_{uuid.uuid4().hex}"
    for half in _halves(spark, sf_dir):
        sources.forget(spark, name)
        sinks.upsert_table(half, name, root)
    return sources.load_mart(spark, name)


# --- quality -----------------------------------------------------------------


@query
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q6 over Silver: everything passes."""
    rows = silver(adapter.listings(spark, sf_dir), tiebreak=TIEBREAK)
    return checks(staging(rows), gold_input(rows))


@query
def quality_checks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q6 over typed rows that were neither deduplicated nor filtered: they must be found."""
    rows = _unfiltered(spark, sf_dir)
    return checks(rows, rows)


def _unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(adapter.domain_listings(spark, sf_dir)).select(
        "id",
        F.when(F.col("odometer") > 0, F.col("make")).alias("make"),
        F.when(F.col("condition") != "R", F.col("price")).alias("price"),
    )


@query
def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5: all rows that break a check, stored, once per check."""
    rows = _unfiltered(spark, sf_dir)
    root, name = scratch.new_dir(spark, "failures"), f"failures_{uuid.uuid4().hex}"
    sinks.save_table(failing_rows(rows, rows), name, root)
    return sources.load_mart(spark, name)


@query
def median_of_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 over values that hardly repeat: price per unit, in thirds, of each return flag."""
    lines = adapter.table(spark, sf_dir, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity") / 3
    found = exact_medians(lines.withColumn("unit", unit), ["l_returnflag"], "unit")
    return found.withColumn("median", F.round("median", 6))


@query
def coverage_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 from stored sketches of two batches, the second of which came twice."""
    root, columns = scratch.new_dir(spark, "sketches"), ["make", "state", "id"]
    rows = clean(adapter.listings(spark, sf_dir))
    early = F.col(spec.INGESTED) < F.lit(SPLIT).cast("timestamp_ntz")
    for number, half in enumerate([rows.filter(early), rows.filter(~early), rows.filter(~early)]):
        sketches = distinct_sketches(half, columns)
        write = lambda df, path: df.write.parquet(path)
        commits.add(sketches, root, write, marks={"batch": min(number, 1)})
    estimates = distinct_estimates(commits.read(spark, root), columns)
    exact = rows.agg(F.count_distinct("id").alias("ids"))
    # far fewer makes and states than a sketch has places: those are exact
    error = F.abs(F.col("id") - F.col("ids")) / F.col("ids")
    return estimates.join(exact).select("make", "state", (error < 4 * SKETCH_ERROR).alias("ids_near"))


# --- wire and stream ---------------------------------------------------------


@query
def wire_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6, P20: key and JSON text of every accepted and rejected row."""
    return sinks.routed_messages(_judged(spark, sf_dir))


@query
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12, P13 over event properties."""
    parsed = F.from_json("props", "k INT").alias("props")
    return adapter.table(spark, sf_dir, "events").select("event_id", parsed).select(
        "event_id", "props.*"
    )


@query
def stream_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6, ST1-ST6, K3: JSON lines of all events, streamed into parquet."""
    root = scratch.new_dir(spark, "event-stream")
    lines = F.to_json(F.struct(*EVENT.fieldNames()), {"ignoreNullFields": "false"})
    sinks.send_files(
        adapter.table(spark, sf_dir, "events").select(lines.alias("value")), f"{root}/in"
    )
    streaming.drain_to_bronze(
        streaming.read_message_files(spark, f"{root}/in"),
        f"{root}/bronze",
        f"{root}/checkpoint",
        schema=EVENT,
    )
    bronze = sources.read_layer(spark, f"{root}/bronze")
    return streaming.usable(bronze, "event_id").drop(spec.INGESTED)


def _stream_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream Bronze of all listings, sent through the same steps the job takes."""
    lake = _lake(spark, "listing-stream")
    judged = classify(adapter.listings(spark, sf_dir))
    sinks.send_keyed_files(sinks.routed_messages(judged), lake.messages, run="one")
    jobs.stream_bronze(spark, lake)
    return streaming.usable(sources.read_layer(spark, lake.stream_bronze))


@query
def stream_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, K6, S6, P11-P13, K3 end to end on listings."""
    return _stream_listings(spark, sf_dir).drop(spec.INGESTED)


@query
def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: keys and records of accepted rows as a reader of the message files gets them."""
    root, name = scratch.new_dir(spark, "messages"), f"messages_{uuid.uuid4().hex}"
    sinks.send_keyed_files(sinks.routed_messages(_judged(spark, sf_dir)), root, run="one")
    arrived = streaming.read_keyed_files(spark, f"{root}/topic={spec.TOPIC}")
    query_ = (
        arrived.writeStream.format("parquet").option("checkpointLocation", f"{root}/{name}-checkpoint")
        .trigger(availableNow=True).start(f"{root}/{name}")
    )
    streaming.wait(query_, name, None)
    return spark.read.parquet(f"{root}/{name}")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3, S6: a second run of the stream takes in only what came after the first."""
    root = scratch.new_dir(spark, "event-stream")
    lines = F.to_json(F.struct(*EVENT.fieldNames()), {"ignoreNullFields": "false"})
    events = adapter.table(spark, sf_dir, "events")
    for odd in (0, 1):
        some = events.filter(F.col("user_id") % 2 == odd)
        sinks.send_files(some.select(lines.alias("value")), f"{root}/in")
        streaming.drain_to_bronze(
            streaming.read_message_files(spark, f"{root}/in"),
            f"{root}/bronze", f"{root}/checkpoint", schema=EVENT,
        )
    return streaming.usable(sources.read_layer(spark, f"{root}/bronze"), "event_id").drop(spec.INGESTED)


@query
def stream_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, W3, ST3: two days of messages, each taken into Silver by itself."""
    lake = _lake(spark, "listing-stream")
    rows = adapter.listings(spark, sf_dir)
    early = F.col(spec.INGESTED) < F.lit(SPLIT).cast("timestamp_ntz")
    for day, some in enumerate((rows.filter(early), rows.filter(~early))):
        messages = sinks.routed_messages(classify(some))
        sinks.send_keyed_files(messages, lake.messages, run=f"day-{day}")
        jobs.stream_bronze(spark, lake)
        jobs.upsert_silver(spark, lake)
    stored = sources.load_mart(spark, lake.stream_silver_table)
    return stored.drop(spec.INGESTED, "log_price")


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of the stream. Arrival times tie here, so the record decides in D1."""
    order = ["make", "model", "year", "price", "mileage", "state", "condition"]
    rows = silver(_stream_listings(spark, sf_dir), WIRE_LAYOUT, tiebreak=order)
    return rows.drop(spec.INGESTED, "log_price")


# --- files and jobs ----------------------------------------------------------


def _csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch.new_dir(spark, "csv")
    writer = adapter.listings(spark, sf_dir).select(*RAW_COLUMNS).write
    writer.options(
        header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        compression="gzip",
    ).csv(path)
    return path


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to Bronze and back."""
    lake = _lake(spark, "csv-bronze")
    jobs.ingest_csv(spark, _csv(spark, sf_dir), lake)
    bronze = sources.read_layer(spark, lake.batch_bronze)
    return bronze.select(
        "id",
        "manufacturer",
        "model",
        int_column(bronze, "year").alias("year"),
        double_column(bronze, "price").alias("price"),
        int_column(bronze, "odometer").alias("odometer"),
        "state",
        "condition",
    )


@query
def csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas and line breaks inside a field stay in it."""
    path = scratch.new_dir(spark, "quoted")
    text = F.concat(F.lit('"'), "p_name", F.lit('", '), "p_brand", F.lit("\n"), "p_name")
    parts = adapter.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), text.alias("text"), F.col("p_brand").alias("brand")
    )
    parts.write.options(header="true", escape='"').csv(path)
    return sources.read_raw_csv(spark, path, multiLine="true").withColumn(
        "id", F.col("id").cast("long")
    )


@query
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an unquoted comma or line break are rejected with their text."""
    path = scratch.new_dir(spark, "malformed")
    rows = adapter.listings(spark, sf_dir).withColumn("line", F.substring_index("id", "-", -1))
    broken = (
        F.when(F.col("line") == "5", F.concat(F.lit("a, b "), "model"))
        .when(F.col("line") == "6", F.concat(F.lit("a\n"), "model"))
        .otherwise(F.col("model"))
    )
    made = rows.withColumns(
        {"model": broken, "price": F.col("price").cast("long"), "odometer": F.col("odometer").cast("long")}
    )
    text = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS))
    # one column that holds whole lines, so that nothing is quoted
    lines = made.select(F.explode(F.split(text, "\n")).alias(",".join(RAW_COLUMNS)))
    lines.write.options(
        header="true", sep="\u0001", quote="\u0002", ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
    judged = classify(sources.read_checked_csv(spark, path))
    return judged.withColumnRenamed(spec.CORRUPT, "line")


@query
def silver_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored by state and make, read for one state."""
    path = scratch.new_dir(spark, "clustered")
    rows = silver(adapter.listings(spark, sf_dir), tiebreak=TIEBREAK).drop(*TIEBREAK)
    sinks.overwrite_silver(rows, path, cluster_by=["state", "make"])
    of_state = gold_input(sources.read_layer(spark, path).filter("state = 'CA'"))
    return of_state.select("id", "make", "model", "year", "price", "mileage", "state", "condition")


@query
def ingest_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of Bronze has the one instant of its ingestion."""
    lake = _lake(spark, "stamped")
    before = spark.range(1).select(F.current_timestamp()).first()[0]
    jobs.ingest_csv(spark, _csv(spark, sf_dir), lake)
    stamp = F.col(spec.INGESTED)
    return sources.read_layer(spark, lake.batch_bronze).agg(
        F.count(stamp).alias("stamped"),
        F.count_distinct(stamp).alias("instants"),
        (F.min(stamp) >= F.lit(before)).alias("after_start"),
        (F.max(stamp) <= F.current_timestamp()).alias("before_end"),
    )


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the Bronze and Silver writes counted on the way."""
    lake = _lake(spark, "counted")
    bronze = jobs.ingest_csv(spark, _csv(spark, sf_dir), lake)
    return spark.createDataFrame(
        [(bronze, jobs.build_silver(spark, lake))], "bronze long, silver long"
    )


@query
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: two appends, the second with one more column, read as their union."""
    path = scratch.new_dir(spark, "appended")
    orders = adapter.table(spark, sf_dir, "orders")
    customers = adapter.table(spark, sf_dir, "customer")
    sinks.append_bronze(
        orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")), path
    )
    sinks.append_bronze(
        customers.select(
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").alias("price"),
            F.col("c_mktsegment").alias("condition"),
        ),
        path,
    )
    return sources.read_layer(spark, path, merge_schema=True).select("id", "price", "condition")


@query
def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to stored marts; returns the make mart."""
    lake = _lake(spark, "lake")
    jobs.run_batch(spark, _csv(spark, sf_dir), lake)
    return sources.load_mart(spark, lake.mart("mart_price_by_make"))


@query
def resumed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that has stopped after Bronze goes on from its own Bronze, not a later one."""
    lake, path = _lake(spark, "lake"), _csv(spark, sf_dir)

    def first_stage() -> list[int]:
        rows = jobs.ingest_csv(spark, path, lake)
        return [rows, commits.latest(spark, lake.batch_bronze).version]

    Ledger(spark, lake.runs, "monday").step("bronze", first_stage)
    sinks.overwrite_bronze(sources.read_layer(spark, lake.batch_bronze).limit(0), lake.batch_bronze)
    jobs.run_batch(spark, path, lake, run="monday")
    return sources.load_mart(spark, lake.mart("mart_price_by_make"))


@query
def stg_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the staging view of a lake, read in another session than the one that made it."""
    lake = _lake(spark, "lake")
    jobs.ingest_csv(spark, _csv(spark, sf_dir), lake)
    jobs.build_silver(spark, lake)
    stored = spark.table(lake.silver_table).schema
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.gold_database}")
    query_ = staging_sql(lake.silver_table, stored)
    sinks.publish_lasting_view(spark, lake.mart("stg_listings"), query_)
    return spark.newSession().table(lake.mart("stg_listings")).drop(spec.INGESTED)


@query
def stream_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, S2, A12, K6, ST1, U1, K8, Q6: CSV to messages to stored marts; returns the make mart."""
    lake = _lake(spark, "lake")
    jobs.run_stream(spark, _csv(spark, sf_dir), lake)
    return sources.load_mart(spark, lake.mart("mart_price_by_make"))
