"""End-to-end jobs on one Spark session.

An exception stops a job. Started again with the same ``run`` it goes on after the last stage
it has finished, with the rows that stage has left, whatever other jobs have stored since.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import commits, sinks, sources, spec, streaming
from forecourt.operators import ChecksFailed, checks, classify, enforce, failing_rows
from forecourt.operators.clean import gold_valid, staging, staging_sql
from forecourt.operators.validate import REASON
from forecourt.plans import cells, gold
from forecourt.plans.ledger import Ledger
from forecourt.plans.silver import silver
from forecourt.spec import CSV_LAYOUT, WIRE_LAYOUT, Layout


Send = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Lake:
    """Locations and names of one lake.

    Batch and stream listings differ in columns, so their Bronze and Silver live apart
    and one lake can serve both jobs. Gold is shared: it shows the run that came last.
    """

    root: str
    bronze_table: str = "bronze.listings"
    silver_table: str = "silver.listings"
    gold_database: str = "gold"

    @property
    def batch_bronze(self) -> str:
        return f"{self.root}/bronze/listings_csv"

    @property
    def stream_bronze(self) -> str:
        return f"{self.root}/bronze/listings_stream"

    @property
    def bronze_checkpoint(self) -> str:
        return f"{self.root}/bronze/_checkpoints/listings_stream"

    @property
    def messages(self) -> str:
        return f"{self.root}/messages"

    def topic(self, name: str) -> str:
        return f"{self.messages}/topic={name}"

    @property
    def batch_silver(self) -> str:
        return f"{self.root}/silver/listings_csv"

    @property
    def stream_silver(self) -> str:
        return f"{self.root}/silver/listings_stream"

    @property
    def stream_silver_table(self) -> str:
        return f"{self.silver_table}_stream"

    @property
    def silver_checkpoint(self) -> str:
        return f"{self.root}/silver/_checkpoints/listings_stream"

    @property
    def stream_cells(self) -> str:
        return f"{self.root}/silver/listings_stream_cells"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def mart(self, name: str) -> str:
        return f"{self.gold_database}.{name}"


@dataclass
class Report:
    """What a job counted on the way, and the outcome of the checks."""

    rows: dict[str, int] = field(default_factory=dict)
    checks: dict[str, int] = field(default_factory=dict)


def ingest_csv(spark: SparkSession, csv_path: str, lake: Lake, **options: str) -> int:
    """All rows of a CSV file to Bronze; of malformed ones their text in the corrupt-record column."""
    raw = sources.read_checked_csv(spark, csv_path, **options)
    stamped = raw.withColumn(spec.INGESTED, F.current_timestamp())
    rows = sinks.overwrite_bronze(stamped, lake.batch_bronze)
    sources.show_table(spark, lake.bronze_table, lake.batch_bronze)
    return rows


def build_silver(spark: SparkSession, lake: Lake, version: int | None = None) -> int:
    """Silver of a version of batch Bronze, the newest one if none is given."""
    bronze = _stored(spark, lake.batch_bronze, version)
    if spec.CORRUPT in bronze.columns:
        bronze = bronze.filter(F.col(spec.CORRUPT).isNull()).drop(spec.CORRUPT)
    rows = sinks.overwrite_silver(silver(bronze), lake.batch_silver)
    sources.show_table(spark, lake.silver_table, lake.batch_silver)
    return rows


def _stored(spark: SparkSession, root: str, version: int | None) -> DataFrame:
    return commits.read(spark, root, version and commits.at_version(spark, root, version))


def produce(
    spark: SparkSession,
    csv_path: str,
    lake: Lake,
    send: Send | None = None,
    run: str | None = None,
    **options: str,
) -> dict[str, int]:
    """Publish accepted and rejected rows in one pass and count both.

    ``send`` takes the messages (topic, key, value), for example
    ``lambda m: sinks.send_kafka(m, servers)``; without one they go to the lake's files,
    once per ``run``. A broker may get a message twice if this dies while it sends.
    """
    run = run or uuid.uuid4().hex

    def counted(write: Send) -> dict[str, int]:
        return sinks.observed(
            classify(sources.read_checked_csv(spark, csv_path, **options)),
            lambda judged: write(sinks.routed_messages(judged)),
            produced=F.count_if(F.col(REASON).isNull()),
            failed=F.count_if(F.col(REASON).isNotNull()),
        )

    if send:
        return counted(send)
    # counts and files are there, or they are made anew, before the first file is moved in
    counts = Ledger(spark, f"{lake.messages}/_sent", run).step(
        "written", lambda: counted(lambda m: sinks.write_aside(m, lake.messages, run))
    )
    sinks.move_in(spark, lake.messages, run)
    return counts


def stream_bronze(
    spark: SparkSession, lake: Lake, timeout: int | None = None, messages: DataFrame | None = None
) -> None:
    """Drain ``messages``, such as ``streaming.read_topic``, or the lake's files, into Bronze."""
    if messages is None:
        # a topic that nothing was accepted for has no folder yet
        sources.make_folder(spark, lake.topic(spec.TOPIC))
        messages = streaming.read_keyed_files(spark, lake.topic(spec.TOPIC))
    streaming.drain_to_bronze(
        messages, lake.stream_bronze, lake.bronze_checkpoint, timeout=timeout
    )


def upsert_silver(
    spark: SparkSession, lake: Lake, timeout: int | None = None, **options: str
) -> int:
    """Clean what is new in stream Bronze and merge it into Silver; counts the merged rows.

    Bronze is read as a stream, so each run takes in the files that came since the last one
    and not all of history. The number of the batch is part of the commit to Silver: a batch that
    comes again after a loss changes nothing. Options such as ``maxFilesPerTrigger`` bound a batch.
    """
    merged = []

    def merge(batch: DataFrame, marks: dict[str, int]) -> None:
        listings = silver(streaming.usable(batch), WIRE_LAYOUT)
        merged.append(sinks.merge_into(listings, lake.stream_silver, marks=marks).rows)

    # its schema is known: a location without a file yet has none to infer
    records = streaming.parse_messages(spark.createDataFrame([], "value string"))
    sources.make_folder(spark, lake.stream_bronze)
    bronze = spark.readStream.schema(records.schema).options(**options).parquet(lake.stream_bronze)
    streaming.drain_batches(bronze, merge, lake.silver_checkpoint, timeout)
    if commits.latest(spark, lake.stream_silver) is None:
        nothing = silver(streaming.usable(records), WIRE_LAYOUT)
        sinks.merge_into(nothing, lake.stream_silver)
    sources.show_table(spark, lake.stream_silver_table, lake.stream_silver)
    return sum(merged)


def _store_gold(df: DataFrame, lake: Lake, name: str) -> DataFrame:
    return sinks.save_table(df, lake.mart(name), f"{lake.gold}/{name}")


def build_gold(
    silver_rows: DataFrame,
    lake: Lake,
    layout: Layout = CSV_LAYOUT,
    table: str | None = None,
    counted: DataFrame | None = None,
) -> dict[str, int]:
    """Staging view, valid set and the four marts as tables, then all checks.

    The valid set is stored before anything is aggregated: four marts and a check
    read it, each only the columns it needs. ``counted`` are cells of the same listings
    (``plans.cells``) for the marts to read instead. ``table`` names the stored Silver for a
    staging view that all sessions see, beside the one of this session.
    """
    spark = silver_rows.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.gold_database}")
    stg = staging(silver_rows, layout)
    sinks.publish_view(stg, "stg_listings")
    if table:
        view = staging_sql(table, silver_rows.schema, layout)
        sinks.publish_lasting_view(spark, lake.mart("stg_listings"), view)
    valid = _store_gold(gold_valid(stg), lake, "int_listings_valid")

    rows, weight = (valid, None) if counted is None else (counted, cells.COUNT)
    by_make = _store_gold(gold.price_by_make(rows, weight=weight), lake, "mart_price_by_make")
    _store_gold(gold.price_by_state(rows, weight), lake, "mart_price_by_state")
    _store_gold(gold.price_by_year(rows, by_make, weight=weight), lake, "mart_price_by_year")
    _store_gold(gold.listings_summary(rows, weight), lake, "mart_listings_summary")
    try:
        return enforce(checks(stg, valid))
    except ChecksFailed:
        _store_gold(failing_rows(stg, valid), lake, "quality_failures")
        raise


def run_batch(
    spark: SparkSession, csv_path: str, lake: Lake, run: str | None = None, **options: str
) -> Report:
    """CSV to Bronze to Silver to Gold to checks (W1); options are the CSV reader's."""
    ledger = Ledger(spark, lake.runs, run or uuid.uuid4().hex)

    def stage(name: str, root: str, work: Callable[[], int]) -> tuple[int, int]:
        return tuple(ledger.step(name, lambda: [work(), commits.latest(spark, root).version]))

    report = Report()
    report.rows["bronze"], bronze = stage(
        "bronze", lake.batch_bronze, lambda: ingest_csv(spark, csv_path, lake, **options)
    )
    report.rows["silver"], version = stage(
        "silver", lake.batch_silver, lambda: build_silver(spark, lake, bronze)
    )
    listings = _stored(spark, lake.batch_silver, version)
    report.checks = ledger.step("gold", lambda: build_gold(listings, lake, table=lake.silver_table))
    return report


def run_stream(
    spark: SparkSession,
    csv_path: str,
    lake: Lake,
    timeout: int | None = None,
    send: Send | None = None,
    messages: DataFrame | None = None,
    run: str | None = None,
    **options: str,
) -> Report:
    """Produce, stream to Bronze, upsert Silver, Gold, checks (W2); options are the CSV reader's.

    ``send`` and ``messages`` are the two ends of a broker; without them files stand in.
    The marts are read off cells that follow the upsert; they show the newest Silver.
    """
    run = run or uuid.uuid4().hex
    ledger = Ledger(spark, lake.runs, run)
    sent = ledger.step("produce", lambda: produce(spark, csv_path, lake, send, run, **options))
    report = Report(rows=dict(sent))
    ledger.step("bronze", lambda: stream_bronze(spark, lake, timeout, messages))
    report.rows["silver"] = ledger.step("silver", lambda: upsert_silver(spark, lake, timeout))

    def marts() -> dict[str, int]:
        cells.refresh_cells(spark, lake.stream_silver, lake.stream_cells, WIRE_LAYOUT)
        return build_gold(
            commits.read(spark, lake.stream_silver),
            lake,
            WIRE_LAYOUT,
            lake.stream_silver_table,
            cells.stored_cells(spark, lake.stream_cells),
        )

    report.checks = ledger.step("gold", marts)
    return report
