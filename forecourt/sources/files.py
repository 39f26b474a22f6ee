"""Batch scans: raw CSV and stored layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import commits, spec


def read_raw_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """Raw listings, every column as text unless ``schema`` says otherwise.

    Types are not inferred: that would read the whole input once more, and the
    same file could change type from day to day. The lenient casts of ``clean`` and
    ``classify`` take it from here. Column names come from the header. A path that
    does not exist raises ``AnalysisException`` right here (S3).

    A quote inside a quoted field is doubled, and a file whose header orders the
    columns differently from the others fails instead of being read by position.
    Files stay splittable; pass ``multiLine="true"`` for quoted line breaks, at the
    price of one task per file.
    """
    defaults = {"header": "true", "mode": "PERMISSIVE", "escape": '"', "enforceSchema": "false"}
    reader = spark.read.options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_checked_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Raw listings as text, and the line of each row that does not fit the header.

    A row with more or fewer cells than the header would otherwise be read by position, so
    that an unquoted comma moves the price into the year. Such a row has NULL in all columns
    but the corrupt-record one, which holds its text and is NULL in all other rows.
    """
    names = read_raw_csv(spark, path, **options).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, spec.CORRUPT]])
    # all cells are parsed: a pruned read would not notice that there are too many
    checked = {**options, "columnPruning": "false", "columnNameOfCorruptRecord": spec.CORRUPT}
    rows = read_raw_csv(spark, path, schema, **checked)
    fits = F.col(spec.CORRUPT).isNull()
    return rows.select(*(F.when(fits, F.col(f"`{n}`")).alias(n) for n in names), spec.CORRUPT)


def read_layer(
    spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """A stored Bronze or Silver location.

    The newest version of a location that keeps commits; its columns are those of all
    writes. For plain files ``merge_schema`` unions columns over those written by
    successive appends. It opens every footer, so it is off unless a layer is known to have
    grown columns.
    """
    snapshot = commits.latest(spark, path) if fmt == "parquet" else None
    if snapshot:
        return commits.read(spark, path, snapshot)
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def list_names(spark: SparkSession, path: str) -> list[str]:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(location))


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Give a file its final name; one that has arrived there before stays."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(new) and not files.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(location)


def existing_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns of the parquet data at ``path``, or None when there is none yet.

    Without commits every footer counts, as appends may have added columns.
    """
    snapshot = commits.latest(spark, path)
    if snapshot:
        return snapshot.schema
    # Asked of the file system: a read that fails is logged as an error by every
    # listener of the session, also when the failure is expected.
    if not path_exists(spark, path):
        return None
    try:
        return read_layer(spark, path, merge_schema=True).schema
    except AnalysisException as problem:
        # a folder that a first write left without a file
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
