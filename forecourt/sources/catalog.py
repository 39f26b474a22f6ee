"""Catalog names for stored data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecourt import commits

FOLDER = "in_folder"


def register_location(
    spark: SparkSession, table: str, location: str, fmt: str = "parquet"
) -> None:
    """Give an existing location a name such as ``silver.listings``."""
    _database_of(spark, table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{location}'")


def show_table(spark: SparkSession, name: str, root: str) -> None:
    """Make ``name`` show the newest version of the data under ``root`` (K5, K7, K8).

    The folders of the version are partitions of a catalog table beside it, and ``name`` is a
    lasting view of the current ones. Replacing the view is one step of the catalog,
    so a reader never sees folders of two versions. No data is touched.
    """
    snapshot = commits.latest(spark, root)
    _database_of(spark, name)
    folders = f"{name}_folders"
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema]
    if not table_exists(spark, folders):
        spark.sql(
            f"CREATE TABLE {folders} ({', '.join(columns)}, {FOLDER} STRING) "
            f"USING parquet PARTITIONED BY ({FOLDER}) LOCATION '{root.rstrip('/')}/data'"
        )
    known = set(spark.table(folders).columns)
    new = [text for f, text in zip(snapshot.schema, columns, strict=True) if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {folders} ADD COLUMNS ({', '.join(new)})")
    current = snapshot.folders()
    if current:
        parts = [f"PARTITION ({FOLDER}='{x}') LOCATION '{root.rstrip('/')}/data/{x}'" for x in current]
        spark.sql(f"ALTER TABLE {folders} ADD IF NOT EXISTS {' '.join(parts)}")
    listed = ", ".join(f"'{x}'" for x in current) or "NULL"
    shown = ", ".join(f"`{f.name}`" for f in snapshot.schema)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM {folders} WHERE {FOLDER} IN ({listed})"
    )


def forget(spark: SparkSession, name: str) -> None:
    """Drop what ``show_table`` has put into the catalog; the data stays."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}_folders")


def _database_of(spark: SparkSession, name: str) -> None:
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def load_mart(spark: SparkSession, table: str) -> DataFrame:
    """A whole mart, for serving."""
    return spark.table(table)
