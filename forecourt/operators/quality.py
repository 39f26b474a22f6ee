"""Data-quality assertions as one small result table (Q1-Q6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ChecksFailed(Exception):
    """At least one data-quality check found offending rows."""


def staging_checks(stg: DataFrame) -> DataFrame:
    """Q1-Q4 in one pass and one shuffle.

    Everything is first folded to one row per id with map-side combine, which is
    enough to answer the uniqueness check and carries the NULL counts along. A hot
    id, or all the rows without one, arrive as one partial row per map task.
    """
    per_id = stg.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(F.col("price").isNull()).alias("no_price"),
        F.count_if(F.col("make").isNull()).alias("no_make"),
    )
    totals = per_id.agg(
        F.count_if(F.col("id").isNotNull() & (F.col("copies") > 1)).alias("unique_id"),
        F.sum(F.when(F.col("id").isNull(), F.col("copies"))).alias("not_null_id"),
        F.sum("no_price").alias("not_null_price"),
        F.sum("no_make").alias("not_null_make"),
    )
    return _as_rows(totals)


def valid_checks(valid: DataFrame) -> DataFrame:
    """Q5: no non-positive price in the Gold input."""
    return _as_rows(valid.agg(F.count_if(F.col("price") <= 0).alias("price_positive")))


def _as_rows(totals: DataFrame) -> DataFrame:
    names = totals.columns
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("failures"),
                    )
                    for name in names
                ]
            )
        )
    )


def failing_rows(stg: DataFrame, valid: DataFrame) -> DataFrame:
    """Every offending row of Q1-Q5 once per check it breaks: ``check_name`` and its columns.

    Repeated ids are found from one folded row per id, the only shuffle, and marked on
    the rows by a join that does not move them while those ids are few. All other checks look at
    a row alone. Rows without an id match nothing and are dealt out by their content, should
    the join be a shuffled one. ``valid`` may lack columns that ``stg`` has, they are NULL then.
    """
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64(*stg.columns), F.lit(1000))).otherwise(0)
    ids = stg.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    repeated = ids.filter("copies > 1").select(
        "id", F.lit(0).cast("long").alias("spread"), F.lit(True).alias("repeated")
    )
    broken = {
        "unique_id": F.col("repeated"),
        "not_null_id": F.col("id").isNull(),
        "not_null_price": F.col("price").isNull(),
        "not_null_make": F.col("make").isNull(),
    }
    names = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in broken.items())))
    in_staging = (
        stg.withColumn("spread", spread)
        .join(repeated, ["id", "spread"], "left")
        .withColumn("check_name", F.explode(names))
        .select("check_name", *stg.columns)
    )
    in_valid = valid.filter(F.col("price") <= 0).withColumn("check_name", F.lit("price_positive"))
    return in_staging.unionByName(in_valid, allowMissingColumns=True)


def checks(stg: DataFrame, valid: DataFrame) -> DataFrame:
    """Every check with the number of offending values or rows (Q6)."""
    return staging_checks(stg).unionByName(valid_checks(valid))


def enforce(report: DataFrame) -> dict[str, int]:
    """Raise when any check failed. The report has one row per check, so collecting it is safe."""
    found = {row["check_name"]: row["failures"] for row in report.collect()}
    broken = {name: n for name, n in found.items() if n}
    if broken:
        raise ChecksFailed(f"data-quality checks failed: {broken}")
    return found
