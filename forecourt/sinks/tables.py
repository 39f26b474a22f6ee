"""Views, tables and the upsert into a table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import commits
from forecourt.commits import BUCKET, Snapshot, TypeClash
from forecourt.sinks.counting import counted, observed
from forecourt.sources.catalog import register_location, show_table, table_exists

__all__ = ["DuplicateKeys", "Merge", "TypeClash", "merge_into", "publish_lasting_view",
           "publish_view", "save_table", "upsert_table"]

BUCKETS = 16
# Folders of one bucket before an upsert that touches it writes it anew as a whole.
MOST_PARTS = 8
ATTEMPTS = 5
# Keys of a source that are compared first, without a shuffle.
SOME_KEYS = 20_000
_SLICE, _NEW, _NTH = "in_slice_of_bucket", "from_source", "copy_of_key"


class DuplicateKeys(Exception):
    """The source of an upsert has several rows for one key."""


@dataclass(frozen=True)
class Merge:
    """What an upsert did: rows merged, and folders written anew or left as they were."""

    rows: int
    version: int
    rewritten: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)
    done_before: bool = False


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def publish_lasting_view(spark: SparkSession, name: str, query: str) -> None:
    """A view in the catalog, for all sessions; replacing it is one step (K7)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def save_table(
    df: DataFrame, name: str, root: str, marks: dict[str, int] | None = None
) -> DataFrame:
    """Full refresh of a table kept under ``root``; returns the stored table (K8).

    The refresh is one commit, and the name then shows it, so a refresh that dies
    leaves the rows as they were and another process can refresh again.
    Rows are stored without an order: readers sort, since a table keeps none.
    """
    spark = df.sparkSession
    snapshot = commits.overwrite(df, root, lambda rows, path: rows.write.parquet(path), marks)
    show_table(spark, name, root)
    return commits.read(spark, root, snapshot)


def upsert_table(
    source: DataFrame, table: str, root: str, key: str = "id", fmt: str = "parquet",
    buckets: int = BUCKETS,
) -> int:
    """Merge ``source`` into ``table``, creating it on the first load; counts its rows.

    With ``fmt="delta"`` the connector's MERGE does the work in place, otherwise
    ``merge_into`` below. The target is the newest version under ``root``, whether or not
    this session's catalog knows the table.
    """
    if fmt == "delta":
        return counted(source, lambda rows: _merge_delta(rows, table, root, key))
    merge = merge_into(source, root, key, buckets)
    show_table(source.sparkSession, table, root)
    return merge.rows


def merge_into(
    source: DataFrame,
    root: str,
    key: str = "id",
    buckets: int = BUCKETS,
    marks: dict[str, int] | None = None,
) -> Merge:
    """Upsert by copy on write: only folders that hold a key of the source are written anew.

    The source is written first, in hash buckets of the key. Of the target only the
    buckets it falls into are looked at, and there only the key column, to find the
    folders with a matching row. Their other rows are written to a new folder; all other
    folders are listed again as they are, so the cost follows the folders touched and not
    the table. Keys that are new to the table rewrite nothing. A bucket that would have
    more than MOST_PARTS folders is written anew as a whole.

    ``buckets`` counts for the first load and stays: about one for each 10 GB the table
    will grow to keeps a rewrite small. Rows without a key never match, and are only added.

    A writer that was overtaken keeps its result if nobody changed its buckets, and
    merges again with the newer rows if somebody did. ``marks`` say what the source stands
    for, such as a batch of a stream; if the table has taken that in, nothing happens.
    """
    spark, root, marks = source.sparkSession, root.rstrip("/"), marks or {}
    base = commits.latest(spark, root)
    if commits.taken_in(base, marks):
        return Merge(0, base.version, kept=base.folders(), done_before=True)
    if base:
        commits.widened(base.schema, source.schema)
    own, n = commits.new_write(), base.buckets if base else buckets
    rows, copies = _write(source, f"{root}/data/{own}", key, n)
    if copies > 1:
        raise DuplicateKeys(f"{key} is not unique in the rows to merge into {root}")
    added = commits.written_buckets(spark, root, own)
    written = commits.read_folders(
        spark, root, [commits.folder(b, own) for b in added], source.schema
    )

    for _ in range(ATTEMPTS):
        base = commits.latest(spark, root)
        if base and base.buckets != n:
            raise commits.Conflict(f"{root} has been created with {base.buckets} buckets meanwhile")
        anew = _to_rewrite(spark, root, base, written, added, key, rows) if base else []
        again = commits.new_write()
        if anew:
            old = commits.read_folders(spark, root, anew, base.schema)
            _store(_left(old, written, key, n), f"{root}/data/{again}")
        copied = commits.written_buckets(spark, root, again)

        def change(newest: Snapshot | None) -> Snapshot | None:
            if commits.taken_in(newest, marks):
                return None
            if newest and base and any(newest.parts.get(b) != base.parts.get(b) for b in added):
                raise _Overtaken
            if newest and not base:
                raise _Overtaken
            start = newest or Snapshot(0, T.StructType(), buckets=n)
            parts = dict(start.parts)
            for b in added:
                left = [w for w in parts.get(b, []) if commits.folder(b, w) not in anew]
                parts[b] = [*left, *([again] if b in copied else []), own]
            return replace(
                start,
                schema=commits.widened(start.schema, source.schema),
                parts=parts,
                marks={**start.marks, **marks},
            )

        try:
            now = commits.commit(spark, root, change)
        except _Overtaken:
            continue
        new = {commits.folder(b, w) for b in [*added, *copied] for w in (own, again)}
        kept = [x for x in now.folders() if x not in new]
        mine = own in now.parts.get(added[0], []) if added else True
        return Merge(rows if mine else 0, now.version, sorted(anew), kept, not mine)
    raise commits.Conflict(f"{root}: overtaken in the same buckets {ATTEMPTS} times")


class _Overtaken(Exception):
    """Another writer has changed a bucket that this one has read."""


def _write(df: DataFrame, path: str, key: str, buckets: int) -> tuple[int, int]:
    """Rows written, and how many of them the most frequent key has."""
    nth = F.row_number().over(Window.partitionBy(BUCKET, _SLICE, key).orderBy(key))
    found = observed(
        _dealt(df, key, buckets).withColumn(_NTH, F.when(F.col(key).isNotNull(), nth)),
        lambda rows: _store(rows.drop(_SLICE, _NTH), path),
        rows=F.count(F.lit(1)),
        copies=F.max(_NTH),
    )
    return found["rows"], found["copies"] or 0


def _store(placed: DataFrame, path: str) -> None:
    placed.write.partitionBy(BUCKET).parquet(path, compression="zstd")


def _dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows by bucket and slice, for a write with few files a bucket.

    A slice is a share of a bucket that one task can take. Rows with one key are in one slice, so
    that keys can be compared there without a second shuffle; those without a key are spread.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = 2 * -(-parts // buckets)
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    spread = F.xxhash64(F.lit(_SLICE), *(F.col(f"`{c}`") for c in plain))
    own = F.when(F.col(key).isNull(), spread).otherwise(F.xxhash64(F.lit(_SLICE), F.col(key)))
    return df.withColumns(
        {BUCKET: commits.bucket_of(F.col(key), buckets), _SLICE: F.pmod(own, F.lit(slices))}
    ).repartition(BUCKET, _SLICE)


def _left(old: DataFrame, written: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows of ``old``, all of them with a key, that ``written`` does not replace, in their buckets."""
    replaced = written.select(key).filter(F.col(key).isNotNull()).withColumn(_NEW, F.lit(True))
    both = old.withColumn(_NEW, F.lit(False)).unionByName(replaced, allowMissingColumns=True)
    same_key = Window.partitionBy(BUCKET, _SLICE, key)
    return (
        _dealt(both, key, buckets)
        .withColumn(_NEW, F.max(_NEW).over(same_key) | F.col(_NEW))
        .filter(~F.col(_NEW))
        .drop(_NEW, _SLICE)
    )


def _to_rewrite(
    spark: SparkSession, root: str, base: Snapshot, written: DataFrame, added: list[int], key: str,
    rows: int,
) -> list[str]:
    """Folders of the target that hold a key of the source, or belong to a crowded bucket."""
    keyed = [b for b in added if b != base.buckets]
    parts = {commits.folder(b, w): b for b in keyed for w in base.parts.get(b, [])}
    if not parts:
        return []
    only_key = T.StructType([base.schema[key]])
    where = F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+/[^/]+)/[^/]+$", 1)

    def keys(folders: list[str]) -> DataFrame:
        return commits.read_folders(spark, root, folders, only_key).select(key, where.alias("part"))

    def hit(some: DataFrame, new: DataFrame) -> set[str]:
        rows = some.join(new.select(key), key, "left_semi").select("part").distinct().collect()
        return {row["part"] for row in rows}  # folders, not rows

    # some keys show most folders that have to be written anew; the others are compared whole
    found = hit(keys(list(parts)), F.broadcast(written.sample(min(1.0, SOME_KEYS / max(rows, 1)), 7)))
    unknown = [x for x in parts if x not in found]
    if unknown and rows > SOME_KEYS:
        found |= hit(keys(unknown), written)
    for b in keyed:
        own = [x for x, bucket in parts.items() if bucket == b]
        if len(own) + 1 + any(x in found for x in own) > MOST_PARTS:
            found.update(own)
    return sorted(found)


def _merge_delta(source: DataFrame, table: str, root: str, key: str) -> None:
    from delta.tables import DeltaTable  # only with the Delta connector installed

    spark = source.sparkSession
    if not DeltaTable.isDeltaTable(spark, root):
        source.write.format("delta").mode("overwrite").save(root)
        register_location(spark, table, root, "delta")
        return
    if not table_exists(spark, table):
        register_location(spark, table, root, "delta")
    merge = DeltaTable.forPath(spark, root).alias("old").merge(
        source.alias("new"), f"old.`{key}` = new.`{key}`"
    )
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
