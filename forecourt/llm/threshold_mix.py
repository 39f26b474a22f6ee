"""Mix sources to target weights with hash thresholds.

A target of several times a source's size takes all its documents so many times; what is left
is the budget of one further copy, which goes to the documents with the smallest hashes. The
threshold of a source is found without sorting: its words are summed by the top 12 bits of the
hash, the bucket in which the running sum passes the budget is the boundary bucket, and only
that bucket is summed again by the next 12 bits, until a single hash is left. The thresholds of
the copies nest: a document that a further copy takes is in all earlier copies.

The document at the threshold does not fit. If what is left of the budget, or what the document
has over it, is within TOLERANCE of the target, the search ends there; else the document is
passed over and a further threshold is looked for beyond it with what is left of the budget,
PASSES times at most. In the end the smallest document passed over is taken if that is nearer.
Large sources end in the first pass.

Targets are min(3 * size, level * weight) with one level for all sources, reached by taking out
the sources above their stop and sharing what they leave, as sums over the table of sources.
Ranks of sources come from a range-partitioned sort and the row counts of its partitions.

Hot sources: sums are folded before they are shuffled; joins with the table of sources, which
Spark broadcasts if its stored size is small, are salted by the hash otherwise.

The hash is that of doc_id and text, so a re-run, on any partitioning, takes the same rows. Rows
that are equal in both and in the source share their place and are taken or left together.
Null texts are empty and have size 0; rows of size 0 are taken 0 words. The null source is a
source of its own, the last. An empty table gives no rows. Long texts are counted whole, and
documents are never split. Other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm import common

MOST = 3  # times a document may be taken
WEIGHTS = (1, 2, 3)
TOLERANCE = 500  # a target is met when less than one part in so many is missing
PASSES = 6
DIGITS = 15  # hexadecimal digits of the hash
LEVELS = (48, 36, 24, 12, 0)  # bits below each level's bucket
SALTS = 64


def place_of(doc_id: Column, text: Column) -> Column:
    """60 bits of MD5."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), text)
    return F.conv(F.substring(F.md5(name), 1, DIGITS), 16, 10).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, key, size, place of every row. Keys sort as sources do, null last."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        place_of(F.col("doc_id"), text).alias("place"),
    )


def ranked(rows: DataFrame) -> DataFrame:
    """key, source_size, weight: sources in order, weighed in turn."""
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    sorted_ = common.store(
        sizes.orderBy("key").withColumn("id", F.monotonically_increasing_id()), "mix-sorted"
    )
    block = F.shiftright("id", 33)
    counts = sorted_.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("n"))
    # one row for each partition of the sort
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.col("first") + F.col("id").bitwiseAND((1 << 33) - 1)
    return sorted_.withColumn("block", block).join(starts, "block").select(
        "key",
        "source_size",
        F.element_at(
            F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int")
        ).cast("long").alias("weight"),
    )


def with_targets(sources: DataFrame) -> DataFrame:
    """Targets: all words by weight, none above MOST times its source."""

    def above(words: int, weight: int) -> Column:
        return F.col("weight") * F.lit(Decimal(words)) > MOST * F.col("source_size") * F.lit(
            Decimal(weight)
        )

    def sums(where: Column) -> tuple[int, int]:
        found = sources.filter(where).agg(F.sum("source_size"), F.sum("weight")).head()
        return int(found[0] or 0), int(found[1] or 0)

    total, all_weights = sums(F.lit(True))
    words, weight, last = total, all_weights, None
    while (words, weight) != last:
        last = words, weight
        full, taken = sums(above(words, weight))
        words, weight = total - MOST * full, all_weights - taken
    level = F.col("weight") * F.lit(words) / F.lit(float(max(weight, 1)))
    stop = (MOST * F.col("source_size")).cast("double")
    target = F.when(above(words, weight), stop).otherwise(F.least(level, stop))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return (
        sources.withColumn("target", target)
        .withColumn("copies", F.coalesce(whole, F.lit(0)).cast("long"))
        .withColumn(
            "budget",
            F.floor(F.col("target") - F.col("copies") * F.col("source_size") + 0.5).cast("long"),
        )
        .withColumn("tolerance", F.floor(F.col("target") / TOLERANCE).cast("long"))
    )


def _salted(rows: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """Join rows with a table of one row a key; a hot key is dealt to SALTS parts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return rows.withColumn("salt", (F.col("place") % SALTS).cast("int")).join(
        few.withColumn("salt", salts), [*on, "salt"]
    ).drop("salt")


def boundaries(rows: DataFrame, state: DataFrame) -> DataFrame:
    """(key, place, before, size): the first hash beyond `after` that passes the budget.

    state has key, after, budget. Keys whose remaining rows all fit have no row.
    """
    found = []
    todo = state.select("key", "after", "budget", F.lit(0).cast("long").alias("before"))
    on, part = ["key"], rows
    for level, shift in enumerate(LEVELS):
        part = _salted(part, todo, on).filter(F.col("place") > F.col("after"))
        part = part.withColumn("bucket", F.shiftright("place", shift))
        if level:
            part = common.store(part, "mix-bucket")
        sums = part.groupBy("key", "after", "budget", "before", "bucket").agg(
            F.sum("size").alias("size"),
            F.min("place").alias("least"),
            F.max("place").alias("most"),
        )
        running = Window.partitionBy("key").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        end = F.col("before") + F.sum("size").over(running)
        passed = sums.withColumn("end", end).withColumn("before", F.col("end") - F.col("size"))
        at = common.store(
            passed.filter((F.col("before") <= F.col("budget")) & (F.col("end") > F.col("budget"))),
            "mix-boundary",
        )
        one = F.col("least") == F.col("most")
        found.append(at.filter(one).select("key", F.col("least").alias("place"), "before", "size"))
        todo = at.filter(~one).select("key", "after", "budget", "before", "bucket")
        if todo.isEmpty():
            break
        on, part = ["key", "bucket"], part.select("key", "size", "place", "bucket")
    return reduce(DataFrame.unionByName, found)


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(key, taken): intervals of hashes, (above, up to), that get one further copy."""
    rows = rows.filter("size > 0").select("key", "size", "place")
    state = sources.filter("budget > 0").select(
        "key", F.lit(-1).cast("long").alias("after"), "budget", "tolerance"
    )
    steps = []
    for _ in range(PASSES):
        at = boundaries(rows, state)
        left = F.col("budget") - F.coalesce("before", F.lit(0))
        passed = F.col("place").isNotNull()
        accept = passed & (left > F.col("tolerance")) & (
            F.col("size") - left <= F.col("tolerance")
        )
        upto = F.when(~passed, (1 << 4 * DIGITS) - 1).when(accept, F.col("place")).otherwise(
            F.col("place") - 1
        )
        step = common.store(
            state.join(at, "key", "left").select(
                "key",
                "after",
                upto.alias("upto"),
                "place",
                "size",
                left.alias("budget"),
                "tolerance",
                (passed & ~accept & (left > F.col("tolerance"))).alias("open"),
            ),
            "mix-threshold",
        )
        steps.append(step)
        state = step.filter("open").select(
            "key", F.col("place").alias("after"), "budget", "tolerance"
        )
        if state.isEmpty():
            break
    found = common.store(
        reduce(DataFrame.unionByName, steps).groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("after", "upto"))).alias("taken"),  # PASSES
            F.min(F.when(F.col("open"), F.struct("size", "place"))).alias("over"),
        ),
        "mix-taken",
    )
    again = found.filter(F.col("over").isNotNull())
    if again.isEmpty():
        return found.select("key", "taken")
    sums = (
        _salted(rows, again, ["key"])
        .filter(_inside(F.col("place"), F.col("taken")))
        .groupBy("key")
        .agg(F.sum("size").alias("sum"))
    )
    left = F.col("budget") - F.coalesce("sum", F.lit(0))
    nearer = (left > F.col("tolerance")) & (F.col("over.size") < 2 * left)
    own = F.array(F.struct((F.col("over.place") - 1).alias("after"), F.col("over.place").alias("upto")))
    return (
        found.join(sources.select("key", "budget", "tolerance"), "key")
        .join(sums, "key", "left")
        .select("key", F.when(nearer, F.concat("taken", own)).otherwise(F.col("taken")).alias("taken"))
    )


def _inside(place: Column, taken: Column) -> Column:
    return F.exists(taken, lambda x: (place > x["after"]) & (place <= x["upto"]))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row."""
    rows = common.store(measured(docs), "mix-rows")
    sources = common.store(with_targets(common.store(ranked(rows), "mix-ranked")), "mix-sources")
    plan = common.store(
        sources.join(thresholds(rows, sources), "key", "left").select(
            "key", "source_size", "target", "copies", "taken"
        ),
        "mix-plan",
    )
    further = F.coalesce(_inside(F.col("place"), F.col("taken")), F.lit(False))
    times = F.col("copies") + further.cast("long")
    return _salted(rows, plan, ["key"]).select(
        "doc_id",
        F.when(F.col("key") != "1", F.col("key").substr(F.lit(2), F.length("key"))).alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("size") * times).alias("taken"),
    )
