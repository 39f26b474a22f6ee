"""What each order of five filters removes, audited over all 120 orders at once.

A document fails a set of filters, its mask. Under an order of the filters it goes at the
first filter of its mask. The orders that begin with the same letters have consecutive
Lehmer ranks, so for each mask and step the orders that remove it there are a few intervals
of ranks. The counts of a mask are added at the start of each of its intervals and taken off
at the end; a prefix sum over the 120 ranks then gives what every step of every order removes.

The texts are read once: each row becomes (doc_id, part, digest of the text, mask of A to D),
which is stored. Filter E compares the doc_id with the smallest one of equal texts. That is
an aggregate over the digest, which Spark folds before it shuffles, so a text that a third of
all rows share is one row of each task. From there on only (part, mask) counts are left, at
most 32 rows a part.

Null texts are empty, null langs are the part ''. Texts with equal SHA-256 are the same text.
A row without doc_id passes E, has no label, and makes no other row fail. Rows that repeat a
doc_id count one by one; repeats of the smallest doc_id of a text all pass E. A label counts
if any label row of the doc_id says so; other label values and null doc_ids are ignored. An
empty table has no parts and gives no rows. Long texts are read whole. Other columns of either
table are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.llm import common

LETTERS = "ABCDE"
ORDERS = factorial(len(LETTERS))
SEPARATOR = r"[\x20\x09-\x0D]+"


def mask_of(text: Column, words: Column) -> Column:
    """Filters A to D as bits, A lowest."""
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        count < 200,
        100 * distinct < 50 * count,
        100 * capitals > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest, mask (A to D) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, SEPARATOR), "").alias("words"),
    )
    return rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        mask_of(F.col("text"), F.col("words")).alias("mask"),
    )


def with_repeats(rows: DataFrame) -> DataFrame:
    """The mask with E: a smaller doc_id has the same text."""
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "first", F.lit(True)
    )
    passes = F.col("doc_id").isNull() | F.col("first").isNotNull()
    e = F.when(passes, 0).otherwise(1 << LETTERS.index("E"))
    return rows.join(first, ["doc_id", "digest"], "left").select(
        "doc_id", "part", (F.col("mask") + e).alias("mask")
    )


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic: all that the orders need to know."""
    known = (
        labels.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.col("quality").cast("int") == 1).cast("int").alias("good"),
            (F.col("toxic").cast("int") == 1).cast("int").alias("toxic"),
        )
        .filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return (
        rows.join(known, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("docs"), total("good"), total("toxic"))
    )


def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, end rank) of the orders that remove the mask at that step."""
    found = []

    def extend(used: tuple[int, ...], rank: int) -> None:
        left = [i for i in range(len(LETTERS)) if i not in used]
        block = factorial(len(left) - 1)
        for smaller, letter in enumerate(left):
            start = rank + smaller * block
            if mask >> letter & 1:
                found.append((len(used) + 1, start, start + block))
            else:
                extend((*used, letter), start)

    if mask:
        extend((), 0)
    return found


def _plan(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The intervals of all masks; filter and name of each step of each rank. Fixed size."""
    ends = [(m, *x) for m in range(1, 1 << len(LETTERS)) for x in intervals(m)]
    steps = [
        (rank, step, "".join(order), LETTERS.index(letter))
        for rank, order in enumerate(permutations(LETTERS))
        for step, letter in enumerate(order, 1)
    ]
    return (
        spark.createDataFrame(ends, "mask int, step int, start int, end int"),
        spark.createDataFrame(steps, "rank int, step int, filter_order string, letter int"),
    )


def all_orders(counts: DataFrame) -> DataFrame:
    """The audit of 120 orders of five steps for each part of (part, mask, docs, good, toxic)."""
    ends, steps = _plan(counts.sparkSession)
    values = ["docs", "good", "toxic"]
    at = lambda where, sign: F.struct(
        F.col(where).alias("rank"), *((sign * F.col(v)).alias(v) for v in values)
    )
    changes = (
        counts.join(F.broadcast(ends), "mask")
        .select("part", "step", F.explode(F.array(at("start", 1), at("end", -1))).alias("at"))
        .select("part", "step", "at.*")
        .filter(F.col("rank") < ORDERS)
    )
    n_steps = len(LETTERS)
    zeros = (
        counts.select("part").distinct()
        .select("part", F.explode(F.sequence(F.lit(0), F.lit(ORDERS * n_steps - 1))).alias("cell"))
        .select(
            "part",
            (F.col("cell") % n_steps + 1).alias("step"),
            F.floor(F.col("cell") / n_steps).cast("int").alias("rank"),
            *(F.lit(0).cast("long").alias(v) for v in values),
        )
    )
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    removed = (
        changes.unionByName(zeros)
        .groupBy("part", "step", "rank")
        .agg(*(F.sum(v).alias(v) for v in values))
        .select("part", "step", "rank", *(F.sum(v).over(ranks).alias(v) for v in values))
        .join(F.broadcast(steps), ["rank", "step"])
    )
    fails = lambda i: F.col("mask").bitwiseAND(1 << i) != 0
    alone = lambda i: F.col("mask") == 1 << i
    of = lambda test: F.array(
        *(F.sum(F.when(test(i), F.col("docs")).otherwise(0)) for i in range(n_steps))
    )
    parts = counts.groupBy("part").agg(
        F.sum("docs").alias("total"), of(fails).alias("fails"), of(alone).alias("alone")
    )
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    letter = F.col("letter") + 1
    return removed.join(parts, "part").select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("docs").over(so_far)).alias("kept"),
        F.col("docs").alias("removed"),
        (F.element_at("fails", letter) - F.col("docs")).alias("redundant"),
        F.element_at("alone", letter).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("docs").over(Window.partitionBy("part", "letter")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of that step, for every part and order."""
    rows = common.store(judged(docs), "audit-rows")
    return all_orders(common.store(mask_counts(with_repeats(rows), labels), "audit-masks"))
