"""Exact dedup by a tree of merges of sorted digest runs.

Every task turns its texts into SHA-256 digests, sorts them into a run and folds equal
ones to the identifier that stays and a count. Runs then move in rounds: in round r the
r-th digit (base FAN_IN) of a task's address is exchanged for that of the digest, so that
after the last round equal digests share an address. After each exchange Spark's external
sort merges the incoming runs and one streaming pass folds neighbours. A group of copies
is therefore down to one entry per task before it first moves and shrinks by FAN_IN each
round; no task ever holds a group. Entries fold only after a full comparison of 256 bits
and the byte length; the leading 64 bits only order them.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Rows that
repeat both identifier and text are all reported as kept; a null identifier stays only if
no other row of its group has one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common

FAN_IN = 8
DIGEST = ["d0", "d1", "d2", "d3"]
NO_ID = -(2**63)
RUN = "d0 long, d1 long, d2 long, d3 long, n_bytes long, keep long, n long, address int"


def digest_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, digest as four longs, n_bytes) of every normalised text."""

    def run(batches):
        for batch in batches:
            found, size = [], []
            for text in batch.column("text"):
                data = text.as_py().encode().lower()
                found.append(hashlib.sha256(data).digest())
                size.append(len(data))
            parts = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array(np.ascontiguousarray(parts[:, i])) for i in range(4)]
                + [pa.array(np.array(size, np.int64))],
                ["doc_id", *DIGEST, "n_bytes"],
            )

    return common.texts(docs).mapInArrow(
        run, "doc_id long, d0 long, d1 long, d2 long, d3 long, n_bytes long"
    )


def _fold(batches):
    """Fold neighbours that agree in digest and length; the last one waits for the next batch."""
    names = [*DIGEST, "n_bytes", "keep", "n", "address"]
    held = None
    for batch in batches:
        rows = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
        if held is not None:
            rows = [np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        new = np.zeros(len(rows[0]), bool)
        new[0] = True
        for column in rows[:5]:
            new[1:] |= column[1:] != column[:-1]
        at = np.flatnonzero(new)
        rows = [
            *(x[at] for x in rows[:5]),
            np.maximum.reduceat(rows[5], at),
            np.add.reduceat(rows[6], at),
            rows[7][at],
        ]
        held = [x[-1:] for x in rows]
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1]) for x in rows], names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)


def merge_runs(entries: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct digest: (digest, n_bytes, keep, n)."""
    wanted = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while fan_in**rounds < wanted:
        rounds += 1
    width = fan_in**rounds
    runs = entries.select(
        *DIGEST,
        "n_bytes",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("keep"),
        F.lit(1).cast("long").alias("n"),
        F.pmod(F.spark_partition_id(), F.lit(width)).cast("int").alias("address"),
    )
    order = [*DIGEST, "n_bytes"]
    runs = runs.sortWithinPartitions(*order).mapInArrow(_fold, RUN)
    for r in range(rounds):
        weight = fan_in**r
        digit = F.pmod(F.shiftright("d0", 8 * (r % 7)), F.lit(fan_in))
        own = F.pmod(F.floor(F.col("address") / weight), F.lit(fan_in))
        runs = (
            runs.withColumn("address", (F.col("address") + (digit - own) * weight).cast("int"))
            .repartition(wanted, "address")
            .sortWithinPartitions(*order)
            .mapInArrow(_fold, RUN)
        )
    return runs.drop("address")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    entries = common.store(digest_documents(docs), "digests")
    merged = common.store(merge_runs(entries), "runs")
    words = [F.lpad(F.lower(F.hex(F.col(x))), 16, "0") for x in DIGEST]
    keep = F.when(F.col("keep") != NO_ID, F.col("keep"))
    return entries.join(merged, [*DIGEST, "n_bytes"]).select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.concat(*words).alias("text_sha256"),
    )
