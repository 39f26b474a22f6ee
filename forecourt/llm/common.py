"""What several operators need: inputs, stored intermediate tables, word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import scratch

CHUNK_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="forecourt-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) only, so that extra columns cannot clash; a null text is empty."""
    ship(docs.sparkSession)
    return docs.select(
        F.col(key).cast("long").alias(key),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there."""
    path = scratch.new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def filtered_joins(spark: SparkSession):
    """Within, Spark filters the large side of a shuffled join of any size by a Bloom filter.

    The filter is Spark's own, of bounded size, built from the keys of the other side where a
    condition narrows that. It saves moving rows that cannot match; where it is full it saves less.
    """
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions_for(df: DataFrame, column: str, bytes_each: int) -> int:
    """How many parts of about bytes_each the column makes."""
    total = df.agg(F.sum(F.octet_length(F.col(column)))).head()[0] or 0
    return max(1, -(-int(total) // bytes_each))


def lowest(df: DataFrame, order: str, size: int) -> DataFrame:
    """The `size` rows with the smallest order, a column of 64-bit hashes.

    Counting comes first, and only the share of hashes that holds over four times as many
    rows is sorted, so that what reaches the driver does not grow with the tasks. Rows that
    share one hash count as one.
    """
    total, wanted = df.count(), 4 * size + 64
    if total > wanted:
        df = df.filter(F.col(order) < -(2**63) + 2**64 * wanted // total)
    return df.dropDuplicates([order]).orderBy(order).limit(size)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return starts - starts[0], raw[starts[0] : starts[-1]]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of about size bytes; a longer row is a run of its own."""
    at, last = 0, len(offsets) - 1
    while at < last:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), last)
        yield at, end
        at = end


_RANDOM = np.random.default_rng(20240607)
BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# The bytes that separate words.
WORD_BYTE = np.ones(256, bool)
for _a, _b in ((0, 48), (58, 65), (91, 97), (123, 128)):
    WORD_BYTE[_a:_b] = False
SPACE_BYTE = np.zeros(256, bool)
SPACE_BYTE[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def matrix_powers(step: np.ndarray, times: np.ndarray) -> np.ndarray:
    """step ** t for each t, each scaled to at most 1, by squaring: no bound on t."""
    wanted, at = np.unique(times, return_inverse=True)
    out = np.broadcast_to(np.eye(len(step)), (len(wanted), *step.shape)).copy()
    square, left = step / step.max(), wanted.copy()
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] @ square
        out[odd] /= out[odd].max((1, 2), keepdims=True)
        square = square @ square
        square /= square.max()
        left >>= 1
    return out[at]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a run of texts: runs of word bytes, A-Z lower-cased, with 64-bit hashes."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, word_byte: np.ndarray = WORD_BYTE):
        self.data, base = data, offsets[0]
        offsets = offsets - base
        inside = word_byte[data]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        first = offsets[:-1][offsets[:-1] < len(data)]
        before[first] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        after[last] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.start, offsets)
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[LOWER[data]] * powers(BASE, len(data)), out=prefix[1:])
        self.prefix, self.unshift = prefix, powers(BASE_INVERSE, len(data) + 1)
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.unshift[start])


def shingle(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of each run of n words that stays within one text."""
    size = max(len(words) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = mix(out * BASE + words[i : i + size])
    whole = doc[:size] == doc[n - 1 : n - 1 + size]
    return out[whole], doc[:size][whole]
