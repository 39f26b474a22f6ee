"""Stupid-backoff scores from n-gram counts over all documents.

Texts are packed into blocks of about BLOCK_BYTES, which move once, to the tasks that will
score them. The rows of a task are packed in a fixed order, so that a block that has to be
built again after a loss is the same block. Each block's distinct n-grams (64-bit hashes, sorted) are sliced by hash and each slice goes to the partition
of the count table that owns its hash range. There the slices merge, counts add up, and
the totals of a slice go back to its block, where they are joined to the block's exploded
n-grams and the logarithms are summed per document. A frequent n-gram is one entry per
block, so no partition grows with its frequency, and entries move as packed, compressed
slices rather than as rows.

Words are runs of letters and digits, A-Z lower-cased. An n-gram of two or more words is
in the tables if it occurs MIN_COUNT times in the corpus. The score of a word is the count
of the longest n-gram that ends with it and is in the tables over the count of its
context, times ALPHA for each word of context given up; a single word counts against all
words. A document's score is the mean decimal logarithm, 0 for a text without words (null
and empty ones). Repeated rows count and are scored as documents of their own; a null
doc_id changes nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common

ORDER, ALPHA, MIN_COUNT = 3, 0.4, 2
BLOCK_BYTES = 8 << 20
PARTITION_BYTES = 4 << 20
PACKED = "block long, ids array<long>, ends array<long>, data binary, size long"


PACKER = pa.Codec("zstd", compression_level=9)


def _press(data: bytes) -> bytes:
    return PACKER.compress(data, asbytes=True)


def _press_numbers(values: np.ndarray) -> bytes:
    """64-bit numbers, the bytes of equal weight together: most of those are zeros."""
    return _press(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _numbers(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view("<u8").ravel()


def _word_count(offsets: np.ndarray, data: np.ndarray) -> int:
    """Places where a word begins: after another kind of byte or at the start of a text."""
    inside = common.WORD_BYTE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = (offsets[:-1] - offsets[0])[np.diff(offsets) > 0]
    starts[heads] = inside[heads]
    return int(starts.sum())


def _measure(batches):
    """Bytes and words of each run of texts."""
    for batch in batches:
        offsets, data = common.buffers(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(data)], pa.int64()), pa.array([_word_count(offsets, data)], pa.int64())],
            ["size", "words"],
        )


def _pack(batches):
    """Blocks of whole texts."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        offsets, data = common.buffers(batch.column("text"))
        ids = batch.column("doc_id")
        for a, b in common.chunks(offsets, BLOCK_BYTES):
            raw = data[offsets[a] : offsets[b]].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                    pa.array([(offsets[a + 1 : b + 1] - offsets[a]).tolist()], pa.list_(pa.int64())),
                    pa.array([_press(raw)], pa.binary()),
                    pa.array([len(raw)], pa.int64()),
                ],
                ["block", "ids", "ends", "data", "size"],
            )
            number += 1


class BlockWords:
    """Word hashes of a block, their texts, and where each text's words begin."""

    def __init__(self, ends, data: bytes, size: int):
        raw = pa.decompress(data, size, "zstd", asbytes=True) if size else b""
        offsets = np.concatenate([[0], np.array(ends, np.int64)])
        data = np.frombuffer(raw, np.uint8)
        hashes, doc, first, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], 0
        for a, b in common.chunks(offsets):
            part = common.Words(offsets[a : b + 1], data[offsets[a] : offsets[b]])
            hashes.append(part.hash)
            doc.append(part.doc + a)
            first.append(part.first[:-1] + n)
            n += len(part.hash)
        self.hash, self.doc = np.concatenate(hashes), np.concatenate(doc)
        self.first = np.concatenate([*first, [n]]).astype(np.int64)


def _grams(words: BlockWords, order: int):
    """(hash per word position that ends an n-gram of this order, those positions)."""
    hashes, _ = common.shingle(words.hash, words.doc, order)
    size = max(len(words.hash) - order + 1, 0)
    whole = words.doc[:size] == words.doc[order - 1 : order - 1 + size]
    return hashes, np.flatnonzero(whole) + order - 1


def _slices(order: int, bits: int):
    """(order, part, block, n, hashes, counts): a block's distinct n-grams by hash range."""

    def run(batches):
        for batch in batches:
            for block, ends, data, size in zip(
                *(batch.column(x).to_pylist() for x in ("block", "ends", "data", "size")), strict=True
            ):
                words = BlockWords(ends, data, size)
                for n in range(1, order + 1):
                    found, count = np.unique(_grams(words, n)[0], return_counts=True)
                    part = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
                    owners, cuts = np.unique(part, return_index=True)
                    rows = []
                    for owner, a, b in zip(
                        owners.tolist(), cuts, np.append(cuts[1:], len(found))[: len(cuts)], strict=True
                    ):
                        step = np.diff(found[a:b], prepend=np.uint64(0))
                        rows.append(
                            (n, owner, block, int(b - a), _press_numbers(step), _press_numbers(count[a:b]))
                        )
                    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    columns = list(zip(*rows, strict=True)) or [[]] * 6
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                        ["n", "part", "block", "entries", "hashes", "counts"],
                    )

    return run


SLICES = "n int, part long, block long, entries long, hashes binary, counts binary"


def _totals(batches):
    """Rows arrive sorted by (n, part): each slice gets the corpus totals of its entries."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if row[:2] != key:
                yield from _merge(held)
                key, held = row[:2], []
            held.append(row)
    yield from _merge(held)


def _merge(rows):
    if not rows:
        return
    hashes, counts = [], []
    for _, _, _, size, packed, count in rows:
        hashes.append(np.cumsum(_numbers(packed, size), dtype=np.uint64))
        counts.append(_numbers(count, size))
    _, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(at, np.concatenate(counts)).astype(np.int64)[at]
    out, a = [], 0
    for n, part, block, size, _, _ in rows:
        out.append((n, part, block, size, _press_numbers(total[a : a + size])))
        a += size
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
        ["n", "part", "block", "entries", "totals"],
    )


def _scores(order: int, all_words: int, alpha: float, least: int):
    """A block meets the totals of its slices."""

    def run(block: pa.Table, totals: pa.Table) -> pa.Table:
        names = ("n", "part", "entries", "totals")
        held: dict[int, list] = {}
        # (n, part) is unique within a block, so the packed bytes are never compared
        for n, _, size, packed in sorted(zip(*(totals.column(x).to_pylist() for x in names), strict=True)):
            held.setdefault(n, []).append(_numbers(packed, size))
        ids, ends, data, size = (block.column(x)[0].as_py() for x in ("ids", "ends", "data", "size"))
        words = BlockWords(ends, data, size)
        sums = np.bincount(words.doc, _score(words, held, order, all_words, alpha, least), len(ids))
        length = np.diff(words.first)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(length.astype(np.int64)),
                "score": pa.array(np.round(sums / np.maximum(length, 1), 6) + 0.0),
            }
        )

    return run


def _score(words, held, order: int, all_words: int, alpha: float, least: int) -> np.ndarray:
    """log10 of the backed-off score of every word of a block."""
    size = len(words.hash)
    count = np.zeros((order + 1, size))
    for n in range(1, order + 1):
        hashes, ends = _grams(words, n)
        if len(hashes):
            _, at = np.unique(hashes, return_inverse=True)
            count[n, ends] = np.concatenate(held[n])[at]
    out = np.log10(np.maximum(count[1], 1) / max(all_words, 1))
    place = np.arange(size) - words.first[words.doc]
    for n in range(2, order + 1):
        context = np.zeros(size)
        context[1:] = count[n - 1][:-1]
        known = count[n] >= least
        better = np.log10(np.maximum(count[n], 1)) - np.log10(np.maximum(context, 1))
        out = np.where(place >= n - 1, np.where(known, better, out + np.log10(alpha)), out)
    return out


def score_documents(
    docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, least: int = MIN_COUNT
) -> DataFrame:
    """doc_id, n_words, score of every document."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = common.texts(docs)
    sums = rows.mapInArrow(_measure, "size long, words long").agg(F.sum("size"), F.sum("words")).head()
    total, all_words = int(sums[0] or 0), int(sums[1] or 0)
    bits = max(0, (total // PARTITION_BYTES).bit_length())
    scorers = max(parts, total // BLOCK_BYTES)
    # both uses of the blocks read this one exchange
    blocks = (
        rows.sortWithinPartitions(F.xxhash64("text"), "doc_id")
        .mapInArrow(_pack, PACKED)
        .repartition(scorers, "block")
    )
    totals = (
        blocks.mapInArrow(_slices(order, bits), SLICES)
        .repartition(max(parts, 1 << min(bits, 14)), "n", "part")
        .sortWithinPartitions("n", "part", "block")
        .mapInArrow(_totals, "n int, part long, block long, entries long, totals binary")
        .repartition(scorers, "block")
    )
    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _scores(order, all_words, alpha, least), "doc_id long, n_words long, score double"
    )
