"""Byte-level BPE by monoid tree reduction.

A text is encoded by halves. Two encoded neighbours are joined by encoding again only a
window around the cut. The window grows on either side until it ends where a word ends
before white space: no match of the splitting pattern crosses such a place and none looks
past it, so the tokens outside the window are those of the joined text. A side without
such a place is encoded again as a whole. Decoding concatenates bytes up the same tree.

Texts are independent, so Spark deals them out as it reads them; nothing is shuffled.
Null texts count as empty and give no tokens. Each input row gives one row, repeated ones equal
rows; an empty table gives none. A long text takes one task, in memory proportional to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from forecourt.llm import common

LEAF_BYTES = 4096
FIRST_WINDOW = 32
# A visible ASCII byte before a space or line break: what follows starts a new match.
SAFE = re.compile(rb"[\x21-\x7e](?=[ \n])")


class TreeCodec:
    def __init__(self, path: str, pattern: str, leaf: int = LEAF_BYTES):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in file if x.strip())}
        self.leaf = leaf
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.length = [len(x) for x in self.bytes_of]
        self.digits = [str(x) for x in range(len(self.bytes_of))]

    def encode(self, data: bytes) -> list[int]:
        return self._encode(data, 0, len(data))

    def _leaf(self, data: bytes) -> list[int]:
        return self.encoding.encode_ordinary(data.decode()) if data else []

    def _encode(self, data: bytes, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self._leaf(data[lo:hi])
        mid = (lo + hi) // 2
        while mid > lo and data[mid] & 0xC0 == 0x80:
            mid -= 1
        if mid == lo:
            return self._leaf(data[lo:hi])
        return self._join(
            data, lo, mid, hi, self._encode(data, lo, mid), self._encode(data, mid, hi)
        )

    def _join(self, data, lo, mid, hi, left: list[int], right: list[int]) -> list[int]:
        start, stop = self._stable_before(data, lo, mid), self._stable_after(data, mid, hi)
        if start < mid or stop > mid:
            drop = seen = 0
            while seen < mid - start:
                drop += 1
                seen += self.length[left[-drop]]
            if drop:
                del left[-drop:]
            skip = seen = 0
            while seen < stop - mid:
                seen += self.length[right[skip]]
                skip += 1
            left.extend(self._leaf(data[start:stop]))
            right = right[skip:]
        left.extend(right)
        return left

    def _stable_before(self, data: bytes, lo: int, mid: int) -> int:
        window = FIRST_WINDOW
        while True:
            begin = max(lo, mid - window)
            found = [m.end() for m in SAFE.finditer(data[begin : mid + 1])]
            if found:
                return begin + found[-1]
            if begin == lo:
                return lo
            window *= 2

    def _stable_after(self, data: bytes, mid: int, hi: int) -> int:
        window = FIRST_WINDOW
        while True:
            found = SAFE.search(data[mid - 1 : min(hi, mid + window)])
            if found:
                return mid - 1 + found.end()
            if mid + window >= hi:
                return hi
            window *= 2

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self.bytes_of[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> TreeCodec:
    """One per Python worker."""
    return TreeCodec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text; path is that of a rank file."""

    def run(batches):
        tool = codec(path, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                ids = [tool.encode(x.encode()) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    return common.texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data): the bytes that the ids of each row stand for."""

    def run(batches):
        tool = codec(path, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                data = [tool.decode(x or []) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes, without moving the ids themselves."""

    def run(batches):
        tool = codec(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch.column("text"):
                ids = tool.encode(text.as_py().encode())
                counts.append(len(ids))
                joined = " ".join([tool.digits[i] for i in ids])
                of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(tool.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.array(counts, np.int64)),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_bytes, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return common.texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
