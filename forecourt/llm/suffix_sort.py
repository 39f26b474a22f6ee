"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if some LENGTH-byte string over it starts in two places. Every such string is
represented by an anchor: the GRAM bytes in it with the smallest hash. The anchor depends
on the string alone, so equal strings have equal anchors, and consecutive strings mostly
share theirs: one row stands for a hundred positions. Rows whose anchor occurs once can
not repeat. Rows that agree in all the text their strings cover (their context, by a
128-bit digest) repeat as a whole, and one of them stands for all in what follows.

The contexts left under one anchor are compared as suffixes. Prefix polynomial hashes give
the common extension of two suffixes by binary search, so a comparison takes a logarithmic
number of steps, and a bottom-up mergesort orders the suffixes that start at the same
distance from the anchor. Neighbours that agree in LENGTH bytes are compared byte by byte
before they count. Where more than SMALL contexts share an anchor, each is cut into ranges
of distances and dealt anew by the text all strings of a range have in common; equal
pieces are folded first. Ranges halve until the groups are small, so no task receives an
unbounded group; at a single distance a group is one piece.

Null and empty texts keep nothing and lose nothing. A repeated row is another place for
all its strings. Strings never cross from one text to another. Rows are told apart by
doc_id and a hash of the text; a null doc_id is an identifier like any other. An empty table
gives an empty result. A place takes POSITION_BITS bits, as many as the longest string in
Spark needs; of two hashes that agree in the other bits the one to the left counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common

LENGTH, GRAM, SMALL = 400, 200, 256
SORTED_BYTES = 1 << 19
POSITION_BITS = 31


class Prefix:
    """Polynomial hashes of all substrings of a byte string, modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(common.BYTE_CODE[data] * common.powers(common.BASE, len(data)), out=self.sum[1:])
        self.unshift = common.powers(common.BASE_INVERSE, len(data) + 1)

    def hash(self, start, end):
        return (self.sum[end] - self.sum[start]) * self.unshift[start]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of width values."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(offsets: np.ndarray, data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, first start, last start, anchor place, anchor hash): consecutive strings by anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    hashes = Prefix(data)
    at = np.arange(len(data) - gram + 1)
    own = common.mix(hashes.hash(at, at + gram))
    bits = np.uint64(POSITION_BITS)
    least = sliding_least((own >> bits << bits) | at.astype(np.uint64), length - gram + 1)
    place = (least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    start = np.arange(len(place))
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[text + 1]
    start, text, place = start[inside], text[inside], place[inside]
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return text[first], start[first], start[last], place[first], own[place[first]]


def _digest(data: bytes, salt: int) -> tuple[int, int]:
    own = hashlib.blake2b(data, digest_size=16, salt=salt.to_bytes(8, "little"))
    return tuple(np.frombuffer(own.digest(), np.int64))


PLACE = "doc_id long, mark long, first long, last long, lead int, key long, x0 long, x1 long"


def _places(length: int, gram: int):
    """One row per text and anchor; lead is the distance from the first string to the anchor."""

    def run(batches):
        for batch in batches:
            offsets, data = common.buffers(batch.column("text"))
            doc, mark = batch.column("doc_id"), batch.column("mark")
            for a, b in common.chunks(offsets):
                part = data[offsets[a] : offsets[b]]
                own = offsets[a : b + 1] - offsets[a]
                text, first, last, place, key = anchors(own, part, length, gram)
                raw = part.tobytes()
                found = np.array(
                    [
                        _digest(raw[x : y + length], z)
                        for x, y, z in zip(
                            first.tolist(), last.tolist(), (place - first).tolist(), strict=True
                        )
                    ],
                    np.int64,
                ).reshape(-1, 2)
                row = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.take(row),
                        mark.take(row),
                        pa.array(first - own[text]),
                        pa.array(last - own[text]),
                        pa.array((place - first).astype(np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.array(np.ascontiguousarray(found[:, 0])),
                        pa.array(np.ascontiguousarray(found[:, 1])),
                    ],
                    ["doc_id", "mark", "first", "last", "lead", "key", "x0", "x1"],
                )

    return run


class Suffixes:
    """Suffixes of a byte string compared by their first `length` bytes."""

    def __init__(self, data: bytes, length: int):
        self.data = np.frombuffer(data, np.uint8)
        self.hashes, self.length = Prefix(self.data), length

    def common_extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share, up to length: binary search on hashes."""
        out = np.full(len(a), self.length)
        left = np.flatnonzero(
            self.hashes.hash(a, a + self.length) != self.hashes.hash(b, b + self.length)
        )
        if len(left):
            x, y = a[left], b[left]
            low, high = np.zeros(len(left), np.int64), np.full(len(left), self.length)
            while (high - low > 1).any():
                mid = (low + high) // 2
                same = self.hashes.hash(x, x + mid) == self.hashes.hash(y, y + mid)
                low, high = np.where(same, mid, low), np.where(same, high, mid)
            out[left] = low
        return out

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the suffix at a sorts before that at b."""
        shared = self.common_extension(a, b)
        out = np.zeros(len(a), bool)
        differ = shared < self.length
        at = shared[differ]
        out[differ] = self.data[a[differ] + at] < self.data[b[differ] + at]
        return out

    def sort(self, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """starts holds lists of the given sizes one after the other; each list is sorted.

        Bottom-up mergesort of all lists at once: an element's place in the merged run is
        its place in its own run plus the number of smaller ones in the other run, found by
        binary search with hashed comparisons. Equal ones keep their order.
        """
        base = np.repeat(np.cumsum(size) - size, size)
        total = np.repeat(size, size)
        index = np.arange(len(starts)) - base
        run = 1
        while len(size) and run < size.max():
            block = index // run
            other = (block ^ 1) * run
            low = np.minimum(other, total)
            high = np.minimum(other + run, total)
            begin = low.copy()
            second = (block & 1).astype(bool)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) // 2
                theirs, mine = starts[base[open_] + mid], starts[open_]
                # an equal element of the first run goes first
                less = np.where(
                    second[open_], ~self.before(mine, theirs), self.before(theirs, mine)
                )
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
            place = (block & ~1) * run + index % run + (low - begin)
            out = np.empty_like(starts)
            out[base + place] = starts
            starts = out
            run *= 2
        return starts


def repeated_strings(contexts: list[bytes], lead, group, length: int = LENGTH):
    """(context, first, last): runs of starts, relative to the context, whose strings repeat.

    contexts of one group are aligned by lead, the place of their common anchor.
    """
    data = b"".join(contexts)
    size = np.array([len(x) for x in contexts], np.int64)
    begin = np.cumsum(size) - size
    count = size - length + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    distance = np.asarray(lead, np.int64)[owner] - offset
    order = np.lexsort((owner, distance, np.asarray(group)[owner]))
    owner, offset, distance = owner[order], offset[order], distance[order]
    starts = begin[owner] + offset
    which = np.asarray(group)[owner]
    new = np.ones(len(starts), bool)
    new[1:] = (which[1:] != which[:-1]) | (distance[1:] != distance[:-1])
    lists = np.diff(np.append(np.flatnonzero(new), len(starts)))
    tool = Suffixes(data, length)
    starts = tool.sort(starts, lists)
    pair = np.flatnonzero(~new)
    a, b = starts[pair - 1], starts[pair]
    equal = tool.common_extension(a, b) == length
    a, b = a[equal], b[equal]
    # verify bytes: pairs that advance together are one comparison
    by = np.lexsort((a, b - a))
    a, b = a[by], b[by]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(a))[: len(heads)] - 1
    found = []
    for x, y, z in zip(a[heads].tolist(), b[heads].tolist(), a[tails].tolist(), strict=True):
        n = z - x + 1
        if data[x : z + length] == data[y : y + n - 1 + length]:
            found += [(x, n), (y, n)]
        else:
            for i in range(n):
                if data[x + i : x + i + length] == data[y + i : y + i + length]:
                    found += [(x + i, 1), (y + i, 1)]
    found = sorted(set(found))
    at = np.array([x for x, _ in found], np.int64)
    own = np.searchsorted(begin, at, "right") - 1
    return [(int(c), int(x - begin[c]), int(x - begin[c] + n - 1)) for c, (x, n) in zip(own, found, strict=True)]


def _sort_groups(length: int):
    """Rows arrive sorted by key; several whole groups are sorted together."""

    def part(frame):
        rows = repeated_strings(
            list(frame["context"]), frame["lead"].to_numpy(), frame["key"].to_numpy(), length
        )
        own = np.array([c for c, _, _ in rows], np.int64)
        shift = frame["first"].to_numpy(np.int64)[own]
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].iloc[own].astype("Int64"),
                "mark": frame["mark"].to_numpy()[own],
                "first": shift + np.array([x for _, x, _ in rows], np.int64),
                "last": shift + np.array([x for _, _, x in rows], np.int64),
            }
        )

    def run(frames):
        rest = None
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            key = frame["key"].to_numpy()
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.cumsum(frame["context"].map(len).to_numpy())
            at = 0
            for cut in new[1:].tolist():
                if size[cut - 1] - (size[at - 1] if at else 0) > SORTED_BYTES or cut == new[-1]:
                    yield part(frame.iloc[at:cut])
                    at = cut
            rest = frame.iloc[at:]
        if rest is not None and len(rest):
            yield part(rest)

    return run


def _contexts(length: int):
    """The text that the strings of each wanted row cover."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, mark, text, wanted in zip(
                *(batch.column(x).to_pylist() for x in ("doc_id", "mark", "text", "wanted")),
                strict=True,
            ):
                data = text.encode()
                for x in wanted:
                    own = data[x["first"] : x["last"] + length]
                    out.append((doc, mark, x["first"], x["last"], x["lead"], x["key"], own))
                if len(out) > 2000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return run


def _batch(rows):
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.binary()]
    names = ["doc_id", "mark", "first", "last", "lead", "key", "context"]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names
    )


CONTEXT = "doc_id long, mark long, first long, last long, lead int, key long, context binary"


def _split(length: int, width: int):
    """Cut rows into ranges of distances; the new key adds what all strings of a range share."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, mark, first, last, lead, key, own in zip(
                *(batch.column(x).to_pylist() for x in batch.schema.names), strict=True
            ):
                top, bottom = lead, lead - (last - first)
                for r in range(bottom // width, top // width + 1):
                    high, low = min(top, (r + 1) * width - 1), max(bottom, r * width)
                    piece = own[top - high : top - low + length]
                    core = own[top - r * width : max(0, top - (r + 1) * width + 1 + length)]
                    name = _digest(core + key.to_bytes(8, "little", signed=True), r)[0]
                    x0, x1 = _digest(piece, high)
                    out.append((doc, mark, first + top - high, first + top - low, high, int(name), piece, int(x0), int(x1)))
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                [*batch.schema.names, "x0", "x1"],
            )

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, small: int = SMALL) -> DataFrame:
    """(doc_id, mark, first, last): runs of starts of repeated strings; mark tells texts apart."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _marked(docs)
    places = common.store(rows.mapInArrow(_places(length, gram), PLACE), "places")
    twice = common.store(
        places.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "twice"
    )
    hits = common.store(places.join(twice, "key", "left_semi"), "hits")
    found = []
    width = 1 << (length - gram).bit_length()
    with_text = False
    while True:
        folded = common.store(
            hits.groupBy("key", "x0", "x1").agg(
                F.count("*").alias("n"),
                F.min(F.struct("doc_id", "mark", "first", "last", "lead")).alias("one"),
            ),
            "folded",
        )
        whole = folded.filter("n > 1").select("key", "x0", "x1")
        found.append(
            hits.join(whole, ["key", "x0", "x1"], "left_semi").select("doc_id", "mark", "first", "last")
        )
        kinds = folded.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
        stay = folded.join(kinds, "key").select("key", "m", "one.*")
        if with_text:
            # a folded row keeps the text of the place that stands for it
            same = [hits["key"].eqNullSafe(stay["key"])] + [
                hits[x].eqNullSafe(stay[x]) for x in ("doc_id", "mark", "first", "last")
            ]
            alive = hits.join(stay, same, "inner").select(
                hits["doc_id"], hits["mark"], hits["first"], hits["last"], hits["lead"],
                hits["key"], hits["context"], stay["m"],
            ).dropDuplicates(["doc_id", "mark", "first", "last", "key"])
            contexts = common.store(alive, "contexts")
        else:
            wanted = stay.groupBy("doc_id", "mark").agg(
                F.collect_list(F.struct("first", "last", "lead", "key")).alias("wanted")
            )
            same = [rows[x].eqNullSafe(wanted[x]) for x in ("doc_id", "mark")]
            own = rows.join(wanted, same).select(rows["doc_id"], rows["mark"], "text", "wanted")
            contexts = common.store(
                own.mapInArrow(_contexts(length), CONTEXT)
                .dropDuplicates(["doc_id", "mark", "first", "key"])
                .join(kinds, "key"),
                "contexts",
            )
            with_text = True
        order = ["key", "doc_id", "mark", "first"]
        found.append(
            contexts.filter(F.col("m") <= small)
            .drop("m")
            .repartition(parts, "key")
            .sortWithinPartitions(*order)
            .mapInPandas(_sort_groups(length), "doc_id long, mark long, first long, last long")
        )
        many = contexts.filter(F.col("m") > small).drop("m")
        if many.isEmpty():
            break
        width = max(1, width // 2)
        hits = common.store(
            many.select("doc_id", "mark", "first", "last", "lead", "key", "context").mapInArrow(
                _split(length, width), f"{CONTEXT}, x0 long, x1 long"
            ),
            "pieces",
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _marked(docs: DataFrame) -> DataFrame:
    return common.texts(docs).select("doc_id", F.xxhash64("text").alias("mark"), "text")


def _cut(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, text, runs in zip(
                *(batch.column(x).to_pylist() for x in ("doc_id", "text", "runs")), strict=True
            ):
                data = text.encode()
                kept, spans, removed, at = hashlib.sha256(), 0, 0, 0
                merged = []
                for x in sorted((r["first"], r["last"] + length) for r in runs or []):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append(list(x))
                for a, b in merged:
                    kept.update(data[at:a])
                    at, spans, removed = b, spans + 1, removed + b - a
                kept.update(data[at:])
                out.append((doc, len(data), removed, spans, kept.hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, small: int = SMALL) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    runs = common.store(repeated_runs(docs, length, gram, small), "runs")
    own = runs.groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")
    )
    rows = _marked(docs)
    same = [rows[x].eqNullSafe(own[x]) for x in ("doc_id", "mark")]
    return (
        rows.join(own, same, "left")
        .select(rows["doc_id"], "text", "runs")
        .mapInArrow(
            _cut(length),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        )
    )
