"""Near copies among embeddings by an epsilon grid order join.

Unit vectors have cosine c or more exactly if their distance is at most eps =
sqrt(2 - 2 c). Vectors are projected on their leading principal dimensions (from a bounded
sample: any orthonormal basis is correct, a good one prunes more), sorted by the grid
cells of width eps, and cut into blocks, intervals of the sequence. The length of the rest of
a vector is one more coordinate: distances of these coordinates never exceed true ones.
Pairs of intervals are split level by level, FAN parts each, and dropped where their bounding
boxes lie farther apart than eps. The block pairs left of one pair of FAN blocks meet in one
group, so a block travels once per such pair. A group is at most 2 * FAN blocks of at most
BLOCK vectors or BLOCK_BYTES. There the recursion goes on to intervals of LEAF vectors, and
what is left is compared in double precision. A group returns link counts and a spanning
forest, never the links. Equal vectors are one row with a weight before all this.

Vectors spread evenly over many dimensions have no empty space between their boxes; nothing
can be dropped there, and the work grows with the square of their number.

Vectors that are null, zero or hold null or non-finite components link with nothing, and
neither do vectors of different length. Rows without vec_id link with nothing. Repeated
rows are vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.llm.components import components, forest

COSINE, DIMENSIONS, BLOCK, SAMPLE, FAN, LEAF = 0.95, 12, 2048, 2048, 8, 64
BLOCK_BYTES = 1 << 22
SLACK = 1e-6


def _unit(batches):
    """Valid vectors as raw doubles with their digest and length."""
    for batch in batches:
        ids, raw, size, a, b = [], [], [], [], []
        for i, own in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            if i is None or not own or any(x is None for x in own):
                continue
            vector = np.array(own, np.float64)
            largest = np.abs(vector).max()
            if not np.isfinite(vector).all() or largest == 0:
                continue
            if not 1e-100 < largest < 1e100:  # its square, or that of a vector near it, may not fit
                vector = vector / largest
            data = vector.tobytes()
            mark = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), np.int64)
            ids.append(i)
            raw.append(data)
            size.append(len(vector))
            a.append(int(mark[0]))
            b.append(int(mark[1]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(size, pa.int32()),
                pa.array(a, pa.int64()), pa.array(b, pa.int64()),
            ],
            ["vec_id", "raw", "size", "a", "b"],
        )


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    """Unit vectors, shorter ones filled up with zeros."""
    out = np.zeros((len(raw), width))
    for i, x in enumerate(raw):
        own = np.frombuffer(x, np.float64)
        out[i, : len(own)] = own
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _coordinates(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Projections on the basis and the length of the rest."""
    at = unit @ basis
    rest = np.sqrt(np.maximum(0, 1 - (at * at).sum(1)))
    return np.column_stack([at, rest])


def _apart(lo_a, hi_a, lo_b, hi_b) -> np.ndarray:
    """Squared distances of boxes, or of points where lo and hi are the same."""
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return (gap * gap).sum(-1)


def _cells(basis: np.ndarray, width: int, eps: float):
    def run(batches):
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            at = _coordinates(_matrix(raw, width), basis)
            cells = np.floor(at / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) for x in ("id", "weight", "size", "raw")]
                + [
                    pa.array(cells.tolist(), pa.list_(pa.int32())),
                    pa.array(at.tolist(), pa.list_(pa.float64())),
                ],
                ["id", "weight", "size", "raw", "cells", "at"],
            )

    return run


def _blocks(size: int):
    """Intervals of the sequence: members, their vectors and the box around them."""

    def block(part, number):
        at = np.array(part["at"])
        return (
            number, at.min(0).tolist(), at.max(0).tolist(),
            part["id"], part["weight"], part["size"], part["raw"],
        )

    def run(batches):
        from pyspark import TaskContext

        names, number = ["id", "weight", "size", "raw", "at"], TaskContext.get().partitionId() << 32
        held = {x: [] for x in names}
        out = []
        for batch in batches:
            for x in names:
                held[x] += batch.column(x).to_pylist()
            while len(held["id"]) >= size:
                out.append(block({x: held[x][:size] for x in names}, number))
                held = {x: held[x][size:] for x in names}
                number += 1
                yield rows(out)
                out = []
        if held["id"]:
            yield rows([block(held, number)])

    def rows(out):
        kinds = [
            pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()),
            pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
            ["block", "lo", "hi", "ids", "weights", "sizes", "raws"],
        )

    return run


BLOCKS = (
    "block long, lo array<double>, hi array<double>, ids array<long>, weights array<long>, "
    "sizes array<int>, raws array<binary>"
)


class Block:
    """Unit vectors of an interval, with the boxes of its leaves."""

    def __init__(self, row: dict, basis: np.ndarray, width: int):
        self.ids, self.weight, self.size = (np.array(row[x]) for x in ("ids", "weights", "sizes"))
        self.unit = _matrix(row["raws"], width)
        self.at = _coordinates(self.unit, basis)
        self.start = np.arange(0, len(self.ids), LEAF)
        self.leaf = np.arange(len(self.ids)) // LEAF
        self.lo = np.minimum.reduceat(self.at, self.start)
        self.hi = np.maximum.reduceat(self.at, self.start)


def _links(a: Block, b: Block, cosine: float, eps: float):
    """(places in a, places in b) of the links between two blocks; within one block each once."""
    found, bound = [], (eps + SLACK) ** 2
    for i, start in enumerate(a.start.tolist()):
        rows = slice(start, start + LEAF)
        near = _apart(a.lo[i], a.hi[i], b.lo, b.hi) <= bound
        if a is b:
            near[:i] = False
        at = np.flatnonzero(near[b.leaf])
        if len(at):
            at = at[_apart(a.lo[i], a.hi[i], b.at[at], b.at[at]) <= bound]
        if not len(at):
            continue
        hit = (a.unit[rows] @ b.unit[at].T >= cosine) & (a.size[rows, None] == b.size[at])
        u, v = np.nonzero(hit)
        u, v = u + start, at[v]
        if a is b:
            u, v = u[u < v], v[u < v]
        found.append((u, v))
    none = np.zeros(0, np.int64)
    return [np.concatenate([none, *x]) for x in (zip(*found, strict=True) if found else [(), ()])]


def _compare(basis: np.ndarray, width: int, cosine: float, eps: float):
    """Link counts and a forest of the block pairs of one group."""

    def run(group: pa.Table) -> pa.Table:
        rows = {row["number"]: row for row in group.to_pylist()}
        blocks = {number: Block(row, basis, width) for number, row in rows.items()}
        ids, counts, ends = [], [], [[], []]
        for number, row in rows.items():
            for partner in row["partners"]:
                a, b = blocks[number], blocks[partner]
                u, v = _links(a, b, cosine, eps)
                for own, other, x, y in ((a, b, u, v), (b, a, v, u)):
                    n = np.bincount(x, other.weight[y], len(own.ids)).astype(np.int64)
                    ids.append(own.ids[n > 0])
                    counts.append(n[n > 0])
                # links of a pair are folded at once: what is held is a forest
                names, root = forest(a.ids[u], b.ids[v])
                ends[0].append(names)
                ends[1].append(root)
        none = np.zeros(0, np.int64)
        linked, n = np.concatenate([none, *ids]), np.concatenate([none, *counts])
        names, root = forest(*(np.concatenate([none, *x]) for x in ends))
        return pa.table(
            {
                "id": pa.array(np.concatenate([linked, names]), pa.int64()),
                "n": pa.array(np.concatenate([n, 0 * names]), pa.int64()),
                "root": pa.array(np.concatenate([np.full(len(linked), -1), root]), pa.int64()),
                "link": pa.array(np.arange(len(linked) + len(names)) >= len(linked)),
            }
        )

    return run


def _groups(pairs: DataFrame) -> DataFrame:
    """(ta, tb, number, partners): the blocks of every group and whom each is compared with."""
    own = pairs.select(F.floor(F.col("a") / FAN).alias("ta"), F.floor(F.col("b") / FAN).alias("tb"), "a", "b")
    sides = own.select("ta", "tb", F.col("a").alias("number"), F.col("b").alias("partner")).unionByName(
        own.select("ta", "tb", F.col("b").alias("number"), F.lit(None).cast("long").alias("partner"))
    )
    return sides.groupBy("ta", "tb", "number").agg(F.collect_list("partner").alias("partners"))


def near_blocks(boxes: DataFrame, count: int, eps: float, fan: int = FAN) -> DataFrame:
    """(a, b), a <= b: numbers of blocks whose boxes (number, lo, hi) may hold neighbours.

    Intervals at level k are runs of fan ** k blocks; the recursion goes from one interval
    that holds everything down to blocks.
    """
    level = 0
    while fan**level < count:
        level += 1

    def intervals(k):
        own = boxes.select(F.floor(F.col("number") / fan**k).cast("long").alias("i"), "lo", "hi")
        dims = range(DIMENSIONS + 1)
        return own.groupBy("i").agg(
            F.array(*[F.min(F.col("lo")[d]) for d in dims]).alias("lo"),
            F.array(*[F.max(F.col("hi")[d]) for d in dims]).alias("hi"),
        )

    pairs = intervals(level).select(F.col("i").alias("a"), F.col("i").alias("b"))
    for k in range(level - 1, -1, -1):
        parts = F.array(*[F.lit(x) for x in range(fan)])
        boxes_k = intervals(k)
        left = boxes_k.select(F.col("i").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
        right = boxes_k.select(F.col("i").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
        apart = F.aggregate(
            F.arrays_zip("la", "ha", "lb", "hb"),
            F.lit(0.0),
            lambda s, x: s + F.pow(F.greatest(F.lit(0.0), x["la"] - x["hb"], x["lb"] - x["ha"]), 2.0),
        )
        pairs = (
            pairs.withColumn("x", F.explode(parts))
            .withColumn("y", F.explode(parts))
            .select((F.col("a") * fan + F.col("x")).alias("a"), (F.col("b") * fan + F.col("y")).alias("b"))
            .filter("a <= b")
            .join(left, "a")
            .join(right, "b")
            .filter(apart <= (eps + SLACK) ** 2)
            .select("a", "b")
        )
        pairs = common.store(pairs, "intervals")
    return pairs


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = vectors.sparkSession
    common.ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    valid = common.store(
        rows.mapInArrow(_unit, "vec_id long, raw binary, size int, a long, b long"), "vectors"
    )
    classes = common.store(
        valid.groupBy("a", "b", "size").agg(
            F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.any_value("raw").alias("raw")
        ),
        "classes",
    )
    head = classes.agg(F.max("size").alias("w"), F.count("*").alias("n")).head()
    width, n = head["w"] or 1, head["n"]
    eps = float(np.sqrt(max(2 - 2 * cosine, 1e-12)))
    sample = classes.orderBy(F.xxhash64("id")).limit(SAMPLE).select("raw").collect()
    spread = _matrix([r["raw"] for r in sample], width) if sample else np.zeros((1, width))
    _, basis = np.linalg.eigh(np.cov(spread.T).reshape(width, width) if len(spread) > 1 else np.eye(width))
    basis = np.ascontiguousarray(basis[:, ::-1][:, :DIMENSIONS])
    if basis.shape[1] < DIMENSIONS:
        basis = np.pad(basis, ((0, 0), (0, DIMENSIONS - basis.shape[1])))
    placed = classes.mapInArrow(
        _cells(basis, width, eps),
        "id long, weight long, size int, raw binary, cells array<int>, at array<double>",
    )
    block = max(1, min(block, BLOCK_BYTES // (8 * width)))
    parts = max(1, -(-n // (FAN * block)))
    stored = common.store(
        placed.repartitionByRange(parts, "cells", "id")
        .sortWithinPartitions("cells", "id")
        .mapInArrow(_blocks(block), BLOCKS),
        "blocks",
    )
    # blocks are numbered by part and place in it; numbers may be left out
    part, place = F.shiftright("block", 32), F.col("block").bitwiseAND((1 << 32) - 1)
    most, stride = stored.agg(F.max(place)).head()[0] or 0, 1
    while stride <= most:
        stride *= FAN
    stored = stored.withColumn("number", part * stride + place)
    last = stored.agg(F.max("number")).head()[0] or 0
    pairs = near_blocks(stored.select("number", "lo", "hi"), last + 1, eps)
    found = common.store(
        _groups(pairs)
        .join(stored.select("number", "ids", "weights", "sizes", "raws"), "number")
        .groupBy("ta", "tb")
        .applyInArrow(_compare(basis, width, cosine, eps), "id long, n long, root long, link boolean"),
        "found",
    )
    counts = found.filter("not link").groupBy("id").agg(F.sum("n").alias("n"))
    named = components(found.filter("link").select(F.col("id").alias("u"), F.col("root").alias("v")))
    per_class = (
        classes.select("a", "b", "size", "id", "weight")
        .join(counts, "id", "left")
        .join(named.withColumnRenamed("vertex", "id"), "id", "left")
        .select(
            "a", "b", "size", F.coalesce("component", "id").alias("component_id"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    good = valid.select("vec_id", "a", "b", "size").join(per_class, ["a", "b", "size"]).select(
        "vec_id", "n_links", "component_id"
    )
    bad = _invalid(rows).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return good.unionByName(bad).select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _invalid(rows: DataFrame) -> DataFrame:
    """The rows that _unit leaves out, by the same rules."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(
        e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ) & F.exists(e, lambda x: x != 0)
    return rows.filter(~F.coalesce(F.col("vec_id").isNotNull() & fine, F.lit(False)))
