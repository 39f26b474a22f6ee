"""Similarity join of documents on word shingles by chosen paths.

A document is the set of its five-word shingles (words: runs of letters and digits, A-Z
lower-cased; a shorter text is one shingle of all its words). Equal sets are one class, so
copies cost nothing later. SIGNS minimum hashes of a set are its sampled tokens.

A run deals the classes into buckets by two sampled tokens; sets that agree in both share a
path. A bucket of at most SMALL sets is compared by brute force on one byte of each sampled
token. A larger one first meets a pivot, another one in each bucket: sets near the pivot are
linked to it and leave, those between near and far are linked to it and stay with the far
ones, and what stays is split again on the next sampled token. By the triangle inequality a
partner of a set that left has a similarity of at least NEAR - (1 - SIMILAR) to the pivot, and
FAR lies 0.1 below that for the error of two estimates. Worked out for the worst case, a true
similarity of NEAR, the partner is missed in that bucket with a chance of 0.06; other runs
meet other pivots. Splitting goes on until nothing is left. A round of RUNS runs shares its SIGNS samples and misses a pair of similarity s, whose
buckets end after depth samples, with the mean of (1 - m ** depth) ** RUNS over the share m
of samples that agree: 0.00004 for s = 0.8 and depth 2, 0.006 for depth 4. The depth grows
with the buckets, so the deepest one of each class is noted, and a class takes part in
further rounds with fresh samples until that chance is at most MISS at its depth. The
shallower one of a pair decides how many rounds the pair needs, and both take part in those.

Linked classes form candidate groups, and here the comparison becomes exact: shingle sets
of the group's members travel once and are intersected block against block, at most some BLOCK
members or SHINGLES shingles a block (or one set), so a group of any size is many bounded tasks. Links are counted there,
never listed; what leaves a block is a spanning forest.

A class is known by its shingles, not by a doc_id: texts that share a doc_id are told apart.

Result: one row per document with the number of documents it is linked to (copies
included) and its class: the smallest doc_id reachable by links. Texts without words,
null among them, link with nothing. Rows without a doc_id are reported with no links and
no class. Repeated rows count as documents of their own. A text is cut into shingles by one task,
however long. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.llm.components import components, forest

WORDS, SIGNS, RUNS, SMALL, BLOCK, SHINGLES = 5, 64, 12, 4096, 2048, 2_000_000
NEAR, FAR, CANDIDATE = 0.75, 0.45, 0.55
SIMILAR, MISS = 0.8, 1e-4
KEY = ["doc_id", "a", "b", "size"]


def missed(depth: int, runs: int = RUNS) -> float:
    """Chance that a round misses a pair of similarity SIMILAR whose buckets end at depth."""
    return sum(
        math.comb(SIGNS, k) * SIMILAR**k * (1 - SIMILAR) ** (SIGNS - k) * (1 - (k / SIGNS) ** depth) ** runs
        for k in range(SIGNS + 1)
    )


def rounds_for(depth: int, runs: int = RUNS) -> int:
    """Rounds, each with its own samples, after which at most MISS of such pairs are missed."""
    return math.ceil(math.log(MISS) / math.log(missed(depth, runs)))


def shingle_sets(column: pa.Array, words: int = WORDS):
    """(hashes, first) per run of texts: row i owns the distinct hashes first[i] : first[i + 1]."""
    offsets, data = common.buffers(column)
    for a, b in common.chunks(offsets):
        found = common.Words(offsets[a : b + 1], data[offsets[a] : offsets[b]])
        hashes, doc = common.shingle(found.hash, found.doc, words)
        size = np.diff(found.first)
        short = np.flatnonzero((size > 0) & (size < words))
        if len(short):
            whole = []
            for i in short:
                value = np.zeros(1, np.uint64)
                for x in found.hash[found.first[i] : found.first[i + 1]]:
                    value = common.mix(value * common.BASE + x)
                whole.append(value[0] ^ np.uint64(size[i]))
            hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
            doc = np.concatenate([doc, short])
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        yield hashes, np.searchsorted(doc, np.arange(b - a + 1))


def _signs(hashes: np.ndarray, first: np.ndarray, number: int) -> np.ndarray:
    """SIGNS minimum hashes (32 bits) of each set that is not empty, others in each round."""
    random = np.random.default_rng(77 + number)
    factor = random.integers(1, 2**63, SIGNS, dtype=np.uint64) | np.uint64(1)
    shift = random.integers(1, 2**63, SIGNS, dtype=np.uint64)
    out = np.empty((len(first) - 1, SIGNS), np.uint32)
    for k in range(SIGNS):
        value = ((hashes * factor[k] + shift[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(value, first[:-1])
    return out


def _digests(hashes: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """The columns a, b and size of each set; a and b are 0 for an empty one."""
    raw = hashes.tobytes()
    digests = np.zeros((len(first) - 1, 2), np.int64)
    for i in np.flatnonzero(np.diff(first)).tolist():
        own = hashlib.blake2b(raw[8 * first[i] : 8 * first[i + 1]], digest_size=16)
        digests[i] = np.frombuffer(own.digest(), np.int64)
    a, b = (pa.array(np.ascontiguousarray(x)) for x in digests.T)
    return [a, b, pa.array(np.diff(first).astype(np.int64))]


def _sketch_of(batches, number: int):
    for batch in batches:
        at = 0
        names = [x for x in batch.schema.names if x != "text"]
        for hashes, first in shingle_sets(batch.column("text")):
            n = len(first) - 1
            full = np.flatnonzero(np.diff(first))
            signs = np.zeros((n, SIGNS), np.uint32)
            if len(full):
                signs[full] = _signs(hashes, np.append(first[:-1][full], len(hashes)), number)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x).slice(at, n) for x in names),
                    *_digests(hashes, first),
                    pa.array([x.tobytes() for x in signs], pa.binary()),
                ],
                [*names, "a", "b", "size", "signs"],
            )
            at += n


def _sketch(batches):
    return _sketch_of(batches, 0)


def _candidates_within(ids: np.ndarray, briefs: np.ndarray):
    """Pairs of a bucket whose estimate reaches CANDIDATE, a few million comparisons at a time."""
    out, rows = [], max(1, 4_000_000 // (len(ids) * SIGNS))
    for a in range(0, len(ids), rows):
        alike = (briefs[a : a + rows, None, :] == briefs[None, a:, :]).mean(2) >= CANDIDATE
        i, j = np.nonzero(np.triu(alike, 1))
        out.append(np.stack([ids[a + i], ids[a + j]], 1))
    return out


def _unpack(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, SIGNS)


def _briefs(batches):
    """One byte of each sampled token is enough to estimate a similarity."""
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("signs").to_pylist()), np.uint8)
        low = np.ascontiguousarray(signs.reshape(-1, SIGNS, 4)[:, :, 0])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([x.tobytes() for x in low], pa.binary())], ["id", "brief"]
        )


def _compare_buckets(frames):
    """Rows arrive sorted by bucket; a bucket may go on in the next batch."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        last = frame["bucket"].iloc[-1]
        done = frame["bucket"] != last
        rest = frame[~done]
        yield _compare(frame[done])
    if rest is not None:
        yield _compare(rest)


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    bucket, ids = frame["bucket"].to_numpy(), frame["id"].to_numpy()
    briefs = _unpack(frame["brief"])
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    cuts, out = np.flatnonzero(new), [np.zeros((0, 2), np.int64)]
    for a, b in zip(cuts, np.append(cuts[1:], len(bucket))[: len(cuts)], strict=True):
        if b - a > 1:
            out += _candidates_within(ids[a:b], briefs[a:b])
    # only what is connected counts: a spanning forest, not the square of a bucket
    u, v = np.concatenate(out).T
    names, root = forest(u, v)
    return pd.DataFrame({"u": names, "v": root}, dtype="int64")[names != root]


def _pivot_similarity(batches):
    for batch in batches:
        names = batch.schema.names
        own, pivot = (_unpack(batch.column(x).to_pylist()) for x in ("brief", "pivot"))
        s = (own == pivot).mean(1) if len(own) else np.zeros(0)
        names = [x for x in names if x not in ("brief", "pivot")]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(s)], [*names, "s"])


def _sign(k, signs="signs"):
    """The k-th sampled token, as four bytes."""
    return F.substring(F.col(signs), F.lit(1) + 4 * k, F.lit(4))


def candidate_links(
    classes: DataFrame,
    runs: int = RUNS,
    small: int = SMALL,
    fresh: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """(u, v) links between classes (id, signs) that connect every pair likely to be similar.

    fresh(ids, round) gives (id, signs) with the samples of a further round; without it
    there is one round, whatever the depth.
    """
    out, depths = _round(classes, runs, small)
    done = 1
    while fresh is not None:
        again = [ids for depth, ids in depths if rounds_for(depth, runs) > done]
        if not again:
            break
        ids = again[0]
        for more in again[1:]:
            ids = ids.unionByName(more)
        if ids.isEmpty():
            break
        signs = common.store(fresh(ids.distinct(), done), "fresh")
        links, found = _round(signs, runs, small)
        out, depths, done = out.unionByName(links), depths + found, done + 1
    return out


def _round(classes: DataFrame, runs: int, small: int):
    """Links of one round, and (depth, ids dealt by that many samples) from depth 3 on."""
    depth, found, depths = 2, [], []
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    briefs = common.store(classes.mapInArrow(_briefs, "id long, brief binary"), "briefs")
    # tokens of their own for up to SIGNS / 5 runs
    first, second = (F.pmod(5 * F.col("run") + x, F.lit(SIGNS)) for x in (0, 2))
    rows = classes.select(
        "id", "signs", F.explode(F.array(*[F.lit(r) for r in range(runs)])).alias("run")
    ).select("id", "run", F.xxhash64("run", _sign(first), _sign(second)).alias("bucket"))
    while True:
        # another pivot in each bucket, so that the error of one estimate does not repeat
        count = rows.groupBy("bucket").agg(
            F.count("*").alias("n"), F.min_by("id", F.xxhash64("id", "bucket")).alias("centre")
        ).filter("n > 1")
        slim = common.store(rows.join(count, "bucket"), "buckets")
        found.append(
            slim.filter(F.col("n") <= small)
            .select("bucket", "id")
            .join(briefs, "id")
            .repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "id")
            .mapInPandas(_compare_buckets, "u long, v long")
        )
        many = slim.filter(F.col("n") > small)
        if many.isEmpty():
            break
        pivots = (
            many.select("bucket", F.col("centre").alias("id")).distinct()
            .join(briefs, "id")
            .select("bucket", F.col("brief").alias("pivot"))
        )
        judged = common.store(
            many.select("bucket", "run", "id", "centre")
            .join(briefs, "id")
            .join(pivots, "bucket")
            .select("id", "bucket", "run", "centre", "brief", "pivot")
            .mapInArrow(
                _pivot_similarity, "id long, bucket long, run int, centre long, s double"
            ),
            "judged",
        )
        found.append(
            judged.filter((F.col("s") >= FAR) & (F.col("id") != F.col("centre"))).select(
                F.col("centre").alias("u"), F.col("id").alias("v")
            )
        )
        stay = judged.filter((F.col("s") < NEAR) & (F.col("id") != F.col("centre")))
        token = F.pmod(F.xxhash64(F.lit(depth), "bucket"), F.lit(SIGNS)).cast("int")
        rows = stay.select("id", "run", "bucket").join(classes, "id").select(
            "id", "run", F.xxhash64("bucket", _sign(token)).alias("bucket")
        )
        depth += 1
        depths.append((depth, stay.select("id")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, depths


def _links(sets: list[np.ndarray], other: list[np.ndarray], same: bool):
    """Pairs (i, j) with Jaccard similarity 0.8 or more, i < j within one block."""
    every = np.concatenate([*sets, *([] if same else other)])
    names, count = np.unique(every, return_counts=True)
    names = names[count > 1]
    size = np.array([len(x) for x in sets])
    size2 = size if same else np.array([len(x) for x in other])
    if not len(names):
        return np.zeros((0, 2), np.int64)

    def incidence(rows):
        row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        at = np.concatenate(rows)
        column = np.minimum(np.searchsorted(names, at), len(names) - 1)
        ok = names[column] == at
        return row[ok], column[ok]

    a, b = incidence(sets), None if same else incidence(other)
    common_ = np.zeros((len(sets), len(size2)), np.float32)
    width = max(256, 4_000_000 // max(len(sets), len(size2)))
    for c in range(0, len(names), width):
        def dense(rows, n, c=c):
            own = (rows[1] >= c) & (rows[1] < c + width)
            out = np.zeros((n, min(width, len(names) - c)), np.float32)
            out[rows[0][own], rows[1][own] - c] = 1
            return out

        x = dense(a, len(sets))
        common_ += x @ (x if same else dense(b, len(other))).T
    # |A n B| / |A u B| >= 4 / 5, in whole numbers
    ok = 9 * common_ >= 4 * (size[:, None] + size2[None, :])
    if same:
        ok = np.triu(ok, 1)
    return np.argwhere(ok)


def _verify_group(frame: pd.DataFrame) -> tuple[list, list]:
    ids, weight = frame["id"].to_numpy(), frame["weight"].to_numpy()
    side = frame["side"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in frame["hashes"]]
    i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
    if i == j:
        left = right = np.arange(len(ids))
    else:
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
    if len(left) < 1 or len(right) < 1:
        return [], []
    pairs = _links([sets[x] for x in left], [sets[x] for x in right], i == j)
    if not len(pairs):
        return [], []
    u, v = left[pairs[:, 0]], right[pairs[:, 1]]
    n = np.bincount(u, weight[v], len(ids)) + np.bincount(v, weight[u], len(ids))
    names, root = forest(ids[u], ids[v])
    counts = [(a, int(b)) for a, b in zip(ids, n, strict=True) if b]
    return counts, list(zip(names, root, strict=True))


def _verify(frames):
    """Rows arrive sorted by (comp, i, j); counts and forest links leave."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        key = frame[["comp", "i", "j"]].to_numpy()
        last = (key == key[-1]).all(1)
        rest = frame[last]
        yield _verify_frame(frame[~last])
    if rest is not None:
        yield _verify_frame(rest)


def _verify_frame(frame: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, group in frame.groupby(["comp", "i", "j"], sort=False):
        counts, links = _verify_group(group)
        out += [(a, n, -1) for a, n in counts] + [(a, 0, b) for a, b in links]
    return pd.DataFrame(out, columns=["id", "n", "root"], dtype="int64")


def _hash_sets(batches):
    for batch in batches:
        at = 0
        for hashes, first in shingle_sets(batch.column("text")):
            n, raw = len(first) - 1, hashes.tobytes()
            sets = [raw[8 * a : 8 * b] for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, n), *_digests(hashes, first), pa.array(sets, pa.binary())],
                [*KEY, "hashes"],
            )
            at += n


def similarity_join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links for every document."""
    return _joined(common.texts(docs)).drop("group_id")


def linked_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, group_id, class_id, n_links; group_id is null for what has no class.

    Texts that share a doc_id can be the smallest of two groups, so only group_id names one.
    """
    return _joined(common.texts(docs).withColumn("text_sha256", F.sha2("text", 256)))


def _joined(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    names = [x for x in rows.columns if x != "text"]
    kinds = ", ".join(f"{x} {dict(rows.dtypes)[x]}" for x in names)
    sketches = common.store(
        rows.mapInArrow(_sketch, f"{kinds}, a long, b long, size long, signs binary"), "sketches"
    )
    # doc_id is that of one text of the class; id names the class
    classes = common.store(
        sketches.filter("size > 0 and doc_id is not null")
        .groupBy("a", "b", "size")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("weight"), F.any_value("signs").alias("signs"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    texts = rows.select("doc_id", "text")

    def fresh(ids: DataFrame, number: int) -> DataFrame:
        own = classes.join(ids, "id", "left_semi").select(*KEY, "id")

        def sketch(batches):
            return _sketch_of(batches, number)

        # samples travel, not texts
        return (
            texts.mapInArrow(sketch, "doc_id long, a long, b long, size long, signs binary")
            .filter("size > 0")
            .join(own, KEY)
            .select("id", "signs")
            .dropDuplicates(["id"])
        )

    links = common.store(candidate_links(classes.select("id", "signs"), fresh=fresh), "candidates")
    groups = common.store(
        components(links).select(F.col("vertex").alias("id"), F.col("component").alias("comp")),
        "groups",
    )
    # members of a group are dealt into blocks of at most about BLOCK sets or SHINGLES shingles
    members = common.store(groups.join(classes.select(*KEY, "id", "weight"), "id"), "members")
    size = members.groupBy("comp").agg(F.count("*").alias("m"), F.sum("size").alias("shingles"))
    blocks = (
        members.join(size, "comp")
        .withColumn(
            "blocks",
            F.ceil(F.greatest(F.col("m") / BLOCK, F.col("shingles") / SHINGLES)).cast("int"),
        )
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    )
    pairs = blocks.select(
        *KEY, "id", "comp", "weight", "side",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        *KEY, "id", "comp", "weight", "side",
        F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
    )
    # a condition that always holds: Spark builds its filter of doc_ids only from a narrowed side
    sets = (
        texts.join(members.filter("size > 0").select("doc_id"), "doc_id", "left_semi")
        .mapInArrow(_hash_sets, "doc_id long, a long, b long, size long, hashes binary")
        .dropDuplicates(KEY)
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with common.filtered_joins(spark):
        verified = common.store(
            pairs.join(sets, KEY)
            .drop(*KEY)
            .repartition(parts, "comp", "i", "j")
            .sortWithinPartitions("comp", "i", "j", "id")
            .mapInPandas(_verify, "id long, n long, root long"),
            "verified",
        )
    counts = verified.groupBy("id").agg(F.sum("n").alias("n"))
    final = common.store(
        components(verified.filter("root >= 0").select(F.col("id").alias("u"), F.col("root").alias("v")))
        .select(F.col("vertex").alias("id"), "component"),
        "linked",
    )
    least = (
        final.join(classes.select("id", "doc_id"), "id")
        .groupBy("component")
        .agg(F.min("doc_id").alias("class_id"))
    )
    named = (
        classes.select(*KEY, "id", "weight")
        .join(counts, "id", "left")
        .join(final.join(least, "component"), "id", "left")
        .select(
            "a", "b", "size",
            F.coalesce("component", "id").alias("group_id"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    has = (F.col("size") > 0) & F.col("doc_id").isNotNull()
    return sketches.select(*names, "a", "b", "size").join(named, ["a", "b", "size"], "left").select(
        *names,
        F.when(has, F.col("group_id")).alias("group_id"),
        F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(has, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
