"""Near vectors of any length, against cosines worked out with scaled numbers."""

from __future__ import annotations

import math
import random

from forecourt.llm import chosen_path, ego_join

ROWS = "vec_id long, embedding array<double>, n_links string, size string"


def brute(rows, least=0.95):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        top = max(abs(x) for x in v)
        v = [x / top for x in v]
        norm = math.sqrt(math.fsum(x * x for x in v))
        return [x / norm for x in v]

    units = [unit(v) for _, v in rows]
    links = {
        i: [j for j, b in enumerate(units) if j != i and a and b and len(a) == len(b)
            and math.fsum(x * y for x, y in zip(a, b, strict=True)) >= least]
        for i, a in enumerate(units)
    }
    found = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen |= set(new)
            todo += new
        least_id = min(rows[j][0] for j in seen)
        found.append((vec_id, len(links[i]), least_id, vec_id == least_id))
    return sorted(found)


def test_tiny_huge_repeated_and_invalid_vectors(spark):
    rng = random.Random(4)
    rows = [
        (1, [1e-300, 2e-300]), (2, [1.0, 2.0]), (3, [1e300, 2e300]), (4, [5e-324, 0.0]), (5, [1.0, 0.0]),
        (6, [1e308, 1e308]), (7, [1.0, 1.0]), (8, [0.0, 0.0]), (9, None), (10, []), (11, [math.nan, 1.0]),
        (12, [math.inf, 1.0]), (13, [None, 1.0]), (14, [1.0, 2.0]), (15, [1.0, 2.0, 0.0]), (16, [-1.0, -2.0]),
    ]
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    for i in range(300):
        scale = rng.choice([1e-200, 1e-3, 1.0, 1e200])
        rows.append((100 + i, [scale * (x + rng.gauss(0, 0.12)) for x in rng.choice(centres)]))
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], ROWS).repartition(3)
    got = ego_join.near_vectors(df)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == brute(rows)


def test_no_vectors(spark):
    assert ego_join.near_vectors(spark.createDataFrame([], ROWS)).count() == 0


def test_small_buckets_still_find_all_links(spark, monkeypatch):
    """Every stage of the path search at work: pivots, splits, further rounds, several blocks."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for _ in range(25):
        base = passage + [f"w{rng.randrange(10**6)}" for _ in range(90)]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            copy[rng.randrange(45, 120)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    grams = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    want = [sum(a is not b and 9 * len(a & b) >= 4 * (len(a) + len(b)) for b in grams) for a in grams]
    monkeypatch.setattr(chosen_path, "SHINGLES", 300)
    monkeypatch.setattr(chosen_path.candidate_links, "__defaults__", (chosen_path.RUNS, 6, None))
    got = {r.doc_id: r.n_links for r in chosen_path.similarity_join(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_distant_blocks_are_never_paired(spark):
    """Boxes in a row, 0.25 apart, with gaps in their numbers: neighbours within 0.3 only."""
    flat = [0.0] * ego_join.DIMENSIONS
    places = [i for i in range(70) if i % 9 != 4]
    boxes = spark.createDataFrame(
        [(i, [0.25 * i, *flat], [0.25 * i + 0.01, *flat]) for i in places],
        "number long, lo array<double>, hi array<double>",
    )
    got = {(r.a, r.b) for r in ego_join.near_blocks(boxes, 70, 0.3).collect()}
    assert got == {(a, b) for a in places for b in (a, a + 1) if b in places}


def test_clusters_over_many_blocks_and_groups(spark, monkeypatch):
    """Blocks of eight and leaves of three, so that every level of the recursion skips something."""
    monkeypatch.setattr(ego_join, "LEAF", 3)
    rng = random.Random(11)
    centres = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(60)]
    rows = []
    for i in range(700):
        rows.append((i, [x + rng.gauss(0, 0.15) for x in centres[i % 5 if i < 230 else rng.randrange(60)]]))
    rows += [(1000 + i, list(rows[3][1])) for i in range(20)]
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], ROWS).repartition(3)
    got = ego_join.near_vectors(df, block=8)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == brute(rows)
