"""The filter audit and the source mix against plain Python, and their odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from forecourt.llm import filter_audit, threshold_mix

DOCS = "doc_id long, text string, lang string, source string, mask string, size long, key string"
LABELS = "doc_id long, quality int, toxic int, part string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mask(text):
    words = WORD.findall(text)
    found = "A" if len(words) < 200 else ""
    found += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
    return found + ("D" if set(text) & set("#$%&*|") else "")


def brute_audit(docs, labels):
    first = {}
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, lang, *_ in docs:
        again = i is not None and i > first[text or ""]
        parts[lang or ""].append((mask(text or "") + "E" * again, i in good, i in toxic))
    rows = []
    for part, all_ in parts.items():
        lost = Counter()
        for order in permutations("ABCDE"):
            left = all_
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                lost[x] += len(gone)
                rows.append((
                    part, "".join(order), step, len(left), len(gone),
                    sum(x in d[0] for d in all_) - len(gone), sum(d[0] == x for d in all_),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                ))
        rows = [r + (lost[r[1][r[2] - 1]],) if r[0] == part else r for r in rows]
    return sorted(rows)


def some_docs(rng, n):
    texts = [None, "", "short", "AB CD", "a#b"]
    for _ in range(n // 2):
        kinds = rng.choice([20, 5000])
        words = [f"w{rng.randrange(kinds)}" for _ in range(rng.choice([5, 199, 200, 260]))]
        words += ["LOUD"] * rng.choice([0, 40]) + ["50%"] * rng.choice([0, 0, 1])
        texts.append(" ".join(words))
    langs = [None, "", "de", "en"]
    return [(i, rng.choice(texts), rng.choice(langs), None, "x", 1, "y") for i in range(n)]


def test_intervals_are_the_orders_that_remove():
    for m in range(1 << 5):
        steps = {}
        for step, a, b in filter_audit.intervals(m):
            assert not steps.keys() & set(range(a, b))
            steps |= dict.fromkeys(range(a, b), step)
        for rank, order in enumerate(permutations(range(5))):
            at = next((s for s, i in enumerate(order, 1) if m >> i & 1), None)
            assert steps.get(rank) == at


def test_audit_is_that_of_brute_force(spark):
    rng = random.Random(3)
    docs = some_docs(rng, 200)
    # repeated rows, also of a text's smallest doc_id, and rows without doc_id
    docs += [docs[0], docs[1], docs[1], (None, docs[5][1], "de", None, None, None, None)] * 2
    docs += [(900, "Z" * 200_000, "xx", None, "x", 1, "y"), (901, "a b " * 60_000, "xx", None, "x", 1, "y")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1]), "p") for i in range(0, 250, 2)]
    labels += [(4, 1, 0, "p"), (4, 0, 1, "p"), (None, 1, 1, "p")]
    got = filter_audit.audit(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    )
    assert got.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ]
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)


def test_audit_without_rows(spark):
    none, docs = spark.createDataFrame([], LABELS), spark.createDataFrame([], DOCS)
    assert filter_audit.audit(docs, none).count() == 0
    one = spark.createDataFrame([(1, "x", None, None, None, None, None)], DOCS)
    got = filter_audit.audit(one, none).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}
    assert {r.shapley for r in got if r.filter_order[r.step - 1] == "A"} == {120}


# --- mix -------------------------------------------------------------------------


def brute_targets(sizes):
    """Reshare the excess by weight until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        by = sum(weight[s] for s in free) or 1
        target = {s: left * weight[s] / by for s in free} | {s: 3 * sizes[s] for s in capped}
        above = {s for s in free if left * weight[s] > 3 * sizes[s] * by}
        if not above:
            return target
        capped |= above


def brute_taken(rows, target, passes=threshold_mix.PASSES):
    """Documents one by one in order of their hash: doc_id -> words."""
    size = sum(r[1] for r in rows)
    copies = int(target // size) if size else 0
    left, tolerance = int(target - copies * size + 0.5), int(target // threshold_mix.TOLERANCE)
    taken = {i: copies * n for i, n, _ in rows}
    over = []
    for i, n, p in sorted((r for r in rows if r[1]), key=lambda r: r[2]):
        if n <= left:
            left -= n
            taken[i] += n
        elif left <= tolerance or len(over) == passes:
            break
        elif n - left <= tolerance:
            taken[i] += n
            return taken
        else:
            over.append((n, p, i))
            if len(over) == passes:
                break
    if over and left > tolerance and min(over)[0] < 2 * left:
        taken[min(over)[2]] += min(over)[0]
    return taken


def place(i, text):
    return int(hashlib.md5(f"{i} {text}".encode()).hexdigest()[:15], 16)


def mixed(spark, docs):
    got = threshold_mix.mix(spark.createDataFrame(docs, DOCS).repartition(3))
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    return got.collect()


@pytest.mark.parametrize("seed", range(3))
def test_mix_is_that_of_brute_force(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "B", "é", "zz", "hot", "big"]
    docs = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else rng.choice(names)
        n = rng.choice([0, 1, 5, 30, 300, 3000 if source == "big" else 40])
        docs.append((i, " ".join(["w"] * n) if n or i % 2 else None, "de", source, "x", 1, "y"))
    by = defaultdict(list)
    for i, text, _, source, *_ in docs:
        n = len(WORD.findall(text or ""))
        by[source].append((i, n, place(i, text or "")))
    sizes = {s: sum(r[1] for r in rows) for s, rows in by.items()}
    targets = brute_targets(sizes)
    want = {}
    for s, rows in by.items():
        taken = brute_taken(rows, targets[s])
        want |= {i: (s, n, sizes[s], targets[s], taken[i]) for i, n, _ in rows}
    got = {r.doc_id: tuple(r)[1:] for r in mixed(spark, docs)}
    assert got.keys() == want.keys()
    for i, row in want.items():
        assert got[i][:3] == row[:3] and got[i][4] == row[4]
        assert got[i][3] == pytest.approx(row[3], rel=1e-12)
        assert got[i][4] <= 3 * got[i][1]
    near = Counter()
    for source, _, _, _, taken in got.values():
        near[source] += taken
    for source, target in targets.items():
        longest = max(r[1] for r in by[source])
        assert abs(near[source] - target) <= max(target / 400, longest / 2 + 1)


def test_the_search_goes_down_to_a_single_hash(spark):
    """Hashes that share their leading bits are told apart by later levels."""
    rows = spark.createDataFrame(
        [("0a", 10, (7 << 48) + (i << 12 if i < 5 else i)) for i in range(10)] + [("0b", 5, 3)],
        "key string, size long, place long",
    )
    state = spark.createDataFrame([("0a", -1, 34), ("0b", -1, 5)], "key string, after long, budget long")
    places = sorted(r.place for r in rows.filter("key = '0a'").collect())
    (found,) = threshold_mix.boundaries(rows, state).collect()
    assert tuple(found) == ("0a", places[3], 30, 10)


def test_mix_with_odd_rows(spark):
    assert threshold_mix.mix(spark.createDataFrame([], DOCS)).count() == 0
    empty = [(1, None, None, "a", None, None, None), (2, "", None, None, None, None, None)]
    assert {tuple(r)[2:] for r in mixed(spark, empty)} == {(0, 0, 0.0, 0)}
    # one row, rows without doc_id, repeated rows
    docs = [(None, "a b c", "x", "s", None, None, None)] * 2 + [(7, "a b", None, "s", None, None, None)]
    got = mixed(spark, docs)
    assert [r.taken for r in got] == [r.size for r in got] and len(got) == 3
    long = [(1, "w " * 100_000, "x", "s", None, None, None), (2, "w", "x", "t", None, None, None)]
    assert {r.doc_id: r.taken for r in mixed(spark, long)} == {1: 100_000, 2: 3}
