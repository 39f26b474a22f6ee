"""Periodic runs of words against brute force, the planted repetition, odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from forecourt.llm import run_automaton as ra

DOCS = "doc_id long, text string, start string, period long"


def brute_runs(words, least=24, periods=3):
    """Every period, every maximal stretch that keeps it and has no shorter one."""
    found, n = [], len(words)
    for q in range(1, n // periods + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            part = words[i : j + q]
            shorter = any(
                all(part[x] == part[x + d] for x in range(len(part) - d)) for d in range(1, q)
            )
            if j > i and len(part) >= max(least, periods * q) and not shorter:
                found.append((i, len(part), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            n = len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id,
        len(found),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def some_text(rng):
    """Words of a small or large alphabet, with stretches of some period put in."""
    kinds, n = rng.choice([1, 2, 3, 40]), rng.randrange(0, 200)
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if len(words) > 30:
            a, period = rng.randrange(len(words)), rng.randrange(1, 25)
            unit = [f"w{rng.randrange(kinds)}" for _ in range(period)]
            size = rng.randrange(10, 120)
            words[a : a + size] = (unit * size)[:size]
    return words


@pytest.mark.parametrize("seed", range(300))
def test_runs_are_those_of_brute_force(seed):
    words = some_text(random.Random(seed))
    assert ra.runs(words) == brute_runs(words)


def test_squares_hold_every_run_of_two_periods():
    rng = random.Random(5)
    for _ in range(100):
        words = [rng.randrange(2) for _ in range(40)]
        assert sorted(ra.squares(words), key=lambda r: (r[0], r[2])) == brute_runs(words, 2, 2)


def test_strongest_run_and_its_ties():
    found = [(0, 24, 8), (30, 30, 10), (70, 24, 8)]
    assert ra.strongest(found) == (0, 24, 8)
    assert ra.strongest([(0, 30, 10), (40, 25, 8)]) == (40, 25, 8)
    assert ra.strongest([]) is None


def test_collapsed_keeps_the_first_period():
    words = ["x"] + ["a", "b", "c"] * 10 + ["y"]
    assert ra.collapsed(words, ra.runs(words)) == ["x", "a", "b", "c", "y"]


def test_planted_repetition_follows_its_rule():
    words = [b"%d" % i for i in range(400)]
    hit = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert hit
    for i in hit:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % 400
        p = 1 + (400 - a) // (3 + g % 8)
        want = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        assert ra.planted(words, i) == want
    assert ra.planted(words, None) == words and ra.planted([], hit[0]) == []
    assert ra.planted([b"x"], hit[0]) == [b"x"]


def test_query_rows_are_those_of_brute_force(spark):
    rng = random.Random(7)
    long = ["w%d" % (i % 997) for i in range(9000)]
    rows = [(1, None, "s", 1), (2, "", "s", 1), (3, " \t\n ", None, 1), (None, "a " * 40, "s", 1)]
    rows += [(4, " ".join(long), "s", None), (4, " ".join(long), "s", None), (5, "é é " * 30, "s", 1)]
    rows += [(i, rng.choice([" ", "\n", "\x0b \r"]).join(some_text(rng)), "s", i) for i in range(10, 260)]
    got = ra.periodic_runs(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    small = [r for r in rows if r[0] != 4]
    assert sorted(map(tuple, (r for r in got if r.doc_id != 4)), key=repr) == sorted(
        (brute_row(r[0], r[1]) for r in small), key=repr
    )
    twice = [r for r in got if r.doc_id == 4]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert twice[0].n_runs == 1 and twice[0].period == 997 and twice[0].length == 9000


def test_empty_table(spark):
    out = ra.periodic_runs(spark.createDataFrame([], DOCS))
    assert out.columns == [x.split()[0] for x in ra.SCHEMA.split(", ")] and out.count() == 0
