"""Marts off cells that follow upserts, against a full refresh."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from forecourt import commits, sinks, spec
from forecourt.operators.clean import gold_valid, staging
from forecourt.plans import cells, gold
from forecourt.spec import WIRE_LAYOUT
from tests.conftest import rows

SCHEMA = (
    "id string, make string, model string, year int, price double, mileage int, state string,"
    " condition string, ingested_at timestamp"
)


def listings(spark, seed, ids):
    rng = random.Random(seed)
    data = [
        (str(i), rng.choice(["ford", "bmw", "unknown"]), "m", rng.choice([1985, 2000, 2010]),
         float(rng.choice([100, 700, 800, 900])), 10, rng.choice(["CA", "NY", "XX"]), None, None)
        for i in ids
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "silver"), str(tmp_path / "cells")


def refresh(spark, roots):
    return cells.refresh_cells(spark, *roots, WIRE_LAYOUT)


def same_as_full_refresh(spark, roots):
    valid = gold_valid(staging(commits.read(spark, roots[0]), WIRE_LAYOUT))
    stored = cells.stored_cells(spark, roots[1])
    counted = valid.groupBy(*cells.CELL).agg(F.count("*").alias(cells.COUNT))
    assert rows(stored) == rows(counted)
    n = cells.COUNT
    assert rows(gold.price_by_make(stored, 5, n)) == rows(gold.price_by_make(valid, 5))
    assert rows(gold.listings_summary(stored, n)) == rows(gold.listings_summary(valid))


def test_cells_follow_upserts(spark, roots):
    sinks.merge_into(listings(spark, 1, range(200)), roots[0])
    refresh(spark, roots)
    same_as_full_refresh(spark, roots)
    all_folders = commits.latest(spark, roots[0]).folders()
    sinks.merge_into(listings(spark, 2, [7]), roots[0])
    read = refresh(spark, roots)
    assert len(read) == 3 and len(all_folders) == 16  # new, copied and dropped folder of a bucket
    same_as_full_refresh(spark, roots)
    assert refresh(spark, roots) == []


def test_several_versions_at_once_and_folding(spark, roots, monkeypatch):
    monkeypatch.setattr(cells, "MOST_FOLDERS", 2)
    sinks.merge_into(listings(spark, 1, range(60)), roots[0])
    refresh(spark, roots)
    for seed in (2, 3, 4):
        sinks.merge_into(listings(spark, seed, range(seed, 80, 3)), roots[0])
        sinks.merge_into(listings(spark, seed + 9, range(seed)), roots[0])
        refresh(spark, roots)
        assert len(commits.latest(spark, roots[1]).folders()) <= 2
    same_as_full_refresh(spark, roots)


def test_an_expired_version_means_counting_anew(spark, roots):
    sinks.merge_into(listings(spark, 1, range(60)), roots[0])
    refresh(spark, roots)
    sinks.merge_into(listings(spark, 2, range(60)), roots[0])
    commits.expire(spark, roots[0], keep=1, min_age_seconds=0)
    refresh(spark, roots)
    same_as_full_refresh(spark, roots)


def test_two_refreshes_at_once_count_nothing_twice(spark, roots, monkeypatch):
    sinks.merge_into(listings(spark, 1, range(60)), roots[0])
    refresh(spark, roots)
    sinks.merge_into(listings(spark, 2, range(60)), roots[0])
    real, left = commits.append, [1]

    def overtaken(spark_, root, snapshot):
        if root == roots[1] and left:
            left.pop()
            refresh(spark, roots)
        return real(spark_, root, snapshot)

    monkeypatch.setattr(commits, "append", overtaken)
    refresh(spark, roots)
    assert not left
    same_as_full_refresh(spark, roots)


def test_cells_of_an_empty_table(spark, roots):
    sinks.merge_into(listings(spark, 1, []), roots[0])
    refresh(spark, roots)
    assert cells.stored_cells(spark, roots[1]).count() == 0
    assert spec.INGESTED not in cells.stored_cells(spark, roots[1]).columns
