"""Connected components of a table of links, without ever holding them in one place.

Stars alternate: every vertex hands its smallest neighbour to its larger, then to its
smaller neighbours, until the links are stars around the smallest vertex of each
component. Minima are pre-aggregated and joined back, so a vertex with a third of all
links is an ordinary skewed join. Each round is a stored table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, smallest vertex of their component) of a bounded list of links."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return names, names[root]
        root = new


def _contract(batches):
    """The links of a task's batches as stars: same components, fewer links."""
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        names, root = forest(u, v)
        moved = names != root
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[moved]), pa.array(root[moved])], ["u", "v"]
        )


def _stars(edges: DataFrame) -> bool:
    """Whether every vertex has one link down or only links from above."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    seen = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return seen.filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex in links (u, v), component its smallest vertex.

    Links of a vertex to itself and repeated links do no harm; nulls are left out.
    """
    common.ship(links.sparkSession)
    edges = (
        links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
        .filter("u is not null and v is not null")
    )
    alone = edges.filter("u = v").select("u").distinct()
    edges = common.store(
        edges.filter("u <> v").mapInArrow(_contract, "u long, v long").distinct(), "links"
    )
    while not _stars(edges):
        # large star: u's neighbours above u get the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        edges = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        # small star: links now point down; u and its lower neighbours get the smallest of them
        edges = edges.filter("u <> v").distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = (
            edges.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = common.store(edges, "stars")
    roots = edges.select(F.col("v").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    stars = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    known = stars.unionByName(roots)
    lone = alone.select(F.col("u").alias("vertex")).join(known, "vertex", "left_anti")
    return known.unionByName(lone.withColumn("component", F.col("vertex")))
