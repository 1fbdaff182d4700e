"""Consolidating pairwise matches into groups: union-find on a two-dimensional grid.

Vertices are hashed into blocks and every edge into the cell of its two blocks. Each cell runs a local
union-find; the representatives that a vertex got in its row and column of cells are then exchanged and
parents are followed once, until they are stable. The state is one edge for each vertex and cell, is
checkpointed every round and never reaches the driver.

Defined cases: null ends and self edges add nothing; repeated and turned edges count once; empty edges give
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.common import durable

#: Edges a cell should hold; the number of blocks follows from it.
EDGES_PER_CELL = 100_000
MAX_ROUNDS = 60


def local_union(cell: pd.DataFrame) -> pd.DataFrame:
    """Union-find within one cell: each vertex with the smallest of its local component."""
    n = len(cell)
    names, codes = np.unique(np.concatenate([cell["v"].to_numpy(str), cell["u"].to_numpy(str)]), return_inverse=True)
    pairs = np.unique(np.stack([codes[:n], codes[n:]], axis=1), axis=0)
    parent = list(range(len(names)))
    for a, b in pairs.tolist():
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    for i, p in enumerate(parent):  # a parent is never larger, so it is settled before
        parent[i] = parent[p]
    child = np.flatnonzero(np.asarray(parent) != np.arange(len(parent)))
    return pd.DataFrame({"x": names[child], "root": names[np.asarray(parent)[child]]})


def connected_groups(edges: DataFrame, a: str, b: str, edges_per_cell: int = EDGES_PER_CELL) -> DataFrame:
    """(vertex, group): every vertex of an edge between two vertices; group is the smallest vertex."""
    e = durable(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter(F.col("v") != F.col("u")))
    blocks = max(2, math.ceil(math.sqrt(2 * e.count() / edges_per_cell)))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    for _ in range(MAX_ROUNDS):
        cells = e.withColumns({"r": F.least(block("u"), block("v")), "c": F.greatest(block("u"), block("v"))})
        local = cells.groupBy("r", "c").applyInPandas(lambda cell: local_union(cell), "x string, root string")
        # at most one root for each cell of the vertex's row and column: 2 * blocks - 1
        step = local.groupBy("x").agg(F.min("root").alias("m"), F.collect_set("root").alias("roots"))
        step = durable(step)
        up = step.select(F.col("x").alias("px"), F.col("m").alias("pm"))
        step = durable(step.join(up, F.col("m") == F.col("px"), "left").select("x", "m", "roots", "pm"))
        open_ = step.filter((F.size("roots") > 1) | F.col("pm").isNotNull()).limit(1).count()
        if not open_:
            return step.select(F.col("x").alias("vertex"), F.col("m").alias("group")).unionByName(step.select(F.col("m").alias("vertex"), F.col("m").alias("group")).distinct())
        own = step.select(F.col("x").alias("v"), F.coalesce("pm", "m").alias("u"))
        others = step.filter((F.size("roots") > 1) | F.col("pm").isNotNull()).select(F.explode("roots").alias("v"), F.coalesce("pm", "m").alias("u")).filter("v <> u")
        e = own.unionByName(others)
    raise RuntimeError(f"no stable parents after {MAX_ROUNDS} rounds")
