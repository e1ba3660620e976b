"""Connected components of an edge table by alternating large-star and small-star steps, with what a task holds contracted in between."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import arrow_rows, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. Large: every larger neighbour of a node is hung on the node's least neighbour (or itself).
    Small: every smaller neighbour, and the node, is hung on the least of them."""
    if large:
        sides = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    else:
        sides = edges  # u > v always
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        moved = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = sides.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


#: Edges that a task contracts at once.
HELD = 1_000_000


def reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges u, v that reach a lesser one, and the least that each reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while len(a):
        least, new = np.minimum(label[a], label[b]), label.copy()
        for end in (a, b):
            np.minimum.at(new, label[end], least)
        while (new[new] != new).any():
            new = new[new]
        label = new
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contracted(held: int):
    """Of a task's edges u, v, so many at a time: each node hung on the least one that it reaches over them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, v, n = [], [], 0
        for batch in batches:
            u.append(batch["u"].to_numpy(np.int64))
            v.append(batch["v"].to_numpy(np.int64))
            n += len(batch)
            if n > held:
                yield pd.DataFrame(dict(zip("uv", reached(np.concatenate(u), np.concatenate(v)), strict=True)))
                u, v, n = [], [], 0
        if n:
            yield pd.DataFrame(dict(zip("uv", reached(np.concatenate(u), np.concatenate(v)), strict=True)))

    return run


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    ends = edges.select("u", "v").distinct().select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("low")), F.struct(F.col("v").alias("id"), F.lit(0).alias("low")))).alias("e")).select("e.*")
    return ends.groupBy("id").agg(F.sum("low").alias("over"), F.min("low").alias("least")).where("over > 1 or (over = 1 and least = 0)").isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 60, held: int | None = None) -> DataFrame:
    """edges: columns a, b (any integer ids). Returns node, component (least id reachable), for nodes with an edge.

    Tasks contract the edges that they read; before a round what they left is read anew by as few tasks as hold it, `held` edges (HELD)
    each, so that a group whose edges lay in many tasks is contracted again, and up to `held` edges are done without a round.
    Rounds are logarithmic in the longest path. Each writes its edges to the shared folder, which cuts lineage; nothing of the edges reaches the driver. Joins on
    a hub's id are plain equality joins whose larger side Spark can split. Null ids and loops: ignored. No edges: no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v"))
    held = held or HELD
    with arrow_rows(edges.sparkSession, 1 << 14):
        contracted = lambda df: materialize(df.mapInPandas(_contracted(held), "u long, v long"))
        edges = contracted(edges)
        for _ in range(most_rounds):
            n = edges.count()
            edges = contracted(edges.coalesce(max(1, -(-n // held))))
            if n <= held or _settled(edges):
                break
            edges = contracted(materialize(_star(_star(edges, True), False)))
        else:
            raise RuntimeError("components didn't settle")
    edges = edges.distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
