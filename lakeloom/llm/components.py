"""Connected components over an edge table.

Every partition of the edges is first contracted to a spanning forest of its own (each vertex with the
smallest one of its tree), so copies of an edge and the inside of dense groups never leave their task.
A forest of at most ``ONE_TASK`` edges is finished by one task. A larger one goes through alternating
large-star and small-star rounds: each is a partial-aggregated minimum per vertex and a join back to
the edges; a hub vertex is pre-aggregated before the shuffle, and as the minima are written first,
adaptive execution can split its join partition. Vertices and edges never reach the driver; it sees
a row count a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import lean, staged

ONE_TASK = 1_000_000  # edges, 16 MB
HELD = 2_000_000  # edges that a task holds before it contracts them


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its tree) of the vertices that are not the smallest themselves."""
    ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    i, j = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[i], label[j])
        if (label[i] == low).all() and (label[j] == low).all():
            break
        np.minimum.at(label, label[i], low)  # whole trees meet at their roots
        np.minimum.at(label, label[j], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    tied = label != np.arange(len(ids))
    return ids[tied], ids[label[tied]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v, held = [], [], 0

    def rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["u", "v"])

    for batch in batches:
        u.append(batch.column(0).to_numpy())
        v.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= HELD:
            a, b = forest(np.concatenate(u), np.concatenate(v))
            u, v, held = [a], [b], len(a)
            if held > HELD // 2:  # little to contract: what is held goes on as it is
                yield rows(a, b)
                u, v, held = [], [], 0
    if held:
        yield rows(*forest(np.concatenate(u), np.concatenate(v)))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = staged(down.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _finished(edges: DataFrame) -> DataFrame:
    """Whether every edge leads to the smallest vertex: no vertex has two ends, and no end goes on."""
    twice = edges.groupBy("u").agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a < b").select("u")
    onward = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return twice.unionByName(onward)


def connected_components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(id, component) of every vertex of ``edges(u, v)``; component = smallest reachable id.

    Self links are ignored, so an isolated vertex does not appear. An empty edge table gives
    an empty result. Null ends are dropped.
    """
    ends = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    edges = staged(ends.mapInArrow(lean(_contracted), "u long, v long"), "cc-forest")
    if edges.count() <= one_task:
        edges = staged(edges.coalesce(1).mapInArrow(lean(_contracted), "u long, v long"), "cc-trees")
    else:
        while True:
            edges = staged(_small_star(_large_star(edges)), "cc-round")
            if _finished(edges).isEmpty():
                break
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("id"), "component").distinct()
    return stars.unionByName(roots)
