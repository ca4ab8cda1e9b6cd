"""Centroid clustering of embeddings by Lloyd rounds with Shallot's nearest-centroid search.

Vectors become integers once, so every distance that decides is an exact integer. A vector keeps,
from round to round, its centroid, its second-nearest centroid, an upper bound of the distance to
the first and a lower bound of the distance to every other one. After the centroids have moved,
the bounds move by their drift; a vector whose bounds still separate is not looked at again. For the
others the search starts from the closer one of the two remembered centroids and walks that one's
neighbours in ascending distance; it ends where a neighbour is farther than (distance to the start
+ best second distance so far), a ball that shrinks while the scan finds closer centroids.
Centroids inside the ball are compared by (squared integer distance, number).

Bounds are doubles rounded outwards by ``SLACK``, so rounding can cost a search but never a
result. A round is one pass over the table, written to the shared folder with its state; the sums of
the next centroids are a partial aggregate of fixed width. The driver holds the centroids only.

Defined cases: a vector that is null, of another length, or holds a null, a non-finite part or a part
of ``PART_LIMIT`` or more in size (its squared distance might not fit a long) gets no row; a null
vec_id takes part but is no starting centroid; rows that repeat a vec_id are vectors of their own,
ordered by their parts where they start as centroids; with fewer vectors than ``k`` there are
fewer centroids; equal centroids are told apart by number; an empty table gives an empty result;
only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import staged

WIDTH = 64
K = 40
ROUNDS = 5
SCALE = 256
SEED = 2
PART_LIMIT = 2**19  # of a part before scaling: 64 * (2 * 2**27)**2 is the largest that a long holds
SLACK = 1e-12

_STATE = "vec_id long, parts array<int>, cluster int, second int, upper double, lower double, distance long"


def integer_vectors(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, parts) of the vectors that take part, as integers floor(scale * x)."""
    whole = F.col("embedding").cast("array<double>")
    usable = (F.size("v") == width) & F.forall("v", lambda x: F.abs(x) < float(PART_LIMIT))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
        .where(F.coalesce(usable, F.lit(False)))  # NaN sorts above the limit, a null part makes the test null
        .select("vec_id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("int")).alias("parts"))
    )


def first_centroids(kept: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``<seed>:<vec_id>``: a distributed top-k of k rows."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.where("vec_id IS NOT NULL").orderBy(rank, "parts").limit(k).collect()
    return np.array([r["parts"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["parts"]) if rows else 0)


class Shallot:
    """Nearest centroids of batches of integer vectors, with what the bounds need of the last move."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None) -> None:
        self.c = centroids.astype(np.int64)
        k = len(self.c)
        gap = np.sqrt(((self.c[:, None, :] - self.c[None, :, :]) ** 2).sum(axis=2).astype(np.float64))
        self.order = np.argsort(gap, axis=1, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, 1) * (1 - SLACK)
        # the centroid itself may not come first where another one equals it
        self.half = np.where(np.eye(k, dtype=bool), np.inf, gap).min(axis=1, initial=np.inf) * (0.5 - SLACK)
        if before is None:
            self.drift = None
            return
        self.drift = np.sqrt(((self.c - before) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)
        most = np.argsort(-self.drift, kind="stable")
        self.other_drift = np.full(k, self.drift[most[0]])
        self.other_drift[most[0]] = self.drift[most[1]] if k > 1 else 0.0

    def distance(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        d = x - self.c[which]
        return (d * d).sum(axis=1)

    def moved(self, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bounds after the centroids' last move."""
        return (upper + self.drift[cluster]) * (1 + SLACK), (lower - self.other_drift[cluster]) * (1 - SLACK) - SLACK

    def assign(self, x, cluster, second, upper, lower):
        """(cluster, second, upper, lower) of the vectors x; state None on the first round."""
        n, k = len(x), len(self.c)
        if k == 1:
            zero = np.zeros(n, np.int32)
            return zero, zero, np.zeros(n), np.full(n, np.inf)
        if cluster is None:
            cluster, second = np.zeros(n, np.int32), np.ones(n, np.int32)
            upper, lower = np.full(n, np.inf), np.zeros(n)
        else:
            upper, lower = self.moved(cluster, upper, lower)
        cluster, second = cluster.copy(), second.copy()
        bound = np.maximum(lower, self.half[cluster])
        at = np.flatnonzero(upper >= bound)
        upper[at] = np.sqrt(self.distance(x[at], cluster[at]).astype(np.float64)) * (1 + SLACK)
        at = at[upper[at] >= bound[at]]
        if len(at):
            cluster[at], second[at], upper[at], lower[at] = self.search(x[at], cluster[at], second[at])
        return cluster, second, upper, lower

    def search(self, x, cluster, second):
        one, two = self.distance(x, cluster), self.distance(x, second)
        closer = (two < one) | ((two == one) & (second < cluster))
        best, best_d = np.where(closer, second, cluster), np.where(closer, two, one)
        next_, next_d = np.where(closer, cluster, second), np.where(closer, one, two)
        start, radius = best.copy(), np.sqrt(best_d.astype(np.float64)) * (1 + SLACK)
        for b in np.unique(start):
            rows = np.flatnonzero(start == b)
            for neighbour, gap in zip(self.order[b], self.gap[b]):
                # the ball shrinks with the second distance, and neighbours only get farther
                rows = rows[radius[rows] + np.sqrt(next_d[rows].astype(np.float64)) * (1 + SLACK) >= gap]
                if not len(rows):
                    break
                todo = rows[(best[rows] != neighbour) & (next_[rows] != neighbour)]
                if not len(todo):
                    continue
                d = x[todo] - self.c[neighbour]
                d = (d * d).sum(axis=1)
                first = (d < best_d[todo]) | ((d == best_d[todo]) & (neighbour < best[todo]))
                then = ~first & ((d < next_d[todo]) | ((d == next_d[todo]) & (neighbour < next_[todo])))
                up, side = todo[first], todo[then]
                next_[up], next_d[up] = best[up], best_d[up]
                best[up], best_d[up] = neighbour, d[first]
                next_[side], next_d[side] = neighbour, d[then]
        return (
            best, next_,
            np.sqrt(best_d.astype(np.float64)) * (1 + SLACK), np.sqrt(next_d.astype(np.float64)) * (1 - SLACK),
        )


def _round(centroids: np.ndarray, before: np.ndarray | None, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Shallot(centroids, before)
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy().astype(np.int64).reshape(b.num_rows, -1)
            state = [None] * 4 if before is None else [b.column(c).to_numpy() for c in range(2, 6)]
            cluster, second, upper, lower = search.assign(x, *state)
            distance = search.distance(x, cluster) if last else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1), pa.array(cluster, pa.int32()), pa.array(second, pa.int32()),
                    pa.array(upper), pa.array(lower), pa.array(distance, pa.int64()),
                ],
                names=["vec_id", "parts", "cluster", "second", "upper", "lower", "distance"],
            )

    return run


def _means(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids moved to floor(sum / count) of their vectors; k rows reach the driver."""
    width = centroids.shape[1]
    sums = ", ".join(f"sum(parts[{i}])" for i in range(width))
    out = centroids.copy()
    for r in assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.expr(f"array({sums})").alias("s")).collect():
        out[r["cluster"]] = [s // r["n"] for s in r["s"]]
    return out


def cluster_vectors(
    vectors: DataFrame, width: int = WIDTH, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    table = staged(integer_vectors(vectors, width, scale), "cluster-vectors")
    centroids, before = first_centroids(table, k, seed), None
    if not len(centroids):
        return table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    for r in range(rounds + 1):
        table = staged(table.mapInArrow(_round(centroids, before, r == rounds), _STATE), "cluster-round")
        if r < rounds:
            before, centroids = centroids, _means(table, centroids)
    return table.select("vec_id", "cluster", "distance"), centroids


def clustered(vectors: DataFrame, **options) -> DataFrame:
    """The contract's rows: the assignment with its inertia and the digest of the final centroid."""
    found, centroids = cluster_vectors(vectors, **options)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # k rows
    inertia = sum(int(r["d"]) for r in per)
    rows = [(r["cluster"], int(r["d"]), inertia, digests[r["cluster"]]) for r in per]
    known = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(known), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle_sql(width: int = WIDTH, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rounds by brute force over all centroids."""
    square = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (v.p[i] - c.p[i]) * (v.p[i] - c.p[i])))"
    parts = [
        f"kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) "
        f"AS p FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) >= {PART_LIMIT})) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, p) - 1 AS j, p FROM (SELECT sha256('{seed}:' || vec_id) AS h, p "
        f"FROM kept WHERE vec_id IS NOT NULL ORDER BY h, p LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"a{r} AS MATERIALIZED (SELECT v.vec_id, v.p, min(struct_pack(d := {square}, j := c.j)) AS m FROM "
            f"(SELECT row_number() OVER () AS row, * FROM kept) v, c{r} c GROUP BY v.row, v.vec_id, v.p)"
        )
        if r < rounds:
            mean = (
                f"list_transform(range(1, {width + 1}), lambda i: (list_sum(list_transform(ps, lambda q: q[i])) - "
                "((list_sum(list_transform(ps, lambda q: q[i])) % len(ps)) + len(ps)) % len(ps)) // len(ps))"
            )
            parts.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce({mean}, c.p) AS p FROM c{r} c LEFT JOIN "
                f"(SELECT m.j AS j, list(p) AS ps FROM a{r} GROUP BY m.j) s ON c.j = s.j)"
            )
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, CAST(m.j AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, "
        "CAST(sum(m.d) OVER (PARTITION BY m.j) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia, "
        f"sha256(array_to_string(c.p, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.j = a.m.j"
    )


ORACLE_SQL = _oracle_sql()
