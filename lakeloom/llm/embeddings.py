"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

A vector is padded to a power of two, rotated three times by (random signs, Hadamard transform)
and hashed to the signed axis it lies closest to; a table concatenates ``hashes`` such codes, and
``tables`` tables are kept. Multiprobe: besides its home bucket a vector is also put into the
buckets that differ by the runner-up axis of one code. Two vectors with equal labels that share a
bucket are compared by their exact cosine in double precision.

Skew and repeated work: vectors equal in label and value are one class with a weight. A bucket
of more than ``block`` classes is cut into blocks, and each pair of blocks is a unit of work, so
no task holds a whole hot bucket and no pair is ever written out: a unit emits, per class, the
weight of the links it found, and the links of a spanning forest. A pair seen in several buckets is
counted only in the smallest bucket key that the two share, which both carry.

Defined cases: a vector that is null, empty, all zero or holds null or non-finite parts links
with nothing, and neither does one with a null label or a null id; vectors of different lengths
never link; repeated rows are vectors of their own (each counts as the other's link); an empty
table gives an empty result; only vec_id, embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import binary_matrix, key_runs, staged
from lakeloom.llm.components import connected_components

COSINE = 0.98
TABLES = 6
BLOCK = 1024
LEAST_WIDTH = 64  # vectors are padded to it, as rotations of a few axes mix sparse vectors too little


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / math.sqrt(d)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def bucket_keys(unit: np.ndarray, tables: int, hashes: int, seed: int = 0) -> np.ndarray:
    """(rows, tables * (1 + hashes)) bucket keys: home and runner-up buckets of every table."""
    n, width = unit.shape
    d = max(LEAST_WIDTH, 1 << max(1, (width - 1).bit_length()))
    padded = np.zeros((n, d))
    padded[:, :width] = unit
    rng = np.random.default_rng([seed, d])
    out = []
    for t in range(tables):
        first, second = [], []
        for _ in range(hashes):
            x = padded
            for _ in range(3):
                x = _hadamard(x * rng.choice([-1.0, 1.0], d))
            axes = np.argpartition(np.abs(x), -2, axis=1)[:, -2:]
            size = np.take_along_axis(np.abs(x), axes, 1)
            best = np.take_along_axis(axes, size.argmax(1)[:, None], 1)[:, 0]
            next_ = axes.sum(axis=1) - best  # the other one, also where both are equal
            rows = np.arange(n)
            first.append(2 * best + (x[rows, best] < 0))
            second.append(2 * next_ + (x[rows, next_] < 0))
        for probe in range(-1, hashes):
            key = np.full(n, (width << 16) + t, np.uint64)
            for h in range(hashes):
                code = second[h] if h == probe else first[h]
                key = _mix64(key * np.uint64(0x9E3779B97F4A7C15) + code.astype(np.uint64) + np.uint64(1))
            out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector's 32-bit floats as bytes, or null where it can link with nothing."""
    for b in batches:
        out = []
        for vec, label, vec_id in zip(b.column(2), b.column(1).to_pylist(), b.column(0).to_pylist()):
            value = None
            if vec.is_valid and label is not None and vec_id is not None and vec.values.null_count == 0:
                x = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if len(x) and np.isfinite(x).all() and x.any():
                    value = x.tobytes()
            out.append(value)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["vec_id", "label", "vec"])


def _hashed(tables: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column("vec").to_pylist()
            keys = [None] * len(vecs)
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vecs):
                by_length.setdefault(len(v), []).append(i)
            for rows in by_length.values():
                x = _units(np.frombuffer(b"".join(vecs[i] for i in rows), "<f8").reshape(len(rows), -1))
                for i, k in zip(rows, bucket_keys(x, tables, hashes)):
                    keys[i] = np.unique(k).tobytes()
            lists = pa.array([np.frombuffer(k, "<i8") for k in keys], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=["rep", "label", "vec", "weight", "buckets"])

    return run


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _least_common(a: list[np.ndarray], i: np.ndarray, j: np.ndarray, key: int) -> np.ndarray:
    """Whether ``key`` is the smallest bucket that the classes i and j share."""
    width = max(map(len, a))
    mine = np.full((len(a), width), np.iinfo(np.int64).max)
    for r, k in enumerate(a):
        below = k[k < key]
        mine[r, : len(below)] = below
    out = np.ones(len(i), bool)
    for at in range(0, len(i), 65_536):
        p, q = mine[i[at : at + 65_536]], mine[j[at : at + 65_536]]
        for c in range(width):
            same = (q[:, c : c + 1] == p) & (p != np.iinfo(np.int64).max)
            out[at : at + 65_536] &= ~same.any(axis=1)
    return out


_FOUND = "rep long, links long, other long"


def _compare(cosine: float):
    """Links of every unit (label, bucket, block a, block b): counts and a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in key_runs(batches, ["label", "bucket", "a", "b"]):
            rep, weight = rows.column("rep").to_numpy(), rows.column("weight").to_numpy()
            key, side = rows.column("bucket").to_numpy(), rows.column("side").to_numpy()
            one = (rows.column("a").to_numpy() == rows.column("b").to_numpy())
            vecs, buckets = rows.column("vec").to_pylist(), rows.column("buckets").to_pylist()
            out: list[np.ndarray] = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s < 2:
                    continue
                lengths = np.array([len(v) for v in vecs[s:e]])
                if (lengths != lengths[0]).any():  # 64-bit key clash between vector lengths
                    continue_rows = [s + np.flatnonzero(lengths == n) for n in np.unique(lengths)]
                else:
                    continue_rows = [np.arange(s, e)]
                for at in continue_rows:
                    x = _units(np.frombuffer(b"".join(vecs[k] for k in at), "<f8").reshape(len(at), -1))
                    near = x @ x.T >= cosine
                    np.fill_diagonal(near, False)
                    if not one[s]:
                        near &= side[at][:, None] != side[at][None, :]
                    if not near.any():
                        continue
                    i, j = np.nonzero(np.triu(near))
                    mine = _least_common([np.asarray(buckets[k], np.int64) for k in at], i, j, key[s])
                    count = np.zeros(len(at), np.int64)
                    np.add.at(count, i[mine], weight[at][j[mine]])
                    np.add.at(count, j[mine], weight[at][i[mine]])
                    label = np.arange(len(at))
                    while True:
                        low = np.minimum(label, np.where(near, label[None, :], len(at)).min(axis=1))
                        low = low[low]
                        if (low == label).all():
                            break
                        label = low
                    keep = (count > 0) | (label != np.arange(len(at)))
                    out.append(np.stack([rep[at], count, rep[at][label]], axis=1)[keep])
            if out:
                m = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([pa.array(m[:, c]) for c in range(3)], names=["rep", "links", "other"])

    return run


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int | None = None, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    rows = staged(
        vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
        .mapInArrow(_usable, "vec_id long, label long, vec binary"),
        "vectors",
    )
    classes = rows.where("vec IS NOT NULL").groupBy("label", "vec").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")
    )
    if hashes is None:
        # unrelated vectors a bucket: about 64 at most, at 128 axes or more a code
        hashes = max(2, math.ceil(math.log(max(rows.count(), 2) / 64, 128)))
    known = staged(
        classes.select("rep", "label", "vec", "weight").mapInArrow(
            _hashed(tables, hashes), "rep long, label long, vec binary, weight long, buckets array<long>"
        ),
        "vector-classes",
    )
    postings = known.select("rep", "label", F.explode("buckets").alias("bucket"))
    sizes = postings.groupBy("label", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    units = postings.join(sizes, ["label", "bucket"])
    units = units.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    units = units.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "label", "bucket", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"),
        (F.col("own") <= F.col("with")).cast("int").alias("side"),
    )
    work = units.join(known.select("rep", "vec", "weight", "buckets"), "rep").repartition("label", "bucket", "a", "b")
    found = staged(
        work.sortWithinPartitions("label", "bucket", "a", "b").mapInArrow(_compare(cosine), _FOUND), "vector-links"
    )
    parts = connected_components(found.where("other <> rep").select(F.col("rep").alias("u"), F.col("other").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    result = (
        known.select("rep", "label", "vec", "weight")
        .join(links, "rep", "left")
        .join(parts.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            F.col("label").alias("l"), F.col("vec").alias("v"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("component", "rep").alias("c"),
        )
    )
    return rows.join(result, (rows["label"] == result["l"]) & (rows["vec"] == result["v"]), "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("c", "vec_id")).alias("kept"),
    )
