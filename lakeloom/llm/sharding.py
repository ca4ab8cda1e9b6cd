"""Size-balanced shards of indivisible groups by distributed Karmarkar-Karp differencing.

Rows with equal texts form a group (pre-aggregated, so a text with a third of all rows is one
number). Groups are dealt into buckets of about ``per_bucket``; in each bucket the largest
differencing method runs: the two partial partitions of largest spread are combined in opposite
order (largest part with smallest part) until one is left. A bucket's outcome is again a
partial partition - one number per shard - so the buckets are combined by the same rule in a
tree with ``fan_in`` children a node. Only (bucket, order of its shards) goes back to the rows.

The ``slot`` of a row in its shard needs no task that sees a whole shard: rows are numbered
inside (shard, block) and the blocks' counts are summed up.

Defined cases: a null text has no bytes (size 1, crc of nothing) and is grouped with the empty
text; repeated rows stay together (equal texts) with slots of their own; a null doc_id is a row
like any other; an empty table gives an empty result; extra columns are not read. A group larger
than an equal share makes its shard larger than the others; it is never split.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm._shared import bucket_count, staged

Part = tuple[int, int, int]  # sum, first and last item of the part's chain (-1: none)


def difference(starts: list[list[Part]], after: list[int]) -> list[Part]:
    """Karmarkar-Karp over partial partitions; ``after`` chains the items of a part."""
    heap = []
    for n, parts in enumerate(starts):
        parts = sorted(parts, key=lambda p: -p[0])
        heap.append((parts[-1][0] - parts[0][0], n, parts))
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        joined = []
        for (x, xf, xl), (y, yf, yl) in zip(a, reversed(b)):
            if xl < 0:
                joined.append((x + y, yf, yl))
            elif yf < 0:
                joined.append((x + y, xf, xl))
            else:
                after[xl] = yf
                joined.append((x + y, xf, yl))
        joined.sort(key=lambda p: -p[0])
        n += 1
        heapq.heapreplace(heap, (joined[-1][0] - joined[0][0], n, joined))
    return heap[0][2]


def _chain(first: int, after: list[int]) -> list[int]:
    out = []
    while first >= 0:
        out.append(first)
        first = after[first]
    return out


def _leaf(shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        empty = [(0, -1, -1)] * (shards - 1)
        after = [-1] * len(pdf)
        parts = difference([[(int(s), i, i), *empty] for i, s in enumerate(pdf["bytes"].tolist())], after)
        part = np.empty(len(pdf), np.int32)
        for p, (_, first, _) in enumerate(parts):
            part[_chain(first, after)] = p
        return pdf[["key", "bucket", "bytes"]].assign(part=part)

    return run


def _node(shards: int):
    """Combines the buckets of one node: where each bucket's parts go, and the node's sums."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket")
        sums = [list(map(int, s)) for s in pdf["sums"]]
        after = [-1] * (len(sums) * shards)
        starts = [[(s, b * shards + p, b * shards + p) for p, s in enumerate(row)] for b, row in enumerate(sums)]
        parts = difference(starts, after)
        to = [[0] * shards for _ in sums]
        for p, (_, first, _) in enumerate(parts):
            for item in _chain(first, after):
                to[item // shards][item % shards] = p
        return pd.DataFrame(
            {"bucket": pdf["bucket"], "parent": key[0], "to": to, "total": [[s for s, _, _ in parts]] * len(to)}
        )

    return run


def shard_groups(groups: DataFrame, shards: int, per_bucket: int = 4096, fan_in: int = 256) -> DataFrame:
    """(key, shard) for groups(key, bytes): sums of bytes per shard nearly equal."""
    buckets = bucket_count(groups.count(), per_bucket)
    leaves = staged(
        groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(_leaf(shards), "key binary, bucket long, bytes long, part int"),
        "kk-leaves",
    )
    sums = (
        leaves.groupBy("bucket", "part").agg(F.sum("bytes").alias("s"))
        .groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("part", "s"))).alias("m"))
        .select("bucket", F.array(*(F.coalesce(F.col("m")[p], F.lit(0)) for p in range(shards))).alias("sums"))
    )
    # routes: for each leaf bucket, where its parts have got to so far, and the node it is in
    here = F.array(*(F.lit(p) for p in range(shards)))
    routes = sums.select("bucket", F.col("bucket").alias("node"), here.alias("at"))
    while True:
        nodes = bucket_count(buckets, fan_in)
        step = staged(
            sums.groupBy(F.floor(F.col("bucket") / fan_in).alias("parent"))
            .applyInPandas(_node(shards), "bucket long, parent long, to array<int>, total array<long>"),
            "kk-node",
        )
        routes = staged(
            routes.join(step.select(F.col("bucket").alias("node"), "parent", "to"), "node").select(
                "bucket", F.col("parent").alias("node"), F.expr("transform(at, p -> to[p])").alias("at")
            ),
            "kk-routes",
        )
        if nodes == 1:
            break
        sums = step.select(F.col("parent").alias("bucket"), F.col("total").alias("sums")).distinct()
        buckets = nodes
    return leaves.join(routes.select("bucket", "at"), "bucket").select("key", F.col("at")[F.col("part")].alias("shard"))


def numbered(rows: DataFrame, shards: int, order: list[str], per_block: int = 50_000, least: int = 8) -> DataFrame:
    """``rows(shard, ...)`` with a gapless ``slot`` from 0 in every shard."""
    blocks = bucket_count(rows.count(), per_block * shards, least)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy(*order)
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "block"])
        .withColumn("slot", (F.col("first") + F.col("place")).cast("long"))
        .drop("block", "place", "first")
    )


def shard_documents(docs: DataFrame, shards: int = 16, per_bucket: int = 4096) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row (law ``bytes``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = staged(
        rows.join(shard_groups(groups, shards, per_bucket), "key").select("doc_id", "size", "text_crc32", "shard"),
        "shard-placed",
    )
    return numbered(placed, shards, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
