"""Exact quantiles (linear interpolation, as pandas ``describe``) without a single-task sort.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer, and a
global window sorts the whole column in one task; neither survives a large table.

Here a quantile is the value at a known rank (``floor``/``ceil`` of ``(n-1)p``). For each
quantile we keep a bracket ``[lo, hi]`` that provably holds its ranks (``below`` values are
smaller than ``lo``). While a bracket holds more than ``limit`` values, a mergeable
``percentile_approx`` sketch over the bracket proposes a narrower one, and an exact count
verifies it (a wrong proposal is rejected, so sketch error can cost time but never
correctness). Sketches and counts of all columns are aggregates over the table as it is, one row
a pass: only values inside the last brackets become rows of their own. A bracket that a round
does not narrow is not refined further, one of a single value gives it. The values of
a small bracket are grouped by value and ranked with a window partitioned by (column,
bracket): at most ``limit`` distinct values per task. Larger ones are ranked by many tasks
(``distributed_ranks``): range partitions of the distinct values, written once, with a prefix
sum over their counts. The driver only holds the bounds: a few numbers per (column, target).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.values import _sql_name
from lakeloom.operators.parallel import scans_only, spread
from lakeloom.operators.transforms import q
from lakeloom.session import checkpoint_root, written


def numeric_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The numeric ``columns`` as doubles ``v0, v1, ...``, null where a cell is null or NaN."""
    values = [f"CASE WHEN NOT isnan(CAST({_sql_name(c)} AS DOUBLE)) THEN CAST({_sql_name(c)} AS DOUBLE) END AS v{i}"
              for i, c in enumerate(columns)]
    return spread(df.select(*[q(c) for c in columns])).selectExpr(*values)


def _in_bracket(v: Column, lo: float | None, hi: float | None) -> Column:
    inside = v.isNotNull()
    if lo is not None:
        inside = inside & (v >= F.lit(lo))
    if hi is not None:
        inside = inside & (v <= F.lit(hi))
    return inside


def _proposals(values: DataFrame, place: dict[str, Column], active: dict, accuracy: int) -> dict:
    """Bracket -> narrower (lo, hi) by one sketch a column and bracket, all in one aggregate row."""
    eps = 1.0 / accuracy  # error of a sketch's rank, as a share of its values
    wanted: dict[tuple, list[float]] = {}
    cuts = {}
    for (c, r), b in active.items():
        of_sketch = wanted.setdefault((c, b["lo"], b["hi"]), [])
        size = max(b["inside"] - 1, 1)
        start, stop = (r - b["below"]) / size - 2 * eps, (b["last"] - b["below"]) / size + 2 * eps
        cut = []
        for share in (start, stop):
            cut.append(len(of_sketch) if 0.0 < share < 1.0 else None)
            if cut[-1] is not None:
                of_sketch.append(share)
        cuts[(c, r)] = cut
    sketches = {k: shares for k, shares in wanted.items() if shares}
    if not sketches:
        return {}
    aggs = [F.percentile_approx(F.when(_in_bracket(place[c], lo, hi), place[c]), F.array(*map(F.lit, shares)), accuracy)
            for (c, lo, hi), shares in sketches.items()]
    found = dict(zip(sketches, values.agg(*[a.alias(f"s{i}") for i, a in enumerate(aggs)]).first()))
    out = {}
    for key, (start, stop) in cuts.items():
        b = active[key]
        qs = found.get((key[0], b["lo"], b["hi"]))
        if qs is not None and (start, stop) != (None, None):
            out[key] = (b["lo"] if start is None else qs[start], b["hi"] if stop is None else qs[stop])
    return out


def _verified(values: DataFrame, place: dict[str, Column], proposed: dict) -> dict:
    """Proposed bracket -> exact (values below it, values inside), all in one aggregate row."""
    aggs = []
    for i, ((c, _), (lo, hi)) in enumerate(proposed.items()):
        below = F.lit(0) if lo is None else F.count(F.when(place[c] < F.lit(lo), 1))
        aggs += [below.alias(f"b{i}"), F.count(F.when(_in_bracket(place[c], lo, hi), 1)).alias(f"n{i}")]
    one = values.agg(*aggs).first()
    return {key: (int(one[f"b{i}"]), int(one[f"n{i}"])) for i, key in enumerate(proposed)}


def distributed_ranks(values: DataFrame) -> DataFrame:
    """``values(column, bid, below, v, cnt)`` with ``cum``, the running count of each (column, bid) by v.

    The values are range-partitioned and written, which fixes the partitions; each partition counts
    its own, the partition counts - a few a bracket and partition - give every partition what comes
    before it, and the running count is a window inside a partition.
    """
    spread_ = values.repartitionByRange("column", "bid", "v").withColumn("part", F.spark_partition_id())
    dealt = written(spread_, "quantile-ranges")
    own = dealt.groupBy("column", "bid", "part").agg(F.sum("cnt").alias("in_part"))
    earlier = Window.partitionBy("column", "bid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.select("column", "bid", "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("column", "bid", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dealt.join(offsets, ["column", "bid", "part"]).withColumn(
        "cum", F.col("offset") + F.sum("cnt").over(inside)).select(*values.columns, "cum")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    limit: int = 1_000_000,
    accuracy: int = 10_000,
    counts: dict[str, int] | None = None,
    refine: bool = True,
) -> DataFrame:
    """(column, prob, value) with pandas' linear interpolation; value null for empty columns.

    ``counts`` (non-null, non-NaN cells per column) may come from an aggregate the caller
    already ran; otherwise one counting pass runs first. ``refine=False`` ranks the whole columns
    without narrowing any bracket.
    """
    spark = df.sparkSession
    names = list(dict.fromkeys(columns))
    place = {c: F.col(f"v{i}") for i, c in enumerate(names)}
    values = numeric_values(df, names)
    if counts is None:
        one = values.agg(F.lit(0), *[F.count(place[c]).alias(f"n{i}") for i, c in enumerate(names)]).first()
        counts = {c: int(one[f"n{i}"]) for i, c in enumerate(names)}

    # the interpolation plan per (column, prob); brackets by column and first rank, each with its last one
    plan = []
    brackets: dict[tuple[str, int], dict] = {}
    for c in columns:
        n = counts.get(c, 0)
        for p in probs:
            if n == 0:
                plan.append((c, float(p), None, None, 0.0))
                continue
            h = (n - 1) * float(p)
            lo_r, hi_r = int(math.floor(h)), int(math.ceil(h))
            plan.append((c, float(p), lo_r, hi_r, h - lo_r))
            b = brackets.setdefault((c, lo_r), {"lo": None, "hi": None, "below": 0, "inside": n, "last": hi_r})
            b["last"] = max(b["last"], hi_r)

    refined = persisted = False
    while True:
        active = {k: b for k, b in brackets.items() if refine and b["inside"] > limit and not b.get("done")
                  and not (b["lo"] is not None and b["lo"] == b["hi"])}
        if not active:
            break
        if not refined and not scans_only(df):  # files are read again, anything else would be worked out again
            values, persisted = values.persist(StorageLevel.MEMORY_AND_DISK), True
        refined = True
        proposed = _proposals(values, place, active, accuracy)
        checked = _verified(values, place, proposed) if proposed else {}
        for key, b in active.items():
            below, ins = checked.get(key, (0, b["inside"]))
            if below <= key[1] and b["last"] < below + ins and ins < b["inside"]:
                b["lo"], b["hi"] = proposed[key]
                b["below"], b["inside"] = below, ins
            else:  # the sketch missed or did not narrow: the proven bracket is ranked as it is
                b["done"] = True

    # final exact step: rank the distinct values inside each distinct bracket once
    bracket_ids: dict[tuple, int] = {}
    known, target_rows, large = [], [], set()
    for (c, r), b in brackets.items():
        ranks = range(r, b["last"] + 1)  # one or two
        if b["lo"] is not None and b["lo"] == b["hi"]:
            known += [(c, rank, float(b["lo"])) for rank in ranks]
            continue
        bid = bracket_ids.setdefault((c, b["lo"], b["hi"], b["below"]), len(bracket_ids))
        target_rows += [(c, bid, rank) for rank in ranks]
        if b["inside"] > limit:
            large.add(bid)
    ranked = spark.createDataFrame(known, "column string, rank long, value double")
    if target_rows:
        bt = spark.createDataFrame([(c, bid, below) for (c, _, _, below), bid in bracket_ids.items()],
                                   "column string, bid int, below long")
        tt = spark.createDataFrame(target_rows, "column string, bid int, rank long").distinct()
        inside = {bid: _in_bracket(place[c], lo, hi) for (c, lo, hi, _), bid in bracket_ids.items()}
        cells = [F.when(inside[bid], F.struct(F.lit(bid).alias("bid"), place[c].alias("v")))
                 for (c, _, _, _), bid in bracket_ids.items()]
        counted = (
            values.where(reduce(lambda x, y: x | y, inside.values()))  # only values inside a bracket become rows
            .select(F.inline(F.array(*cells))).where("bid IS NOT NULL")
            .groupBy("bid", "v")  # distinct-value compression, map-side combine
            .agg(F.count(F.lit(1)).alias("cnt"))
            .join(F.broadcast(bt), "bid")  # bounded: columns x distinct brackets
            .select("column", "bid", "below", "v", "cnt")
        )
        w = Window.partitionBy("column", "bid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts = []
        if len(large) < len(bracket_ids):
            parts.append(counted.where(~F.col("bid").isin(sorted(large))).withColumn("cum", F.sum("cnt").over(w)))
        if large:
            parts.append(distributed_ranks(counted.where(F.col("bid").isin(sorted(large)))))
        placed = reduce(lambda x, y: x.unionByName(y), parts).select(
            "column", "bid", "v", (F.col("below") + F.col("cum") - F.col("cnt")).alias("first"),
            (F.col("below") + F.col("cum")).alias("after"))
        ranked = ranked.unionByName(
            placed.join(F.broadcast(tt), ["column", "bid"])  # bounded: columns x targets
            .where((F.col("first") <= F.col("rank")) & (F.col("rank") < F.col("after")))
            .select("column", "rank", F.col("v").alias("value"))
        )

    # both interpolation ends as rows, so the lookup is an equi-join on (column, rank)
    ends = [(c, p, end, r, frac) for (c, p, lo_r, hi_r, frac) in plan for end, r in (("lo", lo_r), ("hi", hi_r))]
    pt = spark.createDataFrame(ends, "column string, prob double, end string, rank long, frac double")
    out = (
        pt.join(F.broadcast(ranked), ["column", "rank"], "left")  # ranked: one row per target
        .groupBy("column", "prob", "frac")
        .agg(
            F.max(F.when(F.col("end") == "lo", F.col("value"))).alias("lo_v"),
            F.max(F.when(F.col("end") == "hi", F.col("value"))).alias("hi_v"),
        )
        .select("column", "prob", (F.col("lo_v") + F.col("frac") * (F.col("hi_v") - F.col("lo_v"))).alias("value"))
    )
    if refined:
        checkpoint_root(spark)
        out = out.checkpoint(eager=True)
    if persisted:
        values.unpersist()
    return out
