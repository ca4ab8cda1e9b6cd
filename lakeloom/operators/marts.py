"""Gold-mart operators: fact-dimension view counts, dense ranking, top-with-ties.

Scale notes
-----------
* The fact is pre-aggregated by (group keys, join key) *before* the join, and the
  dimension is reduced to (key, multiplicity). A key holding a third of all fact rows
  collapses to one row per map task in the partial aggregate, so the join never sees
  the skew, and duplicate dimension keys still multiply counts exactly like a row join.
* Ranking and top-with-ties never run a window partitioned only by a low-cardinality
  period (that would send all items of a year to one task). ``dense_rank`` of a count
  equals the rank of that count among the *distinct* counts of its period, and a
  period with N views has at most sqrt(2N) distinct counts; the window runs over that
  small table and the rank is joined back in salted copies. Top-with-ties is ``count == max(count)`` per
  period, a two-phase aggregate plus an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeloom.functions.casts import legacy_cast
from lakeloom.operators.transforms import q


def _key_expr(fact: DataFrame, fact_key: str, target_type) -> Column:
    src = fact.schema[fact_key].dataType
    if src == target_type:
        return q(fact_key)
    if isinstance(src, StringType):
        return legacy_cast(q(fact_key), target_type)
    return q(fact_key).try_cast(target_type)


def fact_dim_counts(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    group_by: Sequence[str | Column],
    keep_key_as: str | None = None,
    count_name: str = "views",
    dim_group_by: Sequence[str | Column] = (),
) -> DataFrame:
    """``count(*)`` of ``fact JOIN dim ON fact_key = dim_key`` grouped by fact columns
    (``group_by``) and dimension columns (``dim_group_by``).

    Both sides are aggregated before the join: the fact to (groups, key, n), the
    dimension to (key, dim groups, m); the joined count is ``sum(n * m)``, exactly the
    row count of the row-level join. With ``keep_key_as`` the key is an extra group.
    Text fact keys go through the lenient cast: ``'3.0'`` matches 3, ``'google'`` drops out.
    """
    key_t = dim.schema[dim_key].dataType
    groups = [q(g) if isinstance(g, str) else g for g in group_by]
    f = fact.select(*groups, _key_expr(fact, fact_key, key_t).alias("__key")).where(F.col("__key").isNotNull())
    names = [c for c in f.columns if c != "__key"]
    fa = f.groupBy(*[q(n) for n in names], "__key").agg(F.count(F.lit(1)).alias("__n"))
    dgroups = [q(g) if isinstance(g, str) else g for g in dim_group_by]
    d0 = dim.select(q(dim_key).alias("__key"), *dgroups).where(F.col("__key").isNotNull())
    dnames = [c for c in d0.columns if c != "__key"]
    d = d0.groupBy("__key", *[q(n) for n in dnames]).agg(F.count(F.lit(1)).alias("__m"))
    j = fa.join(d, "__key")
    out_groups = [q(n) for n in names] + [q(n) for n in dnames]
    if keep_key_as:
        out_groups.append(F.col("__key").alias(keep_key_as))
    return j.groupBy(*out_groups).agg(F.sum(F.col("__n") * F.col("__m")).alias(count_name))


# Copies of a rank level, dealt over as many keys: a third of all items share the lowest count of a period.
LEVEL_COPIES = 64


def dense_rank_counts(
    counts: DataFrame,
    partition_col: str,
    count_col: str,
    rank_col: str = "rank",
    copies: int = LEVEL_COPIES,
) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY partition_col ORDER BY count_col DESC)``.

    Valid for non-negative integer counts: the window only sees distinct
    (partition, count) pairs, at most sqrt(2 * total) per partition. Null partitions form
    their own group, as in a window. Each level is joined back in ``copies`` copies, so that
    the rows of one hot (partition, count) go to as many tasks.
    """
    levels = counts.select(partition_col, count_col).distinct()
    w = Window.partitionBy(partition_col).orderBy(F.col(count_col).desc())
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    r = levels.withColumn(rank_col, F.dense_rank().over(w)).withColumn("__copy", copy).alias("__r")
    dealt = F.pmod(F.xxhash64(*[q(c) for c in counts.columns]), F.lit(copies)).cast("int")
    c = counts.withColumn("__copy", dealt).alias("__c")
    joined = c.join(
        r,
        (F.col(f"__c.{partition_col}").eqNullSafe(F.col(f"__r.{partition_col}")))
        & (F.col(f"__c.{count_col}") == F.col(f"__r.{count_col}"))
        & (F.col("__c.__copy") == F.col("__r.__copy")),
    )
    return joined.select(*[F.col(f"__c.`{x}`") for x in counts.columns], F.col(f"__r.{rank_col}"))


def top_with_ties(counts: DataFrame, partition_col: str, count_col: str) -> DataFrame:
    """Rows whose count is the largest of their partition, every tie kept."""
    best = counts.groupBy(partition_col).agg(F.max(count_col).alias("__best"))
    b = best.alias("__b")
    c = counts.alias("__c")
    joined = c.join(
        b,
        (F.col(f"__c.{partition_col}").eqNullSafe(F.col(f"__b.{partition_col}")))
        & (F.col(f"__c.{count_col}") == F.col("__b.__best")),
    )
    return joined.select("__c.*")


def totals_by(counts: DataFrame, group_col: str, count_col: str, out_col: str) -> DataFrame:
    return counts.groupBy(group_col).agg(F.sum(count_col).alias(out_col))


def views_by_period(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    period: Column | str,
    period_name: str = "year",
    total_name: str = "total_item_view",
) -> DataFrame:
    """Total joined fact rows per period (A1): the yearly view totals mart."""
    p = (q(period) if isinstance(period, str) else period).alias(period_name)
    return fact_dim_counts(fact, dim, fact_key, dim_key, [p], count_name=total_name)


def item_rank_by_period(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    period: Column | str,
    period_name: str = "year",
    total_name: str = "total_item_view",
    item_name: str = "item_id",
    rank_name: str = "view_ranking",
    item_from_dim: str | None = None,
) -> DataFrame:
    """Views per (period, item) and their dense rank within the period (A2 + W1).

    The item is the join key, or a dimension column named by ``item_from_dim``.
    """
    p = (q(period) if isinstance(period, str) else period).alias(period_name)
    if item_from_dim:
        counts = fact_dim_counts(fact, dim, fact_key, dim_key, [p], count_name=total_name,
                                 dim_group_by=[q(item_from_dim).alias(item_name)])
    else:
        counts = fact_dim_counts(fact, dim, fact_key, dim_key, [p], keep_key_as=item_name, count_name=total_name)
    ranked = dense_rank_counts(counts, period_name, total_name, rank_name)
    return ranked.select(period_name, total_name, item_name, rank_name)


def top_group_by_period(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    period: Column | str,
    group: Column | str,
    period_name: str = "year",
    group_name: str = "most_used_platform",
    usage_name: str = "total_platform_usage",
    group_from_dim: bool = False,
) -> DataFrame:
    """The most frequent group value per period with all ties (A3 + W2).

    ``group`` is a fact column, or a dimension column with ``group_from_dim=True``.
    """
    p = (q(period) if isinstance(period, str) else period).alias(period_name)
    g = (q(group) if isinstance(group, str) else group).alias(group_name)
    if group_from_dim:
        counts = fact_dim_counts(fact, dim, fact_key, dim_key, [p], count_name=usage_name, dim_group_by=[g])
    else:
        counts = fact_dim_counts(fact, dim, fact_key, dim_key, [p, g], count_name=usage_name)
    return top_with_ties(counts, period_name, usage_name).select(period_name, group_name, usage_name)


# Presentation names of the three gold marts (the reference's column titles).
PRESENTATION_NAMES = {
    "year": "Year",
    "total_item_view": "Total Item View",
    "item_id": "Item Id",
    "view_ranking": "View Ranking",
    "most_used_platform": "Most Used Platform",
    "total_platform_usage": "Total Platform Usage",
}


def presentation(df: DataFrame, newest_first: bool = True) -> DataFrame:
    """Spaced presentation titles (P8), newest year first (O1) for display or export.

    The sort is for presentation only; stored marts stay unsorted.
    """
    out = df.select([q(c).alias(PRESENTATION_NAMES.get(c, c)) for c in df.columns])
    if newest_first and "Year" in out.columns:
        out = out.orderBy(F.col("Year").desc_nulls_last())
    return out


# --------------------------------------------------------------------- time intelligence


def date_dimension(df: DataFrame, column: str) -> DataFrame:
    """One row a day between the first and the last date of ``column``, without gaps."""
    ends = df.agg(F.min(F.to_date(q(column))).alias("lo"), F.max(F.to_date(q(column))).alias("hi"))
    days = ends.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"), F.dayofweek("date").alias("day_of_week"))


def year_over_year(totals: DataFrame, year: str, value: str) -> DataFrame:
    """A yearly mart with the year before and the change to it; missing years count as zero.

    The mart has one row a year, so the window over all of it is small.
    """
    ends = totals.where(q(year).isNotNull()).agg(F.min(year).alias("lo"), F.max(year).alias("hi"))
    years = ends.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("__year"))
    filled = years.join(totals, F.col("__year") == q(year), "left").select(
        F.col("__year").alias(year), F.coalesce(q(value), F.lit(0)).alias(value))
    before = F.lag(F.col(value).cast("double")).over(Window.orderBy(year))
    return filled.withColumn("previous", before).withColumn("change", F.col(value) - F.col("previous")).withColumn(
        "change_ratio", F.when(F.col("previous") != 0, F.col("change") / F.col("previous")))


def share_of_total(counts: DataFrame, value: str, within: str | None = None, out: str = "share") -> DataFrame:
    """Each row's share of the total, of all rows or of its ``within`` group (E2): an aggregate joined back."""
    keys = [] if within is None else [within]
    totals = counts.groupBy(*keys).agg(F.sum(value).alias("__total"))  # one row a group
    if within is None:
        joined = counts.crossJoin(F.broadcast(totals))  # exactly one row: no pairs
    else:
        joined = counts.alias("c").join(totals.alias("t"), F.col(f"c.`{within}`").eqNullSafe(F.col(f"t.`{within}`"))).select(
            "c.*", "__total")
    return joined.withColumn(out, F.when(F.col("__total") != 0, q(value) / F.col("__total"))).drop("__total")
