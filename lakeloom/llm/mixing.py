"""Mixing sources to target weights by pivotal dependent rounding (built-in functions only).

Each source's target divided by its size is the expected number of copies of its documents:
whole copies are taken outright, the fraction is a copy probability. Probabilities are rounded
by the pivotal method on words: two documents trade probability, one word's worth against one
word's worth, in a random direction with the odds that keep every expectation, until one of them
is integral; the other goes on. Documents are dealt into leaves of at most about ``leaf``
documents of one source and size class, each leaf is one fold over an array, and the one
fractional document a leaf may end with meets those of other leaves in the next level. Words are
conserved exactly in every trade. At the root the last open documents of each size class are
rounded, largest first, carrying the error on, so a source misses its target by about half of its
smallest open document. Random numbers are hashes of the document, so reruns agree.

Defined cases: a null text has no words; documents without words take 0; a null source is a
source of its own, last in order; repeated rows (same id, same size) are rounded each; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm._shared import staged

MOST = 3  # copies of a document at most; a target stops at this many times its source's size
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Weights are 1, 2, 3, 1, ... in code point order, null last. The water level at which
    sum(min(weight * level, most * size)) is the whole size has a closed form over the sources
    ordered by cap / weight: all sources before the level are capped, the rest share what is left.
    The windows run over one row per source.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    w = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    w = w.withColumn("cap", (most * F.col("source_size")).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    w = (
        w.withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("free", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # the level if exactly the sources before this one are capped; right where it stays below this cap
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("free"))
        .withColumn("holds", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("rank", F.row_number().over(by_cap))
    )
    first = F.min(F.when(F.col("holds"), F.struct("rank", "level"))).over(whole)
    w = w.withColumn("level", first["level"])
    target = F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap"))
    return w.select("source", "source_size", target.alias("target"))


# A document inside the reduction tree: p is its fractional copy, r its random number in [0, 1).
_FIELDS = ("doc_id", "size", "source_size", "target", "whole", "p", "r")
_ITEM = "struct<doc_id:bigint,size:bigint,source_size:bigint,target:double,whole:int,p:double,r:double>"


def _fold() -> Column:
    """Fold of ``items``: struct(held, done), trading words between the held and the next document.

    ``up`` words would make the held document whole or empty the next one, ``down`` words the
    other way round; the move is up with odds down : up, so both expectations stay.
    """

    def moved(item: str, p: str) -> str:
        snapped = f"CASE WHEN {p} < {EPS} THEN 0D WHEN {p} > {1 - EPS} THEN 1D ELSE {p} END"
        return "named_struct({})".format(", ".join(f"'{f}', {snapped if f == 'p' else f'{item}.{f}'}" for f in _FIELDS))

    a, b = moved("acc.held", "(acc.held.p + move / acc.held.size)"), moved("x", "(x.p - move / x.size)")
    trade = f"""
        transform(transform(transform(
          array(named_struct(
            'up', least((1 - acc.held.p) * acc.held.size, x.p * x.size),
            'down', least(acc.held.p * acc.held.size, (1 - x.p) * x.size))),
          t -> IF(x.r * (t.up + t.down) < t.down, t.up, -t.down)),
          move -> named_struct('a', {a}, 'b', {b})),
          y -> CASE
            WHEN y.a.p IN (0D, 1D) AND y.b.p IN (0D, 1D)
              THEN named_struct('held', CAST(NULL AS {_ITEM}), 'done', concat(acc.done, array(y.a, y.b)))
            WHEN y.a.p IN (0D, 1D) THEN named_struct('held', y.b, 'done', concat(acc.done, array(y.a)))
            ELSE named_struct('held', y.a, 'done', concat(acc.done, array(y.b)))
          END)[0]"""
    return F.expr(f"""
        aggregate(
          items,
          named_struct('held', CAST(NULL AS {_ITEM}), 'done', CAST(array() AS array<{_ITEM}>)),
          (acc, x) -> IF(acc.held IS NULL, named_struct('held', x, 'done', acc.done), {trade}))""")


def _settle() -> Column:
    """Whole copies for the last few documents of a source, largest first, carrying the error on."""
    return F.expr(f"""
        aggregate(
          items,
          named_struct('owed', 0D, 'done', CAST(array() AS array<struct<item:{_ITEM},p:double>>)),
          (acc, x) -> transform(array(acc.owed + x.p * x.size), owed -> IF(
            abs(owed - x.size) < abs(owed),
            named_struct('owed', owed - x.size, 'done', concat(acc.done, array(named_struct('item', x, 'p', 1D)))),
            named_struct('owed', owed, 'done', concat(acc.done, array(named_struct('item', x, 'p', 0D))))))[0])""")


def _random(seed: int) -> Column:
    bits = F.xxhash64(F.lit(seed), "doc_id", "size").bitwiseAND(F.lit((1 << 52) - 1))
    return bits / F.lit(float(1 << 52))


def _gathered(todo: DataFrame, seed: int, *keys: Column | str) -> DataFrame:
    """One row per group: n and ``items``, its documents from the largest to the smallest."""
    item = F.struct(F.col("size").alias("by_size"), _random(seed).alias("r"), "n", *_FIELDS[:-1])
    return todo.groupBy(*keys).agg(F.sort_array(F.collect_list(item), asc=False).alias("a")).select(
        "source", F.col("a")[0]["n"].alias("n"),
        F.expr("transform(a, x -> named_struct({})) AS items".format(", ".join(f"'{f}', x.{f}" for f in _FIELDS))),
    )


def pivotal_round(items: DataFrame, leaf: int = 256, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, whole, p) with every p 0 or 1.

    ``items``: source, n (a bound on its documents) and doc_id, size, source_size, target,
    whole, p with 0 < p < 1 and size > 0. Documents trade with documents of their size class
    (power of two), so each level hands on at most one document a leaf and class. At the root a
    source has three open documents a class left at most (200 at most, as sizes are below 2^63).
    """
    if leaf < 32:
        raise ValueError("a leaf of fewer than 32 documents does not shrink the levels")
    keep = _FIELDS[:-1]
    kind = F.floor(F.log2("size")).alias("kind")
    most = items.agg(F.max("n").alias("n")).first()["n"] or 0
    done, todo, level = [], items, 0
    while True:
        spread = F.xxhash64(F.lit(seed), F.lit(level), "doc_id", "size")
        dealt = F.pmod(spread, F.ceil(F.col("n") / leaf)).alias("leaf")
        # at the root two small documents of each class stay open, to settle what is owed
        spare = F.lit(2 if most <= leaf else 0)
        folds = F.greatest(F.size("items") - spare, F.lit(0))
        folded = staged(
            _gathered(todo, seed + 1 + level, "source", kind, dealt)
            .select("source", "n", F.slice("items", folds + 1, F.size("items")).alias("open"),
                    F.slice("items", F.lit(1), folds).alias("items"))
            .select("source", "n", "open", _fold().alias("out")),
            "pivotal",
        )
        done.append(folded.select(F.explode("out.done").alias("x")).select(*(f"x.{f}" for f in keep)))
        still = F.expr("explode(concat(open, filter(array(out.held), x -> x IS NOT NULL)))").alias("x")
        held = folded.select("source", (16 * F.ceil(F.col("n") / leaf)).alias("n"), still).select(
            "source", "n", *(f"x.{f}" for f in keep)
        )
        if most <= leaf:
            break
        todo, most, level = held, 16 * -(-most // leaf), level + 1
    settled = _gathered(held, seed, "source").select(F.explode(_settle()["done"]).alias("x"))
    done.append(settled.select(*(f"x.item.{f}" for f in keep[:-1]), F.col("x.p").alias("p")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mix_copies(docs: DataFrame, leaf: int = 256, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and copies (0 to 3) of every row."""
    rows = staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size")),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("n")
    )
    targets = source_targets(sizes.select("source", "source_size")).withColumnRenamed("source", "name")
    ratio = F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0))
    ratio = F.when(F.abs(ratio - F.round(ratio)) < EPS, F.round(ratio)).otherwise(ratio)
    targets = staged(
        targets.join(sizes.select(F.col("source").alias("name2"), "n"), F.col("name").eqNullSafe(F.col("name2")))
        .select("name", "source_size", "target", "n", F.floor(ratio).cast("int").alias("whole"),
                (ratio - F.floor(ratio)).alias("p")),
        "mix-targets",
    )
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    rounded = pivotal_round(joined.where(open_), leaf, seed)
    names = ["doc_id", "size", "source_size", "target"]
    return joined.where(~open_).select(*names, F.col("whole").alias("copies")).unionByName(
        rounded.select(*names, (F.col("whole") + F.col("p")).cast("int").alias("copies"))
    )


def repeated(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as ``mix = mix_copies(docs)`` takes it."""
    # rows that repeat an id with equal sizes get the same number of copies
    copies = mix.groupBy(F.col("doc_id").alias("__id"), F.col("size").alias("__words")).agg(
        F.max("copies").alias("__copies")
    ).where("__copies > 0")
    rows = docs.withColumn("__size", word_count(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__size") == F.col("__words"))
    taken = rows.join(copies, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return taken.select(*docs.columns)


def mix_documents(docs: DataFrame, leaf: int = 256, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of every row."""
    return mix_copies(docs, leaf, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )
