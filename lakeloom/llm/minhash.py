"""MinHash near-duplicates by bottom-k sketches of one hash function.

A document's sketch is the ``k`` smallest hashes of its shingle set. Documents with equal sets
are one class from the start. Inverted lists generate candidates: a list holds the classes whose
sketches contain the same two neighbouring retained values (two sets of similarity 0.8 keep some
neighbouring pair of 32 with a miss chance near 1e-9; sets no larger than the sketch always do).

No list is ever expanded into all its pairs:

1. star: every member of a list is paired with the list's smallest member. The union-sketch
   estimate filters the pairs, the exact Jaccard similarity of the full sets confirms them, and
   the confirmed links form components - a large group of near copies is one component now.
2. rest: only lists whose members still lie in several components go on, with the classes that meet
   other components in at least ``LEAST_LISTS`` of their lists. They are cut into blocks by
   component; each pair of blocks of different components is one unit of work that counts retained values shared by members of different
   components, and emits a spanning forest of the pairs that have enough in common for 0.8 -
   nothing per pair. The trees join up to families, which every pair still open lies in.
3. families: a family is cut into blocks by the number of its shingles. Each pair of blocks is a
   unit that compares its members of different components exactly, on their full sets, and emits a spanning forest of
   the links. (In a family of copies with many edits each, most pairs fall short of 0.8; they are
   compared inside the unit, but never written.) The components are formed again from all links.

Every pair of different components that shares a list is therefore tested; links inside a component
change no result. Full sets are made from the texts again, for candidates only.

Defined cases: a null, empty or all-white text has the empty set and links with nothing; a text
shorter than a shingle is one shingle; a null doc_id links with nothing; rows that repeat a doc_id
share one component; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import key_runs, lean, staged
from lakeloom.llm.components import connected_components
from lakeloom.llm.words import shingle_set

SHINGLE = 5
PERCENT = 80
K = 32
LEAST_SHARE = 0.43  # of a union sketch: a similarity of 0.8 stays below it with a chance of 1e-6
LEAST_LISTS = 3  # of 31: a similarity of 0.8 shares fewer with a chance under 1e-6
BLOCK = 2048  # classes of a list in one block
BLOCK_SHINGLES = 500_000  # shingles of a family in one block

_SETS = "doc_id long, n long, c1 long, c2 long, sketch array<long>"


def _long_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _sketches(shingle: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, c1, c2, sketch = [], [], [], []
            for text in _texts(b.column(1)):
                s = shingle_set(text, shingle)
                h = xxhash.xxh128_intdigest(s.tobytes())
                n.append(len(s))
                c1.append((h >> 64) - (1 << 63))
                c2.append((h & ((1 << 64) - 1)) - (1 << 63))
                sketch.append(s[:k].copy())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), _long_lists(sketch)],
                names=["doc_id", "n", "c1", "c2", "sketch"],
            )

    return run


def _full_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sets = [shingle_set(t, shingle) for t in _texts(b.column(1))]
                yield pa.RecordBatch.from_arrays([b.column(0), _long_lists(sets)], names=["doc_id", "shingles"])

    return run


def _similar_size(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def estimated(pairs: DataFrame, reps: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) whose union sketch does not rule the similarity out."""
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(right, "b").join(left, "a").where(_similar_size("na", "nb", percent))
    shared = both.withColumn("both", F.array_intersect("sa", "sb")).where(
        F.size("both") >= LEAST_SHARE * F.least(F.size("sa"), F.size("sb"))
    )
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    return shared.withColumn("union", union).where(
        F.size(F.array_intersect("union", "both")) >= LEAST_SHARE * F.size("union")
    ).select("a", "b")


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles): the whole shingle sets of the documents ``ids(doc_id)``."""
    sets = docs.join(staged(ids.distinct(), "near-needed"), "doc_id", "left_semi")
    return staged(sets.mapInArrow(lean(_full_sets(shingle)), "doc_id long, shingles array<long>"), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; exact."""
    # the set of b travels to a: the smallest member of a large list is not copied for its partners
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    both = pairs.join(right, "b").join(left, "a")
    both = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("s"))
    return staged(both.where(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b"), "near-links")


_FOREST = "u long, v long"


def _forest(batches_of: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """(rep, smallest rep of its tree) for (reps, i, j): links i[k] - j[k] between positions of reps."""
    out = []
    for rep, i, j in batches_of:
        label = np.arange(len(rep))
        while True:
            before = label.copy()
            np.minimum.at(label, i, label[j])
            np.minimum.at(label, j, label[i])
            label = label[label]
            if (label == before).all():
                break
        tied = label != np.arange(len(rep))
        out.append(np.stack([rep[tied], rep[label[tied]]], axis=1))
    m = np.unique(np.concatenate(out), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(m[:, 0]), pa.array(m[:, 1])], names=["u", "v"])


ROWS = 64  # of a unit whose pairs are looked at together: no matrix grows with the square of a unit


def _open_pairs(sketches: list[np.ndarray], open_) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the pairs that share enough retained values; ``open_(s, e)`` says which of rows s to e count."""
    size = np.array([len(s) for s in sketches])
    row = np.repeat(np.arange(len(sketches)), size)
    _, value, times = np.unique(np.concatenate(sketches), return_inverse=True, return_counts=True)
    shared = times[value] > 1
    row, value = row[shared], value[shared]
    column = np.full(len(times), -1)
    found = []
    for at in range(0, len(sketches), ROWS):
        end = min(at + ROWS, len(sketches))
        wanted = open_(at, end)
        if not wanted.any():
            continue
        kinds = np.unique(value[(row >= at) & (row < end)])
        column[kinds] = np.arange(len(kinds))
        known = column[value] >= 0
        table = np.zeros((len(sketches), len(kinds)), np.float32)
        table[row[known], column[value[known]]] = 1
        column[kinds] = -1
        enough = table[at:end] @ table.T >= LEAST_SHARE * np.minimum(size[at:end, None], size[None, :])
        i, j = np.nonzero(enough & wanted)
        found.append((i + at, j))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = zip(*found)
    return np.concatenate(i), np.concatenate(j)


def _likely(percent: int):
    """Forest of the pairs of different components in a list that share enough retained values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in key_runs(batches, ["key", "x", "y"]):
            rep, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
            n, side = rows.column("n").to_numpy(), rows.column("side").to_numpy()
            one = rows.column("x").to_numpy() == rows.column("y").to_numpy()
            lists = rows.column("sketch").combine_chunks()
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            out = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                c, m, half, whole = comp[s:e], n[s:e], side[s:e], bool(one[s])
                if e - s < 2 or (c == c[0]).all():
                    continue

                def open_(a: int, b: int) -> np.ndarray:
                    pairs = (c[a:b, None] != c[None, :]) & (np.arange(len(c))[None, :] > np.arange(a, b)[:, None])
                    if not whole:
                        pairs &= half[a:b, None] != half[None, :]
                    x, y = m[a:b, None], m[None, :]
                    return pairs & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))

                i, j = _open_pairs([values[offsets[r] : offsets[r + 1]] for r in range(s, e)], open_)
                if len(i):
                    out.append((rep[s:e], i, j))
            if out:
                yield _forest(out)

    return run


def _exact(percent: int):
    """Forest of the pairs of a family whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in key_runs(batches, ["key", "x", "y"]):
            rep, side, comp = (rows.column(c).to_numpy() for c in ("rep", "side", "comp"))
            one = rows.column("x").to_numpy() == rows.column("y").to_numpy()
            lists = rows.column("shingles").combine_chunks()
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            out = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                at = offsets[s : e + 1] - offsets[s]
                size = np.diff(at)
                kinds, ids = np.unique(values[offsets[s] : offsets[e]], return_inverse=True)
                mark = np.zeros(len(kinds), np.int32)
                i, j = [], []
                for k in range(e - s - 1):
                    mine = ids[at[k] : at[k + 1]]
                    mark[mine] = 1
                    both = np.add.reduceat(mark[ids[at[k + 1] :]], at[k + 1 : -1] - at[k + 1])
                    mark[mine] = 0
                    near = 100 * both >= percent * (size[k + 1 :] + size[k] - both)
                    if not one[s]:
                        near &= side[s + k + 1 : e] != side[s + k]
                    near &= comp[s + k + 1 : e] != comp[s + k]  # linked already
                    hit = np.flatnonzero(near) + k + 1
                    i.append(np.full(len(hit), k))
                    j.append(hit)
                if i:
                    out.append((rep[s:e], np.concatenate(i), np.concatenate(j)))
            if out:
                yield _forest(out)

    return run


def _units(members: DataFrame, most: int) -> DataFrame:
    """``members(key, rep, comp, weight, ...)`` with a pair of blocks (x <= y) for each unit they take part in.

    A component heavier than half of ``most`` has blocks of its own, the others of its key share blocks, each
    whole in one. Two blocks of one component form no unit: nothing in them is open.
    """
    sizes = members.groupBy("key", "comp").agg(F.sum("weight").alias("weight"))
    own = F.col("weight") > most / 2  # so that no shared block is much over ``most``
    shared = sizes.groupBy("key").agg(F.ceil(F.sum(F.when(~own, F.col("weight"))) / most).cast("int").alias("shares"))
    dealt = staged(
        sizes.join(shared, "key").select(
            "key", "comp", own.alias("own"),
            F.when(own, F.ceil(F.col("weight") / most)).otherwise(F.greatest(F.lit(1), "shares")).cast("int").alias("parts"),
        ),
        "near-blocks",
    )
    # blocks are numbered by what they hold: of one component, or shared
    place = F.pmod(F.when(F.col("own"), F.xxhash64("rep")).otherwise(F.xxhash64("comp")), F.col("parts"))
    owner = F.when(F.col("own"), F.col("comp"))
    rows = members.join(dealt, ["key", "comp"]).withColumn("block", F.xxhash64(owner, place))
    names = [c for c in members.columns if c != "weight"]
    held = dealt.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = held.where("own").select("key", F.xxhash64("comp", F.col("place").cast("long")).alias("block"), F.col("comp").alias("owner"))
    common = rows.where("NOT own").select("key", "block", F.lit(None).cast("long").alias("owner")).distinct()
    blocks = staged(blocks.unionByName(common), "near-block-list")
    other = blocks.select("key", F.col("block").alias("with"), F.col("owner").alias("other"))
    pairs = blocks.join(other, "key").where("owner IS NULL OR other IS NULL OR owner <> other").select("key", "block", "with")
    return rows.join(pairs, ["key", "block"]).select(
        *names, F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"),
        (F.col("block") <= F.col("with")).cast("int").alias("side"),
    )


def _sorted_units(units: DataFrame) -> DataFrame:
    return units.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")


def _several(members: DataFrame) -> DataFrame:
    """The members of lists that hold more than one component."""
    keys = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    return members.join(staged(keys, "near-several"), "key", "left_semi")


def near_links(docs: DataFrame, reps: DataFrame, shingle: int, percent: int, k: int) -> DataFrame:
    """(id, component) of the class representatives that have a link."""
    keys = F.expr("transform(sequence(0, greatest(size(sketch) - 2, 0)), i -> xxhash64(sketch[i], get(sketch, i + 1)))")
    postings = reps.select("rep", F.explode(keys).alias("key"))
    # the aggregates are written, so that either side of a join is a shuffle that skew handling can split
    heads = staged(
        postings.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("last"), F.count("*").alias("m"))
        .where("head < last").select("key", "head", "m"),
        "near-heads",
    )
    lists = staged(postings.join(heads, "key").select("key", "rep", "head", "m"), "near-lists")
    star = lists.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    likely = staged(estimated(star, reps, percent, k), "near-star")
    ends = likely.select(F.col("a").alias("doc_id")).union(likely.select("b"))
    links = confirmed(likely, full_sets(docs, ends, shingle), percent)
    comps = staged(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-parts")

    members = staged(
        _several(
            lists.where("m > 2").join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
                "key", "rep", F.coalesce("component", "rep").alias("comp")
            )
        ),
        "near-members",
    )
    # a class whose own keys are fewer (a small set) needs all of them at most
    often = members.groupBy("rep").agg(F.count("*").alias("lists")).join(reps.select("rep", "n"), "rep").where(
        F.col("lists") >= F.least(F.lit(LEAST_LISTS), F.greatest(F.lit(1), F.col("n") - F.lit(k // 4)))
    ).select("rep")
    members = staged(_several(members.join(staged(often, "near-often"), "rep", "left_semi")), "near-members")
    units = _units(members.withColumn("weight", F.lit(1)), BLOCK).join(reps.select("rep", "n", "sketch"), "rep")
    trees = _sorted_units(units).mapInArrow(lean(_likely(percent)), _FOREST)

    families = staged(connected_components(trees).select(F.col("id").alias("rep"), F.col("component").alias("key")), "near-families")
    sets = full_sets(docs, families.select(F.col("rep").alias("doc_id")), shingle).withColumnRenamed("doc_id", "rep")
    sized = sets.select("rep", F.size("shingles").alias("weight")).join(families, "rep")
    sized = sized.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("comp"), "weight"
    )
    units = _units(sized, BLOCK_SHINGLES).join(sets, "rep")
    more = staged(_sorted_units(units).mapInArrow(lean(_exact(percent)), _FOREST), "near-links")
    return connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(more))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = staged(docs.mapInArrow(lean(_sketches(shingle, k)), _SETS), "near-sketches")
    reps = staged(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("c1", "c2").agg(
            F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min_by("sketch", "doc_id").alias("sketch")
        ),
        "near-reps",
    )
    parts = near_links(docs, reps, shingle, percent, k).withColumnRenamed("id", "rep")
    classes = reps.join(parts, "rep", "left").select(
        F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.coalesce("component", "rep").alias("component")
    )
    own = (sets["c1"] == classes["k1"]) & (sets["c2"] == classes["k2"]) & (sets["n"] > 0) & sets["doc_id"].isNotNull()
    return sets.join(classes, own, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )
