"""Spelling variants: words one edit apart, by dynamic programming over a sorted vocabulary.

The words of all documents are counted; two words are near if one inserted, deleted or replaced
code point turns one into the other. Where two words first differ at place p of the shorter one (m code
points), they share the p code points before it and at least the m - p - 1 last ones. So the places
0..m are cut in two regions [a, e): a word meets its near ones of one region in the group of words
that share ``m``, the first ``a`` and the last ``m - e`` code points, and each pair meets in exactly one
group. A group of more than ``most`` words cuts its region in two again, so a hot start of words is
split by content until a region is one place wide - a group that the alphabet bounds - and no
pair is lost.

Inside a group the words are sorted. Equal starts of neighbours (their LCP) make a run of the sorted
list that shares one row of the edit matrix, of which the three cells of the band around the
diagonal are kept: a row is computed once for a (word, shared start), and a run whose row has no cell
of one edit or less is skipped with all its words. The rows of all words of many groups are
computed together, one depth of the sorted list at a time.

Defined cases: a null or empty text has no words; a null doc_id is the empty text in the hash;
repeated rows count again; bytes that are not UTF-8 are no letters; equal counts are settled by the word
in code-point order; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import staged

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
DIVISOR = 31
MOST = 500  # words of a group that is not cut further
RUNS = re.compile("[a-zÀ-ÿ]+")
COUNTER_WORDS = 200_000  # held by a task before its counts are sent on
ROWS = 20_000  # of the sorted list scanned together
CELLS = 1_000_000  # rows of the edit matrix held together; a word has at most as many as its group has words

_COUNTS = "word string, n long"
_NEAR = "word string, n_near long, form_n long, form string"


# ---------------------------------------------------------------- vocabulary


def variant(run: str, start: int, divisor: int = DIVISOR) -> str:
    """The word that a lower-cased run stands for; ``start`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), start)
    if h % divisor:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(least: int, divisor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            out = [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=["word", "n"])

        for b in batches:
            texts = b.column(1).cast(pa.binary())
            for doc, text in zip(b.column(0).to_pylist(), texts):
                found = RUNS.findall((text.as_py() or b"").lower().decode("utf-8", "replace"))
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run_, n in Counter(found).items():
                    if len(run_) >= least:  # a run only gets shorter
                        word = variant(run_, start, divisor)
                        if len(word) >= least:
                            held[word] += n
                if len(held) > COUNTER_WORDS:
                    yield rows()
        if held:
            yield rows()

    return run


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT, divisor: int = DIVISOR) -> DataFrame:
    """(word, n) of the words with at least ``least`` code points and ``count`` occurrences."""
    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counted(least, divisor), _COUNTS)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# ---------------------------------------------------------------- groups


def _key(word: str = "word") -> Column:
    """Words that share m, a, e, the first a and the last m - e code points."""
    return F.expr(
        f"xxhash64(m, a, e, substring({word}, 1, a), CASE WHEN e < m THEN right({word}, m - e) ELSE '' END)"
    )


def _halves(rows: DataFrame) -> DataFrame:
    """Rows with regions [a, e), each cut in two, and the keys of the halves."""
    cut = F.expr("(a + e) div 2").cast("int")
    two = F.array(F.struct(F.col("a").alias("a"), cut.alias("e")), F.struct(cut.alias("a"), F.col("e").alias("e")))
    return rows.select("word", "n", "m", F.inline(two)).withColumn("key", _key())


def groups(words: DataFrame, most: int = MOST, least: int = LEAST_LETTERS) -> DataFrame:
    """(key, m, a, e, word, n): every word in the groups where it may meet its near words."""
    size = F.length("word")
    # of two near words of different lengths the shorter one's length counts
    lengths = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= least)
    todo = _halves(lengths.withColumn("a", F.lit(0)).withColumn("e", F.col("m") + 1))
    done = []
    while True:
        sizes = todo.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("e") - F.col("a")).alias("wide"))
        # single words have nothing to meet
        sizes = staged(sizes.where("size > 1").select("key", ((F.col("size") > most) & (F.col("wide") > 1)).alias("hot")), "spell-sizes")
        done.append(todo.join(sizes.where("NOT hot").select("key"), "key", "left_semi"))
        hot = sizes.where("hot").select("key")
        if hot.isEmpty():
            break
        todo = staged(_halves(todo.join(hot, "key", "left_semi")), "spell-groups")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# ---------------------------------------------------------------- the scan


def _common(flat: np.ndarray, start: np.ndarray, size: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """LCP of every word with the one before it; -1 where a group begins."""
    lcp = np.full(len(start), -1, np.int64)
    at = np.flatnonzero(~begins)
    lcp[at] = 0
    depth = 0
    while len(at):
        at = at[(size[at] > depth) & (size[at - 1] > depth)]
        at = at[flat[start[at] + depth] == flat[start[at - 1] + depth]]
        depth += 1
        lcp[at] = depth
    return lcp


class SortedList:
    """Words of groups in order of (group, word), to be scanned for the near words of each.

    m, a and e are those of a row's group: only pairs count whose shorter word has m code points and
    whose first difference lies in [a, e).
    """

    def __init__(self, words: list[str], group: np.ndarray, m: np.ndarray, a: np.ndarray, e: np.ndarray) -> None:
        self.m, self.a, self.e = m, a, e
        text = "".join(words).encode("utf-32-le")
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.append(np.frombuffer(text, np.uint32).astype(np.int64), 0)
        begins = np.ones(len(words), bool)
        begins[1:] = (np.diff(group) != 0) | (np.diff(m) != 0) | (np.diff(a) != 0)
        self.lcp = _common(self.flat, self.start, self.size, begins)
        self.lcp[self.lcp < a] = -1  # a clash of keys: no common start, no group
        first = np.flatnonzero(self.lcp < 0)
        last = np.append(first, len(words))[1:]
        self.first, self.stop = np.repeat(first, last - first), np.repeat(last, last - first)

    def letter(self, rows: np.ndarray, at: int) -> np.ndarray:
        """Code point at a place of each word; -1 outside."""
        inside = (at >= 0) & (at < self.size[rows])
        return np.where(inside, self.flat[np.where(inside, self.start[rows] + at, 0)], -1)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows (i, j), i < j, of all near words; each pair of a group once."""
        rows = np.flatnonzero(self.stop - np.arange(len(self.stop)) > 1)  # a word looks for what sorts after it
        share = np.cumsum(self.stop[rows] - self.first[rows]) // CELLS
        found = [self.scan(part) for part in np.split(rows, np.flatnonzero(np.diff(share)) + 1) if len(part)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def scan(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The near words, sorted after it, of each of ``words``."""
        size, lcp, empty = self.size, self.lcp, np.zeros(0, np.int64)
        # words wait at the depth that their group shares
        waiting = words[np.argsort(self.a[words], kind="stable")]
        depths, taken, depth = self.a[waiting], 0, 0
        found_i, found_j = [empty], [empty]
        # word q, run [s, t) of the sorted list, cells of row ``depth`` of the matrix: columns depth - 1 to depth + 1
        q, s, t, d0, d1, d2 = empty, empty, empty, empty, empty, empty
        while len(q) or taken < len(waiting):
            if not len(q):
                depth = int(depths[taken])
            upto = int(np.searchsorted(depths, depth, "right"))
            if upto > taken:
                new = waiting[taken:upto]
                taken = upto
                one = np.ones(len(new), np.int64)
                q, s, t = np.append(q, new), np.append(s, self.first[new]), np.append(t, self.stop[new])
                d0, d1, d2 = np.append(d0, one), np.append(d1, 0 * one), np.append(d2, one)
            # the word that ends here is the first of its run
            gap = size[q] - depth
            r = np.flatnonzero((size[s] == depth) & (s > q) & (np.abs(gap) <= 1))
            d = np.where(gap[r] < 0, d0[r], np.where(gap[r] == 0, d1[r], d2[r]))
            r = r[(d == 1) & (np.minimum(size[q[r]], depth) == self.m[q[r]])]
            found_i.append(q[r])
            found_j.append(s[r])
            # the runs of words that share one code point more, each with one new row of the matrix
            begins = np.flatnonzero((lcp <= depth) & (size > depth))
            lo, hi = np.searchsorted(begins, s), np.searchsorted(begins, t)
            up = np.repeat(np.arange(len(q)), hi - lo)
            child = np.arange(len(up)) - np.repeat(np.cumsum(hi - lo) - hi, hi - lo)
            s, t = begins[child], np.minimum(np.append(begins, len(size))[child + 1], t[up])
            q, d0, d1, d2 = q[up], d0[up], d1[up], d2[up]
            c, left = self.flat[self.start[s] + depth], size[q] - depth
            n0 = np.where(left >= 0, np.minimum(d0 + (self.letter(q, depth - 1) != c), d1 + 1), 9)
            n1 = np.minimum(d1 + (self.letter(q, depth) != c), np.minimum(d2, n0) + 1)
            n1 = np.where(left >= 1, n1, 9)
            n2 = np.where(left >= 2, np.minimum(d2 + (self.letter(q, depth + 1) != c), n1 + 1), 9)
            depth += 1
            # runs beyond one edit are skipped, and those where only words before q are left; a start
            # still equal at the region's end belongs to another group's region
            go = (np.minimum(np.minimum(n0, n1), n2) <= 1) & (t > q + 1) & ((n1 > 0) | (depth < self.e[q]))
            q, s, t, d0, d1, d2 = q[go], s[go], t[go], n0[go], n1[go], n2[go]
        return np.concatenate(found_i), np.concatenate(found_j)


def _scanned():
    def scan(rows: pa.Table) -> pa.RecordBatch:
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        i, j = SortedList(words, *(rows.column(c).to_numpy() for c in ("key", "m", "a", "e"))).pairs()
        one, other = np.append(i, j), np.append(j, i)
        names = np.array(words, object)
        # per word of these groups: how many near words, and the best of them
        order = np.lexsort((names[other], -n[other], one)) if len(one) else one
        one, other = one[order], other[order]
        begin = np.flatnonzero(np.append(True, one[1:] != one[:-1])) if len(one) else one
        count = np.diff(np.append(begin, len(one)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names[one[begin]], pa.string()), pa.array(count, pa.int64()),
                pa.array(n[other[begin]], pa.int64()), pa.array(names[other[begin]], pa.string()),
            ],
            names=["word", "n_near", "form_n", "form"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size < ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows.column("key").to_numpy()
            cut = int(np.flatnonzero(np.append(True, key[1:] != key[:-1]))[-1])  # the last group may go on
            if cut:
                yield scan(rows.slice(0, cut))
            held = [x for x in rows.slice(cut).to_batches() if x.num_rows]
            size = rows.num_rows - cut
        if held:
            yield scan(pa.Table.from_batches(held).combine_chunks())

    return run


def near_words(words: DataFrame, most: int = MOST, least: int = LEAST_LETTERS) -> DataFrame:
    """(word, n_near, form_n, form) of the words (word, n) that have a near one; form is the commonest."""
    dealt = groups(words, most, least).select("key", "m", "a", "e", "word", "n")
    ordered = dealt.repartition("key").sortWithinPartitions("key", "m", "a", "word")
    parts = ordered.mapInArrow(_scanned(), _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("c"), F.col("form").alias("form"))).alias("best")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.c")).alias("form_n"), F.col("best.form").alias("form")
    )


# ---------------------------------------------------------------- forms and roots


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of ``links(word, form)``: the last word that the forms lead to.

    Counts grow by a factor with each step, so a chain has some twenty links at most; a round
    doubles what a word has followed.
    """
    at = staged(links.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        further = at.select(F.col("word").alias("w"), F.col("root").alias("r"))
        joined = at.join(further, F.col("root") == F.col("w"), "left")
        at = staged(joined.select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("went")), "spell-roots")
        if at.where("went").isEmpty():
            return at.select("word", "root")


def spelling_variants(
    docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT, ratio: int = RATIO,
    divisor: int = DIVISOR, most: int = MOST,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = staged(vocabulary(docs, least, count, divisor), "spell-words")
    near = near_words(words, most, least)
    is_form = F.col("form_n") >= ratio * F.col("n")
    known = staged(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
        ),
        "spell-near",
    )
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
