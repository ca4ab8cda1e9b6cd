"""Substring de-duplication by suffix automata over the passages that documents share.

A word is removed where a window of ``window`` consecutive words around it also starts in a
document with a smaller doc_id. Suffix automata of whole shards of the corpus would have to be
broadcast as often as the corpus has shards, which grows with its square, so the reference shards
are cut by content instead, and only passages that more than one document holds become reference:

1. Every window names its anchor, the smallest hash among its ``anchor``-word sequences. Equal
   windows name equal anchors, so all occurrences of a window meet at its anchor. Neighbouring
   windows with one anchor form a region, a row of a few numbers (about one per 22 words).
2. Anchors in one document only are dropped. A region equal, word by word, to one of a smaller
   document is removed whole; equal regions are pre-aggregated, so copies cost nothing here.
3. The first holder of each distinct region of the same anchor (near copies, passages in different
   surroundings) goes to the anchor's reference shard. There, in ascending document order, each
   region is streamed through the suffix automaton of the smaller documents' regions; where the
   matching statistic reaches ``window`` the window is a repeat. Then it is added to the automaton.
4. An anchor with more than ``most`` words of regions is not gathered in one task: they are split
   into windows, whose smallest document is a partial-aggregated minimum - the same result.

Removed spans then meet their documents once.

Defined cases: a null text has no words; a document shorter than the window loses nothing; a
null doc_id neither loses nor causes removals; rows that repeat a doc_id share their removals
(the doc_id identifies a text); an empty table gives an empty result; only doc_id and text are
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import key_runs, staged
from lakeloom.llm.words import mix64, ngram_hashes, word_hashes

WINDOW = 50
ANCHOR = 8
MOST = 1_000_000  # words of the regions that one automaton takes in (some 250 bytes each at most twice)

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 2 * n
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS = np.cumprod(up), np.cumprod(down)
    return _POWERS


def _span_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of words[start:end] for each span; equal for equal word sequences."""
    up, down = _powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)).view(np.int64)


def regions(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(anchor hash, region hash, first window, windows) of every region of a document."""
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32),) * 2
    low = ngram_hashes(words, anchor)
    span, size = window - anchor + 1, 1
    while 2 * size <= span:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    count = np.diff(np.append(first, len(low)))
    hashes = _span_hashes(words, first, first + count + window - 1)
    return low[first].view(np.int64), hashes, first.astype(np.int32), count.astype(np.int32)


class SuffixAutomaton:
    """Generalised suffix automaton over token sequences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, nexts: dict, link: int, length: int) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state for c after p alone, cut off from q, which also stands for longer contexts."""
        nxt, link, length = self.next, self.link, self.length
        clone = self._state(dict(nxt[q]), link[q], length[p] + 1)
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        link[q] = clone
        return clone

    def add(self, tokens: list) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in tokens:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            new, p = self._state({}, 0, length[last] + 1), last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new

    def matches(self, tokens: list) -> list[int]:
        """Matching statistics: the longest known sequence that ends at each token."""
        nxt, link, length = self.next, self.link, self.length
        state, known, out = 0, 0, []
        for c in tokens:
            while state and c not in nxt[state]:
                state = link[state]
                known = length[state]
            q = nxt[state].get(c)
            if q is None:
                known = 0
            else:
                state, known = q, known + 1
            out.append(known)
        return out


def spans_of(matches: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal spans covered by windows whose matching statistic reaches ``window``."""
    out: list[tuple[int, int]] = []
    for end, known in enumerate(matches, 1):
        if known >= window:
            if out and end - window <= out[-1][1]:
                out[-1] = out[-1][0], end
            else:
                out.append((end - window, end))
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


_REGIONS = "doc_id long, anchor long, region long, first int, windows int"


def _scan(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                found = [regions(word_hashes(t.split()), window, anchor) for t in _texts(b.column(1))]
                ids = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(f[0]) for f in found])
                cols = [np.concatenate(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), *(pa.array(c) for c in cols)],
                    names=["doc_id", "anchor", "region", "first", "windows"],
                )

    return run


_WORDS = "hot boolean, key long, doc_id long, first int, windows int, words binary"


def _region_words(window: int):
    """The words of a document's wanted regions; for crowded anchors, a row per run of equal windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                out: list[tuple] = []
                for doc, text, wanted in zip(b.column(0).to_pylist(), _texts(b.column(1)), b.column(2).to_pylist()):
                    words = text.split()
                    hashes = word_hashes(words) if any(w["hot"] for w in wanted) else None
                    for w in wanted:
                        s, n = w["first"], w["windows"]
                        if w["hot"]:
                            start = np.arange(s, s + n)
                            keys = _span_hashes(hashes, start, start + window)
                            at_ = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
                            runs = np.diff(np.append(at_, n)).tolist()
                            out.extend((True, k, doc, p, r, None) for k, p, r in zip(keys[at_].tolist(), start[at_].tolist(), runs))
                        else:
                            out.append((False, w["anchor"], doc, s, n, b" ".join(words[s : s + n + window - 1])))
                cols = list(zip(*out)) or [()] * 6
                kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds)],
                    names=["hot", "key", "doc_id", "first", "windows", "words"],
                )

    return run


_SPANS = "doc_id long, s int, e int"


def _stream(window: int):
    """Each anchor's regions, by ascending document, through the automaton of those before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in key_runs(batches, ["key"]):
            docs, first = rows.column("doc_id").to_pylist(), rows.column("first").to_pylist()
            words = [w.split(b" ") for w in rows.column("words").to_pylist()]
            out = []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                known, r = SuffixAutomaton(), s
                while r < e:
                    same = r
                    while same < e and docs[same] == docs[r]:
                        if r > s:
                            spans = spans_of(known.matches(words[same]), window)
                            out.extend((docs[same], first[same] + a, first[same] + b) for a, b in spans)
                        same += 1
                    if same < e:
                        for k in range(r, same):
                            known.add(words[k])
                    r = same
            cols = list(zip(*out)) or [()] * 3
            kinds = (pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "s", "e"])

    return run


_RESULT = "doc_id long, n_words long, n_removed long, kept_text binary, kept_sha256 string"


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                n_words, removed, kept, digests = [], [], [], []
                for text, spans in zip(_texts(b.column(1)), b.column(2).to_pylist()):
                    words = text.split()
                    stay = words
                    if spans:
                        gone = np.zeros(len(words), bool)
                        for span in spans:
                            gone[span["s"] : span["e"]] = True
                        stay = [w for w, g in zip(words, gone.tolist()) if not g]
                    n_words.append(len(words))
                    removed.append(len(words) - len(stay))
                    left = b" ".join(stay)
                    kept.append(left if with_text else None)
                    digests.append(hashlib.sha256(left).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
                )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, most: int = MOST) -> DataFrame:
    """(doc_id, s, e): spans of word positions that repeat a smaller document; they may overlap."""
    docs = docs.where("doc_id IS NOT NULL")
    found = staged(docs.mapInArrow(_scan(window, anchor), _REGIONS), "regions")
    # the aggregates are written, so that either side of a join is a shuffle that skew handling can split
    anchors = staged(
        found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
        .select("anchor"),
        "shared-anchors",
    )
    shared = staged(found.join(anchors, "anchor", "left_semi"), "shared-regions")
    holders = staged(shared.groupBy("anchor", "region").agg(F.min("doc_id").alias("holder")), "region-holders")
    owned = staged(shared.join(holders, ["anchor", "region"]), "owned-regions")
    whole = owned.where("doc_id > holder").select(
        "doc_id", F.col("first").alias("s"), (F.col("first") + F.col("windows") + F.lit(window - 1)).alias("e")
    )
    firsts = owned.where("doc_id = holder")
    crowds = staged(
        firsts.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                     F.sum(F.col("windows") + window - 1).alias("n"))
        .where("lo < hi").select("anchor", (F.col("n") > most).alias("hot")),
        "region-crowds",
    )
    wanted = staged(
        firsts.join(crowds, "anchor").groupBy("doc_id").agg(
            F.collect_list(F.struct("anchor", "first", "windows", "hot")).alias("wanted")
        ),
        "wanted-regions",
    )
    words = staged(
        docs.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_region_words(window), _WORDS),
        "region-words",
    )
    streamed = (
        words.where("NOT hot").select("key", "doc_id", "first", "words").repartition("key")
        .sortWithinPartitions("key", "doc_id", "first").mapInArrow(_stream(window), _SPANS)
    )
    crowded = words.where("hot").select("key", "doc_id", "first", "windows")
    earliest = staged(
        crowded.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi"),
        "crowded-windows",
    )
    repeats = crowded.join(earliest, "key").where("doc_id > lo").select(
        "doc_id", F.col("first").alias("s"), (F.col("first") + F.col("windows") + window - 1).cast("int").alias("e")
    )
    return whole.unionByName(streamed).unionByName(repeats)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, most: int = MOST, with_text: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = staged(
        repeated_spans(docs, window, anchor, most).groupBy("doc_id").agg(F.collect_set(F.struct("s", "e")).alias("spans")),
        "repeat-spans",
    )
    out = docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_cut(with_text), _RESULT)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return out.select(*names, F.decode("kept_text", "UTF-8").alias("kept_text")) if with_text else out.select(*names)
