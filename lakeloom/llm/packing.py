"""Best-fit packing of tokenised documents by a distributed grouping genetic algorithm.

Documents become token ids once (a bounded cache of a task maps a white-space word to its ids,
which is exact because the tokenizer's splitter never crosses white space). Pieces are dealt
into blocks of about ``block`` pieces; every block lives on several islands (tasks), each with
its own population of packings. A packing is a set of whole bins. Crossover injects the
well-filled bins of one parent into the other, drops the bins that now hold a document twice,
and puts the displaced documents back by best fit; mutation dissolves the emptiest bins. After
each epoch an island's best packing migrates to the next island of its block. The fittest
island wins; bins at least ``full`` full are final, the pieces of the rest meet the rest of
other blocks in a next level, until one block is left. A level keeps only the last, poorly
filled bins of each block, so levels shrink by orders of magnitude.

Defined cases: a null or empty text is the single id 0; bytes that are not UTF-8 count as U+FFFD; a document of more than ``capacity``
ids is cut into full pieces and one shorter last piece; repeated rows are packed each; a null
doc_id is carried through; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import random
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._shared import bucket_count, lean, staged

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
CACHE_BYTES = 40 << 20  # of each of the two generations of a task's word cache
CACHE_ENDINGS = 100_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = f"{_PIECES}, bin long, offset long, fill long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_ENDING = ".,;:!?%#&*$|"  # splits from a letter before it; an apostrophe may not


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 upwards."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class WordIds(dict):
    """Little-endian 32-bit ids of a white-space word, from the tokenizer on first use.

    The tokenizer lower-cases, normalises to NFC and splits letters from what follows them, so a
    word of plain Latin letters goes straight to its merge model, and punctuation after it is
    looked up by itself. Every other word goes through the whole tokenizer.
    """

    def __init__(self, path: str | None = None) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.bytes = _byte_letters()
        self.endings: dict[str, bytes] = {}
        self.old: dict[bytes, bytes] = {}  # the generation before; words still in use move up
        self.held = 0
        self.room = CACHE_BYTES

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, text: str) -> bytes | None:
        """The ids of one run of lower-case Latin letters; None for any other text."""
        if not text.isalpha():
            return None
        if not text.isascii():
            if max(text) >= "\u0130" or not is_normalized("NFC", text):
                return None
            text = text.encode().decode("latin-1").translate(self.bytes)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if self.held > self.room:
            self.old, self.held = dict(self), 0
            self.clear()
        value = self.old.get(word)
        if value is None:
            value = self.ids_of(word)
        self[word] = value
        self.held += len(word) + len(value) + 170
        return value

    def ids_of(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        low = text.lower()
        stem = low.rstrip(_ENDING)
        value = self.letters(stem)
        if value is None:
            value = self.whole(text)
        elif len(stem) < len(low):
            ending = low[len(stem) :]
            if ending not in self.endings:
                if len(self.endings) >= CACHE_ENDINGS:
                    self.endings.clear()
                self.endings[ending] = self.whole(ending)
            value += self.endings[ending]
        return value

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def _pieces(path: str | None, capacity: int, cache: int = CACHE_BYTES):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(path)  # gone with the task, before its worker gives freed memory back
        ids.room = cache
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts = pc.fill_null(b.column(1).cast(pa.string()), "").cast(pa.binary()).to_pylist()
                out = []
                for doc, text in zip(b.column(0).to_pylist(), texts):
                    data = ids(text) + b"\0\0\0\0"
                    for k in range(0, len(data), 4 * capacity):
                        part = data[k : k + 4 * capacity]
                        out.append((doc, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, cache: int = CACHE_BYTES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; ``cache``: bytes of a generation of a task's word cache."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_pieces(path, capacity, cache)), _PIECES)


# ------------------------------------------------------------------ one island's packings


class Packing:
    """Bins of item numbers; rooms are indexed by free space, so a best fit is one bit search."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.fills: list[int] = []

    def best_fit(self, items: list[int]) -> None:
        """Put every item into the fullest bin that still takes it, else into a new one."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for b, fill in enumerate(self.fills):
            room[self.capacity - fill].append(b)
            mask |= 1 << (self.capacity - fill)
        for i in items:
            size = self.sizes[i]
            fits = mask >> size
            if fits:
                free = size + (fits & -fits).bit_length() - 1
                b = room[free].pop()
                if not room[free]:
                    mask ^= 1 << free
                self.bins[b].append(i)
                self.fills[b] += size
            else:
                b, free = len(self.bins), self.capacity
                self.bins.append([i])
                self.fills.append(size)
            free -= size
            if not room[free]:
                mask |= 1 << free
            room[free].append(b)

    def fitness(self) -> float:
        """Fewer bins first; among equals, the more uneven filling (mean squared fill)."""
        return -len(self.bins) + sum(f * f for f in self.fills) / (self.capacity**2 * max(1, len(self.fills)))

    def labels(self) -> list[int]:
        out = [0] * len(self.sizes)
        for b, items in enumerate(self.bins):
            for i in items:
                out[i] = b
        return out


def packing_of(sizes: list[int], labels: list[int], capacity: int) -> Packing:
    p = Packing(sizes, capacity)
    p.bins = [[] for _ in range(max(labels, default=-1) + 1)]
    for i, b in enumerate(labels):
        p.bins[b].append(i)
    p.fills = [sum(sizes[i] for i in b) for b in p.bins]
    return p


def crossover(a: Packing, b: Packing, rng: random.Random) -> Packing:
    """Whole well-filled bins of ``b`` go into ``a``; what they displace is best-fitted."""
    order = sorted(range(len(b.bins)), key=lambda k: -b.fills[k])
    good = order[: max(1, len(order) // 2)]
    inject = rng.sample(good, max(1, len(good) // 2))
    taken = {i for k in inject for i in b.bins[k]}
    child = Packing(a.sizes, a.capacity)
    child.bins = [list(b.bins[k]) for k in inject]
    child.fills = [b.fills[k] for k in inject]
    displaced = []
    for items, fill in zip(a.bins, a.fills):
        if taken.isdisjoint(items):
            child.bins.append(list(items))
            child.fills.append(fill)
        else:
            displaced.extend(i for i in items if i not in taken)
    displaced.sort(key=lambda i: -a.sizes[i])
    child.best_fit(displaced)
    return child


def mutate(p: Packing, rng: random.Random) -> Packing:
    """Dissolve the emptiest bins and a few others, and best-fit their documents again."""
    order = sorted(range(len(p.bins)), key=lambda k: p.fills[k])
    gone = set(order[: max(1, len(order) // 20)]) | {rng.randrange(len(p.bins)) for _ in range(2)}
    child = Packing(p.sizes, p.capacity)
    child.bins = [list(x) for k, x in enumerate(p.bins) if k not in gone]
    child.fills = [f for k, f in enumerate(p.fills) if k not in gone]
    loose = [i for k in gone for i in p.bins[k]]
    loose.sort(key=lambda i: (-p.sizes[i], rng.random()))
    child.best_fit(loose)
    return child


def evolve(sizes: list[int], capacity: int, seed: int, elite: list[int] | None, generations: int, population: int) -> Packing:
    """One epoch of one island; ends early when the lower bound on bins is met."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    pool = [packing_of(sizes, elite, capacity)] if elite is not None else []
    while len(pool) < population:
        order = list(range(len(sizes)))
        noise = 0.02 * len(pool)  # the first is plain best fit decreasing
        order.sort(key=lambda i: -sizes[i] * (1 + noise * rng.random()))
        p = Packing(sizes, capacity)
        p.best_fit(order)
        pool.append(p)
        if len(p.bins) <= least:
            return p
    best = max(pool, key=Packing.fitness)
    for _ in range(generations):
        if len(best.bins) <= least:
            break
        a, b = rng.sample(pool, 2)
        child = mutate(crossover(a, b, rng), rng)
        pool[min(range(len(pool)), key=lambda k: pool[k].fitness())] = child
        best = max(best, child, key=Packing.fitness)
    return best


_ELITE = "block long, island int, labels array<int>, fitness double"


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")


def _epoch(capacity: int, generations: int, population: int):
    def run(key: tuple, pieces: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        if pieces.empty:
            return pd.DataFrame({"block": [], "island": [], "labels": [], "fitness": []})
        sizes = _ordered(pieces)["length"].tolist()
        came = [int(x) for x in elites["labels"].iloc[0]] if len(elites) else None
        seed = int(key[0]) * 1_000_003 + int(key[1]) * 17 + (came is not None)
        best = evolve(sizes, capacity, seed, came, generations, population)
        return pd.DataFrame({"block": [key[0]], "island": [key[1]], "labels": [best.labels()], "fitness": [best.fitness()]})

    return run


def _place(key: tuple, pieces: pd.DataFrame, winner: pd.DataFrame) -> pd.DataFrame:
    """Each piece with its bin of the winning packing, its place there and the bin's fill."""
    if pieces.empty:
        return pd.DataFrame({c.split()[0]: [] for c in _PLACED.split(", ")})
    out = _ordered(pieces).reset_index(drop=True)
    out["bin"] = np.asarray(winner["labels"].iloc[0], np.int64)
    out = out.sort_values("bin", kind="stable")
    grouped = out.groupby("bin")["length"]
    out["offset"] = grouped.cumsum() - out["length"]
    out["fill"] = grouped.transform("sum")
    return out[[c.split()[0] for c in _PLACED.split(", ")]]


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    block: int = 4096,
    islands: int = 2,
    epochs: int = 2,
    generations: int = 6,
    population: int = 4,
    full: float = 0.995,
) -> DataFrame:
    """pieces plus sequence_id and offset; every sequence holds at most ``capacity`` ids."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    todo, rows, done, level = pieces, pieces.count(), [], 0
    while rows:
        blocks = bucket_count(rows, block)
        # the length takes part so that copies of one document do not gather in a block
        key = F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(blocks))
        dealt = todo.withColumn("block", key)
        homes = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
        elites = None
        for _ in range(epochs):
            guests = (
                dealt.sparkSession.createDataFrame([], _ELITE)
                if elites is None
                else elites.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
            )
            elites = staged(
                homes.groupBy("block", "island")
                .cogroup(guests.groupBy("block", "island"))
                .applyInPandas(_epoch(capacity, generations, population), _ELITE),
                "elites",
            )
        best = elites.groupBy("block").agg(F.max_by("labels", F.struct("fitness", -F.col("island"))).alias("labels"))
        placed = staged(
            dealt.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(
                lambda k, a, b: _place(k, a, b).assign(block=k[0]), f"{_PLACED}, block long"
            ),
            "placed",
        )
        last = blocks == 1
        # each level asks for a little less, so that levels end even where no bin can be that full
        final = F.lit(True) if last else F.col("fill") >= max(0.0, full - 0.02 * level) * capacity
        done.append(
            placed.where(final).select(
                *names,
                (F.lit(level << 56) + F.col("block") * (1 << 24) + F.col("bin")).cast("long").alias("sequence_id"),
                "offset",
            )
        )
        if last:
            break
        todo = placed.where(~final).select(*names)
        rows, level = todo.count(), level + 1
    if not done:
        return pieces.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, cache: int = CACHE_BYTES, **options
) -> DataFrame:
    """The contract's rows: one per piece."""
    return pack(staged(token_pieces(docs, path, capacity, cache), "pieces"), capacity, **options)
