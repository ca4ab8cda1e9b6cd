"""Byte-level BPE encoding and decoding in length-bucketed numpy matrices.

The pattern cuts a text into pieces, each encoded by itself. A piece that a bounded cache doesn't
know goes, with all other unknown pieces of its batch, into matrices of one row a piece, padded to the
next power of two. In each round every row looks up the rank of all its neighbouring pairs in a
hash table (open addressing in numpy arrays), merges its leftmost pair of the smallest rank and closes
the gap; rows without a mergeable pair are done and leave the matrix. A piece over ``LONG`` bytes is
a row of its own: it merges, left to right, all the pairs of the smallest rank in one round as
long as no pair that a merge makes has that rank or a smaller one, so the merges are the same.

Decoding joins the byte strings of the ids.

Defined cases: a null or empty text has no ids and decodes to nothing; bytes that are not UTF-8 count
as U+FFFD, and so does an id without bytes when it is decoded; texts that look like special tokens are
plain text; repeated rows are encoded each; an empty table gives an empty result; columns other
than the named one are carried, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

RANKS = "byte_bpe_multi_50k.tiktoken"
CACHE_BYTES = 48 << 20  # of pieces and ids in each of the two generations of a worker's cache
LONG = 512
MATRIX_CELLS = 1 << 20
NONE = np.iinfo(np.int32).max


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class PairTable:
    """Ranks of token pairs: open addressing with linear probes, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 2 - 1).bit_length() + 1)
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        at, todo = _slot(keys, self.bits), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == -1]
            _, one = np.unique(at[free], return_index=True)  # one key a slot, the others try the next
            put = free[one]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) & (size - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        flat = keys.ravel()
        at = _slot(flat, self.bits)
        found = self.keys[at]
        out = np.where(found == flat, self.values[at], NONE)
        open_ = np.flatnonzero((found != flat) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at[open_]]
            hit = found == flat[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out.reshape(keys.shape)


class ByteBpe:
    """Ids of pieces by the merge ranks of a vocabulary, and back."""

    def __init__(self, path: str | None = None) -> None:
        with open(path or ranks_path(), "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {b: a for a, b in self.ranks.items()}
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.step = max(self.bytes_of) + 2  # a pair's key is left * step + right + 1; 0 stands for no right token
        keys, values = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.step + right + 1)
                    values.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(values, np.int32))
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    # ------------------------------------------------------------ merging

    def _pair_ranks(self, ids: np.ndarray) -> np.ndarray:
        """Rank of each pair (column, next column) of padded rows; padding is -1."""
        keys = ids[:, :-1].astype(np.int64) * self.step + ids[:, 1:] + 1
        return np.where((ids[:, :-1] < 0) | (ids[:, 1:] < 0), NONE, self.pairs(np.where(keys < 0, -2, keys)))

    def merge_rows(self, ids: np.ndarray) -> list[bytes]:
        """The ids of every padded row after all its merges, as little-endian bytes."""
        out: list[bytes] = [b""] * len(ids)
        rows = np.arange(len(ids))
        rank = self._pair_ranks(ids)
        while len(rows):
            at = rank.argmin(axis=1)  # the first of equal ones: the leftmost
            least = rank[np.arange(len(rows)), at]
            done = least == NONE
            if done.any():
                real = ids[done] >= 0
                data, ends = ids[done][real].astype("<i4").tobytes(), (4 * np.cumsum(real.sum(axis=1))).tolist()
                for r, s, e in zip(rows[done].tolist(), [0, *ends], ends):
                    out[r] = data[s:e]
                keep = ~done
                rows, ids, rank, at, least = rows[keep], ids[keep], rank[keep], at[keep], least[keep]
                if not len(rows):
                    break
            # the merged token takes the pair's place, what follows moves one place to the left
            n, width = ids.shape
            here = np.arange(n)
            source = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > at[:, None])
            ids = np.take_along_axis(ids, source, 1)
            ids[here, at] = least
            if width == 2:
                rank = np.full((n, 1), NONE, np.int32)
                ids = np.concatenate([ids, np.full((n, 1), -1, np.int32)], axis=1)
                continue
            source = np.arange(width - 2)[None, :] + (np.arange(width - 2)[None, :] > at[:, None])
            rank = np.take_along_axis(rank, source, 1)
            # only the two pairs that hold the new token have a new rank
            left = np.flatnonzero(at > 0)
            if len(left):
                rank[left, at[left] - 1] = self._pair_ranks(
                    np.stack([ids[left, at[left] - 1], ids[left, at[left]]], axis=1))[:, 0]
            right = np.flatnonzero(at < width - 2)
            if len(right):
                rank[right, at[right]] = self._pair_ranks(
                    np.stack([ids[right, at[right]], ids[right, at[right] + 1]], axis=1))[:, 0]
        return out

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: all pairs of the smallest rank a round, as far as no merge makes a pair due sooner."""
        while len(ids) > 1:
            rank = self._pair_ranks(ids[None, :])[0]
            least = rank.min()
            if least == NONE:
                break
            at = np.flatnonzero(rank == least)
            if len(at) > 1:
                # of overlapping pairs in a run every second one, from the left
                run = np.cumsum(np.diff(at, prepend=at[0] - 2) != 1) - 1
                place = np.arange(len(at)) - np.searchsorted(run, run)
                at = at[place % 2 == 0]
            # what stands left of a merge is merged already, what stands right is not yet
            left = ids[np.maximum(at - 1, 0)].copy()
            left[1:][at[1:] - 2 == at[:-1]] = least
            left[at == 0] = -1
            after = at + 2
            right = np.where(after < len(ids), ids[np.minimum(after, len(ids) - 1)], -1)
            new = np.full(len(at), least, np.int32)
            made = np.minimum(
                self._pair_ranks(np.stack([left, new], axis=1))[:, 0], self._pair_ranks(np.stack([new, right], axis=1))[:, 0])
            sooner = np.flatnonzero(made <= least)
            if len(sooner):
                at = at[: sooner[0] + 1]
            ids = ids.copy()
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces: whole pieces of the vocabulary as they are, the others by merging."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = self.merge_long(self.first[np.frombuffer(piece, np.uint8)]).astype("<i4").tobytes()
            else:
                buckets.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for s in range(0, len(members), step):
                part = members[s : s + step]
                raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in part), np.uint8).reshape(len(part), width)
                size = np.array([len(pieces[i]) for i in part])
                ids = np.where(np.arange(width)[None, :] < size[:, None], self.first[raw], np.int32(-1))
                for i, row in zip(part, self.merge_rows(ids)):
                    out[i] = row
        return out

    # ------------------------------------------------------------ texts

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of ``pieces``, new to this generation of the cache, into it; what the older one knows moves up."""
        new = []
        for p in pieces:
            if p in self.old:
                self.known[p] = self.old[p]
                self.held += len(p) + len(self.known[p]) + 150
            else:
                new.append(p)
        raw = [p.encode() for p in new]
        ids = self.encode_pieces(raw)
        self.known.update(zip(new, ids))
        self.held += sum(map(len, raw)) + sum(map(len, ids)) + 150 * len(new)

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Little-endian 32-bit ids of the pieces of each text; unknown pieces are merged together."""
        if self.held > CACHE_BYTES:
            self.known, self.old, self.held = {}, self.known, 0
        self.learn(set().union(*texts).difference(self.known))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in texts]

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        except KeyError:
            return b"".join(self.bytes_of.get(i, "�".encode()) for i in ids)


_MODELS: dict[str | None, ByteBpe] = {}


def model(path: str | None) -> ByteBpe:
    """The worker's model of a vocabulary file; made once a worker."""
    if path not in _MODELS:
        _MODELS[path] = ByteBpe(path)
    return _MODELS[path]


def _id_lists(parts: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32()))


def _text_groups(texts: list[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Slices of a batch of about ``most`` bytes each."""
    start = held = 0
    for i, size in enumerate(map(len, texts)):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    yield start, len(texts)


def _encoded(at: int, path: str | None, split: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = model(path), regex.compile(split).findall
        for b in batches:
            if not b.num_rows:
                continue
            texts = [t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()]
            for s, e in _text_groups(texts):
                ids = bpe.encode([pieces(t.decode("utf-8", "replace")) for t in texts[s:e]])
                yield pa.RecordBatch.from_arrays([*(c.slice(s, e - s) for c in b.columns), _id_lists(ids)], names=names)

    return run


def _decoded(at: int, path: str | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for b in batches:
            if b.num_rows:
                out = [bpe.decode(ids or []) for ids in b.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=names)

    return run


def encode(docs: DataFrame, column: str = "text", into: str = "ids", path: str | None = None, split: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``column`` as an array of ints in a new last column ``into``."""
    schema = StructType([*docs.schema.fields, StructField(into, ArrayType(IntegerType()))])
    names = [f.name for f in schema.fields]
    return docs.mapInArrow(_encoded(docs.columns.index(column), path, split or pattern(), names), schema)


def decode(tokens: DataFrame, column: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """``tokens`` with the bytes of the ids of ``column`` in a new last column ``into``."""
    schema = StructType([*tokens.schema.fields, StructField(into, BinaryType())])
    names = [f.name for f in schema.fields]
    return tokens.mapInArrow(_decoded(tokens.columns.index(column), path, names), schema)


def round_trips(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's rows: number of ids, digest of the ids, digest of the decoded bytes."""
    ids = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path=path).select("doc_id", "ids")
    return decode(ids, path=path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
