"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two words sums, over all triples of letters, their occurrences in both words as
subsequences, each weighted ``DECAY`` to the power of the stretch it spans (up to ``REACH`` + 1
letters); what stands between the letters does not matter, so "idiiot" stays close to "idiot". Words
are letters only, by code point: accents are folded, and marks, digits and invisible characters
between letters are no gap, however many ("i--d--i--o--t", "i\u2022d\u2022i\u2022o\u2022t"). Each two neighbouring words are
also scored as one ("id iot"), and runs of single-letter words, with and without the word before or after.

Training uses a bounded sample of labelled documents that are not held out (``SAMPLE`` a class,
chosen by a hash of the id; copies count once). Their sentences are bags of words: in a toxic document only the
words that tell the classes apart and the sentence that speaks most for the label give examples
(multiple-instance learning, a few rounds), in a clean one the words that come closest. Landmarks are the words that
tell the classes apart best and the most frequent clean words; the Nystroem features of a word
are its kernel values with the landmarks, whitened by the landmarks' kernel matrix. A squared-hinge
SVM is fitted on them. As the kernel is an inner product over letter triples, the trained machine
is one weight per triple (a table of fixed size), which evaluates it exactly for any new word.

A document's score is a logistic function, fitted on the sample and shifted to the classes' shares
among all usable labels, of the strongest word of its whole text, the number of words on
the toxic side and the number of words. Labels, lang, source and doc_id never enter.

Defined cases: a null, empty or wordless text gets the score of "no evidence"; repeated rows get
equal scores; a null doc_id is never learned from and counts as held out; without labelled
documents of both classes every score is 0; an empty table gives an empty result; only doc_id and
text (and doc_id and toxic of the labels) are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeloom.llm._shared import lean, staged
from lakeloom.llm.words import shingle_set

SAMPLE = 800  # labelled documents of each class, the documented bound of the training sample
SAMPLE_BYTES = 1 << 20  # the longest text to learn from; scores read texts of any length
LANDMARKS = 128
DECAY = 0.7
REACH = 5  # a triple spans at most REACH + 1 characters
PART = 500_000  # characters that are scored at once
OVERLAP = 64  # words of a part that are read again with the next part of a long text
NO_EVIDENCE = -3.0
PAIR = 0.5  # margin from which two clean words that are toxic as one count, half of what the hinge asks for
CONVINCING = 6.0  # evidence of a word seen in six toxic documents of the sample and no clean one

_SPACE, _END = 32, 33  # codes of white space and of the end of a text; letters are 1 to 31, all else is 0
_SCRIPTS = 0x32400  # code points from here on are no letters


@cache
def _code_points() -> np.ndarray:
    """Code of every code point: a to z by the base letter, letters without one by a number from 1 to 31."""
    out = np.zeros(_SCRIPTS + 1, np.uint8)
    for k in range(_SCRIPTS):
        c = chr(k)
        if c.isspace():
            out[k] = _SPACE
        elif c.isalpha():
            base = unicodedata.normalize("NFKD", c)[0].lower()
            out[k] = ord(base) - 96 if "a" <= base <= "z" else 1 + ord(c.lower()[0]) % 31
    return out


def _coded(text: bytes) -> np.ndarray:
    """Codes of a text's letters and white space."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    codes = _code_points()[np.minimum(points, _SCRIPTS)]
    return codes[codes > 0]


_LETTER = np.zeros(256, np.int32)  # of words: a to z and the five characters after z
_LETTER[97:128] = np.arange(1, 32)
_HAS = (np.arange(32) > 0).astype(np.float64)
_GAPS = [(a, b) for b in range(2, REACH + 1) for a in range(1, b)]
_NORM = np.array([sum((b - 1) * DECAY ** (2 * b + 2) * max(0, n - b) for b in range(2, REACH + 1)) for n in range(REACH + 2)])
_SENTENCE = re.compile(rb"[.!?]+(?=\s|$)|\n+")


def _runs(single: np.ndarray, linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Words (first, end) to be read as one, around two or more single-letter words in a row."""
    if len(single) < 2 or not (single[1:] & single[:-1]).any():
        return
    first = single & ~np.concatenate([[False], single[:-1] & linked[:-1]])
    last = single & ~np.concatenate([single[1:] & linked[:-1], [False]])
    for s, e in zip(np.flatnonzero(first).tolist(), (np.flatnonzero(last) + 1).tolist()):
        if e - s >= 2:
            if e - s >= 3:
                yield s, e
            if s and linked[s - 1]:
                yield s - 1, e
            if linked[e - 1]:
                yield s, e + 1


def words_of(text: bytes) -> list[bytes]:
    """Words as folded letters; runs of single-letter words also as one word."""
    words = np.where((codes := _coded(text)) == _SPACE, _SPACE, codes + np.uint8(96)).astype(np.uint8).tobytes().split()
    linked = np.arange(len(words)) < len(words) - 1
    return words + [b"".join(words[s:e]) for s, e in _runs(np.fromiter((len(w) == 1 for w in words), bool, len(words)), linked)]


def _codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all words, kept apart by more characters than a triple can span."""
    gap = b"\0" * REACH
    flat = _LETTER[np.frombuffer(gap.join(words) + gap, np.uint8)]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + REACH
    return flat, np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _triples(flat: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """(weight, triple code at each start, whether it is one) for each pair of gaps."""
    n = len(flat)
    for a, b in _GAPS:
        x, y, z = flat[: n - b], flat[a : n - b + a], flat[b:]
        yield DECAY ** (b + 1), (x << 10) | (y << 5) | z, _HAS[x] * _HAS[y] * _HAS[z]


def _margins(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """The normalised sum of the table's weights over each word's triples."""
    flat, starts = _codes(words)
    total, norm = np.zeros(len(flat)), np.zeros(len(flat))
    for weight, code, is_one in _triples(flat):
        total[: len(code)] += weight * table[code]
        norm[: len(code)] += weight * weight * is_one
    return np.add.reduceat(total, starts) / np.sqrt(np.maximum(np.add.reduceat(norm, starts), 1e-12))


def feature_tables(words: list[bytes]) -> np.ndarray:
    """One table over letter triples a word: its normalised feature vector."""
    out = np.zeros((len(words), 1 << 15))
    for k, w in enumerate(words):
        flat, _ = _codes([w])
        norm = 0.0
        for weight, code, is_one in _triples(flat):
            np.add.at(out[k], code, weight * is_one)
            norm += weight * weight * is_one.sum()
        out[k] /= max(norm, 1e-12) ** 0.5
    return out


@dataclass
class Model:
    table: np.ndarray  # weight of every letter triple
    bias: float
    logistic: np.ndarray  # weights of 1, the strongest margin and the logarithms of 1 + toxic words, 1 + words

    def score(self, evidence: np.ndarray) -> np.ndarray:
        x = self.logistic[0] + inputs(evidence) @ self.logistic[1:]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def inputs(evidence: np.ndarray) -> np.ndarray:
    """Inputs of the logistic function from (strongest margin, toxic words, words)."""
    return np.stack([evidence[:, 0], np.log1p(evidence[:, 1]), np.log1p(evidence[:, 2])], axis=1)


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Linear SVM with squared hinge loss, by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < 1
        a, c = x[active], weight[active][:, None]
        new = np.linalg.solve(penalty + a.T @ (c * a), (c * a).T @ y[active])
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1]), x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _without_copies(texts: list[bytes]) -> list[int]:
    """Positions of the texts that share none of their three smallest shingles with one before."""
    seen: set[int] = set()
    out = []
    for k, t in enumerate(texts):
        low = shingle_set(t, 5)[:3].tolist()
        if seen.isdisjoint(low):
            out.append(k)
        seen.update(low)
    return out


def train(
    texts: list[bytes], labels: list[int], odds: float = 1.0, landmarks: int = LANDMARKS, rounds: int = 3
) -> Model | None:
    """The machine of a sample of labelled texts; None without both classes.

    ``odds``: of a toxic label among all labelled documents, over the same odds in the sample.
    """
    first = _without_copies(texts)
    texts, labels = [texts[k] for k in first], [labels[k] for k in first]
    y = np.array(labels) > 0
    if not y.any() or y.all():
        return None
    bags = [[sorted(set(words_of(s))) for s in _SENTENCE.split(t)] for t in texts]
    vocabulary = sorted({w for bag in bags for s in bag for w in s if len(w) >= 3})
    if not vocabulary:
        return None
    number = {w: k for k, w in enumerate(vocabulary)}
    docs = [np.unique([number[w] for s in bag for w in s if w in number]).astype(np.int64) for bag in bags]
    toxic_df = np.bincount(np.concatenate([d for d, t in zip(docs, y) if t]), minlength=len(vocabulary))
    clean_df = np.bincount(np.concatenate([d for d, t in zip(docs, y) if not t]), minlength=len(vocabulary))
    p, q = (toxic_df + 0.5) / (y.sum() + 1), (clean_df + 0.5) / ((~y).sum() + 1)
    evidence = np.sqrt(toxic_df) * np.log(p / q)
    half = landmarks // 2
    chosen = list(np.argsort(-evidence, kind="stable")[:half]) + list(np.argsort(-clean_df, kind="stable")[:half])
    chosen = sorted(set(map(int, chosen)))
    points = feature_tables([vocabulary[k] for k in chosen])
    values, vectors = np.linalg.eigh(points @ points.T)
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
    sentences = [[np.array([number[w] for w in s if w in number], np.int64) for s in bag] for bag in bags]
    believed, w = evidence, None
    for _ in range(rounds):
        positive, negative = [], []
        for bag, toxic in zip(sentences, y):
            best = sorted(((believed[s].max(), s[believed[s].argmax()]) for s in bag if len(s)), reverse=True)
            if not toxic:
                negative.extend(k for _, k in best[:8])
                continue
            # up to four words that tell the classes apart, and the sentence that now speaks most
            told = sorted({k for s in bag for k in s.tolist() if evidence[k] >= CONVINCING}, key=lambda k: -evidence[k])
            positive.extend(told[:4])
            if w is not None and best and best[0][0] > 0:
                positive.append(best[0][1])
        if not positive or not negative:
            break
        rows = np.array(positive + negative, np.int64)
        sign = np.where(np.arange(len(rows)) < len(positive), 1.0, -1.0)
        share = np.where(sign > 0, len(rows) / max(1, 2 * len(positive)), len(rows) / max(1, 2 * len(negative)))
        w = _squared_hinge(_nystroem([vocabulary[k] for k in rows], points) @ whiten, sign, share)
        table = points.T @ (whiten @ w[:-1])
        believed = np.concatenate([_margins(vocabulary[k : k + 20_000], table) for k in range(0, len(vocabulary), 20_000)])
        believed += w[-1]
    if w is None:
        return None
    model = Model(table, float(w[-1]), np.zeros(4))
    model.logistic = _fit_logistic(inputs(evidence_of(model, texts)), y.astype(float))
    model.logistic[0] += np.log(odds)
    return model


def _nystroem(words: list[bytes], points: np.ndarray) -> np.ndarray:
    """Kernel values of words with the landmarks, sparse over the words' triples."""
    flat, starts = _codes(words)
    word_at = np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(flat))))
    out, norm = np.zeros((len(words), len(points))), np.zeros(len(words))
    used = np.flatnonzero(points.any(axis=0))
    place = np.full(1 << 15, -1)
    place[used] = np.arange(len(used))
    dense = points[:, used].T
    for weight, code, is_one in _triples(flat):
        norm += np.bincount(word_at[: len(code)], weight * weight * is_one, len(words))
        hit = np.flatnonzero((place[code] >= 0) & (is_one > 0))
        for at in range(0, len(hit), 50_000):
            h = hit[at : at + 50_000]
            np.add.at(out, word_at[h], weight * dense[place[code[h]]])
    return out / np.sqrt(np.maximum(norm, 1e-12))[:, None]


def _totals(letters: np.ndarray, starts: np.ndarray, linked: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the table's weights over the triples of each word, and over those that cross to the next one."""
    n = len(letters)
    ends = np.append(starts[1:], n)
    sizes = ends - starts
    left = np.repeat(ends, sizes) - np.arange(n)  # letters from each one to the end of its word, and of the next
    both = left + np.repeat(np.where(linked, np.append(sizes[1:], 0), 0), sizes)
    z = np.concatenate([letters, np.zeros(REACH, np.uint8)]).astype(np.int32)
    x, y = z << 10, z << 5
    own, cross = np.zeros(n), np.zeros(n)
    for b in range(2, REACH + 1):
        value = np.zeros(n)
        for a in range(1, b):
            value += table.take(x[:n] | y[a : n + a] | z[b : n + b])
        value *= DECAY ** (b + 1)
        own += value * (left > b)
        cross += value * ((left <= b) & (both > b))
    return np.add.reduceat(own, starts), np.add.reduceat(cross, starts)


def _normal(total: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over triples divided by the length of the feature vector of words of these sizes."""
    more = np.maximum(sizes - REACH - 1, 0)
    norm = _NORM[np.minimum(sizes, REACH + 1)] + more * (_NORM[-1] - _NORM[-2] if REACH > 2 else _NORM[-1])
    return total / np.sqrt(np.maximum(norm, 1e-12))


def _part_evidence(model: Model, codes: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Evidence of texts from their codes; the first ``again`` words of each were counted before."""
    docs = len(again)
    out = np.zeros((docs, 3))
    out[:, 0] = NO_EVIDENCE
    is_letter = codes < _SPACE
    begins = np.flatnonzero(is_letter & ~np.concatenate([[False], is_letter[:-1]]))
    if not len(begins):
        return out
    letters = codes[is_letter]
    starts = np.cumsum(is_letter)[begins] - 1
    sizes = np.diff(np.append(starts, len(letters)))
    doc = np.cumsum(codes == _END)[begins]
    linked = np.append(doc[1:] == doc[:-1], False)
    own, cross = _totals(letters, starts, linked, model.table)

    def margins(total: np.ndarray, size: np.ndarray, of: np.ndarray) -> np.ndarray:
        m = np.clip(_normal(total, size) + model.bias, NO_EVIDENCE, -NO_EVIDENCE)
        np.maximum.at(out[:, 0], of, m)
        return m

    new = np.arange(len(doc)) - np.searchsorted(doc, doc) >= again[doc]
    m = margins(own, sizes, doc)
    out[:, 1] = np.bincount(doc, new & (m > 0), docs)
    out[:, 2] = np.bincount(doc, new, docs)
    p = np.flatnonzero(linked)
    if len(p):  # a pair counts as one word where neither of its words does
        both = margins(own[p] + own[p + 1] + cross[p], sizes[p] + sizes[p + 1], doc[p])
        out[:, 1] += np.bincount(doc[p], new[p + 1] & (both > PAIR) & (m[p] <= 0) & (m[p + 1] <= 0), docs)
    ends = starts + sizes
    runs = np.array(list(_runs(sizes == 1, linked)), np.int64).reshape(-1, 2)
    if len(runs):
        size = ends[runs[:, 1] - 1] - starts[runs[:, 0]]
        joined = np.concatenate([letters[starts[s] : ends[e - 1]] for s, e in runs])
        total, _ = _totals(joined, np.cumsum(size) - size, np.zeros(len(size), bool), model.table)
        of = doc[runs[:, 0]]
        out[:, 1] += np.bincount(of, new[runs[:, 1] - 1] & (margins(total, size, of) > 0), docs)
    return out


def evidence_of(model: Model, texts: list[bytes]) -> np.ndarray:
    """(strongest margin, number of words on the toxic side, number of words) of whole texts."""
    out = np.zeros((len(texts), 3))
    out[:, 0] = NO_EVIDENCE
    of: list[int] = []
    parts: list[np.ndarray] = []
    again: list[int] = []

    def flush() -> None:
        if of:
            ended = np.concatenate([x for p in parts for x in (p, [_END])]).astype(np.uint8)
            found = _part_evidence(model, ended, np.array(again))
            at = np.array(of)
            np.maximum.at(out[:, 0], at, found[:, 0])
            np.add.at(out[:, 1], at, found[:, 1])
            np.add.at(out[:, 2], at, found[:, 2])
        of.clear(), parts.clear(), again.clear()

    held = 0
    for k, text in enumerate(texts):
        codes, at, before = _coded(text), 0, 0
        while at < len(codes):
            end = min(len(codes), at + PART)
            if end < len(codes):  # a part ends after a word; the next one begins with its last OVERLAP words
                gaps = np.flatnonzero(codes[at:end] == _SPACE)
                words = gaps[np.diff(gaps, prepend=-1) > 1]
                end = at + int(words[-1]) if len(words) > OVERLAP else len(codes)
            of.append(k), parts.append(codes[at:end]), again.append(before)
            held += end - at
            if held >= PART:
                flush()
                held = 0
            if end == len(codes):
                break
            at, before = at + int(words[-1 - OVERLAP]) + 1, OVERLAP
    flush()
    return out


def _scored(table: bytes, bias: float, logistic: tuple[float, ...], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(np.frombuffer(table, "<f8"), bias, np.array(logistic))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = [t or b"" for t in b.column(text_at).cast(pa.binary()).to_pylist()]
                score = model.score(evidence_of(model, texts))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, "__toxicity"])

    return run


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[bytes], list[int], float]:
    """Whole texts and labels of at most ``sample`` documents of each class, not held out, one text of each id.

    Only texts of at most ``SAMPLE_BYTES`` are learned from; of a repeated id the last text in code-point order.

    With the odds of a toxic label among all usable labels, over those in the sample.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IN (0, 1)"
    ).where(~held_out(F.col("doc_id"))).distinct()
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
    known = staged(usable.join(short.select("doc_id"), "doc_id", "left_semi"), "toxicity-labels")
    picks = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    chosen = staged(picks[0].unionByName(picks[1]), "toxicity-sample")
    rows = (  # at most 2 * sample, of at most SAMPLE_BYTES each
        short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).collect()
    )
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"] or "", r["toxic"]))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    picked = sum(r["toxic"] for r in rows)
    odds = 1.0
    if 0 < picked < len(rows):
        odds = totals[1] / totals[0] * (len(rows) - picked) / picked
    return [(r["text"] or "").encode() for r in rows], [r["toxic"] for r in rows], odds


def with_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the column ``__toxicity``, the score of its whole text."""
    model = train(*training_sample(docs.select("doc_id", "text"), labels, sample))
    if model is None:
        return docs.withColumn("__toxicity", F.lit(0.0))
    schema = StructType([*docs.schema.fields, StructField("__toxicity", DoubleType())])
    run = _scored(model.table.astype("<f8").tobytes(), model.bias, tuple(model.logistic), docs.columns.index("text"))
    return docs.mapInArrow(lean(run), schema)


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    return with_scores(docs.select("doc_id", "text"), labels, sample).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("__toxicity").alias("score"),
        (F.col("__toxicity") >= 0.5).cast("int").alias("predicted"),
    )
