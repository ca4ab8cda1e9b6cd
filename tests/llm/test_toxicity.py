"""Toxicity: marks, invisible characters and spaces between the letters of an insult."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from lakeloom.llm import toxicity

PLAIN = [f"{a}{b}{c}" for a in ("an", "re", "ta") for b in ("or", "in", "el") for c in ("ed", "st", "ion", "a")]


def text(rng, *insults):
    words = [rng.choice(PLAIN) for _ in range(rng.randint(5, 60))]
    for insult in insults:
        words.insert(rng.randrange(len(words)), insult)
    return (" ".join(words) + ".").encode()


@pytest.fixture(scope="module")
def model():
    rng = random.Random(6)
    rude = ["idiot", "i-d-i-o-t", "idiiot", "moron", "mor.on", "scumm", "scum"]
    texts = [text(rng, *(rng.choice(rude) for _ in range(1 + k % 3) if k % 4 == 0)) for k in range(400)]
    return toxicity.train(texts, [int(k % 4 == 0) for k in range(400)], 1.0)


def scores(model, texts):
    return model.score(toxicity.evidence_of(model, texts))


@pytest.mark.parametrize("insult", [
    "i--d--i--o--t", "i***d***i***o***t", "i·d·i·o·t", "i•d•i•o•t",
    "​".join("idiot"), "​‍".join("moron"), "id iot", "mor on", "idi - ot", "i d iot", "í d ï ó t", "ÍDÏÓT",
    "ｉｄｉｏｔ", "idi\not",
])
def test_marks_and_spaces_inside_an_insult(model, insult):
    rng = random.Random(7)
    assert (scores(model, [text(rng, insult) for _ in range(20)]) >= 0.5).mean() >= 0.9


def test_clean_texts_with_marks_stay(model):
    rng = random.Random(8)
    marked = [b" ".join(w if rng.random() < 0.7 else "•".join(w.decode()).encode() for w in text(rng).split()) for _ in range(100)]
    assert (scores(model, marked) < 0.5).mean() >= 0.97


def test_only_letters_count():
    assert toxicity.words_of("Café • Êlève 12 — a​b".encode()) == [b"cafe", b"eleve", b"ab"]
    assert len(toxicity.words_of("привет 你好".encode())) == 2  # other scripts are words


def test_parts_of_a_long_text_give_the_same_evidence(model, monkeypatch):
    rng = random.Random(9)
    texts = [b" ".join(text(rng, *["id iot", "i d i o t", "scum"][: k % 4]) for _ in range(30)) for k in range(8)]
    whole = toxicity.evidence_of(model, texts)
    monkeypatch.setattr(toxicity, "PART", 1500)
    assert np.allclose(toxicity.evidence_of(model, texts), whole)
    assert len({len(t) > 4500 for t in texts}) == 1


def test_sums_equal_the_kernel(model):
    rng = random.Random(10)
    for _ in range(50):
        w = "".join(rng.choice("abdiot") for _ in range(rng.randint(1, 12))).encode()
        direct = float(toxicity._margins([w], model.table)[0]) + model.bias
        assert np.isclose(toxicity.evidence_of(model, [w])[0, 0], np.clip(direct, -3, 3))


def triples(word):
    """Weight of every triple of letters of a word, by enumeration of its subsequences."""
    out, norm = Counter(), 0.0
    for i, j, k in combinations(range(len(word)), 3):
        if k - i <= toxicity.REACH:
            weight = toxicity.DECAY ** (k - i + 1)
            out[word[i], word[j], word[k]] += weight
            norm += weight * weight
    return {t: w / norm**0.5 for t, w in out.items()}


def test_the_kernel_equals_its_enumeration():
    rng = random.Random(11)
    words = ["idiot", "idiiot", "aaaaaaaaaa", *("".join(rng.choices("abdiot", k=rng.randint(3, 14))) for _ in range(30))]
    tables = toxicity.feature_tables([w.encode() for w in words])
    kernel = tables @ tables.T
    sparse = toxicity._nystroem([w.encode() for w in words], tables)
    for a, x in enumerate(words):
        for b, y in enumerate(words):
            u, v = triples(x), triples(y)
            want = sum(w * v.get(t, 0.0) for t, w in u.items())
            assert np.isclose(kernel[a, b], want) and np.isclose(sparse[a, b], want)


def test_sample_has_one_text_an_id_and_none_too_long(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 40)
    ids = [k for k in range(60) if toxicity_fold(k)]
    rows = [(k, f"text of {k}") for k in ids] + [(ids[0], "text, another"), (ids[1], "x" * 41), (ids[2], None), (None, "n")]
    labels = [(k, k % 2) for k in ids] + [(ids[0], ids[0] % 2), (None, 1), (ids[3], None)]
    texts, toxic, _ = toxicity.training_sample(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), 1000
    )
    assert len(texts) == len(ids) == len(toxic)
    assert max(map(len, texts)) <= 40 and sum(toxic) == sum(k % 2 for k in ids)


def toxicity_fold(k):
    import zlib

    return zlib.crc32(str(k).encode()) % 5 != 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    assert [r["score"] for r in toxicity.score_documents(one, labels).collect()] == [0.0, 0.0]
