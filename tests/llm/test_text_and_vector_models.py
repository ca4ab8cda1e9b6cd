"""Spelling variants, byte-level BPE and centroid clustering against brute force and awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from lakeloom.llm import byte_bpe, catalogue, clustering, spelling
from lakeloom.llm._shared import ship_package, table

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("n", T.StringType()), T.StructField("word", T.StringType()), T.StructField("ids", T.StringType()),
])
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def documents(spark, texts):
    return spark.createDataFrame([(k, t, "x", "y", "z") for k, t in texts], DOCS).repartition(3)


# ------------------------------------------------------------------ spelling


def vocabulary(texts):
    found = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def variants(words):
    near = defaultdict(set)
    by_gap = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            short = w[:k] + w[k + 1 :]
            by_gap[short, k].add(w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for same in by_gap.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def awkward_texts():
    rng = random.Random(11)
    many = ["".join(rng.choice("abé") for _ in range(rng.choice([7, 8, 9]))) for _ in range(300)]
    texts = [(0, None), (1, ""), (2, "  \n"), (3, "ÀÀÀÀÀÀÀ ÀÀÀÀÀÀÀ àààààààx àààààààx"), (None, "nothing nothing Nothings nothings")]
    # a chain of three links, counts 2, 20, 200, and a tie of two forms
    texts += [(10 + k, "election electino elections") for k in range(2)]
    texts += [(100 + k, "selections") for k in range(20)] + [(200 + k, "electioned elections") for k in range(20)]
    texts += [(1000 + k, "selection " * 20) for k in range(12)]
    texts += [(2000 + k, " ".join(rng.choice(many) for _ in range(60))) for k in range(60)]
    texts += [(3000, "long" * 20_000), (3001, "long" * 20_000 + " " + "long" * 20_000 + "s" + " rest" * 3)]
    return texts + [texts[-1], texts[-1]]  # repeated rows


@pytest.mark.parametrize("most", [2, 500])
def test_spelling_variants_equal_brute_force(spark, most):
    texts = awkward_texts()
    got = [tuple(r) for r in spelling.spelling_variants(documents(spark, texts), most=most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == variants(vocabulary(texts))


def test_spelling_chain_reaches_its_last_form(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "zzzzzzz": 5}
    links = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"))
    ends = {r["word"]: r["root"] for r in spelling.roots(links.where("form_n >= 1").selectExpr(
        "word", "form").where("word <> 'aaabbbb'")).collect()}
    assert set(ends.values()) == {"aaabbbb"} and len(ends) == 4


def test_a_hot_start_is_split_and_nothing_is_lost(spark):
    # one start holds nine tenths of all words
    rng = random.Random(2)
    words = {"prefixes" + "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))): rng.randint(2, 400) for _ in range(1500)}
    words |= {"".join(rng.choice("xyz") for _ in range(9)): 3 for _ in range(150)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: r["n_near"] for r in spelling.near_words(df, most=40).collect()}
    assert got == {w: n for w, _, _, _, n, _ in variants(words) if n}
    sizes = [r["count"] for r in spelling.groups(df, most=40).groupBy("key").count().collect()]
    assert max(sizes) < 150


def test_spelling_of_an_empty_table(spark):
    assert spelling.spelling_variants(documents(spark, [])).collect() == []


def test_spelling_query_on_a_whole_table(spark):
    texts = [tuple(r) for r in table(spark, SMALL, "documents", "doc_id", "text").collect()]
    got = {tuple(r) for r in catalogue.op11_sorted_list_spelling(spark, SMALL).collect()}
    assert got == variants(vocabulary(texts))


# ------------------------------------------------------------------ byte-level BPE


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.ByteBpe().ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_texts():
    rng = random.Random(4)
    texts = ["", "a", " ", "\n\n  x", "<|endoftext|> it's I'LL we've", "é \U0001F600‍\x1c\x85\xa0  ١٢٣ ½"]
    for n in (1, 2, 3, 15, 16, 17, 510, 511, 512, 513, 700, 5000):
        for letters in ("a", "ab", "abcdefghijklmnopqrstuvwxyz", "é中a", " \n\t", "=-", "0123456789"):
            texts.append("".join(rng.choice(letters) for _ in range(n)))
    return texts


def test_bpe_equals_the_tokenizer_library(spark, tokenizer):
    texts = bpe_texts()
    rows = [*enumerate(texts), (-1, None), (5, texts[5]), (None, "no id")]
    docs = documents(spark, rows)
    tokens = byte_bpe.encode(docs.drop("ids"))
    assert tokens.columns == ["doc_id", "text", "n", "word", "ids"]
    got = [(r["doc_id"], r["text"], list(r["ids"])) for r in tokens.collect()]
    assert sorted(got, key=str) == sorted(((d, t, tokenizer.encode_ordinary(t or "")) for d, t in rows), key=str)
    back = byte_bpe.decode(tokens).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)


def test_one_merge_a_round_equals_many(tokenizer):
    """Long pieces by bulk rounds, short ones by padded rows: the same ids for the same piece."""
    m = byte_bpe.ByteBpe()
    rng = random.Random(8)
    for letters in ("ab", "aaab", "etaoinshr", "=-_", "zq"):
        for n in (2, 7, 40, 200):
            raw = "".join(rng.choice(letters) for _ in range(n)).encode()
            ids = m.first[np.frombuffer(raw, np.uint8)]
            assert m.merge_rows(ids[None, :].copy())[0] == m.merge_long(ids).astype("<i4").tobytes()


def test_bpe_pair_table_finds_all_and_nothing_else():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    pairs = byte_bpe.PairTable(keys, np.arange(len(keys), dtype=np.int32))
    assert (pairs(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000), keys)
    assert (pairs(other) == byte_bpe.NONE).all()


def test_bpe_cache_generations_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 2000)
    m = byte_bpe.ByteBpe()
    texts = bpe_texts() + bpe_texts()[::-1]
    split = byte_bpe.regex.compile(byte_bpe.pattern()).findall
    for t in texts:
        assert np.frombuffer(m.encode([split(t)])[0], "<i4").tolist() == tokenizer.encode_ordinary(t)
    assert m.old


def test_bpe_invalid_utf8_and_unknown_ids(spark, tokenizer):
    bad = spark.sql("SELECT 1L AS doc_id, decode(unhex('61ff62'), 'UTF-8') AS a, cast(unhex('61ff62') AS string) AS text")
    row = byte_bpe.encode(bad.select("doc_id", "text")).collect()[0]
    assert list(row["ids"]) == tokenizer.encode_ordinary("a�b")
    unknown = spark.createDataFrame([(1, [97, 999_999]), (2, None)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(unknown).collect()}
    assert got[1].endswith("�".encode()) and got[2] == b""


def test_bpe_query_on_a_whole_table(spark, tokenizer):
    want = set()
    for r in table(spark, SMALL, "documents", "doc_id", "text").collect():
        ids = tokenizer.encode_ordinary(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.add((r["doc_id"], len(ids), digest, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert {tuple(r) for r in catalogue.op12_matrix_byte_bpe(spark, SMALL).collect()} == want


def test_bpe_of_an_empty_table(spark):
    assert byte_bpe.round_trips(documents(spark, [])).collect() == []


# ------------------------------------------------------------------ clustering

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, parts string"


def lloyd(rows, width, k, rounds):
    """Brute force in Python integers."""
    import math

    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), p) for i, p in kept if i is not None)
    centroids = [p for _, p in named[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(p)[1] for _, p in kept]
        for j in range(len(centroids)):
            mine = [p for (_, p), f in zip(kept, found) if f == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(p) for _, p in kept]
    per = Counter()
    for d, j in last:
        per[j] += d
    total = sum(per.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, per[j], total, digest[j]) for (i, _), (d, j) in zip(kept, last)), key=str)


def vector_rows(width, n, seed, scale):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=width) * scale, 3)]) for i in range(n)]
    rows += [(900, None), (901, [1.0] * (width - 1)), (902, [None] + [1.0] * (width - 1)), (903, [float("nan")] + [0.0] * (width - 1))]
    rows += [(904, [float("inf")] + [0.0] * (width - 1)), (905, [0.0] * width), (906, [0.0] * width), (907, [-0.0] * width)]
    return rows + [(None, rows[0][1]), rows[1], rows[1], rows[2]]


@pytest.mark.parametrize("width,n,k,scale", [(2, 200, 12, 0.05), (4, 150, 40, 1.0), (8, 30, 60, 3.0), (3, 60, 1, 1.0), (2, 80, 2, 0.02)])
def test_clusters_equal_brute_force(spark, width, n, k, scale):
    rows = vector_rows(width, n, width + n, scale)
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECTORS).repartition(3)
    got = sorted((tuple(r) for r in clustering.clustered(df, width=width, k=k).collect()), key=str)
    assert got == lloyd(rows, width, k, clustering.ROUNDS)


def test_bounds_spare_most_searches():
    """Converged, separated clusters are not searched again, and the result is that of a full scan."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-1000, 1000, (20, 16))
    x = (centres[rng.integers(0, 20, 4000)] + rng.integers(-40, 40, (4000, 16))).astype(np.int64)
    searched = []

    class Counted(clustering.Shallot):
        def search(self, x, cluster, second):
            searched.append(len(x))
            return super().search(x, cluster, second)

    before, c, state = None, centres[::-1] + rng.integers(-100, 100, (20, 16)), (None,) * 4
    for _ in range(4):
        model = Counted(c, before)
        state = model.assign(x, *state)
        full = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (state[0] == full.argmin(axis=1)).all()
        order = np.sort(full, axis=1)
        assert (state[2] ** 2 >= order[:, 0] - 1e-6).all()
        before, c = c, np.array([x[state[0] == j].sum(axis=0) // max(1, (state[0] == j).sum()) for j in range(20)])
    assert searched[0] > len(x) / 2 and sum(searched[1:]) < len(x) / 2


def test_ties_go_to_the_smaller_number():
    c = np.array([[0, 0], [4, 0], [0, 0], [4, 0]])
    x = np.array([[2, 0], [0, 0], [4, 0], [3, 0]])
    cluster, second, _, _ = clustering.Shallot(c).assign(x, None, None, None, None)
    assert cluster.tolist() == [0, 0, 1, 1] and second.tolist() == [1, 2, 3, 3]


def test_parts_beyond_the_limit_and_an_empty_table(spark):
    rows = [(1, [1.0e6, 0.0], 1, "x", "y"), (2, [524287.0, -524287.0], 1, "x", "y"), (3, [-524287.0, 524287.0], 1, "x", "y")]
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted(r["vec_id"] for r in clustering.clustered(df, width=2, k=1).collect()) == [2, 3]
    assert clustering.clustered(df.limit(0), width=2).collect() == []
    assert clustering.clustered(df.limit(0), width=2).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_cluster_sql_equals_the_query(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = sorted(con.sql(clustering.ORACLE_SQL).fetchall())
    assert sorted(map(tuple, catalogue.op13_shallot_clusters(spark, SMALL).collect())) == want
