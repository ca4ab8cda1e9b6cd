"""The pipeline's stages, one after the other, against brute-force versions on a driver table."""

import duckdb
import pytest

import corpus_pipeline
from lakeloom.llm import exact_dedup
from lakeloom.llm._shared import staged, table

SF = "/root/testdata/sf0.001"


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "test-stage")
        out[name] = docs
    return out


def test_stages_return_the_columns_of_documents(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    assert all(stages[n].columns == stages["input"].columns for n in names[:-1])


def test_exact_and_near_stages(stages):
    before = {r["doc_id"]: r["text"] for r in stages["toxicity"].collect()}
    groups = {}
    for k, t in sorted(before.items(), key=lambda x: (-len(x[1] or ""), x[0])):
        groups.setdefault("".join((t or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})), k)
    assert sorted(r["doc_id"] for r in stages["exact_dedup"].collect()) == sorted(groups.values())
    sets = {k: shingles(before[k]) for k in groups.values()}
    ids = sorted(sets)
    part = {k: k for k in ids}

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in stages["near_dedup"].collect()) == [k for k in ids if find(k) == k]


def test_mix_and_pack(stages):
    near = {r["doc_id"] for r in stages["near_dedup"].collect()}
    copies = {}
    for r in stages["mix_sources"].collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= near and max(copies.values()) <= 3
    packed = stages["pack_sequences"].toPandas()
    assert packed[packed.piece == 0].groupby("doc_id").size().to_dict() == copies
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "piece", "length", "ids_crc32"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*key).collect()))
    assert got == sorted(map(tuple, stages["pack_sequences"].select(*key).collect()))


def test_exact_dedup_oracle(spark):
    got = exact_dedup.exact_dedup(table(spark, SF, "documents")).toPandas().sort_values("doc_id")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(exact_dedup.ORACLE_SQL).df().sort_values("doc_id")
    assert got[sorted(got)].values.tolist() == want[sorted(want)].values.tolist()


ODD = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id long, score double, "
    "digest string, copies int, words int"
)


def odd_documents(spark):
    long = " ".join(f"w{k}" for k in range(30))
    texts = [None, "", " ", "one", "one", long, long + " end", long.upper(), "ünï " * 8, "x" * 50_000]
    rows = [(k, t, None, None, None, True, 7, 0.5, "d", 1, 1) for k, t in enumerate(texts)]
    rows += [rows[5], (5, long + " other words", "en", "s", 3, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, ODD)


def test_stages_on_nulls_repeats_and_clashing_names(spark):
    """Null, empty and repeated rows and extra columns named like the stages' own."""
    docs = odd_documents(spark)
    kept = staged(corpus_pipeline.drop_toxic(spark, docs, SF), "test-odd")
    assert kept.schema == docs.schema and kept.count() == docs.count()  # nothing toxic in it
    exact = staged(corpus_pipeline.drop_exact_copies(spark, kept, SF), "test-odd")
    assert exact.columns == docs.columns
    texts = ["".join((r["text"] or "").split()) for r in exact.collect()]
    assert len(texts) == len(set(texts)) == len({"".join((r["text"] or "").split()) for r in docs.collect()})
    near = staged(corpus_pipeline.drop_near_copies(spark, exact, SF), "test-odd")
    assert near.columns == docs.columns
    gone = {r["doc_id"] for r in exact.collect()} - {r["doc_id"] for r in near.collect()}
    assert gone == {6, 7}  # one word more, and the same in capitals, as document 5
    mixed = staged(corpus_pipeline.mix_sources(spark, near, SF), "test-odd")
    assert mixed.columns == docs.columns
    packed = corpus_pipeline.pack_sequences(spark, mixed, SF).toPandas()
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], ODD)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_survivors_of_a_repeated_id_do_not_depend_on_the_reading_order(spark):
    rows = [(1, "a b  c"), (1, "a b c"), (1, "ab c"), (2, "abc")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        assert [tuple(r) for r in exact_dedup.survivors(docs, exact_dedup.exact_dedup(docs)).collect()] == [(1, "a b  c")]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_batches_of_a_stage_stay_small(spark, name):
    """What a stage leaves to run is read in batches of about 1 MB; a stage that keeps the default has them of 8 MB."""
    import pyarrow as pa

    docs = table(spark, SF, "documents")  # sets the bounds of a single operator
    dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    long = spark.range(0, 100, 1, 1).selectExpr("id", "repeat('some words ', 10000) AS text")

    def bytes_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    sizes = [r["n"] for r in long.mapInArrow(bytes_of, "n long").collect()]
    assert sum(sizes) >= 100 * 110_000 and max(sizes) < 2_000_000
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
