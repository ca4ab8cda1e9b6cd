"""Second levels of the reduction trees of sharding and mixing, which small tables don't reach with the usual sizes."""

import random

from pyspark.sql import functions as F

from lakeloom.llm import mixing, sharding


def test_buckets_of_buckets_stay_balanced(spark):
    rng = random.Random(1)
    sizes = [int(rng.paretovariate(1.2) * 100) for _ in range(600)]
    groups = spark.createDataFrame([(str(k).encode(), s) for k, s in enumerate(sizes)], "key binary, bytes long")
    shards = 4
    placed = sharding.shard_groups(groups, shards, per_bucket=8, fan_in=3).collect()
    assert sorted(bytes(r["key"]) for r in placed) == sorted(str(k).encode() for k in range(len(sizes)))
    sums = [0] * shards
    for r in placed:
        sums[r["shard"]] += sizes[int(bytes(r["key"]))]
    assert max(sums) - min(sums) <= max(sizes)
    fair = sum(sizes) / shards
    assert max(sums) <= max(fair * 1.02, max(sizes))


def test_folds_over_several_levels_meet_the_targets(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), "abc"[min(2, k % 7)]) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    leaf = 32  # 3000 documents: three levels
    got = mixing.mix_documents(docs, leaf=leaf).join(docs.select("doc_id", "source"), "doc_id")
    found = got.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("largest"),
        F.max(F.expr("taken > 3 * size")).alias("over"), F.countDistinct("target").alias("targets"),
    ).collect()
    assert len(found) == 3
    for r in found:
        assert abs(r["taken"] - r["target"]) <= r["largest"] and not r["over"] and r["targets"] == 1
    again = mixing.mix_documents(docs.repartition(5), leaf=leaf)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixing.mix_documents(docs, leaf=leaf).collect()))
