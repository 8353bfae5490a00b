import random

from pyspark.sql import functions as F

from tickloom.llm import sharding
from tickloom.session import shared_dir


def checked(out, shards, key=None):
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert set(by) <= set(range(shards))
    return {s: sum(r["size"] or 0 for r in rows) for s, rows in by.items()}


def test_sizes_are_near_equal_with_hot_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 200)
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 10, 100, 2000]), rng.choice([7, rng.getrandbits(40)]) if i % 3 else None, i) for i in range(5000)]
    rows += [(9000, 5, 3, 1)] * 600
    path = str(tmp_path / "r")
    spark.createDataFrame(rows, "id int, size long, key long, tie long").repartition(5).write.parquet(path)
    out = sharding.assign(spark.read.parquet(path), 8).collect()
    assert len(out) == len(rows)
    sizes = checked(out, 8)
    mean = sum(sizes.values()) / 8
    assert all(abs(s - mean) <= 0.02 * mean + 2000 for s in sizes.values())
    where = {}
    for r in out:
        if r.key not in (None, 7):
            where.setdefault(r.key, set()).add(r.shard)
    assert all(len(s) == 1 for k, s in where.items() if k != 3)


def test_odd_rows(spark, odd, odd_rows, none):
    path = shared_dir(spark, "shards")
    sharding.write_shards(odd, 3, path)
    back = spark.read.parquet(path)
    assert back.count() == len(odd_rows) and {"text", "spans", "shard", "slot"} <= set(back.columns)
    checked([r for r in back.withColumn("size", F.length("text")).collect()], 3)
    rows = none.select("doc_id", F.lit(1).cast("long").alias("size"), F.col("doc_id").alias("key"), F.col("doc_id").alias("tie"))
    assert sharding.assign(rows, 8).count() == 0
