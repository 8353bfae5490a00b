"""As-of, range, interval and neighbour joins against brute force, with a hot key."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.asof import asof_join
from tickloom.operators.collect import collect_items, item_rows
from tickloom.operators.rangejoin import interval_join, range_join
from tickloom.plans import vectors
from tickloom.streaming import cycles


def times(rng, n, days=6):
    return pd.Timestamp("2024-03-01") + pd.to_timedelta(rng.integers(0, days * 86400, n), unit="s")


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(11)
    keys = np.where(rng.random(900) < 0.6, "HOT", rng.choice(["a", "b", "c"], 900))
    left = pd.DataFrame({"k": keys, "at": times(rng, 900), "id": range(900)})
    right = pd.DataFrame({"k": np.where(rng.random(700) < 0.6, "HOT", rng.choice(["a", "b", "z"], 700)),
                          "ts": times(rng, 700), "x": range(700)})
    return left, right, spark.createDataFrame(left), spark.createDataFrame(right)


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof(sides, direction):
    left, right, l, r = sides
    got = asof_join(l, r, ["k"], "at", "ts", ["x"], tie="x", direction=direction, width=3600).toPandas().set_index("id")["x"]
    for row in left.itertuples():
        c = right[right.k == row.k]
        c = c[c.ts <= row.at] if direction == "backward" else c[c.ts > row.at]
        if c.empty:
            assert pd.isna(got[row.id])
        else:
            c = c.sort_values(["ts", "x"])
            edge = c.ts.iloc[-1] if direction == "backward" else c.ts.iloc[0]
            best = c[c.ts == edge].x
            assert got[row.id] in set(best)


def test_range_join(sides):
    left, right, l, r = sides
    got = set(map(tuple, range_join(l, r, ["k"], "at", "ts", -7200, 0).select("id", "x").collect()))
    m = left.merge(right, on="k")
    gap = (m.ts - m["at"]).dt.total_seconds()
    assert got == set(zip(m.id[(gap > -7200) & (gap <= 0)], m.x[(gap > -7200) & (gap <= 0)]))


def test_interval_join(spark, sides):
    left, right, l, _ = sides
    iv = right.assign(end=right.ts + pd.to_timedelta((right.x * 977) % 300000, unit="s"))
    iv.loc[iv.x % 9 == 0, "end"] = pd.NaT
    r = spark.createDataFrame(iv)
    got = interval_join(l, r, ["k"], "at", "ts", "end").select("id", "x").collect()
    m = left.merge(iv, on="k")
    ok = (m.ts <= m["at"]) & (m.end.isna() | (m.end > m["at"]))
    assert len(got) == ok.sum() and set(map(tuple, got)) == set(zip(m.id[ok], m.x[ok]))


def test_one_list_per_key_at_any_size(spark, sides):
    _, right, _, r = sides
    rows = collect_items(r, ["k"], F.col("x"), ["ts", "x"]).toPandas()
    assert rows["k"].is_unique and sorted(x for items in rows["items"] for x in items) == list(range(700))
    order = right.sort_values(["ts", "x"]).groupby("k")["x"].apply(list).to_dict()
    assert {k: list(v) for k, v in zip(rows["k"], rows["items"])} == order
    flat = item_rows(r, ["k"], F.col("x"), ["ts", "x"]).toPandas().sort_values(["k", "position"])
    assert flat.groupby("k")["item"].apply(list).to_dict() == order
    many = collect_items(spark.range(12_000).withColumn("k", F.lit(1)), ["k"], F.col("id"), ["id"]).collect()
    assert len(many) == 1 and many[0]["items"] == list(range(12_000))


def test_knn_join_exact_with_copies(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 6))
    x[80:180] = x[0]  # more than a third are copies of one vector
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, vector array<double>")
    q = df.select(F.col("vec_id").alias("query_id"), "vector")
    got = vectors.knn_join(q, df, 4, exclude_self=True, block=15).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(len(x)):
        order = sorted((d[i, j], j) for j in range(len(x)) if j != i)[:4]
        mine = got[got.query_id == i].sort_values("rank")
        assert mine.neighbour_id.tolist() == [j for _, j in order]
    few = vectors.knn_search(q.where("query_id < 3"), df, 3).toPandas()
    assert len(few) == 9
    monkeypatch.setattr(vectors, "MAX_SENT", 12)  # more queries than may be sent are refused
    with pytest.raises(ValueError):
        vectors.knn_search(q, df, 3)
    found = vectors.recall(vectors.knn_approximate(q, df, 4, cells=8, probes=8), vectors.knn_join(q, df, 4))
    assert found.first()["recall"] == 1.0
