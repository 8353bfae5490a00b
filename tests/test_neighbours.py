"""The stored neighbour index against the exact search."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.plans import neighbours, vectors
from tickloom.plans.neighbours import NeighbourIndex


def table(spark, points, ids=None):
    rows = pd.DataFrame({"vec_id": np.arange(len(points)) if ids is None else ids, "vector": [list(map(float, p)) for p in points]})
    return spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(8)


def asked(df, every=50):
    return df.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")


def nine_tenths(spark, points, k=10):
    df = table(spark, points)
    index = NeighbourIndex.build(df)
    q = asked(df)
    exact = vectors.knn_join(q, df, k)
    share = vectors.recall(index.search(q, k), exact).first()["recall"]
    seen = index.candidates(q, k).groupBy("query_id").count().agg(F.max("count")).first()[0]
    return share, seen


def test_recall_without_clusters_and_fewer_candidates_a_vector(spark):
    draw = np.random.default_rng(3)
    share, seen = nine_tenths(spark, draw.normal(size=(3000, 64)))
    more, seen_more = nine_tenths(spark, draw.normal(size=(12000, 64)))
    assert share >= 0.9 and more >= 0.9
    assert seen_more < 2 * seen and seen_more <= 120  # four times the vectors


def test_recall_with_clusters_and_a_third_of_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_BLOCK", 300)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    draw = np.random.default_rng(5)
    points = (draw.normal(size=(40, 64))[draw.integers(0, 40, 3000)] + 0.4 * draw.normal(size=(3000, 64)))
    points[:1000] = points[0]
    df = table(spark, points)
    index = NeighbourIndex.build(df)
    biggest = spark.read.parquet(f"{index.path}/lists").groupBy("cell", "block").count().agg(F.max("count")).first()[0]
    assert biggest < 450
    q = asked(df)
    exact, found = vectors.knn_join(q, df, 10), index.search(q, 10)
    assert vectors.recall(found, exact).first()["recall"] >= 0.9
    copies = found.where("query_id < 1000").toPandas()
    assert (copies["distance"] == 0).all() and set(copies["neighbour_id"]) == set(range(10))


def test_a_loaded_index_gives_the_same_rows(spark, tmp_path):
    df = table(spark, np.random.default_rng(1).normal(size=(800, 10)))
    path = str(tmp_path / "index")
    first = NeighbourIndex.build(df, path).search(asked(df), 5)
    again = NeighbourIndex.load(spark, path).search(asked(df), 5)
    assert first.count() == 16 * 5 and first.exceptAll(again).count() == 0
    exact = {(r["query_id"], r["neighbour_id"]): r["distance"] for r in vectors.knn_join(asked(df), df, 5).collect()}
    for r in again.collect():
        if (r["query_id"], r["neighbour_id"]) in exact:
            assert r["distance"] == pytest.approx(exact[r["query_id"], r["neighbour_id"]], abs=1e-12)


def test_empty_null_and_odd_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, vector array<double>")
    q = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0])], "query_id long, vector array<double>")
    assert NeighbourIndex.build(none).search(q).count() == 0
    odd = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [1.0, None]), (4, [1.0]), (5, [float("inf"), 0.0]), (6, [3.0, 5.0])],
                                "vec_id long, vector array<double>")
    got = [tuple(r) for r in NeighbourIndex.build(odd).search(q, 3).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 0.0, 1), (1, 6, 5.0, 2)]
    assert vectors.knn_approximate(q, none).columns == ["query_id", "neighbour_id", "distance", "rank"]


def test_a_block_of_a_search_needs_little_more_than_its_vectors():
    import tracemalloc

    import pyarrow as pa

    draw = np.random.default_rng(3)
    points = draw.normal(size=(12_000, 8))
    column = pa.chunked_array([pa.array(points.tolist(), pa.list_(pa.float64()))])
    assert (vectors._flat_matrix(column) == points).all()
    for odd in ([[1.0], [1.0, 2.0]], [[1.0], None]):
        with pytest.raises(ValueError):
            vectors._flat_matrix(pa.array(odd, pa.list_(pa.float64())))
    tracemalloc.start()
    found = vectors._nearest(points[:300], np.arange(12_000), points, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6 and all(n[0] == i and d[0] == 0 for i, (n, d) in enumerate(found))
