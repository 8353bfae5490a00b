"""A stored index for approximate nearest neighbours: inverted lists of quantized codes, exact re-ranking.

About sqrt(n) cells are fitted on a bounded sample. Every vector is listed in the ``SPILLS`` cells nearest to it, as a
code of one byte per part of the vector (the number of the nearest of 256 centres of that part). A query looks into about
2 sqrt(cells) cells, ranks the codes there by the sum of its distances to the parts' centres, and computes exact
distances for the best sqrt(n) of them only. So the codes a query sees grow with n^(3/4), the vectors with n^(1/2).
The index is a folder: it outlives the session that built it and serves any number of searches.
"""
import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.session import materialize, shared_dir

#: Cells a vector is listed in, bytes of a code, centres per part.
SPILLS, PARTS, CENTRES = 5, 16, 256
#: Cells at most; their centres travel to every task (34 MB at 64 numbers a vector).
MAX_CELLS = 65_536
#: Vectors that code books are fitted on, about; cells are fitted on 16 a cell if that is more.
SAMPLE = 20_000
#: Codes and queries in one group of a search at most, about.
LIST_BLOCK, QUERY_BLOCK = 50_000, 2_000


def _matrix(column):
    return np.array(column.tolist(), dtype="float64").reshape(len(column), -1)


def _distances(points, centres):
    """Squared distances less the constant of each point."""
    return (centres ** 2).sum(axis=1)[None] - 2 * points @ centres.T


def _slices(width):
    return [s for s in np.array_split(np.arange(width), min(PARTS, width)) if len(s)]


def _usable(df, width):
    """Rows whose vector has ``width`` finite numbers; the others are neighbours of nothing."""
    fine = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col("vector").isNotNull() & (F.size("vector") == width) & fine)


def _sampled(vectors, n, wanted):
    """About ``wanted`` rows, chosen by a hash of the id."""
    if n <= wanted:
        return vectors
    return vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int((1 << 40) * wanted / n))


def _fit_cells(sample, cells, width):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    if cells == 1:
        return np.zeros((1, width))
    model = KMeans(k=cells, seed=7, maxIter=10).fit(sample.select(array_to_vector("vector").alias("features")))
    return np.array(model.clusterCenters())


def _fit_books(sample, width):
    """The centres of every part of the vectors, one task a part."""
    slices = _slices(width)
    parts = F.array(*[F.slice("vector", int(s[0]) + 1, len(s)) for s in slices])
    rows = sample.select(F.posexplode(parts).alias("part", "piece"))

    def fit(pdf):
        points = np.unique(_matrix(pdf["piece"]), axis=0)
        draw = np.random.default_rng(7)
        centres = points[draw.choice(len(points), min(CENTRES, len(points)), replace=False)].copy()
        for _ in range(12 if len(points) > CENTRES else 0):
            near = _distances(points, centres).argmin(axis=1)
            counts = np.bincount(near, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        return pd.DataFrame({"part": pdf["part"].iloc[0], "number": np.arange(len(centres), dtype="int32"), "vector": centres.tolist()})

    return rows.groupBy("part").applyInPandas(fit, "part int, number int, vector array<double>")


def _cells_of(centres, how_many, schema, books=None):
    """Per batch: each row once per cell among the nearest, with its code if code books are given."""
    how_many = min(how_many, len(centres))
    step = max(1, 4_000_000 // len(centres))

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), step):
                some = batch.iloc[at:at + step]
                points = _matrix(some["vector"])
                far = _distances(points, centres)
                near = np.argpartition(far, how_many - 1, axis=1)[:, :how_many] if how_many < len(centres) else \
                    np.broadcast_to(np.arange(how_many), (len(some), how_many))
                out = {some.columns[0]: np.repeat(some[some.columns[0]].to_numpy(), how_many), "cell": near.ravel().astype("int32")}
                if books is None:
                    out["vector"] = list(np.repeat(points, how_many, axis=0))
                else:
                    code = np.stack([_distances(points[:, s], b).argmin(axis=1).astype("uint8")
                                     for s, b in zip(_slices(points.shape[1]), books)], axis=1)
                    out["code"] = [c.tobytes() for c in np.repeat(code, how_many, axis=0)]
                yield pd.DataFrame(out)

    return run, schema


class NeighbourIndex:
    """Index over vectors (vec_id, vector): ``build`` or ``load`` one, then ``search``.

    Ids should be unique. Vectors that are null, hold null or non-finite numbers or have another width than the longest one are
    not indexed; as queries they find nothing. Equal distances come by ascending id.
    A cell may hold any share of all rows: its list is cut into blocks, and so are the queries that look into it.
    """

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        rows = spark.read.parquet(f"{path}/model").collect()
        by = lambda part: np.array([r["vector"] for r in sorted((r for r in rows if r["part"] == part), key=lambda r: r["number"])])
        self.centres = by(-1)
        self.books = [by(p) for p in sorted({r["part"] for r in rows if r["part"] >= 0})]
        self.width = self.centres.shape[1] if len(self.centres) else 0
        self.size = next(r["number"] for r in rows if r["part"] == -2)

    @classmethod
    def load(cls, spark, path):
        return cls(spark, path)

    @classmethod
    def build(cls, vectors, path=None, cells=None, spills=SPILLS):
        """Write an index to ``path`` (default: a new folder in the shared one). Cells and code books are fitted on a sample; every
        vector is indexed."""
        spark = vectors.sparkSession
        path = path or shared_dir(spark, "index")
        width = vectors.select(F.max(F.size("vector"))).first()[0] or 0
        _usable(vectors.select("vec_id", F.col("vector").cast("array<double>").alias("vector")), width).write.parquet(f"{path}/vectors")
        stored = spark.read.parquet(f"{path}/vectors")
        n = stored.count()
        cells = max(1, min(cells or max(4, int(n ** 0.5)), MAX_CELLS, n))
        if n:
            sample = materialize(_sampled(stored, n, max(SAMPLE, 16 * cells)), "sample")
            centres = _fit_cells(sample, cells, width)
            books = _fit_books(_sampled(sample, max(SAMPLE, 16 * cells), SAMPLE), width)
        else:
            centres, books = np.zeros((0, 0)), spark.createDataFrame([], "part int, number int, vector array<double>")
        fitted = [(-1, i, c.tolist()) for i, c in enumerate(centres)] + [(-2, n, None)]
        books.unionByName(spark.createDataFrame(fitted, "part int, number long, vector array<double>")).write.parquet(f"{path}/model")
        index = cls(spark, path)
        index._write_lists(stored, spills)
        return index

    def _write_lists(self, stored, spills):
        schema = "vec_id long, cell int, code binary"
        if not self.size:
            self.spark.createDataFrame([], f"{schema}, block int").write.parquet(f"{self.path}/lists")
            self.spark.createDataFrame([], "cell int, blocks int").write.parquet(f"{self.path}/cells")
            return
        listed = materialize(stored.mapInPandas(*_cells_of(self.centres, spills, schema, self.books)), "listed")
        blocks = listed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / LIST_BLOCK).cast("int").alias("blocks"))
        blocks.write.parquet(f"{self.path}/cells")
        cut = listed.join(self._blocks(), "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).drop("blocks")
        cut.repartition("cell", "block").sortWithinPartitions("cell", "block").write.parquet(f"{self.path}/lists")

    def _blocks(self):
        """Blocks of every cell: at most ``MAX_CELLS`` rows, so small enough to send."""
        return F.broadcast(self.spark.read.parquet(f"{self.path}/cells"))

    def candidates(self, queries, k=5, probes=None, wanted=None):
        """(query_id, vec_id) of the vectors whose exact distance a search computes."""
        wanted = wanted or max(8 * k, int(self.size ** 0.5))
        probes = probes or int(np.ceil(2 * len(self.centres) ** 0.5))
        asked = _usable(queries.select("query_id", F.col("vector").cast("array<double>").alias("vector")), self.width)
        asked = materialize(asked.mapInPandas(*_cells_of(self.centres, probes, "query_id long, cell int, vector array<double>")), "asked")
        turns = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("turns"))
        turns = F.broadcast(materialize(turns, "turns"))  # at most one row a cell
        asked = (asked.join(turns, "cell").withColumn("turn", F.pmod(F.xxhash64("query_id"), "turns").cast("int"))
                 .join(self._blocks(), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        lists = (self.spark.read.parquet(f"{self.path}/lists").join(turns, "cell")
                 .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))))
        books = self.books

        def rank(q, x):
            if not len(q) or not len(x):
                return pd.DataFrame({"query_id": np.zeros(0, "int64"), "vec_id": np.zeros(0, "int64"), "rough": np.zeros(0)})
            ids = x["vec_id"].to_numpy()
            codes = np.frombuffer(b"".join(x["code"]), dtype="uint8").reshape(len(x), -1).T
            points = _matrix(q["vector"])
            slices = _slices(points.shape[1])
            found = []
            for point in points:
                rough = np.zeros(len(ids))
                for s, book, code in zip(slices, books, codes):
                    rough += ((book - point[s]) ** 2).sum(axis=1)[code]
                best = np.arange(len(ids))
                if len(ids) > wanted:
                    best = np.flatnonzero(rough <= np.partition(rough, wanted - 1)[wanted - 1])
                found.append(best[np.lexsort((ids[best], rough[best]))][:wanted])
                found[-1] = (ids[found[-1]], rough[found[-1]])
            return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), [len(v) for v, _ in found]),
                                 "vec_id": np.concatenate([v for v, _ in found]), "rough": np.concatenate([d for _, d in found])})

        keys = ["cell", "block", "turn"]
        rough = asked.select("query_id", "vector", *keys).groupBy(*keys).cogroup(lists.select("vec_id", "code", *keys).groupBy(*keys))
        rows = rough.applyInPandas(rank, "query_id long, vec_id long, rough double")
        w = Window.partitionBy("query_id").orderBy("rough", "vec_id")  # a vector listed in several cells has one rank
        return rows.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= wanted).select("query_id", "vec_id").distinct()

    def search(self, queries, k=5, probes=None, candidates=None):
        """k nearest indexed vectors of every query (query_id, vector): query_id, neighbour_id, distance, rank."""
        schema = "query_id long, neighbour_id long, distance double, rank int"
        if not self.size:
            return self.spark.createDataFrame([], schema)
        pairs = self.candidates(queries, k, probes, candidates)
        x = self.spark.read.parquet(f"{self.path}/vectors").withColumnRenamed("vector", "_x")
        q = queries.select("query_id", F.col("vector").cast("array<double>").alias("_q"))
        square = F.aggregate(F.zip_with("_q", "_x", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e)
        near = pairs.join(x, "vec_id").join(q, "query_id").select(
            F.col("query_id").cast("long").alias("query_id"), F.col("vec_id").alias("neighbour_id"), F.sqrt(square).alias("distance"))
        w = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
        return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
