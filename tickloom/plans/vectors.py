"""Snapshot vectors and nearest-neighbour search."""
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import DOCUMENT_TIMEFRAMES, PATTERN_LIMITS
from tickloom.functions.scalar import pearson
from tickloom.operators import outcome
from tickloom.operators.asof import context_at
from tickloom.operators.sequence import literal_map
from tickloom.plans.neighbours import NeighbourIndex

CLIP = 4.0
PRICES = ("open", "high", "low", "close")


def _fields(features):
    named = {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}
    cols = dict.fromkeys([*features, "close", "atr"])
    return [F.col(named.get(c, c)).cast("double").alias(c) for c in cols]


def _normalise(value, feature, mode):
    """One value of a candle made comparable across symbols and volatility levels.
    ``_last`` is the newest candle of the row, ``_stats`` its means and deviations."""
    last = F.col("_last")
    if mode == "pct":
        base = last["close"] if feature in PRICES else last[feature]
        return (F.try_divide(value, base) - 1) * 100
    if mode == "atr":
        return F.try_divide(value - last["close"], last["atr"]) if feature in PRICES else value
    return F.try_divide(value - F.col("_stats")[f"{feature}_mean"], F.col("_stats")[f"{feature}_std"])


def _window_stats(features):
    """Mean and population deviation of each feature over the non-null candles of a row."""
    out = []
    for f in features:
        known = F.filter(F.transform("candles", lambda c: c[f]), lambda x: x.isNotNull())
        pair = F.aggregate(known, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
                           lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + x * x).alias("q")))
        n = F.size(known)
        mean = F.try_divide(pair["s"], n)
        out += [mean.alias(f"{f}_mean"), F.sqrt(F.greatest(F.try_divide(pair["q"], n) - mean * mean, F.lit(0.0))).alias(f"{f}_std")]
    return F.struct(*out)


def _clipped(x):
    return F.coalesce(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.nanvl(x, F.lit(0.0)))), F.lit(0.0))


def snapshot_vectors(points, bars, features=("close",), mode="pct", limits=PATTERN_LIMITS, visible="open"):
    """Fixed-length vector of every (symbol, at): timeframe, then candle, then feature.

    Values are normalised, clipped to [-4, 4], missing ones become 0 afterwards, and each
    timeframe is padded on the left to its limit, so the length is constant.
    """
    rows = context_at(points, bars, _fields(features), limits, visible)
    rows = rows.withColumn("_last", F.try_element_at("candles", F.lit(-1)))
    if mode == "zscore":
        rows = rows.withColumn("_stats", _window_stats(features))
    values = F.flatten(F.transform("candles", lambda c: F.array(*[_clipped(_normalise(c[f], f, mode)) for f in features])))
    values = F.coalesce(values, F.array().cast("array<double>"))
    size = literal_map({t: n * len(features) for t, n in limits.items()})[F.col("timeframe")]
    padded = F.concat(F.array_repeat(F.lit(0.0), (size - F.size("_v")).cast("int")), F.col("_v"))
    order = literal_map({t: i for i, t in enumerate(DOCUMENT_TIMEFRAMES)})[F.col("timeframe")]
    parts = rows.withColumn("_v", values).select("symbol", "at", F.struct(order.alias("o"), padded.alias("v")).alias("_p"))
    return parts.groupBy("symbol", "at").agg(F.sort_array(F.collect_list("_p")).alias("_ps")).select(
        "symbol", "at", F.flatten(F.transform("_ps", lambda p: p["v"])).alias("vector"))


def vector_length(features=("close",), limits=PATTERN_LIMITS):
    return sum(limits.values()) * len(features)


def check_vectors(vectors, expected, length):
    """Counts of wrong lengths and of NaN / null entries, and the rows missing against ``expected``."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x))
    found = vectors.agg(F.count(F.lit(1)).alias("vectors"), F.count_if(F.size("vector") != length).alias("wrong_length"),
                        F.count_if(bad).alias("with_nan"))
    return found.withColumn("missing", expected.agg(F.count(F.lit(1))).scalar() - F.col("vectors"))


def label_vectors(vectors, m1):
    """Vectors with the one-hour outcome of their time."""
    gain, loss = outcome.gain_loss()
    later = outcome.forward_stats(m1).select("symbol", F.col("open_time").alias("at"), gain.alias("max_gain_pct_1h"),
                                             loss.alias("max_loss_pct_1h"), F.col("fwd_bars").alias("later_bars"))
    return vectors.join(later, ["symbol", "at"], "left")


def vectorization_ready(docs):
    """Do all candles share one schema (given by the column type) and hold prices, and does
    every indicator map cover all six timeframes?"""
    candles_ok = F.forall(F.map_values("context"), lambda cs: F.forall(
        cs, lambda c: c["open"].isNotNull() & c["high"].isNotNull() & c["low"].isNotNull() & c["close"].isNotNull()))
    wanted = F.array(*[F.lit(t) for t in DOCUMENT_TIMEFRAMES])
    maps_ok = F.forall(F.map_values("indicators"), lambda m: F.size(F.array_except(wanted, F.map_keys(m))) == 0)
    return docs.select("symbol", "at", candles_ok.alias("candles_ok"), maps_ok.alias("indicators_ok"))


# --- nearest neighbours ------------------------------------------------------------

RESULT = "query_id long, neighbour_id long, distance double"
#: Vectors in one block of a search.
BLOCK = 20_000
#: Queries that one matrix product takes.
STEP = 64
#: Numbers (queries times width) that ``knn_search`` sends to every task at most.
MAX_SENT = 4_000_000


def _matrix(column):
    return np.array(column.tolist(), dtype="float64").reshape(len(column), -1)


def _flat_matrix(column):
    """A column of equally long Arrow lists as a matrix, without an object per list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = pc.unique(column.value_lengths()).to_pylist()
    if len(width) > 1 or None in width:
        raise ValueError("vectors must all have the same number of numbers")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(queries, ids, matrix, k):
    """Per query the k smallest (distance, id): a matrix product finds the candidates, exact distances rank them."""
    norms = np.einsum("ij,ij->i", matrix, matrix)
    found = []
    for at in range(0, len(queries), STEP):
        some = queries[at:at + STEP]
        rough = some @ matrix.T
        rough *= -2
        rough += norms[None]
        rough += (some ** 2).sum(axis=1)[:, None]
        scale = 1e-9 * (1 + norms.max())
        for row, q in zip(rough, some):
            near = np.arange(len(ids)) if len(ids) <= k else np.flatnonzero(row <= np.partition(row, k - 1)[k - 1] + scale)
            exact = np.sqrt(((matrix[near] - q) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], exact))[:k]
            found.append((ids[near][best], exact[best]))
    return found


def _ranked(rows, k):
    w = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _rows(query_ids, found):
    if not found:
        return pd.DataFrame({"query_id": np.zeros(0, "int64"), "neighbour_id": np.zeros(0, "int64"), "distance": np.zeros(0)})
    return pd.DataFrame({"query_id": np.repeat(query_ids, [len(n) for n, _ in found]),
                         "neighbour_id": np.concatenate([n for n, _ in found]), "distance": np.concatenate([d for _, d in found])})


def knn_search(queries, vectors, k=5):
    """k nearest vectors of a few query vectors (query_id, vector): the live search.

    The queries are read once and travel to every task, which keeps k rows per query. More than
    ``MAX_SENT`` numbers are refused: ``knn_join`` and ``knn_approximate`` take any number of queries.
    """
    width = queries.select(F.max(F.size("vector"))).first()[0] or 1
    some = queries.select("query_id", "vector").limit(MAX_SENT // width + 1).collect()
    if len(some) * width > MAX_SENT:
        raise ValueError("too many queries for a search that sends them to every task")
    ids = np.array([q[0] for q in some], dtype="int64")
    points = np.array([q[1] for q in some], dtype="float64").reshape(len(some), -1)

    def scan(batches):
        kept = [(np.zeros(0, "int64"), np.zeros(0))] * len(ids)
        for batch in batches:
            if len(batch) and len(ids):
                new = _nearest(points, batch["vec_id"].to_numpy(), _matrix(batch["vector"]), k)
                for i, ((n, d), (n2, d2)) in enumerate(zip(kept, new)):
                    n, d = np.r_[n, n2], np.r_[d, d2]
                    best = np.lexsort((n, d))[:k]
                    kept[i] = (n[best], d[best])
        yield _rows(ids, kept)

    return _ranked(vectors.select("vec_id", "vector").mapInPandas(scan, RESULT), k)


def _search_blocks(asked, stored, keys, k):
    """k best of every query within each group of ``keys`` that holds queries and vectors."""
    both = asked.select(*keys, F.lit(True).alias("asks"), F.col("query_id").alias("id"), "vector").unionByName(
        stored.select(*keys, F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "vector"))

    def search(table):
        q, x = table.filter(table["asks"]), table.filter(pc.invert(table["asks"]))
        out = _rows([], [])
        if len(q) and len(x):
            out = _rows(q["id"].to_numpy(), _nearest(_flat_matrix(q["vector"]), x["id"].to_numpy(), _flat_matrix(x["vector"]), k))
        return pa.Table.from_pandas(out[[f.split()[0] for f in RESULT.split(", ")]], preserve_index=False)

    return both.groupBy(*keys).applyInArrow(search, RESULT)


def _dealt(df, name, key, n):
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def _copies(df, name, n):
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def knn_join(queries, vectors, k=5, exclude_self=False, block=BLOCK):
    """Exact k nearest vectors of every query: each block of queries meets each block of vectors.

    The work is queries times vectors, whatever the data (in many dimensions no exact index avoids that);
    a pair of blocks is one matrix product and returns k rows a query, never its pairs. For more than
    some millions of both use ``knn_approximate``.
    """
    kk = k + 1 if exclude_self else k
    q_blocks, v_blocks = max(1, -(-queries.count() // block)), max(1, -(-vectors.count() // block))
    asked = _copies(_dealt(queries.select("query_id", "vector"), "qb", "query_id", q_blocks), "vb", v_blocks)
    stored = _copies(_dealt(vectors.select("vec_id", "vector"), "vb", "vec_id", v_blocks), "qb", q_blocks)
    found = _search_blocks(asked, stored, ["qb", "vb"], kk)
    if exclude_self:
        found = found.where(F.col("neighbour_id") != F.col("query_id"))
    return _ranked(found, k)


def knn_approximate(queries, vectors, k=5, cells=None, probes=None):
    """k nearest vectors of every query by an index built for this call (see ``NeighbourIndex``); may miss some."""
    return NeighbourIndex.build(vectors, cells=cells).search(queries, k, probes)


def recall(found, exact):
    """Share of the exact neighbours (query_id, neighbour_id) that were found: one row."""
    hit = found.select("query_id", "neighbour_id").withColumn("_hit", F.lit(1))
    both = exact.select("query_id", "neighbour_id").join(hit, ["query_id", "neighbour_id"], "left")
    return both.agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"),
                    (F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def knn_regression(neighbours, labels):
    """Distance-weighted mean label; neighbours at distance 0 decide alone."""
    rows = neighbours.join(labels.select(F.col("vec_id").alias("neighbour_id"), F.col("label").cast("double").alias("_y")), "neighbour_id")
    zero = F.col("distance") == 0
    weight = F.when(~zero, 1.0 / F.when(~zero, F.col("distance")))
    agg = rows.groupBy("query_id").agg(F.avg(F.when(zero, F.col("_y"))).alias("_exact"),
                                       F.sum(weight * F.col("_y")).alias("_s"), F.sum(weight).alias("_w"))
    return agg.select("query_id", F.coalesce("_exact", F.try_divide("_s", "_w")).alias("prediction"))


def similarity_outcome(neighbours, labels):
    """Correlation of similarity 1 / (1 + distance) with agreement of outcomes."""
    a = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("_a"))
    b = labels.select(F.col("vec_id").alias("neighbour_id"), F.col("label").alias("_b"))
    rows = neighbours.join(a, "query_id").join(b, "neighbour_id")
    return rows.agg(F.count(F.lit(1)).alias("pairs"),
                    pearson(1.0 / (1.0 + F.col("distance")), -F.abs(F.col("_a") - F.col("_b"))).alias("correlation"))
