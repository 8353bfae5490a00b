"""Embedding near duplicates by spherical-cap filters.

A filter is a direction; a vector passes it if their inner product reaches a threshold. Directions come from random
product codes: after a random rotation the space is cut in two halves, each half has the same number of random unit
vectors, and every combination of two is a direction. A vector's inner product with a combination is the sum of two
numbers, so all combinations above the threshold are listed from sorted lists, without looking at the others. One such
code is uneven (a vector near good words of both halves passes many filters, another one none), so there are ``CODES``
of them, each with its own rotation.

Vectors that pass a common filter meet by a join on the filter and are verified by their cosine. ``design`` takes words
and threshold from the number of vectors: more vectors get more and narrower filters, such that a filter holds few of
them, while a pair at the limit always shares MEETINGS filters on average. So the chance to miss one (below one in
thousand at the limit, less above it) does not depend on the size of the input, and candidates per vector stay few.

Equal vectors are one node each, with a count. A dense group of different vectors that are all linked has as many links
as pairs; they are counted, as the number of links is part of the result.
"""
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, read, stage
from tickloom.llm.graph import components

LIMIT = 0.93
#: Common filters of a pair at the limit, on average; vectors per filter; codes; parts of the space in each.
MEETINGS, MEMBERS = 18.0, 4.0
CODES, PARTS = 16, 2
SEED = 42


def _space(dimension):
    """Power of two that holds the vectors; every part has four dimensions at least."""
    return max(4 * PARTS, 1 << (dimension - 1).bit_length())


def _sphere(dimension, n=4001):
    """(x, chance that one coordinate of a random unit vector is above x)."""
    x = np.linspace(-1, 1, n)
    mass = np.maximum(1 - x * x, 0) ** ((dimension - 3) / 2)
    above = np.cumsum(mass[::-1])[::-1] - mass / 2
    return x, above / mass.sum()


@lru_cache(maxsize=64)
def design(count, dimension, limit=LIMIT, meetings=MEETINGS):
    """(code words per part, threshold on the inner product of unit vectors) for ``count`` vectors."""
    space = _space(dimension)
    x, above = _sphere(space)
    inner, rest = _sphere(space - 1)
    mass = -np.diff(above, append=0)
    turn = np.sqrt(np.maximum(1 - limit * limit, 1e-9) * np.maximum(1 - x * x, 1e-12))
    words = 6
    while True:
        low, high = 0.0, 1.0
        for _ in range(50):
            at = (low + high) / 2
            both = np.sum((mass * np.interp((at - limit * x) / turn, inner, rest, 1, 0))[x >= at])
            low, high = (at, high) if CODES * words ** PARTS * both > meetings else (low, at)
        if count * np.interp(low, x, above) <= MEMBERS or words >= 1 << 16:
            return words, low
        words = words + max(1, words // 8)


@lru_cache(maxsize=64)
def _code(dimension, words, number):
    """(signs of the three rotations, unit vectors of each half) of one code."""
    space = _space(dimension)
    rng = np.random.default_rng([SEED, dimension, number])
    signs = rng.integers(0, 2, (3, space)) * 2.0 - 1
    code = rng.standard_normal((PARTS, words, space // PARTS))
    return signs, code / (np.linalg.norm(code, axis=2, keepdims=True) * np.sqrt(PARTS))


def _rotated(x, signs):
    """Rows of ``x`` after three rounds of random signs and a Walsh-Hadamard transform."""
    n = x.shape[1]
    for s in signs:
        x = x * s
        h = 1
        while h < n:
            y = x.reshape(len(x), -1, 2, h)
            x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
            h *= 2
        x = x / np.sqrt(n)
    return x


def unit(rows):
    """Rows scaled to length one, without overflow of squares."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def filters_of(rows, words, threshold):
    """Numbers of the filters that each unit row passes, as a list of arrays."""
    dimension = rows.shape[1]
    wide = np.zeros((len(rows), _space(dimension)))
    wide[:, :dimension] = rows
    owners, numbers = [], []
    for number in range(CODES):
        signs, code = _code(dimension, words, number)
        halves = _rotated(wide, signs).reshape(len(rows), PARTS, -1)
        left, right = halves[:, 0] @ code[0].T, halves[:, 1] @ code[1].T
        order = np.argsort(-right, axis=1, kind="stable")
        right = np.take_along_axis(right, order, axis=1)
        row, a = np.nonzero(left + right[:, :1] >= threshold)
        for rank in range(words):
            still = left[row, a] + right[row, rank] >= threshold
            row, a = row[still], a[still]
            if not len(row):
                break
            owners.append(row)
            numbers.append((number * words + a) * words + order[row, rank])
    owner, found = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, numbers))
    by_row = np.argsort(owner, kind="stable")
    return np.split(found[by_row], np.searchsorted(owner[by_row], np.arange(1, len(rows))))


def _matrix(column):
    """{dimension: (row numbers, matrix)} of an Arrow list column."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, start = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(lengths) - lengths
    out = {}
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        out[int(d)] = rows, flat[start[rows, None] + np.arange(d)]
    return out


def _passed(nodes, designs):
    """(label, filter, node) for every filter that a node's vector passes; the dimension is part of the label."""
    def run(batch):
        out = [None] * batch.num_rows
        for d, (rows, matrix) in _matrix(batch.column("vector")).items():
            for r, f in zip(rows, filters_of(unit(matrix), *designs[d])):
                out[r] = f
        return [pa.array(out, pa.list_(pa.int64()))]

    rows = append(nodes, run, [T.StructField("filters", T.ArrayType(T.LongType()))], ["label", "d", "node"])
    return rows.select("label", "d", "node", F.explode("filters").alias("filter"))


def _close(pairs, limit):
    """The (a, b) of ``pairs`` whose vectors reach the limit."""
    def run(batch):
        out = np.zeros(batch.num_rows, bool)
        right = _matrix(batch.column("w"))
        for d, (rows, left) in _matrix(batch.column("v")).items():
            out[rows] = np.einsum("rd,rd->r", unit(left), unit(right[d][1])) >= limit
        return [pa.array(out)]

    return append(pairs, run, [T.StructField("near", T.BooleanType())], ["a", "b"]).where("near").select("a", "b")


def nodes_of(rows, vector, label):
    """Different vectors per label: (label, k1, k2, d, node, n, low, vector), stored."""
    held = rows.where(F.col("__ok")).groupBy(label, "__k1", "__k2").agg(
        F.count(F.lit(1)).alias("n"), F.min("__id").alias("low"), F.first(vector).alias("vector"))
    held = held.withColumnRenamed(label, "label").withColumn("d", F.size("vector")).withColumn("node", F.monotonically_increasing_id())
    return stage(held, "vectors")


def links(nodes, limit=LIMIT):
    """Stored (a, b), a < b: nodes of a label and dimension whose cosine reaches ``limit``."""
    sizes = nodes.groupBy("d", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("d").agg(F.max("n").alias("n")).collect()
    # one row per dimension that occurs: a table of embeddings has one or a few
    designs = {r.d: design(1 << (r.n - 1).bit_length(), r.d, limit) for r in sizes}
    passed = stage(_passed(nodes, designs), "filters")
    other = passed.withColumnRenamed("node", "b")
    met = passed.withColumnRenamed("node", "a").join(other, ["label", "d", "filter"]).where("a < b")
    met = met.select("a", "b").distinct()
    vectors = nodes.select("node", "vector")
    both = met.join(vectors.select(F.col("node").alias("a"), F.col("vector").alias("v")), "a")
    both = both.join(vectors.select(F.col("node").alias("b"), F.col("vector").alias("w")), "b")
    return stage(_close(both, limit), "links")


def near_duplicates(df, vector="embedding", label="label", vec_id="vec_id", limit=LIMIT, keep=None):
    """``df[keep]`` with n_links, component_id and kept, comparing vectors of equal labels.

    ``n_links`` counts the other rows within the limit, equal vectors among them; ``component_id`` is the smallest id
    reachable over links, itself included; ``kept`` says whether it is the row's own id. Rows that link with nothing: a
    null label, and a vector that is null, empty, zero or holds a null or non-finite component. Vectors of different
    length are not compared. Null ids are never smallest, a row without links keeps its own id, null or not; rows that
    repeat an id are vectors of their own. Columns of ``df`` with the names of results are replaced.
    """
    keep = [c for c in (keep or df.columns) if c.lower() not in ("n_links", "component_id", "kept")]
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(v, lambda x: x == 0)
    marked = df.withColumns({
        "__id": F.col(vec_id), "__label": F.col(label), "__ok": F.coalesce(~bad & ~zero & F.col(label).isNotNull(), F.lit(False)),
        "__k1": F.xxhash64(v), "__k2": F.xxhash64(F.lit(1), v)})
    nodes = nodes_of(marked.withColumn("__v", v).select("__id", "__label", "__ok", "__k1", "__k2", "__v"), "__v", "__label")
    near = links(nodes, limit)
    sizes = nodes.select("node", "n")
    ways = near.union(near.select("b", "a")).toDF("node", "other")
    more = ways.join(sizes.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.sum("n").alias("more"))
    tops = components(near)
    named = nodes.select("node", "label", "__k1", "__k2", "n", "low").join(more, "node", "left").join(tops, "node", "left")
    named = stage(named.withColumn("root", F.coalesce("root", "node")), "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("lowest"))
    named = named.join(lowest, "root").select(
        F.col("label").alias("__l"), F.col("__k1").alias("__h1"), F.col("__k2").alias("__h2"),
        (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("__links"), F.col("lowest").alias("__lowest"))
    same = F.col("__ok") & (F.col("__label") == F.col("__l")) & (F.col("__k1") == F.col("__h1")) & (F.col("__k2") == F.col("__h2"))
    # only what differs from "alone" is looked up
    out = marked.select(*keep, "__id", "__label", "__ok", "__k1", "__k2").join(named.where("__links > 0"), same, "left")
    component = F.when(F.col("__links").isNull(), F.col("__id")).otherwise(F.col("__lowest"))
    return out.withColumn("component_id", component).select(
        *keep, F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"))


def op12_embedding_duplicates(spark, sf_dir):
    """Links, component and verdict of every embedding."""
    return near_duplicates(read(spark, sf_dir, "embeddings"), keep=["vec_id"])


OP12_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
ok AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM v WHERE label IS NOT NULL AND len(e) > 0
AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
WHERE list_dot_product(a.e, b.e) >= {LIMIT} * a.size * b.size),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id)) AS component_id,
vec_id <= coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id) AS kept FROM embeddings"""
