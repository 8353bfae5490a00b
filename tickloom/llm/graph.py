"""Connected components of an undirected graph of long identifiers."""
from pyspark.sql import functions as F

from tickloom.llm.common import stage


def _size(edges):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1000003)).first()


def components(edges, a="a", b="b"):
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    Alternates two steps until nothing moves: every node hands its larger neighbours to its smallest
    neighbour, then its smaller ones. Each round is a few aggregations and joins over the edges, written to
    the shared folder; a hub's rows are split by the adaptive skew join.
    """
    left, right = F.col(a), F.col(b)
    e = edges.where(left != right).select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct()
    e = stage(e, "edges")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct()
        e = stage(e, "edges")
        now = _size(e)
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
