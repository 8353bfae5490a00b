"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The search is exact (up to equal 64-bit hashes of shingles) and goes in three steps, each on fewer texts.

* A text of n shingles with a near copy shares at least 0.8 n of them, so at most n // 5 occur nowhere else. Of all
  shingles whose hash lies below a fixed bound (``SHARE`` of the hashes) it is found out which are in several texts:
  each batch of a task sends a shingle once, so a passage that a third of all texts hold is a row per batch. Texts with
  more than n // 5 single ones among those are done.
* The rest have all their shingles counted and ordered by that count, rarest first. The first n // 5 + 1 are the
  prefix: near copies have a common shingle in both prefixes, and after the first one enough shingles must remain on
  both sides. A passage that many unlike texts hold is not rare and hence in no prefix.
* Texts that meet in a prefix shingle are verified on their sets of shingles, not on their texts. Of few texts all pairs are
  looked at; many are compared first with the one that has fewest rarer shingles (the text that the others were made
  from, as a rule), and links drawn together, as texts of one component need no look any more. What then still meets with different components is compared in pairs that pass the filters.
"""
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import ROWS, append, content_key, discard, give_back, small, stage
from tickloom.llm.graph import components

WIDTH = 5
#: Similarity 4/5: sets of sizes m and n with c in common reach it if 9 c >= 4 (m + n).
SHARE = 0.3
#: Texts that meet in a shingle of which all pairs are looked at; rounds of one text against the others before all are.
FEW, ROUNDS = 6, 2
SEED = 42
_BOUND = np.uint64(int(SHARE * 2 ** 64))


def shingle_hashes(raw, width):
    """Hashes of the shingles of ``width`` words, repeats included, of UTF-8 bytes: ASCII-lower-cased words.

    A text of fewer words has one shingle, a text without words none.
    """
    words = raw.lower().split()
    n = len(words) - width + 1
    if not words:
        return np.zeros(0, np.uint64)
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[width - 1:] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.array([digest(joined[i:j], seed) for i, j in zip(starts, stops)], np.uint64)


def _slices(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            b = whole.slice(at, ROWS)
            raw = b.column("t").cast(pa.binary()).to_pylist()
            yield b.column("node").to_numpy(), [np.unique(shingle_hashes(x or b"", WIDTH)) for x in raw]
            del b, raw
        del whole
        give_back()


def _sample_rows(texts):
    """The shingles below the bound, once per batch: (h, node, several, part, m, size, here). Every text adds a row
    that has m, the number of its shingles, ``size``, those below the bound, and ``here``, those that another text of
    its batch holds too; its ``h`` is any number."""
    def run(batches):
        for k, (nodes, sets) in enumerate(_slices(batches)):
            low = [s[:np.searchsorted(s, _BOUND)] for s in sets]
            size = np.array([len(x) for x in low], np.int64)
            who = np.repeat(np.arange(len(low)), size)
            h = np.concatenate(low).view(np.int64) if low else np.zeros(0, np.int64)
            order = np.lexsort((nodes[who], h))
            h, who = h[order], who[order]
            head = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
            count = np.diff(head, append=len(h))
            several = nodes[who[head]] != nodes[who[head + count - 1]]
            here = np.bincount(who[np.repeat(several, count)], minlength=len(low))
            part = (TaskContext.get().partitionId() << 32) + k
            n, t = len(head), len(low)
            none = np.ones(n, bool)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((h[head], nodes))),
                pa.array(np.concatenate((nodes[who[head]], nodes)), mask=np.concatenate((several, np.zeros(t, bool)))),
                pa.array(np.concatenate((several, np.zeros(t, bool)))), pa.array(np.full(n + t, part)),
                *[pa.array(np.concatenate((np.zeros(n, np.int64), x)), pa.int64(), mask=np.concatenate((none, np.zeros(t, bool))))
                  for x in (np.array([len(s) for s in sets], np.int64), size, here)]], names=["h", "node", "several", "part", "m", "size", "here"])

    return texts.mapInArrow(run, "h long, node long, several boolean, part long, m long, size long, here long")


def _possible(texts):
    """The nodes that can have a near copy: not too many single shingles below the bound."""
    w = Window.partitionBy("h")
    rows = _sample_rows(texts).withColumns({
        "shared": F.max("several").over(w) | (F.min("node").over(w) != F.max("node").over(w))})
    rows = rows.where("node is not null and (m is not null or shared)")
    found = rows.groupBy("node", "part").agg(F.max("m").alias("m"), F.max("size").alias("size"), F.max("here").alias("here"),
                                             F.count(F.when(F.col("m").isNull(), 1)).alias("elsewhere"))
    return found.where("m > 0 and size - here - elsewhere <= m div 5").select("node").distinct()


def _sets(texts):
    """(node, check, m, hashes) with all shingles of each text, once per node."""
    def run(batch):
        sets = [np.unique(shingle_hashes(x or b"", WIDTH)) for x in batch.column("t").cast(pa.binary()).to_pylist()]
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]

    fields = [T.StructField("m", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))]
    return append(texts, run, fields, ["node", "check"]).dropDuplicates(["node"])


def _ordered(sets):
    """(node, m, single, shared): ``shared`` lists the shingles that several nodes hold, rarest first; nodes with too
    many single ones are left out."""
    rows = sets.select("node", "m", F.explode("hashes").alias("h"))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = rows.join(counts, "h").groupBy("node", "m").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    held = held.select("node", "m", (F.col("m") - F.size("s")).alias("single"), F.transform("s", lambda x: x["h"]).alias("shared"))
    return held.where("single <= m div 5")


def _enough(m, at, n, there):
    """Whether sets of sizes m and n may be near copies if their first common shingles are at these places."""
    rest = F.least(m - at, n - there)
    return (5 * F.least(m, n) >= 4 * F.greatest(m, n)) & (9 * rest >= 4 * (m + n))


def _verified(pairs, sets):
    """The (a, b) of ``pairs`` that are near copies."""
    left = sets.select(F.col("node").alias("a"), F.col("m").alias("ma"), F.col("shared").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("m").alias("mb"), F.col("shared").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(9 * F.size(F.array_intersect("sa", "sb")) >= 4 * (F.col("ma") + F.col("mb"))).select("a", "b")


def _all_pairs(rows):
    """Pairs of different components that meet, a < b, with the filters."""
    other = rows.toDF(*[c if c == "h" else f"{c}2" for c in rows.columns])
    met = rows.join(other, "h").where("node < node2 and root <> root2")
    return met.where(_enough(F.col("m"), F.col("at"), F.col("m2"), F.col("at2"))).select(F.col("node").alias("a"), F.col("node2").alias("b"))


def clusters(docs, text="text"):
    """(node, check, root) of every text that is linked to another one, by its two hashes (``content_key``); root is the
    smallest node. Of different texts with equal first hashes, which are not to be expected, one is compared.

    Null texts and texts without a word have no shingles and no links; repeated texts are one node; texts of fewer than
    five words are one shingle, so they are linked if their words are equal.
    """
    node, check = content_key(F.col(text))
    texts = docs.select(node.alias("node"), check.alias("check"), F.col(text).alias("t"))
    possible = small(stage(_possible(texts.drop("check")), "possible"))
    sets = stage(_sets(texts.join(possible, "node", "left_semi")), "sets")
    ordered, checks = stage(_ordered(sets), "ordered"), stage(sets.select("node", "check"), "checks")
    discard(sets, possible)
    prefix = F.posexplode(F.slice("shared", F.lit(1), (F.floor(F.col("m") / 5) + 1 - F.col("single")).cast("int")))
    met = ordered.select("node", "m", "single", prefix).select(F.col("col").alias("h"), "node", "m", (F.col("single") + F.col("pos")).alias("at"))
    met, links, tops = stage(met, "met"), None, None
    for turn in range(ROUNDS + 1):
        named = met.withColumn("root", F.col("node")) if tops is None else met.join(tops, "node", "left").withColumn("root", F.coalesce("root", "node"))
        named = named.select("h", "node", "m", "at", "root")
        buckets = named.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"),
                                         F.min(F.struct((F.col("at") / F.col("m")).alias("share"), "node", "root", "m", "at")).alias("first")).where("low <> high")
        named = stage(named.join(buckets.select("h", "n", "first"), "h"), "named")
        if named.isEmpty():
            break
        last = turn == ROUNDS
        many = named.where(F.lit(False) if last else F.col("n") > FEW)
        pairs = _all_pairs((named if last else named.where(F.col("n") <= FEW)).drop("n", "first"))
        star = many.where((F.col("root") != F.col("first.root")) & _enough(F.col("first.m"), F.col("first.at"), F.col("m"), F.col("at")))
        pairs = pairs.union(star.select(F.col("first.node").alias("a"), F.col("node").alias("b"))).distinct()
        found = stage(_verified(pairs, ordered), "links")
        links = found if links is None else links.union(found)
        tops = stage(components(links), "roots")
        before, met = met, stage(many.where("node <> first.node").select("h", "node", "m", "at"), "met")
        discard(named, before)
        if last:
            break
    if tops is None:
        return checks.withColumn("root", F.col("node")).limit(0)
    return checks.join(tops, "node")
