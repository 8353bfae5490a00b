"""SimHash near duplicates by meet-in-the-middle ball hashing.

Links join fingerprints that differ in at most three bits. Half of that radius is one and a half, so the
search has two rounds, both on distinct fingerprints:

* radius one: every fingerprint emits itself and its 64 one-bit variants. Two fingerprints that share a
  variant differ in at most two bits, so everything in a bucket is linked and one star per bucket (at most
  65 members) says it all; every pair at distance one or two meets.
* the other half: one of four 16-bit blocks is masked out and the one-bit variants of the other 48 bits are
  emitted. A pair at distance three has its odd bit in one of the blocks, and without that block it is at
  distance two, or none when all three bits lie in it, so it meets. Only buckets with fingerprints of several
  clusters of round one go on, and their pairs are verified by counting bits.

Both rounds emit a fixed number of rows per distinct fingerprint, so copies cost nothing and growth is linear.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, content_key, read, small, stage
from tickloom.llm.graph import components
from tickloom.llm.nearcopies import clusters as near_copies
from tickloom.llm.nearcopies import shingle_hashes

RADIUS = 3
BLOCK = 16


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def fingerprint(raw, width=3):
    """64-bit SimHash of UTF-8 bytes: ASCII-lower-cased words, shingles of ``width`` words, repeats included.

    A text of fewer words has one shingle, a text without words gives zero.
    """
    hashes = shingle_hashes(raw, width)
    n = len(hashes)
    if n < 2:
        return int(hashes[0]) if n else 0
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs, text="text", width=3, keep=None):
    """``docs`` with the long column fp (the unsigned fingerprint's bits); null texts count as empty."""
    def run(batch):
        raw = batch.column(text).cast(pa.binary()).to_pylist()
        return [pa.array([_signed(fingerprint(x or b"", width)) for x in raw], pa.int64())]

    return append(docs, run, [T.StructField("fp", T.LongType())], keep)


def _variants(fp, masks):
    return F.explode(F.transform(F.array(*[F.lit(_signed(m)) for m in masks]), lambda m: fp.bitwiseXOR(m)))


def _keys(number, block):
    """The one-bit variants of fp without a block; the block's place holds its number, to keep the kinds apart."""
    tag = (number + 1) << (number * BLOCK)
    masks = [tag] + [tag | 1 << k for k in range(64) if not block >> k & 1]
    rest = F.col("fp").bitwiseAND(F.lit(_signed(~block & (1 << 64) - 1)))
    return F.transform(F.array(*[F.lit(_signed(m)) for m in masks]), lambda m: rest.bitwiseXOR(m))


def clusters(fps):
    """(fp, root) of every fingerprint in ``fps`` that is linked to another one; root is the smallest."""
    fps = fps.select("fp").where("fp is not null").distinct()
    # many small partitions: each row becomes some two hundred
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = fps.repartition(tasks, "fp")
    ball = fps.select("fp", _variants(F.col("fp"), [0] + [1 << k for k in range(64)]).alias("v"))
    near = ball.withColumn("low", F.min("fp").over(Window.partitionBy("v"))).where("fp <> low").select(
        F.col("fp").alias("a"), F.col("low").alias("b"))
    near = stage(near.distinct(), "near")
    first = stage(components(near), "clusters")

    blocks = [((1 << BLOCK) - 1) << s for s in range(0, 64, BLOCK)]
    keys = [_keys(number, block) for number, block in enumerate(blocks)]
    named = fps.join(first.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))
    w = Window.partitionBy("key")
    named = named.repartition(tasks, "fp")
    met = (named.select("fp", "root", F.explode(F.concat(*keys)).alias("key"))
           .withColumn("low", F.min("root").over(w)).withColumn("high", F.max("root").over(w))
           .where("low <> high").select("key", "fp", "root"))
    met = stage(met, "met")
    other = met.select("key", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    far = (met.join(other, "key").where("root < root2")
           .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS)
           .select(F.col("root").alias("a"), F.col("root2").alias("b")).distinct())
    second = components(far)
    both = named.join(second.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return both.select("fp", F.coalesce("top", "root").alias("root"))


def near_duplicates(docs, text="text", doc_id="doc_id", keep=None):
    """``docs[keep]`` with fp and component_id, the smallest id reachable over links.

    Copies share a fingerprint and hence a component; texts without words all have fingerprint zero and are
    linked like any other. A null id is never smallest; a component of null ids only has a null component_id.
    """
    marked = stage(fingerprints(docs, text, keep=keep), "fingerprints")
    smallest = marked.groupBy("fp").agg(F.min(doc_id).alias("__id"))
    tops = clusters(marked).join(smallest, "fp")
    tops = tops.select("fp", "__id", "root")
    named = tops.groupBy("root").agg(F.min("__id").alias("component_id"))
    lookup = stage(tops.join(named, "root").select("fp", "component_id"), "components")
    return marked.drop("component_id").join(lookup, "fp")


def one_per_group(docs):
    """Pipeline stage: of each group of near copies (five-word shingles, Jaccard 0.8; see ``nearcopies``) the row
    with the smallest doc_id stays.

    Rows that repeat that doc_id count as copies: the one with the smallest text hash stays. Documents
    without a word have nothing to compare and stay. Columns are those of ``docs``.
    """
    some = F.coalesce(F.col("text"), F.lit("")).rlike("[^ \\t-\\r]")
    key = ["__k1", "__k2"]
    named = small(stage(near_copies(docs.where(some)).withColumnsRenamed({"node": "__k1", "check": "__k2"}), "near"))
    rows = docs.where(some).select("doc_id", *content_key(F.col("text"))).groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("n"))
    # a text without near copies is a group of its own, named by both hashes
    group = F.struct(F.coalesce("root", "__k1").alias("a"), F.when(F.col("root").isNull(), F.col("__k2")).alias("b"))
    rows = rows.join(named, key, "left").withColumn("component_id", group).drop("root")
    rows = stage(rows.withColumn("o", F.struct(F.col("doc_id").isNull(), "doc_id", *key)), "members")
    first = rows.groupBy("component_id").agg(F.min("o").alias("first")).withColumnRenamed("component_id", "__c")
    rows = rows.join(first, F.col("component_id").eqNullSafe(F.col("__c")))
    # what does not simply stay: the other members, and of a first one that is repeated all rows but one
    odd = rows.where("o <> first or n > 1").select(F.col("doc_id").alias("__id"), F.col("__k1").alias("__h1"), F.col("__k2").alias("__h2"),
                                                   (F.col("o") == F.col("first")).alias("__first"))
    odd = small(stage(odd, "dropped"))
    wide = docs.withColumns(dict(zip(key, content_key(F.col("text")))))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__k1") == F.col("__h1")) & (F.col("__k2") == F.col("__h2"))
    plain = wide.where(some).join(odd, same, "left_anti").select(*docs.columns)
    repeated = wide.where(some).join(odd.where("__first"), same, "left_semi").dropDuplicates(["doc_id", *key]).select(*docs.columns)
    return plain.unionByName(repeated).unionByName(docs.where(~some))


def op10_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_duplicates(docs, keep=["doc_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
