"""Shards of near-equal size by sampled splitters, with DataFrame functions only.

Records are ordered by a key. A size-weighted sample of keys gives the quantile boundaries (splitters) of many more
ranges than shards; every record finds its range by comparing keys. Ranges that came out overfull, because a few
keys or repeated ones fill them, are subdivided by a hash of the whole record. The exact bytes and rows of all
ranges then give each range its place in the whole, one pass over each range gives each record its place, and
the place in bytes decides the shard. No task orders more than a range.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.llm.common import read, shared_dir, stage

#: Rows a range is planned for; a range of twice as many is subdivided.
RANGE_ROWS = 100_000
RANGES_PER_SHARD = 8
#: Keys drawn per range, on average.
SAMPLES = 24
#: Records of one key stay together while their bytes are under this share of a shard.
TOGETHER = 0.01


def _range_of(bounds, key, tie):
    """Number of splitters at or below (key, tie), found in two steps among groups of splitters."""
    at = F.struct(key.alias("k"), tie.alias("t"))
    group = F.greatest(F.size(F.filter(bounds, lambda g: g[0] <= at)) - 1, F.lit(0))
    inside = F.size(F.filter(F.get(bounds, group), lambda b: b <= at))
    before = F.aggregate(F.slice(bounds, 1, group), F.lit(0), lambda n, g: n + F.size(g))
    return F.when(F.size(bounds) == 0, F.lit(0)).otherwise(before + inside)


def assign(rows, shards, size="size", key="key", tie="tie"):
    """``rows`` with shard and slot; shard sizes differ by about a record or a small group of one key.

    ``key`` and ``tie`` are long columns: the order is by key and tie, and records of one key stay in one shard
    unless they make up over a hundredth of it. Slots count from 0 in each shard without gaps. Null
    sizes count as 0 and null keys come first. ``rows`` must be a stored table. An empty table gives an empty result.
    """
    columns = rows.columns
    rows = rows.withColumns({"__size": F.coalesce(F.col(size), F.lit(0)).cast("long"),
                             "__key": F.coalesce(F.col(key), F.lit(-(1 << 63))), "__tie": F.coalesce(F.col(tie), F.lit(-(1 << 63)))})
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("__size"), F.lit(0)).alias("bytes")).first()
    bytes_ = max(1, total["bytes"])
    ranges = max(shards * RANGES_PER_SHARD, -(-total["rows"] // RANGE_ROWS))

    # a record is drawn with a chance in proportion to its size (at least once if it would fill a sample step)
    chance = F.col("__size") * F.lit(ranges * SAMPLES / bytes_)
    luck = F.pmod(F.xxhash64("__key", "__tie", F.lit(17)), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = rows.where(luck < chance).select(F.struct(F.col("__key").alias("k"), F.col("__tie").alias("t")).alias("s"))
    # one row: about ranges x SAMPLES keys of 16 bytes, every SAMPLES-th of which becomes a splitter
    keys = drawn.agg(F.array_sort(F.collect_list("s")).alias("s"))
    step = F.greatest((F.size("s") / ranges).cast("int"), F.lit(1))
    chosen = keys.select(F.array_distinct(F.filter(F.transform("s", lambda x, i: F.when((i + 1) % step == 0, x)), lambda x: x.isNotNull())).alias("s"))
    wide = max(1, int(ranges ** 0.5))
    groups = F.transform(F.sequence(F.lit(0), (F.size("s") - 1).cast("int"), F.lit(wide)), lambda i: F.slice("s", i + 1, wide))
    splitters = stage(chosen.select(F.when(F.size("s") > 0, groups).otherwise(F.array().cast("array<array<struct<k:bigint,t:bigint>>>")).alias("bounds")), "splitters")

    # the single row of splitters reaches every task through a join on a constant
    placed = rows.withColumn("__one", F.lit(1)).join(F.broadcast(splitters.withColumn("__one", F.lit(1))), "__one")
    placed = stage(placed.withColumn("__range", _range_of(F.col("bounds"), F.col("__key"), F.col("__tie"))).drop("bounds", "__one"), "placed")
    full = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    pieces = full.where(F.col("n") > 2 * RANGE_ROWS).select("__range", F.ceil(F.col("n") / RANGE_ROWS).alias("__pieces"))
    placed = placed.join(pieces, "__range", "left")
    rest = [F.col(c) for c in columns]
    placed = placed.withColumn("__part", F.coalesce(F.pmod(F.xxhash64("__tie", *rest), F.col("__pieces")), F.lit(0)))

    sums = placed.groupBy("__range", "__part").agg(F.sum("__size").alias("b"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__range", "__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = sums.select("__range", "__part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    order = Window.partitionBy("__range", "__part").orderBy("__key", "__tie", *rest)
    same = Window.partitionBy("__range", "__part", "__key")
    ordered = placed.withColumns({"__end": F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)),
                                  "__n": F.row_number().over(order)})
    ordered = ordered.withColumns({"__group": F.sum("__size").over(same), "__start": F.min(F.col("__end") - F.col("__size")).over(same)})
    ordered = ordered.join(sums, ["__range", "__part"])
    small = F.col("__group") <= F.lit(TOGETHER * bytes_ / shards)
    # a record, or a small group, belongs where its middle lies
    middle = F.col("b0") + F.when(small, F.col("__start") + F.col("__group") / 2).otherwise(F.col("__end") - F.col("__size") / 2)
    ordered = ordered.withColumn("shard", F.least(F.floor(middle * shards / F.lit(bytes_)), F.lit(shards - 1)).cast("int"))
    ordered = stage(ordered.withColumn("__at", F.col("n0") + F.col("__n") - 1).select(*rest, "shard", "__at"), "ordered")
    first = ordered.groupBy("shard").agg(F.min("__at").alias("__first"))  # one row per shard
    return ordered.join(first, "shard").select(*rest, "shard", (F.col("__at") - F.col("__first")).cast("long").alias("slot"))


def write_shards(docs, shards, path, text="text"):
    """Write the documents themselves, one folder per shard, rows in slot order within each file."""
    rows = docs.withColumns({"__size": F.coalesce(F.octet_length(text), F.lit(0)) + 1, "__key": F.xxhash64(text),
                             "__tie": F.xxhash64(*docs.columns)})
    placed = assign(stage(rows.withColumnsRenamed({"__size": "__bytes", "__key": "__text_key", "__tie": "__text_tie"}), "records"),
                    shards, "__bytes", "__text_key", "__text_tie")
    placed = placed.drop("__bytes", "__text_key", "__text_tie").repartitionByRange("shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7_sharding(spark, sf_dir):
    """All documents in eight shards of near-equal bytes; equal texts lie next to each other."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    body = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                       F.xxhash64("text").alias("key"), F.xxhash64("doc_id").alias("tie"))
    out = assign(stage(rows, "records"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
