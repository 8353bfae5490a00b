"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is contained in a document when at least ``THRESHOLD`` percent of its distinct word shingles occur in it.
Items are partitioned by their number of shingles; an item of n shingles is sketched by its
``n - ceil(THRESHOLD * n / 100) + 1`` smallest shingle hashes (bottom-k MinHash). A document that holds the
item lacks fewer shingles than the sketch has, so it holds at least one of the sketch: the search over whole
documents of any length loses nothing. Each partition takes the sketch size of its largest item. Candidate
pairs are then verified by comparing the shingles themselves, in the documents that hold candidates; texts are not shuffled
while the pairs are few enough to go to every task.

Only DataFrame functions are used.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.llm.common import content_key, read, small, stage, words_of

WIDTH = 5
#: Share of an item's shingles, in percent.
THRESHOLD = 80
#: Rows (of 24 bytes) up to which the sketch, or the candidate pairs, go to every task; beyond, they are joined
#: by shuffle.
BROADCAST_ROWS = 1_000_000


def _word_hashes(words):
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingle_hashes(h, width):
    """Hash of each run of ``width`` words, from the column of the words' hashes."""
    runs = F.transform(h, lambda x, i: F.when(
        i <= F.size(h) - width, F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)])))
    return F.filter(runs, lambda x: x.isNotNull())


def _shingles(words, width):
    """The runs of ``width`` words as text."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.array_join(F.slice(words, i + 1, width), " "))


def sketch_items(items, item_id="item_id", text="text"):
    """One row per item with at least one word: item (its number), words, width, n shingles, shingles, sketch hashes.

    An item of fewer than five words is one shingle of all its words. Repeated rows count once.
    """
    rows = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0).distinct()
    rows = rows.withColumn("width", F.least(F.lit(WIDTH), F.size("words")))
    shingled = F.when(F.col("width") == WIDTH, F.array_distinct(_shingles(F.col("words"), WIDTH))).otherwise(
        F.array(F.array_join("words", " ")))
    rows = rows.withColumn("shingles", shingled).withColumn("n", F.size("shingles"))
    # partitions by size: items of 2^k to 2^(k+1) - 1 shingles share the sketch size of the largest
    rows = rows.withColumn("part", F.floor(F.log2("n")).cast("int"))
    rows = rows.withColumn("largest", F.max("n").over(Window.partitionBy("part")))
    need = F.col("largest") - F.expr(f"({THRESHOLD} * largest + 99) div 100").cast("int") + 1
    rows = rows.withColumn("k", F.least("n", need))
    rows = rows.withColumn("h", _word_hashes(F.col("words")))
    hashes = F.lit(None).cast("array<bigint>")
    for width in range(1, WIDTH + 1):
        hashes = F.when(F.col("width") == width, F.array_distinct(_shingle_hashes(F.col("h"), width))).otherwise(hashes)
    return rows.withColumn("sketch", F.slice(F.array_sort(hashes), 1, F.col("k"))).drop("largest", "k", "part", "h").withColumn(
        "item", F.monotonically_increasing_id())


def candidates(docs, items, text="text"):
    """Distinct (text key, number of the item) pairs whose text holds a shingle hash of the item's sketch."""
    sketch = stage(items.select("item", "width", F.explode("sketch").alias("h")), "sketch")
    size = {r["width"]: r["n"] for r in sketch.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most five rows
    found = None
    for width, n in sorted(size.items()):
        part = sketch.where(F.col("width") == width).select("item", "h")
        part = F.broadcast(part) if n <= BROADCAST_ROWS else part
        spread = docs.select(*content_key(F.col(text)), words_of(F.col(text)).alias("__w"))
        spread = spread.select("__k1", "__k2", _word_hashes(F.col("__w")).alias("__h"))
        spread = spread.select("__k1", "__k2", F.explode(_shingle_hashes(F.col("__h"), width)).alias("h"))
        hit = spread.join(part, "h").select("__k1", "__k2", "item")
        found = hit if found is None else found.union(hit)
    return None if found is None else found.distinct()


def contained(docs, items, doc_id="doc_id", text="text"):
    """(doc_id, item_id, n_shingles, n_found, containment) of every contained item, one row per document row.

    Equal texts are searched once each for their own row. Null or empty texts and items contain and match
    nothing; rows of equal item_id and equal words count once. A document's own columns of the same names
    as the result's are not looked at.
    """
    rows = stage(sketch_items(items, "item_id", "text"), "items")
    found = candidates(docs, rows, text)
    if found is None:
        return docs.select(F.col(doc_id).alias("doc_id")).limit(0).select(
            "doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("item_id", rows.schema["item_id"].dataType), ("n_shingles", "int"), ("n_found", "int"), ("containment", "double"))])
    found = stage(found, "candidates")
    found = small(found, BROADCAST_ROWS)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"), *content_key(F.col(text)))
    pairs = texts.join(found, ["__k1", "__k2"]).select("doc_id", "item", words_of(F.col("__text")).alias("__w"))
    pairs = pairs.join(rows.select("item", "item_id", "width", "shingles", "n"), "item")
    own = F.lit(None).cast("array<string>")
    for width in range(1, WIDTH + 1):
        own = F.when((F.col("width") == width) & (F.size("__w") >= width), _shingles(F.col("__w"), width)).otherwise(own)
    pairs = pairs.select("doc_id", "item_id", F.col("n").alias("n_shingles"),
                         F.size(F.array_intersect("shingles", own)).alias("n_found"))
    return pairs.where(F.col("n_found") * 100 >= F.col("n_shingles") * THRESHOLD).withColumn(
        "containment", F.col("n_found") / F.col("n_shingles"))


def clean_documents(docs, items):
    """Pipeline stage: the documents that contain no item, with their own columns."""
    hits = contained(docs.select(F.struct("doc_id", *content_key(F.col("text"))).alias("doc_id"), "text"), items)
    hits = small(stage(hits.select("doc_id.*").distinct().toDF("__id", "__h1", "__h2"), "contaminated"))
    k1, k2 = content_key(F.col("text"))
    marked = docs.withColumns({"__k1": k1, "__k2": k2})
    same = (F.col("__k1") == F.col("__h1")) & (F.col("__k2") == F.col("__h2")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return marked.join(hits, same, "left_anti").select(*docs.columns)


def op9_decontamination(spark, sf_dir):
    """Every benchmark item that a document contains."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return contained(docs, read(spark, sf_dir, "benchmark"))


OP9_SQL = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS w FROM benchmark),
ix AS (SELECT item_id, w, least(5, len(w)) AS width FROM i WHERE len(w) > 0),
si AS (SELECT DISTINCT item_id, w, width, array_to_string(w[k:k + width - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS k FROM ix)),
ni AS (SELECT item_id, w, count(*) AS n FROM si GROUP BY ALL),
dn AS (SELECT *, row_number() OVER () AS r FROM d),
sd AS (SELECT DISTINCT doc_id, r, width, array_to_string(w[k:k + width - 1], ' ') AS s
       FROM (SELECT doc_id, r, w, width, unnest(range(1, len(w) - width + 2)) AS k
             FROM dn, (SELECT DISTINCT width FROM ix) WHERE len(w) >= width)),
hit AS (SELECT doc_id, r, item_id, si.w, count(*) AS n_found FROM sd JOIN si USING (width, s) GROUP BY ALL)
SELECT doc_id, item_id, n::INT AS n_shingles, n_found::INT AS n_found, n_found / n AS containment
FROM hit JOIN ni USING (item_id, w) WHERE n_found * 100 >= n * 80
"""
