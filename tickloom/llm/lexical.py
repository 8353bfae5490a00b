"""Ranked lexical search: the highest-scoring documents of each query item, by groups of equal presence masks.

One pass over the texts keeps, of each document, its number of terms and the terms that some item holds. Documents are
then taken in blocks. In a block every term of an item has a bitmap of the documents that hold it; the bitmaps of the
item's terms, packed, give each document its mask of matched terms. All documents of a mask share an upper bound: the
sum of what its terms can add at most in this block. Masks are evaluated by descending bound, until the bound of the
next one is below the lowest score that still counts; then nothing that is left can enter and the block is finished.
A task carries the best scores of each item from block to block, so later blocks finish sooner, and ends with at most
``k`` rows an item, of which a window keeps the best. No row is dropped on other grounds than such a bound.

Scores are whole numbers: see ``weight`` and ``_scores``.
"""
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import append, read, stage

#: Characters of items that go to every task at once; more are searched in several passes.
ITEM_CHARS = 4_000_000
#: Documents of a block, and postings from which a block is closed early.
DOCS, POSTINGS = 4096, 1 << 20
#: Documents of the first masks evaluated; each further step takes twice as many.
FIRST = 64
SCALE = 1_000_000_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(raw):
    """Terms of UTF-8 bytes: maximal stretches of ASCII letters and digits and of characters beyond ASCII, A-Z lowered."""
    return raw.translate(_LOWER).split()


def weight(docs, df):
    """Rarity of a term that ``df`` of ``docs`` documents hold, in thousandths."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _parts(tf, m):
    return SCALE * tf // (1000 * tf + 8 * m)


def postings(docs, vocabulary, text="text", doc_id="doc_id"):
    """(doc_id, n, term, tf) of every document with a term; ``term`` and ``tf`` list those of ``vocabulary`` (a map
    from terms to numbers) that it holds."""
    def run(batch):
        lengths, terms, counts = [], [], []
        for raw in batch.column(text).cast(pa.binary()).to_pylist():
            words = terms_of(raw or b"")
            held = [(vocabulary[t], c) for t, c in Counter(words).items() if t in vocabulary]
            lengths.append(len(words))
            terms.append([t for t, _ in held])
            counts.append([c for _, c in held])
        return [pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]

    fields = [T.StructField("n", T.LongType()), T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType()))]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return append(rows.withColumnRenamed("text", text), run, fields, ["doc_id"]).where("n > 0")


def document_counts(rows, size):
    """Documents that hold each of ``size`` terms, as an array; tasks add up before they send."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(b.column("term").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "df"])

    parts = rows.select("term").mapInArrow(run, "term long, df long")
    out = np.zeros(size, np.int64)
    for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


class _Best:
    """The ``k`` best (score, id) of an item so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k):
        self.k, self.scores, self.ids, self.unknown = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def bar(self):
        """The lowest score that counts; 1 while there is room."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores, ids, unknown):
        scores, ids, unknown = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.unknown, unknown)))
        order = np.lexsort((ids, unknown, -scores))[:self.k]
        self.scores, self.ids, self.unknown = scores[order], ids[order], unknown[order]


class _Block:
    """Documents with their postings, ordered by term."""

    def __init__(self, ids, unknown, m, doc, term, tf, size):
        order = np.argsort(term, kind="stable")
        self.ids, self.unknown, self.m, self.size = ids, unknown, m, size
        self.doc, self.tf = doc[order], tf[order]
        self.edges = np.searchsorted(term[order], np.arange(size + 1))

    def counts(self, terms):
        """Occurrences of ``terms`` (rows) in the documents (columns)."""
        out = np.zeros((len(terms), len(self.ids)), np.int64)
        for row, t in enumerate(terms):
            a, b = self.edges[t], self.edges[t + 1]
            out[row, self.doc[a:b]] = self.tf[a:b]
        return out


def masks_of(present):
    """(number of the mask of each document, one document of each mask) of a terms x documents bitmap."""
    packed = np.packbits(present, axis=0)
    packed = np.concatenate((packed, np.zeros((-len(packed) % 8, packed.shape[1]), np.uint8)))
    group, first = np.zeros(packed.shape[1], np.int64), np.zeros(1, np.int64)
    for k in range(0, len(packed), 8):
        part = np.ascontiguousarray(packed[k:k + 8].T).view(np.uint64)[:, 0]
        _, names = np.unique(part, return_inverse=True)
        _, first, group = np.unique(group * (len(part) + 1) + names, return_index=True, return_inverse=True)
    return group, first


def _search(block, terms, gains, best):
    """Put the documents of a block that can still count for an item into ``best``."""
    tf = block.counts(terms)
    present = tf > 0
    if not present.any():
        return
    most = gains * _parts(tf.max(axis=1), block.m.min())
    group, first = masks_of(present)
    bound = most @ present[:, first]
    order = np.argsort(-bound[group], kind="stable")
    falling = bound[group][order]
    at, step = 0, FIRST
    while at < len(order):
        end = np.searchsorted(-falling, -best.bar(), side="right")
        if end <= at:
            break
        some = order[at:min(at + step, end)]
        scores = gains @ _parts(tf[:, some], block.m[some])
        good = np.flatnonzero(scores >= best.bar())
        best.add(scores[good], block.ids[some[good]], block.unknown[some[good]])
        at, step = at + len(some), step * 2


def _blocks(batch, number, total, size):
    """Blocks of an Arrow batch of postings."""
    lengths = np.diff(batch.column("term").offsets.to_numpy())
    ends = np.cumsum(lengths)
    low = 0
    while low < batch.num_rows:
        before = ends[low] - lengths[low]
        high = min(low + DOCS, max(low + 1, int(np.searchsorted(ends, before + POSTINGS, side="right"))))
        b = batch.slice(low, high - low)
        ids = b.column("doc_id")
        m = 25 + 75 * b.column("n").to_numpy(zero_copy_only=False) * number // total
        yield _Block(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), m,
                     np.repeat(np.arange(high - low), lengths[low:high]), b.column("term").flatten().to_numpy(), b.column("tf").flatten().to_numpy(), size)
        low = high


RESULT = "item long, doc_id long, score long"


def _ranked(rows, items, df, number, total, k):
    """(item, doc_id, score, rank) for ``items``, a list of (number, term numbers, repeats)."""
    weights = np.array([weight(number, int(x)) for x in df], np.int64)
    size = len(df)

    def run(batches):
        best = [_Best(k) for _ in items]
        for batch in batches:
            for block in _blocks(batch, number, total, size):
                for found, (_, terms, repeats) in zip(best, items):
                    _search(block, terms, repeats * weights[terms], found)
        ids = [pa.array(x.ids, mask=x.unknown) for x in best]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([i for i, _, _ in items], [len(x.ids) for x in best]), pa.int64()),
            pa.concat_arrays(ids).cast(pa.int64()), pa.array(np.concatenate([x.scores for x in best]), pa.int64())], names=["item", "doc_id", "score"])

    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = rows.select("doc_id", "n", "term", "tf").mapInArrow(run, RESULT)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(docs, items, k=10, text="text", doc_id="doc_id", item_id="item_id", item_text="text"):
    """The ``k`` documents of highest score above zero of every item (all, if fewer): (item_id, rank, doc_id, score).

    Equal scores rank by ascending doc_id, a null one last; repeated rows are documents of their own. Null or empty
    texts have no terms: such documents are not found and not counted, such items have no rows. Rows that repeat an
    item_id are items of their own. Ids of documents are whole numbers; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = stage(items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
                  .withColumn("item", F.monotonically_increasing_id()), "items")
    # a shortcut for the sum of lengths would not bound a pass with a single long item: such an item is a pass by itself
    passes = max(1, -(-(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // ITEM_CHARS))
    out = None
    for turn in range(passes):
        held, vocabulary = [], {}
        for r in asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == turn).collect():
            found = Counter(terms_of((r.text or "").encode()))
            if found:
                terms = [vocabulary.setdefault(t, len(vocabulary)) for t in found]
                held.append((r.item, np.array(terms), np.array(list(found.values()), np.int64)))
        if not held:
            continue
        rows = stage(postings(docs, vocabulary, text, doc_id), "postings")
        number, total = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not number:
            continue
        ranked = _ranked(rows, held, document_counts(rows, len(vocabulary)), number, total, k)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], RESULT + ", rank int")
    return out.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark, sf_dir):
    """The ten best documents of each benchmark item."""
    return search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents), q AS (SELECT item_id, {_TERMS} AS t FROM benchmark),
docs AS (SELECT doc_id, len(t) AS n FROM d WHERE len(t) > 0),
whole AS (SELECT count(*) AS number, CAST(sum(n) AS BIGINT) AS total FROM docs),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(number) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY 1),
asked AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(t) AS term FROM q) GROUP BY 1, 2),
scored AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * number) // total)))) AS BIGINT) AS score
FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN docs USING (doc_id), whole GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""
