"""Byte-level BPE encoding through a table of distinct words, and decoding through an id-to-piece table.

Each Arrow batch of documents is a block. Pass one splits its texts into words and sends each distinct word of
the block, with its number there, to one of many word buckets; a bucket encodes each distinct word once,
whatever blocks it came from, and sends the ids back. Pass two splits the same batch again, keeps only the word
numbers and joins the ids to them by position. So a word travels once per block, not once per occurrence, and
neither the vocabulary nor the texts are ever gathered anywhere. Both passes need the same batches, so ``docs``
must be a stored table (a file scan), whose tasks always read the same rows in the same order.
"""
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.bytebpe import batch_words, default_tokenizer, load, special_tokens, split_columns, spread
from tickloom.llm.common import append, give_back, read

#: Word numbers in one row of a block, cut between documents.
ROW_WORDS = 1 << 19


def _numbered(batch, tokenizer, only_words=False):
    """Rows, words per row, word numbers and count of distinct words of a batch, or only these words; the most frequent
    one has number 0."""
    order, flat, counts = batch_words(batch, tokenizer)
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    rank = np.argsort(-np.bincount(index, minlength=len(coded.dictionary)), kind="stable")
    words = coded.dictionary.take(pa.array(rank))
    if only_words:
        return words
    number = np.empty(len(rank), np.int32)
    number[rank] = np.arange(len(rank), dtype=np.int32)
    return order, counts, number[index] if len(index) else index, len(words)


def _pack(numbers):
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(blob):
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _block(n):
    return (TaskContext.get().partitionId() << 24) | n


def _lists(cuts, values):
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


@lru_cache(maxsize=2)
def _pieces(path):
    """The bytes of every id, in order, and nothing for any other."""
    return pa.array([*load(path).pieces, b""], pa.binary())


def _texts(column, pieces):
    """The texts of lists of ids: each id takes its piece, the pieces of a list lie end to end."""
    codes = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.where((codes >= 0) & (codes < len(pieces) - 1), codes, len(pieces) - 1)
    got = pieces.take(pa.array(codes))
    ends = np.frombuffer(got.buffers()[1], np.int32)[: len(got) + 1] if len(got) else np.zeros(1, np.int32)
    raw = memoryview(got.buffers()[2]) if len(got) else b""
    n = np.nan_to_num(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
    cuts = ends[np.r_[0, np.cumsum(n)]].tolist()
    return [str(raw[a:b], "utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


def encode(docs, path=None, text="text", doc_id="doc_id", buckets=None, decoded=False):
    """(doc_id, ids) of every row of the stored table ``docs``; a null or empty text has no ids.

    With ``decoded`` the text that the ids stand for comes as a third column, made by the join of ``decode`` in
    the task that has the ids at hand.

    Special tokens written out in a text are encoded as such; none are added.
    """
    path = path or default_tokenizer()
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema[doc_id].dataType
    rows = split_columns(docs, text, special_tokens(path), [F.col(doc_id).alias("doc_id")])

    def send_words(batches):
        for n, b in enumerate(batches):
            words = _numbered(b, load(path), only_words=True)
            if not len(words):
                continue
            bucket = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cuts) - 1, _block(n))), pa.array(bucket[order][cuts[:-1]]),
                 _lists(cuts, pa.array(order.astype(np.int32))), _lists(cuts, words.take(pa.array(order)))],
                names=["block", "bucket", "number", "word"])
            del words, bucket, order, b
            give_back()

    def encode_words(table):
        words = table.column("word").combine_chunks()
        coded = words.flatten().dictionary_encode()
        ids, lens = load(path).encode_words(coded.dictionary.to_pylist())
        flat, n = spread(coded.indices.to_numpy(zero_copy_only=False), ids, lens)
        cuts = np.r_[0, np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))]
        at = np.r_[0, np.cumsum(n)][cuts]
        return pa.table([table.column("block"), table.column("number"), _lists(cuts, pa.array(n.astype(np.int32))),
                         _lists(at, pa.array(flat.astype(np.int32)))], names=["block", "number", "n", "ids"])

    def send_numbers(batches):
        for k, b in enumerate(batches):
            order, counts, numbers, distinct = _numbered(b, load(path))
            ids = b.column("doc_id").take(pa.array(order))
            ends = np.r_[0, np.cumsum(counts)]
            at = 0
            while at < len(counts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + ROW_WORDS, "right")) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_block(k)], pa.int64()), pa.array([distinct], pa.int64()), _lists([0, to - at], ids[at:to]),
                     _lists([0, to - at], pa.array(counts[at:to].astype(np.int32))),
                     pa.array([_pack(numbers[ends[at]:ends[to]])], pa.binary())],
                    names=["block", "distinct", "doc_id", "words", "numbers"])
                at = to
            del order, counts, numbers, ids, b
            give_back()

    def put_back(numbers, coded):
        number = coded.column("number").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        n = coded.column("n").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = coded.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        starts, lens = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        starts[number], lens[number] = np.cumsum(n) - n, n
        out = []
        for k in range(numbers.num_rows):
            if numbers.column("distinct")[k].as_py() != len(number):
                raise RuntimeError("the two passes saw different batches: docs must be a stored table")
            index = _unpack(numbers.column("numbers")[k].as_py())
            per_word = lens[index]
            word_ends = np.cumsum(per_word)
            place = np.arange(word_ends[-1] if len(index) else 0)
            place -= np.repeat(word_ends - per_word - starts[index], per_word)
            words = numbers.column("words")[k].values.to_numpy(zero_copy_only=False)
            cuts = np.r_[0, word_ends][np.r_[0, np.cumsum(words)]]
            lists = _lists(cuts, pa.array(ids[place], pa.int32()))
            del place, index, per_word
            columns = [numbers.column("doc_id")[k].values, lists]
            if decoded:
                columns.append(pa.array(_texts(lists, _pieces(path)), pa.string()))
            out.append(pa.table(columns, names=result.names))
        fields = [("doc_id", numbers.schema.field("doc_id").type.value_type), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        schema = pa.schema(fields[:len(result)])
        return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()

    words = rows.mapInArrow(send_words, "block long, bucket long, number array<int>, word array<string>")
    coded = words.groupBy("bucket").applyInArrow(encode_words, "block long, number array<int>, n array<int>, ids array<int>")
    sent = T.StructType([T.StructField("block", T.LongType()), T.StructField("distinct", T.LongType()),
                         T.StructField("doc_id", T.ArrayType(id_type)), T.StructField("words", T.ArrayType(T.IntegerType())),
                         T.StructField("numbers", T.BinaryType())])
    numbers = rows.mapInArrow(send_numbers, sent)
    result = T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        result = result.add("decoded", T.StringType())
    return numbers.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(put_back, result)


def decode(encoded, path=None, ids="ids", keep=None):
    """``encoded[keep]`` with the column decoded, from a join of the ids with the table of pieces.

    The table has one row per id of the vocabulary and goes to every task. Bytes that are not UTF-8 become
    replacement characters; ids outside the vocabulary and nulls give nothing; a null list gives an empty text.
    """
    path = path or default_tokenizer()

    def run(batch):
        column, texts = batch.column(ids), []
        ends = np.cumsum(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)))
        at = 0
        while at < len(column):  # some documents at a time
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ROW_WORDS, "right")))
            texts += _texts(column.slice(at, to - at), _pieces(path))
            at = to
        return [pa.array(texts, pa.string())]

    return append(encoded, run, [T.StructField("decoded", T.StringType())], keep)


def digests(docs, path=None):
    """Pipeline stage and query: size and digest of the ids and digest of the decoded text of every document."""
    out = encode(docs.select("doc_id", "text"), path, decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_tokens(spark, sf_dir):
    """Tokens of every document there and back."""
    return digests(read(spark, sf_dir, "documents"))
