"""Token files of independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames of little-endian ids (each with its own content checksum), a skippable
frame with the document index (an Arrow record batch of doc_id and n_tokens), and the seek table of the
zstandard seekable format: sizes and an XXH64 checksum of every frame. Frames end between documents; a document
longer than a frame has frames of its own. A reader fetches the table, finds the frames of the documents it
is asked for and decompresses only these. Any zstandard tool can read the ids of a whole file.

``write`` orders documents by id over the files: every task writes one file under a name of its own attempt
and returns one row; only the rows of finished tasks reach the stored manifest, so a lost executor costs a
repeated task and leaves at most a file nobody knows.
"""
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.bytebpe import batch_words, default_tokenizer, load, special_tokens, split_columns, spread
from tickloom.llm.common import read, shared_dir, stage
from tickloom.llm.files import new_file, open_folder

# Fixed values of the seekable format.
INDEX_MAGIC, TABLE_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Ids after which a frame ends at the next document.
FRAME_IDS = 1 << 18
LEVEL = 3
#: Documents in one batch of what a reader returns.
BATCH = 4096
MANIFEST = "part long, file string, documents long, tokens long, frames long, bytes long"


class Writer:
    """One token file; holds at most a frame of ids and the document index."""

    def __init__(self, stream, width, id_type):
        self.stream, self.dtype, self.id_type = stream, np.dtype(f"<u{width}"), id_type
        self.frames, self.docs, self.counts, self.pending, self.size = [], [], [], [], 0
        self.tokens = self.bytes = 0

    def add(self, doc_ids, ids, counts):
        """Documents in order: their ids end to end and the number of each."""
        ends = np.cumsum(counts)
        at = done = 0
        while at < len(counts):
            # the first document that fills the frame is its last
            to = min(len(counts), int(np.searchsorted(ends, done + FRAME_IDS - self.size)) + 1)
            self.pending.append(ids[done:ends[to - 1]].astype(self.dtype))
            self.size += int(ends[to - 1] - done)
            at, done = to, int(ends[to - 1])
            if self.size >= FRAME_IDS:
                self.flush()
        self.docs.append(doc_ids)
        self.counts.append(np.asarray(counts, np.int64))
        self.tokens += int(ends[-1]) if len(ends) else 0

    def flush(self):
        raw = np.concatenate(self.pending) if self.pending else np.zeros(0, self.dtype)
        self.pending, self.size = [], 0
        for k in range(0, len(raw), 2 * FRAME_IDS):
            part = raw[k:k + 2 * FRAME_IDS].tobytes()
            packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(part)
            self.frames.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
            self._write(packed)

    def _write(self, data):
        self.stream.write(data)
        self.bytes += len(data)

    def close(self):
        """The manifest's figures: documents, tokens, frames, bytes."""
        self.flush()
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        docs = pa.concat_arrays(self.docs) if self.docs else pa.array([], self.id_type)
        batch = pa.RecordBatch.from_arrays([docs, pa.array(counts)], schema=pa.schema(
            [("doc_id", self.id_type), ("n_tokens", pa.int64())], metadata={"width": str(self.dtype.itemsize)}))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        index = sink.getvalue().to_pybytes()
        self._write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, END_MAGIC)
        self._write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        return len(docs), self.tokens, len(self.frames), self.bytes


class Reader:
    """Random access to a token file: only the table, the index and the frames asked for are read."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != END_MAGIC:
            raise ValueError("no seek table")
        table = file.read_at(12 * n, size - 9 - 12 * n)
        self.frames = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.offsets = np.r_[0, np.cumsum(self.frames[:, 0])]
        start = int(self.offsets[-1])
        index = file.read_at(size - 9 - 12 * n - 8 - start, start)
        if struct.unpack("<I", index[:4])[0] != INDEX_MAGIC:
            raise ValueError("no document index")
        table = pa.ipc.open_stream(pa.py_buffer(index[8:])).read_all()
        self.dtype = np.dtype(f"<u{table.schema.metadata[b'width'].decode()}")
        self.doc_ids = table.column(0)
        self.counts = table.column(1).to_numpy()
        self.starts = np.cumsum(self.counts) - self.counts
        self.first = np.r_[0, np.cumsum(self.frames[:, 1] // self.dtype.itemsize)]

    def frame(self, k):
        """The ids of frame k, checked."""
        packed = self.file.read_at(int(self.frames[k, 0]), int(self.offsets[k]))
        raw = zstandard.ZstdDecompressor().decompress(packed)
        if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, self.dtype)

    def ids(self, row):
        """The ids of the document at a row of the index, from the frames that hold it."""
        a, b = int(self.starts[row]), int(self.starts[row] + self.counts[row])
        if a == b:
            return np.zeros(0, self.dtype)
        k, last = int(np.searchsorted(self.first, a, "right")) - 1, int(np.searchsorted(self.first, b, "left")) - 1
        got = np.concatenate([self.frame(j) for j in range(k, last + 1)])
        return got[a - self.first[k]:b - self.first[k]]

    def all(self):
        """(row, ids) of every document in order, one frame after the other."""
        row, have, at = 0, np.zeros(0, self.dtype), 0
        for k in range(len(self.frames)):
            have = np.concatenate([have[at:], self.frame(k)])
            at = 0
            while row < len(self.counts) and at + self.counts[row] <= len(have):
                yield row, have[at:at + int(self.counts[row])]
                at += int(self.counts[row])
                row += 1
        for row in range(row, len(self.counts)):  # documents without ids after the last frame
            yield row, have[:0]


def write(docs, folder, path=None, end_id=0, text="text", doc_id="doc_id"):
    """Write the ids of ``docs`` in ascending doc_id order (nulls first, ties by text); the stored manifest.

    A null text counts as empty; ``end_id`` (if not None) ends every document. Files follow the order of their part.
    """
    path = path or default_tokenizer()
    ordered = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    rows = split_columns(ordered, "text", special_tokens(path), ["doc_id"])

    def run(batches):
        tokenizer = load(path)
        width = 2 if len(tokenizer.pieces) <= 1 << 16 else 4
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        name, out, stream = new_file("part", ".ids.zst"), None, None
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                stream = files.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)
                out = Writer(stream, width, b.column("doc_id").type)
            order, flat, words = batch_words(b, tokenizer)
            coded = flat.dictionary_encode()
            ids, per_word = spread(coded.indices.to_numpy(zero_copy_only=False), *tokenizer.encode_words(coded.dictionary.to_pylist()))
            cuts = np.r_[0, np.cumsum(per_word)][np.r_[0, np.cumsum(words)]]
            ids, counts = _in_order(ids, cuts, order, end_id)
            out.add(b.column("doc_id"), ids, counts)
        if out is not None:
            figures = out.close()
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (TaskContext.get().partitionId(), f"{folder}/{name}", *figures)],
                                             names=["part", "file", "documents", "tokens", "frames", "bytes"])

    return stage(rows.mapInArrow(run, MANIFEST), "manifest")


def _in_order(ids, cuts, order, end_id):
    """Ids and counts in the rows' own order, with the end id after each row."""
    extra = end_id is not None
    counts = np.empty(len(order), np.int64)
    counts[order] = np.diff(cuts) + extra
    if not extra and (np.diff(order) == 1).all():
        return ids, counts
    starts = np.cumsum(counts) - counts
    out = np.full(int(counts.sum()), end_id if extra else 0, np.uint32)
    lens = np.diff(cuts)
    out[np.arange(len(ids)) + np.repeat(starts[order] - cuts[:-1], lens)] = ids
    return out, counts


def read_documents(manifest, id_type):
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files of ``manifest``, read from them.

    start counts the ids of all documents before; ids_crc32 is over the ids as little-endian 32-bit integers.
    """
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base"))  # one row a file
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                folder, _, file = name.rpartition("/")
                files, at = open_folder(folder)
                with files.open_input_file(f"{at}/{file}") as f:
                    reader, sums = Reader(f), []
                    for row, ids in reader.all():
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if len(sums) == BATCH or row == len(reader.counts) - 1:
                            lo = row + 1 - len(sums)
                            ids_ = reader.doc_ids.slice(lo, len(sums)).combine_chunks()
                            yield pa.RecordBatch.from_arrays(
                                [ids_, pa.array(reader.starts[lo:row + 1] + base), pa.array(reader.counts[lo:row + 1]), pa.array(sums, pa.int64())],
                                names=schema.names)
                            sums = []

    return placed.repartition(max(1, manifest.count())).mapInArrow(run, schema)


def op5_token_files(spark, sf_dir):
    """Every document of the token files, as read back from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write(docs, shared_dir(spark, "token-files"))
    return read_documents(manifest, docs.schema["doc_id"].dataType)
