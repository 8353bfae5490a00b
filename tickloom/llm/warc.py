"""WARC archives through a table of chunks.

Payloads become rows of (record id, chunk number, bytes), made by Spark where the page is; the writer streams
them into one gzip member per record and never holds a record. The reader streams the members back into the
same kind of rows, each with the payload size and SHA-256 of all bytes so far, so the last chunk of a record
carries the digest of the whole. Memory is bounded by the chunk size on both sides.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the smallest page id (nulls last, then
the earliest row) is a response, the others are revisits without a body that refer to it.

Every attempt of a task writes to a file of its own name and returns an index row per record; the stored index
holds the rows of finished tasks only.
"""
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import read, shared_dir, stage
from tickloom.llm.files import new_file, open_folder

CHUNK = 64 * 1024
REVISIT_BYTES = 100
READ = 256 * 1024
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
INDEX = "file string, offset long, length long, record_id string, record_type string"
BATCH = 512


def _record_id(*parts):
    h = F.md5(F.concat_ws(":", *parts))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cuts))


def records(pages, page_id="page_id", url="url", html="html"):
    """One row per page: page_id, url, payload, its size and digest, record_id, record_type, refers_to and its record."""
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"),
                        F.monotonically_increasing_id().alias("row"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id"), F.col("row"))
    equal = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min(order).alias("first")).where("copies > 1")
    equal = equal.select("payload_digest", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    rows = rows.join(equal, "payload_digest", "left")
    again = F.col("first_row").isNotNull() & (F.col("row") != F.col("first_row"))
    own = _record_id("payload_digest", F.col("page_id").cast("string"), F.col("row").cast("string"))
    first = _record_id("payload_digest", F.col("first_id").cast("string"), F.col("first_row").cast("string"))
    return rows.select("page_id", "url", "payload", "payload_bytes", "payload_digest", own.alias("record_id"),
                       F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, first).alias("refers_to_record"))


def chunks(rows, size=CHUNK):
    """The chunk rows of ``records``, those of a record next to each other in order; a revisit has one empty chunk."""
    sent = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("payload_bytes"))
    n = F.greatest(F.ceil(sent / size), F.lit(1)).cast("int")
    rows = rows.select("*", n.alias("n_chunks"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    data = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.substring("payload", F.col("chunk") * size + 1, F.lit(size)))
    return rows.select("record_id", "chunk", "n_chunks", data.alias("data"), "record_type", "page_id", "url", "payload_bytes",
                       "payload_digest", "refers_to", "refers_to_record")


def _header(r):
    """The WARC header and the HTTP header of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n".encode()
    body = 0 if r["record_type"] == "revisit" else r["payload_bytes"]
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {DATE}"]
    if r["url"] is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in r["url"]))
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + body}",
              f"WARC-Payload-Digest: sha256:{r['payload_digest']}", f"X-Payload-Length: {r['payload_bytes']}"]
    if r["page_id"] is not None:
        lines.append(f"X-Page-ID: {r['page_id']}")
    if r["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{r['refers_to_record']}>"]
        if r["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page-ID: {r['refers_to']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write(pages, folder, level=6):
    """Write the archives of ``pages``; the stored index with one row per record.

    A null page is an empty payload; a null url or page id leaves out its header; line ends in a url are escaped.
    Rows that repeat a page id are records of their own.
    """
    def run(batches):
        out = base = name = member = None
        at = start = expected = 0
        rows = []
        for b in batches:
            names = [c for c in b.schema.names if c != "data"]
            data = b.column("data")
            for k, r in enumerate(b.select(names).to_pylist()):
                if out is None:
                    files, base = open_folder(folder)
                    files.create_dir(base, recursive=True)
                    name = new_file("part", ".warc.gz")
                    out = files.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)
                if r["chunk"] != expected:
                    raise RuntimeError("the chunks of a record are not in order")
                if r["chunk"] == 0:
                    member, start = zlib.compressobj(level, zlib.DEFLATED, 31), at
                    at += out.write(member.compress(_header(r)))
                at += out.write(member.compress(data[k].as_py()))
                expected = r["chunk"] + 1
                if expected == r["n_chunks"]:
                    at += out.write(member.compress(b"\r\n\r\n") + member.flush())
                    rows.append((f"{folder}/{name}", start, at - start, r["record_id"], r["record_type"]))
                    expected = 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "offset", "length", "record_id", "record_type"])
                rows = []
        if out is not None:
            out.close()

    return stage(chunks(records(pages)).mapInArrow(run, INDEX), "warc-index")


class Members:
    """Bytes of consecutive gzip members, with a bounded buffer."""

    def __init__(self, file):
        self.file, self.inflate, self.ahead, self.have = file, zlib.decompressobj(31), b"", bytearray()

    def _more(self):
        while True:
            if self.inflate.eof:
                self.ahead = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
            raw = self.ahead or self.file.read(READ)
            if not raw:
                return False
            got = self.inflate.decompress(raw, READ)
            self.ahead = self.inflate.unconsumed_tail
            if got:
                self.have += got
                return True

    def line(self):
        """The next line without its end; None at the end of the file."""
        while (end := self.have.find(b"\r\n")) < 0:
            if not self._more():
                return None
        line = bytes(self.have[:end])
        del self.have[:end + 2]
        return line

    def some(self, most):
        """One to ``most`` of the next bytes."""
        if not self.have and not self._more():
            raise ValueError("the archive ends within a record")
        part = bytes(self.have[:most])
        del self.have[:most]
        return part


def parse(file, size=CHUNK):
    """Chunk rows of an archive: dicts with the record's headers, chunk number, data, bytes and digest so far, last."""
    source = Members(file)
    while (line := source.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while line := source.line():
            key, _, value = line.decode().partition(":")
            head[key.lower()] = value.strip()
        left = int(head["content-length"])
        while (line := source.line()) is not None:
            left -= len(line) + 2
            if not line:
                break
        digest, done, chunk, held = hashlib.sha256(), 0, 0, b""
        while left or chunk == 0:
            while left and len(held) < size:
                part = source.some(min(left, size - len(held)))
                held, left = held + part, left - len(part)
            digest.update(held)
            done += len(held)
            yield head, chunk, held, done, digest.copy().hexdigest(), left == 0
            chunk, held = chunk + 1, b""


def read_chunks(index, id_type=None, with_data=True):
    """Chunk rows of every record of the archives in ``index``, read from the files.

    A revisit has one row, with the payload size and digest its header names.
    """
    id_type = id_type or T.LongType()
    schema = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("page_id", id_type),
                           T.StructField("record_type", T.StringType()), T.StructField("refers_to", id_type),
                           T.StructField("refers_to_record", T.StringType()), T.StructField("chunk", T.IntegerType()),
                           T.StructField("data", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
                           T.StructField("payload_digest", T.StringType()), T.StructField("last", T.BooleanType())])
    files = index.select("file").distinct()
    number = id_type.typeName() in ("long", "integer", "short", "byte")
    as_id = lambda x: None if x is None else int(x) if number else x

    def run(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                folder, _, file = name.rpartition("/")
                store, at = open_folder(folder)
                rows, held = [], 0
                with store.open_input_stream(f"{at}/{file}", compression=None, buffer_size=READ) as f:
                    for head, chunk, data, done, digest, last in parse(f):
                        if head["warc-type"] == "revisit":
                            done, digest = int(head["x-payload-length"]), head["warc-payload-digest"].partition(":")[2]
                        refers = head.get("warc-refers-to")
                        rows.append((head["warc-record-id"].strip("<>"), as_id(head.get("x-page-id")), head["warc-type"],
                                     as_id(head.get("x-refers-to-page-id")), refers and refers.strip("<>"), chunk,
                                     data if with_data else None, done, digest, last))
                        held += len(data) if with_data else 0
                        if len(rows) == BATCH or held > 1 << 24:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    arrow = {"long": pa.int64(), "integer": pa.int32(), "short": pa.int16(), "byte": pa.int8()}.get(id_type.typeName(), pa.string())
    types = [pa.string(), arrow, pa.string(), arrow, pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

    return files.repartition(max(1, files.count())).mapInArrow(run, schema)


def op3_warc(spark, sf_dir):
    """Every page as read back from the archives; revisits take size and digest from the record they refer to."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = write(pages, shared_dir(spark, "warc"))
    read_back = stage(read_chunks(index, pages.schema["page_id"].dataType, with_data=False).where("last").drop("data"), "warc-read")
    whole = read_back.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    revisits = read_back.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(whole, "refers_to_record")
    revisits = revisits.withColumnsRenamed({"b": "payload_bytes", "d": "payload_digest"})
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read_back.where("record_type = 'response'").select(*columns).union(revisits.select(*columns))


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
s AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
g AS (SELECT payload_digest, min(page_id) AS first, count(*) AS n FROM s WHERE payload_bytes >= 100 GROUP BY 1)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
  CASE WHEN g.n > 1 AND s.page_id <> g.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.n > 1 AND s.page_id <> g.first THEN g.first END AS refers_to
FROM s LEFT JOIN g USING (payload_digest)
"""
