"""Helpers the operators of this subpackage share."""
import ctypes

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import materialize, shared_dir

__all__ = ["append", "content_key", "discard", "give_back", "read", "shared_dir", "small", "stage", "words_of"]


def read(spark, sf_dir, table):
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df, name):
    """Write ``df`` once to the shared folder and read it back (see ``materialize``)."""
    return materialize(df, name)


def discard(*stored):
    """Delete the folders of staged tables that nothing reads any more, so that rounds do not pile up on disk."""
    for df in stored:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Rows up to which ``small`` lets a table of a few narrow columns go to every task.
SMALL_ROWS = 1_000_000


def small(stored, rows=SMALL_ROWS):
    """A stored table of narrow rows, marked for broadcast if a count shows at most ``rows``; a larger one is left to a
    shuffle join with the same result."""
    return F.broadcast(stored) if stored.count() <= rows else stored


def give_back():
    """Return freed memory to the system. Python workers serve one task after another, and their allocators would keep
    what a batch of long texts needed once, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Rows that ``append`` hands to its function at once, to keep the memory of a task low.
ROWS = 2048


def append(df, fn, fields, keep=None):
    """``df[keep]`` with the columns ``fields`` that ``fn`` makes of each Arrow batch.

    ``fn(batch)`` returns one Arrow array per field. A kept column with the name of a new one is
    replaced; every other value passes through unchanged.
    """
    new = {f.name.lower() for f in fields}
    keep = [c for c in (keep or df.columns) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in keep] + list(fields))
    names = schema.names

    def run(batches):
        for whole in batches:
            b = None
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + list(fn(b)), names=names)
            del whole, b
            give_back()

    return df.mapInArrow(run, schema)


def content_key(text):
    """Two independent 64-bit hashes of a text: equal texts, and in practice only those, share both."""
    return [F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit(1), text).alias("__k2")]


def words_of(text):
    """Lower-cased words between ASCII white space; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), "")
