"""A bar table that takes late and corrected bars by appending: merge on read, with compaction.

Folder layout: ``base`` holds the compacted bars by timeframe, symbol and day, ``log/batch=N`` what batch N brought. A
batch is one small append, whatever partitions it touches. Readers merge base and log; ``merge_bars`` gives the same
result however often a change is merged, so neither a repeated batch nor a compaction that was cut short does harm.
``compact`` rewrites the partitions that the log touches, and only those, then drops the folders it has merged.
"""
from pyspark.sql import functions as F

from tickloom.sources.sinks import BAR_KEY, merge_bars, overwrite_partitions, write_spread

BY = ("timeframe", "symbol", "day")
#: Batches in the log from which it is compacted.
COMPACT_AFTER = 8


def _files(spark, path):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def batches(spark, path):
    """Paths of the log's complete batches, oldest first."""
    fs, folder = _files(spark, f"{path}/log")
    if not fs.exists(folder):
        return []
    found = [str(s.getPath()) for s in fs.listStatus(folder)]
    return sorted(p for p in found if fs.exists(_files(spark, f"{p}/_SUCCESS")[1]))


def _with_day(bars):
    return bars.withColumn("day", F.to_date("open_time"))


def create(bars, path, by=BY):
    """A new table of ``bars``."""
    write_spread(_with_day(bars), f"{path}/base", by, mode="overwrite")


def append(bars, path, batch_id):
    """Log the bars of a batch; the same batch again replaces itself. Few files, as the batch is sized first."""
    write_spread(_with_day(bars), f"{path}/log/batch={batch_id:012d}", (), mode="overwrite")


def _base(spark, path):
    fs, folder = _files(spark, f"{path}/base")
    return spark.read.parquet(f"{path}/base") if fs.exists(folder) else None


def _log(spark, paths):
    # an explicit list, not the whole folder: a batch that is being written is not read
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read(spark, path, where=None, keys=BAR_KEY):
    """The table as of now; ``where`` is a condition on the partition columns and prunes base and log."""
    base, log = _base(spark, path), batches(spark, path)
    if base is None and not log:
        raise ValueError(f"no bar table at {path}")
    pick = lambda df: df if where is None else df.where(where)
    if not log:
        return pick(base)
    new = pick(_log(spark, log))
    return _with_day(merge_bars(pick(base) if base is not None else new.limit(0), new, keys=keys))


def compact(spark, path, by=BY, keys=BAR_KEY):
    """Merge the log into the base partitions it touches."""
    log = batches(spark, path)
    if not log:
        return
    new, base = _log(spark, log), _base(spark, path)
    if base is None:
        touched = new.limit(0)
    else:
        touched = base.join(new.select(*by).distinct(), list(by), "left_semi")
    overwrite_partitions(_with_day(merge_bars(touched, new, keys=keys)), f"{path}/base", by)
    for p in log:
        fs, folder = _files(spark, p)
        fs.delete(folder, True)


def merge_into(path, by=BY, compact_after=COMPACT_AFTER):
    """Micro-batch handler: append each batch to the log and compact it from time to time."""
    def handle(batch, batch_id):
        spark = batch.sparkSession
        append(batch, path, batch_id)
        if len(batches(spark, path)) >= compact_after:
            compact(spark, path, by)
    return handle
