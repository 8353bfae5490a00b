"""Keyed merges and writers.

Merges are joins on the full key that return the new table; ``overwrite_partitions``
stores a result whose input is the table being replaced.
"""
from pyspark.sql import functions as F

from tickloom.constants import INDICATOR_COLUMNS
from tickloom.functions.classify import any_null
from tickloom.operators.incomplete import incomplete_indicators
from tickloom.session import materialize, shared_dir

SNAPSHOT_KEY = ["symbol", "snapshot_time"]
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
BAR_KEY = ["symbol", "timeframe", "open_time"]


def _sides(old, new, keys, how):
    n = new.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys])
    return old.withColumn("_old", F.lit(True)).join(n, keys, how)


def upsert(old, new, keys=SNAPSHOT_KEY, columns=None, extras=(), extras_on_insert=True):
    """Insert new keys, set ``columns`` on existing ones; other columns stay as they are.

    ``extras`` are further columns of ``new``; with ``extras_on_insert=False`` they only
    apply to keys that existed before.
    """
    columns = columns or [c for c in new.columns if c not in keys and c not in extras]
    rows = _sides(old, new, keys, "full")
    out = []
    for c in dict.fromkeys([*old.columns, *columns, *extras]):
        before = F.col(c) if c in old.columns else F.lit(None)
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(before).alias(c))
        elif c in extras:
            applies = F.col("_new") & (F.lit(True) if extras_on_insert else F.coalesce(F.col("_old"), F.lit(False)))
            out.append(F.when(applies, F.col(f"_n_{c}")).otherwise(before).alias(c))
        else:
            out.append(before.alias(c))
    return rows.select(*out)


def insert_absent(old, new, keys=SNAPSHOT_KEY):
    """Append rows whose key is not there yet."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def skip_existing(new, old, keys=SNAPSHOT_KEY, overwrite=False):
    """Rows to work on: all when overwriting, else those without a stored row."""
    return new if overwrite else new.join(old.select(*keys), keys, "left_anti")


def update(old, new, keys=BAR_KEY, columns=INDICATOR_COLUMNS, only_incomplete=False):
    """Set ``columns`` from ``new`` on matching rows, optionally only where one is null: then complete rows pass by without a join."""
    if only_incomplete:
        rest = any_null(columns)
        return old.where(~rest).unionByName(update(old.where(rest), new, keys, columns))
    rows = _sides(old, new, keys, "left")
    hit = F.coalesce(F.col("_new"), F.lit(False))
    return rows.select(*[F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
                         for c in old.columns])


def update_set(stored, computed, keys=BAR_KEY, columns=INDICATOR_COLUMNS):
    """Computed values for the stored rows that still have a null indicator."""
    return stored.where(any_null(columns)).select(*keys).join(computed.select(*keys, *columns), keys, "left")


def fill_incomplete(stored, columns=INDICATOR_COLUMNS):
    """A stored table with the indicators of its incomplete rows filled in, computed from the blocks around those rows."""
    return update(stored, incomplete_indicators(stored, columns), BAR_KEY, columns, only_incomplete=True)


def merge_bars(old, new, order="ingest_time", keys=BAR_KEY):
    """Conflicting bars: highest high, lowest low, newest close / volume / spread, first open."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.groupBy(*keys).agg(
        F.min_by("open_price", order).alias("open_price"), F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"), F.max_by("close_price", order).alias("close_price"),
        F.max_by("volume", order).alias("volume"), F.max_by("spread", order).alias("spread"),
        F.max(order).alias(order))


def patch_latest(bars, patch, columns=("spread",)):
    """Set columns on the newest bar of each series from ``patch`` (symbol, timeframe, ...)."""
    newest = bars.groupBy("symbol", "timeframe").agg(F.max("open_time").alias("open_time"))
    return update(bars, newest.join(patch, ["symbol", "timeframe"]), BAR_KEY, list(columns))


def attach_to_latest(bars, documents, column="snapshot"):
    """Put a symbol's document on its newest bar of every timeframe."""
    newest = bars.groupBy("symbol", "timeframe").agg(F.max("open_time").alias("open_time"))
    rows = newest.join(documents.select("symbol", column), "symbol")
    return bars.join(rows, BAR_KEY, "left")


def delete_where(table, condition):
    """Rows kept after a selective delete (nulls in the condition keep the row)."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def add_columns(table, fields):
    """Add absent columns (name -> type) as nulls."""
    return table.withColumns({n: F.lit(None).cast(t) for n, t in fields.items() if n not in table.columns})


# --- writers -----------------------------------------------------------------------

PER_FILE = 5000000


def write_spread(df, path, by, mode, per_file=PER_FILE, time="open_time"):
    """Write ``df`` by the columns ``by`` with as few files as its size needs: rows of a partition go to one task, a
    partition of more than ``per_file`` rows to as many tasks as it has that many rows. Overwriting replaces only
    partitions that are in ``df``. ``df`` should be stored, as it is counted first."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    parts = -(-sizes // per_file) or 1
    salt = F.pmod(F.xxhash64(time), F.lit(parts))
    spread = df.repartition(*by, salt) if by else df.repartition(parts)
    writer = spread.sortWithinPartitions(*by, time).write.mode(mode)
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(path)


def overwrite_partitions(df, path, by=("timeframe", "symbol"), per_file=PER_FILE, time=None):
    """Replace the partitions present in ``df``. The result is stored first because it may
    be computed from the very table."""
    time = time or ("open_time" if "open_time" in df.columns else next(c for c in df.columns if c not in by))
    write_spread(materialize(df, "staged"), path, by, "overwrite", per_file, time)


def write_bars(bars, path):
    """Whole bar table, partitioned by timeframe and symbol."""
    (bars.repartitionByRange("timeframe", "symbol", "open_time").sortWithinPartitions("timeframe", "symbol", "open_time")
     .write.mode("overwrite").partitionBy("timeframe", "symbol").parquet(path))


def append_log(rows, path):
    rows.write.mode("append").parquet(path)


def last_log_rows(log, n=24, time="timestamp"):
    return log.orderBy(F.desc(time)).limit(n)


def write_json(df, path, pretty=False):
    (df.write.mode("overwrite").option("ignoreNullFields", False).option("pretty", pretty)
     .option("timestampFormat", TIME_FORMAT).json(path))


def fixed(c, digits=5):
    """Number as text with exactly ``digits`` decimals."""
    return F.format_string(f"%.{digits}f", F.col(c)).alias(c)


def _tick_lines():
    return [F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSS").alias("time"), fixed("ask"), fixed("bid"), "ask_volume", "bid_volume"]


def _candle_lines():
    price = lambda c, name: F.format_string("%.5f", F.col(c)).alias(name)
    return [F.date_format("open_time", "yyyy-MM-dd HH:mm:ss").alias("time"), price("open_price", "open"), price("close_price", "close"),
            price("high_price", "high"), price("low_price", "low")]


#: File name of a symbol and a range of days.
RANGE_NAME = "{symbol}-{first}-{last}.csv"


def _named_files(rows, time, lines, folder, days, header, tie=()):
    """One file per symbol and range of ``days`` days, its lines in time order, named by both.

    The rows of a file go to one task, which sorts them; ranges are counted from 1970, so the size of a file follows
    ``days`` and not the history. Spark writes the files in folders by range; then each is given its name, which
    moves no data. Rows without a symbol or a time belong to no file and are left out.
    """
    span = days * 86400
    first = F.timestamp_seconds(F.floor(F.unix_seconds(time) / span) * span)
    text = lambda t: F.date_format(t, "yyyy_MM_dd")
    last = F.timestamp_seconds(F.unix_seconds(first) + span - 86400)
    cut = rows.where(F.col("symbol").isNotNull() & F.col(time).isNotNull()).withColumns({"_first": text(first), "_last": text(last)})
    by = ["symbol", "_first", "_last"]
    made = (cut.repartition(*by).sortWithinPartitions(*by, time, *tie)
            .select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(by)], *lines))
    spark = rows.sparkSession
    staged = shared_dir(spark, "files")
    made.write.option("header", header).partitionBy("_0", "_1", "_2").csv(staged)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for status in fs.globStatus(path(f"{staged}/_0=*/_1=*/_2=*/part-*")):
        source = status.getPath()
        values = [unescape(p.split("=", 1)[1]) for p in source.getParent().toString().rsplit("/", 3)[1:]]
        target = path(f"{folder}/{RANGE_NAME.format(symbol=values[0], first=values[1], last=values[2])}")
        fs.delete(target, False)
        fs.rename(source, target)


def write_tick_files(ticks, folder, days=1, header=False, tie=()):
    """Tick files: time, ask, bid, ask_volume, bid_volume with 5 decimals; ``tie`` orders ticks of equal time."""
    _named_files(ticks, "time", _tick_lines(), folder, days, header, tie)


def write_candle_files(bars, folder, days=31, header=False):
    """Candle files: time, open, close, high, low with 5 decimals."""
    _named_files(bars, "open_time", _candle_lines(), folder, days, header)


def write_candle_csv(bars, path, header=False):
    """All bars as one ordered set of files: time, open, close, high, low with 5 decimals."""
    bars.sort("open_time").select(*_candle_lines()).write.mode("overwrite").option("header", header).csv(path)
