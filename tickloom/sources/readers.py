"""Scans of bar tables and ingestion of bar files."""
from pyspark.sql import functions as F

from tickloom.operators.asof import top_n
from tickloom.operators.sequence import SERIES
from tickloom.session import materialize

REQUIRED_COLUMNS = ["timestamp", "open", "high", "low", "close"]


def series_list(bars):
    return bars.select(*SERIES).distinct().orderBy(*SERIES)


def symbols(bars):
    return bars.select("symbol").distinct()


def range_scan(bars, symbol=None, timeframe=None, start=None, end=None):
    """Inclusive time range of one or all series; plain predicates, so they reach the
    scan and prune the timeframe / symbol partitions."""
    if symbol is not None:
        bars = bars.where(F.col("symbol") == symbol)
    if timeframe is not None:
        bars = bars.where(F.col("timeframe") == timeframe)
    if start is not None:
        bars = bars.where(F.col("open_time") >= start)
    if end is not None:
        bars = bars.where(F.col("open_time") <= end)
    return bars


def tail_scan(bars, n):
    """Last ``n`` bars of every series."""
    return top_n(bars, n)


def minute_times(bars, symbol=None, start=None, end=None):
    """Distinct M1 open times."""
    return range_scan(bars, symbol, "M1", start, end).select("symbol", "open_time").distinct()


def pending(snapshots, column, start=None, end=None):
    """Snapshots still lacking a column."""
    rows = snapshots.where(F.col(column).isNull())
    if start is not None:
        rows = rows.where(F.col("snapshot_time") >= start)
    if end is not None:
        rows = rows.where(F.col("snapshot_time") <= end)
    return rows


def newest_since(df, time, since, limit, tie):
    """The newest ``limit`` rows after ``since``, the last processed time."""
    return df.where(F.col(time) > since).orderBy(F.desc(time), F.desc(tie)).limit(limit)


def column_fill(df, pattern="%"):
    """Per column of a LIKE pattern the rows with and without a value: one pass over the table."""
    names = [r["column_name"] for r in columns_like(df, pattern).collect()]  # the schema's own names
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in names])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled"), (F.col("_n") - F.col(c)).alias("empty")) for c in names])
    return counts.select(F.inline(rows))


def columns_like(df, pattern="%"):
    """Column names and types of a frame as rows, filtered by a LIKE pattern."""
    import re
    rx = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern))
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields) if rx.fullmatch(f.name)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def missing_columns(required, actual):
    return sorted(set(required) - set(actual))


# --- bar files -----------------------------------------------------------------------

def _file_parts(path):
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.split(name, "-")


def read_bar_files(spark, path, time_column="timestamp", symbol=None, timeframe=None):
    """Bars from files named symbol-timeframe-side-from-to.csv with a millisecond epoch
    column; volume is 0. Symbol and timeframe come from the file name unless given.

    Files are read in one distributed scan; file names that cannot be parsed and the
    converter's own outputs are left out (see ``rejected_files``).
    """
    schema = f"{time_column} long, open double, high double, low double, close double"
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("pathGlobFilter", "*.csv").csv(path).withColumn("_file", F.input_file_name()))
    parts = _file_parts(F.col("_file"))
    if symbol is None:
        rows = rows.where(_good_name(F.col("_file")))
    return rows.select(
        (F.lit(symbol) if symbol else F.upper(parts[0])).alias("symbol"),
        (F.lit(timeframe) if timeframe else F.upper(parts[1])).alias("timeframe"),
        F.timestamp_seconds(F.floor(F.col(time_column) / 1000)).alias("open_time"), F.col("open").alias("open_price"),
        F.col("high").alias("high_price"), F.col("low").alias("low_price"), F.col("close").alias("close_price"),
        F.lit(0).cast("long").alias("volume"))


def _good_name(path):
    return (F.size(_file_parts(path)) >= 5) & ~path.endswith("-import.csv")


def _heads(spark, path, required):
    """(file, reason, missing) of every CSV file of a folder; a good one has no reason."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("_file"), "value", F.monotonically_increasing_id().alias("_n"))
    heads = lines.groupBy("_file").agg(F.min_by("value", "_n").alias("_first")).select(
        "_file", F.transform(F.split("_first", ","), lambda c: F.trim(c)).alias("_head"))
    lost = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("_head"))
    return heads.select("_file", F.when(~_good_name(F.col("_file")), "name").when(F.size(lost) > 0, "columns").alias("reason"),
                        F.concat_ws(",", F.array_sort(lost)).alias("missing"))


def rejected_files(spark, path, required=REQUIRED_COLUMNS):
    """File names left out, with the reason: bad name or missing columns (header line).

    The header is the first line of a file's first block; it is found with a map-side
    combining aggregate, so large files are never held whole.
    """
    return _heads(spark, path, required).where("reason is not null").select(
        F.regexp_extract("_file", r"([^/]+)$", 1).alias("file_name"), "reason", "missing")


def read_bar_folder(spark, path, required=REQUIRED_COLUMNS):
    """(bars of the good files, rejected files) of a folder that may hold anything named *.csv. The names of the good files come
    to the driver, which lists the folder anyway; a folder without any gives no bars."""
    heads = materialize(_heads(spark, path, required), "heads")
    good = [r["_file"] for r in heads.where("reason is null").select("_file").collect()]
    rejected = heads.where("reason is not null").select(F.regexp_extract("_file", r"([^/]+)$", 1).alias("file_name"), "reason", "missing")
    bars = read_bar_files(spark, good) if good else read_bar_files(spark, path).where(F.lit(False))
    return bars, rejected
