"""Row-sequence and time-range frames that never put a whole series in one task.

A series (symbol, timeframe) may hold a third of all bars, so a plain
``Window.partitionBy(series)`` would leave one task with all of them.  Here each
series is cut into blocks of bounded size, and every block is given the few
neighbouring rows (the halo) its frames reach into:

* row frames:  bars get a dense row index per series (a two-level count: rows per
  time block, then a prefix sum over the blocks), blocks are ``BLOCK_ROWS`` rows;
* time frames: blocks are fixed time spans.

Rows of the halo are computed but dropped again by ``drop_halo``.
"""
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import TF_SECONDS, TICK_TF_SECONDS

SERIES = ["symbol", "timeframe"]
BLOCK_ROWS = 4096


def literal_map(values):
    """Literal map expression from a small dict of fixed values."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def tf_seconds(timeframe="timeframe"):
    """Span of a timeframe, of the bar and the tick tools alike; an unknown or null one is an error, not a lost row."""
    known = {k: v for k, v in (TICK_TF_SECONDS | TF_SECONDS).items() if v}
    name = F.coalesce(F.col(timeframe), F.lit("null"))
    unknown = F.raise_error(F.concat(F.lit("unknown timeframe: "), name)).cast("int")
    return F.coalesce(literal_map(known)[name], unknown)


def join_blocks(rows, summary, keys):
    """Inner join on ``keys`` in which nulls (of a series or a time) match each other, so that no row is lost."""
    named = summary.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return rows.join(named, same).drop(*[f"_k_{k}" for k in keys])


def epoch(col):
    """Seconds since 1970 of a timestamp column."""
    return F.unix_seconds(F.col(col) if isinstance(col, str) else col)


def time_block(time_col, seconds):
    """Number of the time span of ``seconds`` length a timestamp falls into."""
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.floor(epoch(time_col) / seconds).cast("long")


def prefix_over_blocks(summary, keys, block, columns, keep=()):
    """Exclusive prefix sums of ``columns`` over the blocks of each key.

    ``summary`` has one row per block; the blocks of a key number (time range /
    block span), which does not grow with the number of rows.
    """
    w = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*keys, block, *keep, *[
        F.coalesce(F.sum(src).over(w), F.lit(0)).alias(dst) for src, dst in columns.items()])


def with_row_index(df, keys=SERIES, time="open_time", seconds=None, tie=()):
    """Add ``_rn``: dense 0-based position of the row in its series, by time and then the columns ``tie``.

    ``seconds`` is the span of the counting blocks; the default, 4096 bars of the
    row's timeframe, bounds a block at 4096 rows because bars are unique per slot.
    """
    span = seconds if seconds is not None else tf_seconds() * BLOCK_ROWS
    cut = df.withColumn("_tb", time_block(time, span))
    counts = cut.groupBy(*keys, "_tb").agg(F.count(F.lit(1)).alias("_n"))
    offsets = prefix_over_blocks(counts, keys, "_tb", {"_n": "_before"})
    inner = Window.partitionBy(*keys, "_tb").orderBy(time, *tie)
    return (cut.withColumn("_pos", F.row_number().over(inner))
            .transform(join_blocks, offsets, [*keys, "_tb"])
            .withColumn("_rn", F.col("_before") + F.col("_pos") - 1)
            .drop("_tb", "_pos", "_before"))


def row_blocks(indexed, halo, size=BLOCK_ROWS, after=0):
    """Assign rows to row blocks and copy the last ``halo`` rows of a block to the
    next one (and the first ``after`` rows to the previous one)."""
    if max(halo, after) > size:
        size = max(halo, after)
    own = F.floor(F.col("_rn") / size).cast("long")
    inside = F.col("_rn") % size
    targets = [own]
    if halo:
        targets.append(F.when(inside >= size - halo, own + 1))
    if after:
        targets.append(F.when((inside < after) & (own > 0), own - 1))
    df = indexed.withColumn("_blk", F.explode(F.array_compact(F.array(*targets))))
    return df.withColumn("_halo", F.col("_blk") != own)


def range_blocks(df, back=0, ahead=0, time="open_time", width=86400):
    """Assign rows to time blocks of ``width`` seconds so that frames reaching
    ``back`` / ``ahead`` seconds are complete for every own row of a block."""
    t = epoch(time)
    own = F.floor(t / width).cast("long")
    first = F.floor((t - ahead) / width).cast("long")
    last = F.floor((t + back) / width).cast("long")
    df = df.withColumn("_blk", F.explode(F.sequence(first, last)))
    return df.withColumn("_halo", F.col("_blk") != own).withColumn("_t", t)


def block_window(keys=SERIES, order="_rn"):
    return Window.partitionBy(*keys, "_blk").orderBy(order)


def rows_back(n, keys=SERIES):
    """Frame of the last ``n`` rows including the current one."""
    return block_window(keys).rowsBetween(-(n - 1), 0)


def drop_halo(df):
    keep = [c for c in df.columns if c not in ("_blk", "_halo", "_rn", "_t")]
    return df.where(~F.col("_halo")).select(*keep)


def full(agg, x, frame, n):
    """``agg`` over ``frame``, null until the frame holds ``n`` non-null values."""
    return F.when(F.count(x).over(frame) == n, agg.over(frame))


def rolling(df, columns, halo, keys=SERIES, time="open_time", after=0, seconds=None, tie=()):
    """Add row-frame columns. ``columns`` maps a name to an expression built on
    ``block_window`` / ``rows_back``; entries may use the ones before them."""
    out = row_blocks(with_row_index(df, keys, time, seconds, tie), halo, after=after)
    for name, expr in columns.items():
        out = out.withColumn(name, expr)
    return drop_halo(out)


def ranged(df, columns, back=0, ahead=0, keys=SERIES, time="open_time", width=86400):
    """Add time-frame columns; expressions use ``block_window(keys, '_t')``."""
    out = range_blocks(df, back, ahead, time, width)
    for name, expr in columns.items():
        out = out.withColumn(name, expr)
    return drop_halo(out)


def running_total(df, value, name, keys=SERIES, time="open_time", seconds=None):
    """Add the running sum of ``value`` per series: sums inside time blocks plus
    the prefix sum of the block totals."""
    span = seconds if seconds is not None else tf_seconds() * BLOCK_ROWS
    cut = df.withColumn("_tb", time_block(time, span)).withColumn("_v", value)
    totals = cut.groupBy(*keys, "_tb").agg(F.sum("_v").alias("_s"))
    carry = prefix_over_blocks(totals, keys, "_tb", {"_s": "_carry"})
    inner = Window.partitionBy(*keys, "_tb").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return (cut.withColumn("_in", F.sum("_v").over(inner))
            .transform(join_blocks, carry, [*keys, "_tb"])
            .withColumn(name, F.col("_carry") + F.coalesce(F.col("_in"), F.lit(0)))
            .drop("_tb", "_v", "_in", "_carry"))
