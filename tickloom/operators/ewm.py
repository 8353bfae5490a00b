"""Exponentially weighted mean (recursive form, seeded at the first value).

y[t] = (1-a) y[t-1] + a x[t], y = x at the first non-null value.  Written as one
running sum inside a block window:  y = A^n * sum(b * A^-n), A = 1 - a, where n
counts the values seen and b is x for the first value and a*x afterwards.

A block is preceded by ``HORIZON`` rows of halo, and the recurrence is started at
the halo's first row.  The weight of everything before it, A^HORIZON, is below the
resolution of a double for all smoothings in use (a >= 1/14), so the result
equals the recurrence from the start of the series.  ``n`` is centred on the
block so the powers stay inside the double range.

There, values must be non-null after the first one; a null carries the last mean.

``ewm`` is the form for any smoothing and any nulls: a scan of the affine maps y -> a y + b, row by row inside small
blocks, then over the blocks in groups, and the groups in groups, so neither the length of a series nor the memory of
the mean matters.
"""
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.sequence import BLOCK_ROWS, SERIES, block_window, join_blocks, with_row_index
from tickloom.session import materialize

HORIZON = 640
_CENTRE = (BLOCK_ROWS + HORIZON) // 2


def check_alpha(alpha):
    """Reject smoothings too slow for the halo or too fast for the powers."""
    decay = -math.log(1 - alpha)
    if decay * HORIZON < 36:
        raise ValueError(f"alpha {alpha} needs a longer halo than {HORIZON} rows; use ewm")
    if decay * (_CENTRE + 1) > 660:
        raise ValueError(f"alpha {alpha} overflows blocks of {BLOCK_ROWS} rows; use ewm")
    return alpha


def span_alpha(span):
    return 2.0 / (span + 1)


def ewm_columns(df, specs, keys=SERIES):
    """Add means to a frame of row blocks with at least ``HORIZON`` rows of halo.

    ``specs`` maps the new column to (input column, alpha).
    """
    run = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    seen = {x: f"_seen_{x}" for x, _ in specs.values()}
    df = df.withColumns({name: F.count(x).over(run) for x, name in seen.items()})
    out = {}
    for name, (x, alpha) in specs.items():
        check_alpha(alpha)
        n = F.col(seen[x]) - _CENTRE
        base = F.lit(1.0 - alpha)
        value = F.when(F.col(seen[x]) == 1, F.col(x)).otherwise(F.col(x) * alpha)
        out[name] = F.pow(base, n) * F.sum(value * F.pow(base, -n)).over(run)
    return df.withColumns(out).drop(*seen.values())


#: Entries that one step of the scan over blocks takes together, and steps; the last one takes what is left.
GROUP, STEPS = 256, 3
#: Least weight of the last mean that is told from none; the powers of a block then stay inside the double range.
GONE = 1e-30


def _before(blocks, keys, steps=STEPS):
    """(keys, _b, _in): the value in front of every block, 0 at the start; ``blocks`` has the map y -> _p y + _y of each."""
    entry = F.struct("_b", "_p", "_y")
    group = F.floor(F.col("_b") / GROUP) if steps > 1 else F.lit(0).cast("long")
    listed = blocks.groupBy(*keys, group.alias("_g")).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    apply = lambda y, x: x["_p"] * y + x["_y"]
    if steps > 1:
        maps = listed.select(*keys, F.col("_g").alias("_b"), F.aggregate("_l", F.lit(1.0), lambda p, x: p * x["_p"]).alias("_p"),
                             F.aggregate("_l", F.lit(0.0), apply).alias("_y"))
        carry = _before(maps, keys, steps - 1).withColumnsRenamed({"_b": "_g", "_in": "_c"})
        listed = listed.transform(join_blocks, carry, [*keys, "_g"])
    else:
        listed = listed.withColumn("_c", F.lit(0.0))
    start = F.struct(F.col("_c").alias("y"), F.array().cast("array<double>").alias("seen"))
    run = F.aggregate("_l", start, lambda s, x: F.struct(apply(s["y"], x).alias("y"), F.concat(s["seen"], F.array(s["y"])).alias("seen")))
    pairs = F.explode(F.arrays_zip(F.col("_l"), run["seen"].alias("s")))
    return listed.select(*keys, pairs.alias("_e")).select(*keys, F.col("_e._l._b").alias("_b"), F.col("_e.s").alias("_in"))


def ewm(df, column, alpha, name, keys=SERIES, time="open_time", seconds=None, tie=()):
    """Add the exponentially weighted mean of ``column`` for any ``alpha`` in (0, 1].

    The first value is the first mean. After a gap of nulls the last mean has the weight (1 - alpha) ** g, g the number
    of rows since its value, and the new value the weight alpha, both divided by their sum; a null row repeats the last
    mean, and rows before the first value have none.
    """
    if not 0 < alpha <= 1:
        raise ValueError(f"alpha must be in (0, 1], not {alpha}")
    decay = -math.log(1 - alpha) if alpha < 1 else math.inf
    size = max(1, min(BLOCK_ROWS, int(600 / decay)))
    x, keys = F.col(column).cast("double"), list(keys)
    rows = with_row_index(df, keys, time, seconds, tie).withColumn("_b", F.floor(F.col("_rn") / size).cast("long"))
    rows = materialize(rows, "indexed")  # read by each step of the scan
    inner = Window.partitionBy(*keys, "_b").orderBy("_rn")
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    valid = F.when(x.isNotNull(), F.col("_rn"))
    # where the last value in front of a block stands
    ends = rows.groupBy(*keys, "_b").agg(F.max(valid).alias("_end"))
    over = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "_b", F.max("_end").over(over).alias("_earlier"))
    rows = rows.transform(join_blocks, ends, [*keys, "_b"])
    last = F.coalesce(F.max(valid).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.col("_earlier"))
    rows = rows.withColumn("_w", F.pow(F.lit(1 - alpha), F.col("_rn") - last))
    first = F.col("_w").isNull()
    rows = rows.withColumns({
        "_a": F.when(x.isNull() | first, 0.0).otherwise(F.ln(F.greatest(F.col("_w") / (F.col("_w") + alpha), F.lit(GONE)))),
        "_v": F.when(x.isNull(), 0.0).when(first, x).otherwise(alpha * x / (F.col("_w") + alpha))})
    rows = rows.withColumn("_s", F.sum("_a").over(upto))
    rows = rows.withColumn("_local", F.exp("_s") * F.sum(F.col("_v") * F.exp(-F.col("_s"))).over(upto))
    maps = rows.groupBy(*keys, "_b").agg(F.max_by("_s", "_rn").alias("_s"), F.max_by("_local", "_rn").alias("_y"))
    carry = _before(maps.select(*keys, "_b", F.exp("_s").alias("_p"), "_y"), keys)
    rows = rows.transform(join_blocks, carry, [*keys, "_b"])
    seen = x.isNotNull() | ~first
    return rows.withColumn(name, F.when(seen, F.col("_local") + F.exp("_s") * F.col("_in"))).drop(
        "_rn", "_b", "_earlier", "_w", "_a", "_v", "_s", "_local", "_in")
