"""Indicators of stored rows that lack some, computed from the blocks around those rows only.

One aggregate per time block (4,096 slots of the timeframe) counts rows and rows with a null, so the row blocks
that need work are known before any bar moves. Only the time blocks those row blocks and their halo reach into are
read, shuffled and computed; complete blocks elsewhere are never touched.

On-balance volume sums over the whole series. It goes on from the stored value of the newest row of the latest block
without nulls, so its movement is computed inside the blocks that are read and nowhere else.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import INDICATOR_COLUMNS
from tickloom.functions.classify import any_null
from tickloom.operators.ewm import HORIZON
from tickloom.operators.indicators import block_indicators, obv_moves, obv_step
from tickloom.operators.sequence import BLOCK_ROWS, SERIES, join_blocks, prefix_over_blocks, tf_seconds, time_block
from tickloom.session import materialize

INPUTS = ["high_price", "low_price", "close_price", "volume"]


def block_summary(stored, columns=INDICATOR_COLUMNS):
    """One row per series and time block: rows, incomplete rows, rows before it, edge values and newest stored obv."""
    cut = stored.withColumn("_tb", time_block("open_time", tf_seconds() * BLOCK_ROWS))
    rows = cut.groupBy(*SERIES, "_tb").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(any_null(columns)).alias("_open"),
        F.min_by("close_price", "open_time").alias("_first"), F.min_by("volume", "open_time").alias("_first_v"),
        F.max_by("close_price", "open_time").alias("_last"),
        (F.max_by("obv", "open_time") if "obv" in columns else F.lit(None).cast("double")).alias("_end"))
    rows = rows.withColumn("_step", obv_step(Window.partitionBy(*SERIES).orderBy("_tb")))
    return prefix_over_blocks(rows, SERIES, "_tb", {"_n": "_before"}, keep=["_n", "_open", "_step", "_end"])


def _row_blocks(first, last):
    return F.explode(F.sequence(F.floor(first / BLOCK_ROWS).cast("long"), F.floor(last / BLOCK_ROWS).cast("long")))


def incomplete_blocks(summary):
    """(series, _blk): the row blocks that may hold an incomplete row."""
    last = F.col("_before") + F.col("_n") - 1
    return summary.where("_open > 0").select(*SERIES, _row_blocks(F.col("_before"), last).alias("_blk")).distinct()


def _carried(needed, rows):
    """Value of obv before each needed time block: the end of the latest complete block plus the movements since."""
    moved = rows.groupBy(*SERIES, "_tb").agg(F.sum("_move").alias("_moved"))
    blocks = join_blocks(needed, moved, [*SERIES, "_tb"])
    before = Window.partitionBy(*SERIES).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*SERIES).orderBy("_tb").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("_sum", F.sum(F.col("_step") + F.col("_moved")).over(upto))
    anchor = F.when(F.col("_open") == 0, F.struct(F.col("_end").alias("at"), F.col("_sum").alias("sum")))
    blocks = (blocks.withColumn("_anchor", F.last(anchor, ignorenulls=True).over(before))
              .withColumn("_start", F.coalesce(F.lag("_sum").over(Window.partitionBy(*SERIES).orderBy("_tb")), F.lit(0.0))))
    # a block whose predecessor is not read begins at that one's stored end
    chain = F.coalesce(F.col("_start") - F.col("_anchor")["sum"] + F.col("_anchor")["at"], F.col("_start"))
    return blocks.withColumn("_carry", F.coalesce("_prev_end", chain)).select(*SERIES, "_tb", "_carry", "_step")


def incomplete_indicators(stored, columns=INDICATOR_COLUMNS):
    """Key and ``columns`` of every row of the row blocks that hold an incomplete row; other blocks give no row.

    ``stored`` (symbol, timeframe, open_time, prices, volume, ``columns``) is read twice and should be a stored
    table with one row per key; a stored obv must come from the same rule, as later blocks go on from it. Rows whose indicators
    are null by definition (the first of a series) count as incomplete, so the first block of a series is always
    computed. Null symbols and times are series of their own; an empty table gives no rows.
    """
    summary = materialize(block_summary(stored, columns), "blocks")
    prev = Window.partitionBy(*SERIES).orderBy("_tb")
    complete_end = F.when(F.col("_open") == 0, F.col("_end"))
    summary = summary.withColumn("_prev_end", F.lag(complete_end).over(prev))
    wanted = incomplete_blocks(summary)
    reach = summary.withColumn("_blk", _row_blocks(F.col("_before"), F.col("_before") + F.col("_n") - 1 + HORIZON))
    keep = [c for c in summary.columns if c not in (*SERIES, "_tb")]
    needed = join_blocks(reach, wanted.withColumn("_w", F.lit(True)), [*SERIES, "_blk"]).select(*SERIES, "_tb", *keep).distinct()
    cut = stored.select(*SERIES, "open_time", *INPUTS).withColumn("_tb", time_block("open_time", tf_seconds() * BLOCK_ROWS))
    rows = join_blocks(cut, needed.select(*SERIES, "_tb", "_before"), [*SERIES, "_tb"])
    inner = Window.partitionBy(*SERIES, "_tb").orderBy("open_time")
    rows = obv_moves(rows.withColumn("_rn", F.col("_before") + F.row_number().over(inner) - 1), inner).drop("_before")
    indexed = rows
    if "obv" in columns:
        carry = _carried(needed, rows)
        indexed = join_blocks(rows, carry, [*SERIES, "_tb"]).withColumn(
            "obv", F.col("_carry") + F.col("_step") + F.col("_obv")).drop("_carry", "_step")
    indexed = indexed.drop("_tb", "_move", "_obv")
    own = F.floor(F.col("_rn") / BLOCK_ROWS).cast("long")
    targets = F.array(own, F.when(F.col("_rn") % BLOCK_ROWS >= BLOCK_ROWS - HORIZON, own + 1))
    blocks = indexed.withColumn("_blk", F.explode(F.array_compact(targets))).withColumn("_halo", F.col("_blk") != own)
    blocks = join_blocks(blocks, wanted.withColumn("_w", F.lit(True)), [*SERIES, "_blk"]).drop("_w")
    return block_indicators(blocks, [*SERIES, "open_time"], columns)
