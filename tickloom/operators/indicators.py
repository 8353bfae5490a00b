"""The sixteen stored indicators and the extra ones of the feature table.

All row-frame work of one bar frame shares a single block shuffle: rolling
frames, the true range family and the exponentially weighted means are columns
over the same (symbol, timeframe, block) window.
"""
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import INDICATOR_COLUMNS
from tickloom.operators.ewm import HORIZON, ewm_columns, span_alpha
from tickloom.operators.sequence import (BLOCK_ROWS, SERIES, block_window, drop_halo, full, join_blocks, prefix_over_blocks,
                                         row_blocks, rows_back, tf_seconds, time_block, with_row_index)

WILDER = 1.0 / 14


def nullif(x, value=0):
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x != value, x)


def ratio(a, b):
    """a / b, null where b is 0 or null (ANSI division would raise)."""
    return F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def obv_moves(rows, inner):
    """Signed volume of each row inside its time block, and its running sum there."""
    move = F.coalesce(F.signum(F.col("close_price") - F.lag("close_price").over(inner)) * F.col("volume"), F.lit(0.0))
    return rows.withColumn("_move", move).withColumn("_obv", F.sum("_move").over(inner.rowsBetween(Window.unboundedPreceding, 0)))


def obv_step(over):
    """Signed volume of the first row of a time block against the last close of the block before."""
    return F.coalesce(F.signum(F.col("_first") - F.lag("_last").over(over)) * F.col("_first_v"), F.lit(0.0))


def index_with_obv(bars):
    """Dense row index plus on-balance volume in one two-level scan.

    Each time block yields its row count, its inner OBV movement and its edge
    values; prefix sums over the blocks give the offsets. The step across a block
    edge is taken from the previous block's last close.
    """
    cut = bars.withColumn("_tb", time_block("open_time", tf_seconds() * BLOCK_ROWS))
    inner = Window.partitionBy(*SERIES, "_tb").orderBy("open_time")
    rows = obv_moves(cut.withColumn("_pos", F.row_number().over(inner)), inner)
    edges = (rows.groupBy(*SERIES, "_tb")
             .agg(F.count(F.lit(1)).alias("_n"), F.sum("_move").alias("_moved"),
                  F.min_by("close_price", "open_time").alias("_first"), F.min_by("volume", "open_time").alias("_first_v"),
                  F.max_by("close_price", "open_time").alias("_last")))
    step = obv_step(Window.partitionBy(*SERIES).orderBy("_tb"))
    edges = edges.withColumn("_step", step).withColumn("_moved", F.col("_moved") + F.col("_step"))
    carry = prefix_over_blocks(edges, SERIES, "_tb", {"_n": "_before", "_moved": "_carry"}, keep=["_step"])
    return (join_blocks(rows, carry, [*SERIES, "_tb"])
            .withColumn("_rn", F.col("_before") + F.col("_pos") - 1)
            .withColumn("obv", F.col("_carry") + F.col("_step") + F.col("_obv"))
            .drop("_tb", "_pos", "_move", "_obv", "_before", "_carry", "_step"))


def true_range(w=None):
    w = w or block_window()
    prev = F.lag("close_price").over(w)
    return F.greatest(F.col("high_price") - F.col("low_price"), F.abs(F.col("high_price") - prev),
                      F.abs(F.col("low_price") - prev))


def directional_moves(w=None):
    """(+DM, -DM), 0 in the first row."""
    w = w or block_window()
    up = F.col("high_price") - F.lag("high_price").over(w)
    down = F.lag("low_price").over(w) - F.col("low_price")
    return (F.when((up > 0) & (up > down), up).otherwise(0.0), F.when((down > 0) & (down > up), down).otherwise(0.0))


# what each column is computed from; only the needed ones enter the plan
NEEDS = {
    "plus_di": ["plus_dm", "_pdm", "atr"], "minus_di": ["minus_dm", "_mdm", "atr"], "atr": ["true_range"], "_pdm": ["plus_dm"],
    "_mdm": ["minus_dm"], "dx": ["plus_di", "minus_di"], "adx": ["dx"], "_gain": ["gain"], "_loss": ["loss"], "rsi": ["_gain", "_loss"],
    "bb_upper": ["bb_middle", "_std"], "bb_lower": ["bb_middle", "_std"], "stochastic_k": ["_low14", "_high14"],
    "willr": ["_low14", "_high14"], "stochastic_d": ["stochastic_k"], "_tpm": ["tp"], "cci": ["tp", "_tpm"],
    "macd": ["_fast", "_slow"], "macd_signal": ["macd"], "macd_hist": ["macd", "macd_signal"]}
MEANS = {"atr": ("true_range", WILDER), "_pdm": ("plus_dm", WILDER), "_mdm": ("minus_dm", WILDER), "_gain": ("gain", WILDER),
         "_loss": ("loss", WILDER), "ema": ("close_price", span_alpha(20)), "_fast": ("close_price", span_alpha(12)),
         "_slow": ("close_price", span_alpha(26))}
SECOND_MEANS = {"adx": ("dx", WILDER), "macd_signal": ("macd", span_alpha(9))}


def _closure(columns):
    need, todo = set(), list(columns)
    while todo:
        c = todo.pop()
        if c not in need:
            need.add(c)
            todo += NEEDS.get(c, [])
    return need


def _first_stage():
    """Columns over the bars themselves."""
    w = block_window()
    w14, w20 = rows_back(14), rows_back(20)
    c, h, l = F.col("close_price"), F.col("high_price"), F.col("low_price")
    plus, minus = directional_moves(w)
    delta = c - F.lag("close_price").over(w)
    zero = F.when(delta.isNotNull(), 0.0)
    return {"true_range": true_range(w), "plus_dm": plus, "minus_dm": minus, "gain": F.greatest(delta, zero),
            "loss": F.greatest(-delta, zero), "tp": (h + l + c) / 3.0,
            "bb_middle": full(F.avg("close_price"), "close_price", w20, 20),
            "_std": full(F.stddev_samp("close_price"), "close_price", w20, 20),
            "_low14": full(F.min("low_price"), "low_price", w14, 14),
            "_high14": full(F.max("high_price"), "high_price", w14, 14),
            "sma": full(F.avg("close_price"), "close_price", w14, 14)}


def _second_stage():
    w20 = rows_back(20)
    c = F.col("close_price")
    width = F.col("_high14") - F.col("_low14")
    return {"bb_upper": F.col("bb_middle") + 2 * F.col("_std"), "bb_lower": F.col("bb_middle") - 2 * F.col("_std"),
            "stochastic_k": ratio(100 * (c - F.col("_low14")), width), "willr": ratio(-100 * (F.col("_high14") - c), width),
            "_tpm": full(F.avg("tp"), "tp", w20, 20)}


def _third_stage():
    return {"stochastic_d": full(F.avg("stochastic_k"), "stochastic_k", rows_back(3), 3)}


def _cci():
    """Mean absolute deviation around the frame's mean: the twenty values by lag, so the sum
    is one generated expression instead of a collected list per row."""
    w = block_window()
    deviations = [F.abs((F.lag("tp", i).over(w) if i else F.col("tp")) - F.col("_tpm")) for i in range(19, -1, -1)]
    return {"cci": ratio(F.col("tp") - F.col("_tpm"), 0.015 * (reduce(lambda a, b: a + b, deviations) / 20))}


def _after_means():
    return {"plus_di": ratio(100 * F.col("_pdm"), "atr"), "minus_di": ratio(100 * F.col("_mdm"), "atr"),
            "macd": F.col("_fast") - F.col("_slow"),
            "rsi": 100 - ratio(F.lit(100.0), 1 + ratio("_gain", nullif("_loss")))}


def _direction_index():
    p, m = F.col("plus_di"), F.col("minus_di")
    return {"dx": ratio(100 * F.abs(p - m), p + m)}


def stored_indicators(bars, columns=INDICATOR_COLUMNS):
    """Bars plus the chosen indicator columns (the sixteen stored ones by default; also
    true_range, plus_dm, minus_dm, plus_di, minus_di, dx, gain, loss, tp)."""
    need = _closure(columns)
    if "obv" in need:
        indexed = index_with_obv(bars)
    else:
        indexed = with_row_index(bars)
    df = row_blocks(indexed, HORIZON if need & {*MEANS, *SECOND_MEANS} else 32)
    return block_indicators(df, bars.columns, columns)


def block_indicators(df, kept, columns=INDICATOR_COLUMNS):
    """Columns ``kept`` and the chosen indicators of the own rows of a frame of row blocks with their halo."""
    need = _closure(columns)
    pick = lambda stage: {n: x for n, x in stage.items() if n in need}
    for step in (_first_stage, _second_stage, _third_stage, _cci, MEANS, _after_means, _direction_index, SECOND_MEANS):
        if callable(step):
            found = pick(step())
            df = df.withColumns(found) if found else df
        else:
            found = pick(step)
            df = ewm_columns(df, found) if found else df
    if "macd_hist" in need:
        df = df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return drop_halo(df.select(*kept, *[c for c in columns if c not in kept], "_halo"))


def on_balance_volume(bars):
    return index_with_obv(bars).drop("_rn")
