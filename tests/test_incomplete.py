"""Incomplete rows: only the blocks around them are computed, with the values of the whole history."""
import pytest
from pyspark.sql import functions as F

from tests.test_state import minute_bars
from tickloom.constants import INDICATOR_COLUMNS
from tickloom.operators.incomplete import block_summary, incomplete_blocks, incomplete_indicators
from tickloom.operators.indicators import stored_indicators
from tickloom.session import materialize
from tickloom.sources import sinks

KEYS = ["symbol", "timeframe", "open_time"]
ROWS = 60_000


@pytest.fixture(scope="module")
def history(spark):
    bars = minute_bars(spark, ROWS).where("unix_seconds(open_time) % 420 <> 60 or unix_seconds(open_time) < 1705000000")
    return materialize(stored_indicators(bars.unionByName(minute_bars(spark, 300, "FEW"))), "history")


def holed(history, *spans):
    """The history with all indicators empty in the given spans of minutes, two of them everywhere else in the span."""
    minute = (F.unix_seconds("open_time") - 1704067200) / 60
    inside = F.lit(False)
    for a, b in spans:
        inside = inside | ((F.col("symbol") == "HOT") & minute.between(a, b))
    return materialize(history.withColumns({c: F.when(~inside, F.col(c)) for c in INDICATOR_COLUMNS}), "holed")


def differences(got, want):
    both = got.alias("g").join(want.alias("w"), KEYS)
    off = F.lit(False)
    for c in INDICATOR_COLUMNS:
        g, w = F.col(f"g.{c}"), F.col(f"w.{c}")
        off = off | (g.isNull() != w.isNull()) | (F.abs(g - w) > 1e-6 * (1 + F.abs(w)))
    return both.where(off).count()


@pytest.mark.parametrize("spans", [[(30_000, 30_010)], [(10_000, 33_000), (59_990, 60_000)], [(4_090, 4_100), (40_000, 40_000)]])
def test_filled_table_is_the_computed_one(history, spans):
    table = holed(history, *spans)
    assert table.where("rsi is null").count() > history.where("rsi is null").count()
    full = sinks.fill_incomplete(table)
    assert full.count() == history.count() and full.columns == history.columns
    assert differences(full, history) == 0


def test_only_blocks_with_gaps_are_computed(history):
    table = holed(history, (30_000, 30_010))
    blocks = incomplete_blocks(block_summary(table))
    assert blocks.where("symbol = 'HOT'").count() <= 4  # the first of the series, and at most two around the gap each
    made = incomplete_indicators(table)
    assert made.where("symbol = 'HOT'").count() <= 4 * 4096 < ROWS / 3
    # what is stored in other blocks plays no part: broken inputs there do not show
    minute = (F.unix_seconds("open_time") - 1704067200) / 60
    broken = materialize(table.withColumn("high_price", F.when(minute.between(45_000, 55_000), F.lit(-1e9)).otherwise(F.col("high_price"))), "broken")
    assert differences(incomplete_indicators(broken), history) == 0


def test_nothing_to_fill_and_no_rows(spark, history):
    warm = history.where("rsi is not null and adx is not null and stochastic_d is not null and cci is not null")
    assert incomplete_indicators(materialize(warm.where("open_time > '2024-01-03'").na.drop(subset=INDICATOR_COLUMNS), "warm")).count() == 0
    assert sinks.fill_incomplete(history.limit(0)).count() == 0


def test_null_symbol_is_a_series_of_its_own(history):
    table = materialize(holed(history, (20_000, 20_005)).withColumn("symbol", F.when(F.col("symbol") != "HOT", F.col("symbol"))), "null")
    made = incomplete_indicators(table).where("symbol is null").withColumn("symbol", F.lit("HOT"))
    assert made.count() > 0 and differences(made, history) == 0


def test_some_columns_without_volume_total(history):
    table = holed(history, (25_000, 25_001))
    made = incomplete_indicators(table, ["rsi", "macd"])
    assert set(made.columns) == {*KEYS, "rsi", "macd"}
    close = made.alias("m").join(history.alias("h"), KEYS).where("abs(m.rsi - h.rsi) > 1e-6 or abs(m.macd - h.macd) > 1e-6")
    assert close.count() == 0
