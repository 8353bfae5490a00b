"""Named, ordered files by symbol and range."""
import datetime as dt
import os

from tickloom.sources import sinks


def test_one_ordered_file_per_symbol_and_range(spark, tmp_path):
    start = dt.datetime(2024, 1, 30)
    rows = [(s, start + dt.timedelta(hours=h), 1.5 + h, 1.25, 10 + h, h, h) for h in range(72) for s in ("EURUSD", "A=B/C")]
    rows += [(None, start, 1.0, 1.0, 1, 1, 1), ("EURUSD", None, 1.0, 1.0, 1, 1, 1), ("EURUSD", start, 9.0, 1.25, 10, 0, 99)]
    ticks = spark.createDataFrame(rows, "symbol string, time timestamp, ask double, bid double, ask_volume int, bid_volume int, id int").repartition(5)
    folder = str(tmp_path / "out")
    sinks.write_tick_files(ticks.where("symbol is null or symbol <> 'A=B/C'"), folder, days=1, header=True, tie=["id"])
    names = sorted(n for n in os.listdir(folder) if n.endswith(".csv"))
    assert names == [f"EURUSD-{d}-{d}.csv" for d in ("2024_01_30", "2024_01_31", "2024_02_01")]
    lines = open(f"{folder}/{names[0]}").read().splitlines()
    assert lines[0] == "time,ask,bid,ask_volume,bid_volume" and len(lines) == 26 and lines[1:] == sorted(lines[1:], key=lambda x: x[:23])
    assert lines[1].startswith("2024-01-30 00:00:00.000,1.50000,1.25000") and lines[2].startswith("2024-01-30 00:00:00.000,9.00000")
    sinks.write_tick_files(ticks.where("symbol = 'EURUSD' and ask < 3"), folder, days=1)
    assert len(open(f"{folder}/{names[0]}").read().splitlines()) == 2 and len(os.listdir(folder)) >= 3


def test_no_rows_no_files(spark, tmp_path):
    bars = spark.createDataFrame([], "symbol string, open_time timestamp, open_price double, high_price double, low_price double, close_price double")
    sinks.write_candle_files(bars, str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == []


def test_ticks_of_an_archive_come_in_pieces():
    import lzma

    import numpy as np
    import pandas as pd

    from tickloom.sources import archive

    rec = np.zeros(3 * 20_000 + 5, dtype=archive.RECORD)
    rec["ms"] = np.arange(len(rec)) % 3_600_000
    files = pd.DataFrame({"symbol": ["EURUSD"], "day": ["2024-01-02"], "content": [lzma.compress(rec.tobytes(), lzma.FORMAT_ALONE)]})
    got = list(archive._decode([files]))
    assert max(map(len, got)) <= 20_000
    assert (pd.concat(got)["seq"].to_numpy() == np.arange(len(rec))).all() and (pd.concat(got)["ms"].to_numpy() == rec["ms"]).all()
