"""Indicators of newly closed bars, updated from a small state per series.

The state (means, running totals, the last twenty bars) is all a series needs; bars are
taken in time order behind a watermark. A bar not newer than the last one taken is a
repeat and ignored; series with fewer than ``minimum`` bars stay silent, as the batch loop does.
"""
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import TF_SECONDS, TICK_TF_SECONDS
from tickloom.operators.ewm import HORIZON
from tickloom.operators.indicators import index_with_obv
from tickloom.operators.sequence import SERIES
from tickloom.streaming import order

RESULT = ("symbol string, timeframe string, open_time timestamp, n long, atr double, adx double, ema double, macd double, "
          "macd_signal double, macd_hist double, rsi double, obv double, sma double, bb_middle double, bb_upper double, bb_lower double, "
          "cci double, stochastic_k double, stochastic_d double, willr double")
MEANS = ["atr", "pdm", "mdm", "gain", "loss", "ema", "fast", "slow", "adx", "macd_signal"]
STATE = ("n long, last_us long, obv double, highs array<double>, lows array<double>, closes array<double>, "
         + ", ".join(f"{m} double" for m in MEANS))
ALPHA = {"atr": 1 / 14, "pdm": 1 / 14, "mdm": 1 / 14, "gain": 1 / 14, "loss": 1 / 14, "adx": 1 / 14, "ema": 2 / 21,
         "fast": 2 / 13, "slow": 2 / 27, "macd_signal": 2 / 10}
KEEP = 20


def _mean(s, name, x):
    """Next value of a recursive mean; the first value seeds it."""
    s[name] = x if s[name] is None else (1 - ALPHA[name]) * s[name] + ALPHA[name] * x
    return s[name]


def _stochastic(s, back=0):
    """(%K, width) of fourteen bars, ``back`` bars ago; None while there are fewer or where they do not move."""
    end = len(s["closes"]) - back
    if end < 14:
        return None
    high, low = max(s["highs"][end - 14:end]), min(s["lows"][end - 14:end])
    return 100 * (s["closes"][end - 1] - low) / (high - low) if high != low else None


def _bands(s):
    """Middle, upper and lower band and the channel index of twenty bars."""
    if s["n"] < KEEP:
        return None, None, None, None
    mean = sum(s["closes"]) / KEEP
    deviation = (sum((x - mean) ** 2 for x in s["closes"]) / (KEEP - 1)) ** 0.5
    typical = [(h + l + c) / 3.0 for h, l, c in zip(s["highs"], s["lows"], s["closes"])]
    middle = sum(typical) / KEEP
    spread = 0.015 * sum(abs(x - middle) for x in typical) / KEEP
    return mean, mean + 2 * deviation, mean - 2 * deviation, (typical[-1] - middle) / spread if spread else None


def _step(s, bar):
    _, h, l, c, v = bar
    first = not s["closes"]
    ph, pl, pc = (None, None, None) if first else (s["highs"][-1], s["lows"][-1], s["closes"][-1])
    tr = h - l if first else max(h - l, abs(h - pc), abs(l - pc))
    up, down = (0.0, 0.0) if first else (h - ph, pl - l)
    atr = _mean(s, "atr", tr)
    pdm = _mean(s, "pdm", up if up > 0 and up > down else 0.0)
    mdm = _mean(s, "mdm", down if down > 0 and down > up else 0.0)
    if atr != 0 and pdm + mdm != 0:
        plus, minus = 100 * pdm / atr, 100 * mdm / atr
        _mean(s, "adx", 100 * abs(plus - minus) / (plus + minus))
    if not first:
        _mean(s, "gain", max(c - pc, 0.0))
        _mean(s, "loss", max(pc - c, 0.0))
        s["obv"] += (c > pc) * v - (c < pc) * v
    macd = _mean(s, "fast", c) - _mean(s, "slow", c)
    ema, signal = _mean(s, "ema", c), _mean(s, "macd_signal", macd)
    for name, x in (("highs", h), ("lows", l), ("closes", c)):
        s[name] = (s[name] + [x])[-KEEP:]
    s["n"] += 1
    rsi = 100 - 100 / (1 + s["gain"] / s["loss"]) if s["loss"] else None
    last14 = s["n"] >= 14
    high, low = max(s["highs"][-14:]), min(s["lows"][-14:])
    wide = last14 and high != low
    middle, upper, lower, cci = _bands(s)
    fast = [_stochastic(s, back) for back in range(3)]
    return {"n": s["n"], "atr": atr, "adx": s["adx"], "ema": ema, "macd": macd, "macd_signal": signal,
            "macd_hist": macd - signal, "rsi": rsi,
            "obv": s["obv"], "sma": sum(s["closes"][-14:]) / 14 if last14 else None,
            "bb_middle": middle, "bb_upper": upper, "bb_lower": lower, "cci": cci,
            "stochastic_k": fast[0], "stochastic_d": sum(fast) / 3 if None not in fast else None,
            "willr": -100 * (high - c) / (high - low) if wide else None}


NAMES = [x.split()[0] for x in STATE.split(", ")]
COLUMNS = [x.split()[0] for x in RESULT.split(", ")]
BAR = {"high_price": "double", "low_price": "double", "close_price": "double", "volume": "long"}


class LiveIndicators(order.InTimeOrder):
    """State of a series: its means, its running totals and its last twenty bars."""

    def __init__(self, minimum):
        super().__init__(BAR, "open_time", STATE)
        self.minimum = minimum

    def span(self, key):
        seconds = TF_SECONDS.get(key[1]) or TICK_TF_SECONDS.get(key[1])
        if not seconds:
            raise ValueError(f"unknown timeframe: {key[1]}")
        return seconds * order.BLOCK_ROWS * 1000000

    def start(self):
        s = dict.fromkeys(NAMES)
        s.update(n=0, last_us=-1, obv=0.0, highs=[], lows=[], closes=[])
        return tuple(s[n] for n in NAMES)

    def seeded(self, key, stored):
        """The totals in front of the first stored bar."""
        s = dict(zip(NAMES, self.start()))
        return tuple({**s, "n": int(stored["n"].min()), "obv": float(stored["base"].iloc[0])}[n] for n in NAMES)

    def take(self, key, state, rows):
        s = dict(zip(NAMES, state))
        for name in ("highs", "lows", "closes"):
            s[name] = list(s[name])
        out = []
        for bar in rows:
            if bar[0] <= s["last_us"]:
                continue
            row = _step(s, bar)
            s["last_us"] = bar[0]
            if row["n"] >= self.minimum:
                out.append({"symbol": key[0], "timeframe": key[1], "open_time": pd.Timestamp(bar[0], unit="us"), **row})
        return tuple(s[n] for n in NAMES), order.frame(out, COLUMNS) if out else None


def seed_rows(bars, keep=HORIZON + KEEP):
    """The last ``keep`` stored bars of each series with the totals in front of them: enough to go on from a stored
    table, as the weight of older bars in any mean is below the resolution of a double."""
    last = Window.partitionBy(*SERIES).orderBy(F.desc("_rn"))
    rows = index_with_obv(bars).withColumn("_k", F.row_number().over(last)).where(F.col("_k") <= keep)
    first = F.min_by("obv", "_rn").over(Window.partitionBy(*SERIES))
    return rows.select(*SERIES, "open_time", *[F.col(c).cast(t).alias(c) for c, t in BAR.items()],
                       F.col("_rn").cast("long").alias("n"), first.alias("base"))


def live_indicators(bars, minimum=150, delay="0 seconds", stored=None):
    """Indicator rows of a stream of closed bars. ``delay`` is how far behind the newest bar the feed may still deliver
    (0 where every batch holds whole commits of the bar table). With ``stored``, a table of older bars, the series go on
    from there: nothing is emitted for those, and of the stream only later bars count."""
    rows = bars.withWatermark("open_time", delay).select(
        *SERIES, "open_time", *[F.col(c).cast(t).alias(c) for c, t in BAR.items()])
    return order.run(rows, SERIES, LiveIndicators(minimum), RESULT, seed_rows(stored) if stored is not None else None)
