"""Timeframes, per-timeframe limits, thresholds and defaults."""

# --- fixed values -----------------------------------------------------------
TF_SECONDS = {"M1": 60, "M5": 300, "M15": 900, "M30": 1800, "H1": 3600, "H4": 14400, "D1": 86400}

# tick-tool timeframes (TICK means "no resampling")
TICK_TF_SECONDS = {"TICK": 0, "S_30": 30, "M1": 60, "M2": 120, "M5": 300, "M10": 600, "M15": 900,
                   "M30": 1800, "H1": 3600, "H4": 14400, "D1": 86400}

INDICATOR_COLUMNS = ["adx", "atr", "bb_upper", "bb_middle", "bb_lower", "cci", "ema", "macd",
                     "macd_signal", "macd_hist", "obv", "rsi", "sma", "stochastic_k", "stochastic_d", "willr"]

KEY_INDICATORS = ["rsi", "ema", "atr", "bb_middle", "bb_upper", "bb_lower"]

PATTERN_LIMITS = {"D1": 7, "H4": 5, "H1": 20, "M15": 30, "M5": 30, "M1": 60}
FULL_LIMITS = {"M1": 120, "M5": 288, "M15": 192, "H1": 480, "H4": 300, "D1": 250}
COMPACT_LIMITS = {"M1": 5, "M5": 30, "M15": 16, "H1": 20, "H4": 6, "D1": 4}

# timeframes of the documents, in output order
DOCUMENT_TIMEFRAMES = ["D1", "H4", "H1", "M15", "M5", "M1"]

# volatility thresholds by timeframe: (above -> high, above -> medium)
ATR_THRESHOLDS = {"H1": (15.0, 8.0), "H4": (25.0, 12.0), "M15": (6.0, 3.0), "M5": (3.0, 1.5)}
RANGE_4H_THRESHOLDS = (20.0, 10.0)
RANGE_1H_THRESHOLDS = (8.0, 4.0)

DEFAULT_SPREADS = {"XAUUSD": 0.30, "EURUSD": 0.00015, "GBPUSD": 0.0002, "USDJPY": 0.015, "USDCHF": 0.00018}
DEFAULT_SPREAD = 0.0001
FALLBACK_SPREAD = 0.40

# symbols whose archived ticks carry three decimals instead of five
THREE_DECIMAL_SYMBOLS = ["usdrub", "xagusd", "xauusd"]
# ----------------------------------------------------------------------------
