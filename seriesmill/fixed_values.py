"""Fixed values.

Everything in this module is a constant that results depend on: time-frame
names, venue page sizes, look-back limits, default ranges, report texts and
the macro catalogue.  They are data, kept together so that nothing else in
the library hides a magic number.
"""

from __future__ import annotations

# -- fixed values: standard time frames, in minutes (case matters) -----------
STANDARD_TIMEFRAMES = {
    "1m": 1,
    "3m": 3,
    "5m": 5,
    "15m": 15,
    "30m": 30,
    "1h": 60,
    "2h": 120,
    "4h": 240,
    "6h": 360,
    "8h": 480,
    "12h": 720,
    "1d": 1440,
    "3d": 4320,
    "1w": 10080,
    "1M": 43200,
    "1y": 525600,
}

# -- fixed values: units of free-form time frames, in minutes ----------------
TIMEFRAME_UNITS = {
    "m": 1,
    "min": 1,
    "minute": 1,
    "h": 60,
    "hour": 60,
    "d": 1440,
    "day": 1440,
    "w": 10080,
    "week": 10080,
    "month": 43200,
    "y": 525600,
    "year": 525600,
}

# -- fixed values: time frames a series may be collected at ------------------
SERIES_TIMEFRAMES = ["1w", "1d", "4h", "1h"]
DEFAULT_TIMEFRAME = "1d"

# -- fixed values: units of relative times ("-2h"), in milliseconds ----------
RELATIVE_UNITS_MS = {
    "s": 1_000,
    "m": 60_000,
    "h": 3_600_000,
    "d": 86_400_000,
    "w": 604_800_000,
    "y": 31_536_000_000,
}

# -- fixed values: time ranges -----------------------------------------------
DEFAULT_RANGE_START = "20240101_000000"
DEFAULT_TASK_RANGE = "20220101-"
RANGE_DAY_START = "_000000"
RANGE_DAY_END = "_235959"
RANGE_MIN_MS = 1_000_000_000_000
RANGE_MAX_MS = 3_000_000_000_000
RANGE_FALLBACK_START_MS = 1_640_995_200_000  # 2022-01-01T00:00:00Z
EPOCH_MS_THRESHOLD = 1e10  # larger numbers are milliseconds, others seconds

# -- fixed values: paging and look-back of the venues ------------------------
SPOT_PAGE_BARS = 1000
SPOT_PAGE_BARS_BY_VENUE = {"okx": 300}
FUTURES_PAGE_BARS = 500
FUTURES_PAGE_PAD_MS = 1000
FUTURES_LOOKBACK_DAYS = 30
DEFAULT_VENUE = "binance"
READ_LIMIT = 1000

# -- fixed values: macro calendar and sentiment index ------------------------
MACRO_TIME_ZONE = "US/Central"
SENTIMENT_SYMBOL = "bitcoin_fgi"
SENTIMENT_TIMEFRAME = "1d"
SENTIMENT_SHIFT_SECONDS = 86_400

# -- fixed values: texts of the data-info report -----------------------------
NO_START_TEXT = "未知"
NO_END_TEXT = "至今"
NO_DATASET_TEXT = "无法获取"

# -- fixed values: derivatives feeds, wire field -> column -------------------
DERIVATIVES_FEEDS = {
    "open_interest": ("sumOpenInterestValue", "timestamp", "open_interest_value"),
    "taker_ratio": ("buySellRatio", "timestamp", "taker_long_short_ratio"),
    "top_position_ratio": ("longShortRatio", "timestamp", "top_long_short_position_ratio"),
    "top_account_ratio": ("longShortRatio", "timestamp", "top_long_short_account_ratio"),
    "global_account_ratio": ("longShortRatio", "timestamp", "global_long_short_account_ratio"),
    "funding": ("fundingRate", "fundingTime", "funding_rate"),
}

# -- fixed values: run states of a collection task ---------------------------
RUN_STATES = [
    "created", "replaced", "waiting", "running", "executing",
    "completed", "failed", "deleted", "stopped", "idle",
]

# -- fixed values: macro catalogue (kind, frequency, key, id, name) ----------
MACRO_CATALOGUE = [
    ("rate", "Daily", "IORB", "IORB", "Interest Rate Overnight Reverse Repurchase Agreements"),
    ("rate", "Daily", "ON_RRP_Award", "RRPONTSYAWARD",
     "Overnight Reverse Repurchase Agreements Award Rate"),
    ("rate", "Daily", "EFFR", "EFFR", "Federal Funds Effective Rate"),
    ("rate", "Daily", "SOFR", "SOFR", "Secured Overnight Financing Rate"),
    ("rate", "Daily", "T-Bill_1M", "DTB4WK", "1-Month T-Bill Secondary Market Rate"),
    ("rate", "Daily", "T-Bill_3M", "DTB3", "3-Month T-Bill Secondary Market Rate"),
    ("rate", "Daily", "T-Bill_6M", "DTB6", "6-Month T-Bill Secondary Market Rate"),
    ("rate", "Daily", "T-Bill_1Y", "DTB1YR", "1-Year T-Bill Secondary Market Rate"),
    ("rate", "Daily", "T-Note_2Y", "DGS2", "2-Year T-Note Secondary Market Rate"),
    ("rate", "Daily", "T-Note_5Y", "DGS5", "5-Year T-Note Secondary Market Rate"),
    ("rate", "Daily", "T-Note_10Y", "DGS10", "10-Year T-Note Secondary Market Rate"),
    ("rate", "Daily", "T-Bond_20Y", "DGS20", "20-Year T-Bond Secondary Market Rate"),
    ("rate", "Daily", "T-Bond_30Y", "DGS30", "30-Year T-Bond Secondary Market Rate"),
    ("volume", "Daily", "ON_RRP", "RRPONTSYD", "Overnight Reverse Repurchase Agreements"),
    ("volume", "Daily", "EFFR", "EFFRVOL", "Effective Federal Funds Volume"),
    ("volume", "Daily", "SOFR", "SOFRVOL", "Secured Overnight Financing Rate Volume"),
    ("volume", "Daily", "SRF_TS", "RPONTSYD",
     "Standing Repo Facility - Treasury Securities Purchased in OMO"),
    ("volume", "Daily", "SRF_MBS", "RPMBSD", "Standing Repo Facility - MBS Purchased in OMO"),
    ("volume", "Daily", "SRF_Agency", "RPAGYD",
     "Standing Repo Facility - Agency Securities Purchased in OMO"),
    ("volume", "Weekly", "Reserve_Balances", "WRBWFRBL",
     "Reserve Balances with Federal Reserve Banks: Wednesday Level"),
]
