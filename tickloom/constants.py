"""Fixed values.

These must stay as they are for results, file layouts and model inputs to line up
with the data they describe.  Nothing here is computed.
"""

# --- rolling windows -------------------------------------------------------------
ROLLING_WINDOWS = (7, 30, 90, 180, 365)  # rows, current row included
LOOKBACK_DAYS = 365  # days read for one daily rolling run, target day included
PERCENTILES = (0.1, 0.5, 0.9)

# --- epoch decoding --------------------------------------------------------------
# Epoch values above this cannot be milliseconds (the nanosecond range ends there).
MAX_EPOCH_MS = 9223372036854

# --- archive layouts, by position ------------------------------------------------
KLINE_COLUMNS = (
    "time_period_start",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "time_period_end",
    "quote_volume",
    "trades",
    "taker_buy_volume",
    "taker_buy_quote_volume",
    "ignore",
)
SPOT_TRADE_COLUMNS = (
    "trade_id",
    "price",
    "qty",
    "quote_qty",
    "time",
    "is_buyer_maker",
    "is_best_match",
)
FUTURES_TRADE_COLUMNS = (
    "trade_id",
    "price",
    "qty",
    "quote_qty",
    "time",
    "is_buyer_maker",
)
FUNDING_COLUMNS = ("timestamp", "funding_interval_hours", "last_funding_rate")
DEPTH_COLUMNS = ("timestamp", "percentage", "depth", "notional")
METRICS_COLUMNS = (
    "timestamp",
    "symbol",
    "sum_open_interest",
    "sum_open_interest_value",
    "count_toptrader_long_short_ratio",
    "sum_toper_long_short_ratio",
    "count_long_short_ratio",
    "sum_taker_long_short_vol_ratio",
)

# --- archive names: <base><quote>-<tag>-<period>.zip ------------------------------
ARCHIVE_TAGS = {
    "candle": "1m",
    "trade": "trades",
    "futures_candle": "1m",
    "futures_trade": "trades",
    "funding_rate": "fundingRate",
    "order_book_depth": "bookDepth",
    "futures_metrics": "metrics",
}

# --- load progress ---------------------------------------------------------------
# Metadata holds <dataset>_data_start and <dataset>_data_end for each of these.
METADATA_DATASETS = (
    "candle",
    "trade",
    "futures_trade",
    "futures_candle",
    "funding_rate",
    "order_book_depth",
    "futures_metrics",
)
DEFAULT_START_MS = 1546300800000  # 2019-01-01, for symbols new to the metadata
DATASET_FLOORS = {
    "order_book_depth": "2023-01-01",
    "futures_metrics": "2021-12-01",
}
SPOT_QUOTE_ASSET = "USDT"
DERIVATIVE_QUOTE_ASSETS = ("USDT", "USDC", "BUSD")
EXCHANGE_ID = "BINANCE"

# --- model features --------------------------------------------------------------
CATEGORICAL_FEATURES = ("symbol_id", "day_of_week", "month", "day_of_month")
NON_NUMERIC_FEATURES = (
    "asset_id_base",
    "asset_id_quote",
    "exchange_id",
)
NON_MODEL_FEATURES = (
    "open_spot",
    "high_spot",
    "low_spot",
    "close_spot",
    "open_futures",
    "high_futures",
    "low_futures",
    "close_futures",
    "date",
)
# A column whose name holds one of these is left out of the model ...
RAW_SCALE_MARKERS = ("num", "dollar", "delta")
# ... unless its name also holds one of these.
RESCALED_MARKERS = ("rz", "zscore", "percentile")
# These are always left out.
TAIL_MARKERS = ("10th_percentile", "90th_percentile", "forward_returns")

LABEL_SOURCE = "futures_returns_7"
LABEL = "futures_forward_returns_7"
LABEL_HORIZON = 7
PREDICTION = "predicted_return_7d"
TRAINING_DAYS = 730
MODEL_PARAMS = {
    "learning_rate": 0.1,
    "trees": 100,
    "depth": 5,
    "feature_fraction": 0.8,
    "bagging_fraction": 0.8,
    "bagging_freq": 5,
    "l2": 5.0,
    "seed": 19,
}
