"""Market-shaped views over the test tables, as one SQL text for both engines.

``timestamp`` is quoted per engine; every view covers its whole source table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_MINUTE = "CAST(date_trunc('minute', {c}) AS {ntz})"
_BAR_KEYS = "asset_id_base, asset_id_quote, exchange_id"

# Trades: lineitem is the spot market, orders the futures market.
SPOT_TRADES = """
SELECT l_orderkey*8+l_linenumber AS trade_id, l_shipdate AS {q}timestamp{q},
       l_extendedprice/l_quantity AS price, l_quantity AS quantity,
       l_extendedprice AS quote_quantity,
       CASE WHEN l_linestatus='F' THEN 'buy' ELSE 'sell' END AS side,
       concat('S', CAST(l_suppkey%5 AS VARCHAR(10))) AS asset_id_base,
       'USDT' AS asset_id_quote, 'BINANCE' AS exchange_id
FROM lineitem
"""

FUTURES_TRADES = """
SELECT o_orderkey AS trade_id, o_orderdate AS {q}timestamp{q}, o_totalprice AS price,
       CAST(1.0 AS DOUBLE) AS quantity, o_totalprice AS quote_quantity,
       CASE WHEN o_orderstatus='F' THEN 'buy' ELSE 'sell' END AS side,
       concat('S', CAST(o_custkey%6 AS VARCHAR(10))) AS asset_id_base,
       'USDT' AS asset_id_quote, 'BINANCE' AS exchange_id
FROM orders
"""

# Sparse one-minute bars from the event stream.
BARS_1M = """
SELECT {minute} AS time_period_start,
       {minute} + INTERVAL 1 MINUTE AS time_period_end,
       min_by(value, event_id) AS open, max(value) AS high, min(value) AS low,
       max_by(value, event_id) AS close,
       CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS volume,
       count(*) AS trades,
       concat('S', CAST(user_id%3 AS VARCHAR(10))) AS asset_id_base,
       'USDT' AS asset_id_quote, 'BINANCE' AS exchange_id
FROM events GROUP BY date_trunc('minute', ts), user_id%3
"""

# One-minute bars from trades, so that spot and futures share symbols and days.  A trade
# id may repeat, hence the price as second ordering key.
_BARS_FROM_TRADES = """
SELECT {minute} AS time_period_start,
       {minute} + INTERVAL 1 MINUTE AS time_period_end,
       {first} AS open, max(price) AS high, min(price) AS low, {last} AS close,
       CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
       count(*) AS trades, {keys}
FROM ({trades}) t GROUP BY date_trunc('minute', {q}timestamp{q}), {keys}
"""

# Load progress per symbol, in epoch milliseconds.  S2 has no end mark, and the two
# derivative feeds have no marks at all.
SYMBOL_META = """
SELECT asset_id_base, asset_id_quote, exchange_id,
       {ms_min} AS candle_data_start,
       CASE WHEN asset_id_base = 'S2' THEN NULL ELSE {ms_max} END AS candle_data_end,
       {ms_min} AS trade_data_start,
       CASE WHEN asset_id_base = 'S2' THEN NULL ELSE {ms_max} END AS trade_data_end,
       {ms_min} AS futures_trade_data_start, {ms_min} AS futures_trade_data_end,
       {ms_min} AS futures_candle_data_start, {ms_max} AS futures_candle_data_end,
       {ms_min} AS funding_rate_data_start, CAST(NULL AS BIGINT) AS funding_rate_data_end,
       CAST(NULL AS BIGINT) AS order_book_depth_data_start,
       CAST(NULL AS BIGINT) AS order_book_depth_data_end,
       CAST(NULL AS BIGINT) AS futures_metrics_data_start,
       {ms_max} AS futures_metrics_data_end
FROM ({trades}) t GROUP BY asset_id_base, asset_id_quote, exchange_id
"""

# A pair listing from the part table, with dollar and non-dollar assets on both sides.
LISTING = """
SELECT concat(CASE p_size % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'USTC' ELSE 'P' END,
              CAST(p_partkey AS VARCHAR(20))) AS baseAsset,
       CASE p_size % 5 WHEN 0 THEN 'USDT' WHEN 1 THEN 'USDC' WHEN 2 THEN 'BUSD'
                       WHEN 3 THEN 'BTC' ELSE 'EUR' END AS quoteAsset,
       p_size <= 40 AS isSpotTradingAllowed,
       p_retailprice >= 920 AS isMarginTradingAllowed
FROM part
"""

_ENGINES = {
    "spark": {
        "q": "`",
        "ntz": "TIMESTAMP_NTZ",
        "first": "min_by(price, struct(trade_id, price))",
        "last": "max_by(price, struct(trade_id, price))",
        "ms": "unix_millis(CAST({x} AS TIMESTAMP))",
    },
    "duckdb": {
        "q": '"',
        "ntz": "TIMESTAMP",
        "first": "first(price ORDER BY trade_id, price)",
        "last": "last(price ORDER BY trade_id, price)",
        "ms": "epoch_ms({x})",
    },
}


def view_sql(engine: str) -> dict[str, str]:
    """Name -> SELECT for ``engine`` (``spark`` or ``duckdb``)."""
    e = _ENGINES[engine]
    q = e["q"]
    ts = f"{q}timestamp{q}"
    spot, futures = SPOT_TRADES.format(q=q), FUTURES_TRADES.format(q=q)

    def bars(trades: str) -> str:
        minute = _MINUTE.format(c=ts, ntz=e["ntz"])
        return _BARS_FROM_TRADES.format(
            minute=minute, first=e["first"], last=e["last"], keys=_BAR_KEYS, trades=trades, q=q
        )

    return {
        "listing": LISTING,
        "spot_trades": spot,
        "futures_trades": futures,
        "bars_1m": BARS_1M.format(minute=_MINUTE.format(c="ts", ntz=e["ntz"])),
        "spot_bars": bars(spot),
        "futures_bars": bars(futures),
        "symbol_meta": SYMBOL_META.format(
            ms_min=e["ms"].format(x=f"min({ts})"), ms_max=e["ms"].format(x=f"max({ts})"), trades=spot
        ),
    }


_SOURCES = ("lineitem", "orders", "events", "part")


class Views(Mapping):
    """The views as DataFrames; tables are opened when a view first needs them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._sql = spark, sf_dir, view_sql("spark")

    def __getitem__(self, name: str) -> DataFrame:
        sql = self._sql[name]
        for source in _SOURCES:
            if re.search(rf"\b{source}\b", sql):
                table = self._spark.read.parquet(f"{self._dir}/{source}.parquet")
                table.createOrReplaceTempView(source)
        return self._spark.sql(sql)

    def __iter__(self):
        return iter(self._sql)

    def __len__(self):
        return len(self._sql)


def load_views(spark: SparkSession, sf_dir: str) -> Views:
    """The views over the Parquet tables in ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Views(spark, sf_dir)


# Archive lines as text, c0, c1, ..., made from whole tables.  Klines are stamped off the
# minute, half of the spot trades in microseconds, flags in mixed case, and every symbol's
# futures file has a header line.
_KEY_COLUMNS = "asset_id_base, asset_id_quote, exchange_id"
_TEXT = {
    "candle": """
SELECT ms(time_period_start) + 400 AS c0, open AS c1, high AS c2, low AS c3, close AS c4,
       volume AS c5, ms(time_period_end) - 1 AS c6, 0 AS c7, trades AS c8, 0 AS c9, 0 AS c10,
       0 AS c11, {keys} FROM bars_1m""",
    "futures_candle": """
SELECT ms(time_period_start) AS c0, open AS c1, high AS c2, low AS c3, close AS c4,
       volume AS c5, ms(time_period_end) - 1 AS c6, volume * 2 AS c7, trades AS c8,
       volume / 2 AS c9, volume AS c10, 0 AS c11, {keys} FROM futures_bars""",
    "trade": """
SELECT trade_id AS c0, price AS c1, quantity AS c2, quote_quantity AS c3,
       CASE WHEN side = 'buy' THEN ms(timestamp) * 1000 ELSE ms(timestamp) END AS c4,
       CASE WHEN side = 'buy' THEN 'False' ELSE 'True' END AS c5, 'true' AS c6,
       {keys} FROM spot_trades""",
    "futures_trade": """
SELECT trade_id AS c0, price AS c1, quantity AS c2, quote_quantity AS c3, ms(timestamp) AS c4,
       CASE WHEN side = 'buy' THEN 'false' ELSE 'true' END AS c5, {keys} FROM futures_trades""",
    "funding_rate": """
SELECT ms(timestamp) AS c0, 8 AS c1, price / 1000000 AS c2, {keys} FROM futures_trades""",
    "order_book_depth": """
SELECT date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') AS c0, quantity AS c1, price AS c2,
       quote_quantity AS c3, {keys} FROM spot_trades""",
    "futures_metrics": """
SELECT date_format(time_period_start, 'yyyy-MM-dd HH:mm:ss') AS c0, 'S' AS c1, open AS c2,
       high AS c3, low AS c4, close AS c5, volume AS c6, 'NaN' AS c7, {keys} FROM bars_1m""",
}
_HEADED = ("futures_candle", "futures_trade", "funding_rate", "order_book_depth", "futures_metrics")


def raw_text(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Text rows as the archive reader would give them."""
    source = re.search(r"FROM (\w+)", _TEXT[dataset]).group(1)
    load_views(spark, sf_dir)[source].createOrReplaceTempView(source)
    millis = re.sub(r"\bms\((\w+)\)", r"unix_millis(CAST(\1 AS TIMESTAMP))", _TEXT[dataset])
    rows = spark.sql(millis.format(keys=_KEY_COLUMNS))
    fields = [c for c in rows.columns if c.startswith("c") and c[1:].isdigit()]
    keys = [c for c in rows.columns if c not in fields]
    rows = rows.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in fields], *keys)
    if dataset in _HEADED:
        header = rows.select(*keys).distinct().selectExpr(*[f"'{c}' AS {c}" for c in fields], *keys)
        rows = rows.unionByName(header)
    return rows
