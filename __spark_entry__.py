"""

Every query reads the whole test tables through the market-shaped views in ``views.py``.
Double columns are rounded to 6 decimals the same way on both sides (``rint`` here,
``round_even`` there), because engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from tickloom import schemas
from tickloom.constants import PREDICTION
from tickloom.functions.scalar import KEYS, symbol_id
from tickloom.operators import (
    aggregate,
    boosting,
    cleaning,
    features,
    incremental,
    rolling,
    training,
    transformers,
    universe,
)
from tickloom.plans import jobs
from tickloom.session import scratch_path
from tickloom.sources import archives, datasets, layouts, tables
from tickloom.streaming.ingest import ingest_stream
from views import load_views, raw_text

SCALE = 2  # money in the test tables has two decimals
Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Trades to daily statistics to rolling features, at sf0.001."""
    return rolling_trade_features(spark, "/root/testdata/sf0.001")


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded; integers that can be null as doubles (pandas has no plain form)."""

    def shown(name: str, kind: str) -> str:
        if kind == "double":
            return f"rint(`{name}` * 1e6D) / 1e6D AS `{name}`"
        if kind == "bigint" and oracles.nullable_integer(name):
            return f"CAST(`{name}` AS DOUBLE) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[shown(c, t) for c, t in df.dtypes])


# --- aggregation and windows ------------------------------------------------------


def _stats(spark: SparkSession, sf_dir: str, market: str = "spot", **options) -> DataFrame:
    trades = load_views(spark, sf_dir)[f"{market}_trades"]
    return aggregate.daily_trade_stats(trades, exact_scale=SCALE, **options)


def daily_trade_stats_spot(spark, sf_dir):
    return tidy(_stats(spark, sf_dir))


def daily_trade_stats_futures(spark, sf_dir):
    return tidy(_stats(spark, sf_dir, "futures"))


def daily_trade_stats_hot(spark, sf_dir):
    """The same statistics where half of all trades fall on one day of one symbol."""
    trades = load_views(spark, sf_dir)["futures_trades"]
    bought = F.col("side") == "buy"
    moved = trades.withColumns(
        {
            "timestamp": F.when(bought, F.lit(oracles.HOT_DAY).cast("timestamp_ntz")).otherwise(F.col("timestamp")),
            "asset_id_base": F.when(bought, F.lit("S0")).otherwise(F.col("asset_id_base")),
        }
    )
    return tidy(aggregate.daily_trade_stats(moved, exact_scale=SCALE))


def daily_ohlcv_spot(spark, sf_dir):
    bars = load_views(spark, sf_dir)["bars_1m"]
    return tidy(aggregate.daily_ohlcv(bars, exact_scale=6))


def daily_ohlcv_spot_end_label(spark, sf_dir):
    bars = load_views(spark, sf_dir)["bars_1m"]
    return tidy(aggregate.daily_ohlcv(bars, label="end", exact_scale=6))


def daily_ohlcv_futures(spark, sf_dir):
    bars = load_views(spark, sf_dir)["futures_bars"]
    return tidy(aggregate.daily_ohlcv(bars, exact_scale=SCALE))


def _rolling(spark, sf_dir, **options) -> DataFrame:
    return rolling.rolling_trade_features(_stats(spark, sf_dir), exact_scale=SCALE, **options)


def rolling_trade_features(spark, sf_dir):
    return tidy(_rolling(spark, sf_dir))


def rolling_trade_features_double(spark, sf_dir):
    """Sliding frames over plain doubles, the production default: the totals, whose true
    values have two decimals and so survive rounding (quotients of them may not)."""
    rolled = rolling.rolling_trade_features(_stats(spark, sf_dir))
    totals = [f"{c}_{n}d" for c in (*rolling.MONEY, *rolling.COUNTS) for n in (1, 7, 30, 90, 180, 365)]
    return tidy(rolled.select(*oracles.ID, *totals))


def rolling_trade_latest(spark, sf_dir):
    return tidy(_rolling(spark, sf_dir, mode="latest"))


def rolling_trade_as_of(spark, sf_dir):
    """One daily run: 365 days of input, rows of the target date only."""
    return tidy(_rolling(spark, sf_dir, mode="latest", as_of=oracles.AS_OF))


def dedupe_trades(spark, sf_dir):
    return tidy(cleaning.dedupe_trades(load_views(spark, sf_dir)["spot_trades"]))


def gap_fill_bars(spark, sf_dir):
    return tidy(cleaning.gap_fill(load_views(spark, sf_dir)["bars_1m"]))


def gap_fill_bars_zero_volume(spark, sf_dir):
    return tidy(cleaning.gap_fill(load_views(spark, sf_dir)["bars_1m"], fill="zero_volume"))


# --- parsing ----------------------------------------------------------------------


def parse_klines_spot(spark, sf_dir):
    return tidy(layouts.parse_bars(raw_text(spark, sf_dir, "candle"), "spot"))


def parse_klines_futures(spark, sf_dir):
    return tidy(layouts.parse_bars(raw_text(spark, sf_dir, "futures_candle"), "futures"))


def parse_trades_spot(spark, sf_dir):
    return tidy(layouts.parse_trades(raw_text(spark, sf_dir, "trade"), "spot"))


def parse_trades_futures(spark, sf_dir):
    return tidy(layouts.parse_trades(raw_text(spark, sf_dir, "futures_trade"), "futures"))


def parse_funding(spark, sf_dir):
    return tidy(layouts.parse_funding(raw_text(spark, sf_dir, "funding_rate")))


def parse_depth(spark, sf_dir):
    return tidy(layouts.parse_depth(raw_text(spark, sf_dir, "order_book_depth")))


def parse_metrics(spark, sf_dir):
    return tidy(layouts.parse_metrics(raw_text(spark, sf_dir, "futures_metrics")))


# --- universe and joins -----------------------------------------------------------


def symbol_universe(spark, sf_dir):
    spot, futures = _stats(spark, sf_dir), _stats(spark, sf_dir, "futures")
    return universe.active_universe(spot, futures)


def symbol_universe_on_date(spark, sf_dir):
    spot, futures = _stats(spark, sf_dir), _stats(spark, sf_dir, "futures")
    return universe.active_universe(spot, futures, oracles.AS_OF)


def listing_filter(spark, sf_dir):
    return universe.filter_listing(load_views(spark, sf_dir)["listing"])


def quote_assets(spark, sf_dir):
    listed = load_views(spark, sf_dir)["listing"].withColumnRenamed("quoteAsset", "asset_id_quote")
    kept = universe.quoted_in(listed, "USDT", "USDC", "BUSD")
    return kept.groupBy("asset_id_quote").agg(
        F.count("*").alias("symbols"), F.count_distinct("baseAsset").alias("bases")
    )


def _joined(spark, sf_dir) -> DataFrame:
    views = load_views(spark, sf_dir)
    spot = aggregate.daily_ohlcv(views["spot_bars"], exact_scale=SCALE)
    futures = aggregate.daily_ohlcv(views["futures_bars"], exact_scale=SCALE)
    return universe.spot_futures_join(spot, futures)


def spot_futures_join(spark, sf_dir):
    return tidy(_joined(spark, sf_dir))


def spot_futures_join_universe(spark, sf_dir):
    views = load_views(spark, sf_dir)
    spot = aggregate.daily_ohlcv(views["spot_bars"], exact_scale=SCALE)
    futures = aggregate.daily_ohlcv(views["futures_bars"], exact_scale=SCALE)
    active = universe.active_universe(spot, futures)
    return tidy(universe.spot_futures_join(spot, futures, active, as_of=oracles.AS_OF))


# --- features ---------------------------------------------------------------------


def _days(spark, sf_dir) -> DataFrame:
    return features.place_by_symbol(_joined(spark, sf_dir))


def time_features(spark, sf_dir):
    return tidy(features.time_features(_joined(spark, sf_dir)))


def returns_features(spark, sf_dir):
    return tidy(features.returns_features(_days(spark, sf_dir)))


def returns_features_long(spark, sf_dir):
    """The longer exploration horizons."""
    return tidy(features.returns_features(_days(spark, sf_dir), (1, 7, 30, 180), (30, 180)))


def risk_features(spark, sf_dir):
    return tidy(features.risk_features(_days(spark, sf_dir)))


def trade_features(spark, sf_dir):
    return tidy(features.trade_features(_days(spark, sf_dir), tidy(_rolling(spark, sf_dir))))


def interaction_features(spark, sf_dir):
    return tidy(features.interaction_features(_days(spark, sf_dir)))


def rolling_zscore(spark, sf_dir):
    made = features.returns_features(_days(spark, sf_dir))
    return tidy(features.rolling_zscore(features.interaction_features(made)))


def _ml_features(spark, sf_dir) -> DataFrame:
    # Moments of two values are constants up to rounding error, which a z-score would blow
    # up, so the order-flow input is rounded first.
    steps = features.feature_steps(tidy(_rolling(spark, sf_dir)))
    return features.build_features(_joined(spark, sf_dir), steps)


def ml_features(spark, sf_dir):
    """All transformers in order, for all symbols in one plan."""
    return tidy(_ml_features(spark, sf_dir))


def order_check(spark, sf_dir):
    """Symbols and days with more than one row, among the trades as they are."""
    trades = load_views(spark, sf_dir)["spot_trades"]
    return features.repeated_days(trades.select(symbol_id().alias("symbol_id"), F.to_date("timestamp").alias("date")))


def forward_label(spark, sf_dir):
    made = features.returns_features(_days(spark, sf_dir), (7,), (30,))
    return tidy(training.forward_label(made))


def training_set(spark, sf_dir):
    steps = features.feature_steps(None, zscore=None)
    made = features.build_features(_joined(spark, sf_dir), steps)
    return tidy(training.training_set(made, oracles.RUN_DATE))


def user_transformer(spark, sf_dir):
    """A step fitted per symbol on the days before the run date, saved, loaded and applied to
    every day."""
    days = _joined(spark, sf_dir)
    columns = ["close_spot", "volume_spot", "close_futures"]
    scaler = transformers.SymbolScaler(inputCols=columns, outputCols=[f"{c}_scaled" for c in columns])
    path = scratch_path(spark, "steps")
    Pipeline(stages=[scaler]).fit(days.where(f"date < DATE'{oracles.RUN_DATE}'")).save(path)
    made = PipelineModel.load(path).transform(days)
    return tidy(made.select("symbol_id", "date", *[f"{c}_scaled" for c in columns]))


def boosted_trees(spark, sf_dir):
    """Two regularised trees on the price of every trade, a seventh of them without a quantity,
    and each trade's forecast."""
    trades = load_views(spark, sf_dir)["spot_trades"].selectExpr(
        "trade_id", "price",
        "IF(trade_id % 7 = 0, NULL, quantity) AS quantity",
        "CAST(month(`timestamp`) AS DOUBLE) AS month",
        "CAST(trade_id % 5 AS DOUBLE) AS residue",
    )
    cuts = list(oracles.BOOSTING_CUTS.values())
    model = boosting.fit(
        trades, list(oracles.BOOSTING_CUTS), "price", trees=2, depth=3, input_fraction=1.0, row_fraction=1.0, cuts=cuts, unit=2.0**20
    )
    return tidy(model.predict(trades).select("trade_id", "price", PREDICTION))


def predictions(spark, sf_dir):
    """Train on the 730 days before the run date, then score every row after it."""
    steps = features.feature_steps(None)
    made = features.build_features(_joined(spark, sf_dir), steps)
    stored = scratch_path(spark, "features")
    datasets.write_partitions(made, stored, ["asset_id_base"])
    made = spark.read.parquet(stored)
    model = training.train(made, oracles.RUN_DATE)
    return training.predict(made.where(f"date >= DATE'{oracles.RUN_DATE}'"), model)


def predict_day(spark, sf_dir):
    """The monthly and the daily model job: train on the two years before the run date, save,
    choose the newest model up to a later run, score its day, write CSV and read it back.
    Every symbol with a futures close gets a finite forecast."""
    made = features.build_features(_joined(spark, sf_dir), features.feature_steps(None))
    stored, models, out = (scratch_path(spark, n) for n in ("features", "models", "predictions"))
    datasets.write_partitions(made, stored, ["asset_id_base"])
    jobs.train_monthly(spark, stored, models, oracles.RUN_DATE)
    jobs.predict_daily(spark, stored, models, out, oracles.SCORING_RUN)
    shown = spark.read.schema(f"symbol_id string, {PREDICTION} double, date date").option("header", True).csv(out)
    finite = F.coalesce(F.abs(PREDICTION) < float("inf"), F.lit(False))
    return shown.select("symbol_id", "date", finite.alias("finite"))


# --- load progress ----------------------------------------------------------------


def next_start(spark, sf_dir):
    return incremental.next_start(load_views(spark, sf_dir)["symbol_meta"], "trade")


def next_start_floor(spark, sf_dir):
    return incremental.next_start(load_views(spark, sf_dir)["symbol_meta"], "futures_metrics")


def load_plan_months(spark, sf_dir):
    meta = load_views(spark, sf_dir)["symbol_meta"]
    return incremental.load_plan(meta, "futures_trade", "month", oracles.UNTIL, include_start=False)


def load_plan_days(spark, sf_dir):
    meta = load_views(spark, sf_dir)["symbol_meta"]
    return incremental.load_plan(meta, "order_book_depth", "day", "2023-04-15")


def missing_archives(spark, sf_dir):
    views = load_views(spark, sf_dir)
    plan = incremental.load_plan(views["symbol_meta"], "futures_trade", "month", oracles.UNTIL)
    trades = views["futures_trades"].withColumn("period_start", F.trunc("timestamp", "month"))
    landed = trades.select(incremental.archive_name("futures_trade", "month").alias("archive")).distinct()
    return incremental.missing_archives(plan, landed)


def high_water(spark, sf_dir):
    return incremental.high_water(load_views(spark, sf_dir)["futures_trades"])


def advance_high_water(spark, sf_dir):
    views = load_views(spark, sf_dir)
    marks = incremental.high_water(views["futures_trades"])
    return tidy(incremental.advance_high_water(views["symbol_meta"], marks, "futures_trade"))


def _listed(views) -> DataFrame:
    return views["futures_trades"].select(symbol_id().alias("symbol_id"))


def missing_symbols(spark, sf_dir):
    views = load_views(spark, sf_dir)
    return incremental.missing_symbols(_listed(views), views["symbol_meta"])


def extend_metadata(spark, sf_dir):
    views = load_views(spark, sf_dir)
    missing = incremental.missing_symbols(_listed(views), views["symbol_meta"])
    return tidy(incremental.extend_metadata(views["symbol_meta"], missing))


# --- writers, read back -----------------------------------------------------------


def write_partitions(spark, sf_dir):
    """Daily bars written by symbol and date, one day written again, all read back."""
    views = load_views(spark, sf_dir)
    daily = aggregate.daily_ohlcv(views["bars_1m"], exact_scale=6)
    root = scratch_path(spark, "daily")
    datasets.write_partitions(daily, root)
    datasets.write_partitions(daily.where("date = DATE'2024-01-10'"), root)
    return tidy(datasets.read_dataset(spark, root, schemas.DAILY_OHLCV).select(*daily.columns))


def write_by_date(spark, sf_dir):
    """Daily bars written by date alone, all read back."""
    daily = aggregate.daily_ohlcv(load_views(spark, sf_dir)["bars_1m"], exact_scale=6)
    root = scratch_path(spark, "by-date")
    datasets.write_partitions(daily, root, ["date"], sort_by=["symbol_id"])
    return tidy(datasets.read_dataset(spark, root).select(*daily.columns))


def write_raw(spark, sf_dir):
    bars = load_views(spark, sf_dir)["bars_1m"]
    root = scratch_path(spark, "raw")
    datasets.write_raw(bars, root, "time_period_start")
    return tidy(datasets.read_dataset(spark, root, schemas.SPOT_BARS).select(*bars.columns))


def write_feed(spark, sf_dir):
    """The metrics feed parsed, filed by symbol and day, and read back."""
    feed = layouts.parse_metrics(raw_text(spark, sf_dir, "futures_metrics"))
    root = scratch_path(spark, "feed")
    datasets.write_raw(feed, root, "timestamp")
    return tidy(datasets.read_dataset(spark, root, schemas.METRICS).select(*feed.columns))


def write_csv_gz(spark, sf_dir):
    bars = load_views(spark, sf_dir)["bars_1m"]
    root = scratch_path(spark, "csv")
    datasets.write_csv_gz(bars, root, "time_period_start")
    back = spark.read.schema(schemas.SPOT_BARS).option("header", True)
    # The file columns follow the view's order, so name them in that order.
    back = back.schema(spark.createDataFrame([], bars.schema).schema)
    return tidy(back.csv(root).select(*bars.columns))


def write_metadata(spark, sf_dir):
    """Metadata written, advanced from what was read, written again and read back."""
    views = load_views(spark, sf_dir)
    root = scratch_path(spark, "metadata")
    datasets.write_metadata(views["symbol_meta"], root)
    marks = incremental.high_water(views["futures_trades"])
    held = datasets.read_metadata(spark, root)
    datasets.write_metadata(incremental.advance_high_water(held, marks, "futures_trade"), root)
    return tidy(datasets.read_metadata(spark, root))


def append_replace(spark, sf_dir):
    """Keyed rows inserted, then all rows with half of them corrected, then all once more,
    which changes nothing; read back."""
    deduped, staged = cleaning.dedupe_trades(load_views(spark, sf_dir)["spot_trades"]), scratch_path(spark, "deduped")
    deduped.write.option("compression", "zstd").parquet(staged)  # used three times
    trades = spark.read.schema(deduped.schema).parquet(staged)
    root, keys = scratch_path(spark, "keyed"), ["trade_id", *KEYS]
    tables.replace_rows(trades.where("side = 'sell'").withColumn("price", F.col("price") + 1), root, keys)
    version = tables.replace_rows(trades, root, keys)
    if tables.replace_rows(trades, root, keys) != version:
        raise ValueError("writing the same rows again made a new version")
    return tidy(tables.read_rows(spark, root, trades.schema))


def exchange_listing(spark, sf_dir):
    """The listing as exchange-information documents whose fields drift: flags as text in
    some, entries with further fields in others; read back row by row."""
    listed = load_views(spark, sf_dir)["listing"]
    flags = ("isSpotTradingAllowed", "isMarginTradingAllowed")
    entry = ["baseAsset || quoteAsset AS symbol", "baseAsset", "quoteAsset", *flags]
    plain = listed.selectExpr("baseAsset", f"to_json(named_struct({_named(entry)})) AS e")
    as_text = [*entry[:3], *[f"CAST({c} AS STRING) AS {c}" for c in flags], "array(named_struct('kind', 'PRICE', 'min', 0.01)) AS filters"]
    drifted = listed.selectExpr("baseAsset", f"to_json(named_struct({_named(as_text)})) AS e")
    odd = F.crc32(F.col("baseAsset").cast("binary")) % 2 == 1
    entries = plain.where(~odd).unionByName(drifted.where(odd))
    document = F.concat(F.lit('{"timezone":"UTC","symbols":['), F.array_join(F.collect_list("e"), ","), F.lit("]}"))
    landed = scratch_path(spark, "listing")
    entries.groupBy(F.pmod(F.xxhash64("baseAsset"), F.lit(64))).agg(document.alias("value")).select("value").write.text(landed)
    return datasets.listing_symbols(spark.read.text(landed), "value")


def _named(columns: list[str]) -> str:
    """Arguments of ``named_struct`` from expressions with aliases."""
    parts = [(c.split(" AS ")[-1], " AS ".join(c.split(" AS ")[:-1]) or c) for c in columns]
    return ", ".join(f"'{name}', {x}" for name, x in parts)


def advance_marks(spark, sf_dir):
    """The daily job on stored bars and metadata: marks moved to the newest bar, read from the
    days since the earliest mark and the folders of symbols without one."""
    views = load_views(spark, sf_dir)
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "metadata")
    datasets.write_raw(views["bars_1m"], raw, "time_period_start")
    datasets.write_metadata(views["symbol_meta"], root)
    jobs.advance_marks(spark, root, raw, "candle")
    return tidy(datasets.read_metadata(spark, root))


def ingest_stream_trades(spark, sf_dir):
    """Events as a trade feed that repeats every trade a minute later, streamed into day
    folders; the earliest of each pair is kept."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "progress")

    def as_trades(stream: DataFrame) -> DataFrame:
        twice = stream.withColumn("again", F.explode(F.array(F.lit(1), F.lit(0))))
        return twice.selectExpr(
            "event_id AS trade_id",
            "ts + make_dt_interval(0, 0, again) AS timestamp",
            "value AS price",
            "1D AS quantity",
            "value AS quote_quantity",
            "CASE WHEN event_type = 'click' THEN 'buy' ELSE 'sell' END AS side",
            "concat('S', CAST(user_id % 3 AS STRING)) AS asset_id_base",
            "'USDT' AS asset_id_quote",
            "'BINANCE' AS exchange_id",
        )

    source = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    query = ingest_stream(
        spark, sf_dir, source, root, checkpoint, prepare=as_trades, name_filter="events.parquet"
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return tidy(datasets.read_dataset(spark, root).select(*[f.name for f in schemas.FUTURES_TRADES.fields]))


def _twelve_hours_twice(events: DataFrame) -> DataFrame:
    """Events as trades with a copy twelve hours later, so that half of the copies carry
    another day; ``first_batch`` says which of the two arrives first, by turns."""
    twice = events.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.selectExpr(
        "event_id AS trade_id",
        "ts + make_dt_interval(0, 12 * again) AS timestamp",
        "value AS price",
        "1D AS quantity",
        "value AS quote_quantity",
        "CASE WHEN event_type = 'click' THEN 'buy' ELSE 'sell' END AS side",
        "concat('S', CAST(user_id % 3 AS STRING)) AS asset_id_base",
        "'USDT' AS asset_id_quote",
        "'BINANCE' AS exchange_id",
        "(event_id + again) % 2 = 0 AS first_batch",
    )


def ingest_stream_two_batches(spark, sf_dir):
    """Copies that arrive in different batches and lie in different days: the earliest stays,
    whichever came first, as ``dedupe_trades`` over all rows has it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    landing, root, progress = (scratch_path(spark, n) for n in ("landing", "stream", "progress"))
    trades = _twelve_hours_twice(spark.read.parquet(f"{sf_dir}/events.parquet"))
    for first in (True, False):
        part = trades.where(F.col("first_batch") == first).drop("first_batch")
        part.write.mode("append").parquet(landing)
        query = ingest_stream(spark, landing, part.schema, root, progress)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return tidy(datasets.read_dataset(spark, root).select(*[f.name for f in schemas.FUTURES_TRADES.fields]))


# --- archives ---------------------------------------------------------------------


def _spot_archives(spark, sf_dir, name) -> DataFrame:
    """The spot trades as zipped CSV archives by symbol and month, made by Spark."""
    lines = raw_text(spark, sf_dir, "trade")
    # Half of the times are in microseconds.
    millis = F.col("c4").cast("long")
    month = F.date_format(F.timestamp_millis(F.when(millis >= 10**14, millis / 1000).otherwise(millis).cast("long")), "yyyy-MM")
    return archives.pack_archives(lines, name(month))


def _trade_symbols(spark, sf_dir) -> DataFrame:
    return load_views(spark, sf_dir)["spot_trades"].select(*KEYS).distinct()


def archive_round_trip(spark, sf_dir):
    """Spot trades zipped by symbol and month, unpacked, matched to symbols and parsed."""
    pair = F.concat("asset_id_base", "asset_id_quote")
    packed = _spot_archives(spark, sf_dir, lambda month: F.concat(F.lit("landing/"), pair, F.lit("-trades-"), month, F.lit(".zip")))
    rows = archives.unpack(packed, layouts.LAYOUTS["trade"][0])
    named = archives.symbols_from_path(archives.data_rows(rows, 0), _trade_symbols(spark, sf_dir))
    parsed = layouts.parse_trades(named.withColumn(layouts.PERIOD, archives.archive_period()), "spot")
    return tidy(parsed.drop(layouts.PERIOD))


def archive_outcomes(spark, sf_dir):
    """The report on archives of which some are cut short (March), fit no symbol (S4), fit two
    (S3), or have not landed (S9, expected beside those that did)."""
    base = F.when(F.col("asset_id_base") == "S4", F.lit("NONE")).otherwise(F.col("asset_id_base"))
    pair = F.concat(base, "asset_id_quote")
    packed = _spot_archives(spark, sf_dir, lambda month: F.concat(F.lit("landing/"), pair, F.lit("-trades-"), month, F.lit(".zip")))
    half = F.expr("substring(content, 1, CAST(length / 2 AS INT))")
    packed = packed.withColumn("content", F.when(F.col("path").like("%-03.zip"), half).otherwise(F.col("content")))
    unpacked = scratch_path(spark, "unpacked")
    archives.unpack(packed, layouts.LAYOUTS["trade"][0]).write.parquet(unpacked)
    rows = spark.read.parquet(unpacked)
    symbols = _trade_symbols(spark, sf_dir)
    symbols = symbols.unionByName(symbols.where("asset_id_base = 'S3'").withColumn("exchange_id", F.lit("OTHER")))
    landed = rows.where("status IS NOT NULL").select(F.element_at(F.split("path", "/"), -1).alias("archive"))
    expected = landed.union(landed.select(F.regexp_replace("archive", r"^\w+USDT", "S9USDT"))).distinct()
    report = archives.outcomes(rows, symbols, expected)
    name = F.element_at(F.split("path", "/"), -1).alias("archive")
    return report.select(name, "date", "symbol", "status", "rows")


_QUERIES = (
    daily_trade_stats_spot,
    daily_trade_stats_futures,
    daily_trade_stats_hot,
    daily_ohlcv_spot,
    daily_ohlcv_spot_end_label,
    daily_ohlcv_futures,
    rolling_trade_features,
    rolling_trade_features_double,
    rolling_trade_latest,
    rolling_trade_as_of,
    dedupe_trades,
    gap_fill_bars,
    gap_fill_bars_zero_volume,
    parse_klines_spot,
    parse_klines_futures,
    parse_trades_spot,
    parse_trades_futures,
    parse_funding,
    parse_depth,
    parse_metrics,
    symbol_universe,
    symbol_universe_on_date,
    listing_filter,
    quote_assets,
    spot_futures_join,
    spot_futures_join_universe,
    time_features,
    returns_features,
    returns_features_long,
    risk_features,
    trade_features,
    interaction_features,
    rolling_zscore,
    ml_features,
    order_check,
    forward_label,
    training_set,
    user_transformer,
    boosted_trees,
    predictions,
    predict_day,
    next_start,
    next_start_floor,
    load_plan_months,
    load_plan_days,
    missing_archives,
    high_water,
    advance_high_water,
    missing_symbols,
    extend_metadata,
    write_partitions,
    write_by_date,
    write_raw,
    write_feed,
    write_csv_gz,
    write_metadata,
    append_replace,
    exchange_listing,
    advance_marks,
    ingest_stream_trades,
    ingest_stream_two_batches,
    archive_round_trip,
    archive_outcomes,
)


def _training_data():
    """The queries of the training-data operators, where that subpackage is present."""
    try:
        from tickloom.llm import queries as module
    except ImportError:
        return None
    return module


def queries() -> dict[str, Query]:
    module = _training_data()
    return {q.__name__: q for q in _QUERIES} | (module.queries() if module else {})


def oracle_sql() -> dict[str, str]:
    module = _training_data()
    return oracles.all_sql() | (module.oracle_sql() if module else {})
