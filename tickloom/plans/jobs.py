"""The daily and monthly jobs: read what is needed, transform, write one result.

``run_date`` is the day a job runs; its target is the UTC day before.  Every job
overwrites only the partitions it produces, so running one again changes nothing.
Roots are folders of a shared file system.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.constants import DERIVATIVE_QUOTE_ASSETS, LOOKBACK_DAYS, SPOT_QUOTE_ASSET, TRAINING_DAYS
from tickloom.functions.scalar import ms_to_ts, symbol_id
from tickloom.operators import aggregate, cleaning, features, incremental, rolling, training, universe
from tickloom.session import scratch_path
from tickloom.sources import archives, datasets, layouts

BARS = ("candle", "futures_candle")
TRADES = ("trade", "futures_trade")


def days_before(run_date: str, n: int) -> str:
    return (date.fromisoformat(run_date) - timedelta(days=n)).isoformat()


def ingest(
    spark: SparkSession,
    landing: str,
    dataset: str,
    symbols: DataFrame,
    out: str,
    quote_assets: tuple[str, ...] | None = None,
    fill: str = "reference",
    expected: DataFrame | None = None,
    content_limit: int = archives.CONTENT_LIMIT,
    skip_large: bool = False,
) -> DataFrame:
    """Landed archives to typed raw rows by symbol and day; returns the outcome table.

    Unless ``quote_assets`` says otherwise, bars keep symbols quoted in the spot asset, the
    derivative feeds those quoted in the derivative assets, and trades keep all symbols.

    The archives are unpacked once, into the shared scratch folder: the outcome report,
    the exclusion of broken archives and the data itself all read from there.  Archives
    that are missing (of those ``expected``), empty, broken, or of no single wanted symbol
    are reported and do not stop the others.  Rows are filed under the period of their own
    archive.

    Archives of wanted symbols above ``content_limit`` are not read: the others are written,
    then the job fails and names them, unless ``skip_large`` accepts that they are left out.
    """
    n_fields, parse = layouts.LAYOUTS[dataset]
    staged = scratch_path(spark, f"ingest-{dataset}")
    archives.read_zip_csv(spark, landing, n_fields, content_limit).write.parquet(staged)
    unpacked = spark.read.parquet(staged)
    if quote_assets is None:
        quote_assets = (SPOT_QUOTE_ASSET,) if dataset in BARS else () if dataset in TRADES else DERIVATIVE_QUOTE_ASSETS
    wanted = universe.quoted_in(symbols, *quote_assets) if quote_assets else symbols
    n_broken = unpacked.where("status = 'error'").count()
    named = archives.symbols_from_path(archives.data_rows(unpacked, n_broken), wanted)
    rows = parse(named.withColumn(layouts.PERIOD, archives.archive_period()))
    at = "timestamp"
    if dataset in BARS:
        at = "time_period_start"
        rows = cleaning.gap_fill(rows, fill=fill)
    elif dataset in TRADES:
        rows = cleaning.dedupe_trades(rows)
    datasets.write_raw(rows, out, at, layouts.PERIOD)
    if not skip_large:
        left = archives.too_large(unpacked, wanted)
        n_left, some = left.count(), [r.path for r in left.orderBy("path").limit(20).collect()]
        if n_left:
            raise archives.ArchivesTooLarge(
                f"{n_left} archives above {content_limit} bytes were not read, the others are written: {', '.join(some)}"
            )
    return archives.outcomes(unpacked, wanted, expected)


def advance_marks(spark: SparkSession, metadata: str, raw: str, dataset: str) -> str:
    """Move the end marks of ``dataset`` to the newest raw row per symbol."""
    held = datasets.read_metadata(spark, metadata)
    marks = new_marks(held, datasets.read_dataset(spark, raw), dataset)
    return datasets.write_metadata(incremental.advance_high_water(held, marks, dataset), metadata)


def new_marks(held: DataFrame, raw: DataFrame, dataset: str) -> DataFrame:
    """Newest raw time per symbol, from the folders that can hold it.

    Marks never move back, so of symbols that have one only the days from the earliest mark on
    are read, a filter on the ``date`` folders; of those without, only their own folders.
    """
    at, mark = "time_period_end" if dataset in BARS else "timestamp", f"{dataset}_data_end"
    earliest = held.agg(F.to_date(ms_to_ts(F.min(mark)))).first()[0]
    unmarked = held.where(F.col(mark).isNull()).select(symbol_id().alias("symbol_id"))
    new = raw.join(unmarked, "symbol_id", "left_semi")
    if earliest is not None:
        # A row may be filed in the day before or after its own.
        later = raw.where(F.col("date") >= F.lit(earliest - timedelta(days=1)))
        new = later.unionByName(new)
    return incremental.high_water(new, at)


def _raw_day(spark: SparkSession, raw: str, at: str, day: str) -> DataFrame:
    """Raw rows of a day; an archive's first and last rows may lie in a neighbouring day, so
    the folders beside are read too, where the time range skips nearly everything."""
    after = days_before(day, -1)
    rows = datasets.read_dataset(spark, raw, start=days_before(day, 1), end=after)
    own = (F.col(at) >= F.lit(day).cast("timestamp_ntz")) & (F.col(at) < F.lit(after).cast("timestamp_ntz"))
    return rows.where(own).drop("symbol_id", "date")


def aggregate_bars(spark: SparkSession, raw: str, out: str, run_date: str) -> None:
    """Daily OHLCV of the target day."""
    day = days_before(run_date, 1)
    bars = _raw_day(spark, raw, "time_period_start", day)
    datasets.write_partitions(aggregate.daily_ohlcv(bars), out)


def aggregate_trades(spark: SparkSession, raw: str, out: str, run_date: str, approx: bool = False) -> None:
    """Daily trade statistics of the target day."""
    day = days_before(run_date, 1)
    trades = _raw_day(spark, raw, "timestamp", day)
    datasets.write_partitions(aggregate.daily_trade_stats(trades, approx=approx), out)


def roll_trades(spark: SparkSession, stats: str, out: str, run_date: str) -> None:
    """Rolling order-flow features of the target day, from 365 days of statistics."""
    day = days_before(run_date, 1)
    held = datasets.read_dataset(spark, stats, start=days_before(run_date, LOOKBACK_DAYS), end=day)
    latest = rolling.rolling_trade_features(held, mode="latest", as_of=day)
    datasets.write_partitions(latest, out)


def make_features(
    spark: SparkSession,
    spot: str,
    futures: str,
    trade_stats: str,
    out: str,
    run_date: str,
    rolling_root: str | None = None,
    steps: Callable[[DataFrame | None], list[features.Step]] = features.feature_steps,
    history: bool = False,
) -> None:
    """Model features of the target day (``history``: of the whole lookback).

    Symbols are those with a spot bar and trade statistics on the target day.  All of them
    go through one plan; the symbol list never leaves the cluster.
    """
    day, first = days_before(run_date, 1), days_before(run_date, LOOKBACK_DAYS)
    spot_days = datasets.read_dataset(spark, spot, start=first, end=day)
    futures_days = datasets.read_dataset(spark, futures, start=first, end=day)
    stats = datasets.read_dataset(spark, trade_stats, date=day)
    active = universe.active_universe(spot_days.where(f"date = DATE'{day}'"), stats)
    joined = universe.spot_futures_join(spot_days, futures_days, active)
    flows = None
    if rolling_root is not None:
        flows = datasets.read_dataset(spark, rolling_root, start=first, end=day)
    made = features.build_features(joined, steps(flows))
    if not history:
        # Only after the windows, which need the days before.
        made = made.where(F.col("date") == F.lit(day).cast("date"))
    datasets.write_partitions(made, out, ["date"], sort_by=["symbol_id"])


def train_monthly(
    spark: SparkSession, features_root: str, models: str, run_date: str, force: bool = False
) -> PipelineModel | None:
    """Fit on the two years before the first of a month and save; other days do nothing."""
    if not force and not run_date.endswith("-01"):
        return None
    made = datasets.read_dataset(
        spark, features_root, start=days_before(run_date, TRAINING_DAYS), end=days_before(run_date, 1)
    )
    model = training.train(made, run_date, force=force)
    datasets.save_model(model, models, run_date)
    return model


def predict_daily(
    spark: SparkSession, features_root: str, models: str, out: str, run_date: str
) -> DataFrame:
    """Score the newest finished day, the one ``make_features`` writes for this run date, with
    the newest model up to then; an error if that day has no features."""
    model = datasets.load_model(spark, models, run_date)
    target = days_before(run_date, 1)
    day = datasets.read_dataset(spark, features_root, date=target)
    if day.isEmpty():
        raise ValueError(f"no features for {target}")
    scored = training.predict(day, model)
    datasets.write_predictions(scored, out)
    return scored
