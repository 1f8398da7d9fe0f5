"""Symbol universe and the spot/futures join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.constants import EXCHANGE_ID, LOOKBACK_DAYS
from tickloom.functions.scalar import KEYS, symbol_id


def active_universe(spot_daily: DataFrame, trades_daily: DataFrame, date: str | None = None) -> DataFrame:
    """Symbols with both a spot bar and trade statistics (on ``date``, if given)."""
    if date is not None:
        on = F.col("date") == F.lit(date).cast("date")
        spot_daily, trades_daily = spot_daily.where(on), trades_daily.where(on)
    return (
        spot_daily.select("symbol_id")
        .distinct()
        .join(trades_daily.select("symbol_id").distinct(), "symbol_id", "left_semi")
    )


def filter_listing(symbols: DataFrame) -> DataFrame:
    """Listed pairs quoted in a dollar asset, tradable on spot and margin, whose base is
    not itself a dollar asset; keyed by symbol id and sorted by it.

    Columns as listed: ``baseAsset, quoteAsset, isSpotTradingAllowed,
    isMarginTradingAllowed``.
    """
    base, quote = F.col("baseAsset"), F.col("quoteAsset")
    keep = (
        quote.contains("USD")
        & F.col("isSpotTradingAllowed")
        & F.col("isMarginTradingAllowed")
        & ~base.contains("USD")
        & ~base.contains("USTC")
    )
    return (
        symbols.where(keep)
        .withColumn("symbol_id", symbol_id(base, quote, F.lit(EXCHANGE_ID)))
        .orderBy("symbol_id")
    )


def quoted_in(df: DataFrame, *assets: str) -> DataFrame:
    """Rows whose quote asset is one of ``assets``."""
    return df.where(F.col("asset_id_quote").isin(*assets))


def restrict(facts: DataFrame, universe: DataFrame) -> DataFrame:
    """Facts of the universe's symbols.

    No hint: the symbol list is broadcast when Spark measures it below its threshold,
    which also prunes ``symbol_id=`` folders at run time, and shuffled otherwise.
    """
    return facts.join(universe.select("symbol_id"), "symbol_id", "left_semi")


def spot_futures_join(
    spot: DataFrame,
    futures: DataFrame,
    universe: DataFrame | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Daily spot bars with the same day's futures bar beside them, if there is one.

    Both sides have one row per symbol and day, so the join cannot multiply rows.
    ``as_of`` keeps the ``LOOKBACK_DAYS`` before that run date.
    """
    if as_of is not None:
        run = F.lit(as_of).cast("date")
        recent = F.col("date").between(F.date_sub(run, LOOKBACK_DAYS), F.date_sub(run, 1))
        spot, futures = spot.where(recent), futures.where(recent)
    if universe is not None:
        spot, futures = restrict(spot, universe), restrict(futures, universe)
    on = ("symbol_id", "date")
    values = [c for c in spot.columns if c not in (*on, *KEYS)]
    left = spot.select(*on, *KEYS, *[F.col(c).alias(f"{c}_spot") for c in values])
    right = futures.select(
        *on, *[F.col(c).alias(f"{c}_futures") for c in futures.columns if c not in (*on, *KEYS)]
    )
    return left.join(right, list(on), "left")
