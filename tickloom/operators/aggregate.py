"""Daily aggregates: OHLCV from minute bars, order-flow statistics from trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.constants import PERCENTILES
from tickloom.functions.scalar import KEYS
from tickloom.functions.sqltext import adjusted_skewness, from_units, q, to_units
from tickloom.operators.percentiles import percentiles

SIDES = ("", "buy_", "sell_")
# Rank error of the approximate form is rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000
_PERCENTILE_NAMES = ("10th_percentile", "median", "90th_percentile")


def daily_ohlcv(bars: DataFrame, label: str = "start", exact_scale: int | None = None) -> DataFrame:
    """One OHLCV row per symbol and UTC day.

    ``label='start'`` dates a bar by its first instant, so a day holds its 1,440 minutes.
    ``label='end'`` dates it by its last, which moves each day's final bar to the next
    day; do not write that form day by day with overwrite.

    Open and close follow the bar's own time (scan order means nothing on a cluster).
    Every aggregate has a fixed-width buffer, so the map side combines in a hash map and
    at most one row per symbol-day leaves each task.
    """
    if label not in ("start", "end"):
        raise ValueError("label is 'start' or 'end'")
    at = f"time_period_{label}"
    volume = "sum(volume)"
    if exact_scale is not None:
        volume = from_units(f"sum({to_units('volume', exact_scale)})", exact_scale)
    grouped = _aggregate(
        bars.withColumn("date", F.to_date(at)),
        ["date", *KEYS],
        [
            f"min_by(open, {at}) AS open",
            "max(high) AS high",
            "min(low) AS low",
            f"max_by(close, {at}) AS close",
            f"{volume} AS volume",
            "sum(trades) AS trades",
        ],
    )
    symbol = " || '_' || ".join(KEYS)
    return grouped.selectExpr(
        "date", *KEYS, f"{symbol} AS symbol_id", "open", "high", "low", "close", "volume", "trades"
    )


def _side_value(side: str) -> str:
    x = "quote_quantity"
    return f"CASE WHEN side = '{side.rstrip('_')}' THEN {x} END" if side else x


def _moments(exact_scale: int | None) -> list[str]:
    """Everything but the percentiles, in output order."""

    def total(x: str) -> str:
        if exact_scale is None:
            return f"sum({x})"
        return from_units(f"sum({to_units(x, exact_scale)})", exact_scale)

    def mean(x: str) -> str:
        return f"avg({x})" if exact_scale is None else f"{total(x)} / nullif(count({x}), 0)"

    value = {s: f"({_side_value(s)})" for s in SIDES}
    out = [f"{total(value[''])} AS total_dollar_volume"]
    for s in SIDES[1:]:
        # A day without that side totals 0, not null.
        amount = f"(CASE WHEN side = '{s.rstrip('_')}' THEN quote_quantity ELSE 0D END)"
        out.append(f"{total(amount)} AS total_{s}dollar_volume")
    out += [f"count_if(side = '{s.rstrip('_')}') AS num_{s.rstrip('_')}s" for s in SIDES[1:]]
    shapes = {
        "avg": mean,
        "std": lambda x: f"stddev_pop({x})",
        "skew": adjusted_skewness,
        "kurtosis": lambda x: f"kurtosis({x})",
    }
    out += [f"{f(value[s])} AS {name}_{s}dollar_volume" for name, f in shapes.items() for s in SIDES]
    return out


def daily_trade_stats(trades: DataFrame, approx: bool = False, exact_scale: int | None = None) -> DataFrame:
    """26 order-flow statistics per symbol and UTC day.

    Moments combine on the map side; percentiles are selected by counts
    (:mod:`tickloom.operators.percentiles`).  No task meets a symbol-day's rows, so one way
    serves days of every size.

    ``approx=True`` swaps in mergeable sketches; ``exact_scale`` sums in fixed point.
    """
    day = trades.selectExpr("to_date(timestamp) AS date", *KEYS, "side", "quote_quantity")
    keys = ["date", *KEYS]
    if approx:
        probs = ", ".join(str(p) for p in PERCENTILES)
        sketches = [
            f"percentile_approx({_side_value(s)}, array({probs}), {SKETCH_ACCURACY}) AS _p_{s}" for s in SIDES
        ]
        return _finish(_aggregate(day, keys, [*_moments(exact_scale), *sketches]))

    sides = {s: f"side = '{s.rstrip('_')}'" if s else None for s in SIDES}
    exact = percentiles(day, keys, "quote_quantity", sides, PERCENTILES)
    return _finish(_join_groups(_aggregate(day, keys, _moments(exact_scale)), exact, keys))


def _aggregate(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(m) for m in measures])


def _join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join two aggregates of the same rows; null-safe, as grouping treats nulls as one key: nulls
    in structs are equal.  Key by key, Spark would filter some uses of the right side's rows by keys
    that are constant on the left, and deal those rows once more."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = f"struct({', '.join(map(q, keys))}) = struct({', '.join(q(f'_r_{k}') for k in keys)})"
    return left.join(renamed, F.expr(same), "left").drop(*[f"_r_{k}" for k in keys])


def _finish(stats: DataFrame) -> DataFrame:
    measures = [q(c) for c in stats.columns if c.endswith("dollar_volume") or c.startswith("num_")]
    percentiles = [
        f"get(_p_{s}, {i}) AS {q(f'{name}_{s}dollar_volume')}"
        for i, name in enumerate(_PERCENTILE_NAMES)
        for s in SIDES
    ]
    symbol = " || '_' || ".join(KEYS)
    return stats.selectExpr("date", *KEYS, f"{symbol} AS symbol_id", *measures, *percentiles)
