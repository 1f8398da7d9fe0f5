"""Model features over the joined spot/futures days.

Each function adds columns and keeps the rest.  All windows share one partitioning
(``symbol_id``) and order (``date``), so consecutive ones cost one exchange and one sort; a
partition is one symbol's days.  Frames count rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.constants import CATEGORICAL_FEATURES
from tickloom.functions.scalar import KEYS
from tickloom.functions.sqltext import adjusted, q, rows

MARKETS = ("spot", "futures")
NOISE = 1e-9  # relative spread below which a frame counts as constant
_BY_DATE = "(PARTITION BY symbol_id ORDER BY date)"
_FLOW_FAMILIES = (
    "total_dollar_volume",
    "total_buy_dollar_volume",
    "total_sell_dollar_volume",
    "num_buys",
    "num_sells",
    "avg_dollar_volume",
    "avg_buy_dollar_volume",
    "avg_sell_dollar_volume",
    "num_trades",
    "pct_buys",
    "pct_sells",
    "pct_buy_dollar_volume",
    "pct_sell_dollar_volume",
    "trade_imbalance",
)

Step = Callable[[DataFrame], DataFrame]


def _lag(c: str, n: int) -> str:
    return f"lag({c}, {n}) OVER {_BY_DATE}"


def place_by_symbol(df: DataFrame) -> DataFrame:
    """Spread the symbols over all shuffle partitions.

    Feature windows cost much computation on few bytes, so letting AQE merge partitions by
    their size would leave most cores idle.  Every window below keeps this partitioning.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "symbol_id")


def _with_zscores(df: DataFrame, wanted: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Add ``name -> (column, frame length)`` z-scores, hundreds at a time.

    As window expressions of the wide row these are sliding aggregates per column, past a few
    dozen too large to be compiled.  Here the columns are rows of (column, value), so that a
    handful of aggregates over frames of (symbol, column) serve all of them, and one array
    per day brings the scores back.  Everything keeps the partitioning by symbol.

    Missing and NaN values count as missing.  A frame without spread has no z-score, and
    neither has one whose spread is only rounding error, such as a constant that was computed
    in different orders.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    windows = list(dict.fromkeys(n for _, n in wanted.values()))
    if not columns:
        return df
    values = ", ".join(f"CAST({q(c)} AS DOUBLE)" for c in columns)
    # The day's other columns travel with its first value, so nothing is joined back.
    whole = f"struct({', '.join(map(q, df.columns))})"
    entries = f"transform(array({values}), (v, i) -> struct(i AS _c, v AS _v, IF(i = 0, {whole}, NULL) AS _row))"
    long = df.selectExpr("symbol_id", "date", f"explode({entries}) AS _e")
    long = long.selectExpr("symbol_id", "date", "_e._c", "CASE WHEN NOT isnan(_e._v) THEN _e._v END AS _v", "_e._row")
    framed = []
    for n in windows:
        over = f"OVER {rows(n, 'symbol_id, _c')}"
        framed += [f"{f}(_v) {over} AS _{f}_{n}" for f in ("avg", "stddev_samp", "min", "max")]
    scores = []
    for n in windows:
        apart = f"_max_{n} - _min_{n} > {NOISE}D * greatest(abs(_max_{n}), abs(_min_{n}))"
        scores.append(f"CASE WHEN {apart} AND _stddev_samp_{n} > 0 THEN (_v - _avg_{n}) / _stddev_samp_{n} END AS _z_{n}")
    scored = long.selectExpr("*", *framed).selectExpr("symbol_id", "date", "_c", "_row", *scores)
    entry = ", ".join(["_c", *[f"_z_{n}" for n in windows]])
    days = scored.groupBy("symbol_id", "date").agg(
        F.expr(f"sort_array(collect_list(struct({entry}))) AS _scores"), F.expr("first(_row, true) AS _row")
    )
    at = {c: i for i, c in enumerate(columns)}
    new = [f"_scores[{at[c]}]._z_{n} AS {q(name)}" for name, (c, n) in wanted.items()]
    return days.selectExpr(*[f"_row.{q(c)}" for c in df.columns], *new)


def _with(df: DataFrame, *new: str) -> DataFrame:
    return df.selectExpr("*", *new)


def _without(df: DataFrame, prefix: str, *new: str) -> DataFrame:
    """Add columns and leave out the helpers named with ``prefix``."""
    return df.selectExpr(*[q(c) for c in df.columns if not c.startswith(prefix)], *new)


def time_features(df: DataFrame) -> DataFrame:
    """Calendar position; Monday is day 0."""
    return _with(
        df, "weekday(date) AS day_of_week", "month(date) AS month", "dayofmonth(date) AS day_of_month"
    )


def _ensure_returns(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    new = []
    for m in MARKETS:
        for w in windows:
            name = f"{m}_returns_{w}"
            if name not in df.columns:
                new.append(f"close_{m} / nullif({_lag(f'close_{m}', w)}, 0D) - 1D AS {name}")
    return _with(df, *new) if new else df


def returns_features(df: DataFrame, windows: Sequence[int] = (1, 7), lookbacks: Sequence[int] = (30,)) -> DataFrame:
    """Returns per market and horizon, and where each stands within its recent past.

    The percentile is the share of the frame's values not above the current one; the
    frame it collects is bounded by the lookback.
    """
    df = _ensure_returns(df, windows)
    names = [f"{m}_returns_{w}" for m in MARKETS for w in windows]
    framed, final = [], []
    for r in names:
        for n in lookbacks:
            over, arr = f"OVER {rows(n)}", f"_frame_{r}_{n}"
            framed += [
                f"avg({r}) {over} AS {r}_mean_{n}",
                f"stddev_samp({r}) {over} AS {r}_std_{n}",
                f"collect_list({r}) {over} AS {arr}",
            ]
            final += [
                f"({r} - {r}_mean_{n}) / nullif({r}_std_{n}, 0D) AS {r}_zscore_{n}",
                f"CASE WHEN {r} IS NOT NULL THEN CAST(size(filter({arr}, x -> x <= {r})) AS DOUBLE)"
                f" / size({arr}) END AS {r}_percentile_{n}",
            ]
    return _without(_with(df, *framed), "_frame_", *final)


def risk_features(df: DataFrame, windows: Sequence[int] = (1, 7), lookbacks: Sequence[int] = (30,)) -> DataFrame:
    """Spread, downside, extremes and asymmetry of returns, and the deepest drawdown."""
    df = _ensure_returns(df, windows)
    framed, final = [], []
    for m in MARKETS:
        for n in lookbacks:
            over = f"OVER {rows(n)}"
            for w in windows:
                r = f"{m}_returns_{w}"
                loss = f"CASE WHEN {r} < 0 THEN {r} * {r} WHEN {r} >= 0 THEN 0D END"
                framed += [
                    f"stddev_samp({r}) {over} AS {r}_vol_{n}",
                    f"avg({r}) {over} AS _frame_{r}_mean_{n}",
                    f"sqrt(avg({loss}) {over}) AS {r}_downside_{n}",
                    f"min({r}) {over} AS {r}_min_{n}",
                    f"max({r}) {over} AS {r}_max_{n}",
                    f"skewness({r}) {over} AS _frame_{r}_skew_{n}",
                    f"CAST(count({r}) {over} AS DOUBLE) AS _frame_{r}_n_{n}",
                ]
                final += [
                    f"_frame_{r}_mean_{n} / nullif({r}_vol_{n}, 0D) AS {r}_sharpe_{n}",
                    f"{adjusted(f'_frame_{r}_skew_{n}', f'_frame_{r}_n_{n}')} AS {r}_skew_{n}",
                ]
            prices = f"_frame_{m}_{n}"
            framed.append(f"collect_list(close_{m}) {over} AS {prices}")
            final.append(
                f"aggregate({prices}, named_struct('top', CAST(NULL AS DOUBLE), 'low', CAST(NULL AS DOUBLE)),"
                " (a, x) -> named_struct('top', greatest(a.top, x),"
                " 'low', least(a.low, x / nullif(greatest(a.top, x), 0D) - 1D)),"
                f" a -> a.low) AS {m}_max_drawdown_{n}"
            )
    return _without(_with(df, *framed), "_frame_", *final)


def trade_features(
    df: DataFrame,
    rolling: DataFrame,
    windows: Sequence[int] = (1, 7),
    lookbacks: Sequence[int] = (30,),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rolling order-flow features of the day, their changes and their z-scores.

    Changes and z-scores cover ``columns``, by default every family at the horizons in
    ``windows``.  ``rolling`` has one row per symbol and day, so rows cannot multiply.
    """
    flows = rolling.drop(*KEYS)
    joined = df.join(flows, ["symbol_id", "date"], "left")
    if columns is None:
        columns = [f"{c}_{w}d" for w in windows for c in _FLOW_FAMILIES if f"{c}_{w}d" in flows.columns]
    new = [f"{q(c)} - {_lag(q(c), w)} AS {q(f'{c}_delta_{w}')}" for c in columns for w in windows]
    return _with_zscores(
        _with(joined, *new), {f"{c}_zscore_{n}": (c, n) for c in columns for n in lookbacks}
    )


def interaction_features(
    df: DataFrame, windows: Sequence[int] = (1, 7), lookbacks: Sequence[int] = (30,)
) -> DataFrame:
    """How futures stand to spot: basis, return spread, volume ratio, correlation, beta."""
    df = _ensure_returns(df, windows)
    df = _with(
        df,
        "close_futures / nullif(close_spot, 0D) - 1D AS basis",
        "volume_futures / nullif(volume_spot, 0D) AS volume_ratio",
    )
    new = [f"basis - {_lag('basis', w)} AS basis_delta_{w}" for w in windows]
    new += [f"futures_returns_{w} - spot_returns_{w} AS returns_spread_{w}" for w in windows]
    for w in windows:
        fut, spot = f"futures_returns_{w}", f"spot_returns_{w}"
        # Both moments over the same pairs, those with both returns.
        f, s = (f"CASE WHEN {b} IS NOT NULL THEN {a} END" for a, b in ((fut, spot), (spot, fut)))
        for n in lookbacks:
            over = f"OVER {rows(n)}"
            cov = f"covar_samp({fut}, {spot}) {over}"
            new += [
                f"{cov} / nullif(stddev_samp({f}) {over} * stddev_samp({s}) {over}, 0D)"
                f" AS returns_corr_{w}_{n}",
                f"{cov} / nullif(var_samp({s}) {over}, 0D) AS returns_beta_{w}_{n}",
            ]
    return _with(df, *new)


def rolling_zscore(
    df: DataFrame, columns: Sequence[str] | None = None, windows: Sequence[int] = (30,)
) -> DataFrame:
    """``{c}_rz_{n}`` for every numeric feature, or for those named."""
    if columns is None:
        numeric = (T.DoubleType, T.FloatType, T.LongType)
        columns = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, numeric) and f.name not in CATEGORICAL_FEATURES
        ]
    return _with_zscores(df, {f"{c}_rz_{n}": (c, n) for c in columns for n in windows})


def build_features(joined: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Chain of steps over all symbols at once; a step is any DataFrame function.  Fails when
    a symbol has two rows of one date."""
    features = checked_order(place_by_symbol(joined))
    for step in steps:
        features = features.transform(step)
    return features


def feature_steps(
    rolling: DataFrame | None,
    returns: tuple[Sequence[int], Sequence[int]] = ((1, 7), (30,)),
    risk: tuple[Sequence[int], Sequence[int]] = ((1, 7), (30,)),
    trade: tuple[Sequence[int], Sequence[int]] = ((1, 7), (30,)),
    interaction: tuple[Sequence[int], Sequence[int]] = ((1, 7), (30,)),
    zscore: Sequence[int] | None = (30,),
) -> list[Step]:
    """The standard chain; every entry is (windows, lookbacks)."""
    steps: list[Step] = [
        time_features,
        lambda df: returns_features(df, *returns),
        lambda df: risk_features(df, *risk),
    ]
    if rolling is not None:
        steps.append(lambda df: trade_features(df, rolling, *trade))
    steps.append(lambda df: interaction_features(df, *interaction))
    if zscore:
        steps.append(lambda df: rolling_zscore(df, windows=zscore))
    return steps


def repeated_days(df: DataFrame) -> DataFrame:
    """Symbols and dates with more than one row, and how many.

    Distinct dates are what makes ordering by date well defined in every window.
    """
    return df.groupBy("symbol_id", "date").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def checked_order(df: DataFrame) -> DataFrame:
    """The rows, failing when a symbol has two of one date.

    The check is an expression in the plan, over the windows' own partitioning and order, so
    it costs no job of its own and cannot see other rows than the features do.
    """
    message = "concat('more than one row for ', symbol_id, ' on ', date)"
    date = f"CASE WHEN {_lag('date', 1)} = date THEN raise_error({message}) ELSE date END AS date"
    return df.selectExpr(*[date if c == "date" else q(c) for c in df.columns])
