"""Load progress: where to resume, which archives to expect, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.constants import (
    ARCHIVE_TAGS,
    DATASET_FLOORS,
    DEFAULT_START_MS,
    METADATA_DATASETS,
)
from tickloom.functions.scalar import KEYS, ms_to_ts, split_symbol_id, symbol_id, ts_to_ms


def next_start(meta: DataFrame, dataset: str, floor: str | None = None) -> DataFrame:
    """Per symbol, where loading resumes: the end mark, else the start mark.

    Datasets that begin at a known date resume no earlier than that.
    """
    floor = floor or DATASET_FLOORS.get(dataset)
    start = ms_to_ts(F.coalesce(f"{dataset}_data_end", f"{dataset}_data_start"))
    if floor is not None:
        # Only the end mark counts here; greatest() passes over a null.
        start = F.greatest(ms_to_ts(f"{dataset}_data_end"), F.lit(floor).cast("timestamp_ntz"))
    return meta.select(*KEYS, symbol_id().alias("symbol_id"), start.alias("next_start"))


def load_plan(
    meta: DataFrame,
    dataset: str,
    unit: str,
    until: str,
    include_start: bool = True,
    floor: str | None = None,
) -> DataFrame:
    """One row per symbol and month (or day) to load, with the archive expected for it.

    ``include_start=False`` begins after the period the mark lies in.  Days that do not
    exist and days after ``until`` never arise.
    """
    if unit not in ("month", "day"):
        raise ValueError("unit is 'month' or 'day'")
    starts = next_start(meta, dataset, floor)
    step = F.expr(f"INTERVAL 1 {unit}")
    first = F.trunc("next_start", "month") if unit == "month" else F.to_date("next_start")
    first = F.coalesce(first, F.lit(DATASET_FLOORS.get(dataset, "2019-01-01")).cast("date"))
    if not include_start:
        first = F.add_months(first, 1) if unit == "month" else F.date_add(first, 1)
    last = F.lit(until).cast("date")
    bounded = starts.select(*KEYS, "symbol_id", first.alias("_first")).where(F.col("_first") <= last)
    periods = bounded.select(
        *KEYS, "symbol_id", F.explode(F.sequence("_first", last, step)).alias("period_start")
    )
    return periods.withColumn("archive", archive_name(dataset, unit))


def archive_name(dataset: str, unit: str) -> Column:
    label = F.date_format("period_start", "yyyy-MM" if unit == "month" else "yyyy-MM-dd")
    return F.format_string(
        f"%s%s-{ARCHIVE_TAGS[dataset]}-%s.zip", F.col("asset_id_base"), F.col("asset_id_quote"), label
    )


def missing_archives(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned archives that have not landed (``landed`` has their names in ``archive``)."""
    return plan.join(landed.select("archive"), "archive", "left_anti").select(*plan.columns)


def high_water(df: DataFrame, at: str = "timestamp") -> DataFrame:
    """Newest time per symbol, in epoch milliseconds."""
    return df.groupBy(*KEYS).agg(F.max(at).alias("_max")).select(
        *KEYS, ts_to_ms("_max").alias("high_water")
    )


def advance_high_water(meta: DataFrame, hw: DataFrame, dataset: str) -> DataFrame:
    """Move each symbol's end mark forward to ``hw``; marks never move back.

    The mark is recomputed from the data, so repeating a run changes nothing.
    """
    end = f"{dataset}_data_end"
    joined = meta.join(hw.select(*KEYS, "high_water"), list(KEYS), "left")
    return joined.withColumn(end, F.greatest(end, "high_water")).select(*meta.columns)


def missing_symbols(listing: DataFrame, meta: DataFrame) -> DataFrame:
    """Listed symbol ids that the metadata does not have."""
    known = meta.select(symbol_id().alias("symbol_id"))
    return listing.select("symbol_id").distinct().join(known, "symbol_id", "left_anti")


def extend_metadata(meta: DataFrame, missing: DataFrame, default_ms: int = DEFAULT_START_MS) -> DataFrame:
    """Metadata with the missing symbols added, all their marks at the default start."""
    marks = [
        F.lit(default_ms).cast("bigint").alias(f"{d}_data_{edge}")
        for d in METADATA_DATASETS
        for edge in ("start", "end")
    ]
    added = missing.select(*split_symbol_id("symbol_id"), *marks)
    return meta.unionByName(added, allowMissingColumns=True).orderBy(*KEYS)
