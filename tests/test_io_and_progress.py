import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import incremental, universe
from tickloom.plans import jobs
from tickloom.session import scratch_root
from tickloom.sources import datasets, tables


def daily(rows, *days):
    return rows(
        schemas.DAILY_OHLCV,
        *[{"date": dt.date(2024, 1, d), "symbol_id": s, "close": float(v)} for s, d, v in days],
    )


def test_overwrite_touches_only_its_partitions(spark, rows, tmp_path):
    root = str(tmp_path / "daily")
    datasets.write_partitions(daily(rows, ("A", 1, 1), ("A", 2, 2), ("B", 1, 3)), root)
    datasets.write_partitions(daily(rows, ("A", 2, 9)), root)
    datasets.write_partitions(daily(rows, ("A", 2, 9)), root)
    got = datasets.read_dataset(spark, root, schemas.DAILY_OHLCV).collect()
    assert sorted((r["symbol_id"], r["date"].day, r["close"]) for r in got) == [("A", 1, 1), ("A", 2, 9), ("B", 1, 3)]


def test_one_day_read_prunes_folders(spark, rows, tmp_path):
    root = str(tmp_path / "daily")
    datasets.write_partitions(daily(rows, ("A", 1, 1), ("A", 2, 2)), root)
    df = datasets.read_dataset(spark, root, date="2024-01-02")
    assert [r["close"] for r in df.collect()] == [2.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_universe_restriction_prunes_at_run_time(spark, rows, tmp_path):
    root = str(tmp_path / "daily")
    datasets.write_partitions(daily(rows, ("A", 1, 1), ("B", 1, 2)), root)
    facts = datasets.read_dataset(spark, root)
    wanted = daily(rows, ("A", 1, 1)).where("close > 0").select("symbol_id")
    assert {r["symbol_id"] for r in universe.restrict(facts, wanted).collect()} == {"A"}


def test_metadata_versions(spark, tmp_path):
    root = str(tmp_path / "meta")
    line = {"asset_id_base": "BTC", "asset_id_quote": "USDT", "exchange_id": "X", "trade_data_start": 1, "trade_data_end": None}
    plain = tmp_path / "plain.json"
    plain.write_text(json.dumps(line) + "\n")
    meta = datasets.read_metadata(spark, str(plain))
    assert meta.schema == schemas.METADATA
    datasets.write_metadata(meta, root)
    hw = spark.createDataFrame([("BTC", "USDT", "X", 50)], "asset_id_base string, asset_id_quote string, exchange_id string, high_water bigint")
    for _ in range(2):  # a repeated run changes nothing
        held = datasets.read_metadata(spark, root)
        datasets.write_metadata(incremental.advance_high_water(held, hw, "trade"), root)
        assert datasets.read_metadata(spark, root).first()["trade_data_end"] == 50
    back = hw.withColumn("high_water", F.lit(20).cast("bigint"))
    assert incremental.advance_high_water(datasets.read_metadata(spark, root), back, "trade").first()["trade_data_end"] == 50
    # A version that was not finished is not read.
    (tmp_path / "meta" / "version=00000099").mkdir()
    assert datasets.read_metadata(spark, root).first()["trade_data_end"] == 50


def test_exchange_listing(spark, tmp_path):
    doc = {"timezone": "UTC", "symbols": [
        {"symbol": b + q, "baseAsset": b, "quoteAsset": q, "isSpotTradingAllowed": s, "isMarginTradingAllowed": m}
        for b, q, s, m in [("BTC", "USDT", True, True), ("ETH", "USDC", True, False), ("FDUSD", "USDT", True, True),
                           ("USTC", "USDT", True, True), ("ADA", "BTC", True, True)]
    ]}
    path = tmp_path / "info.json"
    path.write_text(json.dumps(doc, indent=1))
    listed = datasets.read_exchange_symbols(spark, str(path))
    assert listed.count() == 5
    assert [r["symbol_id"] for r in universe.filter_listing(listed).collect()] == ["BTC_USDT_BINANCE"]


def test_append_table_and_statements(spark):
    rows = spark.createDataFrame([(1, 2.0, "x")], "trade_id bigint, price double, note string")
    datasets.run_statements(spark, ["CREATE DATABASE IF NOT EXISTS market_data", "DROP TABLE IF EXISTS market_data.t"])
    datasets.append_table(rows, "market_data.t", ["trade_id", "price"])
    datasets.append_table(rows.select("price", "note", "trade_id"), "market_data.t", ["price", "trade_id"])
    assert spark.table("market_data.t").collect() == [(1, 2.0), (1, 2.0)]


def test_plan_bounds(spark):
    month_ms = 1_704_067_200_000  # 2024-01-01
    fields = {f"{d}_data_{e}": None for d in ("trade",) for e in ("start", "end")}
    meta = spark.createDataFrame(
        [("A", "USDT", "X", month_ms, None), ("B", "USDT", "X", month_ms, month_ms + 45 * 86_400_000)],
        "asset_id_base string, asset_id_quote string, exchange_id string, trade_data_start bigint, trade_data_end bigint",
    )
    assert len(fields) == 2
    plan = incremental.load_plan(meta, "trade", "month", "2024-03-20")
    names = sorted(r["archive"] for r in plan.collect())
    assert names == [f"AUSDT-trades-2024-0{m}.zip" for m in (1, 2, 3)] + [f"BUSDT-trades-2024-0{m}.zip" for m in (2, 3)]
    strict = incremental.load_plan(meta, "trade", "month", "2024-03-20", include_start=False)
    assert strict.count() == 3
    assert incremental.load_plan(meta, "trade", "day", "2024-02-29").where("asset_id_base = 'A'").count() == 60
    assert incremental.load_plan(meta, "trade", "day", "2023-12-31").count() == 0


def test_scratch_is_the_named_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        incremental.load_plan(None, "trade", "week", "2024-01-01")


def test_keyed_rows_replace_and_insert(spark, tmp_path):
    root, schema = str(tmp_path / "keyed"), "k long, v string, w double"
    write = lambda *rows: tables.replace_rows(spark.createDataFrame(list(rows), schema), root, ["k"], buckets=4)
    held = lambda: sorted(
        map(tuple, tables.read_rows(spark, root, spark.createDataFrame([], schema).schema).collect()), key=str
    )
    assert held() == []
    assert write((1, "a", 1.0), (2, "b", None), (None, "n", 0.0), (2, "c", 9.0)) == 1
    assert held() == [(1, "a", 1.0), (2, "b", None), (None, "n", 0.0)]
    assert write((2, "b", None), (1, "a", 1.0)) == 1  # nothing differs
    assert write((1, "z", None), (None, "m", 0.0), *[(i, "new", 1.0) for i in range(10, 30)]) == 2
    want = [(1, "z", None), (2, "b", None), (None, "m", 0.0), *[(i, "new", 1.0) for i in range(10, 30)]]
    assert held() == sorted(want, key=str)


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = tmp_path / "keyed"
    rows = spark.range(200).selectExpr("id AS k", "'a' AS v")
    tables.replace_rows(rows, str(root), ["k"], buckets=8)
    tables.replace_rows(rows.where("k = 5").selectExpr("k", "'b' AS v"), str(root), ["k"], buckets=8)
    assert len(list((root / "written=1").glob("_bucket=*"))) == 8
    assert len(list((root / "written=2").glob("_bucket=*"))) == 1
    # A write that died before its manifest is not seen, and the next one replaces it.
    (root / "manifest" / "version=00000002" / "_SUCCESS").unlink()
    held = tables.read_rows(spark, str(root), rows.schema)
    assert held.where("v = 'b'").count() == 0 and held.count() == 200


def test_changed_rows_are_written_once(spark, tmp_path):
    """Straight to their buckets, without a staged copy; what the buckets held besides stays."""
    root, scratch = str(tmp_path / "keyed"), Path(scratch_root(spark)) / "tickloom"
    staged = lambda: set(scratch.glob("*")) if scratch.exists() else set()
    rows = spark.range(300).selectExpr("IF(id = 7, NULL, id) AS k", "IF(id % 3 = 0, NULL, 'a') AS v")
    before = staged()
    assert tables.replace_rows(rows, root, ["k"], buckets=2) == 1
    newer = rows.where("k IS NULL OR k % 2 = 0").selectExpr("k", "coalesce(v, 'b') AS v")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        # An attempt that died left other rows, in a bucket that this version does not touch.
        rows.selectExpr("k", "'dead' AS v", "1 AS _bucket").write.partitionBy("_bucket").parquet(f"{root}/written=2")
        assert tables.replace_rows(rows.where("false"), root, ["k"], buckets=2) == 1
        assert tables.replace_rows(newer.unionByName(newer), root, ["k"], buckets=2) == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert staged() == before
    want = {k: "a" if k % 3 else None for k in range(300) if k != 7} | {None: "a"}
    want |= {k: v or "b" for k, v in want.items() if k is None or k % 2 == 0}
    held = tables.read_rows(spark, root, rows.schema).collect()
    assert len(held) == 300 and {r["k"]: r["v"] for r in held} == want


def test_listing_with_drifted_fields(spark):
    documents = [
        ('{"symbols": [{"symbol": "AB", "baseAsset": "A", "quoteAsset": "B", "isSpotTradingAllowed": "true"}]}',),
        ('{"symbols": [{"baseAsset": 7, "isSpotTradingAllowed": "perhaps", "new": {"x": [1]}}, {}]}',),
        ('{"other": 1}',),
        ("no json",),
        (None,),
    ]
    got = datasets.listing_symbols(spark.createDataFrame(documents, "value string"), "value").collect()
    want = [("AB", "A", "B", True, None), (None, "7", None, None, None), (None,) * 5]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_marks_read_only_later_folders(spark, rows, tmp_path):
    raw = str(tmp_path / "raw")
    times = {"A": range(1, 9), "B": range(1, 4)}
    made = [
        {"asset_id_base": s, "trade_id": d, "timestamp": dt.datetime(2024, 1, d, 12), "side": "buy"} for s, days in times.items() for d in days
    ]
    datasets.write_raw(rows(schemas.FUTURES_TRADES, *made), raw, "timestamp")
    day6 = int(dt.datetime(2024, 1, 6, tzinfo=dt.timezone.utc).timestamp() * 1000)
    held = rows(schemas.METADATA, {"asset_id_base": "A", "trade_data_end": day6}, {"asset_id_base": "B"})
    marks = jobs.new_marks(held, datasets.read_dataset(spark, raw), "trade")
    noon = lambda d: int(dt.datetime(2024, 1, d, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert {r["asset_id_base"]: r["high_water"] for r in marks.collect()} == {"A": noon(8), "B": noon(3)}
    plan = marks._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert any("date" in x.split("PartitionFilters:")[1].split("]")[0] for x in scans)
    assert all("symbol_id" in x.split("PartitionFilters:")[1] or "date" in x.split("PartitionFilters:")[1] for x in scans)
