"""Incremental ingest of landed files.

The reference job is a daily batch; here the same work is driven by arrival.  Each
micro-batch is de-duplicated and merged into the day folders it touches, so a repeated trade
is resolved by the batch rule whenever it arrives, however late: there is no watermark that
could drop a row.  The day folders are the state: a copy that carries a time of another day is
looked up by its key in the folders up to ``horizon`` days around, and taken out there if the
new row comes first.  Replaying a batch after a failure merges the same rows again and changes
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.scalar import KEYS
from tickloom.operators.cleaning import dedupe_trades
from tickloom.session import scratch_path
from tickloom.sources import archives, layouts
from tickloom.sources.datasets import write_partitions, with_partitions

PARTS = ("symbol_id", "date")
_BINARY = "path string, modificationTime timestamp, length long, content binary"


def merge_into_days(
    batch: DataFrame,
    root: str,
    staged: str,
    at: str = "timestamp",
    resolve: Callable[[DataFrame], DataFrame] = dedupe_trades,
    repeats: Sequence[str] = ("trade_id", *KEYS),
    horizon: int = 1,
) -> None:
    """Merge rows into the ``symbol_id=/date=`` folders they belong to.

    ``repeats`` names the columns that copies of a row share, their times ``horizon`` days
    apart at most.  Touched are the folders of the batch's rows and those that hold such a
    copy.  They are read, resolved together with the new rows, written to ``staged`` and only
    then swapped in, since a folder cannot be overwritten while it is being read; folders
    whose rows all went elsewhere are removed.  A complete ``staged`` from an attempt that
    died during the swap is swapped in again.
    """
    spark = batch.sparkSession
    keyed = with_partitions(batch, at)
    folders = f"{staged}-folders"
    if not _exists(spark, f"{staged}/_SUCCESS"):
        new = keyed
        touched = keyed.select(*PARTS).distinct()
        if _exists(spark, root):
            # One row: literal bounds keep the scan to the folders of these days.
            low, high = keyed.agg(F.min("date"), F.max("date")).first()
            bounds = [F.date_add(F.lit(d).cast("date"), n) for d, n in ((low, -horizon), (high, horizon))]
            days = F.col("date").between(*bounds) | F.col("date").isNull()
            held = spark.read.schema(keyed.schema).parquet(root).where(days)
            copies = _matching(held, keyed.select(*repeats).distinct(), repeats)
            touched = touched.union(copies.select(*PARTS)).distinct()
            touched.write.mode("overwrite").parquet(folders)
            touched = spark.read.schema("symbol_id string, date date").parquet(folders)
            new = new.unionByName(_matching(held, touched, PARTS))
        merged = with_partitions(resolve(new.drop(*PARTS)), at)
        write_partitions(merged, staged, PARTS, sort_by=[at])
    done = spark.read.schema(keyed.schema).parquet(staged)
    write_partitions(done, root, PARTS, sort_by=[at])
    if _exists(spark, folders):
        touched = spark.read.schema("symbol_id string, date date").parquet(folders)
        same = [touched[c].eqNullSafe(done[c]) for c in PARTS]
        # Only folders that lost their last row to a neighbouring day.
        for left in touched.join(done.select(*PARTS).distinct(), same, "left_anti").toLocalIterator():
            names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if left[c] is None else left[c]}" for c in PARTS]
            _delete(spark, f"{root.rstrip('/')}/{'/'.join(names)}")
        _delete(spark, folders)


def _matching(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose ``on`` columns are among ``keys``; nulls match."""
    left, right = rows.alias("rows"), keys.alias("keys")
    return left.join(right, [F.col(f"rows.{c}").eqNullSafe(F.col(f"keys.{c}")) for c in on], "left_semi")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _file_system(spark, path)
    return system.exists(hadoop_path)


def _delete(spark: SparkSession, path: str) -> None:
    system, hadoop_path = _file_system(spark, path)
    system.delete(hadoop_path, True)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    watermark: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
    name_filter: str | None = None,
) -> StreamingQuery:
    """Load every file in ``landing`` not loaded before, then stop.

    ``watermark`` (such as ``'1 day'``) also drops repeats inside the stream within that
    delay, which saves merge work for feeds known never to be later than it; rows that are
    later would be dropped, so it is off by default.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    stream = reader.parquet(landing)
    if prepare is not None:
        stream = prepare(stream)
    if watermark is not None:
        keys = ["asset_id_base", "asset_id_quote", "exchange_id", "trade_id"]
        # Event time must be a zoned timestamp.
        timed = stream.withColumn("_at", F.col("timestamp").cast("timestamp"))
        stream = timed.withWatermark("_at", watermark).dropDuplicatesWithinWatermark(keys).drop("_at")
    staged = f"{checkpoint.rstrip('/')}-staged"

    def load(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                merge_into_days(batch, out, f"{staged}/batch={number}")
        finally:
            batch.unpersist()
        # Swapped in completely; a replay of this batch would stage the same rows again.
        _delete(batch.sparkSession, f"{staged}/batch={number}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_archive_stream(
    spark: SparkSession,
    landing: str,
    dataset: str,
    symbols: DataFrame,
    out: str,
    report: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    content_limit: int = archives.CONTENT_LIMIT,
) -> StreamingQuery:
    """Load every zipped trade archive in ``landing`` not loaded before, then stop.

    The stream hands over the archives themselves; unpacking, matching of symbols, parsing and
    the report are those of the batch job.  ``report`` gets one row per archive, in a folder
    per batch, so a replayed batch replaces its own.  Archives above the limit are reported as
    errors and not read.
    """
    n_fields, parse = layouts.LAYOUTS[dataset]
    files = spark.readStream.format("binaryFile").schema(_BINARY).option("pathGlobFilter", "*.zip")
    files = files.option("recursiveFileLookup", "true")
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    stream = files.load(landing)
    staged = f"{checkpoint.rstrip('/')}-staged"

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        within = F.when(F.col("length") <= content_limit, F.col("content")).alias("content")
        unpacked = scratch_path(session, "unpacked")
        archives.unpack(batch.select("path", "length", within), n_fields, content_limit).write.parquet(unpacked)
        rows = session.read.parquet(unpacked)
        archives.outcomes(rows, symbols).write.mode("overwrite").parquet(f"{report.rstrip('/')}/batch={number}")
        named = archives.symbols_from_path(archives.data_rows(rows), symbols)
        parsed = parse(named.withColumn(layouts.PERIOD, archives.archive_period())).drop(layouts.PERIOD)
        if not parsed.isEmpty():
            merge_into_days(parsed, out, f"{staged}/batch={number}")
        _delete(session, f"{staged}/batch={number}")
        _delete(session, unpacked)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
