"""Readers for Parquet datasets, metadata and listings, and the writers beside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.constants import PREDICTION
from tickloom.functions.scalar import symbol_id


def read_dataset(
    spark: SparkSession,
    root: str,
    schema: T.StructType | None = None,
    date: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """A Parquet dataset in ``symbol_id=/date=`` or ``date=`` folders.

    ``date`` (one day) and ``start``/``end`` (inclusive) become partition filters, so
    other folders are not opened.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root)
    for bound, op in ((date, "="), (start, ">="), (end, "<=")):
        if bound is not None:
            df = df.where(f"date {op} DATE'{bound}'")
    return df


def write_partitions(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = ("symbol_id", "date"),
    sort_by: Sequence[str] = (),
) -> None:
    """Overwrite exactly the partitions present in ``df``; all others stay.

    Running a day twice therefore changes nothing.  Rows are rebalanced on the partition
    columns: small partitions share a task and one folder gets few files, while AQE splits
    a folder that holds much of the data over several tasks (and files).
    """
    placed = df.hint("rebalance", *partition_by)
    if sort_by:
        placed = placed.sortWithinPartitions(*partition_by, *sort_by)
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(root)
    )


def with_partitions(df: DataFrame, at: str) -> DataFrame:
    """Add the ``symbol_id`` and ``date`` columns that raw rows are filed under."""
    return df.withColumns({"symbol_id": symbol_id(), "date": F.to_date(at)})


def write_raw(df: DataFrame, root: str, at: str, period: str | None = None) -> None:
    """Raw rows filed by symbol and UTC day of column ``at``.

    ``period`` names a column with the day or month (``yyyy-MM-dd``, ``yyyy-MM``) of the
    archive a row came from.  A row outside it is filed under the nearest day inside, so an
    archive never overwrites a day that belongs to another; the column is not written.
    """
    rows = with_partitions(df, at)
    if period is not None:
        first = F.col(period).try_cast("date")
        last = F.when(F.length(period) == 7, F.last_day(first)).otherwise(first)
        inside = F.greatest(first, F.least(last, F.col("date")))
        rows = rows.withColumn("date", F.coalesce(inside, F.col("date"))).drop(period)
    write_partitions(rows, root, sort_by=[at])


def write_csv_gz(df: DataFrame, root: str, at: str) -> None:
    """Gzip CSV with header, by symbol and month."""
    keyed = df.withColumns({"symbol_id": symbol_id(), "year": F.year(at), "month": F.month(at)})
    parts = ("symbol_id", "year", "month")
    (
        keyed.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("header", True)
        .partitionBy(*parts)
        .csv(root)
    )


def append_table(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Append the named columns to a catalog table, creating it if needed."""
    rows = df.select(*columns)
    if df.sparkSession.catalog.tableExists(table):
        rows.select(*df.sparkSession.table(table).columns).write.insertInto(table)
    else:
        rows.write.format("parquet").saveAsTable(table)


def run_statements(spark: SparkSession, statements: Sequence[str]) -> None:
    """SQL statements in order.  Spark has no transaction around several of them."""
    for statement in statements:
        spark.sql(statement)


# --- metadata --------------------------------------------------------------------


def versions(spark: SparkSession, root: str, key: str, done: str = "_SUCCESS") -> list[str]:
    """Values of ``key=`` folders below ``root`` that were written completely."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    found = []
    for entry in system.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith(f"{key}=") and system.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), done)):
            found.append(name.split("=", 1)[1])
    return sorted(found)


def write_metadata(df: DataFrame, root: str) -> str:
    """Write load progress as JSON lines in a new version folder, and return its path.

    Readers take the newest complete version, so the one being read is never overwritten.
    """
    last = versions(df.sparkSession, root, "version")
    path = f"{root}/version={int(last[-1]) + 1 if last else 1:08d}"
    # One row per listed symbol: a few thousand rows, one file.
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Newest complete version of the metadata; a plain JSON-lines file also works."""
    known = versions(spark, root, "version")
    path = f"{root}/version={known[-1]}" if known else root
    return spark.read.schema(schemas.METADATA).json(path)


def read_exchange_symbols(spark: SparkSession, path: str) -> DataFrame:
    """The ``symbols`` array of a landed exchange-information document, one row each."""
    info = spark.read.schema(schemas.EXCHANGE_INFO).option("multiLine", True).json(path)
    return info.select(F.explode("symbols").alias("s")).select("s.*")


def listing_symbols(documents: DataFrame, column: str) -> DataFrame:
    """The ``symbols`` of exchange-information documents held as JSON text, one row each.

    Read as variants, so a field that is missing, new, or of another type (a flag as text)
    does not lose its document; a value that cannot be read is null.
    """
    parsed = documents.selectExpr(f"try_parse_json({column}) AS _document")
    symbols = parsed.selectExpr("explode(try_variant_get(_document, '$.symbols', 'array<variant>')) AS _s")
    return symbols.selectExpr(
        *[f"try_variant_get(_s, '$.{f.name}', '{f.dataType.simpleString()}') AS {f.name}" for f in schemas.LISTING.fields]
    )


# --- models and predictions ------------------------------------------------------


def write_predictions(df: DataFrame, root: str) -> None:
    """CSV with header below ``date=``."""
    (
        df.select("symbol_id", "date", PREDICTION)
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("date")
        .csv(root)
    )


def save_model(model: PipelineModel, root: str, date: str) -> str:
    path = f"{root}/date={date}"
    model.write().overwrite().save(path)
    return path


def latest_model_date(spark: SparkSession, root: str, run_date: str) -> str | None:
    """Date of the newest model not after ``run_date``.

    Training is monthly and scoring daily, so most days have no model of their own.
    """
    dates = [d for d in versions(spark, root, "date", done="metadata/_SUCCESS") if d <= run_date]
    return dates[-1] if dates else None


def load_model(spark: SparkSession, root: str, run_date: str) -> PipelineModel:
    date = latest_model_date(spark, root, run_date)
    if date is None:
        raise FileNotFoundError(f"no model up to {run_date} below {root}")
    return PipelineModel.load(f"{root}/date={date}")
