"""Tables of keyed rows in which new rows replace old ones.

Rows lie in buckets by the hash of their key.  A write touches only the buckets of rows that
are new or differ; those are written anew beside the old ones (copy on write), and a manifest
that names each bucket's write is stored last, as a new version.  Readers take the newest
complete manifest, so they never see half a write, one that died leaves no trace, and writing
the same rows again changes nothing (it leaves an empty folder that the next version takes).  One
writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import quoted
from tickloom.sources.datasets import versions

BUCKETS = 64
#: Tasks that a bucket is spread over at most when it is written.
SPREAD = 8
_MANIFEST = "bucket int, written long"


def _manifest(spark: SparkSession, root: str) -> tuple[int, dict[int, int]]:
    """The newest version (0: none) and, per bucket that has rows, the write that holds it."""
    known = versions(spark, f"{root}/manifest", "version")
    if not known:
        return 0, {}
    rows = spark.read.schema(_MANIFEST).json(f"{root}/manifest/version={known[-1]}").collect()
    return int(known[-1]), {r["bucket"]: r["written"] for r in rows}


def _read(spark: SparkSession, root: str, schema: T.StructType, held: dict[int, int]) -> DataFrame:
    """Rows of the buckets with their number; at most as many paths as there are buckets."""
    full = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])
    if not held:
        return spark.createDataFrame([], full)
    paths = [f"{root}/written={w}/_bucket={b}" for b, w in sorted(held.items())]
    return spark.read.schema(full).option("basePath", root).parquet(*paths).select(*[f.name for f in full.fields])


def read_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return _read(spark, root, schema, _manifest(spark, root)[1]).drop("_bucket")


def _beside(new: DataFrame, old: DataFrame | None, keys: Sequence[str], buckets: int) -> DataFrame:
    """Per key the smallest row of either side, as ``_new`` and ``_old`` (null: none); null keys match.

    One shuffle, which also lays the rows out for the write: a bucket's rows lie in at most
    SPREAD tasks, in order of bucket and key.
    """
    names = (old if old is not None else new).columns
    sides = new.withColumn("_is_new", F.lit(True))
    if old is not None:
        sides = old.withColumn("_is_new", F.lit(False)).unionByName(sides, allowMissingColumns=True)
    hashed = F.xxhash64(*[quoted(k) for k in keys])
    slot = F.pmod(hashed, F.lit(buckets)) * SPREAD + F.pmod(F.shiftright(hashed, 40), F.lit(SPREAD))
    row = F.struct(*[quoted(c) for c in names if c not in keys])
    grouped = sides.withColumn("_slot", slot.cast("int")).repartition("_slot").groupBy("_slot", *[quoted(k) for k in keys])
    return grouped.agg(
        F.min(F.when(F.col("_is_new"), row)).alias("_new"), F.min(F.when(~F.col("_is_new"), row)).alias("_old")
    )


def _write(rows: DataFrame, side: str, names: Sequence[str], keys: Sequence[str], path: str, mode: str) -> None:
    """One side of grouped rows into the bucket folders of a write."""
    shown = [quoted(c) if c in keys else F.col(side)[c].alias(c) for c in names]
    bucket = F.floor(F.col("_slot") / SPREAD).cast("int").alias("_bucket")
    laid = rows.select(*shown, bucket).sortWithinPartitions("_bucket", *[quoted(k) for k in keys])
    # Static: an overwrite also clears buckets that an attempt that died left of this version.
    laid.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(path)


def replace_rows(df: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Insert the rows of ``df``, each in place of the row with its key; the table's version.

    Of several rows with one key the smallest stays; where a key has very many,
    ``cleaning.keep_first`` before this spreads them.  The number of buckets is that of the first
    write; keep it.

    New and current rows meet in one shuffle, out of which the rows that are new or differ are
    written to their buckets.  What else the touched buckets hold is then found by keys alone
    and written beside them.
    """
    spark, names = df.sparkSession, df.columns
    version, held = _manifest(spark, root)
    path = f"{root}/written={version + 1}"
    current = _read(spark, root, df.schema, held).drop("_bucket") if held else None
    differs = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old"))
    _write(_beside(df, current, keys, buckets).where(differs), "_new", names, keys, path, "overwrite")
    full = T.StructType([*df.schema.fields, T.StructField("_bucket", T.IntegerType())])
    written = spark.read.schema(full).parquet(path)
    touched = sorted(r["_bucket"] for r in written.select("_bucket").distinct().collect())
    if not touched:
        return version
    if over := {b: held[b] for b in touched if b in held}:
        beside = _beside(
            written.select(*[quoted(k) for k in keys]), _read(spark, root, df.schema, over).drop("_bucket"), keys, buckets
        )
        _write(beside.where(F.col("_new").isNull()), "_old", names, keys, path, "append")
    version += 1
    named = held | dict.fromkeys(touched, version)
    rows = spark.createDataFrame(sorted(named.items()), _MANIFEST).coalesce(1)
    rows.write.mode("overwrite").json(f"{root}/manifest/version={version:08d}")
    return version
