"""Which files were loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions import parsing as P
from tallyhouse.sources import schemas as S

KEY = ["source_name", "filename"]


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.MANIFEST)


def list_files(spark: SparkSession, glob: str, pattern: str, source: str) -> DataFrame:
    """Feed files below a glob, one row per file name, listed without reading content."""
    found = spark.read.format("binaryFile").load(glob).select("path")
    return found.select(
        F.lit(source).alias("source_name"), P.file_of("path", pattern).alias("filename")
    ).filter("filename <> ''").distinct()


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files the manifest does not name."""
    return files.join(manifest.select(*KEY), KEY, "left_anti")


def loaded_counts(batch: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Manifest rows of a loaded batch. A file without rows has none, so it stays new."""
    return batch.groupBy(
        F.col("_source_system").alias("source_name"), F.col("_source_file").alias("filename")
    ).agg(F.count("*").alias("row_count")).withColumn("loaded_at", F.lit(loaded_at))


def mark_processed(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Upsert: the latest load of a file wins."""
    both = manifest.unionByName(loaded)
    newest = Window.partitionBy(*KEY).orderBy(
        F.col("loaded_at").desc(), F.col("row_count").desc()
    )
    return both.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


def clear_source(manifest: DataFrame, source: str) -> DataFrame:
    """Forget every file of a source, for a full refresh."""
    return manifest.filter(F.col("source_name") != source)


# --- files known by content -----------------------------------------------------------

FILE_LOG = (
    "source_name string, filename string, path string, length bigint, modified timestamp, fingerprint string, "
    "lo date, hi date, row_count bigint, loaded_at timestamp, load string, run string"
)


def latest_files(log: DataFrame) -> DataFrame:
    """The last entry of each path in a file log that is only ever appended to; runs sort by their start."""
    columns = [c for c in log.columns if c not in ("source_name", "path", "run")]
    last = log.groupBy("source_name", "path").agg(F.max_by(F.struct(*columns), "run").alias("last"))
    return last.select("source_name", "path", *[F.col(f"last.{c}") for c in columns])


def changed_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files (path, length, modified) that are not known with that size and time."""
    same = ["path", "length", "modified"]
    return listed.join(known.select(*same), same, "left_anti")


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, fingerprint: number and sum of the hashes of each file's lines, in any order; files may be of any size."""
    lines = spark.read.option("encoding", "ISO-8859-1").text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    # the sum of 64-bit hashes from its halves, which add up as longs
    halves = lines.select("path", F.xxhash64("value").alias("_hash")).groupBy("path").agg(
        F.sum(F.shiftright("_hash", 32)).alias("_high"), F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"), F.count("*").alias("n")
    )
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    total = (whole("_high") * F.lit(2**32).cast("decimal(11,0)") + whole("_low")).cast("decimal(38,0)")
    summed = halves.select("path", total.alias("total"), "n")
    found = summed.select(_plain_path("path").alias("_plain"), F.concat_ws("-", F.col("n").cast("string"), F.col("total").cast("string")).alias("fingerprint"))
    asked = spark.createDataFrame([(p,) for p in paths], "path string").select("path", _plain_path("path").alias("_plain"))
    return asked.join(found, "_plain", "left").select("path", F.coalesce("fingerprint", F.lit("0")).alias("fingerprint"))


def _plain_path(col: str):
    """A path without scheme, as two readers may spell it."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(col), F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/*", "/")


def latest_loads(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of a log that come from the last load of their file; of a file that never loaded, from the last try."""
    keys = ["source_name", "filename"]
    load = F.substring_index("run", "-", 1)
    tried = rows.groupBy(*keys).agg(F.max(load).alias("_tried"))
    loaded = files.groupBy(*keys).agg(F.max("load").alias("_load"))
    told = rows.join(tried, keys).join(loaded, keys, "left")
    return told.filter(load == F.coalesce("_load", "_tried")).drop("_tried", "_load")
