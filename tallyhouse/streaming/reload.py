"""Replacing parts of written tables.

A table is a parquet folder partitioned by the columns a load replaces. A job
writes all new partitions aside and swaps them in when it commits. Rows that were
read from the target itself are staged in the shared folder first, so no job reads
the folder it writes.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import fresh_dir, spread_writers
from tallyhouse.storage import settle


# Fixed value: how a partition folder spells a missing value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    """A partitioned parquet folder with a fixed schema."""

    spark: SparkSession
    path: str
    schema: T.StructType
    partitions: tuple[str, ...]

    def exists(self) -> bool:
        path, fs = _file_system(self.spark, self.path)
        return fs.exists(path)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        names = self.schema.names
        return self.spark.read.schema(self.schema).parquet(self.path).select(*names)

    def _stage(self, df: DataFrame) -> DataFrame:
        stage = fresh_dir(self.spark, "stage")
        df.select(*self.schema.names).write.parquet(stage)
        return self.spark.read.schema(self.schema).parquet(stage)

    def replace_partitions(self, df: DataFrame, reads_target: bool = False, gathered: bool = False) -> None:
        """Overwrite the partitions that occur in ``df``; all others stay.

        Rows that come from files of these partitions (``gathered``) lie together and are written where they are.
        """
        rows = self._stage(df) if reads_target else df.select(*self.schema.names)
        writer = (rows if gathered else rows.hint("rebalance", *self.partitions)).write.mode("overwrite")
        with spread_writers(rows.sparkSession, gathered):
            writer.partitionBy(*self.partitions).option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def replace_slices(
        self, df: DataFrame, keys: list[str], slices: DataFrame | None = None, gathered: bool = False
    ) -> None:
        """Replace the slices (values of ``keys``) of ``df``, or the given ones; all other rows stay.

        The table may be partitioned by some of the keys only, as by day for (store, day) slices:
        then the other slices of a touched folder are written again with it. A folder that is
        left without rows goes. Where there is no table yet, nothing stays and the rows are written once.
        """
        by = list(self.partitions)
        if (slices is None and set(by) == set(keys)) or not self.exists():
            return self.replace_partitions(df, gathered=gathered)
        slices = settle((df if slices is None else slices).select(*keys).distinct())
        parts = settle(slices.select(*by).distinct())
        # the folders are known, so the scan lists them as partition filters
        held_in = [[r[0] for r in parts.select(p).distinct().collect()] for p in by]
        near = self.read()
        for name, values in zip(by, held_in):
            near = near.filter(F.col(name).isin([v for v in values if v is not None]))
        kept = near.join(parts, by, "left_semi").join(slices, keys, "left_anti")
        after = settle(kept.select(*self.schema.names).unionByName(df.select(*self.schema.names)))
        empty = []
        if self.exists():
            held = self.folders(F.lit(True)).join(parts, by, "left_semi")
            gone = held.join(after.select(*by).distinct(), by, "left_anti")
            empty = [r.folder for r in gone.select("folder").collect()]
        self.replace_partitions(after, gathered=gathered)
        self.drop_folders(empty)

    def overwrite(self, df: DataFrame) -> None:
        """Replace the whole table; staged, because the old files go before the job runs."""
        rows = self._stage(df).hint("rebalance", *self.partitions)
        rows.write.mode("overwrite").partitionBy(*self.partitions).parquet(self.path)

    def replace_all(self, df: DataFrame) -> None:
        """Replace an unpartitioned table by rows that were not read from it."""
        df.select(*self.schema.names).write.mode("overwrite").parquet(self.path)

    def swap(self, other: "Table") -> None:
        """Take the other table's place in the file system: two renames, then the old rows go."""
        mine, fs = _file_system(self.spark, self.path)
        theirs, _ = _file_system(self.spark, other.path)
        old, _ = _file_system(self.spark, f"{self.path}.old")
        if not other.exists():
            fs.mkdirs(theirs)
        fs.delete(old, True)
        if fs.exists(mine):
            fs.rename(mine, old)
        fs.rename(theirs, mine)
        fs.delete(old, True)

    def folders(self, where: Column) -> DataFrame:
        """Partition values and folder of the partitions that hold for ``where``.

        They come from the file listing that a read makes anyway; no file is opened.
        """
        found = {f.rpartition("/")[0] for f in self.spark.read.schema(self.schema).parquet(self.path).inputFiles()}
        rows = [(f, *_partition_values(f, self.partitions)) for f in sorted(found)]
        text = ", ".join(["folder string", *[f"`{p}` string" for p in self.partitions]])
        typed = [F.col(p).cast(self.schema[p].dataType).alias(p) for p in self.partitions]
        return self.spark.createDataFrame(rows, text).select(*typed, "folder").filter(where)

    def drop_folders(self, folders: list[str]) -> None:
        """Delete partition folders; there are as many as partitions, not as rows."""
        for path in folders:
            place, fs = _file_system(self.spark, path)
            fs.delete(place, True)


def _partition_values(folder: str, names: tuple[str, ...]) -> list[str | None]:
    """Values of the last path segments; the path is a URI, and values in it are escaped once more."""
    parts = dict(p.partition("=")[::2] for p in unquote(folder).split("/") if "=" in p)
    return [None if parts[n] == NO_VALUE else unquote(parts[n]) for n in names]


def replace_slice(df: DataFrame, target: Table) -> None:
    """Replace the (store, date) slices of ``df``."""
    target.replace_partitions(df)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if a key repeats."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").head(1)
    if twice:
        raise ValueError(f"duplicate key {tuple(twice[0][k] for k in keys)} in ({', '.join(keys)})")


def replace_entries(entries: DataFrame, target: Table) -> None:
    """Replace slices of raw entries; (order_id, entry_id) must be unique."""
    assert_unique(entries, ["order_id", "entry_id"])
    target.replace_partitions(entries)


def single_scope(df: DataFrame, scope_col: str):
    """The one value of the scope column; a load that spans several is refused."""
    found = [r[0] for r in df.select(scope_col).na.drop().distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(
            f"{scope_col} must hold exactly one value per file, found {len(found)}; "
            "an unscoped reload could remove other stores' rows"
        )
    return found[0]


def reload_range(
    df: DataFrame, target: Table, date_col: str, scope_col: str | None = None
) -> int:
    """Replace the target's rows between the first and last day of ``df``.

    With ``scope_col`` only rows of the load's single scope value go. The target
    must be partitioned by ``date_col`` alone or by scope and date. Days in the
    range that the load does not cover become empty in the same step: their
    surviving rows (other scopes) are restaged, and a day without any survivor is
    dropped by its partition. The batch is settled first: its files are parsed once,
    and every step sees the same rows. Returns the number of loaded rows.
    """
    df = settle(df)
    span = df.agg(
        F.min(date_col).alias("lo"), F.max(date_col).alias("hi"), F.count("*").alias("n")
    ).head()
    if span.n == 0:
        return 0
    inside = F.col(date_col).between(F.lit(span.lo), F.lit(span.hi))
    if scope_col is not None:
        inside = inside & F.col(scope_col).eqNullSafe(F.lit(single_scope(df, scope_col)))
    kept = target.read().filter(~F.coalesce(inside, F.lit(False)))
    if target.partitions == (scope_col, date_col) or target.partitions == (date_col,):
        _swap_range(df, kept, inside, target, span, date_col, scope_col)
    else:
        raise ValueError(f"partition the target by {scope_col or ''} {date_col}")
    return span.n


def _swap_range(df, kept, inside, target, span, date_col, scope_col) -> None:
    """Write the touched partitions, then drop the range's partitions left without rows.

    A job that dies between the two steps is repaired by running the load again.
    """
    touched = df.select(*target.schema.names)
    shared = target.partitions == (date_col,) and scope_col is not None
    near = F.col(date_col).between(F.lit(span.lo), F.lit(span.hi))
    if shared:
        touched = touched.unionByName(kept.filter(near))
    by = list(target.partitions)
    empty = []
    if target.exists():
        old = target.folders(F.coalesce(near if shared else inside, F.lit(False)))
        gone = old.join(touched.select(*by).distinct(), by, "left_anti")
        empty = [r.folder for r in gone.select("folder").collect()]
    target.replace_partitions(touched, reads_target=shared)
    target.drop_folders(empty)


def _file_system(spark: SparkSession, path: str):
    """Hadoop path and its file system, for whatever storage holds the table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(spark.sparkContext._jvm.java.net.URI(path.replace(" ", "%20")))
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def load(
    batches: list[DataFrame],
    target: Table,
    date_col: str,
    scope_col: str | None = None,
    full_refresh: bool = False,
) -> int:
    """Load files in order, each as a range reload; a full refresh starts empty."""
    if not full_refresh:
        return sum(reload_range(batch, target, date_col, scope_col) for batch in batches)
    # built beside the table and swapped in whole: a load that fails leaves the old rows
    beside = Table(target.spark, fresh_dir(target.spark, "refresh"), target.schema, target.partitions)
    total = sum(reload_range(batch, beside, date_col, scope_col) for batch in batches)
    target.swap(beside)
    return total
