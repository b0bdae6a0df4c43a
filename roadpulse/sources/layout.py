"""Parquet tables clustered on keys, so that filters skip files and row groups."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.curve import BITS, curve_key
from roadpulse.sources.shared_dir import remove_path, scratch_path

# Clustering keys and rows per row group.
CLUSTER_KEYS = ("state", "start_lat", "start_lng", "street")
ROWS_PER_GROUP = 100_000

ROWS_PER_FILE = 5_000_000

_SPREAD, _CURVE = "_spread", "_curve"


class ClusteredTable(NamedTuple):
    path: str
    keys: tuple[str, ...]


def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = CLUSTER_KEYS,
    partitions: int | None = None,
    rows_per_group: int = ROWS_PER_GROUP,
    rows_per_file: int = ROWS_PER_FILE,
    spread_by: Sequence[str | Column] | None = None,
    drop: Sequence[str] = (),
) -> ClusteredTable:
    """Write ``df`` sorted by ``keys`` across the whole table (an action).

    Files hold consecutive key ranges and are sorted inside; nulls come first
    and no row is lost. ``spread_by`` breaks ties between rows with equal keys,
    so that a key with a third of the table covers many files and not one. It
    must depend on the row alone (a retried task has to send it to the same
    place): by default a hash of the whole row; give a unique column where
    identical rows may be many. Without ``partitions`` the rows are written to
    the scratch folder first, so that counting, sampling and sorting read that
    copy and not ``df`` three times; the copy is removed. Without ``keys`` rows
    are written as they come. Columns to ``drop`` serve as keys and are not written.
    """
    keys = tuple(keys)
    if partitions is None and keys:
        staged = scratch_path(df.sparkSession, "to-cluster")
        df.write.parquet(staged)
        try:
            rows = df.sparkSession.read.schema(df.schema).parquet(staged)
            number = max(1, math.ceil(rows.count() / rows_per_file))
            return write_clustered(rows, path, keys, number, rows_per_group, rows_per_file, spread_by, drop)
        finally:
            remove_path(df.sparkSession, staged)
    if not keys:
        _writer(df, rows_per_group, rows_per_file).parquet(path)
        return ClusteredTable(path, keys)
    spread = F.xxhash64(*([F.col(f"`{c}`") for c in df.columns] if spread_by is None else spread_by))
    by_key = [F.col(k).asc_nulls_first() for k in keys]
    ordered = df.withColumn(_SPREAD, spread).repartitionByRange(partitions, *by_key, _SPREAD).sortWithinPartitions(*by_key)
    _writer(ordered.drop(_SPREAD, *drop), rows_per_group, rows_per_file).parquet(path)
    return ClusteredTable(path, tuple(k for k in keys if k not in drop))


def write_along_curve(
    df: DataFrame, path: str, lat: str = "start_lat", lng: str = "start_lng", bits: int = BITS, **options
) -> ClusteredTable:
    """Write ``df`` along a space-filling curve over two coordinates (an action).

    Rows of one row group lie in a small patch of the map, so a filter on a box
    of coordinates alone opens few row groups, whatever the states in it. Rows
    without a place come first. ``options`` are those of ``write_clustered``.
    """
    table = write_clustered(df.withColumn(_CURVE, curve_key(lat, lng, bits)), path, (_CURVE,), drop=(_CURVE,), **options)
    return table._replace(keys=(lat, lng))


def _writer(df: DataFrame, rows_per_group: int, rows_per_file: int) -> DataFrameWriter:
    return (
        df.write.option("compression", "zstd")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.row.count.limit", str(rows_per_group))
        .option("maxRecordsPerFile", str(2 * rows_per_file))
    )


def cluster_parquet(
    spark: SparkSession,
    source: str,
    path: str,
    keys: Sequence[str] = CLUSTER_KEYS,
    where: Column | None = None,
    drop: Sequence[str] = (),
    partitions: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    **options,
) -> ClusteredTable:
    """Rewrite a Parquet table clustered on ``keys``.

    Ties are spread by the place of the row in the source files, which is unique
    and the same on every retry, so even identical copies are spread. The number
    of files follows from the footers of the source.
    """
    rows = spark.read.parquet(source)
    if partitions is None:
        partitions = max(1, math.ceil(rows.count() / rows_per_file))
    if where is not None:
        rows = rows.filter(where)
    return write_clustered(
        rows.drop(*drop),
        path,
        keys,
        partitions,
        rows_per_file=rows_per_file,
        spread_by=("_metadata.file_path", "_metadata.row_index"),
        **options,
    )


def read_clustered(spark: SparkSession, table: ClusteredTable) -> DataFrame:
    return spark.read.parquet(table.path)


def zone_map(spark: SparkSession, table: ClusteredTable) -> DataFrame:
    """Per file: rows, and smallest and largest value of every clustering key."""
    bounds = []
    for k in table.keys:
        bounds += [F.min(k).alias(f"min_{k}"), F.max(k).alias(f"max_{k}")]
    return (
        spark.read.parquet(table.path)
        .groupBy(F.col("_metadata.file_name").alias("file_name"))
        .agg(F.count("*").alias("rows"), *bounds)
    )


def row_group_zones(
    spark: SparkSession, table: ClusteredTable, columns: Sequence[str], rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Per file and row group: rows, and smallest and largest value of the columns.

    A row group holds ``rows_per_group`` consecutive rows of its file, the number
    the table was written with.
    """
    bounds = []
    for c in columns:
        bounds += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    group = F.floor(F.col("_metadata.row_index") / rows_per_group)
    return (
        spark.read.parquet(table.path)
        .groupBy(F.col("_metadata.file_name").alias("file_name"), group.alias("row_group"))
        .agg(F.count("*").alias("rows"), *bounds)
    )


def opened_by_box(zones: DataFrame, box: Mapping[str, tuple[float, float]]) -> DataFrame:
    """How many row groups, and rows in them, a filter on a box of the columns has to read, and how many there are."""
    meets = F.lit(True)
    for column, (low, high) in box.items():
        meets = meets & F.coalesce((F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high), F.lit(False))
    return zones.agg(
        F.count_if(meets).alias("groups_opened"),
        F.coalesce(F.sum(F.when(meets, F.col("rows"))), F.lit(0)).alias("rows_opened"),
        F.count("*").alias("groups"),
        F.sum("rows").alias("rows"),
    )


def order_check(spark: SparkSession, table: ClusteredTable) -> DataFrame:
    """One row that says whether a table lies as ``write_clustered`` writes it.

    ``files`` and ``rows``; ``rows_out_of_order`` inside files; ``files_overlapping``,
    whose first key lies before the last key of the file before; ``null_first``,
    the rows whose first key is null. Reads the table and writes nothing.
    """
    key = F.struct(*[F.struct(F.col(k).isNotNull().alias("set"), F.col(k).alias("value")).alias(f"k{i}") for i, k in enumerate(table.keys)])
    rows = spark.read.parquet(table.path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
        key.alias("key"),
        F.col(table.keys[0]).isNull().alias("no_first"),
    )
    in_file = Window.partitionBy("file").orderBy("at")
    files = (
        rows.withColumn("falls", F.lag("key").over(in_file) > F.col("key"))
        .groupBy("file")
        .agg(
            F.count("*").alias("rows"),
            F.count_if("falls").alias("out_of_order"),
            F.count_if("no_first").alias("null_first"),
            F.min("key").alias("first"),
            F.max("key").alias("last"),
        )
        .withColumn("overlaps", F.lag("last").over(Window.orderBy("first", "last")) > F.col("first"))
    )
    return files.agg(
        F.count("*").alias("files"),
        F.sum("rows").alias("rows"),
        F.sum("out_of_order").alias("rows_out_of_order"),
        F.count_if("overlaps").alias("files_overlapping"),
        F.sum("null_first").alias("null_first"),
    )
