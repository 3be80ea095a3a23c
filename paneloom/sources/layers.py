"""Reading, tagging, writing and refreshing layers partitioned by season."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paneloom.runtime import store


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    seasons: Sequence[int] | None = None,
    fmt: str = "parquet",
    period: str = "season",
) -> DataFrame:
    """One layer, cut to the seasons by partition pruning.

    A layer that does not exist yet reads as an empty frame of the schema.
    """
    options = {"header": "true"} if fmt == "csv" else {}
    try:
        layer = spark.read.format(fmt).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        layer = spark.createDataFrame([], schema)
    return layer if seasons is None else layer.filter(F.col(period).isin(*seasons))


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", period: str = "season") -> None:
    """Write by season and replace only the seasons that occur in ``df``.

    Rebalancing gathers a season's rows into files of the advisory size: neither
    one file per task and season nor one task per season.
    """
    balanced = df.hint("rebalance", F.col(period))
    writer = balanced.write.partitionBy(period).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a listing or summary as CSV with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def list_partitions(df: DataFrame, period: str = "season") -> DataFrame:
    """Sorted periods that hold rows."""
    return df.select(period).filter(F.col(period).isNotNull()).distinct().orderBy(period)


def tag_from_file(df: DataFrame, column: str, pattern: str, whole_path: bool = False) -> DataFrame:
    """Fill ``column`` from the name (or the whole path) of the file a row was read from, first
    group of the pattern; values already there stay. Any number of files is one scan."""
    found = F.regexp_extract(F.col("_metadata.file_path" if whole_path else "_metadata.file_name"), pattern, 1)
    tag = F.nullif(found, F.lit(""))
    return df.withColumn(column, F.coalesce(F.col(column), tag) if column in df.columns else tag)


def full_or_parts(full: DataFrame, parts: DataFrame, period: str = "season") -> DataFrame:
    """The complete sheet of each period, or its parts where there is none."""
    lacking = parts.join(full.select(period).distinct(), period, "left_anti")
    return full.unionByName(lacking, allowMissingColumns=True)


def seasons_to_refresh(
    expected: DataFrame, existing: DataFrame, current: int, with_previous: bool = False, period: str = "season"
) -> DataFrame:
    """Periods that are due: expected ones not there yet, and the current one.

    Nothing is due when only the current period would be and it is there. When
    only the current one is due and absent, ``with_previous`` adds the one before.
    """
    there = existing.select(F.col(period).cast("int").alias(period)).distinct().withColumn("_there", F.lit(True))
    wanted = expected.select(F.col(period).cast("int").alias(period)).distinct()
    absent = F.when(F.col("_there").isNull(), F.col(period))
    # One array of period numbers, never longer than the list of periods.
    missing = wanted.join(there, period, "left").agg(F.sort_array(F.collect_set(absent)).alias("missing"))
    now = F.lit(current)
    only_now = F.array(now, now - 1) if with_previous else F.array(now)
    due = (
        F.when(F.size("missing") == 0, F.array().cast("array<int>"))
        .when(F.col("missing") == F.array(now), only_now)
        .otherwise(F.array_union("missing", F.array(now)))
    )
    return missing.select(F.explode(due).alias(period))


def file_columns(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, column, type) from the footers of Parquet files, read by tasks: one schema for all hides what a file lacks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column("file").to_pylist():
                system, path = FileSystem.from_uri(unquote(file))
                rows += [(file, f.name, str(f.type)) for f in pq.read_schema(path, filesystem=system)]
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["file", "column", "type"])

    listed = spark.createDataFrame([(f,) for f in files], "file string")
    tasks = max(1, min(len(files), spark.sparkContext.defaultParallelism))
    return listed.repartition(tasks).mapInArrow(read, "file string, column string, type string")


def validate_files(spark: SparkSession, path: str, period: str = "season") -> DataFrame:
    """One row a column of a written layer: in how many periods all files have it with the type that most have, against all periods.

    Columns ``check``, ``expected``, ``actual``, ``ok``, like the checks of ``validate_layer``.
    """
    files = list(spark.read.option("recursiveFileLookup", "true").parquet(path).inputFiles())
    found = store(file_columns(spark, files).withColumn("period", F.regexp_extract("file", f"/{period}=([^/]*)/", 1)))
    sizes = found.groupBy("period").agg(F.countDistinct("file").alias("files"))
    kinds = found.groupBy("column", "type").agg(F.countDistinct("file").alias("n"))
    main = kinds.groupBy("column").agg(F.max_by("type", F.struct("n", "type")).alias("type"))
    whole = found.join(main, ["column", "type"]).groupBy("column", "period").agg(F.countDistinct("file").alias("held"))
    counted = whole.join(sizes, "period").groupBy("column").agg(F.count_if(F.col("held") == F.col("files")).alias("actual"))
    periods = F.lit(sizes.count()).cast("bigint").alias("expected")
    checks = counted.select(F.concat(F.lit("column "), "column").alias("check"), periods, "actual")
    return checks.withColumn("ok", F.col("expected") == F.col("actual"))
