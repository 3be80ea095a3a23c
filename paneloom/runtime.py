"""Tables stored in the shared folder, and splitting of oversized groups."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Session settings the operators were tuned with. Java compiles no method beyond
#: 8000 bytes of code, so longer generated stages run faster split up. Parts are
#: merged down to 32 KB only, which keeps costly steps on small inputs parallel.
SESSION_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

#: A window group above this many rows is range-split over many tasks.
HOT_ROWS = 5_000_000

#: Ordinal of the piece of a split group a row belongs to.
PART = "_part"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a private one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="paneloom-"))
        folder = context.getCheckpointDir()
    return folder


#: Paths handed out inside the open ``stored_tables`` blocks, innermost last.
_HANDED_OUT: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _HANDED_OUT:
        _HANDED_OUT[-1].append(path)
    return path


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that operators store inside the block when it ends.

    Results of the block have to be written before: they read these tables.
    """
    _HANDED_OUT.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _HANDED_OUT.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def store(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Cuts the lineage so that the loss of executors costs no recomputation, gives
    every later reader the same rows, and tells the optimizer the true size: a
    small table is then broadcast within the session's threshold, a large one is
    joined by shuffling.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ordered_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    hot_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """Split groups above ``hot_rows`` into range parts along ``order``.

    Returns the frame and whether anything was split. When it was, the frame has
    a ``PART`` column: parts of one group never overlap and ascend with the
    order, so a window per (keys, PART) plus one small window over the part
    summaries replaces a window over the whole group. The range boundaries come
    from sampling, hence the stored table: both later reads see the same parts.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = df.groupBy(*keys).count().filter(F.col("count") > hot_rows)
    if hot.isEmpty():
        return df, False
    hot = store(hot)
    rows = hot.agg(F.sum("count")).first()[0]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * rows // hot_rows)
    # At most (all rows / hot_rows) keys can be hot, which bounds this broadcast.
    hot = F.broadcast(hot.select(*keys))
    order_by = [F.col(k) for k in keys] + list(order)
    split = store(
        df.join(hot, list(keys), "left_semi")
        .repartitionByRange(parts, *order_by)
        .withColumn(PART, F.spark_partition_id())
    )
    rest = df.join(hot, list(keys), "left_anti").withColumn(PART, F.lit(0))
    return rest.unionByName(split), True


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    weight: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the total ``weight`` (default: number) of the rows before each row.

    ``order`` must be unique within the keys.
    """
    frame, split = ordered_parts(df, keys, order, hot_rows)
    group = [*keys, PART] if split else list(keys)
    window = Window.partitionBy(*group).orderBy(*order)
    if weight is None:
        before = F.row_number().over(window).cast("bigint") - 1
        size = F.count(F.lit(1))
    else:
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum(weight).over(upto) - F.col(weight)
        size = F.sum(weight)
    if not split:
        return frame.withColumn(name, before)
    earlier = Window.partitionBy(*keys).orderBy(PART)
    offsets = (
        frame.groupBy(*group)
        .agg(size.alias("_size"))
        .select(*group, (F.sum("_size").over(earlier) - F.col("_size")).alias("_offset"))
    )
    return (
        frame.withColumn(name, before)
        .join(offsets, group)
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_offset", PART)
    )
