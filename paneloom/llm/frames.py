"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in pieces of about this many characters, which bounds the
#: memory of a task whatever the number of rows in an Arrow batch.
CHUNK_CHARS = 200_000


#: Rows of an Arrow batch. A row is a whole document, and a batch is held several
#: times over: in the executor, on its way, and in the Python worker.
BATCH_ROWS = "1000"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def document_batches(spark: SparkSession, rows: str = BATCH_ROWS) -> None:
    """Lower the session's default batch size; a size that the user has chosen stays."""
    if spark.conf.get(_BATCH_SETTING) in ("10000", BATCH_ROWS):
        spark.conf.set(_BATCH_SETTING, rows)


def text_of(column: str) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def with_outputs(df: DataFrame, outputs: dict[str, Column]) -> DataFrame:
    """The frame plus the outputs; an input column of an output's name (in any case) is replaced."""
    taken = {name.lower() for name in outputs}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in outputs.items()])


def with_fields(df: DataFrame, value: Column, names: list[str]) -> DataFrame:
    """The frame plus the named fields of one struct column, which is computed once."""
    holder = free_name(df, "_fields")
    held = df.withColumn(holder, value)
    return with_outputs(held, {name: F.col(f"{holder}.{name}") for name in names}).drop(holder)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def chunks(texts: pa.Array, most: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """The texts of a batch in order, in lists of about ``most`` characters; null as empty."""
    held, size = [], 0
    for value in texts:
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def joined(parts: Iterable[pa.Array], kind: pa.DataType) -> pa.Array:
    parts = list(parts)
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
