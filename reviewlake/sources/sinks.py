"""Overwrite tables and directories; write documents in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlake.config import Settings
from reviewlake.operators.placement import as_list
from reviewlake.operators.ranking import global_index

DOCUMENT_BATCH = 30


def _laid_out(df: DataFrame, partition_by: str | list[str] | None) -> DataFrame:
    """Bring the rows of a partition value together, so a task does not write a file into every
    directory. Rebalancing splits a hot value over several tasks, which hashing would not."""
    return df.hint("rebalance", *as_list(partition_by)) if partition_by else df


def write_stage(
    df: DataFrame, stage: str, settings: Settings, fmt: str = "parquet", partition_by: str | list[str] | None = None
) -> str:
    """Overwrite the managed table of a stage together with its schema; returns the table name."""
    name = settings.table(stage)
    writer = _laid_out(df, partition_by).write.mode("overwrite").format(fmt)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*as_list(partition_by))
    writer.saveAsTable(name)
    return name


def write_files(df: DataFrame, path: str, partition_by: str | list[str] | None = None, fmt: str = "parquet") -> str:
    """Overwrite a directory, optionally one subdirectory per partition value."""
    writer = _laid_out(df, partition_by).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*as_list(partition_by))
    writer.save(path)
    return path


def write_documents(df: DataFrame, path: str, batch_size: int | None = None) -> str:
    """Write rows as JSON documents, in files of the size that rebalancing gives them.

    ``batch_size`` limits the documents per file, for receivers that take one file per upload; it makes
    very many files of a large table. ``batch_ids`` numbers batches as a column instead.
    """
    writer = df.hint("rebalance").write if batch_size is None else df.write.option("maxRecordsPerFile", batch_size)
    writer.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_named(df: DataFrame, path: str, name: str, content: str | Column, directories: bool = False) -> str:
    """Write each page's text beside its file name, as (name, value) rows in files of ordinary size.

    ``directories`` writes one directory per name instead, which suits few pages only.
    """
    body = F.col(content) if isinstance(content, str) else content
    rows = df.select(F.col(name).alias("name"), body.alias("value"))
    if directories:
        _laid_out(rows, "name").write.mode("overwrite").partitionBy("name").text(path)
    else:
        rows.hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def batch_ids(df: DataFrame, order_by: str | list[str], batch_size: int = DOCUMENT_BATCH, name: str = "batch") -> DataFrame:
    """Add the 0-based number of the slice of ``batch_size`` rows that each row falls in."""
    indexed = global_index(df, order_by, "_position")
    return indexed.withColumn(name, F.floor(F.col("_position") / batch_size).cast("bigint")).drop("_position")
