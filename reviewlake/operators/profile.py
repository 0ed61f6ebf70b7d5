"""Counts, distinct values and histograms of any stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlake.operators.placement import as_list


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def top(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Group counts, largest first; ties in key order. ``n`` keeps the first n groups."""
    ranked = counts(df, *keys).orderBy(F.desc("count"), *keys)
    return ranked if n is None else ranked.limit(n)


def summary(df: DataFrame, *distinct: str) -> DataFrame:
    """One row: number of rows and, per named column, its exact number of distinct values (NULL included)."""
    present = [
        (F.count_distinct(c) + F.coalesce(F.max(F.when(F.col(c).isNull(), 1)), F.lit(0))).cast("bigint").alias(f"distinct_{c}")
        for c in distinct
    ]
    return df.agg(F.count("*").alias("rows"), *present)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def sample_rows(df: DataFrame, order_by: str | list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*as_list(order_by)).limit(n)


def histogram(df: DataFrame, column: str, by: str | list[str] = ()) -> DataFrame:
    """Counts of a discrete column, optionally split by other columns."""
    return counts(df, column, *as_list(by))


def binned_histogram(df: DataFrame, column: str, bins: int = 10, by: str | list[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins between the observed minimum and maximum.

    The bounds are scalar subqueries. Bins are numbered from 0, the last one includes the maximum;
    when all values are equal they sit in the middle bin. NULL values are not counted.
    """
    bounds = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo: Column = bounds.select("lo").scalar()
    hi: Column = bounds.select("hi").scalar()
    spaced = df.where(F.col(column).isNotNull()).withColumn("_lo", lo).withColumn("_w", (hi - lo) / F.lit(bins))
    place = F.floor((F.col(column) - F.col("_lo")) / F.nullif(F.col("_w"), F.lit(0.0)))
    number = F.when(F.col("_w") == 0, F.lit(bins // 2)).otherwise(F.least(place, F.lit(bins - 1)))
    return spaced.groupBy(number.cast("bigint").alias("bin"), *as_list(by)).agg(F.count("*").alias("count"))
