"""Exact order statistics without a one-task window.

Rows are ordered by ``md5(key:seed)``, which spreads any set of distinct keys evenly. A count per
(group, hash prefix) says in which prefix a wanted rank falls, so only the rows of that one prefix
ever have to be sorted, even when one group holds most of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewlake.operators.placement import as_list, pin_small, stage

PREFIX_DIGITS = 4


def key_hash(key: str | Column, seed: int | str) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(column.cast("string"), F.lit(f":{seed}")).cast("binary"))


def hashed_rows(df: DataFrame, key: str, group: str, seed: int | str) -> DataFrame:
    hashed = df.select(F.col(group).alias("_g"), F.col(key).alias("_k"))
    hashed = hashed.withColumn("_h", F.coalesce(key_hash("_k", seed), F.lit("")))
    return hashed.withColumn("_b", F.substring("_h", 1, PREFIX_DIGITS))


def prefix_counts(rows: DataFrame) -> DataFrame:
    """(group, prefix, count, rows of the group before this prefix), written once."""
    counted = stage(rows.groupBy("_g", "_b").agg(F.count("*").alias("_n")), "prefix_counts")
    upto = W.partitionBy("_g").orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    return counted.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))


def hash_cutoffs(rows: DataFrame, counted: DataFrame, quotas: DataFrame) -> DataFrame:
    """For each group the (hash, key) of its ``quota``-th row in hash order.

    ``quotas`` holds (_g, _quota). Repeated keys are counted before sorting, so a key with many
    copies is one row here. Groups with quota 0 have no cutoff.
    """
    quotas = quotas.select(F.col("_g").alias("_qg"), "_quota")
    boundary = (
        counted.join(quotas, F.col("_g").eqNullSafe(F.col("_qg")))
        .where((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_before") + F.col("_n")))
        .select("_qg", F.col("_b").alias("_qb"), (F.col("_quota") - F.col("_before")).alias("_need"))
    )
    boundary = pin_small(boundary, "boundary")
    inside = rows.join(boundary, F.col("_g").eqNullSafe(F.col("_qg")) & (F.col("_b") == F.col("_qb")))
    inside = inside.groupBy("_g", "_h", "_k", "_need").agg(F.count("*").alias("_n"))
    upto = W.partitionBy("_g").orderBy("_h", "_k").rowsBetween(W.unboundedPreceding, W.currentRow)
    reached = inside.withColumn("_upto", F.sum("_n").over(upto))
    reached = reached.where(
        (F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need"))
    )
    return pin_small(
        reached.select(F.col("_g").alias("_cut_g"), F.col("_h").alias("_cut_h"), F.col("_k").alias("_cut_k")),
        "cutoffs",
    )


def within_cutoff(df: DataFrame, key: str, group: str, seed: int | str, cutoffs: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: is the row among the first ``quota`` of its group? A map-side test."""
    digest = F.coalesce(key_hash(key, seed), F.lit(""))
    inside = (digest < F.col("_cut_h")) | ((digest == F.col("_cut_h")) & F.col(key).eqNullSafe(F.col("_cut_k")))
    flagged = df.join(cutoffs, F.col(group).eqNullSafe(F.col("_cut_g")), "left")
    return flagged.withColumn(name, F.coalesce(inside, F.lit(False))).drop("_cut_g", "_cut_h", "_cut_k")


def numbered_in_group(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """(_g, _k, _rn): 0-based position in hash order within the group. Keys must be unique.

    Positions are counted inside each (group, prefix) and shifted by the rows before the prefix.
    """
    inside = W.partitionBy("_g", "_b").orderBy("_h", "_k")
    local = rows.withColumn("_local", F.row_number().over(inside))
    offsets = counted.select(F.col("_g").alias("_og"), F.col("_b").alias("_ob"), "_before")
    placed = local.join(offsets, F.col("_g").eqNullSafe(F.col("_og")) & (F.col("_b") == F.col("_ob")))
    return placed.select("_g", "_k", (F.col("_before") + F.col("_local") - 1).alias("_rn"))


def global_index(df: DataFrame, order_by: str | list[str], name: str = "idx") -> DataFrame:
    """0-based position of every row in the total order of ``order_by`` (which should be unique).

    A range-partitioned sort is written once together with each row's (partition, position); the
    number of rows in the partitions before it, a table of one row per partition, does the rest.
    """
    ordered = df.orderBy(*as_list(order_by)).withColumn("_mono", F.monotonically_increasing_id())
    written = stage(ordered, "ordered")
    part = F.shiftright("_mono", 33)
    written = written.withColumn("_part", part).withColumn("_pos", F.col("_mono") - F.shiftleft(part, 33))
    sizes = written.groupBy("_part").agg(F.count("*").alias("_n"))
    upto = W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = sizes.select("_part", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    indexed = written.join(pin_small(offsets, "offsets"), "_part")
    return indexed.withColumn(name, F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_mono", "_before")
