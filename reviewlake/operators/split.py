"""Repeatable stratified train/test split and label columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from reviewlake.operators.placement import lookup_join, stage
from reviewlake.operators.ranking import hash_cutoffs, hashed_rows, prefix_counts, within_cutoff


def proportional_quotas(classes: DataFrame, fraction: float) -> DataFrame:
    """Split ``ceil(fraction * n)`` draws over classes (_g, _n_c) by largest remainder, exactly.

    Products of two row counts can pass 64 bits, hence the decimals. The window runs over one row
    per class.
    """
    everything = W.partitionBy()
    table = classes.withColumn("_n", F.sum("_n_c").over(everything))
    table = table.withColumn("_draws", F.ceil(F.lit(float(fraction)) * F.col("_n")).cast("decimal(18,0)"))
    table = table.withColumn("_share", F.col("_draws") * F.col("_n_c").cast("decimal(18,0)"))
    table = table.withColumn("_base", F.expr("_share div _n"))
    table = table.withColumn("_rest", F.expr("_share % cast(_n as decimal(18,0))"))
    by_rest = W.orderBy(F.desc("_rest"), F.col("_g"))
    table = table.withColumn("_rank", F.row_number().over(by_rest))
    left_over = F.col("_draws").cast("bigint") - F.sum("_base").over(everything)
    table = table.withColumn("_extra", (F.col("_rank") <= left_over).cast("bigint"))
    return table.select("_g", (F.col("_base") + F.col("_extra")).cast("bigint").alias("_quota"))


def stratified(
    df: DataFrame,
    key: str = "id",
    strata: str = "rating",
    test_fraction: float = 0.25,
    seed: int = 42,
    name: str = "train_test",
) -> DataFrame:
    """Add ``train``/``test``: exactly ``ceil(test_fraction * n)`` test rows, class shares kept.

    Within a class the rows with the smallest ``md5(key:seed)`` are the test rows. Two narrow passes
    over (key, strata) find one cutoff per class; labelling is then a comparison next to a broadcast
    of one row per class, so the wide table is never shuffled. The key must be unique for the counts
    to be exact; copies of one key in one class always get the same label.
    """
    rows = hashed_rows(df, key, strata, seed)
    counted = prefix_counts(rows)
    classes = counted.groupBy("_g").agg(F.sum("_n").alias("_n_c"))
    cutoffs = hash_cutoffs(rows, counted, proportional_quotas(classes, test_fraction))
    flagged = within_cutoff(df, key, strata, seed, cutoffs, "_is_test")
    return flagged.withColumn(name, F.when(F.col("_is_test"), "test").otherwise("train")).drop("_is_test")


def label_membership(df: DataFrame, train_keys: DataFrame, key: str = "id", name: str = "train_test") -> DataFrame:
    """``train`` when the key is in ``train_keys``, else ``test``: a lookup join, not a literal list."""
    members = stage(train_keys.select(key).distinct().withColumn("_member", F.lit(True)), "members")
    joined = lookup_join(df, members, key, "left")
    return joined.withColumn(name, F.when(F.col("_member"), "train").otherwise("test")).drop("_member")


def binary_label(df: DataFrame, column: str = "rating", threshold: int = 4, name: str = "positive_review") -> DataFrame:
    """1 when ``column >= threshold``, else 0; NULL gives 0."""
    return df.withColumn(name, F.when(F.col(column) >= threshold, 1).otherwise(0))


def parts(df: DataFrame, name: str = "train_test") -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows)."""
    return df.where(F.col(name) == "train"), df.where(F.col(name) == "test")
