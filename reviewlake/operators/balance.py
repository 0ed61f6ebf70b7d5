"""Class weights and exact per-class resampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from reviewlake.operators.placement import pin_small, stage
from reviewlake.operators.ranking import (
    hash_cutoffs,
    hashed_rows,
    numbered_in_group,
    prefix_counts,
    within_cutoff,
)

# The names of the resampling strategies.
STRATEGIES = ("majority", "not minority", "not majority", "all")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n_rows, weight) with weight ``n / (classes * n_rows)``."""
    everything = W.partitionBy()
    counted = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(everything)
    classes = F.count("*").over(everything)
    return counted.withColumn("weight", total / (classes * F.col("n_rows")))


def attach_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(pin_small(weights, "class_weights"), label)


def resampled_classes(sizes: list[int], strategy: str | None) -> list[bool]:
    """Which of a few counted classes ``strategy`` reduces; the same choice as in ``undersample``. None reduces none."""
    if strategy is None:
        return [False] * len(sizes)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    present = [i for i, n in enumerate(sizes) if n]
    smallest = min(present, key=lambda i: (sizes[i], i), default=None)
    largest = min(present, key=lambda i: (-sizes[i], i), default=None)
    chosen = {
        "majority": lambda i: i == largest,
        "not minority": lambda i: i != smallest,
        "not majority": lambda i: i != largest,
        "all": lambda i: True,
    }[strategy]
    return [i in present and chosen(i) for i in range(len(sizes))]


def _targets(counted: DataFrame, strategy: str) -> DataFrame:
    """(_g, _n_c, _quota, _target): which classes are resampled, and to how many rows.

    The target size is always the smallest class; equal sizes are told apart by the label.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    classes = counted.groupBy("_g").agg(F.sum("_n").alias("_n_c"))
    classes = classes.withColumn("_quota", F.min("_n_c").over(W.partitionBy()))
    smallest = F.row_number().over(W.orderBy(F.col("_n_c"), F.col("_g"))) == 1
    largest = F.row_number().over(W.orderBy(F.desc("_n_c"), F.col("_g"))) == 1
    classes = classes.withColumn("_smallest", smallest).withColumn("_largest", largest)
    chosen = {
        "majority": F.col("_largest"),
        "not minority": ~F.col("_smallest"),
        "not majority": ~F.col("_largest"),
        "all": F.lit(True),
    }[strategy]
    return classes.select("_g", "_n_c", "_quota", chosen.alias("_target"))


def draws(numbered: DataFrame, targets: DataFrame, seed: int | str) -> DataFrame:
    """(_g, _rn, _times): ``_quota`` draws with replacement from ``_n_c`` row numbers per class.

    Draw k of a class is 60 bits of ``md5(seed:class:k)`` modulo the class size. The draws 0, 1, ...
    are made next to the rows with those numbers, so making them is spread like the rows are.
    """
    wanted = targets.where("_target").select(F.col("_g").alias("_tg"), "_n_c", "_quota")
    wanted = pin_small(wanted, "targets")
    single = numbered.join(wanted, F.col("_g").eqNullSafe(F.col("_tg"))).where(F.col("_rn") < F.col("_quota"))
    text = F.concat_ws(":", F.lit(str(seed)), F.col("_g").cast("string"), F.col("_rn").cast("string"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return single.groupBy("_g", (bits % F.col("_n_c")).alias("_rn")).agg(F.count("*").alias("_times"))


@dataclass(frozen=True)
class Numbering:
    """Row numbers within each class, counted once and shared by any number of draws."""

    classes: DataFrame  # (_g, _n)
    numbered: DataFrame  # (_g, _k, _rn)


def number_classes(df: DataFrame, label: str, key: str, seed: int | str = 42) -> Numbering:
    rows = hashed_rows(df, key, label, seed)
    counted = prefix_counts(rows)
    classes = pin_small(counted.groupBy("_g").agg(F.sum("_n").alias("_n")), "classes")
    return Numbering(classes, stage(numbered_in_group(rows, counted), "numbered"))


def _untouched(df: DataFrame, label: str, targets: DataFrame, name: str) -> DataFrame:
    kept = pin_small(targets.where(~F.col("_target")).select(F.col("_g").alias("_whole")), "untouched")
    rows = df.join(kept, F.col(label).eqNullSafe(F.col("_whole")), "left_semi")
    return rows.withColumn(name, F.lit(1).cast("bigint"))


def draw_sample(
    df: DataFrame, label: str, key: str, numbering: Numbering, strategy: str, seed: int | str, name: str = "multiplicity"
) -> DataFrame:
    """Rows drawn with replacement, with how often each was drawn in ``name``."""
    targets = _targets(numbering.classes, strategy)
    drawn = draws(numbering.numbered, targets, seed).withColumnsRenamed({"_g": "_dg", "_rn": "_drn"})
    hits = numbering.numbered.join(drawn, F.col("_g").eqNullSafe(F.col("_dg")) & (F.col("_rn") == F.col("_drn")))
    hits = hits.select(F.col("_k").alias("_hit"), F.col("_times").alias(name))
    sampled = df.join(hits, F.col(key) == F.col("_hit")).drop("_hit")
    return sampled.unionByName(_untouched(df, label, targets, name))


def undersample(
    df: DataFrame,
    label: str,
    key: str,
    strategy: str = "all",
    replacement: bool = False,
    seed: int | str = 42,
    name: str = "multiplicity",
) -> DataFrame:
    """Reduce the chosen classes to the size of the smallest one.

    Without replacement the rows with the smallest ``md5(key:seed)`` stay. With replacement each row
    carries how often it was drawn in ``multiplicity`` (1 for classes that are not resampled), which
    learners take as a weight; rows that were not drawn are absent. ``key`` must be unique.
    """
    if replacement:
        return draw_sample(df, label, key, number_classes(df, label, key, seed), strategy, seed, name)
    rows = hashed_rows(df, key, label, seed)
    counted = prefix_counts(rows)
    targets = _targets(counted, strategy)
    cutoffs = hash_cutoffs(rows, counted, targets.where("_target"))
    chosen = within_cutoff(df, key, label, seed, cutoffs, "_in").where("_in").drop("_in")
    return chosen.withColumn(name, F.lit(1).cast("bigint")).unionByName(_untouched(df, label, targets, name))
