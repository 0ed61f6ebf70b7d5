"""Records to weighted shards by rendezvous hashing of a stable key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.llm.texts import small_join
from reviewlake.operators.placement import stage

#: Slots are counted in so many ranges of the key's hash per shard.
RANGES = 4096


def _score(key: Column, shard: int, weight: float, seed: int) -> Column:
    """-weight / ln(u): the shard with the largest score wins, with a chance in proportion to its weight."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(shard)), 11)
    uniform = (bits.cast("double") + 0.5) / float(2**53)
    return -F.lit(float(weight)) / F.log(uniform)


def shard_of(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """The shard of a key; a shard with weight 0 gets nothing, ties go to the smaller shard.

    One more weight at the end takes keys only into the new shard, since no other score changes. A NULL
    key is a key like any other.
    """
    live = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("some weight must be positive")
    scored = F.array(*(F.struct(_score(key, i, w, seed).alias("score"), F.lit(-i).alias("order")) for i, w in live))
    return (-F.array_max(scored)["order"]).cast("int")


def with_slots(assigned: DataFrame, key: str, seed: int = 0, ranges: int = RANGES) -> DataFrame:
    """Add ``slot``: the place of a row in its shard, from 0 without gaps.

    Rows are numbered inside (shard, hash range of the key); the ranges before add their counts. So a
    shard never meets in one task, and the table of counts has ``shards * ranges`` rows at most.
    Rows of one repeated key are in one range.
    """
    ranged = assigned.withColumn("_range", F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(ranges)).cast("int"))
    counted = ranged.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        counted.select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "shard_offsets"
    )
    inside = Window.partitionBy("shard", "_range").orderBy(F.xxhash64(F.col(key), F.lit(seed + 2)), F.col(key), "text_crc32")
    numbered = ranged.withColumn("_row", F.row_number().over(inside))
    return (
        small_join(numbered, offsets, ["shard", "_range"], "inner")
        .withColumn("slot", F.col("_before") + F.col("_row") - 1)
        .drop("_range", "_row", "_before")
    )


def shard_documents(
    documents: DataFrame, shards: int | Sequence[float], seed: int = 0, ranges: int = RANGES
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``shards``: a number of equal shards or their weights. The law is ``key``: doc_id and the shards
    decide. ``grown_shard`` is the shard with one more shard of the mean weight. ``size``: UTF-8 bytes of
    the text plus 8; a NULL text counts as empty. Repeated rows get slots of their own; a doc_id always
    gets the same shard; an empty table gives no rows; other columns are ignored.
    """
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    grown = [*weights, sum(weights) / len(weights)]
    text = F.coalesce(F.col("text"), F.lit(""))
    assigned = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    assigned = assigned.withColumn("shard", shard_of(F.col("doc_id"), weights, seed)).withColumn(
        "grown_shard", shard_of(F.col("doc_id"), grown, seed)
    )
    return with_slots(assigned, "doc_id", seed, ranges).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


def write_shards(documents: DataFrame, path: str, shards: int | Sequence[float], key: str = "doc_id", seed: int = 0) -> None:
    """Write the whole rows as Parquet, one folder per shard; rows are spread before, so files have even sizes."""
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    placed = documents.withColumn("shard", shard_of(F.col(key), weights, seed))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
