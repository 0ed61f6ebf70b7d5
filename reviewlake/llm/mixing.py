"""Mixing of sources: shares with a temperature, and whole documents in budgeted block permutations.

All of it is DataFrame operations. A source's weight is its token share to the power of an exponent,
normalised. Exponent 1 keeps the shares, 0 makes all sources equal; in between, entropy falls and the
repetition of small sources shrinks as the exponent grows, so both limits are found by bisection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.llm.texts import WORD, small_join
from reviewlake.operators.placement import stage

#: A source's documents lie in so many blocks, by hash; one block is the unit in which a budget is met. It also bounds
#: what meets in one task of the plan: a source of any size is so many rows there.
BLOCKS = 1024
#: Halvings of the interval of exponents; so many fit into one pass over the sources.
HALVINGS, HALVINGS_A_PASS = 40, 5
SOURCE, ROW_TOKENS = "_mix_source", "_mix_tokens"


def token_count(text: Column) -> Column:
    """Words of a text; NULL counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash48(*parts: Column) -> Column:
    """48 bits of the MD5 of the parts joined by '/', which any SQL engine can repeat."""
    joined = F.concat_ws("/", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 12), 16, 10).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """(source, tokens) of sources that have tokens; staged."""
    counted = rows.groupBy(SOURCE).agg(F.sum(ROW_TOKENS).alias("tokens")).where("tokens > 0")
    return stage(counted, "source_totals")


def _measures(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy of the weights and the largest epochs of a source, for each exponent, in one pass.

    The largest source gets one epoch; the largest number of epochs is then that of the smallest source.
    """
    trial = F.explode(F.array(*(F.lit(e) for e in exponents)))
    sums = totals.crossJoin(F.broadcast(totals.agg(F.sum("tokens").alias("total"), F.min("tokens").alias("least"), F.max("tokens").alias("most"))))
    powers = sums.select("*", trial.alias("exponent")).withColumn("power", F.pow(F.col("tokens") / F.col("total"), "exponent"))
    rows = powers.groupBy("exponent").agg(
        F.sum("power").alias("sum"),
        F.sum(F.col("power") * F.log("power")).alias("plog"),
        F.max(F.pow(F.col("most") / F.col("least"), 1 - F.col("exponent"))).alias("epochs"),
    )
    found = rows.select("exponent", (F.log("sum") - F.col("plog") / F.col("sum")).alias("entropy"), "epochs").collect()
    return {r["exponent"]: (r["entropy"], r["epochs"]) for r in found}


def fit_exponent(totals: DataFrame, target_entropy: float | None, max_epochs: float | None) -> float:
    """The exponent at which the weights reach the target entropy, raised until no source repeats too often.

    ``target_entropy``: nats divided by the log of the number of sources, so 1 means equal weights. The
    shares themselves are kept (exponent 1) if their entropy already reaches it. Every pass over the
    sources settles several halvings: it measures all midpoints that they can ask for.
    """
    sources = totals.count()
    if sources < 2:
        return 1.0
    goal = None if target_entropy is None else target_entropy * math.log(sources)

    def too_high(measured: tuple[float, float]) -> bool:
        """Whether a smaller exponent is still wanted and allowed."""
        entropy, epochs = measured
        if max_epochs is not None and epochs > max_epochs:
            return False
        return goal is None or entropy < goal

    low, high = 0.0, 1.0
    if not too_high(_measures(totals, [1.0])[1.0]):
        return 1.0
    for _ in range(HALVINGS // HALVINGS_A_PASS):
        step = (high - low) / 2**HALVINGS_A_PASS
        grid = [low + step * i for i in range(1, 2**HALVINGS_A_PASS)]
        measured = _measures(totals, grid)
        for _ in range(HALVINGS_A_PASS):
            middle = min(grid, key=lambda e: abs(e - (low + high) / 2))
            low, high = (low, middle) if too_high(measured[middle]) else (middle, high)
    return high


def plan_epochs(totals: DataFrame, exponent: float, budget_tokens: int | None = None) -> DataFrame:
    """(source, tokens, weight, epochs): weights add up to 1; epochs = weight * budget / tokens.

    Without a budget the smallest one is taken that gives every source, the largest included, a whole
    epoch, so no document is left out.
    """
    total = totals.agg(F.sum("tokens").alias("total"), F.max("tokens").alias("most"))
    shares = totals.crossJoin(F.broadcast(total)).withColumn("power", F.pow(F.col("tokens") / F.col("total"), F.lit(exponent)))
    normal = shares.agg(F.sum("power").alias("sum"))
    if budget_tokens is None:
        epochs = F.pow(F.col("most") / F.col("tokens"), F.lit(1 - exponent))
    else:
        epochs = F.col("weight") * budget_tokens / F.col("tokens")
    return (
        shares.crossJoin(F.broadcast(normal))
        .withColumn("weight", F.col("power") / F.col("sum"))
        .withColumn("epochs", F.round(epochs, 9))
        .select(SOURCE, "tokens", "weight", "epochs", F.floor("epochs").alias("whole"))
    )


def _block(seed: int) -> Column:
    return F.pmod(hash48(F.lit(f"block{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.lit(BLOCKS)).cast("int")


def _place(epoch: Column, seed: int) -> Column:
    """Place of a block in the permutation of its source and epoch."""
    source = F.coalesce(F.col(SOURCE), F.lit("null"))
    return hash48(F.lit(f"order{seed}"), source, epoch, F.col("_mix_block"))


def mix(
    documents: DataFrame,
    target_entropy: float | None = 0.95,
    max_epochs: float | None = 4.0,
    budget_tokens: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Rows of ``documents`` as often as their source's weight asks for.

    Added columns: mix_source, mix_tokens, mix_weight, mix_epoch (from 0), mix_block and mix_place, which
    orders the blocks of a source and epoch. Whole epochs give every document once. The part of an epoch
    that remains takes blocks in permuted order while the tokens, with half of the block at the end, stay
    within the budget; it is met to about half a block, that is half a thousandth of the source or half a document.
    Every choice hangs on doc_id, source and seed alone, so a lost task repeats it.

    NULL is a source like any other. Documents without words cost nothing and come with each whole epoch,
    and once if their source has no words at all. Repeated rows share a block and stay together. An empty
    table gives no rows. Columns of the input stay, whatever their names, unless they begin with ``mix_``.
    """
    clash = [c for c in documents.columns if c.lower().startswith(("mix_", "_mix_"))]
    rows = documents.drop(*clash).withColumn(SOURCE, F.col("source").cast("string")).withColumn(ROW_TOKENS, token_count(F.col("text")))
    counted = stage(
        rows.select(SOURCE, ROW_TOKENS, _block(seed).alias("_mix_block")).groupBy(SOURCE, "_mix_block").agg(F.sum(ROW_TOKENS).alias(ROW_TOKENS)),
        "block_tokens",
    )
    totals = source_totals(counted)
    exponent = fit_exponent(totals, target_entropy, max_epochs)
    plan = stage(plan_epochs(totals, exponent, budget_tokens), "mix_plan")

    marked = counted.join(plan, counted[SOURCE].eqNullSafe(plan[SOURCE])).select(
        counted[SOURCE], "_mix_block", ROW_TOKENS, "whole",
        F.floor((F.col("epochs") - F.col("whole")) * F.col("tokens") + 0.5).alias("rest"),
    )
    marked = marked.withColumn("place", _place(F.col("whole"), seed))
    ordered = Window.partitionBy(SOURCE).orderBy("place", "_mix_block").rowsBetween(Window.unboundedPreceding, 0)
    partial = (
        marked.withColumn("upto", F.sum(ROW_TOKENS).over(ordered))
        .where("2 * upto - _mix_tokens <= 2 * rest AND rest > 0")
        .groupBy(SOURCE).agg(F.max(F.struct("place", "_mix_block")).alias("last"))
    )
    final = plan.join(partial.withColumnRenamed(SOURCE, "_s"), F.col(SOURCE).eqNullSafe(F.col("_s")), "left").select(
        F.coalesce(F.col(SOURCE), F.lit("null")).alias("_key"), F.col(SOURCE).isNull().alias("_none"), F.col("weight").alias("mix_weight"), "whole", "last"
    )
    keyed = rows.withColumn("_mix_block", _block(seed)).withColumn("_key", F.coalesce(F.col(SOURCE), F.lit("null"))).withColumn("_none", F.col(SOURCE).isNull())
    joined = small_join(keyed, stage(final, "mix_final"), ["_key", "_none"], "left")
    extra = F.struct(_place(F.col("whole"), seed).alias("place"), F.col("_mix_block")) <= F.col("last")
    copies = F.coalesce(F.col("whole"), F.lit(1)) + F.when(extra, 1).otherwise(0)
    repeated = joined.withColumn("_mix_copies", copies).where("_mix_copies > 0")
    return repeated.select(
        *(F.col(f"`{c}`") for c in documents.columns if c not in clash),
        F.col(SOURCE).alias("mix_source"),
        F.col(ROW_TOKENS).alias("mix_tokens"),
        "mix_weight",
        F.explode(F.expr("sequence(0L, _mix_copies - 1L)")).alias("mix_epoch"),
        F.col("_mix_block").alias("mix_block"),
        SOURCE, "_mix_block",
    ).withColumn("mix_place", _place(F.col("mix_epoch"), seed)).drop(SOURCE, "_mix_block")
