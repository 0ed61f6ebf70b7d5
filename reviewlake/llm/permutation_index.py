"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its nearest pivots. The order is posted in the inverted files of its
pivots: the file of a pivot holds, for each vector of a block, at which place it names the pivot. A query reads the files
of its own nearest pivots, sums the differences of places (footrule distance, a vector that does not name the
pivot counts as the first place beyond), and the nearest part of each block is ranked again by the exact product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from reviewlake.llm.texts import ship_package
from reviewlake.operators.placement import stage

#: Pivots, and how many of the nearest ones represent a vector.
PIVOTS, PLACES = 128, 64
#: The part of each block, at least so many vectors, that is ranked again.
RERANKED, LEAST_RERANKED = 0.4, 600
BLOCK_ROWS, QUERY_ROWS = 8192, 2048


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """(vec_id, embedding) without NULL, zero or non-finite vectors and without rows that lack an id.

    All vectors must have one length; others than the most frequent one (the shorter at a tie) take no part.
    """
    v = F.col("embedding")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")
    )
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0))
    if dimension is None:
        sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
        dimension = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("embedding") == dimension)


def choose_pivots(rows: DataFrame, pivots: int, seed: int = 0) -> np.ndarray:
    """The ``pivots`` vectors with the smallest hash of their id; a bounded sample of the table."""
    order = F.xxhash64("vec_id", F.lit(seed))
    chosen = rows.orderBy(order, "vec_id").limit(pivots).collect()
    return np.array([r["embedding"] for r in chosen], np.float64)


def represent(matrix: np.ndarray, pivots: np.ndarray, places: int) -> np.ndarray:
    """The nearest pivots of each row by inner product, nearest first; ties to the smaller pivot."""
    unit = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)
    return np.argsort(-(matrix @ unit.T), axis=1, kind="stable")[:, :places].astype(np.int16)


def build_index(rows: DataFrame, pivots, places: int, blocks: int) -> DataFrame:
    """(vec_id, embedding, nearest, block): every vector with its pivots; staged."""

    def run(frames):
        for frame in frames:
            if len(frame):
                matrix = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
                frame["nearest"] = list(represent(matrix, pivots.value, places))
            else:
                frame["nearest"] = []
            yield frame

    block = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(blocks)).cast("int")
    posted = rows.mapInPandas(run, "vec_id long, embedding array<double>, nearest array<short>")
    return stage(posted.withColumn("block", block), "permutations")


def _search_cell(places: int, pivots: int, k: int, reranked: float, least: int):
    columns = ["query_id", "vec_id", "score"]

    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        vectors = vectors.sort_values("vec_id", kind="stable")
        ids = vectors["vec_id"].to_numpy()
        exact = np.stack(vectors["embedding"].to_numpy())
        norms = np.sqrt((exact * exact).sum(axis=1))
        rough = (exact / norms[:, None]).astype(np.float32)
        # more than a product of single-precision unit vectors can be off by
        margin = (exact.shape[1] + 8) * 1.2e-7
        files = np.full((pivots, len(ids)), places, np.int16)
        named = np.stack(vectors["nearest"].to_numpy())
        files[named.T, np.arange(len(ids))[None, :]] = np.arange(named.shape[1], dtype=np.int16)[:, None]
        wanted = min(len(ids), max(least, int(np.ceil(reranked * len(ids)))))
        found = []
        for query_id, embedding, nearest in zip(queries["vec_id"], queries["embedding"], queries["nearest"]):
            footrule = np.zeros(len(ids), np.int32)
            for place, pivot in enumerate(nearest):
                footrule += np.abs(files[pivot] - np.int16(place))
            near = np.argpartition(footrule, wanted - 1)[:wanted] if wanted < len(ids) else np.arange(len(ids))
            near = near[ids[near] != query_id]
            query = np.asarray(embedding)
            length = np.sqrt((query * query).sum())
            if len(near) > 4 * k and np.isfinite(norms).all() and np.isfinite(length):
                # unit vectors in single precision first; what lies between the bounds of each candidate is ranked exactly
                size = norms[near] * length
                about = (rough[near] @ (query / length).astype(np.float32)).astype(np.float64) * size
                low = about - margin * size
                near = near[about + margin * size >= np.partition(low, len(low) - k)[len(low) - k]]
            score = (exact[near] * query).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(found)[columns]

    return run


def search(
    vectors: DataFrame, is_query, k: int = 20, pivots: int = PIVOTS, places: int = PLACES,
    reranked: float = RERANKED, least: int = LEAST_RERANKED, seed: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``is_query`` holds.

    Queries meet vectors block by block, each block by hash of vec_id, so no block is hot; each gives its
    best ``k``, and those are merged. Rows with the query's own vec_id are no candidates; a vec_id that is
    repeated asks once, with its smallest vector, and each of its rows is a candidate. Ties go to the smaller vec_id. Vectors that ``usable`` leaves out take no part; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(usable(vectors), "vectors")
    chosen = choose_pivots(rows, pivots, seed)
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(chosen):
        return spark.createDataFrame([], schema)
    places = min(places, len(chosen))
    total = rows.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    index = build_index(rows, spark.sparkContext.broadcast(chosen), places, blocks)
    asked = index.where(is_query)
    query_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(12)), F.lit(query_blocks)).cast("int")
    left = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    single = asked.groupBy("vec_id").agg(F.min(F.struct("embedding", "nearest")).alias("one")).select("vec_id", "one.*")
    right = single.withColumn("query_block", query_block).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = left.groupBy("block", "query_block").cogroup(right.groupBy("block", "query_block"))
    near = cells.applyInPandas(_search_cell(places, len(chosen), k, reranked, least), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
