"""Compression of vectors to one byte a part, with per-dimension value dictionaries.

Components become whole numbers. A block of vectors keeps, for each dimension, the sorted distinct numbers and a code per
vector. To compare a block with a codebook, the squared differences of each distinct number to all entries
are tabulated once; the distance of a part is then a gather by code and a few additions. Blocks are written once
and read by every round; a round gives sums per entry from each task, so nothing but the codebooks, whose
size is fixed, ever reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlake.llm.texts import ship_package, small_join
from reviewlake.operators.placement import stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components of one block at most, unless a single vector has more.
BLOCK_VALUES = 1 << 19
#: Numbers of a larger size are computed as Python's unbounded ones.
NARROW = 1 << 24
_LIMB = 32
LARGEST = (1 << 63) - 1


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """(vec_id, embedding, label) of vectors that are complete and finite and have the most frequent length.

    At a tie the shorter length counts; an empty vector takes no part.
    """
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label")
    )
    if dimension is None:
        sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
        dimension = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("embedding") == dimension)


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x); as Python numbers where one is too large for fast sums of squares."""
    if not values.size or np.abs(values).max() < NARROW / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = [int(x) * scale if abs(x) >= 2.0**40 else int(np.floor(x * scale)) for x in values.ravel().tolist()]
    made = np.empty(len(exact), object)
    made[:] = exact
    return made.reshape(values.shape)


def dictionaries(numbers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct numbers of each column, and each row's codes in them."""
    made = [np.unique(numbers[:, d], return_inverse=True) for d in range(numbers.shape[1])]
    return [values for values, _ in made], np.stack([codes.ravel() for _, codes in made], axis=1).astype(np.uint32)


def _plain(values: np.ndarray) -> bytes:
    return json.dumps([int(v) for v in values]).encode() if values.dtype == object else values.astype("<i8").tobytes()


def to_blocks(rows: DataFrame, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(ids, labels, dictionaries, codes, wide): blocks of vectors, in the order in which a task reads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            width = len(lists[0])
            step = max(1, block_values // width)
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                numbers = whole_numbers(values)
                tables, codes = dictionaries(numbers)
                yield pa.RecordBatch.from_pydict(
                    {
                        "ids": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        "labels": pa.array([part.column(2).to_pylist()], pa.list_(pa.int64())),
                        "dictionaries": pa.array([[_plain(t) for t in tables]], pa.list_(pa.binary())),
                        "codes": pa.array([_packed(codes, tables)], pa.binary()),
                        "wide": pa.array([numbers.dtype == object]),
                    }
                )

    schema = "ids array<long>, labels array<long>, dictionaries array<binary>, codes binary, wide boolean"
    return stage(rows.mapInArrow(run, schema), "vector_blocks")


def _packed(codes: np.ndarray, tables: list[np.ndarray]) -> bytes:
    kind = "<u2" if max(map(len, tables)) <= 1 << 16 else "<u4"
    return codes.astype(kind).tobytes()


def _unpacked(block: dict) -> tuple[list[np.ndarray], np.ndarray]:
    if block["wide"]:
        tables = []
        for raw in block["dictionaries"]:
            numbers = json.loads(raw)
            tables.append(np.empty(len(numbers), object))
            tables[-1][:] = numbers
    else:
        tables = [np.frombuffer(raw, "<i8") for raw in block["dictionaries"]]
    rows, width = len(block["ids"]), len(tables)
    kind = "<u2" if len(block["codes"]) == 2 * rows * width else "<u4"
    return tables, np.frombuffer(block["codes"], kind).reshape(rows, width)


def part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    """Equal consecutive parts; where the width is no multiple of ``parts``, the last ones are shorter or empty."""
    step = -(-width // parts)
    return [(min(p * step, width), min((p + 1) * step, width)) for p in range(parts)]


def nearest(tables: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a part: the nearest entry of each vector, the lower at a tie, and its squared distance.

    ``book``: entries x dimensions of the part.
    """
    total = np.zeros((len(codes), len(book)), np.int64)
    wide = book.dtype == object or any(t.dtype == object for t in tables)
    if wide:
        total = total.astype(object)
    for d, table in enumerate(tables):
        values, entries = (table.astype(object), book[:, d].astype(object)) if wide else (table, book[:, d])
        squares = (values[:, None] - entries[None, :]) ** 2
        total = total + squares[codes[:, d]]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(codes)), best]


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    """A number as (place, digit) in base 2**32; all digits but the last are not negative."""
    place = 0
    while not -(1 << 31) <= total < 1 << 31:
        yield place, total & ((1 << _LIMB) - 1)
        total >>= _LIMB
        place += 1
    yield place, total


def _entry_sums(blocks: DataFrame, books, bounds: list[tuple[int, int]]) -> DataFrame:
    """(part, entry, limb, n, sums): what each task's vectors add up to per entry."""
    longest = max((stop - start for start, stop in bounds), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for block in batch.to_pylist():
                tables, codes = _unpacked(block)
                for p, (start, stop) in enumerate(bounds):
                    if start == stop:
                        continue
                    best, _ = nearest(tables[start:stop], codes[:, start:stop], books.value[p])
                    order = np.argsort(best, kind="stable")
                    entries, firsts = np.unique(best[order], return_index=True)
                    columns = [np.add.reduceat(tables[d][codes[order, d]], firsts) for d in range(start, stop)]
                    counts = np.diff(np.append(firsts, len(order)))
                    for k, entry in enumerate(entries.tolist()):
                        mine = sums.setdefault((p, entry), [0] * (longest + 1))
                        mine[0] += int(counts[k])
                        for d, column in enumerate(columns):
                            mine[d + 1] += int(column[k])
        made: dict[tuple[int, int, int], list[int]] = {}
        for (p, entry), (count, *totals) in sums.items():
            made.setdefault((p, entry, 0), [0] * (longest + 1))[0] = count
            for d, total in enumerate(totals):
                for place, digit in _limbs(total):
                    made.setdefault((p, entry, place), [0] * (longest + 1))[d + 1] = digit
        if made:
            keys, rows = list(made), list(made.values())
            columns = {name: [k[i] for k in keys] for i, name in enumerate(("part", "entry", "limb"))}
            batch = {n: pa.array(v, pa.int32()) for n, v in columns.items()}
            batch["n"] = pa.array([r[0] for r in rows], pa.int64())
            batch["sums"] = pa.array([r[1:] for r in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(batch)

    each = blocks.mapInArrow(run, "part int, entry int, limb int, n long, sums array<long>")
    added = F.array(*(F.sum(F.col("sums")[d]) for d in range(longest)))
    return each.groupBy("part", "entry", "limb").agg(F.sum("n").alias("n"), added.alias("sums"))


def _as_numbers(rows: list[list[int]], width: int) -> np.ndarray:
    large = any(abs(x) >= NARROW for row in rows for x in row)
    made = np.empty((len(rows), width), object if large else np.int64)
    for i, row in enumerate(rows):
        made[i, :] = row
    return made


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """Per part, the parts of the vectors with the smallest ids; equal ids go by their components."""
    chosen = rows.where("vec_id IS NOT NULL").orderBy("vec_id", "embedding").limit(entries).select("embedding").collect()
    if not chosen:
        return []
    numbers = whole_numbers(np.array([r["embedding"] for r in chosen], np.float64))
    return [_as_numbers(numbers[:, a:b].tolist(), b - a) for a, b in part_bounds(numbers.shape[1], parts)]


def refine(blocks: DataFrame, books: list[np.ndarray], bounds: list[tuple[int, int]]) -> list[np.ndarray]:
    """One round: every part goes to its nearest entry, every entry becomes the floor of its parts' mean; unused ones stay."""
    sums = _entry_sums(blocks, blocks.sparkSession.sparkContext.broadcast(books), bounds).collect()
    counts: dict[tuple[int, int], int] = {}
    totals: dict[tuple[int, int], list[int]] = {}
    for r in sums:
        key = (r["part"], r["entry"])
        counts[key] = counts.get(key, 0) + r["n"]
        old = totals.get(key, [0] * len(r["sums"]))
        totals[key] = [t + (s << (_LIMB * r["limb"])) for t, s in zip(old, r["sums"])]
    refined = []
    for p, (start, stop) in enumerate(bounds):
        rows = books[p].tolist()
        for entry in range(len(rows)):
            if counts.get((p, entry)):
                rows[entry] = [t // counts[p, entry] for t in totals[p, entry][: stop - start]]
        refined.append(_as_numbers(rows, stop - start))
    return refined


def fit_codebooks(rows: DataFrame, blocks: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Integer codebooks, one per part, from all vectors."""
    books = first_codebooks(rows, parts, entries)
    if books:
        bounds = part_bounds(sum(b.shape[1] for b in books), parts)
        for _ in range(rounds):
            books = refine(blocks, books, bounds)
    return books


def encode(blocks: DataFrame, books: list[np.ndarray], parts: int = PARTS) -> DataFrame:
    """(vec_id, label, code, error): two hex digits per part and the squared distance; errors stop at 2**63 - 1."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    bounds = part_bounds(sum(b.shape[1] for b in books), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                tables, codes = _unpacked(block)
                found = np.zeros((len(codes), len(bounds)), np.uint8)
                error = np.zeros(len(codes), object)
                for p, (start, stop) in enumerate(bounds):
                    if start < stop:
                        found[:, p], distance = nearest(tables[start:stop], codes[:, start:stop], shared.value[p])
                        error = error + distance.astype(object)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": pa.array(block["ids"], pa.int64()),
                        "label": pa.array(block["labels"], pa.int64()),
                        "code": pa.array([row.tobytes().hex() for row in found], pa.string()),
                        "error": pa.array([min(int(e), LARGEST) for e in error], pa.int64()),
                    }
                )

    return blocks.mapInArrow(run, "vec_id long, label long, code string, error long")


def decode(encoded: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding): the vectors that the codes stand for, each component in the middle of its step."""
    entries = F.array(*(F.array(*(F.array(*(F.lit((float(x) + 0.5) / scale) for x in row)) for row in book.tolist())) for book in books))
    place = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    picked = F.flatten(F.array(*(entries[p][place(p)] for p in range(len(books)))))
    return encoded.select("vec_id", picked.alias("embedding"))


def codebook_digest(books: list[np.ndarray]) -> str:
    return sha256(",".join(str(int(x)) for book in books for row in book.tolist() for x in row).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    Repeated ids are rows of their own, and the smallest of them may start several entries; a row without vec_id is encoded
    but starts none. Fewer vectors than ``entries`` start as many entries. Codes need at most 256 entries. Components
    may have any finite size. Errors of one label are added before they meet a join, so a label that most
    rows share is no hot group. Vectors that ``usable`` leaves out and an empty table give no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(usable(vectors), "vectors")
    blocks = to_blocks(rows)
    books = fit_codebooks(rows, blocks, parts, entries, rounds)
    if not books:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    encoded = encode(blocks, books, parts)
    encoded = stage(encoded.withColumn("_no_label", F.col("label").isNull()).fillna(0, ["label"]), "vector_codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = encoded.groupBy("label", "_no_label").agg(F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    joined = small_join(encoded, stage(sums, "label_errors"), ["label", "_no_label"], "inner")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def _sql_round(i: int) -> str:
    return f"""
near{i} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT v.r, v.p, b.e, sum((v.x - b.x) * (v.x - b.x)) AS d FROM v JOIN book{i} b ON b.p = v.p AND b.k = v.k GROUP BY v.r, v.p, b.e)
  GROUP BY r, p
)"""


def _sql_book(i: int) -> str:
    return f"""
means{i} AS (SELECT v.p, n.e, v.k, floor(sum(v.x)::DOUBLE / count(*))::BIGINT AS x FROM v JOIN near{i - 1} n USING (r, p) GROUP BY v.p, n.e, v.k),
book{i} AS MATERIALIZED (SELECT b.p, b.e, b.k, coalesce(m.x, b.x) AS x FROM book{i - 1} b LEFT JOIN means{i} m USING (p, e, k))"""


#: Components as rows; distances, means and codes by grouping.
SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT r, (i - 1) // (len(embedding) // {PARTS}) AS p, (i - 1) % (len(embedding) // {PARTS}) AS k,
    floor({SCALE} * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT r, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), first AS (SELECT r, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS e FROM kept WHERE vec_id IS NOT NULL ORDER BY e LIMIT {ENTRIES}),
book0 AS MATERIALIZED (SELECT p, e, k, x FROM v JOIN first USING (r)),
{_sql_round(0)}, {_sql_book(1)}, {_sql_round(1)}, {_sql_book(2)}, {_sql_round(2)},
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY r)
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, k)) FROM book2) AS codebooks_sha256
FROM kept k JOIN codes c USING (r)
"""
