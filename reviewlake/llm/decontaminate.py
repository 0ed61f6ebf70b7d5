"""Benchmark decontamination: find windows of benchmark words in training texts, then report, cut or drop.

The benchmark becomes blocks of bounded size. A block holds its words as numbers, its items as one stream of such
numbers, and the distinct windows of the stream with a hash and the items they come from. Blocks are broadcast one at
a time; each scans every text once: words are looked up, windows of known words are hashed, and a hash that is found is
verified word by word. What a text has collected so far travels with its row, so no row needs an identity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlake.llm.texts import mix, ship_package, slices, text_column
from reviewlake.operators.placement import stage

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Most UTF-8 bytes of benchmark text in one block, unless a single item is longer.
BLOCK_BYTES = 16 * 1024 * 1024
SLICE_BYTES = 4 * 1024 * 1024
#: Words of the contract, on text whose A-Z are in lower case: digits, letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BYTE_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(range(256)).lower()
#: Lower case, and a blank for every byte that is in no word.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in _LOWER)
_FACTORS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def window_hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` numbers."""
    last = len(numbers) - size + 1
    if last <= 0:
        return np.zeros(0, np.uint64)
    hashed = mix(numbers.astype(np.uint64) + np.uint64(1))
    total = np.zeros(last, np.uint64)
    for offset in range(size):
        total += hashed[offset : offset + last] * _FACTORS[offset]
    return mix(total)


@dataclass
class Windows:
    """Distinct windows of one size: sorted ``hashes``, where each stands in the stream, and the number of its item list."""

    hashes: np.ndarray
    at: np.ndarray
    items: np.ndarray
    most_equal: int


@dataclass
class Block:
    """``vocabulary``: word to number; ``stream``: the items' words; ``windows`` by size; ``lists``: distinct item lists."""

    vocabulary: dict[bytes, int]
    stream: np.ndarray
    windows: dict[int, Windows]
    lists: list[tuple[int, ...]]


def build_block(rows: list[tuple[int | None, str | None]]) -> Block:
    vocabulary: dict[bytes, int] = {}
    stream: list[int] = []
    found: dict[int, dict[tuple[int, ...], tuple[int, set[int]]]] = {}
    for item, text in rows:
        numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        size = min(WINDOW, len(numbers))
        start = len(stream)
        stream += numbers
        for i in range(len(numbers) - size + 1 if size else 0):
            at, items = found.setdefault(size, {}).setdefault(tuple(numbers[i : i + size]), (start + i, set()))
            if item is not None:
                items.add(item)
    lists: dict[tuple[int, ...], int] = {}
    flat = np.array(stream, np.int32)
    windows = {}
    for size, of_size in found.items():
        at = np.array([a for a, _ in of_size.values()], np.int64)
        items = np.array([lists.setdefault(tuple(sorted(i)), len(lists)) for _, i in of_size.values()], np.int32)
        hashes = window_hashes(np.array([k for k in of_size], np.int64).ravel(), size)[::size]
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        equal = np.searchsorted(hashes, hashes, side="right") - np.searchsorted(hashes, hashes, side="left")
        windows[size] = Windows(hashes, at[order], items[order], int(equal.max()))
    return Block(vocabulary, flat, windows, list(lists))


@dataclass
class Scan:
    """Of a few texts: words of each, ``hit`` per word (one after another), and pairs (text, item list)."""

    counts: np.ndarray
    hit: np.ndarray
    pairs: np.ndarray


def scan(texts: list[str | None], block: Block) -> Scan:
    words = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    total = int(counts.sum())
    get = block.vocabulary.get
    numbers = np.fromiter((get(x, -1) for w in words for x in w), np.int32, total)
    text_of = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    unknown = np.append(np.flatnonzero(numbers < 0), total)
    known_to = unknown[np.searchsorted(unknown, np.arange(total))]
    room = np.minimum(known_to, ends) - np.arange(total)  # words from here on that a window may take
    edges = np.zeros(total + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for size, windows in block.windows.items():
        starts = np.flatnonzero(room >= size)
        if not len(starts):
            continue
        hashes = window_hashes(numbers, size)[starts]
        first = np.searchsorted(windows.hashes, hashes)
        for step in range(windows.most_equal):
            slot = np.minimum(first + step, len(windows.hashes) - 1)
            same = np.flatnonzero((first + step < len(windows.hashes)) & (windows.hashes[slot] == hashes))
            if not len(same):
                continue
            at, slot = starts[same], slot[same]
            reach = np.arange(size)
            true = (numbers[at[:, None] + reach] == block.stream[windows.at[slot][:, None] + reach]).all(axis=1)
            at, slot = at[true], slot[true]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + size, -1)
            pairs.append(np.unique(np.stack([text_of[at], windows.items[slot].astype(np.int64)], axis=1), axis=0))
    return Scan(counts, np.cumsum(edges[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0))


def _spans(hit: np.ndarray) -> list[list[int]]:
    """[first word, word after the last] of each run of hit words."""
    steps = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return steps.reshape(-1, 2).tolist()


def _merged(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for first, end in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    return merged


def cut(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them; what is left is joined by a blank."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _BYTE_WORD.finditer(raw.translate(_LOWER))]
    kept, at = [], 0
    for first, end in spans:
        kept.append(raw[at : places[first][0]].strip())
        at = places[end - 1][1]
    kept.append(raw[at:].strip())
    return b" ".join(part for part in kept if part).decode("utf-8", "surrogatepass")


#: What a scan adds to a row.
MARKS = {"n_words": pa.int64(), "spans": pa.list_(pa.list_(pa.int64())), "items": pa.list_(pa.int64())}


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks by hash; their number comes from the counted bytes."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("text"))
    rows = stage(rows.where(F.length("text") > 0).dropDuplicates(), "benchmark")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    numbered = rows.withColumn("block", F.pmod(F.xxhash64("text", "item"), F.lit(count)))
    for i in range(count):
        part = numbered.where(F.col("block") == i).select("item", "text").collect()
        yield build_block([(r["item"], r["text"]) for r in part])


def mark(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, text: str = "text") -> DataFrame:
    """All rows with one more column ``marks``: (n_words, spans of hit words, item_ids), all of the whole text.

    The caller's columns are kept, whatever their names but ``marks``. NULL and empty texts have no words. Equal rows are
    marked alike. Rows of the benchmark without text or words match nothing, those without item_id are in no ``items``.
    A block after the first rescans the staged rows, so memory does not grow with the benchmark.
    """
    spark = documents.sparkSession
    ship_package(spark)
    kind = "struct<n_words: bigint, spans: array<array<bigint>>, items: array<bigint>>"
    none = "CAST(NULL AS " + kind + ")"
    marked = documents.withColumn("marks", F.expr(none))
    for i, block in enumerate(_blocks(benchmark, block_bytes)):
        if i:
            marked = stage(marked, "marked")
        marked = marked.mapInArrow(_scanner(spark.sparkContext.broadcast(block), text), marked.schema)
    return marked


def _scanner(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for batch in slices(batches, text, SLICE_BYTES):
            found = scan(text_column(batch, text), block)
            place = batch.schema.get_field_index("marks")
            before = batch.column(place).to_pylist()
            ends = np.cumsum(found.counts)
            lists: dict[int, set[int]] = {}
            for row, number in found.pairs.tolist():
                lists.setdefault(row, set()).update(block.lists[number])
            hits = np.add.reduceat(np.append(found.hit, False).astype(np.int64), np.minimum(ends - found.counts, len(found.hit))) if len(ends) else []
            marks = []
            for row, (count, end, some) in enumerate(zip(found.counts.tolist(), ends.tolist(), hits)):
                old = before[row]
                spans = _spans(found.hit[end - count : end]) if count and some else []
                items = lists.get(row, set())
                if old is not None:
                    spans, items = _merged(spans + old["spans"]), items | set(old["items"])
                marks.append({"n_words": count, "spans": spans, "items": sorted(items)})
            column = pa.array(marks, pa.struct(list(MARKS.items())))
            columns = [*batch.columns[:place], column, *batch.columns[place + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _n_hit():
    return F.aggregate("marks.spans", F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0])


def report(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row; see ``mark`` for unusual rows."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = mark(rows, benchmark, block_bytes)
    listed = F.array_join(F.array_sort(F.col("marks.items").cast("array<string>")), ",")
    return marked.select(
        "doc_id", F.col("marks.n_words").alias("n_words"), _n_hit().alias("n_hit"),
        F.size("marks.items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        (F.size("marks.spans") > 0).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, remove: str = "spans", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows without benchmark passages: ``spans`` cuts the hit words out, ``documents`` drops every text with a hit.

    Columns are those of the input. A text that is cut may become empty; the row stays.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be spans or documents, got {remove!r}")
    names = documents.columns
    own = [f"c{i}" for i in range(len(names))]
    text = own[names.index("text")]
    marked = mark(documents.toDF(*own), benchmark, block_bytes, text)
    if remove == "documents":
        return marked.where(F.size("marks.spans") == 0).drop("marks").toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE_BYTES):
            at = batch.schema.get_field_index(text)
            marks = batch.column(batch.schema.get_field_index("marks")).to_pylist()
            texts = [cut(t, m["spans"]) if m["spans"] else t for t, m in zip(batch.column(at).to_pylist(), marks)]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "marks"]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "marks"])

    return marked.mapInArrow(run, marked.drop("marks").schema).toDF(*names)


_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Windows of items by size, windows of texts of the same sizes, and a join on the words themselves.
SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_SQL_LOWER}, '{WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_SQL_LOWER}, '{WORD}') AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i+k-1], ' ') AS win
  FROM (SELECT *, least({WINDOW}, len(w)) AS k, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), seen AS (
  SELECT r, k, i, array_to_string(w[i:i+k-1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), hits AS MATERIALIZED (SELECT r, k, i, item_id FROM seen JOIN windows USING (k, win)),
words AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS word FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items.items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
