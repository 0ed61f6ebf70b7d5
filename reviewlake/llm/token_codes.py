"""Token ids in directly addressable codes: any id can be read without decoding a block.

The ids of a segment are cut into chunks, lowest bits first. Level k holds the k-th chunk of all ids that
have one, packed at a fixed width, beside a bitmap that says which ids continue at level k + 1; a directory
of ranks over the bitmap gives an id's place there. Widths are the ones that make the segment smallest.

A file is a Parquet table of segments in order of doc_id: Spark's committer makes lost tasks harmless, and
any store that Spark reads will do. Segment bytes: see ``pack``.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reviewlake.llm.pretokens import START, WHOLE, ChunkIds, chunk_text
from reviewlake.llm.texts import ship_package, slices, small_join, text_column
from reviewlake.operators.placement import scratch_path

MAGIC = b"DAC1"
#: A segment ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 20
RANK_BITS = 512
END_ID = 0
SEGMENTS = "part int, seq int, first_doc long, last_doc long, n_docs int, n_tokens long, codes binary"


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths with the fewest bits in all, by dynamic programming over the lengths of the ids in bits."""
    top = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
    longer = [int((ids >> np.uint32(k)).astype(bool).sum()) if k else len(ids) for k in range(top)]
    cost, choice = [0.0] * (top + 1), [0] * (top + 1)
    for at in range(top - 1, -1, -1):
        options = [(longer[at] * (w + (at + w < top)) + 4096 + cost[at + w], w) for w in range(1, top - at + 1)]
        cost[at], choice[at] = min(options)
    widths, at = [], 0
    while at < top:
        widths.append(choice[at])
        at += choice[at]
    return widths


def _packed(values: np.ndarray, width: int) -> bytes:
    out = bytearray()
    for start in range(0, len(values), 1 << 17):  # a multiple of 8 values: whole bytes
        part = values[start : start + (1 << 17)]
        raw = np.ascontiguousarray(part, "<u4").view(np.uint8).reshape(-1, 4)
        out += np.packbits(np.unpackbits(raw, axis=1, count=width, bitorder="little").ravel(), bitorder="little").tobytes()
    return bytes(out)


def pack(ids: np.ndarray, doc_ids: list[int | None], counts: np.ndarray) -> bytes:
    """MAGIC, length of the header, header (JSON), doc ids, counts, then chunks, bitmap and ranks of each level."""
    widths = best_widths(ids)
    rest, body, levels = ids.astype(np.uint32), [], []
    for k, width in enumerate(widths):
        chunks = _packed(rest & np.uint32((1 << width) - 1), width)
        higher = rest >> np.uint32(width)
        more = higher > 0 if k + 1 < len(widths) else np.zeros(0, bool)
        bitmap = np.packbits(more, bitorder="little").tobytes()
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, bool)
        padded[: len(more)] = more
        sums = padded.reshape(-1, RANK_BITS).sum(1) if len(more) else np.zeros(0, np.int64)
        ranks = (np.cumsum(sums) - sums).astype("<u4").tobytes()
        levels.append([width, len(rest), len(chunks), len(bitmap), len(ranks)])
        body += [chunks, bitmap, ranks]
        rest = higher[more] if len(more) else rest[:0]
    nulls = [i for i, d in enumerate(doc_ids) if d is None]
    header = json.dumps({"n": len(ids), "docs": len(doc_ids), "nulls": nulls, "levels": levels}).encode()
    index = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + counts.astype("<u4").tobytes()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, index, *body])


class Codes:
    """A packed segment. ``codes[i]`` reads one id; ``all()`` reads them all."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        length = int.from_bytes(data[4:8], "little")
        header = json.loads(data[8 : 8 + length])
        at = 8 + length
        docs = header["docs"]
        ids = np.frombuffer(data, "<i8", docs, at).tolist()
        for i in header["nulls"]:
            ids[i] = None
        self.doc_ids = ids
        self.counts = np.frombuffer(data, "<u4", docs, at + 8 * docs).astype(np.int64)
        at += 12 * docs
        self.n = header["n"]
        self.levels = []
        for width, size, chunks, bitmap, ranks in header["levels"]:
            parts = []
            for part in (chunks, bitmap):
                parts.append(np.frombuffer(data, np.uint8, part, at))
                at += part
            parts.append(np.frombuffer(data, "<u4", ranks // 4, at))
            at += ranks
            self.levels.append((width, size, *parts))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for width, _, chunks, bitmap, ranks in self.levels:
            first = i * width
            window = int.from_bytes(chunks[first >> 3 : (first + width + 7) >> 3].tobytes(), "little")
            value |= ((window >> (first & 7)) & ((1 << width) - 1)) << shift
            shift += width
            if not len(bitmap) or not (int(bitmap[i >> 3]) >> (i & 7)) & 1:
                break
            block = i // RANK_BITS
            before = int.from_bytes(bitmap[block * RANK_BITS // 8 : (i >> 3) + 1].tobytes(), "little")
            i = int(ranks[block]) + (before & ((1 << (i - block * RANK_BITS)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        ids, place, shift = np.zeros(self.n, np.uint32), np.arange(self.n), 0
        for width, size, chunks, bitmap, _ in self.levels:
            for start in range(0, size, 1 << 17):
                stop = min(size, start + (1 << 17))
                bits = np.unpackbits(chunks[start * width // 8 :], count=(stop - start) * width, bitorder="little")
                raw = np.zeros((stop - start, 4), np.uint8)
                raw[:, : -(-width // 8)] = np.packbits(bits.reshape(-1, width), axis=1, bitorder="little")
                ids[place[start:stop]] |= raw.view("<u4").ravel().astype(np.uint32) << np.uint32(shift)
            shift += width
            if len(bitmap):
                place = place[np.unpackbits(bitmap, count=size, bitorder="little").astype(bool)]
        return ids


@lru_cache(maxsize=2)
def _library_encoder(path: str) -> Callable[[list[str | None]], list[np.ndarray]]:
    """Ids of texts as the library gives them: chunk by chunk, and texts that name an added token as a whole."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    length = np.zeros(max(tokenizer.get_vocab().values()) + 1, np.int64)
    for token, i in tokenizer.get_vocab().items():
        length[i] = len(token)  # the byte-level alphabet has one character per byte

    def single(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast([chunk_text(k) for k in keys], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def joined(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that begin with white space encode as one text; the bytes of its tokens tell where each ends."""
        texts = [chunk_text(k) for k in keys]
        (found,) = tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        ends = np.cumsum(length[ids])
        wanted = np.cumsum([len(t.encode("utf-8", "surrogatepass")) for t in texts])
        place = np.searchsorted(ends, wanted)
        if place[-1] >= len(ends) or (ends[place] != wanted).any():
            return single(keys)
        return ids, np.diff(place, prepend=-1)

    def encode(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        marked = sum(key[0] in (START, WHOLE) for key in keys)  # these come first
        parts = [single(keys[i : min(i + 4096, marked)]) for i in range(0, marked, 4096)]
        parts += [joined(keys[i : i + 4096]) for i in range(marked, len(keys), 4096)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    chunks = ChunkIds(encode)

    def encode_all(texts: list[str | None]) -> list[np.ndarray]:
        whole = [i for i, text in enumerate(texts) if text and any(a in text for a in added)]
        apart = set(whole)
        found = list(chunks.encode_all([None if i in apart else t for i, t in enumerate(texts)] if whole else texts))
        for i in whole:
            found[i] = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return found

    return encode_all


def _segments(tokenizer_path: str, segment_ids: int):
    schema = pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
         ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("codes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encode_all = _library_encoder(tokenizer_path)
        end = np.array([END_ID], np.uint32)
        counts: list[int] = []
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        total = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = [part, seq, docs[0], docs[-1], len(docs), len(ids), pack(ids, docs, np.array(counts, np.int64))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in slices(batches, "text", 16 << 20):
            for doc_id, ids in zip(text_column(batch, "doc_id"), encode_all(text_column(batch, "text"))):
                docs.append(doc_id)
                counts.append(len(ids) + 1)
                held += (ids, end)
                total += counts[-1]
                if total >= segment_ids:
                    yield close()
                    seq, docs, counts, held, total = seq + 1, [], [], [], 0
        if docs:
            yield close()

    return run


def write_codes(documents: DataFrame, path: str, tokenizer_path: str, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text and write the segments in ascending order of doc_id (NULL first).

    Rows are spread by ranges of doc_id; repeated ids are ordered by a hash of their text. The text is
    what is shuffled, since it is smaller than its ids. NULL texts are empty; each document ends with id 0.
    ``tokenizer_path`` must exist at the same place on all executors.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    ordered.mapInArrow(_segments(tokenizer_path, segment_ids), SEGMENTS).write.parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(part, seq, start): ids before each segment. Only one number per part meets in one place."""
    counts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = segments.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("local"))
    return local.join(before, "part").select("part", "seq", (F.col("before") + F.col("local")).alias("start"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )
    for batch in batches:
        for row in batch.to_pylist():
            codes = Codes(row["codes"])
            ids = codes.all().astype("<u4")
            ends = np.cumsum(codes.counts)
            starts = ends - codes.counts
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
            n = len(sums)
            columns = [np.full(n, row["part"], np.int32), np.full(n, row["seq"], np.int32), codes.doc_ids, starts, codes.counts, sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the written files."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    found = segments.select("part", "seq", "codes").mapInArrow(
        _digests, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    starts = segment_starts(segments.select("part", "seq", "n_tokens"))
    return small_join(found, starts, ["part", "seq"], "inner").select(
        "doc_id", (F.col("start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_range(spark: SparkSession, path: str, doc_id: int, first: int, last: int) -> list[int]:
    """Ids ``first`` to ``last`` (exclusive) of one document; reads one segment and only these ids of it."""
    segments = spark.read.schema(SEGMENTS).parquet(path).where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    for row in segments.select("codes").toLocalIterator():
        codes = Codes(row["codes"])
        if doc_id in codes.doc_ids:
            place = codes.doc_ids.index(doc_id)
            base = int(codes.counts[:place].sum())
            return [codes[base + i] for i in range(max(first, 0), min(last, int(codes.counts[place])))]
    return []


def encode_documents(documents: DataFrame, tokenizer_path: str, path: str | None = None, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Write ``documents`` as token codes and return the digests read back from the files.

    One row per row of ``documents``; an empty table writes no segment and gives no rows; other columns
    are ignored. ``path``: where the files go, by default a new folder in the shared one.
    """
    spark = documents.sparkSession
    ship_package(spark)
    path = path or scratch_path(spark, "token_codes")
    write_codes(documents, path, tokenizer_path, segment_ids)
    return read_digests(spark, path)
