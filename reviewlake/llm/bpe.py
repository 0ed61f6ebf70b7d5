"""Byte-level BPE by replay of the merges over the distinct words of a corpus block.

The distinct words of a block of texts are laid out as one sequence of symbols. An inverted index leads
from each merge to the positions where its pair stands; merges are applied in order of rank, each at all its
positions at once, and only the neighbours of what was merged get new entries in the index. A word that
occurs a thousand times is thus merged once. Blocks are independent, so nothing is shuffled, and a lost
task repeats its block only.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from reviewlake.llm.pretokens import ChunkIds, chunk_text
from reviewlake.llm.texts import ship_package, slices, text_column

#: Text of one corpus block. Its chunks, symbols and index take many times its size in a worker.
BLOCK_BYTES = 2 << 20
#: Chunks a worker remembers between blocks.
REMEMBERED = 200_000
NEVER = np.int32(2**31 - 1)


class Ranks:
    """The merges of a rank file: which pairs of tokens make which token."""

    def __init__(self, tokens: dict[bytes, int]):
        self.tokens: list[bytes] = [b""] * (max(tokens.values()) + 1)
        for token, rank in tokens.items():
            self.tokens[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in tokens]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.of_byte = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(merged, np.int32)[order], NEVER)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NEVER)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    with open(path, "rb") as lines:
        return Ranks({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def _by_rank(index: dict[int, list[np.ndarray]], heap: list[int], rank: np.ndarray, place: np.ndarray) -> None:
    """Enter positions into the index under the merge that their pair asks for."""
    order = np.argsort(rank, kind="stable")
    rank, place = rank[order], place[order]
    cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
    firsts = np.concatenate(([0], cuts))
    for r, start, stop in zip(rank[firsts].tolist(), firsts.tolist(), [*cuts.tolist(), len(rank)]):
        if r in index:
            index[r].append(place[start:stop])
        else:
            index[r] = [place[start:stop]]
            heapq.heappush(heap, r)


def _alone(word: bytes, ranks: Ranks) -> np.ndarray:
    """Ids of one word: again and again its pair of the smallest rank, the first from the left."""
    ids = ranks.of_byte[np.frombuffer(word, np.uint8)]
    while len(ids) > 1:
        found = ranks.of_pairs(ids[:-1], ids[1:])
        at = int(found.argmin())
        if found[at] == NEVER:
            break
        ids = np.concatenate((ids[:at], found[at : at + 1], ids[at + 2 :]))
    return ids.astype(np.uint32)


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and their number per word.

    The smallest rank in the index is always the next, as each word by itself would choose; equal ranks in
    one word are taken from the left. Vocabularies of ranks may let a merge make a pair of a smaller rank,
    which a word by itself would take before its other places; such words, if any, are encoded singly.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    symbol = ranks.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    total = len(symbol)
    if not total:
        return np.zeros(0, np.uint32), sizes
    ends = np.cumsum(sizes)
    after = np.arange(1, total + 1, dtype=np.int32)
    before = np.arange(-1, total - 1, dtype=np.int32)
    filled = sizes > 0
    after[ends[filled] - 1] = total
    before[(ends - sizes)[filled]] = -1
    pair = np.full(total, NEVER, np.int32)
    inner = np.flatnonzero(after < total)
    pair[inner] = ranks.of_pairs(symbol[inner], symbol[inner + 1])
    alive = np.ones(total, bool)

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    early: list[np.ndarray] = []
    live = np.flatnonzero(pair != NEVER).astype(np.int32)
    if len(live):
        _by_rank(index, heap, pair[live], live)
    while heap:
        rank = heapq.heappop(heap)
        lists = index.pop(rank)
        place = lists[0] if len(lists) == 1 else np.concatenate(lists)
        place = place[pair[place] == rank]
        if not len(place):
            continue
        place = np.unique(place)
        right = after[place]
        touching = right[:-1] == place[1:]
        if touching.any():  # in a run of overlapping pairs every other one is taken, from the left
            run_start = np.concatenate(([True], ~touching))
            at = np.arange(len(place))
            place = place[(at - np.maximum.accumulate(np.where(run_start, at, 0))) % 2 == 0]
            right = after[place]
        following = after[right]
        chained = np.flatnonzero(following[:-1] == place[1:])
        if len(chained):  # between two merges side by side the first meets the second's left symbol
            middle = ranks.of_pairs(np.full(len(chained), rank, np.int32), symbol[following[chained]])
            early.append(place[chained[middle < rank]])
        symbol[place] = rank
        after[place] = following
        alive[right] = False
        pair[right] = NEVER
        has_next = following < total
        before[following[has_next]] = place[has_next]
        left = before[place]
        touched = np.concatenate((place, left[left >= 0]))
        follower = after[touched]
        pair[touched[follower >= total]] = NEVER
        touched = touched[follower < total]
        if len(touched):
            found = ranks.of_pairs(symbol[touched], symbol[after[touched]])
            pair[touched] = found
            if (found < rank).any():
                early.append(touched[found < rank])
            new = found != NEVER
            if new.any():
                _by_rank(index, heap, found[new], touched[new])
    kept = np.flatnonzero(alive)
    owner = np.searchsorted(ends, kept, side="right")
    flat, counts = symbol[kept].astype(np.uint32), np.bincount(owner, minlength=len(words)).astype(np.int64)
    singly = np.unique(np.searchsorted(ends, np.concatenate(early), side="right")) if early else []
    if len(singly):
        parts = np.split(flat, np.cumsum(counts)[:-1])
        for i in singly:
            parts[i] = _alone(words[i], ranks)
        flat, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
    return flat, counts


@lru_cache(maxsize=2)
def corpus_encoder(ranks_path: str, pattern: str) -> ChunkIds:
    """A table of chunks whose new entries are encoded by one replay over their distinct words."""
    ranks, splitter = load_ranks(ranks_path), regex.compile(pattern)

    def encode(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number: dict[str, int] = {}
        words: list[int] = []
        per_chunk = []
        for key in keys:
            found = splitter.findall(chunk_text(key))
            per_chunk.append(len(found))
            words += [number.setdefault(word, len(number)) for word in found]
        flat, counts = replay([w.encode("utf-8", "surrogatepass") for w in number], ranks)
        starts = np.cumsum(counts) - counts
        word = np.array(words, np.int64)
        length = counts[word]
        stops = np.cumsum(length)
        ids = flat[np.repeat(starts[word] - stops + length, length) + np.arange(int(length.sum()))]
        chunk_of = np.repeat(np.arange(len(keys)), per_chunk)
        return ids, np.bincount(chunk_of, weights=length, minlength=len(keys)).astype(np.int64)

    return ChunkIds(encode, REMEMBERED)


def encoded(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str, block_bytes: int = BLOCK_BYTES):
    """(slice of a batch, ids of each of its texts)."""
    table = corpus_encoder(ranks_path, pattern)
    for batch in slices(batches, "text", block_bytes):
        yield batch, table.encode_all(text_column(batch, "text"))


def decode(ids: np.ndarray, ranks: Ranks) -> bytes:
    return b"".join(map(ranks.tokens.__getitem__, ids.tolist()))


def with_ids(documents: DataFrame, ranks_path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids): the ids of every text; NULL and empty texts have none."""
    ship_package(documents.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for batch, found in encoded(batches, ranks_path, pattern, block_bytes):
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], schema=schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def digest_documents(documents: DataFrame, ranks_path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes every text, decodes the ids, and digests both.

    One row per row of ``documents``; NULL and empty texts have no tokens; other columns are ignored; an
    empty table gives no rows. A text with a lone surrogate is taken by its three bytes.
    """
    ship_package(documents.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch, found in encoded(batches, ranks_path, pattern, block_bytes):
            counts, ids_sums, text_sums = [], [], []
            for ids in found:
                counts.append(len(ids))
                ids_sums.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_sums.append(hashlib.sha256(decode(ids, ranks)).hexdigest())
            doc_ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, *map(pa.array, (counts, ids_sums, text_sums))], schema=schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
