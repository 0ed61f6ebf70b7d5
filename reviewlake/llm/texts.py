"""Words, hashes, Arrow plumbing and joins shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.operators.placement import fits_broadcast

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
LOWER_A_TO_Z = bytes(range(256)).lower()
BROADCAST_BYTES = 32 * 1024 * 1024


def lower_words(text: str | None) -> list[bytes]:
    """Words of ``text`` with A-Z in lower case; ``bytes.split`` knows exactly the white space of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_A_TO_Z).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Odd factors of the words of a shingle.
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct ``size``-word shingles; a shorter text is one shingle.

    Words are hashed one by one, shingles of all texts together, so the cost per text is one small sort.
    """
    words = [lower_words(text) for text in texts]
    counts = np.array([len(w) for w in words], np.int64)
    total = int(counts.sum())
    if not total:
        return [np.zeros(0, np.uint64) for _ in texts]
    hashes = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, total)
    shingles = np.zeros(total, np.uint64)
    for offset in range(size):
        shingles[: total - offset] += hashes[offset:] * _FACTORS[offset]
    shingles = mix(shingles)
    ends = np.cumsum(counts)
    found = []
    for start, stop in zip((ends - counts).tolist(), ends.tolist()):
        if stop - start >= size:
            part = shingles[start : stop - size + 1].copy()
            part.sort()
            found.append(part[np.concatenate(([True], part[1:] != part[:-1]))])
        elif stop > start:
            whole = (hashes[start:stop] * _FACTORS[size : size + stop - start]).sum(keepdims=True)
            found.append(mix(whole))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def text_column(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def long_column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A long column without nulls as numpy, without a copy where Arrow allows it."""
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def slices(batches: Iterator[pa.RecordBatch], name: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice have about ``most_bytes`` at most; a longer text is a slice alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(name))
        ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def small_join(big: DataFrame, small: DataFrame, on: list[str], how: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a staged table: broadcast when its counted bytes fit ``max_bytes``, else by shuffle.

    For keys that may be hot on the big side both sides reach the shuffle join as plain exchanges, so
    adaptive execution can split a hot key.
    """
    return big.join(F.broadcast(small) if fits_broadcast(small, max_bytes) else small, on, how)


def shielded(documents: DataFrame, operate: Callable[[DataFrame], DataFrame], needed: tuple[str, ...]) -> DataFrame:
    """Rows of ``operate(documents)`` with the input's own columns, whatever their names.

    All columns but the ``needed`` ones have other names inside, so none meets a column that the operator adds.
    """
    inside = [c if c in needed else f"in{i}" for i, c in enumerate(documents.columns)]
    result = operate(documents.toDF(*inside))
    return result.select(*(F.col(name).alias(c) for name, c in zip(inside, documents.columns)))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this library: Spark serves it to every executor, once per application.

    Nothing is done where PYTHONPATH, which workers inherit, already names the library's folder.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if context.applicationId in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    package = root / Path(__file__).resolve().parents[1].name
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
