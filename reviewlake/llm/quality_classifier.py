"""Quality classifier: logistic regression on hashed word n-grams, FTRL training, sparse dot products."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from reviewlake.llm.linear import Settings, bounded, sigmoid, train
from reviewlake.llm.texts import mix, ship_package, slices, text_column
from reviewlake.operators.placement import stage

#: Documented bound on the labelled rows a model is trained on.
MOST_TRAINING_ROWS = 16_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
REMEMBERED = 200_000
_SHAPES = np.uint64(0x51A9E5)


class WordNgrams:
    """Hashed 1- and 2-grams of words, and 1- to 3-grams of word shapes, of a whole text.

    A shape is the form of a word (lower, capitalised, upper, digits, signs) and whether it repeats the
    word before it. Counts are scaled to length one.
    """

    def __init__(self, dimensions: int):
        self.mask = np.uint64(dimensions - 1)
        self.known: dict[str, int] = {}

    @staticmethod
    def _code(word: str) -> int:
        if not (word[0].isalnum() or word[0] == "_"):
            shape = 4
        elif word.isdigit():
            shape = 3
        elif word.isupper() and len(word) > 1:
            shape = 2
        elif word[0].isupper():
            shape = 1
        else:
            shape = 0
        return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~7 | shape

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = TOKEN.findall(text) if text else []
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for word in set(words).difference(known):
                known[word] = self._code(word)
            codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        same = np.r_[np.uint64(0), (codes[1:] == codes[:-1]).astype(np.uint64)]
        shapes = (codes & np.uint64(7)) + np.uint64(8) * same + _SHAPES
        grams = [codes, mix(codes[:-1] * np.uint64(31) + codes[1:]), mix(shapes)]
        grams.append(mix(shapes[:-1] * np.uint64(131) + shapes[1:] * np.uint64(7)))
        grams.append(mix(shapes[:-2] * np.uint64(8191) + shapes[1:-1] * np.uint64(131) + shapes[2:]))
        index, counts = np.unique(mix(np.concatenate(grams)) & self.mask, return_counts=True)
        return index.astype(np.int64), counts / np.sqrt(float((counts.astype(float) ** 2).sum()))


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def training_rows(documents: DataFrame, labels: DataFrame, most_rows: int, parts: int) -> DataFrame:
    """(doc_id, text, label, part): a bounded sample of labelled rows outside the held-out third; staged."""
    usable = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~_held_out())
    chosen = stage(bounded(usable.select("doc_id", F.col("quality").alias("label")), most_rows), "quality_labels")
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(parts)).cast("int")
    return stage(texts.select("doc_id", "text", "label", part.alias("part")), "quality_training")


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), most_rows: int = MOST_TRAINING_ROWS) -> np.ndarray:
    """Dense weights; all zero, so every score is one half, when there is no labelled row to learn from."""
    ship_package(documents.sparkSession)
    rows = training_rows(documents, labels, most_rows, settings.parts).withColumn("model", F.lit("quality"))

    def features(row: dict, made=WordNgrams(settings.dimensions)) -> tuple[np.ndarray, np.ndarray]:
        return made(row["text"])

    return train(rows, features, ["text"], settings, ["quality"])["quality"]


def _scores(weights, dimensions: int):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, ngrams = weights.value, WordNgrams(dimensions)
        for batch in slices(batches, "text", 16 << 20):
            scores = []
            for text in text_column(batch, "text"):
                index, value = ngrams(text)
                scores.append(float(w[index] @ value) + w[dimensions])
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(sigmoid(np.array(scores)))], schema=schema)

    return run


def score_documents(documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), most_rows: int = MOST_TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``documents``; only the text is scored.

    Empty and NULL texts get the score of the bias alone. A NULL doc_id is never held out. Labels that
    are NULL or belong to no document are not used; labels of repeated ids all count.
    """
    weights = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, settings, most_rows))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(_scores(weights, settings.dimensions), "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
