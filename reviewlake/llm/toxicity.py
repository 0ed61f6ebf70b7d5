"""Toxicity by a classifier chain: each category's linear model sees the probabilities of the ones before it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from reviewlake.llm.linear import Settings, bounded, sigmoid, train
from reviewlake.llm.texts import ship_package, slices, text_column
from reviewlake.operators.placement import stage

#: Documented bound on the labelled rows the chain is trained on.
MOST_TRAINING_ROWS = 12_000
FOLDS = 3
#: Weak labels of the categories before the last: a toxic row with one of these words. A parameter.
SEEDS = {
    "insult": ("idiot", "moron", "clown", "loser", "scum"),
    "contempt": ("pathetic", "worthless", "disgusting", "stupid", "trash"),
}
LAST = "toxic"
WORDS = re.compile(r"\w+")
#: Words are seen whole and by their beginnings, so that inflected forms share evidence.
BEGINNINGS = (4, 5, 6)
REMEMBERED = 200_000
#: A gram takes part in training if the share of toxic rows among the rows that hold it is surely above this.
TELLING_SHARE = 0.4
#: How sure: the lower end of the Wilson interval this many deviations wide.
DEVIATIONS = 1.96
SETTINGS = Settings(alpha=1.0, l1=0.05, l2=0.01, passes=6, parts=1)
MODELS = ("all", *(f"fold{k}" for k in range(FOLDS)))


class WordPresence:
    """Distinct hashed words and word beginnings of a whole text; each counts once."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.known: dict[str, int] = {}
        self.table = np.zeros((REMEMBERED + 1, 1 + len(BEGINNINGS)), np.int64)

    def _hash(self, gram: str) -> int:
        return xxhash.xxh3_64_intdigest(gram.encode("utf-8", "surrogatepass")) & (self.dimensions - 1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = set(WORDS.findall(text.lower())) if text else ()
        if not words:
            return np.zeros(0, np.int64)
        known = self.known
        fresh = words.difference(known)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = words
            if len(fresh) > REMEMBERED:
                return np.unique([self._hash(g) for w in words for g in self._grams(w)])
        for word in fresh:
            known[word] = row = len(known)
            self.table[row] = [self._hash(gram) for gram in self._grams(word)]
        return np.unique(self.table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))])

    @staticmethod
    def _grams(word: str) -> list[str]:
        return [word, *("^" + word[:n] if len(word) >= n else word for n in BEGINNINGS)]


def _example(row: dict, dimensions: int, earlier: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse part of a row and, behind the bias, the probabilities of earlier categories."""
    index = np.asarray(row["grams"], np.int64)
    dense = np.arange(dimensions + 1, dimensions + 1 + earlier)
    chances = np.asarray([row[f"p{k}"] for k in range(earlier)], float)
    return np.concatenate((index, dense)), np.concatenate((np.ones(len(index)), chances))


def _grams_of(dimensions: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("toxic", pa.int32()), ("seeded", pa.list_(pa.int32())), ("grams", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = WordPresence(dimensions)
        for batch in slices(batches, "text", 8 << 20):
            texts = text_column(batch, "text")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()),
                    batch.column(batch.schema.get_field_index("toxic")).cast(pa.int32()),
                    batch.column(batch.schema.get_field_index("seeded")).cast(pa.list_(pa.int32())),
                    pa.array([presence(t) for t in texts], pa.list_(pa.int64())),
                ],
                schema=schema,
            )

    return run


def training_rows(documents: DataFrame, labels: DataFrame, seeds: dict, settings: Settings, most_rows: int) -> DataFrame:
    """(doc_id, toxic, seeded, grams, fold, part) of a bounded sample of labelled rows; staged."""
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = stage(bounded(usable, most_rows), "toxic_labels")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    marks = [F.coalesce(F.lower("text").rlike(r"\b(" + "|".join(map(re.escape, words)) + r")\b"), F.lit(False)).cast("int") for words in seeds.values()]
    marked = texts.select("doc_id", "toxic", "text", F.array(*marks).cast("array<int>").alias("seeded"))
    made = marked.mapInArrow(_grams_of(settings.dimensions), "doc_id long, toxic int, seeded array<int>, grams array<long>")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
    part = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(settings.parts)).cast("int")
    return stage(made.withColumn("fold", fold).withColumn("part", part), "toxic_training")


def telling_grams(rows: DataFrame, dimensions: int) -> dict[str, np.ndarray]:
    """{model: mask over the hashed grams} of grams whose presence tells toxic rows from others.

    A rare word of one long toxic text says nothing, the same word in several toxic texts and no clean one
    does. The model of a fold counts only the rows outside that fold. At most ``dimensions`` rows come back.
    """
    grams = rows.select("toxic", "fold", F.explode("grams").alias("gram"))

    def share(model: str) -> Column:
        seen = F.lit(True) if model == "all" else F.col("fold") != int(model.removeprefix("fold"))
        n, hits = F.count_if(seen), F.count_if(seen & (F.col("toxic") == 1))
        p, z2 = hits / n, DEVIATIONS**2
        low = (p + z2 / (2 * n) - DEVIATIONS * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
        return F.coalesce(F.when(n > 0, low), F.lit(0.0))

    counted = grams.groupBy("gram").agg(*((share(m) >= TELLING_SHARE).alias(m) for m in MODELS))
    found = counted.where(" OR ".join(MODELS)).toArrow()
    masks = {}
    for model in MODELS:
        masks[model] = np.zeros(dimensions, bool)
        masks[model][found["gram"].to_numpy()[found[model].to_numpy()]] = True
    return masks


def _only(rows: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``rows`` with the grams in ``wanted`` only, staged: what is trained on stays small, however long a text is."""
    mask = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(frames):
        for frame in frames:
            frame["grams"] = [g[mask.value[g]] for g in (np.asarray(g, np.int64) for g in frame["grams"])]
            yield frame

    return stage(rows.mapInPandas(run, rows.schema), "toxic_telling")


def _chances(row: dict, weights: np.ndarray, dimensions: int, earlier: int) -> float:
    index, value = _example(row, dimensions, earlier)
    return float(sigmoid(weights[index] @ value + weights[dimensions]))


def _out_of_fold(rows: DataFrame, weights: dict[str, np.ndarray], dimensions: int, step: int) -> DataFrame:
    """Add p<step>: for each row the probability by the model that has not seen its fold."""
    shared = rows.sparkSession.sparkContext.broadcast([weights[f"fold{k}"] for k in range(FOLDS)])

    def run(frames):
        for frame in frames:
            records = frame.to_dict("records")
            frame[f"p{step}"] = [_chances(r, shared.value[r["fold"]], dimensions, step) for r in records]
            yield frame

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", p{step} double"
    return stage(rows.mapInPandas(run, schema), f"toxic_step{step}")


def fit_chain(documents: DataFrame, labels: DataFrame, seeds: dict = SEEDS, settings: Settings = SETTINGS, most_rows: int = MOST_TRAINING_ROWS) -> list[np.ndarray]:
    """Weights of each link of the chain. A later link is trained on out-of-fold probabilities of earlier ones."""
    ship_package(documents.sparkSession)
    rows = training_rows(documents, labels, seeds, settings, most_rows)
    telling = telling_grams(rows, settings.dimensions)
    rows = _only(rows, np.logical_or.reduce(list(telling.values())))
    masks = documents.sparkSession.sparkContext.broadcast(telling)
    chain = []
    for step in range(len(seeds) + 1):
        label = F.col("toxic") if step == len(seeds) else F.when(F.col("toxic") == 1, F.col("seeded")[step]).otherwise(0)
        models = MODELS[:1] if step == len(seeds) else MODELS
        member = F.array(
            F.lit("all"), *(F.when(F.col("fold") != k, F.lit(f"fold{k}")) for k in range(FOLDS) if step < len(seeds))
        )
        copies = rows.withColumn("label", label).withColumn("model", F.explode(F.array_compact(member)))

        def features(row: dict, step=step) -> tuple[np.ndarray, np.ndarray]:
            grams = np.asarray(row["grams"], np.int64)
            return _example({**row, "grams": grams[masks.value[row["model"]][grams]]}, settings.dimensions, step)

        weights = train(copies, features, ["grams", *(f"p{k}" for k in range(step))], settings, models, len(seeds))
        chain.append(weights["all"])
        if step < len(seeds):
            rows = _out_of_fold(rows, weights, settings.dimensions, step)
    return chain


def _scored(batches: Iterator[pa.RecordBatch], column: str, links: list[np.ndarray], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, bounded in bytes of text, with the probability of each category per row."""
    presence = WordPresence(dimensions)
    for batch in slices(batches, column, 16 << 20):
        found = np.zeros((batch.num_rows, len(links)))
        for i, text in enumerate(text_column(batch, column)):
            grams = presence(text)
            for k, w in enumerate(links):
                score = w[grams].sum() + w[dimensions] + w[dimensions + 1 : dimensions + 1 + k] @ found[i, :k]
                found[i, k] = sigmoid(score)
        yield batch, found


def _predict(chain, dimensions: int, names: list[str]):
    schema = pa.schema([("doc_id", pa.int64()), *((f"p_{name}", pa.float64()) for name in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scored(batches, "text", chain.value, dimensions):
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(found[:, k]) for k in range(len(names)))], schema=schema)

    return run


def score_toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, seeds: dict = SEEDS, settings: Settings = SETTINGS, most_rows: int = MOST_TRAINING_ROWS) -> DataFrame:
    """(doc_id, p_<category>..., toxic): one row per row of ``documents``, from the whole text.

    NULL and empty texts get the probabilities of the biases. Without usable labels all probabilities are
    one half of nothing learned and nothing is called toxic: ``toxic`` asks for more than ``threshold``.
    Labels that are NULL or belong to no document are not used. Other columns are ignored.
    """
    names = [*seeds, LAST]
    chain = documents.sparkSession.sparkContext.broadcast(fit_chain(documents, labels, seeds, settings, most_rows))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, " + ", ".join(f"p_{name} double" for name in names)
    scored = rows.mapInArrow(_predict(chain, settings.dimensions, names), schema)
    return scored.withColumn("toxic", F.col(f"p_{LAST}") > threshold)


def reject_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``documents``, all columns, that the chain does not call toxic; the text alone decides."""
    chain = fit_chain(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(chain)
    column = next(c for c in documents.columns if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scored(batches, column, shared.value, SETTINGS.dimensions):
            yield batch.filter(pa.array(found[:, -1] <= threshold))

    return documents.mapInArrow(run, documents.schema)
