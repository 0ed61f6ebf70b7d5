"""Hashed sparse logistic regression, trained by follow-the-regularised-leader updates in a fixed number of parts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Settings:
    """``alpha``, ``beta``: step size per coordinate; ``l1``, ``l2``: penalties; ``parts``: models that are averaged."""

    dimensions: int = 1 << 18
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.05
    passes: int = 5
    parts: int = 4


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the weights that are not zero. Index ``dimensions`` is the bias, without penalty.

    A row is (distinct indices, values, label). Indices beyond the bias are dense extra inputs.
    """
    extra = max((int(i.max()) for i, _, _ in rows if len(i)), default=0)
    width = max(settings.dimensions, extra) + 1
    z, n = np.zeros(width), np.zeros(width)
    bias = settings.dimensions
    order = np.random.default_rng(seed)
    for _ in range(settings.passes):
        for k in order.permutation(len(rows)):
            index, value, label = rows[k]
            index, value = np.append(index, bias), np.append(value, 1.0)
            zi, ni = z[index], n[index]
            l1 = np.where(index == bias, 0.0, settings.l1)
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((settings.beta + root) / settings.alpha + settings.l2), 0.0)
            gradient = (sigmoid(float(w @ value)) - label) * value
            grown = ni + gradient * gradient
            z[index] = zi + gradient - (np.sqrt(grown) - root) / settings.alpha * w
            n[index] = grown
    l1 = np.full(width, settings.l1)
    l1[bias] = 0.0
    live = np.flatnonzero(np.abs(z) > l1)
    w = (np.sign(z[live]) * l1[live] - z[live]) / ((settings.beta + np.sqrt(n[live])) / settings.alpha + settings.l2)
    return live, w


def train(
    rows: DataFrame,
    features: Callable[[dict], tuple[np.ndarray, np.ndarray]],
    inputs: list[str],
    settings: Settings,
    models: Iterable[str],
    extra: int = 0,
) -> dict[str, np.ndarray]:
    """{model: dense weights}: per model the mean of the parts' weights.

    ``rows``: (model, part, label, *inputs), already bounded by the caller; one task trains one part of
    one model. What comes back is bounded by models * (dimensions + extra).
    """

    def fit(key, frame: pd.DataFrame) -> pd.DataFrame:
        examples = [(*features(row), int(row["label"])) for row in frame.sort_values("doc_id").to_dict("records")]
        index, weight = ftrl(examples, settings, int(key[1]))
        return pd.DataFrame({"model": key[0], "index": index.astype(np.int64), "weight": weight})

    used = rows.select("model", "part", "doc_id", "label", *inputs)
    fitted = used.groupBy("model", "part").applyInPandas(fit, "model string, index long, weight double")
    parts = {r["model"]: r["parts"] for r in used.groupBy("model").agg(F.count_distinct("part").alias("parts")).collect()}
    mean = fitted.groupBy("model", "index").agg(F.sum("weight").alias("weight")).toArrow()
    names, index, weight = (mean.column(c).to_numpy() for c in ("model", "index", "weight"))
    dense = {}
    for model in models:
        dense[model] = np.zeros(settings.dimensions + 1 + extra)
        mine = names == model
        dense[model][index[mine]] = weight[mine] / parts.get(model, 1)
    return dense


def bounded(labelled: DataFrame, most_rows: int, salt: int = 0) -> DataFrame:
    """About ``most_rows`` rows by hash of doc_id, all if there are fewer. The same rows at every run."""
    total = labelled.count()
    if total <= most_rows:
        return labelled
    chance = int(most_rows / total * 1_000_000)
    return labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < chance)
