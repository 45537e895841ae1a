"""Quality classifier: Naive Bayes support vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mergewell.llm.common import logistic, probability, text_bytes, training_rows

BITS = 15
ORDERS = 4
#: Most labelled documents of either class that the model is fitted on; they are read whole.
PER_CLASS = 2000
#: Slots beside the byte n-grams: what share of the words repeats the word before.
REPEATS = (0.0, 0.02, 0.1, 0.3, 0.6)


def ngram_slots(text: bytes) -> np.ndarray:
    """The sorted hash slots of the byte n-grams of orders 1 to 4 that occur in the whole text, and of its word repeats."""
    size = 1 << BITS
    seen = np.zeros(size + len(REPEATS), bool)
    codes = np.frombuffer(text, np.uint8).astype(np.uint32)
    rolled = codes + np.uint32(1)
    for order in range(1, ORDERS + 1):
        if len(codes) < order:
            break
        if order > 1:
            rolled = rolled[: len(codes) - order + 1] * np.uint32(0x9E3779B1) + codes[order - 1 :] + np.uint32(1)
        mixed = rolled * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
        seen[(mixed + np.uint32(order * 7919)) & np.uint32(size - 1)] = True
    words = text.split()
    if len(words) > 1:
        share = sum(a == b for a, b in zip(words, words[1:])) / (len(words) - 1)
        for k, least in enumerate(REPEATS):
            seen[size + k] = share > least
    return np.flatnonzero(seen)


def log_count_ratios(slots: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each n-gram among good documents over that among the others."""
    counts = np.ones((2, (1 << BITS) + len(REPEATS)))
    for s, y in zip(slots, good):
        counts[int(y), s] += 1
    shares = counts / counts.sum(1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, size: int, cost: float = 1.0, epochs: int = 20, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model; classes weigh equally. Each dual variable stays between 0 and its class's cost."""
    sign = np.where(good, 1.0, -1.0)
    upper = cost * np.where(good, len(good) / 2 / max(1, good.sum()), len(good) / 2 / max(1, (~good).sum()))
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(size), 0.0
    order = np.random.RandomState(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            gradient = sign[i] * (weights[at] @ value + bias) - 1
            now = min(max(alpha[i] - gradient / 2, 0.0), upper[i])  # unit rows and a bias of 1: squared length 2
            if now != alpha[i]:
                change = (now - alpha[i]) * sign[i]
                weights[at] += change * value
                bias += change
                moved = max(moved, abs(change))
                alpha[i] = now
        if moved < 1e-4:
            break
    return weights, bias


class QualityModel:
    """Scores texts by r-scaled n-gram indicators, a hinge-loss model and a logistic calibration; without both classes, by the share of good labels."""

    def __init__(self, samples: list[tuple[bytes, bool]], counts: dict[bool, int]):
        total = sum(counts.values())
        self.share = counts.get(True, 0) / total if total else 0.5
        good = np.array([y for _, y in samples], bool)
        self.ready = len(samples) >= 8 and 3 < good.sum() < len(good) - 3
        if not self.ready:
            return
        slots = [ngram_slots(t) for t, _ in samples]
        order = np.random.RandomState(11).permutation(len(samples))
        rest = np.isin(np.arange(len(samples)), order[: max(4, len(samples) // 4)])
        for y in (False, True):  # both parts need both classes
            mine = np.flatnonzero(good == y)
            rest[mine[0]], rest[mine[1]] = True, False
        fit = np.flatnonzero(~rest)
        self.ratios = log_count_ratios([slots[i] for i in fit], good[fit])
        weights, self.bias = dual_coordinate_descent([self._row(slots[i]) for i in fit], good[fit], len(self.ratios))
        self.weights = weights * self.ratios
        held = np.flatnonzero(rest)
        features = np.array([self._features(slots[i], samples[i][0]) for i in held])
        weight = np.where(good[held], counts[True] / good.sum(), counts[False] / (~good).sum())
        self.calibration = logistic(features, good[held].astype(float), weight)

    def _row(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = self.ratios[slots]
        return slots, value / (np.sqrt(value @ value) + 1e-9)

    def _features(self, slots: np.ndarray, text: bytes) -> tuple[float, float]:
        value = self.ratios[slots]
        return self.weights[slots].sum() / (np.sqrt(value @ value) + 1e-9) + self.bias, np.log1p(len(text))

    def score(self, texts: Iterator[bytes]) -> np.ndarray:
        features = [self._features(ngram_slots(t), t) if self.ready else (0.0, 0.0) for t in texts]
        if not self.ready or not features:
            return np.full(len(features), self.share)
        return probability(self.calibration, np.array(features))


def train_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> QualityModel:
    """Fits on at most per_class labelled documents of either class, none of them held out."""
    return QualityModel(*training_rows(documents, labels, label, per_class))


def score_texts(documents: DataFrame, model, text: str = "text", into: str = "score") -> DataFrame:
    """All rows and columns of documents, with the model's score of the whole text; null and empty texts are scored as empty.

    A column of the name of into is replaced. The model has a fixed size and travels with the tasks; no shuffle.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.functions import arrow_udf

    shared = documents.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(shared.value.score(text_bytes(part)), pa.float64())

    return documents.withColumn(into, scored(F.col(text)))
