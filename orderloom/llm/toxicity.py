"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams of its lower-cased characters, each present or absent.
From labelled texts come the log-count ratios r; a logistic regression is then trained on the
features times r, each text scaled to unit length, so that long texts weigh no more than short ones.
Scores are calibrated on texts that a first fit has not seen.

Training reads a bounded sample: at most ``most_labelled`` labelled texts, chosen by a hash of the id.
Its sparse features meet in one task, whose memory this bound and the hash space limit.  Scoring reads
whole texts in blocks and needs nothing but the weights (two floats per hash slot, broadcast).

Defined cases: null and empty texts have no features and score the bias alone; repeated rows score alike;
labels other than 0 and 1, null labels and labels without a document are not used; a document with several labels
counts once per label; without labels of both classes every score is the share of label 1 (0.5 if there
are none); an empty table has no output.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (4, 5)
SLOT_BITS = 18
MOST_LABELLED = 6000
BLOCK_FEATURES = 1 << 20
BLOCK_CHARS = 1 << 20


def ngram_slots(text: str | None, orders: tuple[int, ...] = ORDERS, slot_bits: int = SLOT_BITS,
                seen: np.ndarray | None = None) -> np.ndarray:
    """Sorted hash slots of the distinct n-grams of a whole text, computed in blocks that overlap."""
    seen = np.zeros(1 << slot_bits, bool) if seen is None else seen
    lowered = f" {text or ''} ".lower() if text else ""
    most = max(orders) - 1
    touched = []
    for start in range(0, len(lowered), BLOCK_CHARS):
        block = lowered[start:start + BLOCK_CHARS + most]
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32) * np.uint32(0x85EBCA6B)
        rolled = np.full(len(codes), 0x1B873593, np.uint32)
        for n in range(1, max(orders) + 1):
            if len(codes) < n:
                break
            rolled = (rolled[:len(codes) - n + 1] + codes[n - 1:]) * np.uint32(0x9E3779B1)
            rolled ^= rolled >> np.uint32(15)
            if n in orders:
                slots = (rolled * np.uint32(0xC2B2AE35 + 2 * n)) >> np.uint32(32 - slot_bits)
                seen[slots] = True
                touched.append(slots)
    found = np.flatnonzero(seen)
    for slots in touched:
        seen[slots] = False
    return found


@dataclass
class NaiveBayesLinear:
    """Weight per hash slot (ratio times coefficient), the ratios for the length, and the bias."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    orders: tuple[int, ...] = ORDERS

    def score(self, text: str | None, seen: np.ndarray) -> float:
        slots = ngram_slots(text, self.orders, len(self.ratio).bit_length() - 1, seen)
        z = self.bias
        if len(slots):
            length = np.sqrt(np.square(self.ratio[slots], dtype=np.float64).sum())
            z += float(self.weight[slots].sum(dtype=np.float64)) / max(length, 1e-9)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def fit(features: list[np.ndarray], labels: np.ndarray, slots: int = 1 << SLOT_BITS, smooth: float = 1.0,
        least_texts: int = 5, strength: float = 1e-5, rounds: int = 60, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray, float]:
    """Ratios, weights and bias from the slot lists of sampled texts."""
    labels, n = labels.astype(np.float64), len(labels)
    share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6)) if n else 0.5
    if not n or labels.min() == labels.max():
        return np.zeros(slots), np.zeros(slots), float(np.log(share / (1 - share)))
    p, q = np.zeros(slots), np.zeros(slots)
    for f, toxic in zip(features, labels):
        (p if toxic else q)[f] += 1
    ratio = np.log((p + smooth) / (labels.sum() + 2 * smooth)) - np.log((q + smooth) / ((1 - labels).sum() + 2 * smooth))
    ratio[p + q < least_texts] = 0     # n-grams of a few texts say nothing
    # Sparse rows of unit length; a text without features keeps one of value 0.
    columns, values = [], []
    for f in features:
        f = f[ratio[f] != 0] if len(f) else f
        v = ratio[f]
        columns.append(f.astype(np.int32) if len(f) else np.zeros(1, np.int32))
        values.append((v / np.sqrt(v @ v)).astype(np.float32) if len(f) else np.zeros(1, np.float32))
    borders = np.searchsorted(np.cumsum([len(c) for c in columns]), np.arange(0, sum(map(len, columns)), BLOCK_FEATURES))
    blocks = []
    for i, j in zip(borders, [*borders[1:], n]):
        if j > i:
            sizes = np.array([len(c) for c in columns[i:j]])
            blocks.append((np.concatenate(columns[i:j]), np.concatenate(values[i:j]), sizes, labels[i:j]))
    del columns, values
    # Logistic regression by Adam over the whole sample.
    w, b = np.zeros(slots), float(np.log(share / (1 - share)))
    first, second = np.zeros(slots + 1), np.zeros(slots + 1)
    for step in range(1, rounds + 1):
        gradient = np.append(strength * w, 0.0)
        for column, value, sizes, y in blocks:
            z = np.add.reduceat(value * w[column], np.cumsum(sizes) - sizes) + b
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
            gradient[:-1] += np.bincount(column, value * np.repeat(error, sizes), slots)
            gradient[-1] += error.sum()
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient * gradient
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return ratio, w * ratio, float(b)


def margins(features: list[np.ndarray], ratio: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    """Linear score of each slot list."""
    return np.array([bias + (weight[f].sum() / max(np.sqrt(np.square(ratio[f]).sum()), 1e-9) if len(f) else 0.0)
                     for f in features])


def platt(z: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Scale and shift of linear scores that fit the labels best, with smoothed targets."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x, theta = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])), -1, 1)
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit_calibrated(features: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on all texts; scale and shift come from a fit on three quarters, judged on the fourth."""
    scale, shift = 1.0, 0.0
    apart = np.arange(len(labels)) % 4 == 3
    if apart.any():
        kept = [f for f, out in zip(features, apart) if not out]
        z = margins([f for f, out in zip(features, apart) if out], *fit(kept, labels[~apart]))
        scale, shift = platt(z, labels[apart].astype(np.float64))
    ratio, weight, bias = fit(features, labels)
    return ratio, weight * scale, bias * scale + shift


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, key: str, text: str, label: str,
                    most: int) -> DataFrame:
    """Sampled ``text, label`` rows.  Ids are chosen first, by hash, and bounded by ``most``, so their join may be broadcast."""
    known = labels.where(F.col(label).isin(0, 1) & usable).select(F.col(key).alias("_id"), F.col(label).alias("label"))
    ids = F.broadcast(known.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id", "label").limit(most))
    return docs.join(ids, F.col(key) == F.col("_id")).select(F.col(text).alias("text"), "label")


def train(docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
          most_labelled: int = MOST_LABELLED) -> NaiveBayesLinear:
    """Fit on the labelled documents for which ``usable`` (a condition on the label rows) holds."""
    sample = labelled_sample(docs, labels, usable, key, text, label, most_labelled)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SLOT_BITS, bool)
        for batch in batches:
            slots = [ngram_slots(t.as_py(), seen=seen).astype(np.int32) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.list_(pa.int32())), batch.column(1).cast(pa.int32())],
                                             names=["slots", "label"])

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        slots, marks = [], []
        for batch in batches:
            slots += [np.asarray(s.values) for s in batch.column(0)]
            marks.append(batch.column(1).to_numpy(zero_copy_only=False))
        # The order of rows differs between runs; sums should not.
        marks = np.concatenate(marks) if marks else np.zeros(0)
        order = sorted(range(len(slots)), key=lambda i: (int(marks[i]), len(slots[i]), slots[i].tobytes()))
        ratio, weight, bias = fit_calibrated([slots[i] for i in order], marks[order])
        yield pa.RecordBatch.from_arrays(
            [pa.array([ratio.astype(np.float32).tobytes()]), pa.array([weight.astype(np.float32).tobytes()]), pa.array([bias])],
            names=["ratio", "weight", "bias"])

    rows = sample.mapInArrow(features, "slots array<int>, label int").repartition(1)
    got = rows.mapInArrow(fit_rows, "ratio binary, weight binary, bias double").first()
    return NaiveBayesLinear(np.frombuffer(got["ratio"], np.float32), np.frombuffer(got["weight"], np.float32), got["bias"])


def score(docs: DataFrame, model: NaiveBayesLinear, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        used, seen = shared.value, np.zeros(len(shared.value.ratio), bool)
        for texts in batches:
            yield pd.Series([used.score(t, seen) for t in texts], dtype="float64")

    return docs.withColumn(name, of(F.col(text)))


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves remainder ``fold``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == fold
