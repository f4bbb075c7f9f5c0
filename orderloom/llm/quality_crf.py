"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its bytes and words (how much of it is upper case, symbols, separators, digits; how
often its words or the line itself repeat; how long it and its words are), each put into one of a few bins.
The field scores a line by its own bins and by those of the lines before and after it, and pairs of labels by
a 2 x 2 table.  Forward-backward gives each line's probability of being good; the mean over lines,
weighted by their length, is the document's quality, calibrated on the labelled documents.

Labels exist for documents only.  Training starts from lines that have their document's label, fits a line-wise
logistic regression, lets it clear those lines of bad documents that look good, and then fits the field.
It reads a bounded sample of at most ``most_labelled`` documents, chosen by a hash of the id, in one task.

Defined cases: null and empty texts are one empty line, scored like any other; lines of any length and texts of any number of
lines are read whole; repeated rows score alike; labels other than 0 and 1 and labels without a document are not used;
without labels of both classes every score is the share of label 1 (0.5 if there are none); an empty table has no output.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.toxicity import labelled_sample, platt

MOST_LABELLED = 6000
BATCH_BYTES = 4 << 20
EDGES = np.array([0.005, 0.03, 0.1, 0.25, 0.5])   # bins of shares
SIZES = np.array([20, 60, 200, 800, 3000])        # bins of line lengths in bytes
WORDS = np.array([3, 4, 5, 6, 8])                 # bins of mean word lengths
FEATURES, BINS = 11, 6


def _classes() -> np.ndarray:
    """Kind of a byte: 0 letter, 1 upper case, 2 digit, 3 space, 4 sentence mark, 5 exclamation, 6 separator, 7 other symbol."""
    kind = np.full(256, 7, np.int64)
    kind[128:] = 0
    for chars, k in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t\r\v\f\n", 3),
                     (".,;:'\"-()?", 4), ("!", 5), ("|<>{}[]=/\\", 6)):
        kind[np.frombuffer(chars.encode(), np.uint8)] = k
    return kind


KIND = _classes()
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _shares(values: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, values, "right")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in runs of whole lines of at most ``BATCH_BYTES``; a longer line is a piece of its own."""
    at = 0
    while len(text) - at > BATCH_BYTES:
        cut = text.rfind(b"\n", at, at + BATCH_BYTES)
        cut = cut if cut >= 0 else text.find(b"\n", at + BATCH_BYTES)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (line, feature), first line of each text, and bytes per line.

    All but the repetition of lines is seen within a line, so the working arrays are those of one piece.
    """
    bins, again, whole, size = (np.concatenate(c) for c in zip(*map(_line_parts, _pieces(b"\n".join(texts)))))
    # A text starts after as many breaks as the texts before it have lines.
    first = np.concatenate(([0], np.cumsum([t.count(b"\n") + 1 for t in texts])[:-1]))
    n = len(size)
    # Lines that occur more than once in their text.
    text = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    at = np.lexsort((whole, text))
    same = (whole[at][1:] == whole[at][:-1]) & (text[at][1:] == text[at][:-1]) & (size[at][1:] > 0)
    twice = np.zeros(n, bool)
    twice[at[1:]] |= same
    twice[at[:-1]] |= same
    return np.column_stack([bins, _shares(np.where(twice, 1.0, again))]), first, size


def _line_parts(piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines of a piece: bins, share of repeated words, a hash of the words in order, and bytes."""
    data = np.frombuffer(piece + b"\n", np.uint8)
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate(([0], breaks[:-1] + 1))
    size = breaks - begin
    n = len(begin)
    line = np.repeat(np.arange(n), size + 1)
    kind = KIND[data]
    counts = np.bincount(line * 8 + kind, minlength=8 * n).reshape(n, 8).astype(float)
    counts[:, 3] -= 1                                   # the break itself
    total = np.maximum(size, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
    run = np.zeros(len(data), bool)                     # a symbol that repeats the byte before it
    run[1:] = (data[1:] == data[:-1]) & (kind[1:] >= 4)
    runs = np.bincount(line[run], minlength=n)
    # Words: runs of bytes that are not white space, told apart by a hash.
    inside = np.concatenate(([0], (kind != 3).view(np.int8), [0]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    hashes = np.zeros(0, np.uint64)
    if len(start):
        power = np.cumprod(np.full(len(data) + 1, FACTOR, np.uint64))
        inverse = np.cumprod(np.full(len(data) + 1, np.uint64(pow(int(FACTOR), -1, 1 << 64)), np.uint64))
        sums = np.concatenate(([np.uint64(0)], np.cumsum((data | np.uint8(32)).astype(np.uint64) * power[:-1])))
        hashes = (sums[stop] - sums[start]) * inverse[start]
    owner = line[start]
    words = np.bincount(owner, minlength=n)
    many = np.maximum(words, 1)
    again = np.zeros(len(start), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    repeated = np.zeros(len(start), bool)
    repeated[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    sum_words = np.concatenate(([np.uint64(0)], np.cumsum(hashes * (np.uint64(1) + np.uint64(2) * np.arange(len(hashes), dtype=np.uint64)))))
    sum_hashes = np.concatenate(([np.uint64(0)], np.cumsum(hashes)))
    last = np.cumsum(words)
    whole = sum_words[last] - sum_words[last - words] - np.uint64(2) * (last - words).astype(np.uint64) * (
        sum_hashes[last] - sum_hashes[last - words])
    bins = np.stack([
        np.searchsorted(SIZES, size, "right"), np.searchsorted(WORDS, size / many, "right"),
        _shares(counts[:, 1] / letters), _shares(counts[:, 2] / total), _shares(counts[:, 4] / total),
        _shares(counts[:, 5] / many), _shares(counts[:, 6] / many), _shares(counts[:, 7] / many), _shares(runs / many),
        _shares(np.bincount(owner[again], minlength=n) / many)], axis=1)
    return bins, np.bincount(owner[order][repeated], minlength=n) / many / 2, whole, size


def _batches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features of texts in batches of bounded size."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= BATCH_BYTES):
            size += len(texts[stop])
            stop += 1
        yield line_features(texts[at:stop])
        at = stop


def batched_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as ``line_features``, with bounded memory besides the result."""
    bins, first, size = zip(*_batches(texts))
    lines = np.cumsum([0, *map(len, bins)])
    return np.concatenate(bins), np.concatenate([f + n for f, n in zip(first, lines)]), np.concatenate(size)


@dataclass
class LineField:
    """Weights of own, previous and next line's bins, of label pairs (bad, good), and the calibration."""

    own: np.ndarray
    previous: np.ndarray
    following: np.ndarray
    bias: float
    pair: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    @classmethod
    def zero(cls) -> "LineField":
        empty = np.zeros((FEATURES, BINS))
        return cls(empty, empty.copy(), empty.copy(), 0.0, np.zeros((2, 2)))

    def margins(self, bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Score of good over bad per line, without its label pairs."""
        f = np.arange(FEATURES)
        own = self.own[f, bins].sum(axis=1) + self.bias
        before, after = self.previous[f, bins].sum(axis=1), self.following[f, bins].sum(axis=1)
        own[1:] += np.where(starts[1:], 0.0, before[:-1])
        own[:-1] += np.where(starts[1:], 0.0, after[1:])
        return own


def _products(m: np.ndarray, longest: int) -> np.ndarray:
    """Running products m[0] m[1] ... m[t] of 2 x 2 matrices (scaled), over ``longest`` matrices back at least."""
    m, step = m.copy(), 1
    while step < longest and step < len(m):
        a, b = m[:-step], m[step:]
        c = np.empty_like(b)
        for i in range(2):
            for j in range(2):
                c[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
        m[step:] = c / c.sum(axis=(1, 2), keepdims=True)
        step *= 2
    return m


def forward_backward(margin: np.ndarray, starts: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good per line, and summed probabilities of label pairs.

    All chains run at once: at a chain's first line the matrix has equal rows, which forgets what came before.
    """
    n = len(margin)
    bounded = np.clip(margin, -30, 30)
    node = np.stack([np.exp(-bounded / 2), np.exp(bounded / 2)], axis=1)
    step = np.exp(pair)[None] * node[:, None, :]
    begin = np.flatnonzero(starts)
    longest = int(np.diff(np.append(begin, n)).max())
    forward = step.copy()
    forward[begin] = node[begin][:, None, :]
    forward /= forward.sum(axis=(1, 2), keepdims=True)
    alpha = _products(forward, longest)[:, 0, :]
    # Backward: the same from the end, on transposed matrices.
    back = np.ones((n, 2, 2))
    back[:-1][~starts[1:]] = step[1:][~starts[1:]]
    back /= back.sum(axis=(1, 2), keepdims=True)
    beta = _products(np.ascontiguousarray(back.transpose(0, 2, 1)[::-1]), longest)[::-1].sum(axis=1)
    both = alpha * beta
    good = both[:, 1] / both.sum(axis=1)
    inner = ~starts[1:]
    joint = alpha[:-1][inner][:, :, None] * step[1:][inner] * beta[1:][inner][:, None, :]
    pairs = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if inner.any() else np.zeros((2, 2))
    return good, pairs


def _marks(first: np.ndarray, n: int) -> np.ndarray:
    starts = np.zeros(n, bool)
    starts[first] = True
    return starts


def fit(bins: np.ndarray, first: np.ndarray, size: np.ndarray, label: np.ndarray, rounds: int = 120, rate: float = 0.08,
        strength: float = 1e-3) -> LineField:
    """Train on the lines of labelled documents."""
    n = len(bins)
    starts, lines = _marks(first, n), np.diff(np.append(first, n))
    doc = np.repeat(np.arange(len(first)), lines)
    line_label = label[doc].astype(float)
    # Both classes of documents weigh the same, and a document's lines share its weight.
    weigh = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    weight = (weigh / lines)[doc]
    flat = np.arange(FEATURES) * BINS + bins
    nxt, prv = ~starts[1:], ~starts[1:]

    def train(field: LineField, target: np.ndarray, chain: bool) -> LineField:
        size_ = FEATURES * BINS
        theta = np.concatenate([field.own.ravel(), field.previous.ravel(), field.following.ravel(), [field.bias], field.pair.ravel()])
        moments = np.zeros((2, len(theta)))
        seen = np.zeros((2, 2))
        inner = np.flatnonzero(~starts[1:])
        np.add.at(seen, (target[inner].astype(int), target[inner + 1].astype(int)), 1.0)
        for step in range(1, rounds + 1):
            field = LineField(*(theta[i * size_:(i + 1) * size_].reshape(FEATURES, BINS) for i in range(3)), theta[3 * size_],
                              theta[3 * size_ + 1:].reshape(2, 2))
            margin = field.margins(bins, starts)
            if chain:
                good, pairs = forward_backward(margin, starts, field.pair)
                pair_gradient = (pairs - seen) / n
            else:
                good, pair_gradient = 1 / (1 + np.exp(-np.clip(margin, -30, 30))), np.zeros((2, 2))
            error = (good - target) * weight
            parts = [np.bincount(flat.ravel(), np.repeat(error, FEATURES), size_)]
            for source, toward in ((slice(None, -1), slice(1, None)), (slice(1, None), slice(None, -1))):
                e = np.where(nxt, error[toward], 0.0)
                parts.append(np.bincount(flat[source].ravel(), np.repeat(e, FEATURES), size_))
            gradient = np.concatenate([*parts, [error.sum()], pair_gradient.ravel()]) + strength / 100 * theta
            moments[0] = 0.9 * moments[0] + 0.1 * gradient
            moments[1] = 0.99 * moments[1] + 0.01 * gradient ** 2
            theta = theta - rate * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-9)
        return LineField(*(theta[i * size_:(i + 1) * size_].reshape(FEATURES, BINS) for i in range(3)), float(theta[3 * size_]),
                         theta[3 * size_ + 1:].reshape(2, 2))

    field = train(LineField.zero(), line_label, chain=False)
    margin = field.margins(bins, starts)
    cleared = (line_label == 0) & (margin > 0)
    worst = np.minimum.reduceat(margin, first)
    cleared &= margin > worst[doc]                     # a bad document keeps its worst line
    field = train(field, np.where(cleared, 1.0, line_label), chain=True)
    share = document_shares(field, bins, first, size)
    field.scale, field.shift = platt(share, label.astype(float))
    return field


def document_shares(field: LineField, bins: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Log-odds of the length-weighted mean probability of good lines, per document."""
    good, _ = forward_backward(field.margins(bins, _marks(first, len(bins))), _marks(first, len(bins)), field.pair)
    weight = size + 1.0
    mean = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def _encoded(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in texts]


def train(docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "quality",
          most_labelled: int = MOST_LABELLED) -> LineField | float:
    """A field, or the constant score if the usable labels are of one class."""
    sample = labelled_sample(docs, labels, usable, key, text, label, most_labelled).repartition(1)

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        rows = [r for b in batches for r in zip(_encoded(b.column(0).to_pylist()), b.column(1).to_pylist())]
        rows.sort(key=lambda r: (r[1], r[0]))           # sums should not depend on the order of arrival
        marks = np.array([r[1] for r in rows])
        if not len(marks) or marks.min() == marks.max():
            model = float(marks.mean()) if len(marks) else 0.5
        else:
            model = fit(*batched_features([r[0] for r in rows]), marks)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], names=["model"])

    import pickle
    got = sample.mapInArrow(fit_rows, "model binary").first()
    return pickle.loads(got["model"]) if got else 0.5


def score(docs: DataFrame, model: LineField | float, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as column ``name``."""
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        field = shared.value
        for texts in batches:
            out = []
            for features in _batches(_encoded(texts)):
                z = document_shares(field, *features) * field.scale + field.shift
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(name, of(F.col(text)))


def line_labels(text: str | None, field: LineField) -> list[tuple[str, float]]:
    """Each line of a text with its probability of being good."""
    bins, first, _ = line_features(_encoded([text]))
    starts = _marks(first, len(bins))
    good, _ = forward_backward(field.margins(bins, starts), starts, field.pair)
    return list(zip((text or "").split("\n"), good.tolist()))
