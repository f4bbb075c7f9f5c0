"""Benchmark decontamination by greedy string tiling.

Texts become lists of lower-cased words (letters and digits).  Windows of ``seed`` words that a document
shares with a benchmark item are seeds.  Greedy string tiling then covers the item with the longest
common runs first, none overlapping in item or document, found by a running Karp-Rabin hash; the
share of the item's words that tiles cover decides.  As tiles may come in any order, a
benchmark passage whose sentences were shuffled is caught as well.

Candidates come from one scan of the documents and a join.  A broadcast bit filter of ``filter_bits`` bits, whatever the size of the benchmark,
tells which windows of a document may be seeds; the runs of words in such windows are all that leaves the scan, once per
different text.  Their windows meet the benchmark's seeds by hash.  An item is compared only with texts whose shared seeds could
cover enough of it, and only with the runs that hold one of them: every tile lies inside such a run, so nothing is lost.  A
larger benchmark fills the filter and lets more runs through to the join; results stay the same.  A document larger than
memory-friendly blocks is tokenized block by block; only its runs are kept.

Defined cases: null and empty texts share nothing; items of fewer than ``seed`` words match if all of their words
occur as one run; items without words match nothing; repeated rows of documents give repeated results, repeated
benchmark rows of one id count once each; ties between tiles go to the earlier place in the item, then in the
document; empty tables have no output; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Stored, free_name, text_hash

SEED_WORDS = 5
COVERAGE = 0.5
FILTER_BITS = 1 << 26      # a power of two
BLOCK_CHARS = 1 << 18
PLANE = 1 << 16
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its lower case and whether it is part of a word; all beyond the basic plane are."""
    lower, word = np.arange(PLANE + 1, dtype=np.uint64), np.ones(PLANE + 1, bool)
    for code in range(PLANE):
        small = chr(code).lower()
        word[code] = chr(code).isalnum()
        lower[code] = ord(small) if len(small) == 1 else code
    return lower, word


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the word factor and of its inverse, modulo 2^64."""
    inverse = np.uint64(pow(int(FACTOR), -1, 1 << 64))
    up, down = (np.cumprod(np.full(2 * BLOCK_CHARS, f, np.uint64)) for f in (FACTOR, inverse))
    return up, down


def words_of(text: str | None) -> Iterator[np.ndarray]:
    """64-bit hashes of the words of a text, in blocks that end between words.

    A word's hash is a difference of running sums, moved to a common origin; a word longer than a block is
    cut there, the same way in every text only if it starts the block, which no real word needs.
    """
    text, start = text or "", 0
    (lower, word), (up, down) = _characters(), _powers()
    while start < len(text):
        end = min(start + BLOCK_CHARS, len(text))
        while end < min(len(text), start + 2 * BLOCK_CHARS) and text[end].isalnum():
            end += 1
        codes = np.frombuffer(text[start:end].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.minimum(codes, PLANE)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = word[codes]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((lower[codes] + np.uint64(1)) * up[:len(codes)], out=sums[1:])
        begins, ends = edges[::2], edges[1::2]
        yield (sums[ends] - sums[begins]) * down[begins] * (ends - begins).astype(np.uint64)
        start = end


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` word numbers."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * FACTOR + ids[k:k + n].astype(np.uint64)
    return total


def _whole(text: str | None) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *words_of(text)])


def _shift(bits: int) -> int:
    """A hash shifted so far right is a place in a filter of ``bits`` bits."""
    return 65 - bits.bit_length()


class Filter:
    """Which window hashes may be seeds, and the widths of seeds; equal hashes always pass."""

    def __init__(self, bits: np.ndarray, widths: list[int]):
        self.bits, self.widths = bits, widths
        self.shift = np.uint64(_shift(32 * len(bits)))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> self.shift
        return (self.bits[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32) & np.uint32(1)) != 0

    def runs(self, text: str | None) -> Iterator[tuple[int, np.ndarray]]:
        """``width, words`` of the longest stretches of words that lie in windows that may be seeds, in order per width."""
        for width in self.widths:
            held: list[np.ndarray] = []
            for words, inside in self._marked(text, width):
                edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
                if held and len(inside) and not inside[0]:
                    yield width, np.concatenate(held)
                    held = []
                for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    held.append(words[start:stop])
                    if stop < len(inside):
                        yield width, np.concatenate(held)
                        held = []
            if held:
                yield width, np.concatenate(held)

    def _marked(self, text: str | None, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Parts of the text, and which of their words lie in a window of ``width`` words that may be a seed."""
        tail, marked = np.zeros(0, np.uint64), 0          # words whose windows are not complete; how many of them lie in one
        for block in words_of(text):
            words = np.concatenate((tail, block))
            starts = np.flatnonzero(self.may_hold(window_hashes(words, width)))
            done = max(0, len(words) - width + 1)
            steps = np.zeros(len(words) + 1, np.int64)
            steps[starts] += 1
            steps[starts + width] -= 1
            inside = np.cumsum(steps[:-1]) > 0
            inside[:marked] = True
            yield words[:done], inside[:done]
            marked = max(0, marked - done, int(starts[-1]) + width - done if len(starts) else 0)
            tail = words[done:]
        yield tail[:marked], np.ones(marked, bool)


class _Windows:
    """Unmarked windows of ``width`` words of a pattern, in order, with the places of equal hash in a text.

    Places are one list per hash, not one per pair, so repeated words cost no more than others.
    """

    def __init__(self, pattern: np.ndarray, text: np.ndarray, free_p: np.ndarray, free_t: np.ndarray, width: int):
        self.pattern, self.text, self.free_p, self.free_t, self.width = pattern, text, free_p, free_t, width
        whole_p, whole_t = (np.flatnonzero(np.convolve(free, np.ones(width, int), "valid") == width) if len(free) >= width
                            else np.zeros(0, int) for free in (free_p, free_t))
        self.places, self.hashes = [], []
        if not len(whole_p) or not len(whole_t):
            return
        hp, ht = window_hashes(pattern, width)[whole_p], window_hashes(text, width)[whole_t]
        order = np.argsort(ht, kind="stable")
        self._hashes, self._places = ht[order], whole_t[order]
        low, high = np.searchsorted(self._hashes, hp, "left"), np.searchsorted(self._hashes, hp, "right")
        met = low < high
        self.places, self.hashes = whole_p[met].tolist(), list(zip(low[met].tolist(), high[met].tolist()))

    def _equal(self, p: int, t: int) -> bool:
        return bool((self.pattern[p:p + self.width] == self.text[t:t + self.width]).all())

    def any(self) -> bool:
        return any(self._equal(p, int(self._places[i])) for p, (low, high) in zip(self.places, self.hashes) for i in range(low, high))

    def mark(self) -> list[tuple[int, int, int]]:
        """Tiles of this width, each at the first place of the pattern and then of the text that is free, and mark them."""
        tiles, following = [], {}
        for p, (low, high) in zip(self.places, self.hashes):
            if not self.free_p[p:p + self.width].all():
                continue
            i = following.get(low, low)
            # Marks only grow, so places passed over once are passed for all windows of the hash.
            while i < high and not self.free_t[self._places[i]:self._places[i] + self.width].all():
                i += 1
            following[low] = i
            for j in range(i, high):
                t = int(self._places[j])
                if self.free_t[t:t + self.width].all() and self._equal(p, t):
                    self.free_p[p:p + self.width] = self.free_t[t:t + self.width] = 0
                    tiles.append((p, t, self.width))
                    break
        return tiles


def tile(pattern: np.ndarray, runs: list[np.ndarray], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in pattern, place in the joined runs, length), longest first, of ``least`` words or more."""
    # Runs are joined by numbers that occur nowhere else, so no tile crosses a border.
    parts, barrier = [], -1
    for run in runs:
        parts += [run, np.array([barrier])]
        barrier -= 1
    text = np.concatenate(parts)
    free_p, free_t = np.ones(len(pattern), int), np.ones(len(text), int)
    tiles = []
    while True:
        # Longest common unmarked run: binary search over the length, as any shorter length occurs as well.
        low, high, best = least, min(len(pattern), max(map(len, runs))), None
        while low <= high:
            middle = (low + high) // 2
            windows = _Windows(pattern, text, free_p, free_t, middle)
            if windows.any():
                best, low = windows, middle + 1
            else:
                high = middle - 1
        if best is None:
            return tiles
        tiles += best.mark()


def covered(pattern: np.ndarray, runs: list[np.ndarray], seed: int) -> tuple[float, int, int]:
    """``coverage, tiles, longest`` of an item by the runs of a text, both as word hashes."""
    vocabulary = np.unique(pattern)

    def numbers(words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
        return np.where(vocabulary[at] == words, at + 1, 0)

    tiles = tile(numbers(pattern), [numbers(r) for r in runs], min(seed, len(pattern)))
    return sum(t[2] for t in tiles) / len(pattern), len(tiles), max((t[2] for t in tiles), default=0)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as Arrow lists of signed numbers."""
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _items(benchmark: DataFrame, text: str, seed: int) -> DataFrame:
    """``item, width, words, seeds`` per different text of the benchmark that has words."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_whole(t.as_py()) for t in batch.column(1)]
            keep = [i for i, w in enumerate(words) if len(w)]
            words = [words[i] for i in keep]
            widths = [min(seed, len(w)) for w in words]
            seeds = [window_hashes(w, n) for w, n in zip(words, widths)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(widths, pa.int32()),
                                              _lists(words), _lists(seeds)], names=["item", "width", "words", "seeds"])

    texts = benchmark.select(text_hash(F.col(text)).alias("item"), F.col(text).alias("t")).where("t is not null").dropDuplicates(["item"])
    return texts.mapInArrow(read, "item string, width int, words array<bigint>, seeds array<bigint>")


def _filter(seeds: DataFrame, size: int) -> Filter:
    """Bits of all seeds: at most ``size`` / 32 rows reach the driver, and one per width."""
    place = f"shiftrightunsigned(seed, {_shift(size)})"
    rows = (seeds.groupBy(F.expr(f"shiftright({place}, 5)").alias("at"))
            .agg(F.expr(f"bit_or(shiftleft(1L, cast({place} & 31 as int)))").alias("bits"))).toArrow()
    bits = np.zeros(size // 32, np.uint32)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return Filter(bits, sorted(r[0] for r in seeds.select("width").distinct().collect()))


def _found(docs: DataFrame, benchmark: DataFrame, key: Column, text: str, item_text: str, seed: int,
           coverage: float, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """``key, text_id`` of the rows with runs, and ``text_id, item, coverage, tiles, longest`` per text and item covered enough."""
    items = Stored(_items(benchmark, item_text, seed), "tiling-items").df
    seeds = Stored(items.select("item", "width", F.size("words").alias("n"), F.explode("seeds").alias("seed"))
                   .groupBy("item", "width", "n", "seed").agg(F.count(F.lit(1)).alias("places")), "tiling-seeds").df
    shared = docs.sparkSession.sparkContext.broadcast(_filter(seeds, filter_bits))
    rows = docs.select(key.alias("key"), text_hash(F.col(text)).alias("text_id"), F.col(text).alias("t"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(2)):
                found = list(shared.value.runs(t.as_py()))
                if found:
                    n, one = len(found), pa.array(np.full(len(found), i))
                    hashes = [np.unique(window_hashes(words, width)) for width, words in found]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(one), batch.column(1).take(one), pa.array([w for w, _ in found], pa.int32()),
                         pa.array(np.arange(n, dtype=np.int32)), _lists([w for _, w in found]), _lists(hashes)],
                        names=["key", "text_id", "width", "run", "words", "seeds"])

    kind = dict(rows.dtypes)["key"]
    found = Stored(rows.mapInArrow(scan, f"key {kind}, text_id string, width int, run int, words array<bigint>, seeds array<bigint>"),
                   "tiling-runs").df
    # Copies of a text have the same runs: one of each goes on.
    runs = Stored(found.drop("key").dropDuplicates(["text_id", "run"]), "tiling-texts").df
    pairs = (runs.select("text_id", "width", "run", F.explode("seeds").alias("seed")).join(seeds, ["width", "seed"])
             .groupBy("text_id", "item", "width", "n").agg(F.sum("places").alias("places"), F.collect_set("run").alias("runs"))
             .where(F.col("places") * F.col("width") >= F.col("n") * F.lit(coverage) - F.lit(1e-6)))
    held = (pairs.select("text_id", "item", F.explode("runs").alias("run")).join(runs.select("text_id", "run", "words"), ["text_id", "run"])
            .groupBy("text_id", "item").agg(F.sort_array(F.collect_list(F.struct("run", "words"))).alias("held")))
    both = held.select("text_id", "item", F.col("held.words").alias("runs")).join(items.select("item", "words"), "item")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(len(batch)):
                share = covered(batch.column(3)[i].values.to_numpy().view(np.uint64),
                                [r.values.to_numpy().view(np.uint64) for r in batch.column(2)[i]], seed)
                if share[0] >= coverage:
                    out.append((i, *share))
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([o[1] for o in out], pa.float64()),
                                              *[pa.array([o[c] for o in out], pa.int32()) for c in (2, 3)]],
                                             names=["text_id", "item", "coverage", "tiles", "longest"])

    both = both.select("text_id", "item", "runs", "words")
    matched = both.mapInArrow(compare, "text_id string, item string, coverage double, tiles int, longest int")
    return found.where("run = 0").select("key", "text_id"), Stored(matched, "tiling-matches").df


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", seed: int = SEED_WORDS, coverage: float = COVERAGE,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """Pairs ``key, item_key, coverage, tiles, longest``: the document covers at least ``coverage`` of the item's words."""
    holders, matched = _found(docs, benchmark, F.col(key), text, item_text, seed, coverage, filter_bits)
    named = benchmark.select(F.col(item_key).alias("item_key"), text_hash(F.col(item_text)).alias("item")).where(F.col(item_text).isNotNull())
    return (holders.join(matched.join(named, "item"), "text_id")
            .select(F.col("key").alias(key), F.col("item_key").alias(item_key), "coverage", "tiles", "longest"))


def clean(docs: DataFrame, benchmark: DataFrame, seed: int = SEED_WORDS, coverage: float = COVERAGE, text: str = "text",
          item_text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """The documents, all columns and repeated rows kept, that cover no benchmark item enough."""
    _, matched = _found(docs, benchmark, F.lit(0), text, item_text, seed, coverage, filter_bits)
    name = free_name("text_id", docs.columns)
    covers = matched.select(F.col("text_id").alias(name)).distinct()
    return docs.join(covers, text_hash(F.col(text)) == F.col(name), "left_anti")
