"""SimHash near-duplicates: fingerprints of word shingles, compared bit-sliced within blocks.

1. A fingerprint bit is 1 if it is set in over half of the XXH64 values of a text's shingles.
2. Only distinct fingerprints are compared.  Two that differ in at most 2 of 64 bits agree on 2 of
   4 blocks of 16 bits, so each goes to 6 buckets.  A bucket above ``crowded`` rows is
   refined: its members agree on 32 bits, so the 32 others split into 4 blocks of 8 (6 buckets
   of 48 known bits), and once more into 4 blocks of 4 (56 known bits, 256 members at most).  No
   pair is lost at any level, and no bucket exceeds max(crowded, 256) rows.
3. Tasks store the bit planes of their buckets vertically, 64 fingerprints to a machine word.  Per
   plane one XOR updates 64 distances, kept in carry-save counters (ones, twos, more); words whose
   lanes all exceed the radius are abandoned.  A bucket returns the edges of its stars, never its pairs.
4. Components over these edges; copies hang on their fingerprint's smallest id.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and link like any
other; one or two words are one shingle; repeated shingles count each; repeated rows and equal texts
share a component; rows of null id have no component id unless linked; an empty table has no output.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Stored, text_hash
from orderloom.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
CROWDED = 2048
CHUNK_ROWS = 1 << 15      # rows whose planes are in memory at once, besides the bucket that crosses the border
CHUNK_CELLS = 1 << 19     # (fingerprint, word) cells compared at once
SEGMENT_BYTES = 1 << 22   # a text is hashed in segments of this size


def _segments(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in lists of bounded size, cut at white space."""
    if len(data) <= SEGMENT_BYTES:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = min(start + SEGMENT_BYTES, len(data))
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].split()
        start = end


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, count, carried = np.zeros(64, np.int64), 0, []

    def add(hashes: list[int]) -> None:
        nonlocal ones, count
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255           # 255 bits fit a byte's counter
        ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
        count += len(hashes)

    for words in _segments((text or "").encode("utf-8", "replace").lower()):
        words = carried + words
        n = len(words)
        if n >= width:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            stops = (ends[width - 1:] - 1).tolist()
            starts = [0, *ends[:n - width].tolist()]
            for i in range(0, len(starts), 1 << 16):
                add([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + (1 << 16)], stops[i:i + (1 << 16)])])
        carried = words[1 - width:]
    if not count and carried:
        add([digest(b" ".join(carried), SEED)])
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big") if count else 0


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns of ``also`` and ``fp``, the fingerprint as a signed 64-bit number."""
    rows = docs.select(text, key, *also)
    kinds, kept = dict(rows.dtypes), [key, *also]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(_signed(values))], names=[*kept, "fp"])

    return rows.mapInArrow(of, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", fp bigint")


def _block_keys(known: list[tuple[int, int]], rest: list[tuple[int, int]]) -> list[tuple[list, list]]:
    """Ways to fix two of four equal parts of the free bit ranges: (fixed ranges, free ranges)."""
    bits = [p for low, high in rest for p in range(low, high)]
    size = len(bits) // 4
    parts = [(bits[i * size], bits[i * size] + size) if bits[(i + 1) * size - 1] - bits[i * size] == size - 1 else None
             for i in range(4)]
    assert all(parts)
    return [(known + [parts[i], parts[j]], [p for k, p in enumerate(parts) if k not in (i, j)])
            for i, j in combinations(range(4), 2)]


def _mask(ranges: list[tuple[int, int]]) -> int:
    value = sum(((1 << (high - low)) - 1) << low for low, high in ranges)
    return value - (1 << 64) if value >> 63 else value


def _levels() -> list[list[tuple[int, int]]]:
    """Per level its masks with the number of the mask they refine."""
    level, out = [(0, [], [(0, 64)])], []
    for _ in range(3):
        following = [(parent, known, rest) for parent, (_, k, r) in enumerate(level) for known, rest in _block_keys(k, r)]
        out.append([(parent, _mask(known)) for parent, known, _ in following])
        level = following
    return out


LEVELS = _levels()


def _buckets(distinct: DataFrame, crowded: int) -> DataFrame:
    """``level, mask, bucket, fp`` of every bucket with two members or more, none of them crowded."""
    done, rows = None, distinct.select(F.lit(0).alias("mask"), "fp")
    for number, level in enumerate(LEVELS):
        choices = F.array(*[F.struct(F.lit(parent).alias("parent"), F.lit(m).alias("mask"), F.lit(value).cast("long").alias("bits"))
                            for m, (parent, value) in enumerate(level)])
        rows = (rows.withColumn("_c", F.explode(F.filter(choices, lambda c: c["parent"] == F.col("mask"))))
                .select(F.col("_c.mask").alias("mask"), F.col("fp").bitwiseAND(F.col("_c.bits")).alias("bucket"), "fp"))
        counts = rows.groupBy("mask", "bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
        shared = rows.join(counts, ["mask", "bucket"])
        last = number == len(LEVELS) - 1
        stored = Stored(shared.select(F.lit(number).alias("level"), "mask", "bucket", "fp",
                                      (F.lit(not last) & (F.col("rows") > crowded)).alias("refine")), "simhash-buckets")
        fine = stored.df.where(~F.col("refine")).drop("refine")
        done = fine if done is None else done.unionByName(fine)
        rows = stored.df.where("refine").select("mask", "fp")
        if last or rows.isEmpty():
            return done
    return done


def compare_sliced(fp: np.ndarray, starts: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of rows within ``radius`` of each other in the same bucket.

    ``fp`` holds unsigned fingerprints, bucket after bucket; ``starts`` the first row of each bucket.
    """
    n = len(fp)
    sizes = np.diff(np.append(starts, n))
    words = (sizes + 63) // 64
    word_start = np.concatenate(([0], np.cumsum(words)))
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    local = np.arange(n) - starts[bucket]
    word, lane = word_start[bucket] + local // 64, (local % 64).astype(np.uint64)
    one, full = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    planes = np.zeros((64, int(word_start[-1])), np.uint64)
    for b in range(64):
        bit = (fp >> np.uint64(b)) & one
        np.bitwise_or.at(planes[b], word, bit << lane)
    first_row = np.repeat(starts, words) + 64 * (np.arange(int(word_start[-1])) - np.repeat(word_start[:-1], words))
    last_row = np.minimum(first_row + 64, np.repeat(starts + sizes, words))
    valid = np.where(last_row - first_row == 64, full, (one << (last_row - first_row).astype(np.uint64)) - one)
    # A row is compared with its own word and those after it in the bucket.
    spans = word_start[bucket + 1] - word
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    borders = np.searchsorted(np.cumsum(spans), np.arange(CHUNK_CELLS, int(spans.sum()) + CHUNK_CELLS, CHUNK_CELLS))
    begin = 0
    for stop in [*np.minimum(borders + 1, n).tolist(), n]:
        if stop <= begin:
            continue
        rows = np.repeat(np.arange(begin, stop), spans[begin:stop])
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(spans[begin:stop]) - spans[begin:stop], spans[begin:stop])
        cell = word[rows] + offset
        own = offset == 0
        after = np.where(own, ~((one << lane[rows]) | ((one << lane[rows]) - one)), full)
        more = ~(valid[cell] & after)          # lanes that are out from the start
        counters = [np.zeros(len(rows), np.uint64) for _ in range(radius.bit_length())]
        over_at = radius + 1
        for b in range(64):
            carry = planes[b][cell] ^ (np.uint64(0) - ((fp[rows] >> np.uint64(b)) & one))
            for k, c in enumerate(counters):
                counters[k], carry = c ^ carry, c & carry
            more |= carry
            if over_at < 1 << len(counters):    # lanes that have just reached radius + 1 stay out
                reached = full
                for k, c in enumerate(counters):
                    reached = reached & (c if over_at >> k & 1 else ~c)
                more |= reached
            if b % 4 == 3:
                alive = more != full
                if not alive.all():
                    rows, cell, more = rows[alive], cell[alive], more[alive]
                    counters = [c[alive] for c in counters]
                if not len(rows):
                    break
        hit = np.flatnonzero(more != full)
        if len(hit):
            lanes = np.unpackbits((~more[hit]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, bit = np.nonzero(lanes)
            left.append(rows[hit][at])
            right.append(first_row[cell[hit][at]] + bit)
        begin = stop
    return np.concatenate(left), np.concatenate(right)


def star_edges(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each row to the smallest row it can reach, for pairs of row numbers below ``n``."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        if (a == b).all():
            break
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def near_edges(distinct: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that connect all those within ``radius``."""
    if not 0 <= radius <= 2:
        raise ValueError("two of four blocks agree for a radius of 2 at most")
    buckets = _buckets(distinct.select("fp"), crowded)
    keys = ["level", "mask", "bucket"]

    def edges_of(fp: np.ndarray, changes: np.ndarray) -> pa.RecordBatch:
        own = fp.view(np.uint64)
        left, right = compare_sliced(own, np.flatnonzero(changes), radius)
        moved, root = star_edges(len(fp), left, right)
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root])], names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "fp")])
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                columns = [np.concatenate(c) for c in zip(*held)]
                change = _changes(columns[:3])
                cut = int(np.flatnonzero(change)[-1])   # the last bucket may go on
                if cut:
                    yield edges_of(columns[3][:cut], change[:cut])
                held, rows = [[c[cut:] for c in columns]], rows - cut
        if rows:
            columns = [np.concatenate(c) for c in zip(*held)]
            yield edges_of(columns[3], _changes(columns[:3]))

    dealt = buckets.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "a bigint, b bigint")


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    change = np.ones(len(columns[0]), bool)
    change[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return change


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS,
                   crowded: int = CROWDED) -> DataFrame:
    """``key, fingerprint, component_id``: 16 hex digits, and the smallest key within reach."""
    stored = Stored(fingerprints(docs, key, text), "simhash-fingerprints")
    distinct = Stored(stored.df.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    found = components(near_edges(distinct.df, radius, crowded))
    linked = (found.join(distinct.df, F.col("node") == F.col("fp"))
              .groupBy("root").agg(F.min("first").alias("root_first")))
    # Only fingerprints with a neighbour have a root; the others stand for themselves.
    roots = found.join(linked, "root").select("node", "root_first")
    named = distinct.df.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root_first", "first").alias("component_id"))
    return stored.df.join(named, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def group_leads(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS,
                crowded: int = CROWDED) -> DataFrame:
    """``id, h, n``: of each group its row of smallest id (nulls last), then of smallest text hash, and how often it occurs."""
    rows = docs.select(F.col(key).alias("id"), text_hash(F.col(text)).alias("h"), F.col(text).alias("text"))
    stored = Stored(fingerprints(rows, "id", "text", also=("h",)), "simhash-rows")
    counts = stored.df.groupBy("fp", "id", "h").agg(F.count(F.lit(1)).alias("n"))
    lead = F.struct(F.col("id").isNull().alias("last"), "id", "h", "n")
    by_print = Stored(counts.groupBy("fp").agg(F.min(lead).alias("lead")), "simhash-distinct")
    found = components(near_edges(by_print.df, radius, crowded))
    linked = by_print.df.join(found, F.col("fp") == F.col("node"), "left")
    leads = linked.groupBy(F.coalesce("root", "fp")).agg(F.min("lead").alias("lead"))
    return leads.select("lead.id", "lead.h", "lead.n")
