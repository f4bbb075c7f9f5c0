"""Removal of repeated byte strings with a run-length compressed suffix index.

A byte goes if a string of ``length`` bytes that covers it starts earlier as well: in a document of smaller id, or
further ahead in the same one.  Matching every start of a corpus against one index would put all text in
one place, so starts are dealt out by content first.

1. *Anchors.* Of the grams inside the ``length`` bytes from a start, the one of least hash is its anchor; equal
   strings have equal anchors.  Neighbouring starts with the same anchor form a segment of at most
   69 starts.  Tasks hash their segments and keep the first of equal ones.
2. *Meeting.* Segments meet by anchor.  Of equal segments all but the first are removed; an anchor with one
   text only needs nothing more.  Hot anchors were cut down to one row per text and task before.
3. *Index.* The distinct segments of an anchor can still share strings.  Their text is fetched, groups are
   packed into parts of about ``part_bytes``, and segments that agree with no other next to the anchor are left out.  A part's
   Burrows-Wheeler transform is stored as runs with the place sampled at each run's end.  Matching statistics are streamed
   from them: a run's head is compared with the sampled end of the run before, and inside a run the match moves on with
   the text and gets shorter by one.  Matches of ``length`` bytes or more chain equal strings, and all but the first
   place of a chain are removed.  A group above ``part_bytes`` is spread by the 128-bit hash of its strings instead, which
   needs no group in one task and finds the same starts.
4. *Applying.* Removed starts meet their document, are merged into spans and cut out.

Defined cases: null and empty texts have no bytes; repeated rows (equal id and text) are one document, reported once
per row; rows that share an id but not the text, and rows without id, are documents of their own, ordered by id
(null first), then by a hash of the text; texts may be of any length, as they are read in blocks; an empty table has no
output; other columns, of any name, are kept by ``without_repeats`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.llm.common import Stored, release

LENGTH, GRAM = 100, 32
BLOCK_BYTES = 1 << 18
PART_BYTES = 1 << 19
CHUNK_ROWS = 1 << 17
FACTOR = np.uint64(0xD1B54A32D192ED03)
OTHER = np.uint64(0xA0761D6478BD642F)
PLACE = np.uint64((1 << 21) - 1)      # low bits of a key: the place within a block


@lru_cache(4)
def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(factor, -1, 1 << 64)
    return tuple(np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, f, np.uint64)))) for f in (factor, inverse))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sums(data: np.ndarray, factor: np.uint64 = FACTOR) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(int(factor), 2 * BLOCK_BYTES)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums, down


def segments(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Segments of the pieces ``[begin, end)`` of a block.

    Returns anchor hash, content hash, piece number, first start (in the block) and number of starts.
    """
    empty = np.zeros(0, np.uint64)
    counts = np.maximum(ends - begins - length + 1, 0)
    if not counts.sum():
        return empty, empty, *[np.zeros(0, np.int64)] * 3
    sums, down = _sums(data)
    h = _mixed((sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1])
    least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    width, step = length - gram + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[:step - width], least[width - step:])
    piece = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begins, counts)
    anchor = (least[starts] & PLACE).astype(np.int64)
    first = np.ones(len(starts), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    at = np.flatnonzero(first)
    sizes = np.diff(np.append(at, len(starts)))
    start = starts[at]
    content = _mixed((sums[start + sizes + length - 1] - sums[start]) * down[start] + sizes.astype(np.uint64))
    return h[anchor[at]], content, piece[at], start, sizes


def _pieces(values: pa.Array, length: int) -> Iterator[tuple[np.ndarray, list]]:
    """Blocks of concatenated texts with their pieces (row, offset in the text, begin, end); long texts are cut with overlap."""
    held, pieces, size = [], [], 0
    for row, value in enumerate(values):
        view = np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.zeros(0, np.uint8)
        for offset in range(0, max(len(view) - length + 1, 0), BLOCK_BYTES):
            part = view[offset:offset + BLOCK_BYTES + length - 1]
            if size and size + len(part) > BLOCK_BYTES:
                yield np.concatenate(held), pieces
                held, pieces, size = [], [], 0
            held.append(part)
            pieces.append((row, offset, size, size + len(part)))
            size += len(part)
    if size:
        yield np.concatenate(held), pieces


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """``h, c, doc, at, gone``: segments by anchor; ``at`` is start * 128 + starts - 1.

    Of equal segments in a block all but the first are already gone; they carry a hash that spreads them.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for data, pieces in _pieces(batch.column(1), length):
                row, offset, begin, end = (np.array(x, np.int64) for x in zip(*pieces))
                h, c, piece, start, sizes = segments(data, begin, end, length)
                doc = ids[row[piece]]
                at = (start - begin[piece] + offset[piece]) * 128 + sizes - 1
                order = np.argsort(h ^ (c * OTHER))
                mixed = (h ^ (c * OTHER))[order]
                if (mixed[1:] == mixed[:-1]).any():          # equal segments in the order of documents
                    order = np.lexsort((at, doc, h ^ (c * OTHER)))
                h, c, doc, at = h[order], c[order], doc[order], at[order]
                gone = np.zeros(len(h), bool)
                gone[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
                h[gone] = _mixed(doc[gone].astype(np.uint64) * OTHER + at[gone].astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (h.view(np.int64), c.view(np.int64), doc, at * 2 + gone)], names=["h", "c", "doc", "at"])

    return docs.select("doc", "bytes").mapInArrow(scan, "h bigint, c bigint, doc bigint, at bigint")


def _meet(rows: DataFrame) -> DataFrame:
    """``gone, h, doc, at``: segments to remove, and the distinct segments of anchors with two texts or more."""
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ghost, several = [], 0, 0, False
        # The last distinct segment of a group that may go on is put before the following rows: as a ghost, which
        # is not returned again, if the group is known to have several texts.
        def flush(last: bool):
            nonlocal held, size, ghost, several
            h, c, doc, at = (np.concatenate(x) for x in zip(*held))
            marked, at = at & 1 == 1, at >> 1
            if ghost:
                marked[0] = False
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            group = np.ones(len(h), bool)
            group[1:] = h[1:] != h[:-1]
            number = np.cumsum(group) - 1
            texts = np.bincount(number, fresh & ~marked)
            if several:
                texts[0] = max(texts[0], 2)
            out = marked | ~fresh
            need = ~out & (texts[number] > 1)
            if ghost and several:
                need[0] = False
            open_group = number[-1]
            rep = np.flatnonzero((number == open_group) & fresh & ~marked)
            keep = out | need
            result = pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (out, h, doc, at)], names=["gone", "h", "doc", "at"])
            if not last and len(rep):
                r = rep[-1:]
                several = bool(texts[open_group] > 1)
                held, size, ghost = [(h[r], c[r], doc[r], at[r] * 2)], 1, 1
            else:
                held, size, ghost, several = [], 0, 0, False
            return result

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                yield flush(False)
        if size > ghost:
            yield flush(True)
        elif size and not several:
            pass                      # a single text: nothing to remove

    dealt = rows.repartition("h").sortWithinPartitions("h", "c", "doc", "at")
    return dealt.mapInArrow(decide, "gone boolean, h bigint, doc bigint, at bigint")


class RunIndex:
    """Run-length compressed Burrows-Wheeler transform of a set of segments, each with an end mark of its own.

    Of the suffix order only the places at the borders of runs are kept: that of each run's first row and, sampled, that of
    the row before it, the end of the previous run.
    """

    def __init__(self, parts: list[np.ndarray]):
        self.sizes = np.array([len(p) for p in parts])
        n = int(self.sizes.sum()) + len(parts)
        self.begin = np.cumsum(self.sizes + 1) - self.sizes - 1
        stop = self.begin + self.sizes                  # places of the end marks
        self.text = np.zeros(n, np.int16)
        inside = np.ones(n, bool)
        inside[stop] = False
        self.text[inside] = np.concatenate(parts).astype(np.int16) + 1
        self.own_stop = np.repeat(stop, self.sizes + 1).astype(np.int32)
        order = self._suffix_order()
        # Transform: the symbol before each suffix.  A segment's first suffix follows another segment's end mark, so it
        # is a run by itself.
        before = np.where(np.isin(order, self.begin.astype(np.int32)), np.int16(-1), self.text[order - 1])
        heads = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (before[1:] < 0)))
        self.run_symbol, self.run_size = before[heads], np.diff(np.append(heads, n)).astype(np.int32)
        self.run_head_place = order[heads[1:]]
        self.run_end_place = order[heads[1:] - 1]

    def _suffix_order(self) -> np.ndarray:
        """Places in the order of their suffixes, by ranks over twice as many symbols in each round."""
        n = len(self.text)
        places = np.arange(n, dtype=np.int32)
        key = np.zeros(n, np.int64)
        for k in range(7):
            key = key << 9 | self.text[np.minimum(places + np.int32(k), self.own_stop)]
        ends = np.flatnonzero(self.own_stop == places)
        key[ends] = np.arange(len(ends)) - len(ends)     # end marks come first, in order
        rank, depth = self._ranks(key), 7
        while int(rank.max()) < n - 1:
            key = rank.astype(np.int64) * n
            key += rank[np.minimum(places + np.int32(depth), self.own_stop)]
            rank = self._ranks(key)
            depth *= 2
        order = np.empty(n, np.int32)
        order[rank] = places
        return order

    @staticmethod
    def _ranks(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(len(key), np.int32)
        rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]), dtype=np.int32)
        return rank

    def _agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of symbols that the suffixes at ``a`` and ``b`` have in common; an end mark equals nothing."""
        out, alive, depth = np.zeros(len(a), np.int32), np.arange(len(a)), 0
        while len(alive):
            x, y = self.text[a[alive] + depth], self.text[b[alive] + depth]
            alive = alive[(x == y) & (x > 0)]
            depth += 1
            out[alive] = depth
        return out

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Per place the length of the match with the suffix before it in order, and the place of that match.

        A run's first row is compared with the sampled end of the run before.  Going on in the text, both places move
        by one and the length falls by one, until the next place that heads a run.
        """
        text_order = np.argsort(self.run_head_place)
        head, end = self.run_head_place[text_order], self.run_end_place[text_order]
        length = self._agreement(head, end)
        places = np.arange(len(self.text), dtype=np.int32)
        at = np.searchsorted(head, places, "right") - 1
        since = places - head[np.maximum(at, 0)]
        known = at >= 0
        return (np.where(known, np.maximum(length[at] - since, 0), 0),
                np.where(known, np.minimum(end[at] + since, len(places) - 1), places))


def repeated_starts(parts: list[np.ndarray], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of all starts in ordered segments whose string starts in an earlier place too."""
    index = RunIndex(parts)
    matched, partner = index.matching_statistics()
    places = np.arange(len(partner), dtype=np.int32)
    # Long matches chain the equal strings of a place together; the first of a chain stays.
    first = np.where(matched >= length, partner, places).astype(np.int32)
    while True:
        following = first[first]
        if (following == first).all():
            break
        first = following
    least = places.copy()
    np.minimum.at(least, first, places)
    later = np.flatnonzero(least[first] < places)
    segment = np.searchsorted(index.begin, later, "right") - 1
    return segment, later - index.begin[segment]


def may_match(anchors: np.ndarray, parts: list[np.ndarray], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Whether a segment can share a string with another of its anchor.

    A common string reaches (length - gram) / 2 bytes to the left or right of the anchor at least, so
    both segments agree on one of these two contexts.
    """
    sizes = np.array([len(p) for p in parts])
    data, reach = np.concatenate(parts), (length - gram + 1) // 2
    sums = np.zeros(len(data) + 1, np.uint64)
    up, down = _powers(int(FACTOR), 1 << (len(data)).bit_length())
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    begin = np.cumsum(sizes) - sizes
    grams = _mixed((sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1])
    at = np.flatnonzero(grams == np.repeat(anchors, sizes)[:len(grams)])
    owner = np.searchsorted(begin, at, "right") - 1
    inside = at + gram <= begin[owner] + sizes[owner]
    owner, first = np.unique(owner[inside], return_index=True)
    place = at[inside][first]
    out = np.zeros(len(parts), bool)
    for left, right in ((reach, 0), (0, reach)):
        fits = (place - left >= begin[owner]) & (place + gram + right <= begin[owner] + sizes[owner])
        a, o = place[fits] - left, owner[fits]
        context = _mixed((sums[a + gram + reach] - sums[a]) * down[a]) ^ (anchors[o] * OTHER)
        _, back, count = np.unique(context, return_inverse=True, return_counts=True)
        out[o[count[back] > 1]] = True
    return out


def _removed_rows(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Single starts as rows ``doc, at``, neighbours together."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(first)
    sizes = np.diff(np.append(at, len(doc)))
    # A row holds at most 128 starts.
    pieces = (sizes + 127) // 128
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(start[at], pieces) + 128 * nth
    left = np.minimum(np.repeat(sizes, pieces) - 128 * nth, 128)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(doc[at], pieces)), pa.array(begin * 128 + left - 1)], names=["doc", "at"])


def _index_groups(texts: DataFrame, length: int, part_bytes: int) -> DataFrame:
    """``doc, at`` of the starts to remove among the segments ``h, doc, at, piece``."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, doc, at, parts, size = [], [], [], [], 0

        def flush(n: int) -> pa.RecordBatch:
            nonlocal h, doc, at, parts, size
            docs, places = np.array(doc[:n]), np.array(at[:n])
            order = np.lexsort((places, docs))
            order = order[may_match(np.array(h[:n]).view(np.uint64), parts[:n], length)[order]]
            docs, starts = docs[order], places[order] // 128
            segment, offset = repeated_starts([parts[i] for i in order], length) if len(order) else (order, order)
            h, doc, at, parts = h[n:], doc[n:], at[n:], parts[n:]
            size = sum(map(len, parts))
            return _removed_rows(docs[segment], starts[segment] + offset)

        for batch in batches:
            for key, d, a, piece in zip(*(batch.column(i) for i in range(4))):
                key = key.as_py()
                if size >= part_bytes and key != h[-1]:
                    yield flush(len(h))
                h.append(key)
                doc.append(d.as_py())
                at.append(a.as_py())
                parts.append(np.frombuffer(piece.as_buffer(), np.uint8))
                size += len(parts[-1])
        if parts:
            yield flush(len(h))

    return texts.repartition("h").sortWithinPartitions("h").mapInArrow(index, "doc bigint, at bigint")


def _spread_groups(texts: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: their strings meet by 128-bit hashes, the first of each stays."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, a, piece in zip(*(batch.column(i) for i in (1, 2, 3))):
                data = np.frombuffer(piece.as_buffer(), np.uint8)
                n, halves = len(data) - length + 1, []
                for factor in (FACTOR, OTHER):
                    sums, down = _sums(data, factor)
                    halves.append(_mixed((sums[length:] - sums[:-length]) * down[:n]).view(np.int64))
                out.append((*halves, np.full(n, d.as_py()), a.as_py() // 128 + np.arange(n)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["h1", "h2", "doc", "start"])

    rows = Stored(texts.mapInArrow(strings, "h1 bigint, h2 bigint, doc bigint, start bigint"), "repeats-strings").df
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = rows.join(first, ["h1", "h2"]).where(F.struct("doc", "start") != F.col("first"))
    return later.select("doc", (F.col("start") * 128).alias("at"))


def _segment_texts(needed: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``h, doc, at, piece``: the bytes of needed segments."""
    lists = needed.groupBy("doc").agg(F.collect_list("h").alias("hs"), F.collect_list("at").alias("ats"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, value, hs, ats in zip(*(batch.column(i) for i in range(4))):
                data, places = value.as_py(), ats.values.to_numpy(zero_copy_only=False)
                pieces = [data[p // 128:p // 128 + p % 128 + length] for p in places.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [hs.values, pa.array(np.full(len(places), d.as_py())), pa.array(places), pa.array(pieces, pa.binary())],
                    names=["h", "doc", "at", "piece"])

    rows = docs.select("doc", "bytes").join(lists, "doc")
    return rows.mapInArrow(cut, "h bigint, doc bigint, at bigint, piece binary")


def _numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """``docs`` with ``doc``, a whole number in the order of documents, and whether equal rows share it.

    Ids serve as they are where each has one text.  Otherwise documents are numbered over range partitions.
    """
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    whole = dict(docs.dtypes)[key] in ("bigint", "int", "smallint", "tinyint")
    per_id = docs.select(F.col(key).alias("id"), mark.alias("mark")).groupBy("id").agg(
        F.min("mark").alias("a"), F.max("mark").alias("b"), F.count(F.lit(1)).alias("n"))
    state = per_id.agg(F.max((F.col("a") != F.col("b")) | F.col("id").isNull()).alias("mixed"), F.max("n").alias("n")).first()
    repeated = bool(state["n"] and state["n"] > 1)
    if whole and not state["mixed"]:
        return docs.withColumn("doc", F.col(key).cast("long")), repeated
    order = [F.col(key).asc_nulls_first(), F.col("_mark")]
    ranged = Stored(docs.withColumn("_mark", mark).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()),
                    "repeats-numbered").df
    fresh = W.partitionBy("_range").orderBy(*order)
    rows = ranged.withColumn("_n", F.dense_rank().over(fresh))
    sizes = rows.groupBy("_range").agg(F.max("_n").alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = rows.join(starts, "_range").withColumn("doc", (F.col("_start") + F.col("_n")).cast("long"))
    return numbered.drop("_mark", "_range", "_n", "_start"), repeated


def find_repeats(docs: DataFrame, repeated: bool = False, length: int = LENGTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc, ats``: per document with repeats the starts to remove; for documents ``doc, bytes``."""
    spark = docs.sparkSession
    single = docs.select("doc", "bytes")
    if repeated:
        single = single.dropDuplicates(["doc"])
    met = Stored(_meet(_anchor_rows(single, length)), "repeats-met")
    release(spark)
    needed = met.df.where(~F.col("gone")).select("h", "doc", "at")
    # A group's size is known before its text is fetched.
    large = (needed.groupBy("h").agg(F.sum(F.col("at") % 128 + length).alias("size"))
             .where(F.col("size") > part_bytes).select("h", F.lit(True).alias("large")))
    texts = Stored(_segment_texts(needed, single, length), "repeats-texts")
    release(spark)
    sized = texts.df.join(large, "h", "left")
    small = sized.where(F.col("large").isNull()).drop("large")
    removed = _index_groups(small, length, part_bytes)
    if not large.isEmpty():
        removed = removed.unionByName(_spread_groups(sized.where(F.col("large")).drop("large"), length))
    found = Stored(removed, "repeats-found")
    texts.drop()
    release(spark)
    starts = met.df.where("gone").select("doc", "at").unionByName(found.df)
    return starts.groupBy("doc").agg(F.collect_list("at").alias("ats"))


def spans_of(ats: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Merged, ordered byte spans (n, 2) of removed starts."""
    begin = ats // 128
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], (begin + ats % 128 + length)[order]
    reach = np.maximum.accumulate(end)
    first = np.ones(len(begin), bool)
    first[1:] = begin[1:] > reach[:-1]
    at = np.flatnonzero(first)
    return np.stack([begin[at], np.append(reach[at[1:] - 1], reach[-1])], axis=1)


def kept_bytes(data: bytes, ats: np.ndarray, length: int = LENGTH) -> tuple[bytes, np.ndarray]:
    """What is left of a text, and the spans that went."""
    spans = spans_of(ats, length)
    borders = np.concatenate(([0], spans.ravel(), [len(data)])).tolist()
    return b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2])), spans


def _with_starts(docs: DataFrame, key: str, text: str, length: int, part_bytes: int) -> DataFrame:
    numbered, repeated = _numbered(docs, key, text)
    held = numbered.withColumn("bytes", F.coalesce(F.col(text), F.lit("")).cast("binary"))
    starts = find_repeats(held, repeated, length, part_bytes)
    return held.join(starts, "doc", "left")


def repeat_report(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document ``key, n_bytes, n_removed, n_spans, kept_sha256``."""
    kind = dict(docs.dtypes)[key]
    rows = _with_starts(docs.select(key, text), key, text, length, part_bytes).select(key, "bytes", "ats")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, ats in zip(batch.column(1), batch.column(2)):
                data, spans = value.as_buffer(), np.zeros((0, 2), np.int64)
                kept = data
                if ats.is_valid:
                    kept, spans = kept_bytes(value.as_py(), ats.values.to_numpy(zero_copy_only=False), length)
                out.append((len(data), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), hashlib.sha256(kept).hexdigest()))
            n, removed, spans, digest = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (n, removed, spans)], pa.array(digest, pa.string())],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(report, f"{key} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with repeated strings cut out of the text; characters that a cut splits go as a whole."""
    # The caller's columns travel in one struct, so none of them meets a column of this module.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = _with_starts(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), others.alias("row")), "key", "text",
                        length, part_bytes)
    own = [F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]

    @F.pandas_udf("string")
    def cut(data: pd.Series, ats: pd.Series) -> pd.Series:
        return pd.Series([kept_bytes(bytes(d), np.asarray(a), length)[0].decode("utf-8", "ignore") for d, a in zip(data, ats)],
                         dtype=object)

    # Untouched texts, nulls among them, do not pass through Python.
    touched = rows.where(F.col("ats").isNotNull()).withColumn("text", cut("bytes", "ats"))
    return touched.select(*own).unionByName(rows.where(F.col("ats").isNull()).select(*own))
