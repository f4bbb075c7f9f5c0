"""What each of several filters removes in every order of them, from one packed counter per part.

1. One pass over the texts gives a row per document: its part, the bits of the filters it fails, and a digest of the text.  The
   filter for repeated texts compares digests over the whole table.
2. What happens to a document at each step of each order depends on its mask alone.  So every mask maps to one big
   integer with a field of ``FIELD_BITS`` bits for each (order, step, outcome): 600 steps of 5 filters.
3. Tasks add these integers per part, over all, good and toxic documents; equal masks of a batch are counted first and
   added as one multiple.  The sums of tasks are added in rounds of bounded fan-in, so no task adds up one part alone.
4. The sum of a part is unpacked into its rows.  A field holds up to 2**64 - 1 documents, so no carry reaches the next one.

Filters (a bit each): A under ``LEAST_WORDS`` words; B distinct words below 80% of words; C over 10% capitals A-Z; D a
control mark; E a text that a smaller id has as well.

Defined cases: null texts are empty, a null part is the empty string; rows of null id never fail E and let nobody fail it; repeated rows
count each, and do not make one another fail E; several labels of an id count as good or toxic if one of them is; documents
without label are neither; an empty table has no parts and no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Stored, join_weighted

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = re.compile(rb"[#$%&*|]")
CONTINUED = bytes(range(0x80, 0xC0))        # bytes of a code point after its first
FIELD_BITS = 64
OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
FAN_IN = 64
GROUPS = ("everyone", "good", "toxic")


def failed_filters(data: bytes) -> int:
    """Bits of the filters A to D that one UTF-8 text fails."""
    words = data.split()                    # bytes split at space and tab to carriage return
    capitals = len(data) - len(data.translate(None, CAPITALS))
    points = len(data.translate(None, CONTINUED))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2
            | (MARKS.search(data) is not None) << 3)


def text_masks(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``id, part, mask, digest``: one pass over the texts; a digest has 128 bits."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2):
                data = value.as_py()
                masks.append(failed_filters(data))
                digests.append(hashlib.sha256(data).digest()[:16])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                names=["id", "part", "mask", "digest"])

    return rows.mapInArrow(of, f"id {dict(rows.dtypes)['id']}, part string, mask int, digest binary")


def with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with the bit of E set where a smaller id has the same text."""
    groups = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("rows"))
    shared = Stored(groups.where("first < last").drop("last"), "audit-texts").df
    joined = join_weighted(rows, shared, ["digest"], "rows", rows.count(), "left")
    repeat = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return joined.select("id", "part", (F.col("mask") + F.when(repeat, 16).otherwise(0)).alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``part, mask, good, toxic``; rows and labels meet by id."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = rows.where(F.col("id").isNotNull()).join(marks.where("good or toxic"), "id", "left").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    return named.unionByName(rows.where(F.col("id").isNull()).select(
        "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def step_outcomes(mask: int, order: tuple[int, ...]) -> list[tuple[bool, ...]]:
    """Per step of ``order`` what becomes of a document that fails the filters of ``mask``, as in ``OUTCOMES``."""
    here, out = True, []
    for number in order:
        fails = bool(mask >> number & 1)
        removed = here and fails
        redundant = fails and not here
        here = here and not fails
        out.append((here, removed, redundant, mask == 1 << number))
    return out


@lru_cache(maxsize=None)
def packed_mask(mask: int, filters: int = len(FILTERS)) -> int:
    """All step outcomes of a mask as one integer; the first field is the lowest."""
    width, value = FIELD_BITS // 8, bytearray()
    for order in permutations(range(filters)):
        for outcome in step_outcomes(mask, order):
            for happened in outcome:
                value += int(happened).to_bytes(width, "little")
    return int.from_bytes(value, "little")


def _bytes(value: int) -> bytes:
    return value.to_bytes((value.bit_length() + 7) // 8, "little")


def _emit(sums: dict[tuple, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in sums], pa.string()), pa.array([g for _, g in sums], pa.string()),
         pa.array([_bytes(v) for v in sums.values()], pa.binary())], names=["part", "who", "packed"])


SUMS = "part string, who string, packed binary"


def add_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of packed integers over rows ``part, mask, good, toxic``; emitted when a task holds ``FAN_IN`` of them."""
    sums: dict[tuple, int] = {}
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns))
        for (part, mask, good, toxic), n in Counter(rows).items():
            for who, counts in zip(GROUPS, (True, good, toxic)):
                if counts:
                    sums[part, who] = sums.get((part, who), 0) + n * packed_mask(mask)
        if len(sums) > FAN_IN:
            yield _emit(sums)
            sums = {}
    if sums:
        yield _emit(sums)


def add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows ``part, who, packed`` that come sorted by part and group."""
    current, total = None, 0
    for batch in batches:
        for part, who, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if current is not None and current != (part, who):
                yield _emit({current: total})
                total = 0
            current, total = (part, who), total + int.from_bytes(packed, "little")
    if current is not None:
        yield _emit({current: total})


def packed_sums(rows: DataFrame) -> DataFrame:
    """``part, who, packed``: one row per part and group of documents that has any."""
    sums = Stored(rows.select("part", "mask", "good", "toxic").mapInArrow(add_masks, SUMS), "audit-sums")
    while True:
        most = sums.df.groupBy("part", "who").count().agg(F.max("count")).first()[0] or 0
        # Groups of up to FAN_IN sums, dealt by a stored number, until one round can take what is left of a part.
        last = most <= FAN_IN
        slot = F.lit(0) if last else F.pmod(F.xxhash64("packed", F.monotonically_increasing_id()), F.lit(-(-most // FAN_IN)))
        dealt = sums.df.withColumn("slot", slot).repartition("part", "who", "slot").sortWithinPartitions("part", "who", "slot")
        following = dealt.select("part", "who", "packed").mapInArrow(add_sums, SUMS)
        if last:
            return following
        stored = Stored(following, "audit-sums")
        sums.drop()
        sums = stored


def unpack(packed: bytes, filters: int = len(FILTERS)) -> np.ndarray:
    """Counts by order, step and outcome."""
    orders = len(list(permutations(range(filters))))
    fields = orders * filters * len(OUTCOMES)
    return np.frombuffer(packed.ljust(fields * FIELD_BITS // 8, b"\0"), "<u8").reshape(orders, filters, len(OUTCOMES))


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def unpack_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a part from ``part, everyone, good, toxic``."""
    orders = list(permutations(range(len(FILTERS))))
    place = np.array(orders)
    for batch in batches:
        for part, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            everyone, good, toxic = (unpack(p or b"").astype(np.int64) for p in packed)
            removed = everyone[:, :, 1]
            by_filter = np.zeros(len(FILTERS), np.int64)
            np.add.at(by_filter, place.ravel(), removed.ravel())
            names = ["".join(FILTERS[f] for f in o) for o in orders]
            columns = [everyone[:, :, 0], removed, everyone[:, :, 2], everyone[:, :, 3], good[:, :, 1], toxic[:, :, 1],
                       by_filter[place]]
            steps = len(FILTERS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(orders) * steps), pa.array(np.repeat(names, steps).tolist()),
                 pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders))),
                 *[pa.array(c.ravel()) for c in columns]],
                names=[c.split()[0] for c in RESULT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step."""
    rows = Stored(text_masks(docs, key, text, part), "audit-masks").df
    masks = with_labels(with_repeats(rows), labels, key)
    sums = packed_sums(masks)
    wide = sums.groupBy("part").agg(*[F.max(F.when(F.col("who") == g, F.col("packed"))).alias(g) for g in GROUPS])
    return wide.mapInArrow(unpack_parts, RESULT)
