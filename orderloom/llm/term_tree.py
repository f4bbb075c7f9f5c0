"""Ranked lexical search: tasks build trees of documents and search them by branch and bound, item by item.

1. Items come in blocks of a bounded number of terms.  For each block one pass over the texts keeps, of every document, the
   number of its terms and the terms of the block with their counts; document frequencies follow from these vectors.
2. A task takes documents in chunks of bounded size.  Their vectors, terms in order of falling document frequency, form a trie:
   equal beginnings share a path, and chains without a branch are one node.  A node knows for every term
   the largest count below it, and the smallest length term ``m`` and the smallest id below it.
3. A score rises with the counts and falls with ``m``, so a node's values bound every score below it.  Per item the
   search goes depth first, best bound first, several nodes of the stack at a time, and drops a node whose bound is below
   the item's k-th score so far (or equal to it, with larger ids only).  The best documents of an item live on from chunk to chunk.
4. The best of all tasks are ranked by a window, which Spark limits to k rows per item before its shuffle.

Nothing is estimated: a dropped node holds no document of the result.

Defined cases: a null text has no terms; every row is a document, so repeated rows take a rank each; documents of null id come last
among equal scores; rows of equal item id are one item, whose terms add up; items without terms, or without a document of a score
above 0, have no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import string
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window as W

from orderloom.llm.common import Stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The same for UTF-8 bytes: A-Z lower-cased, what is no part of a term to a space.
TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
K = 10
BLOCK_TERMS = 1 << 18       # (item, term) rows of a block, on average
TREE_TERMS = 1 << 12        # terms of the items searched in one tree; an item with more has a tree of its own
TREE_CELLS = 1 << 22        # documents times terms of a tree
BUCKET = 8                  # a node of so few documents is not divided further
AT_ONCE = 32                # nodes taken from the stack together
SEGMENT_BYTES = 1 << 22
SCALE = 10 ** 9


def term_counts(data: bytes) -> tuple[Counter, int]:
    """Counts of all terms of a UTF-8 text and their number; long texts are read in segments."""
    counts, n, start = Counter(), 0, 0
    while start < len(data):
        end = min(start + SEGMENT_BYTES, len(data))
        while end < len(data) and TO_TERMS[data[end]] != 32:
            end += 1
        words = data[start:end].translate(TO_TERMS).split()
        counts.update(words)
        n, start = n + len(words), end
    return counts, n


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item, term, times``."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    terms = items.select(F.col(key).alias("item"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), 0)).alias("term"))
    return terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


def restricted_vectors(docs: DataFrame, terms: list[str], key: str, text: str) -> DataFrame:
    """``id, n, terms, counts``: numbers of the given terms in each document with their counts, by number."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    number = {t.encode(): i for i, t in enumerate(terms)}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, found, times = [], [0], [], []
            for value in batch.column(1):
                counts, n = term_counts(value.as_py())
                own = sorted((number[t], c) for t, c in counts.items() if t in number)
                found += [t for t, _ in own]
                times += [c for _, c in own]
                sizes.append(n)
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], names=["id", "n", "terms", "counts"])

    return rows.mapInArrow(of, f"id {dict(rows.dtypes)['id']}, n long, terms array<int>, counts array<int>")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two vectors."""
    k = min(len(a), len(b))
    differ = a[:k] != b[:k]
    return int(differ.argmax()) if differ.any() else k


class TermTree:
    """Compact trie of document vectors.  Rows 0 .. documents - 1 of the arrays are documents, the others inner nodes."""

    def __init__(self, ids: list, m: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], width: int):
        order = sorted(range(len(ids)), key=lambda i: vectors[i][0].astype(">u4").tobytes())
        n = self.documents = len(order)
        self.ids = [ids[i] for i in order]
        paths = [vectors[i][0] for i in order]
        self.most = np.zeros((2 * n + 1, width), np.int32)      # largest count below, by term
        self.low_m = np.full(2 * n + 1, np.iinfo(np.int64).max)
        self.low_m[:n] = m[order]
        for row, i in enumerate(order):
            self.most[row, vectors[i][0]] = vectors[i][1]
        self.low_id = [(i is None, 0 if i is None else i) for i in self.ids] + [None] * (n + 1)
        self.below: list = [None] * (2 * n + 1)                 # children of an inner node
        size = [1] * n + [0] * (n + 1)
        self.root, used = n, n + 1
        self.below[n] = []
        stack, pending = [(0, n)], None

        def attach(child: int, node: int) -> None:
            np.maximum(self.most[node], self.most[child], out=self.most[node])
            self.low_m[node] = min(self.low_m[node], self.low_m[child])
            low = self.low_id[node]
            self.low_id[node] = self.low_id[child] if low is None else min(low, self.low_id[child])
            size[node] += size[child]
            # A small node is left out: its documents hang on the node above.
            self.below[node] += self.below[child] if child > n and size[child] <= BUCKET else [child]

        for row in range(n):
            shared = _common(paths[row - 1], paths[row]) if row else 0
            while stack[-1][0] > shared:
                node = stack.pop()[1]
                attach(pending, node)
                pending = node
            if stack[-1][0] < shared:
                stack.append((shared, used))
                self.below[used] = []
                used += 1
            if pending is not None:
                attach(pending, stack[-1][1])
            pending = row
        while stack and pending is not None:
            node = stack.pop()[1]
            attach(pending, node)
            pending = node
        self.below = [None if b is None else np.array(b, np.int64) for b in self.below]

    def bounds(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of documents; for nodes, no score below is larger."""
        counts = self.most[rows[:, None], terms].astype(np.int64)
        return (weights * (SCALE * counts // (1000 * counts + 8 * self.low_m[rows][:, None]))).sum(axis=1)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list, k: int) -> int:
        """Put documents among the ``best`` k, kept as (-score, id is null, id); returns the number of scores computed."""
        stack, visited = [(None, self.root)], 0

        def hopeless(score: int, row: int) -> bool:
            return score <= 0 or (len(best) == k and (-score, *self.low_id[row]) > best[-1])

        while stack:
            nodes = []
            while stack and len(nodes) < AT_ONCE:
                bound, node = stack.pop()
                if bound is None or not hopeless(bound, node):
                    nodes.append(self.below[node])
            if not nodes:
                continue
            rows = np.concatenate(nodes)
            scores = self.bounds(rows, terms, weights)
            visited += len(rows)
            worth = scores >= (max(1, -best[-1][0]) if len(best) == k else 1)
            rows, scores = rows[worth], scores[worth]
            order = np.argsort(scores, kind="stable")
            rows, scores = rows[order].tolist(), scores[order].tolist()
            for row, score in zip(reversed(rows), reversed(scores)):
                if row < self.documents and not hopeless(score, row):
                    insort(best, (-score, *self.low_id[row]))
                    del best[k:]
            stack += [(score, row) for row, score in zip(rows, scores) if row >= self.documents]
        return visited


def tree_groups(items: list[tuple], most_terms: int = TREE_TERMS) -> list[tuple[list, np.ndarray]]:
    """Items ``(place, terms, weights)`` in groups of at most ``most_terms`` distinct terms, with the terms of each group."""
    groups, held, known = [], [], set()
    for item in items:
        own = set(item[1].tolist())
        if held and len(known | own) > most_terms:
            groups.append((held, np.array(sorted(known))))
            held, known = [], set()
        held.append(item)
        known |= own
    if held:
        groups.append((held, np.array(sorted(known))))
    return groups


def best_in_trees(rows: Iterator[tuple], groups: list, documents: int, terms: int, k: int = K,
                  cells: int = TREE_CELLS) -> dict[int, list]:
    """The best documents per item place over rows ``(id, n, terms, counts)``; terms are numbered by falling frequency."""
    best = {item[0]: [] for items, _ in groups for item in items}

    def search(chunk: list[tuple]) -> None:
        m = np.array([25 + 75 * n * documents // terms for _, n, _, _ in chunk], np.int64)
        ids = [r[0] for r in chunk]
        for items, known in groups:
            vectors = []
            for _, _, own, counts in chunk:
                at = np.searchsorted(known, own)
                inside = known[np.minimum(at, len(known) - 1)] == own
                vectors.append((at[inside], counts[inside]))
            tree = TermTree(ids, m, vectors, len(known))
            for place, own, weights in items:
                tree.search(np.searchsorted(known, own), weights, best[place], k)

    widest = max((len(known) for _, known in groups), default=1)
    chunk, limit = [], max(1, cells // max(1, widest))
    for row in rows:
        if len(row[2]):
            chunk.append(row)
        if len(chunk) >= limit:
            search(chunk)
            chunk = []
    if chunk:
        search(chunk)
    return best


def _block_best(docs: DataFrame, block: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``item, doc, score`` of the best documents of each task for the items of a block."""
    wanted: dict = {}
    for item, term, times in block.select("item", "term", "times").toLocalIterator():
        wanted.setdefault(item, {})[term] = times
    terms = sorted({t for own in wanted.values() for t in own})
    vectors = Stored(restricted_vectors(docs, terms, key, text), "term-vectors").df
    documents, total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    kinds = dict(docs.dtypes)[key], dict(block.dtypes)["item"]
    schema = f"item {kinds[1]}, doc {kinds[0]}, score long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    if not documents:
        return docs.sparkSession.createDataFrame([], schema)
    frequency = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())   # terms of the block
    order = sorted(range(len(terms)), key=lambda t: (-frequency.get(t, 0), t))
    place = np.empty(len(terms), np.int64)
    place[order] = np.arange(len(terms))
    number = {t: i for i, t in enumerate(terms)}

    def weight(term: str) -> int:
        return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(number[term], 0) + 1)))

    names, items = list(wanted), []
    for at, name in enumerate(names):
        own = sorted((int(place[number[t]]), weight(t) * times) for t, times in wanted[name].items())
        items.append((at, np.array([t for t, _ in own]), np.array([w for _, w in own], np.int64)))
    groups, cells = tree_groups(items, TREE_TERMS), TREE_CELLS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc, n, own, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           batch.column(2), batch.column(3)):
                at = place[own.values.to_numpy()]
                sort = np.argsort(at)
                yield doc, n, at[sort], counts.values.to_numpy()[sort]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = best_in_trees(rows(batches), groups, documents, total, k, cells)
        flat = [(names[at], None if null else doc, -score) for at, own in found.items() for score, null, doc in own]
        if flat:
            yield pa.RecordBatch.from_pylist([dict(zip(("item", "doc", "score"), row)) for row in flat], schema=arrow)
    return Stored(vectors.mapInArrow(of, schema), "term-best").df


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score`` (named as the keys are): the ``k`` best documents of each item, best first."""
    asked = Stored(item_terms(items, item_key, item_text), "item-terms").df
    blocks = max(1, -(-asked.count() // BLOCK_TERMS))
    number = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for b in range(blocks):
        best = _block_best(docs, asked.where(number == b), key, text, k)
        found = best if found is None else found.unionByName(best)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
