"""Largest inner products by multiprobe p-stable hashing.

Vectors of a dimension are scaled by the largest norm M and get one more component that makes all norms M, so that the largest
inner product becomes the smallest Euclidean distance.  A table cuts ``cuts`` Gaussian projections into slots of
``width`` * M; a query visits its own bucket and then those next to it, in the order of how likely a
near vector fell there (the query's distances to the slot borders, in the fixed order of expected success).

* Equal vectors are one class: an answer holds at most ``top`` + 1 ids of it, the smallest.
* The number of probes is fitted on a bounded sample of ``sample`` vectors until it finds ``aim`` of the true
  neighbours there; every vector is indexed.  Sampled neighbours lie farther apart than those of all rows, so recall is higher.
  A dimension in which ``MOST_PROBES`` do not reach the aim is searched exactly: it has one bucket, whose grid of cells
  holds all members and all queries, in blocks.
* Bucket members and the queries that visit them meet in cells of at most ``cell`` members times ``cell`` queries: a crowded
  bucket is split into a grid, so no key grows with the data.  Queries are dealt out to slices of about ``SLICE_QUERIES``, and a task sees
  the queries of one slice and ``PART_ROWS`` members on average.
* A cell is scored by a matrix product, which keeps the best of each query with room for rounding.  Those are scored
  again one by one, in an order of summation that depends on the dimension alone, so equal pairs have equal scores
  wherever they meet; these scores rank and are returned.

Defined cases: null vectors, zero vectors and those with null or non-finite components take no part; vectors of different
lengths are never compared; equal scores go to the smaller id; repeated rows are one candidate; an id with several vectors has
each of them as a candidate and, if it is a query, answers for each; empty tables have no output; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.llm.common import Stored

TABLES, CUTS, WIDTH, SEED = 4, 8, 2.5, 11
TOP, SAMPLE, AIM, MOST_PROBES = 20, 4000, 0.95, 1500
CELL, PART_ROWS, SLICE_QUERIES = 4096, 20_000, 50_000


def perturbations(cuts: int, count: int) -> list[tuple[int, ...]]:
    """Sets of places in a query's order of border distances, most promising first.

    Place j stands for the j-th nearest border; j and 2 * cuts + 1 - j are the two sides of one projection.
    """
    m = cuts
    expected = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else
                1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
                for j in range(1, 2 * m + 1)]

    def cost(places):
        return sum(expected[j - 1] for j in places)

    out, heap = [()], [(cost((1,)), (1,))]
    while heap and len(out) < count:
        _, places = heapq.heappop(heap)
        if all(2 * m + 1 - j not in places for j in places):
            out.append(places)
        last = places[-1]
        if last < 2 * m:
            for following in (places[:-1] + (last + 1,), places + (last + 1,)):
                heapq.heappush(heap, (cost(following), following))
    return out


@dataclass
class Tables:
    """Projections of one dimension: ``a`` is (tables, dimension + 1, cuts); slots are ``width`` wide."""

    dimension: int
    norm: float
    probes: int = MOST_PROBES
    tables: int = TABLES
    cuts: int = CUTS
    width: float = WIDTH
    seed: int = SEED
    exact: bool = False

    def __post_init__(self):
        rng = np.random.default_rng([self.seed, self.dimension])
        self.a = rng.normal(size=(self.tables, self.dimension + 1, self.cuts))
        self.shift = rng.uniform(0, self.width, size=(self.tables, self.cuts))
        self.mixer = rng.integers(1, 1 << 62, size=self.cuts, dtype=np.int64) | 1

    def _slots(self, x: np.ndarray, table: int) -> np.ndarray:
        return (x @ self.a[table] + self.shift[table]) / self.width

    def _keys(self, slots: np.ndarray) -> np.ndarray:
        return (slots.astype(np.int64) * self.mixer).sum(axis=-1)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table; an exact search has one of either."""
        if self.exact:
            return np.zeros((len(vectors), 1), np.int64)
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        x = np.column_stack([scaled, rest])
        return np.stack([self._keys(np.floor(self._slots(x, t))) for t in range(self.tables)], axis=1)

    def probe(self, queries: np.ndarray, probes: int | None = None) -> np.ndarray:
        """Buckets that each query visits, (query, table, probe), in order."""
        if self.exact:
            return np.zeros((len(queries), 1, 1), np.int64)
        scaled = queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        x = np.column_stack([scaled, np.zeros(len(queries))])
        sets = perturbations(self.cuts, probes or self.probes)
        out = np.empty((len(queries), self.tables, len(sets)), np.int64)
        rows = np.arange(len(queries))
        for t in range(self.tables):
            place = self._slots(x, t)
            base = np.floor(place)
            fraction = place - base
            order = np.argsort(np.concatenate([fraction, 1 - fraction], axis=1), axis=1, kind="stable")
            for p, chosen in enumerate(sets):
                moved = base.copy()
                for j in chosen:
                    side = order[:, j - 1]
                    moved[rows, side % self.cuts] += np.where(side < self.cuts, -1, 1)
                out[:, t, p] = self._keys(moved)
        return out


def fitted(vectors: np.ndarray, norm: float, top: int = TOP, aim: float = AIM, most: int = MOST_PROBES) -> Tables:
    """Tables whose number of probes finds ``aim`` of the ``top`` nearest of a sample, or exact ones if ``most`` probes do not."""
    tables = Tables(vectors.shape[1], norm, most)
    asked = vectors[:: max(1, len(vectors) // 64)][:64]
    scores = asked @ vectors.T
    nearest = np.argsort(-scores, axis=1, kind="stable")[:, :min(top + 1, len(vectors))]
    own, visited = tables.buckets(vectors), tables.probe(asked)
    # The first probe, over all tables, at which each true neighbour is found.
    needed = np.full(nearest.shape, tables.probes + 1)
    for q in range(len(asked)):
        for t in range(tables.tables):
            first = {}
            for p, bucket in enumerate(visited[q, t].tolist()):
                first.setdefault(bucket, p + 1)
            found = np.array([first.get(b, tables.probes + 1) for b in own[nearest[q], t].tolist()])
            needed[q] = np.minimum(needed[q], found)
    probes = int(np.quantile(needed, aim, method="higher"))
    tables.exact, tables.probes = probes > most, min(probes, most)
    return tables


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """``cid, ids, vec``: equal vectors with their ``most`` smallest ids; ids are thinned in the tasks first."""
    kind = dict(rows.dtypes)["vec"]

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[bytes, list[tuple[int, int]]] = {}
            ids = batch.column(0).to_pylist()
            for i, v in enumerate(batch.column(1)):
                groups.setdefault(v.values.to_numpy().tobytes(), []).append((ids[i], i))
            keep = sorted(i for g in groups.values() for _, i in (g if len(g) <= most else sorted(g)[:most]))
            yield batch.take(pa.array(keep, pa.int64()))

    thinned = rows.mapInArrow(thin, f"id bigint, vec {kind}")
    ids = F.slice(F.sort_array(F.collect_set("id")), 1, most)
    return thinned.groupBy("vec").agg(ids.alias("ids")).select(F.col("ids")[0].alias("cid"), "ids", "vec", F.size("vec").alias("n"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _best(qids: np.ndarray, cids: np.ndarray, score: np.ndarray, top: int, slack: float = 0.0) -> np.ndarray:
    """Places of the ``top`` best members of each query, and with ``slack`` of those that are lower by no more than that; a pair counts once."""
    order = np.lexsort((cids, qids))
    q, c = qids[order], cids[order]
    order = order[np.append(np.ones(min(1, len(q)), bool), (q[1:] != q[:-1]) | (c[1:] != c[:-1]))]
    order = order[np.lexsort((cids[order], -score[order], qids[order]))]
    q, held = qids[order], score[order]
    begin, end = np.searchsorted(q, q, "left"), np.searchsorted(q, q, "right")
    if slack:
        return order[held >= held[np.minimum(begin + top, end) - 1] - slack]
    return order[np.arange(len(q)) - begin < top]


def products(left: np.ndarray, right: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Inner products of rows ``at`` and ``to``; each depends on its two vectors alone."""
    out = np.empty(len(at))
    for i in range(0, len(at), 16_384):
        out[i:i + 16_384] = (left[at[i:i + 16_384]] * right[to[i:i + 16_384]]).sum(axis=1)
    return out


def _scored(left: pd.DataFrame, right: pd.DataFrame, top: int) -> pd.DataFrame:
    """Best members per query in the cells of one part; ``left`` has members, ``right`` the queries with their cells."""
    sizes = left["vec"].map(len), right["vec"].map(len)
    parts = [_scored_alike(left[sizes[0] == n], right[sizes[1] == n], top) for n in sorted(set(sizes[0]) & set(sizes[1]))]
    return pd.concat(parts) if parts else _scored_alike(left[:0], right[:0], top)


def _scored_alike(left: pd.DataFrame, right: pd.DataFrame, top: int) -> pd.DataFrame:
    """The same for vectors of one length."""
    if not len(left) or not len(right):
        return pd.DataFrame({"qid": np.zeros(0, np.int64), "cid": np.zeros(0, np.int64), "score": np.zeros(0)})
    left = left.sort_values("cell", kind="stable")
    cells, begin = np.unique(left["cell"].to_numpy(), return_index=True)
    end = np.append(begin[1:], len(left))
    members, ids = np.array(left["vec"].tolist(), np.float64), left["cid"].to_numpy()
    queries, qids = np.array(right["vec"].tolist(), np.float64), right["qid"].to_numpy()
    asked = np.concatenate(right["cells"].tolist())
    owner = np.repeat(np.arange(len(right)), [len(c) for c in right["cells"]])
    order = np.argsort(asked, kind="stable")
    asked, owner = asked[order], owner[order]
    # Two sums of the same n products differ by less than this.
    longest = [np.sqrt((x * x).sum(axis=1).max()) for x in (members, queries)]
    slack = 4 * members.shape[1] * np.finfo(float).eps * longest[0] * longest[1]
    # Places of queries and members, and their scores: those kept, and those since the last merge.
    out: list[list[np.ndarray]] = [[], [], []]

    def merge() -> None:
        q, m, score = (np.concatenate(o) for o in out)
        near = _best(qids[q], ids[m], score, top, slack)
        q, m = q[near], m[near]
        score = products(queries, members, q, m)
        best = _best(qids[q], ids[m], score, top)
        out[:] = [[q[best]], [m[best]], [score[best]]]

    held = 0
    for cell, a, b in zip(cells, begin, end):
        rows = owner[np.searchsorted(asked, cell, "left"):np.searchsorted(asked, cell, "right")]
        if not len(rows):
            continue
        scores = queries[rows] @ members[a:b].T
        if b - a > top:
            least = np.partition(scores, b - a - top, axis=1)[:, b - a - top]
            q, m = np.nonzero(scores >= least[:, None] - slack)
        else:
            q, m = np.divmod(np.arange(scores.size), b - a)
        for o, x in zip(out, (rows[q], a + m, scores[q, m])):
            o.append(x)
        held += len(q)
        if held > 2_000_000:
            merge()
            held = len(out[0][0])
    if not out[0]:
        return _scored_alike(left[:0], right[:0], top)
    merge()
    return pd.DataFrame({"qid": qids[out[0][0]], "cid": ids[out[1][0]], "score": out[2][0]})


def _fit_all(classes: DataFrame, top: int, sample: int, aim: float, most: int) -> dict[int, Tables]:
    """Fitted tables of each dimension; a bounded sample of vectors reaches the driver."""
    squared = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norms = classes.groupBy("n").agg(F.max(F.sqrt(squared)).alias("norm"))
    out = {}
    for n, norm in norms.collect():
        rows = classes.where(F.col("n") == n).orderBy(F.xxhash64("cid"), "cid").limit(sample).select("vec").collect()
        out[n] = fitted(np.array([r[0] for r in rows], np.float64), norm, top, aim, most)
    return out


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", asks: Column | None = None, top: int = TOP,
            sample: int = SAMPLE, aim: float = AIM, cell: int = CELL, most_probes: int = MOST_PROBES,
            slice_queries: int = SLICE_QUERIES) -> DataFrame:
    """``query_id, rank, key, score``: the ``top`` largest inner products of the rows for which ``asks`` holds.

    A row is never its own answer.  ``asks`` is a condition on the key, by default all rows ask.
    """
    asks = F.lit(True) if asks is None else asks
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"), asks.alias("asks"))
    most = top + 1
    classes = Stored(_classes(rows.select("id", "vec"), most), "lsh-classes").df
    asking = rows.where("asks").select("id", "vec")
    queries = Stored(asking.distinct().join(classes.select("vec", "cid"), "vec").select("id", "cid"), "lsh-queries").df
    spark = vectors.sparkSession
    kind = dict(rows.dtypes)["vec"]
    tables = spark.sparkContext.broadcast(_fit_all(classes, top, sample, aim, most_probes))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                own, t = tables.value[int(n)].buckets(_matrix(batch.column(1).take(pa.array(at)))), tables.value[int(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(own.shape[1]) + 1000 * int(n), len(at))), pa.array(own.T.ravel()),
                     *[batch.column(i).take(pa.array(np.tile(at, own.shape[1]))) for i in (0, 1)]], names=["tab", "bucket", "cid", "vec"])

    members = classes.select("cid", "vec", "n").mapInArrow(index, f"tab bigint, bucket bigint, cid bigint, vec {kind}")
    members = Stored(members, "lsh-members").df
    asked = classes.join(queries.select("cid").distinct(), "cid").select("cid", "vec", "n")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for n in np.unique(sizes):
                at, t = np.flatnonzero(sizes == n), tables.value[int(n)]
                ids = batch.column(0).to_numpy()
                for i in range(0, len(at), 512):
                    some = at[i:i + 512]
                    buckets = t.probe(_matrix(batch.column(1).take(pa.array(some))))
                    q, tab, _ = np.indices(buckets.shape)
                    yield pa.RecordBatch.from_arrays([pa.array((tab + 1000 * int(n)).ravel()), pa.array(buckets.ravel()),
                                                      pa.array(ids[some][q.ravel()])], names=["tab", "bucket", "qid"])

    slices = max(1, math.ceil(queries.count() / slice_queries))
    visits = asked.mapInArrow(visit, "tab bigint, bucket bigint, qid bigint")
    visits = Stored(visits.withColumn("slice", F.pmod(F.xxhash64("qid"), F.lit(slices))), "lsh-visits").df
    # How often a bucket is split: one row per bucket that has members and slice of queries that visit it.
    grid = (members.groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("_m"))
            .join(visits.groupBy("tab", "bucket", "slice").agg(F.count(F.lit(1)).alias("_q")), ["tab", "bucket"])
            .select("tab", "bucket", "slice", F.ceil(F.col("_m") / cell).cast("int").alias("ms"),
                    F.ceil(F.col("_q") / cell).cast("int").alias("qs")))
    grid = Stored(grid, "lsh-grid").df
    total = members.count()
    # A part returns the best of each query that visits it, so parts of a slice follow the size of the index alone.
    parts = max(1, math.ceil(total / PART_ROWS))

    def placed(df: DataFrame, key_: str, mine: str, other: str) -> DataFrame:
        # Queries meet the cells of their own slice, members those of every slice that visits them.
        spread = df.join(grid, [c for c in ("tab", "bucket", "slice") if c in df.columns])
        # Other bits of the hash than those that choose the slice.
        spread = spread.withColumn("_own", F.pmod(F.xxhash64(key_, F.lit("cell")), F.col(mine)))
        spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        place = ("_own", "_other") if mine == "ms" else ("_other", "_own")
        return (spread.withColumn("cell", F.xxhash64("tab", "bucket", "slice", *[F.col(p).cast("long") for p in place]))
                .withColumn("part", F.pmod("cell", F.lit(parts))))

    left = placed(members, "cid", "ms", "qs").select("slice", "part", "cell", "cid", "vec")
    right = (placed(visits, "qid", "qs", "ms").groupBy("slice", "part", "qid").agg(F.collect_set("cell").alias("cells"))
             .join(asked.select(F.col("cid").alias("qid"), "vec"), "qid"))
    scored = left.groupBy("slice", "part").cogroup(right.groupBy("slice", "part")).applyInPandas(
        lambda a, b: _scored(a, b, most), "qid bigint, cid bigint, score double")
    by_score = W.partitionBy("qid").orderBy(F.col("score").desc(), "cid")
    best = (scored.groupBy("qid", "cid").agg(F.max("score").alias("score"))
            .withColumn("_r", F.row_number().over(by_score)).where(F.col("_r") <= most))
    ids = best.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("id"))
    by_id = W.partitionBy("qid").orderBy(F.col("score").desc(), "id")
    # At most one row per class of queries: its answers, of which a query leaves out itself.
    answers = (ids.withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= most)
               .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("_r", "id", "score"))).alias("found")))
    own = queries.select(F.col("id").alias("query_id"), F.col("cid").alias("qid")).join(answers, "qid")
    mine = F.slice(F.filter("found", lambda a: a["id"] != F.col("query_id")), 1, top)
    return (own.select("query_id", F.posexplode(mine).alias("_p", "_a"))
            .select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_a.id").alias(key), F.col("_a.score").alias("score")))

