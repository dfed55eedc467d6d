"""Nearest neighbours by cosine: a vantage-point tree per shard.

Vectors are brought to length one, where the cosine order is the order of
Euclidean distance, which keeps the triangle inequality. A node holds a vantage
point, the half of its rows that is nearer to it and the half that is farther.
A half is left out if the inequality says that none of its rows can be nearer
than the k-th found so far; that distance is first divided by ``factor``. Factor
one leaves out nothing that counts, so the search is exact; larger ones leave
out more.

Shards of at most ``shard_rows`` rows are built where the rows lie, every row
in one, and stored as one row each in the shared folder. Queries are a stated
set; they reach the shards in blocks of at most ``block_rows``, one broadcast at
a time. All queries of a block walk a tree together. Per query and shard k rows
are shuffled.

Defined cases: vectors that are null, empty, zero, or hold a null, NaN or
infinity, and rows without id, take no part. Vectors of other lengths are no
candidates of a query. Every vector that rounding cannot tell from the k-th is
scored in doubles before the cut, however many there are. Equal vectors of a shard are one point with its smallest
ids, k + 1 of them, as more can never be among the k nearest. Rows that repeat id
and vector count once, and no row finds its own id. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store

LEAF = 256
WALK = 2048  # queries that walk a tree together
PAIRS = 50_000  # scored at a time
SHARD = "dim int, n long, ids binary, starts binary, vectors binary, inner binary, outer binary"


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v"))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow on the way
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def split_at(a: int, b: int) -> int:
    """Where the farther half of node [a, b) starts; a itself is the vantage point."""
    return a + 1 + (b - a - 1) // 2


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows in the tree, and by node start the largest distance of the nearer and the smallest of the farther half."""
    x = unit(vectors)
    order, inner, outer = np.arange(len(x)), np.zeros(len(x)), np.zeros(len(x))
    todo = [(0, len(x))]
    while todo:
        a, b = todo.pop()
        if b - a <= LEAF:
            continue
        far = a + int(np.argmin(x[order[a:b]] @ x[order[a]]))  # an outer point separates best
        order[[a, far]] = order[[far, a]]
        d = np.linalg.norm(x[order[a + 1:b]] - x[order[a]], axis=1)
        m = split_at(a, b)
        by = np.argsort(d, kind="stable")
        order[a + 1:b] = order[a + 1:b][by]
        inner[a], outer[a] = d[by[m - a - 2]], d[by[m - a - 1]]
        todo += [(a + 1, m), (m, b)]
    return order, inner, outer


#: More than what rounding moves a cosine of unit vectors, for each dimension and besides.
ROUNDING = 1e-15


class Search:
    """All queries of a block in one tree."""

    def __init__(self, points: np.ndarray, inner: np.ndarray, outer: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.x, self.q, self.inner, self.outer, self.k, self.factor = points, queries, inner, outer, k, factor
        self.near = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), -1)
        self.margin = 16 * ROUNDING * (points.shape[1] + 8)  # of squared distances
        self.close: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query, point and squared distance of all that may be among the nearest
        self.held = self.limit = 0
        self.measured = 0

    def look(self, who: np.ndarray, a: int, b: int) -> np.ndarray:
        """Distances of queries to points [a, b); the nearest k are kept, and all that rounding cannot tell from the last of them."""
        square = np.maximum(0, 2 - 2 * (self.q[who] @ self.x[a:b].T))
        d = np.sqrt(square)
        self.measured += d.size
        # most leaves hold nothing nearer than what is known
        nearer = np.flatnonzero(d.min(axis=1) < self.near[who, -1])
        if len(nearer):
            some, closer = who[nearer], d[nearer]
            both = np.concatenate((self.near[some], closer), axis=1)
            at = np.concatenate((self.found[some], np.broadcast_to(np.arange(a, b), closer.shape)), axis=1)
            best = np.argsort(both, axis=1, kind="stable")[:, :self.k]
            self.near[some], self.found[some] = np.take_along_axis(both, best, 1), np.take_along_axis(at, best, 1)
        row, place = np.nonzero(square <= self.reach2(who)[:, None])
        if len(row):
            self.close.append((who[row], a + place, square[row, place]))
            self.held += len(row)
            if self.held > self.limit:
                self.shrink()
        return d

    def reach2(self, who: np.ndarray) -> np.ndarray:
        return self.near[who, -1] ** 2 + self.margin

    def shrink(self) -> tuple[np.ndarray, np.ndarray]:
        """Queries and points that may still be among the nearest."""
        if self.close:
            who, point, square = map(np.concatenate, zip(*self.close))
            keep = square <= self.reach2(who)
            self.close = [(who[keep], point[keep], square[keep])]
            self.held = int(keep.sum())
            self.limit = 2 * self.held + 1_000_000
            return self.close[0][:2]
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def walk(self, who: np.ndarray, a: int, b: int) -> None:
        if not len(who) or a >= b:
            return
        if b - a <= LEAF:
            self.look(who, a, b)
            return
        d = self.look(who, a, a + 1)[:, 0]
        m, inner, outer = split_at(a, b), self.inner[a], self.outer[a]
        first = d <= (inner + outer) / 2
        self.walk(who[first], a + 1, m)
        self.walk(who[~first], m, b)
        # rounding: a squared distance is off by the margin, so a short distance by its root
        off = np.sqrt(self.margin)
        reach = np.sqrt(self.reach2(who)) / self.factor + 2 * off
        self.walk(who[first & (outer - d <= reach)], m, b)
        self.walk(who[~first & (d - inner <= reach)], a + 1, m)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in doubles; summed one dimension after the other, so that equal rows give equal scores wherever they lie."""
    def dot(u, v):
        total = np.zeros(len(u))
        for d in range(u.shape[1]):
            total += u[:, d] * v[:, d]
        return total

    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        c = dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))
    bad = ~np.isfinite(c)
    if bad.any():
        c[bad] = dot(unit(x[bad]), unit(y[bad]))
    return c


def score(who: np.ndarray, point: np.ndarray, own: np.ndarray, q: np.ndarray, x: np.ndarray, ids: np.ndarray, starts: np.ndarray, k: int):
    """The k best rows of each query among its close points, a limited number of pairs at a time and no query cut in two."""
    by = np.argsort(who, kind="stable")
    who, point = who[by], point[by]
    a = 0
    while a < len(who):
        b = int(np.searchsorted(who, who[min(a + PAIRS, len(who)) - 1], "right"))
        one, p = who[a:b], point[a:b]
        a = b
        value = cosine(q[one], x[p])
        size = starts[p + 1] - starts[p]
        at = np.repeat(starts[p] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        one, value, vec = np.repeat(one, size), np.repeat(value, size), ids[at]
        other = vec != own[one]
        one, value, vec = one[other], value[other], vec[other]
        order = np.lexsort((vec, -value, one))
        one, value, vec = one[order], value[order], vec[order]
        keep = np.arange(len(one)) - np.searchsorted(one, one) < k
        yield pa.RecordBatch.from_arrays([pa.array(own[one[keep]]), pa.array(vec[keep]), pa.array(value[keep])], ["query_id", "vec_id", "score"])


def pack_shard(ids: np.ndarray, vectors: np.ndarray, k: int) -> pa.RecordBatch:
    # equal vectors become one point with its smallest ids
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    fresh = np.append(True, (vectors[1:] != vectors[:-1]).any(axis=1))
    group = np.cumsum(fresh) - 1
    once = np.append(True, (group[1:] != group[:-1]) | (ids[1:] != ids[:-1]))
    ids, group, points = ids[once], group[once], vectors[fresh]
    nth = np.arange(len(ids)) - np.searchsorted(group, group)
    ids, group = ids[nth <= k], group[nth <= k]
    tree, inner, outer = build(points)
    sizes = np.bincount(group, minlength=len(points))
    starts = np.concatenate(([0], np.cumsum(sizes[tree])))
    begin = np.cumsum(sizes) - sizes
    ids = ids[np.repeat(begin[tree] - starts[:-1], sizes[tree]) + np.arange(starts[-1])]
    cells = [ids.astype("<i8"), starts.astype("<i8"), points[tree].astype("<f8"), inner, outer]
    return pa.RecordBatch.from_arrays([pa.array([points.shape[1]], pa.int32()), pa.array([len(points)], pa.int64()),
                                       *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                                      ["dim", "n", "ids", "starts", "vectors", "inner", "outer"])


def index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, shard_rows: int = 8192) -> DataFrame:
    """A stored row for each shard: the points in tree order, their ids, and the radii."""
    def gather(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v")):
                v = v.values.to_numpy()
                part = held.setdefault(len(v), [])
                part.append((i, v))
                if len(part) >= shard_rows:
                    yield pack_shard(np.array([i for i, _ in part]), np.stack([v for _, v in part]), k)
                    part.clear()
        for part in held.values():
            if part:
                yield pack_shard(np.array([i for i, _ in part]), np.stack([v for _, v in part]), k)

    return store(map_batches(usable(rows, id_col, vector_col), gather, SHARD), "vp-shards")


def query_blocks(queries: DataFrame, block_rows: int):
    block = []
    for r in queries.toLocalIterator():
        block.append((r.id, r.v))
        if len(block) == block_rows:
            yield block
            block = []
    if block:
        yield block


def nearest(shards: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, factor: float = 1.0,
            block_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: for every query its k nearest rows other than itself, ties to the smaller id."""
    spark, found = shards.sparkSession, None
    for n, block in enumerate(query_blocks(usable(queries, id_col, vector_col).distinct(), block_rows)):
        shared = spark.sparkContext.broadcast(block)

        def look(batches, shared=shared):
            block = shared.value
            asked: dict[int, list] = {}
            for i, v in block:
                asked.setdefault(len(v), []).append((i, v))
            asked = {d: (np.array([i for i, _ in p]), np.array([v for _, v in p], float)) for d, p in asked.items()}
            for batch in batches:
                for shard in batch.to_pylist():
                    if shard["dim"] not in asked:
                        continue
                    own, q = asked[shard["dim"]]
                    x = np.frombuffer(shard["vectors"], "<f8").reshape(-1, shard["dim"])
                    ids, starts = np.frombuffer(shard["ids"], "<i8"), np.frombuffer(shard["starts"], "<i8")
                    inner, outer = np.frombuffer(shard["inner"]), np.frombuffer(shard["outer"])
                    near = unit(x)
                    for at in range(0, len(q), WALK):
                        # one point may be the query itself; all that rounding cannot tell from the last are compared exactly
                        s = Search(near, inner, outer, unit(q[at:at + WALK]), min(k + 1, len(x)), factor)
                        s.walk(np.arange(len(s.q)), 0, len(x))
                        yield from score(*s.shrink(), own[at:at + WALK], q[at:at + WALK], x, ids, starts, k)

        part = store(map_batches(shards, look, "query_id long, vec_id long, score double"), "vp-found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.range(0).selectExpr("id AS query_id", "0 AS rank", "id AS vec_id", "0D AS score")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
