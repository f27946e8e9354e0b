"""Exact top-k search by inner product with KD-trees, one per shard.

Vectors become integers, floor(256 * x) of each component. Space is cut into cells by a tree of
median cuts, placed on a bounded sample of the vectors (``SAMPLE``); every vector walks the cuts to
its cell, and a cell of more than ``SHARD`` rows is dealt into several shards by a hash, so neither
a dense region nor a vector that many rows share fills one task. Each shard is a KD-tree: median
splits of the widest dimension, with tight bounding boxes. A query walks a tree best node first; a
node's bound is the largest inner product that its box allows, and the walk ends when no bound can
beat the kth score so far.

Queries first walk the shard they live in. The kth (score, id) found there travels with them, and
they are sent on only to cells whose tight box can still beat it; there only better rows are
returned. How much that prunes is up to the data: clusters that lie apart are skipped, while in many
dimensions without clusters every box reaches the kth score and every cell is asked.

The queries are a stated set against all rows, in blocks of ``BLOCK``: a task holds one shard
and one block, and a shard's rows go only to the blocks that ask it. A vector that many rows share
is one point of the tree with its k + 1 smallest ids, which is exact (no more can be among the best
k of any query).

Defined results: rows whose id is null, or whose vector is null or holds a null or non-finite
component, take no part; rows that repeat an id and a vector count once; an id is no candidate
for itself; an id with several vectors queries with each, ranked together; vectors of different
lengths do not meet; ties go to the smaller id; with fewer rows than k all are returned. Scores
must fit 64 bits. No rows give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import tidy, written

SHARD = 8192
BLOCK = 4096
LEAF = 128

#: Cells at most, and vectors sampled to place their cuts.
CELLS = 4096
SAMPLE = 20_000

RESULT = "query_id long, vec_id long, score long"


class Cells:
    """Median cuts of sampled vectors: node -> (axis, value, left, right); a leaf's axis is -1 and its
    ``left`` the cell's number. ``first``: the number of the first cell."""

    def __init__(self, sample: np.ndarray, cells: int, first: int):
        self.nodes: list[tuple[int, int, int, int]] = []
        self.first = self.stop = first
        self._cut(sample, cells)
        self.table = np.array(self.nodes, np.int64)

    def _cut(self, part: np.ndarray, cells: int) -> int:
        node = len(self.nodes)
        self.nodes.append((-1, 0, self.stop, 0))
        if cells > 1 and len(part) > 1 and part.shape[1]:
            axis = int((part.max(0) - part.min(0)).argmax())
            value = int(np.partition(part[:, axis], len(part) // 2)[len(part) // 2])
            left = part[:, axis] < value
            if left.any():
                a = self._cut(part[left], cells // 2)
                b = self._cut(part[~left], cells - cells // 2)
                self.nodes[node] = (axis, value, a, b)
                return node
        self.stop += 1
        return node

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector."""
        at = np.zeros(len(vectors), np.int64)
        while True:
            axis, value, left, right = self.table[at].T
            inner = np.flatnonzero(axis >= 0)
            if not len(inner):
                return left
            goes = vectors[inner, axis[inner]] < value[inner]
            at[inner] = np.where(goes, left[inner], right[inner])


class Tree:
    """A KD-tree over distinct integer vectors; ``ids``: up to k + 1 smallest ids of each."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, k: int):
        order = np.lexsort((ids, *vectors.T[::-1])) if vectors.shape[1] else np.argsort(ids)
        vectors, ids = vectors[order], ids[order]
        new = np.append(True, (vectors[1:] != vectors[:-1]).any(1))[: len(ids)]
        same_row = np.append(False, ~new[1:] & (ids[1:] == ids[:-1]))[: len(ids)]
        vectors, ids, new = vectors[~same_row], ids[~same_row], new[~same_row]
        begin = np.flatnonzero(new)
        self.points = vectors[begin]
        stop = np.append(begin[1:], len(ids))
        self.ids = [ids[a : min(b, a + k + 1)].tolist() for a, b in zip(begin, stop, strict=True)]
        self.first = ids[begin]
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.least: list[int] = []  # smallest id below a node
        self.below: list[tuple[int, int] | np.ndarray] = []
        if len(begin):
            self._build(np.arange(len(begin)))
        self.lo_all, self.hi_all = np.array(self.lo), np.array(self.hi)

    def _build(self, rows: np.ndarray) -> int:
        part = self.points[rows]
        node = len(self.lo)
        self.lo.append(part.min(0))
        self.hi.append(part.max(0))
        self.least.append(int(self.first[rows].min()))
        self.below.append(rows)
        if len(rows) > LEAF:
            widest = int((self.hi[node] - self.lo[node]).argmax())
            half = np.argpartition(part[:, widest], len(rows) // 2)
            a = self._build(rows[half[: len(rows) // 2]])
            b = self._build(rows[half[len(rows) // 2 :]])
            self.below[node] = (a, b)
        return node

    def search(self, queries: np.ndarray, query_ids: list[int], bounds: list[tuple[int, int] | None], k: int) -> Iterator[tuple[int, int, int]]:
        """(query id, id, score): up to k rows of this shard per query that beat its bound, a
        (score, id) that the kth best so far has."""
        if not len(self.points) or not len(queries):
            return
        exact = float(np.abs(queries).max(initial=0)) * float(np.abs(self.points).max(initial=0)) * max(1, queries.shape[1]) < 2**53
        kind = np.float64 if exact else np.int64
        q, points = queries.astype(kind), self.points.astype(kind)
        above = (np.maximum(q, 0) @ self.hi_all.T.astype(kind) + np.minimum(q, 0) @ self.lo_all.T.astype(kind)).astype(np.int64)
        for row, own in enumerate(query_ids):
            best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
            floor = bounds[row]
            limit = (floor[0], -floor[1]) if floor is not None else None
            bound = above[row].tolist()
            heap = [(-bound[0], 0)]
            while heap:
                up, node = heapq.heappop(heap)
                if limit is not None and -up < limit[0]:
                    break  # nothing left can reach the kth score
                if limit is not None and (-up, -self.least[node]) < limit:
                    continue  # it may tie, with larger ids only
                below = self.below[node]
                if isinstance(below, tuple):
                    for child in below:
                        heapq.heappush(heap, (-bound[child], child))
                    continue
                scores = (points[below] @ q[row]).astype(np.int64)
                hits = np.flatnonzero(scores >= limit[0]) if limit is not None else np.arange(len(below))
                for at in hits.tolist():
                    score = int(scores[at])
                    for i in self.ids[below[at]]:
                        if i == own:
                            continue
                        if limit is not None and (score, -i) <= limit:
                            break
                        heapq.heappush(best, (score, -i))
                        if len(best) > k:
                            heapq.heappop(best)
                        if len(best) == k and (limit is None or best[0] > limit):
                            limit = best[0]
            for score, i in best:
                yield own, -i, score


def quantised(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, dim, q): the integer vector as 64-bit little-endian bytes."""

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", finite))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = batch.column(1)
            offs = np.asarray(e.offsets)
            flat = np.floor(256 * np.asarray(e.values, np.float64)).astype("<i8")
            data = [flat[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs).astype(np.int32)), pa.array(data, pa.binary())], ["vec_id", "dim", "q"])

    return rows.mapInArrow(run, "vec_id long, dim int, q binary")


def _matrix(column: pd.Series) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return np.frombuffer(b"".join(column), "<i8").astype(np.int64).reshape(len(column), -1)


def _cells(rows: DataFrame, n: int) -> dict[int, Cells]:
    """The cuts for each vector length that the sample holds (bounded: ``SAMPLE`` rows on average)."""
    wanted = min(CELLS, math.ceil(n / SHARD))
    if wanted < 2:
        return {}
    part = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE / n) * (1 << 30)))
    sample = rows.where(part).select("dim", "q").toPandas()
    out, first = {}, 0
    for dim, group in sample.groupby("dim"):
        out[int(dim)] = Cells(_matrix(group["q"]), max(1, round(wanted * len(group) / len(sample))), first)
        first = out[int(dim)].stop
    return out


def with_cells(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """``rows`` with the cell of each vector; -1 for lengths that the sample did not hold."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, q = np.asarray(batch.column(1)), batch.column(2).to_pylist()
            cell = np.full(len(dim), -1, np.int64)
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                if d in cells:
                    cell[at] = cells[d].of(_matrix(pd.Series([q[i] for i in at.tolist()])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["vec_id", "dim", "q", "cell"])

    return rows.select("vec_id", "dim", "q").mapInArrow(run, "vec_id long, dim int, q binary, cell long")


def _merged_boxes(group: pd.DataFrame) -> pd.DataFrame:
    lo, hi = _matrix(group["lo"]).min(0), _matrix(group["hi"]).max(0)
    return pd.DataFrame({"cell": group["cell"].iloc[:1], "dim": group["dim"].iloc[:1], "lo": [lo.astype("<i8").tobytes()], "hi": [hi.astype("<i8").tobytes()]})


def reachable(asked: DataFrame, boxes: pd.DataFrame) -> DataFrame:
    """(vec_id, dim, q, kth, cell): each query with the cells whose box can beat its kth score, and
    cell -1, whose lengths have no boxes. ``boxes``: cell, dim, lo, hi, one row per cell."""
    by_dim = {int(d): (g["cell"].to_numpy(), _matrix(g["lo"]), _matrix(g["hi"])) for d, g in boxes.groupby("dim")}

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, qs, kths = (c.to_pylist() for c in batch.columns)
            for i in range(batch.num_rows):
                cells = np.array([-1], np.int64)
                if dims[i] in by_dim:
                    number, lo, hi = by_dim[dims[i]]
                    q = np.frombuffer(qs[i], "<i8").astype(np.int64)
                    above = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
                    cells = number if not kths[i] else number[above >= int(kths[i].split()[0])]
                n = len(cells)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]] * n, pa.int64()), pa.array([dims[i]] * n, pa.int32()), pa.array([qs[i]] * n, pa.binary()), pa.array([kths[i]] * n, pa.string()), pa.array(cells, pa.int64())],
                    ["vec_id", "dim", "q", "kth", "cell"],
                )

    return asked.select("vec_id", "dim", "q", "kth").mapInArrow(run, "vec_id long, dim int, q binary, kth string, cell long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows. ``is_query``: a condition on vec_id."""
    return plan(vectors, is_query, k, vec_id, embedding)[0]


def plan(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """The result of ``top_k``, and which shards each query is sent to besides its own (vec_id, dim,
    q, kth, block, cell, sub)."""
    rows = written(quantised(vectors, vec_id, embedding).dropDuplicates(["vec_id", "q"]), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks = max(1, math.ceil(counts["q"] / BLOCK))
    rows = written(with_cells(rows, _cells(rows, counts["n"])), "cells")
    full = {r["cell"]: math.ceil(r["n"] / SHARD) for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row per cell
    subs = F.expr("map(" + ", ".join(f"{c}L, {n}" for c, n in full.items()) + ")") if full else F.create_map(F.lit(0).cast("long"), F.lit(1))
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("vec_id", "q"), subs[F.col("cell")]).cast("int"))

    @tidy
    def at_home(group: pd.DataFrame) -> pd.DataFrame:
        points = _matrix(group["q"])
        tree = Tree(points, group["vec_id"].to_numpy(), k)
        mine = group[group["asks"]]
        found = tree.search(_matrix(mine["q"]), mine["vec_id"].tolist(), [None] * len(mine), k)
        cell, dim = group["cell"].iloc[0], group["dim"].iloc[0]
        box = (None, None, None, cell, dim, points.min(0).astype("<i8").tobytes(), points.max(0).astype("<i8").tobytes())
        out = pd.DataFrame([*((*f, cell, dim, None, None) for f in found), box], columns=["query_id", "vec_id", "score", "cell", "dim", "lo", "hi"])
        return out.astype({"query_id": "Int64", "vec_id": "Int64", "score": "Int64"})

    keys = ("cell", "sub", "dim")
    first = written(rows.withColumn("asks", is_query).groupBy(*keys).applyInPandas(at_home, f"{RESULT}, cell long, dim int, lo binary, hi binary"), "home")
    home = first.where("query_id IS NOT NULL").select("query_id", "vec_id", "score")
    boxes = first.where("query_id IS NULL AND cell >= 0").select("cell", "dim", "lo", "hi")
    boxes = boxes.groupBy("cell", "dim").applyInPandas(_merged_boxes, "cell long, dim int, lo binary, hi binary").toPandas()  # a row per cell
    kth = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min(F.struct("score", (-F.col("vec_id")).alias("id"))).alias("kth"))
    kth = kth.where(F.col("n") == k)
    asked = rows.where(is_query).join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    asked = asked.select("vec_id", "dim", "q", F.concat_ws(" ", "kth.score", -F.col("kth.id")).alias("kth"))
    sent = reachable(asked, boxes).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    sent = sent.withColumn("sub", F.explode(F.sequence(F.lit(0), subs[F.col("cell")] - 1)))
    own = rows.where(is_query).select(F.col("vec_id").alias("i"), F.col("q").alias("v"), F.col("cell").alias("c"), F.col("sub").alias("s"))
    at_own = (F.col("vec_id") == F.col("i")) & (F.col("q") == F.col("v")) & (F.col("cell") == F.col("c")) & (F.col("sub") == F.col("s"))
    sent = written(sent.join(own, at_own, "left_anti"), "sent")
    held = rows.select(*keys, "vec_id", "q").join(sent.select(*keys, "block").distinct(), list(keys))
    held = held.select(*[F.col(c).alias(c) for c in held.columns])  # columns of its own beside those of ``sent``

    @tidy
    def away(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        tree = Tree(_matrix(points["q"]), points["vec_id"].to_numpy(), k)
        bounds = [tuple(map(int, x.split())) or None for x in queries["kth"]]
        found = tree.search(_matrix(queries["q"]), queries["vec_id"].tolist(), bounds, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    both = (*keys, "block")
    others = held.groupBy(*both).cogroup(sent.groupBy(*both)).applyInPandas(away, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = home.unionByName(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score"), sent
