"""Nearest neighbours by stable projections and a kd-tree.

Unit vectors are projected on ``PROJECTED`` Gaussian directions: the squared projected distance of
two vectors is their squared distance times a chi-square variable of that many degrees. A kd-tree
over the projections, its splits fitted on at most ``SAMPLE`` vectors, deals every vector to a cell.
A query is searched in its own cell first, which gives a bound on the distance of its k-th
neighbour, then in every cell that its radius reaches. In a cell, candidates come in the order of
projected distance and are verified on the original vectors in small steps, until the chi-square
test says that a nearer one would have come already with probability ``CONFIDENCE``.

Equal vectors are one point with their k + 1 smallest ids, so one vector that is a third of all rows
costs one point. Queries that reach one cell are dealt over blocks, and the points of a cell, which
grows with the table, over parts.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows without id or those whose length differs from that of the smallest id's vector; an
id that is there twice counts once, with its least vector; ties go to the smaller id; with fewer
candidates than k all are returned; any finite doubles are compared, however large or small. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import saved
from tallyspan.spread import df_col

PROJECTED, CONFIDENCE = 8, 0.99
#: Vectors that the splits are fitted on, rows of a cell on average, queries of a block in a cell.
SAMPLE, CELL, QUERIES = 16_384, 2_048, 2_048
#: Points of a cell that are searched in one task; a larger cell is searched in parts.
POINTS = 65_536
#: Candidates verified between two stopping tests.
STEP = 128


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile for an even number of degrees, by bisection of the closed form."""
    low, high = 0.0, 1_000.0
    for _ in range(100):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))
        low, high = (x, high) if 1 - tail < p else (low, x)
    return high


class Cells:
    """The kd-tree's splits: inner nodes hold a direction and a value, leaves are cells with a box."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.direction: list[int] = []
        self.value: list[float] = []
        self.child: list[list[int]] = []
        self.cell: list[int] = []
        boxes: list[tuple[np.ndarray, np.ndarray]] = []
        width = points.shape[1]
        todo = [(points, np.full(width, -np.inf), np.full(width, np.inf), -1, 0)]
        while todo:
            some, low, high, parent, side = todo.pop()
            node = len(self.cell)
            if parent >= 0:
                self.child[parent][side] = node
            spread = np.ptp(some, axis=0) if len(some) else np.zeros(width)
            at = int(spread.argmax())
            cut = float(np.median(some[:, at])) if len(some) > leaf and spread[at] > 0 else None
            left = some[:, at] < cut if cut is not None else np.zeros(len(some), bool)
            self.direction.append(at)
            self.value.append(cut if cut is not None else 0.0)
            self.child.append([-1, -1])
            if cut is None or not left.any():
                self.cell.append(len(boxes))
                boxes.append((low, high))
                continue
            self.cell.append(-1)
            below, above = high.copy(), low.copy()
            below[at] = above[at] = cut
            todo += [(some[left], low, below, node, 0), (some[~left], above, high, node, 1)]
        self.low, self.high = (np.array(x) for x in zip(*boxes))

    def home(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        direction, value, child, cell = (np.array(x) for x in (self.direction, self.value, self.child, self.cell))
        while (open_ := cell[node] < 0).any():
            at = node[open_]
            right = points[open_, direction[at]] >= value[at]
            node[open_] = child[at, right.astype(np.int64)]
        return cell[node]

    def reached(self, point: np.ndarray, radius2: float) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        return np.flatnonzero((gap * gap).sum(axis=1) <= radius2)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: cosines stay the same to the last
    bit, and no square is too large or too small for a double."""
    _, power = np.frexp(np.abs(vectors).max(axis=-1, keepdims=True, initial=0.0))
    half = power // 2  # the power itself may be out of range
    return np.ldexp(np.ldexp(vectors, -half), half - power)


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores wherever they stand."""
    return (vectors * query).sum(axis=1) / (norms * math.sqrt(float((query * query).sum())))


class Cell:
    """The points of one cell, ready to be searched."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], planes: np.ndarray, k: int, quantile: float):
        self.vectors, self.ids, self.k, self.quantile = scaled(vectors), ids, k, quantile
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.units = self.vectors / self.norms[:, None]
        self.planes = planes
        self.projected = self.units @ planes if len(vectors) else np.zeros((0, planes.shape[1]))

    def search(self, query: np.ndarray, bound2: float) -> list[tuple[float, int]]:
        """At most k best of the cell as (score, id), best first; ``bound2`` is a squared distance
        that the k-th neighbour is known not to exceed."""
        query = scaled(query)
        unit = _units(query[None, :])
        gap = self.projected - unit @ self.planes
        far2 = (gap * gap).sum(axis=1)
        order = np.flatnonzero(far2 <= self.quantile * bound2 + 1e-9)
        order = order[np.argsort(far2[order], kind="stable")]
        best: list[tuple[float, int]] = []
        for at in range(0, len(order), STEP):
            if far2[order[at]] > self.quantile * bound2 + 1e-9:
                break  # the test: with the stated confidence nothing nearer is left
            some = order[at : at + STEP]
            # a screen, then the exact measure for what may be among the best
            some = some[self.units[some] @ unit[0] >= 1.0 - bound2 / 2 - 1e-9]
            if not len(some):
                continue
            scores = cosines(self.vectors[some], self.norms[some], query).tolist()
            best += [(s, i) for s, p in zip(scores, some) for i in self.ids[p]]
            best = sorted(best, key=lambda x: (-x[0], x[1]))[: self.k]
            if len(best) == self.k:
                bound2 = min(bound2, max(2.0 - 2.0 * best[-1][0], 0.0))
        return best


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 17
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``vectors`` with the largest cosine for each
    row of ``queries`` (a part of the same table), the query's own id excepted."""
    spark = vectors.sparkSession
    keep = k + 1  # one may be the query itself

    def usable(df: DataFrame) -> DataFrame:
        v = df_col(vector_col)
        whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
        rows = df.select(df_col(id_col).cast("long").alias("id"), v.alias("vector")).filter(F.col("id").isNotNull() & whole)
        return rows.groupBy("id").agg(F.min("vector").alias("vector"))

    rows = saved(usable(vectors))
    first = rows.agg(F.min_by(F.size("vector"), "id"), F.count(F.lit(1))).first()
    width = int(first[0] or 0)
    rows = rows.filter(F.size("vector") == width)
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    points = rows.withColumn("nth", nth).filter(F.col("nth") <= keep)
    points = points.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = points.withColumn("point", F.col("ids")[0])

    planes = np.random.default_rng(seed).standard_normal((width, PROJECTED))
    sample = points.select("vector").orderBy(F.xxhash64("point"), "point").limit(SAMPLE).toArrow()
    share = max(len(sample), 1) / max(first[1], 1)
    projected = _units(_matrix(sample.column(0))) @ planes if len(sample) else np.zeros((0, PROJECTED))
    cells = Cells(projected, max(8, int(CELL * min(share, 1.0))))
    quantile = chi_square_quantile(CONFIDENCE, PROJECTED)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = cells.home(_units(_matrix(batch.column("vector"))) @ planes)
                yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32)), *batch.columns], ["cell", *batch.schema.names])

    asked = usable(queries).filter(F.size("vector") == width)
    asked = saved(asked.select("id", "vector"))
    kind = dict(rows.dtypes)["vector"]
    placed = saved(points.mapInArrow(settle, f"cell int, vector {kind}, ids array<long>, point long"))
    wanted = asked.select("vector").distinct().join(placed.select("cell", "vector", "point"), "vector")

    def bound(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """The best of the home cell, and the squared distance of the k-th."""
        found = {"point": [], "bound2": [], "best": []}
        cell = Cell(_matrix(right.column("vector")), right.column("ids").to_pylist(), planes, keep, quantile)
        for point, query in zip(left.column("point").to_pylist(), _matrix(left.column("vector"))):
            best = cell.search(query, 4.0)
            found["point"].append(point)
            found["bound2"].append(max(2.0 - 2.0 * best[-1][0], 0.0) if len(best) == keep else 4.0)
            found["best"].append([{"vec_id": i, "score": s} for s, i in best])
        one = pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])
        return pa.table(found, schema=pa.schema([("point", pa.int64()), ("bound2", pa.float64()), ("best", pa.list_(one))]))

    # a cell of the fitted tree grows with the table: its points are dealt over parts of bounded size
    parts = saved(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / POINTS).cast("int").alias("parts")))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def in_blocks(asked_rows: DataFrame, fn, schema: str) -> DataFrame:
        """Cogroup queries and points of a cell, both dealt over blocks of bounded size; every block of
        queries meets every part of the points."""
        blocks = asked_rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks")).join(parts, "cell")
        dealt = asked_rows.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int")).withColumn("part", numbers("parts"))
        copies = placed.join(blocks, "cell").withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int")).withColumn("block", numbers("blocks"))
        # both sides stem from the same table: new names for the same columns
        left, right = (df.select(*[F.col(c).alias(c) for c in df.columns if c not in ("blocks", "parts")]) for df in (dealt, copies))
        return left.groupBy("cell", "block", "part").cogroup(right.groupBy("cell", "block", "part")).applyInArrow(fn, schema)

    bounds = in_blocks(wanted, bound, "point long, bound2 double, best array<struct<vec_id:bigint,score:double>>")
    # the k-th of any part bounds the k-th of the cell
    bounds = saved(bounds.groupBy("point").agg(F.min("bound2").alias("bound2"), F.flatten(F.collect_list("best")).alias("best")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every cell that the query's radius reaches."""
        for batch in batches:
            if not batch.num_rows:
                continue
            at = _units(_matrix(batch.column("vector"))) @ planes
            reached = [cells.reached(p, quantile * b + 1e-9) for p, b in zip(at, batch.column("bound2").to_pylist())]
            take = pa.array(np.repeat(np.arange(len(reached)), [len(r) for r in reached]))
            cell = pa.array(np.concatenate(reached).astype(np.int32))
            yield pa.RecordBatch.from_arrays([cell, *(c.take(take) for c in batch.columns)], ["cell", *batch.schema.names])

    probes = wanted.select("vector", "point").join(bounds.drop("best"), "point").select("point", "bound2", "vector")
    probes = probes.mapInArrow(spread, f"cell int, point long, bound2 double, vector {kind}")

    def look(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"point": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            cell = Cell(_matrix(right.column("vector")), right.column("ids").to_pylist(), planes, keep, quantile)
            columns = (left.column(c).to_pylist() for c in ("point", "bound2"))
            for point, bound2, query in zip(*columns, _matrix(left.column("vector"))):
                for score, vec_id in cell.search(query, bound2):
                    for name, value in (("point", point), ("vec_id", vec_id), ("score", score)):
                        found[name].append(value)
        return pa.table(found, schema=pa.schema([("point", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    found = in_blocks(probes, look, "point long, vec_id long, score double")
    # what the first search has found stays, even where the second one's radius leaves it out
    found = found.unionByName(bounds.select("point", F.inline("best"))).dropDuplicates(["point", "vec_id"])
    by_score = [F.col("score").desc(), F.col("vec_id")]
    best = found.withColumn("nth", F.row_number().over(Window.partitionBy("point").orderBy(*by_score))).filter(F.col("nth") <= keep)
    best = best.groupBy("point").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("best"))
    named = asked.join(placed.select("vector", "point"), "vector").select(F.col("id").alias("query_id"), "point").join(best, "point")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    out = named.select("query_id", F.posexplode(others).alias("at", "b"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
