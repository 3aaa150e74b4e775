"""Nearest neighbours by largest inner product: stable projections in kd-trees, with a chi-square stopping test.

Inner products become distances: vectors, in units of the largest length, get one more component, the root of what
their squared length lacks to 1, and queries are stretched to length 1, so that the squared distance is
``2 - 2 q.x``.  Gaussian projections to ``PROJECTED`` numbers are stable: the squared distance of two
projections, over the squared distance of the vectors, follows the chi-square law with ``PROJECTED`` degrees of freedom.

The projections are indexed in two levels.  A kd-tree over a sample of at most ``SAMPLE`` rows cuts their space into at
most ``CELLS`` cells, and every row is dealt to its cell; cells of more than ``BLOCK`` rows are cut by hash.  A task builds
a kd-tree over each of its blocks.  A query takes the leaves in order of their distance from its projection, verifies
the vectors in them exactly, and stops when the chi-square law says that a neighbour as near as the ``k``-th
found would, with probability ``CERTAIN``, have been met at a smaller projected distance already.

Queries first search their own cell; the ``k``-th found there bounds which other cells they are sent to.  There is no cap on
candidates.  With data that the projections cannot tell apart most cells are searched, and the work is that of the
query set against all rows, in blocks.

Rows without an id, and vectors that are null, all zeros, or hold null or non-finite components take no part.  Shorter
vectors count as followed by zeros.  Rows that share an id are one item with several vectors: its score is the
best of theirs, and it is listed once.  Ties go to the smaller id.  With fewer than ``k`` others all are listed; an empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.arrow_rows import columns_of
from sensorloom.llm.common import partitions, stored
from sensorloom.llm.vectors import finite, matrix, width

PROJECTED = 8
CERTAIN = 0.9
SAMPLE = 1 << 14
CELLS = 1 << 10
#: Rows of a block, about, at most, and of a cell, on average, at least.
BLOCK, CELL_LEAST = 1 << 15, 1 << 10
LEAF = 64
#: Queries that are searched for at once.
ASKED = 512
#: Added to squared projected distances, which are rounded, in units of the squared largest length.
CLOSE = 1e-9
#: How far the scores of a whole leaf may be from those of single pairs, in units of both lengths.
ROUNDED = 1e-12


def chi_square_quantile(probability: float, freedom: int) -> float:
    """Quantile of the chi-square law with an even number of degrees of freedom."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < probability:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


class Space:
    """The augmented space, its projections, and the cells; of bounded size, and sent to every task."""

    def __init__(self, size: int, longest: float, projected: int = PROJECTED, seed: int = 7):
        self.size, self.longest = size, longest
        self.directions = np.random.default_rng(seed).standard_normal((size + 1, projected))
        self.reach = chi_square_quantile(CERTAIN, projected)
        self.splits: list[tuple[int, float]] = []  # of the cells' tree, level by level: axis and value
        self.depth = 0

    def candidates(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of vectors as candidates."""
        scaled = vectors / self.longest
        lack = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        return scaled @ self.directions[:-1] + lack[:, None] * self.directions[-1]

    def queries(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Projections of vectors as queries, and what an inner product of theirs is stretched by."""
        length = np.sqrt((vectors * vectors).sum(axis=1))
        return (vectors / length[:, None]) @ self.directions[:-1], 1 / length / self.longest

    def squared(self, scores: np.ndarray, stretch: np.ndarray) -> np.ndarray:
        """Squared distances from inner products; infinite for a score of minus infinity."""
        return np.maximum(0, 2 - 2 * stretch * scores)

    def radius(self, scores: np.ndarray, stretch: np.ndarray) -> np.ndarray:
        """Squared projected distance up to which the stopping test does not hold."""
        return self.squared(scores, stretch) * self.reach + CLOSE

    def split(self, sample: np.ndarray, cells: int) -> None:
        """Cut the sample's projections into cells by medians along the widest axes."""
        while (2 << self.depth) <= cells:
            self.depth += 1
        groups = [np.arange(len(sample))]
        for _ in range(self.depth):
            halves = []
            for group in groups:
                points = sample[group]
                axis = int(np.ptp(points, axis=0).argmax()) if len(group) else 0
                value = float(np.median(points[:, axis])) if len(group) else 0.0
                self.splits.append((axis, value))
                upper = points[:, axis] > value
                halves += [group[~upper], group[upper]]
            groups = halves

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of every cell."""
        axes = self.directions.shape[1]
        low, high = [np.full(axes, -np.inf)], [np.full(axes, np.inf)]
        for n, (axis, value) in enumerate(self.splits):
            for upper in (False, True):
                bounds = low[n].copy(), high[n].copy()
                bounds[0 if upper else 1][axis] = value
                low.append(bounds[0])
                high.append(bounds[1])
        first = (1 << self.depth) - 1
        return np.stack(low[first:]), np.stack(high[first:])

    def cell(self, projections: np.ndarray) -> np.ndarray:
        at = np.zeros(len(projections), np.int64)  # place in the tree, children of n at 2n + 1 and 2n + 2
        axes = np.array([axis for axis, _ in self.splits], np.int64)
        values = np.array([value for _, value in self.splits])
        for _ in range(self.depth):
            at = 2 * at + 1 + (projections[np.arange(len(at)), axes[at]] > values[at])
        return at - ((1 << self.depth) - 1)


class Tree:
    """A kd-tree over the projections of a block: its leaves are ranges of the block's rows, with their boxes."""

    def __init__(self, projections: np.ndarray, leaf: int = LEAF):
        groups = [np.arange(len(projections))]
        while len(groups[0]) > leaf:
            halves = []
            for group in groups:
                points = projections[group]
                axis = int(np.ptp(points, axis=0).argmax())
                order = np.argpartition(points[:, axis], len(group) // 2)
                halves += [group[order[: len(group) // 2]], group[order[len(group) // 2:]]]
            groups = halves
        self.order = np.concatenate(groups)
        self.starts = np.cumsum([0, *map(len, groups)])
        self.low = np.stack([projections[group].min(axis=0) for group in groups])
        self.high = np.stack([projections[group].max(axis=0) for group in groups])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        column = points[:, axis, None]
        away = np.maximum(0, np.maximum(low[:, axis] - column, column - high[:, axis]))
        out += away * away
    return out


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of every query, each id once: by query, score descending and id."""
    order = np.lexsort((ids, -scores, query))
    by_id = order[np.lexsort((np.arange(len(order)), ids[order], query[order]))]
    again = np.r_[False, (query[by_id][1:] == query[by_id][:-1]) & (ids[by_id][1:] == ids[by_id][:-1])][: len(by_id)]
    repeated = np.zeros(len(order), bool)
    repeated[by_id[again]] = True
    order = order[~repeated[order]]
    owner = query[order]
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
    rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.r_[start, len(owner)]))
    return order[rank < k]


class Block:
    """The vectors of a block, of equal ones as many ids as a list can need."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, space: Space, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order]) + 0.0
        raw = vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel()
        _, kind = np.unique(raw, return_inverse=True)
        by_kind = np.lexsort((ids, kind))
        kinds, named = kind[by_kind], ids[by_kind]
        fresh = np.r_[True, (kinds[1:] != kinds[:-1]) | (named[1:] != named[:-1])]
        by_kind, kinds = by_kind[fresh], kinds[fresh]
        start = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
        turn = np.arange(len(kinds)) - np.repeat(start, np.diff(np.r_[start, len(kinds)]))
        kept = by_kind[turn <= k]  # the query itself may be one of them
        projections = space.candidates(vectors[kept])
        self.tree = Tree(projections)
        self.ids, self.vectors = ids[kept][self.tree.order], vectors[kept][self.tree.order]
        self.lengths = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.space, self.k = space, k

    def search(self, own: np.ndarray, queries: np.ndarray, floor: np.ndarray):
        """(query, id, score) of the ``k`` best of each query in the block that reach its floor."""
        space, tree, k = self.space, self.tree, self.k
        points, stretch = space.queries(queries)
        lengths = np.sqrt((queries * queries).sum(axis=1))
        away = box_distances(points, tree.low, tree.high)
        turn = np.argsort(away, axis=1, kind="stable")
        away = np.take_along_axis(away, turn, axis=1)
        floor = floor.copy()
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        leaves, at, step = len(tree.low), 0, 1
        while at < leaves:
            # The leaves that come next, as far as the test does not hold; farther ones only later.
            some = slice(at, min(at + step, leaves))
            query, place = np.nonzero(away[:, some] <= space.radius(floor, stretch)[:, None])
            if not len(query):
                break
            leaf = turn[query, place + at]
            order = np.argsort(leaf, kind="stable")
            query, leaf = query[order], leaf[order]
            cuts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
            parts = [found]
            for a, b in zip(cuts, np.r_[cuts[1:], len(leaf)]):
                rows = slice(tree.starts[leaf[a]], tree.starts[leaf[a] + 1])
                asked = query[a:b]
                scores = queries[asked] @ self.vectors[rows].T
                slack = ROUNDED * lengths[asked][:, None] * self.lengths[rows]
                i, j = np.nonzero((scores >= floor[asked][:, None] - slack) & (self.ids[rows] != own[asked][:, None]))
                if len(i):
                    i, j = asked[i], j + rows.start
                    parts.append((i, self.ids[j], (queries[i] * self.vectors[j]).sum(axis=1)))
            query, ids, scores = map(np.concatenate, zip(*parts))
            kept = best(query, ids, scores, k)
            found = query[kept], ids[kept], scores[kept]
            full = np.flatnonzero(np.bincount(found[0], minlength=len(own)) == k)
            last = np.cumsum(np.bincount(found[0], minlength=len(own)))[full] - 1
            floor[full] = np.maximum(floor[full], found[2][last])
            at, step = some.stop, step * 2
        return found


def _matrix(column: pa.Array, kind: np.dtype, size: int) -> np.ndarray:
    """Rows of packed vectors as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), size).astype(np.float64)


def _measured(batches):
    """Most components, greatest length and number of the vectors of each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = int(np.diff(batch.column(0).offsets.to_numpy()).max())
        values = matrix(batch.column(0), size)
        largest = np.abs(values).max(axis=1)
        lengths = largest * np.sqrt(((values / largest[:, None]) ** 2).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([size], pa.int32()), pa.array([lengths.max()]), pa.array([len(values)])], ["size", "longest", "n"])


def _placed(space: Space, kind: np.dtype):
    """Rows (id, asks, vector) with packed vectors and the cell of each, as a candidate."""

    def placed(batches):
        for batch in batches:
            ids, asks, vectors = columns_of(batch, ["id", "asks", "vector"])
            values = matrix(vectors, space.size)
            yield pa.RecordBatch.from_arrays(
                [ids, asks, pa.array(space.cell(space.candidates(values)).astype(np.int32)),
                 pa.array([row.tobytes() for row in values.astype(kind)], pa.binary())], ["id", "asks", "cell", "vector"])

    return placed


def _sent(space: Space, kind: np.dtype, home: bool):
    """Rows (id, floor, vector) of queries, once for every cell to be searched: their own, or the others in reach."""
    low, high = space.boxes()

    def sent(batches):
        for batch in batches:
            ids, floors, vectors = columns_of(batch, ["id", "floor", "vector"])
            for at in range(0, len(ids), ASKED):
                part = slice(at, at + ASKED)
                points, stretch = space.queries(_matrix(vectors[part], kind, space.size))
                own = space.cell(points)
                if home:
                    row, cell = np.arange(len(own)), own
                else:
                    floor = floors[part].to_numpy(zero_copy_only=False)
                    reached = box_distances(points, low, high) <= space.radius(floor, stretch)[:, None]
                    reached[np.arange(len(own)), own] = False
                    row, cell = np.nonzero(reached)
                took = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [ids[part].take(took), pa.array(cell.astype(np.int32)), floors[part].take(took), vectors[part].take(took)],
                    ["id", "cell", "floor", "vector"])

    return sent


def _searched(space: Space, kind: np.dtype, k: int):
    """The rows of each block come together, its candidates before its queries."""

    def searched(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        here = block = None
        for batch in batches:
            ids, cells, blocks, asks, floors, vectors = columns_of(batch, ["id", "cell", "block", "asks", "floor", "vector"])
            keys = np.stack([cells.to_numpy(), blocks.to_numpy(), asks.to_numpy(zero_copy_only=False)], axis=1).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)][: len(keys)])
            for a, b in zip(cuts, np.r_[cuts[1:], len(keys)]):
                if here != tuple(keys[a, :2]):
                    here, held, block = tuple(keys[a, :2]), [], None
                if not keys[a, 2]:
                    held.append((ids[a:b].to_numpy(), _matrix(vectors[a:b], kind, space.size)))
                    continue
                if block is None and held:
                    block = Block(*map(np.concatenate, zip(*held)), space, k)
                    held = []
                for at in range(a, b if block else a, ASKED):
                    part = slice(at, min(b, at + ASKED))
                    own = ids[part].to_numpy()
                    query, found, scores = block.search(
                        own, _matrix(vectors[part], kind, space.size), floors[part].to_numpy(zero_copy_only=False))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[query]), pa.array(found), pa.array(scores)], ["query_id", "vec_id", "score"])

    return searched


_FOUND = "query_id long, vec_id long, score double"


def _search(placed: DataFrame, blocks: DataFrame, queries: DataFrame, space: Space, kind: np.dtype, k: int) -> DataFrame:
    """What the queries (id, cell, floor, vector) find in the blocks of their cells."""
    small = F.broadcast(blocks)  # a row for each of at most CELLS cells
    candidates = placed.join(small, "cell").select(
        "id", "cell", F.pmod(F.xxhash64("id", "vector"), F.col("blocks")).alias("block"), F.lit(False).alias("asks"),
        F.lit(0.0).alias("floor"), "vector")
    asked = queries.join(small, "cell").select(
        "id", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(True).alias("asks"), "floor", "vector")
    dealt = candidates.unionAll(asked).repartition(partitions(placed.sparkSession), "cell", "block")
    return dealt.sortWithinPartitions("cell", "block", "asks").mapInArrow(_searched(space, kind, k), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; all steps share one shuffle by query."""
    once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, asks: Column, k: int = 20, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``asks`` holds."""
    spark = vectors.sparkSession
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x).cast("double")))
    taking_part = F.col(id_).isNotNull() & finite(vector) & (F.coalesce(largest, F.lit(0.0)) > 0)
    rows = vectors.filter(taking_part).select(
        F.col(id_).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vector).alias("vector"))
    size, longest, count = rows.select("vector").mapInArrow(_measured, "size int, longest double, n long").agg(
        F.max("size"), F.max("longest"), F.sum("n")).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = np.dtype(np.float32 if "float" in rows.schema["vector"].dataType.simpleString() else np.float64)
    space = Space(size, longest)
    sample = rows.select("vector").orderBy(F.xxhash64("id", "vector"), "vector").limit(SAMPLE).toArrow()
    space.split(space.candidates(matrix(sample.column("vector").combine_chunks(), size)), min(CELLS, count // CELL_LEAST))
    placed = stored(rows.mapInArrow(
        _placed(space, kind), "id long, asks boolean, cell int, vector binary"), "placed")
    blocks = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    queries = placed.filter("asks").select("id", F.lit(-math.inf).alias("floor"), "vector")
    schema = "id long, cell int, floor double, vector binary"
    at_home = stored(_search(placed, blocks, queries.mapInArrow(
        _sent(space, kind, True), schema), space, kind, k), "at_home")
    last = _ranked(at_home, k).filter(F.col("rank") == k).select(
        F.col("query_id").alias("id"), F.col("score").alias("last"))
    bounded = queries.drop("floor").join(last, "id", "left").withColumn(
        "floor", F.coalesce("last", F.lit(-math.inf))).select("id", "floor", "vector")
    elsewhere = _search(placed, blocks, bounded.mapInArrow(
        _sent(space, kind, False), schema), space, kind, k)
    return _ranked(at_home.unionAll(elsewhere), k).select("query_id", "rank", "vec_id", "score")
