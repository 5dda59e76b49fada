"""Nearest neighbours by stable projections: projected neighbours are verified until a chi-square test holds.

Vectors are projected to eight dimensions with a Gaussian matrix, so that the squared projected distance
of two vectors over their squared distance has a chi-square distribution. Projections are dealt to cells
of a kd-tree fitted on a bounded sample; each cell is indexed by a kd-tree of its own. A query first
searches its own cell and then every cell that may still hold a nearer vector: candidates come in order
of projected distance and are verified with the original vectors until the next projected distance is so
large that a vector nearer than the current last neighbour would have it with probability 1 - CERTAINTY
at most. There is no cap on candidates. Equal vectors are indexed once with their smallest ids, which
are all that can be among the nearest, and equal queries are searched once. Vectors of each length are
searched among themselves, with a projection and cells of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clienttrail.llm.common import read_table, stored

NEIGHBOURS = 10
PROJECTED = 8
CERTAINTY = 0.97
SEED = 11
#: Vectors the cells are fitted on, vectors in a cell on average, vectors in a leaf, queries a task takes.
SAMPLE_ROWS, CELL_ROWS, LEAF_ROWS, QUERY_ROWS = 20_000, 16_384, 64, 2_048
#: Leaves opened at a time.
LEAVES = 8

_FOUND = "query_key array<double>, vec_id long, score double"


def chi_square_quantile(probability: float, degrees: int) -> float:
    """Quantile for an even number of degrees of freedom, by bisection of the closed form."""

    def below(x: float) -> float:
        terms = [(x / 2) ** i / math.factorial(i) for i in range(degrees // 2)]
        return 1 - math.exp(-x / 2) * sum(terms)

    low, high = 0.0, 1.0
    while below(high) < probability:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


def projection(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimensions, PROJECTED))


def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class KdCells:
    """A complete kd-tree whose leaves are numbered cells, split at medians of the widest coordinate."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        self.axis = np.zeros(1 << levels, np.int64)
        self.split = np.zeros(1 << levels)
        groups = {1: points}
        for node in range(1, 1 << levels):
            own = groups.pop(node)
            if len(own):
                self.axis[node] = np.argmax(own.max(axis=0) - own.min(axis=0))
                self.split[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] >= self.split[node]
            groups[2 * node], groups[2 * node + 1] = own[~right], own[right]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.levels):
            node = 2 * node + (points[rows, self.axis[node]] >= self.split[node])
        return node - (1 << self.levels)


class KdIndex:
    """The kd-tree of a cell: leaves of a few points with their bounding boxes."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray):
        self.vectors, self.projected = vectors, projected
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(vectors))]
        while stack:
            rows = stack.pop()
            if len(rows) <= LEAF_ROWS:
                self.leaves.append(rows)
                continue
            own = projected[rows]
            axis = np.argmax(own.max(axis=0) - own.min(axis=0))
            order = np.argsort(own[:, axis], kind="stable")
            stack += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.low = np.array([projected[rows].min(axis=0) for rows in self.leaves])
        self.high = np.array([projected[rows].max(axis=0) for rows in self.leaves])

    def search(
        self, vector: np.ndarray, place: np.ndarray, count: int, reach: float, limit: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the count nearest found that are nearer than limit or as near.

        reach is the chi-square quantile of the stopping test.
        """
        gap = np.maximum(0, np.maximum(self.low - place, place - self.high))
        least = (gap**2).sum(axis=1)
        order = np.argsort(least, kind="stable")
        rows, distances = np.zeros(0, np.int64), np.zeros(0)
        for start in range(0, len(order), LEAVES):
            if least[order[start]] > limit**2 * reach:
                break
            near = np.concatenate([self.leaves[i] for i in order[start : start + LEAVES]])
            projected = ((self.projected[near] - place) ** 2).sum(axis=1)
            near = near[projected <= limit**2 * reach]
            found = np.sqrt(((self.vectors[near] - vector) ** 2).sum(axis=1))
            rows, distances = np.concatenate([rows, near]), np.concatenate([distances, found])
            if len(rows) > count:
                last = np.partition(distances, count - 1)[count - 1]
                best = distances <= last
                rows, distances = rows[best], distances[best]
                limit = min(limit, last)
        return rows, distances


def _usable(vector: str) -> Column:
    return F.expr(
        f"size({vector}) > 0 and not exists({vector}, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        f" and exists({vector}, x -> x <> 0)"
    )


def _placed(points: DataFrame, shared) -> DataFrame:
    """Add the cell and the projection of each point; shared has the cells of lengths with more than one."""
    names = [*points.columns, "cell", "projected"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                same = batch.filter(pa.array(sizes == size))
                projected = matrix_of(same.column("vector")) @ projection(size)
                trees = shared.value.get(size)
                own = trees.cells(projected) if trees else np.zeros(same.num_rows)
                lists = pa.array(list(projected), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*same.columns, pa.array(own.astype(np.int64)), lists], names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    return points.mapInArrow(place, f"{kinds}, cell long, projected array<double>")


def _cells(distinct: DataFrame, cell_rows: int) -> dict[int, KdCells]:
    """By length, of lengths with more than cell_rows vectors: cells fitted on a sample of them.

    There are at most as many such lengths as all vectors over cell_rows.
    """
    out = {}
    for size, rows in distinct.groupBy("size").count().where(F.col("count") > cell_rows).orderBy("size").collect():
        sample = distinct.where(F.col("size") == size).orderBy(F.xxhash64("first_id"), "first_id")
        points = matrix_of(sample.limit(SAMPLE_ROWS).select("vector").toArrow().column("vector"))
        out[size] = KdCells(points @ projection(size), math.ceil(math.log2(rows / cell_rows)))
    return out


def _search(count: int, reach: float):
    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = [pa.list_(pa.float64()), pa.int64(), pa.float64()]
        columns: list[list] = [[], [], []]
        if points.num_rows and queries.num_rows:
            points = points.sort_by("first_id")
            index = KdIndex(matrix_of(points.column("vector")), matrix_of(points.column("projected")))
            ids = points.column("ids").to_pylist()
            vectors, places = matrix_of(queries.column("vector")), matrix_of(queries.column("projected"))
            limits = queries.column("limit").to_pylist()
            for vector, place, limit in zip(vectors, places, limits):
                rows, distances = index.search(vector, place, count, reach, limit)
                found = sorted((d, i) for r, d in zip(rows.tolist(), distances.tolist()) for i in ids[r])
                for distance, vec_id in found[:count]:
                    columns[0].append(vector)
                    columns[1].append(vec_id)
                    columns[2].append(distance)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.Table.from_arrays(arrays, ["query_key", "vec_id", "score"])

    return search


def _searched(points: DataFrame, queries: DataFrame, count: int, reach: float) -> DataFrame:
    """Search queries (size, cell, vector, projected, limit) in their cells, in blocks of a bounded size.

    A cell that many queries visit is given to several tasks.
    """
    cell = ["size", "cell"]
    sizes = queries.groupBy(*cell).agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    copies = points.join(sizes, cell).select(*points.columns, block)
    dealt = queries.join(sizes, cell).select(
        *queries.columns, F.pmod(F.xxhash64("vector"), F.col("blocks")).cast("int").alias("block")
    )
    keys = [*cell, "block"]
    pairs = copies.groupBy(*keys).cogroup(dealt.groupBy(*keys))
    return stored(pairs.applyInArrow(_search(count, reach), _FOUND), "found")


def _visits(boxes, reach: float):
    """Other cells whose box the stopping test does not rule out for a query."""
    names = ["size", "cell", "vector", "projected", "limit"]

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, own = batch.column("size").to_numpy(), batch.column("cell").to_numpy()
            limits = batch.column("limit").to_numpy()
            for row, size in enumerate(sizes.tolist()):
                if size not in boxes.value:
                    continue
                cells, low, high = boxes.value[size]
                place = batch.column("projected")[row].values.to_numpy()
                gap = np.maximum(0, np.maximum(low - place, place - high))
                near = (gap**2).sum(axis=1) <= limits[row] ** 2 * reach
                open_ = cells[near & (cells != own[row])]
                at = pa.array(np.full(len(open_), row))
                kept = [batch.column(c).take(at) for c in ("vector", "projected", "limit")]
                yield pa.RecordBatch.from_arrays([batch.column("size").take(at), pa.array(open_), *kept], names)

    return visits


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    count: int = NEIGHBOURS,
    certainty: float = CERTAINTY,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the nearest found of each row for which queries holds.

    vectors has vec_id and embedding. Null and zero vectors, vectors with null, infinite or undefined
    components, and rows without vec_id take no part. A query's candidates are the vectors as long as it is:
    the distance to others is undefined. A query is no neighbour of its own id. Ties go to the smaller vec_id.
    Repeated rows count once; rows of one vec_id with different vectors are searched each. All candidates come
    if there are fewer than count; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    reach = chi_square_quantile(certainty, PROJECTED)
    usable = vectors.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), queries.alias("is_query")
    ).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    usable = usable.where(_usable("vector"))
    # Equal vectors once, with one id more than can be wanted: a query may have to pass over its own.
    order = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = (
        usable.select("vector", "vec_id")
        .distinct()
        .withColumn("place", order)
        .where(F.col("place") <= count + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("first_id"))
    )
    distinct = stored(distinct.withColumn("size", F.size("vector")), "vectors")
    shared = spark.sparkContext.broadcast(_cells(distinct, cell_rows))
    points = stored(_placed(distinct, shared), "points")

    # Boxes: sixteen numbers for each cell, and cells are cell_rows vectors each.
    sides = [F.min(F.get("projected", F.lit(i))).alias(f"low{i}") for i in range(PROJECTED)]
    sides += [F.max(F.get("projected", F.lit(i))).alias(f"high{i}") for i in range(PROJECTED)]
    several = points.where(F.col("size").isin(list(shared.value)))
    found = np.array([tuple(r) for r in several.groupBy("size", "cell").agg(*sides).orderBy("size", "cell").collect()])
    boxes = {}
    for size in shared.value:
        own_boxes = found[found[:, 0] == size]
        boxes[size] = own_boxes[:, 1].astype(np.int64), own_boxes[:, 2 : 2 + PROJECTED], own_boxes[:, 2 + PROJECTED :]
    boxes = spark.sparkContext.broadcast(boxes)

    asked = stored(usable.where("is_query").select(F.col("vec_id").alias("query_id"), "vector").distinct(), "asked")
    queried = asked.select("vector", F.size("vector").alias("size")).distinct()
    single = stored(_placed(queried, shared), "queries")
    wanted = count + 1
    own = _searched(points, single.withColumn("limit", F.lit(float("inf"))), wanted, reach)
    last = own.groupBy("query_key").agg(
        F.when(F.count("*") >= wanted, F.max("score")).otherwise(float("inf")).alias("limit")
    )
    bounded = single.join(last, F.col("vector") == F.col("query_key")).select(*single.columns, "limit")
    more = bounded.mapInArrow(
        _visits(boxes, reach), "size int, cell long, vector array<double>, projected array<double>, limit double"
    )
    others = _searched(points, stored(more, "visits"), wanted, reach)

    by_score = Window.partitionBy("query_key").orderBy("score", "vec_id")
    best = own.unionAll(others).withColumn("place", F.row_number().over(by_score))
    best = best.where(F.col("place") <= wanted).drop("place")
    matched = asked.join(best, F.col("vector") == F.col("query_key")).where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "vector").orderBy("score", "vec_id"))
    return (
        matched.withColumn("rank", rank)
        .where(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
