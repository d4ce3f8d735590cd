"""Exact top-k inner-product search by dual cover trees.

Vectors become integers. They are dealt to cells around pivots and each cell to
blocks of bounded size; a block of queries and a block of data are searched
with a cover tree each. The levels of a tree have falling scales: the points of
a level lie more than its scale apart, every point of the next level lies
within the scale of its parent, and a level's points are among the next one's.
A point stands for all points below it, with the radius that covers them.

Both trees are gone down together, level by level. The inner product of any
query below a with any point below b is at most

    <a, b> + |a| r_b + |b| r_a + r_a r_b

of the points and radii; a pair of nodes whose bound lies below the worst kth
score of all the node's queries is left out with all pairs below it, and what is
left at the last level is compared directly. Bounds are taken with a margin for
rounding, scores are integers and exact, and equal scores are never pruned:
results are those of brute force, ties going to the smaller id.

Queries first search the block they lie in. The kth score found there goes with
them to the other blocks, and the same bound, of whole blocks, decides which
blocks meet at all: only those pairs are sent to a task. How much is pruned
depends on the vectors: clusters are told apart, directions that are spread
evenly in many dimensions are not, and then all pairs are compared.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.llm import worker
from listwright.session import cut_lineage

TREE = 2048  # points of one tree; building it takes the square of that
SHRINK = 1.3  # a level's scale by the next one's
SCALES = 40  # below the last scale the rest of a node's points are compared directly


class Tree:
    """A cover tree over the rows of `points`.

    Level i has `scales[i]` and the points `levels[i]` (row numbers; those of
    the level before come first), whose parents, as places in the level before,
    are `parents[i]` and whose covering radii are `radii[i]`. `below[i]` gives
    for every row the place of its node in level i.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.points, self.norms = points, np.linalg.norm(points, axis=1)
        self.scales, self.levels, self.parents, self.radii, self.below = [], [], [], [], []
        n = len(points)
        if not n:
            return
        with np.errstate(over="ignore", invalid="ignore"):
            squares = self.norms[:, None] ** 2 + self.norms[None] ** 2 - 2 * points @ points.T
        distance = np.sqrt(np.maximum(np.nan_to_num(squares, nan=np.inf, posinf=np.inf), 0))
        np.fill_diagonal(distance, 0)
        centres, near, owner = [0], distance[0].copy(), np.zeros(n, dtype=np.int64)
        scale = float(near.max())
        for _ in range(SCALES):
            before = len(centres)
            parents = list(range(before))
            above = owner.copy()
            # the farthest point not yet covered is the next one of the level
            while len(centres) < n and near[far := int(near.argmax())] > scale:
                parents.append(int(above[far]))
                closer = distance[far] < near
                near = np.where(closer, distance[far], near)
                owner[closer] = len(centres)
                centres.append(far)
            self._level(scale, centres, parents, owner, distance)
            if near.max() <= 0 or not np.isfinite(scale):
                break
            scale /= SHRINK

    def _level(self, scale: float, centres: list[int], parents: list[int], owner: np.ndarray, distance: np.ndarray) -> None:
        """Adds a level. A row's node is the one its ancestors lead to: the nearest of the last level, and so on up."""
        self.scales.append(scale)
        self.levels.append(np.array(centres))
        self.parents.append(np.array(parents))
        self.below = []
        place = owner.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            self.below.insert(0, place)
            place = self.parents[level][place]
        self.radii = []
        for level, below in zip(self.levels, self.below):
            radius = np.zeros(len(level))
            np.maximum.at(radius, below, distance[np.arange(len(below)), level[below]])
            self.radii.append(radius)


def _bounds(points_a: np.ndarray, norm_a: np.ndarray, r_a: np.ndarray, points_b: np.ndarray, norm_b: np.ndarray, r_b: np.ndarray) -> np.ndarray:
    """Most that the inner products below each pair of nodes can be."""
    with np.errstate(over="ignore", invalid="ignore"):
        top = points_a @ points_b.T + norm_a[:, None] * r_b[None] + r_a[:, None] * norm_b[None] + r_a[:, None] * r_b[None]
        return np.nan_to_num(top + 1e-9 * np.abs(top) + 1e-6, nan=np.inf, posinf=np.inf)


def open_pairs(queries: Tree, data: Tree, floor: np.ndarray) -> np.ndarray:
    """(query, point) pairs that no pair of nodes above them rules out; `floor` are the queries' known kth scores."""
    depth = max(len(queries.levels), len(data.levels))
    mask = None
    for i in range(depth):
        a, b = min(i, len(queries.levels) - 1), min(i, len(data.levels) - 1)
        if mask is None:
            active = np.ones((len(queries.levels[0]), len(data.levels[0])), dtype=bool)
        else:
            active = mask
            if i < len(queries.levels):
                active = active[queries.parents[a]]
            if i < len(data.levels):
                active = active[:, data.parents[b]]
        worst = np.full(len(queries.levels[a]), np.inf)
        np.minimum.at(worst, queries.below[a], floor)
        rows, cols = np.flatnonzero(active.any(axis=1)), np.flatnonzero(active.any(axis=0))
        own, other = queries.levels[a][rows], data.levels[b][cols]
        top = _bounds(queries.points[own], queries.norms[own], queries.radii[a][rows], data.points[other], data.norms[other], data.radii[b][cols])
        mask = np.zeros_like(active)
        mask[np.ix_(rows, cols)] = active[np.ix_(rows, cols)] & (top >= worst[rows][:, None])
    return mask[queries.below[-1]][:, data.below[-1]]


def _integers(vectors: list, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of all components, as floats for the bounds and exactly for the scores."""
    width = max((len(v) for v in vectors), default=0)
    points = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        points[i, :len(v)] = v
    with np.errstate(over="ignore"):
        whole = np.floor(points * scale)
    if whole.size and float(np.abs(whole).max()) * np.sqrt(width) >= 2.0 ** 26.5:
        return whole, np.array([[math.floor(Fraction(x) * Fraction(scale)) for x in row] for row in points.tolist()], dtype=object)
    return whole, whole


def search(queries: pd.DataFrame, data: pd.DataFrame, k: int, scale: float) -> tuple[pd.DataFrame, int]:
    """Top k of each row of `queries(id, v, floor)` in `data(id, v)`, ids being distinct, and how many pairs were compared."""
    vectors, exact = _integers([*queries["v"], *data["v"]], scale)
    n, compared = len(queries), 0
    q_ids, p_ids = queries["id"].to_numpy(np.int64), data["id"].to_numpy(np.int64)
    floor = queries["floor"].to_numpy(dtype=np.float64, na_value=-np.inf)
    best: list[list] = [[] for _ in range(n)]
    trees = [(slice(i, i + TREE), Tree(vectors[n + i:n + min(i + TREE, len(data))])) for i in range(0, len(data), TREE)]
    for i in range(0, n, TREE):
        part = slice(i, min(i + TREE, n))
        tree, own_floor = Tree(vectors[part]), floor[part]
        for at, other in trees:
            mask = open_pairs(tree, other, own_floor)
            rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
            compared += int(mask.sum())
            scores, ids = exact[part][rows] @ exact[n:][at][cols].T, p_ids[at][cols]
            for row, j in enumerate((rows + i).tolist()):
                found = np.flatnonzero(mask[j - i, cols] & (scores[row] >= floor[j]) & (ids != q_ids[j]))
                if not len(found):
                    continue
                own = scores[row][found]
                if len(found) > k:
                    if own.dtype != object:
                        near = own >= np.partition(own, len(own) - k)[len(own) - k]
                        found, own = found[near], own[near]
                    first = np.lexsort((ids[found], -own))[:k]
                    found, own = found[first], own[first]
                best[j] = sorted(best[j] + [(-int(s), int(p)) for s, p in zip(own, ids[found])])[:k]
                if len(best[j]) == k:
                    floor[j] = max(floor[j], -best[j][-1][0])
    limit = (1 << 63) - 1
    out = [(int(q), p, max(-limit, min(limit, -s))) for q, found in zip(q_ids, best) for s, p in found]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64"), compared


class Cells:
    """Pivots, and the cell of each vector: the nearest pivot's."""

    def __init__(self, pivots: list, scale: float) -> None:
        self.pivots, self.scale = _integers(pivots, scale)[0], scale

    def place(self, vectors: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance from the pivot, norm) of each vector."""
        points = _integers(vectors, self.scale)[0]
        width = max(points.shape[1], self.pivots.shape[1])
        points, pivots = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (points, self.pivots))
        with np.errstate(over="ignore", invalid="ignore"):
            order = (pivots * pivots).sum(axis=1)[None] - 2 * points @ pivots.T
            cell = np.nan_to_num(order, nan=np.inf).argmin(axis=1) if len(pivots) else np.zeros(len(points), np.int64)
            away = np.linalg.norm(points - pivots[cell], axis=1)
        return cell, np.nan_to_num(away, nan=np.inf) * (1 + 1e-9), np.linalg.norm(points, axis=1)


def _spread(vectors: list, n: int, scale: float) -> list:
    """n of the vectors, each as far as possible from those before it."""
    points = _integers(vectors, scale)[0]
    if not len(points):
        return []
    chosen = [0]
    with np.errstate(over="ignore", invalid="ignore"):
        near = np.linalg.norm(points - points[0], axis=1)
        while len(chosen) < min(n, len(points)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return [vectors[i] for i in chosen]


def _dealt(rows: DataFrame, scale: float, block_rows: int) -> tuple[DataFrame, pd.DataFrame]:
    """Rows (id, v) with their block, and the blocks: (block, centre, radius).

    There is a pivot for `block_rows` rows, far apart ones of eight times as
    many that are drawn by the hash of their ids; a cell with more rows than that is
    dealt to several blocks by the rows' ids, so no block grows with a cluster.
    """
    count = rows.count()
    n = count // block_rows + 1
    pivots = _spread([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(8 * n).collect()], n, scale)
    sent = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Cells(pivots, scale)))

    def place(batches):
        cells = cloudpickle.loads(sent.value)
        for batch in batches:
            cell, away, _ = cells.place(batch.column("v").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=[*batch.schema.names, "cell", "away"])

    placed = cut_lineage(rows.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])))
    found = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).orderBy("cell").collect()
    blocks, firsts = [], []
    for r in found:
        parts = -(-r["n"] // block_rows)
        firsts.append((r["cell"], len(blocks), parts))
        blocks += [(len(blocks) + i, r["cell"], r["radius"]) for i in range(parts)]
    numbered = F.broadcast(rows.sparkSession.createDataFrame(firsts, "of_cell int, first int, parts int"))  # one short row for block_rows rows
    in_block = placed.join(numbered, F.col("cell") == F.col("of_cell")).withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts"))).cast("int"))
    centres = Cells(pivots, scale).pivots
    table = pd.DataFrame({"block": [b for b, _, _ in blocks], "centre": [centres[c] for _, c, _ in blocks], "radius": [r for _, _, r in blocks]})
    return in_block.select(*rows.columns, "block"), table


def top_k(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0, block_rows: int = 8192) -> DataFrame:
    """The k best rows for each query: query_id, rank, vec_id, score.

    Queries are the rows for which the Column `is_query` holds, candidates all
    rows with another id. The score is the inner product of the vectors of
    floor(scale * x); ties go to the smaller id. Rows with a null id, a null
    vector or a null or non-finite component take no part; shorter vectors
    count as filled up with zeros; rows that repeat an id count once (with the
    least of their vectors); scores beyond a long stop at its ends. A query
    with fewer candidates has fewer rows; an empty table gives none.
    """
    id_, v = worker.columns([key, vector])
    usable = v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))
    rows = vectors.where(id_.isNotNull() & usable).select(id_.cast("long").alias("id"), v.cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = cut_lineage(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("asked").alias("asked")))
    data, data_blocks = _dealt(rows, scale, block_rows)
    data = cut_lineage(data.withColumnRenamed("block", "d"))
    queries, query_blocks = _dealt(data.where("asked").select("id", "v", "d"), scale, block_rows)
    queries = cut_lineage(queries.withColumnsRenamed({"block": "q", "d": "home"}))
    points = data.select(F.col("d").alias("p_d"), F.col("id").alias("p_id"), F.col("v").alias("p_v"))
    schema = "query_id long, vec_id long, score long"

    def run(_, asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return search(asked, block.rename(columns={"p_id": "id", "p_v": "v"}), k, scale)[0]

    at_home = queries.withColumn("floor", F.lit(None).cast("double"))
    first = cut_lineage(at_home.groupBy("home").cogroup(points.groupBy("p_d")).applyInPandas(run, schema))
    reached = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score").cast("double")).alias("floor"))
    known = cut_lineage(queries.join(reached, F.col("id") == F.col("query_id"), "left").select("id", "v", "floor", "q", "home"))
    # which blocks meet: those whose bound reaches the worst floor of the query block
    floors = {r["q"]: r["floor"] for r in known.groupBy("q").agg(F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("floor")).collect()}
    meeting = _meeting(query_blocks, data_blocks, floors)
    pairs = F.broadcast(rows.sparkSession.createDataFrame(meeting, "q int, ds array<int>"))  # one row for block_rows queries
    spread = known.join(pairs, "q").select("id", "v", "floor", "q", "home", F.explode("ds").alias("d")).where("d <> home")
    wanted = [(d, [q for q, ds in meeting if d in ds]) for d in sorted({d for _, ds in meeting for d in ds})]
    sent = F.broadcast(rows.sparkSession.createDataFrame(wanted, "of_d int, qs array<int>"))
    met = points.join(sent, F.col("p_d") == F.col("of_d")).select("p_id", "p_v", "p_d", F.explode("qs").alias("p_q"))
    other = spread.groupBy("d", "q").cogroup(met.groupBy("p_d", "p_q")).applyInPandas(run, schema)
    ranked = first.union(other).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meeting(queries: pd.DataFrame, data: pd.DataFrame, floors: dict[int, float]) -> list[tuple[int, list[int]]]:
    """(query block, data blocks) of all pairs of blocks that may hold a result."""
    if not len(queries) or not len(data):
        return []
    qc, dc = np.stack(queries["centre"]), np.stack(data["centre"])
    width = max(qc.shape[1], dc.shape[1])
    qc, dc = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (qc, dc))
    top = _bounds(qc, np.linalg.norm(qc, axis=1), queries["radius"].to_numpy(), dc, np.linalg.norm(dc, axis=1), data["radius"].to_numpy())
    return [(int(q), [int(d) for d in data["block"][row >= floors.get(q, -np.inf)]]) for q, row in zip(queries["block"], top)]
