"""Hard-negative mining with Four-Russians scoring.

Vectors become integers and are packed as bit planes: plane p of a row holds
bit p of all components (two's complement), eight components a byte. An anchor
gets a table for each group of eight components with the sums of all 256
subsets of its own components there. The inner product with a row is then

    sum over planes of 2^p * sum over groups of table[group][byte]

the top plane counting negative: one lookup and addition for a byte, one shift
for a plane, and no multiplication. All scores are full and exact, nothing is
estimated or pruned.

Anchors and rows are dealt to blocks of bounded size; every anchor block meets
every row block in one task, first for the anchors' best rows of their own
label, then for the rows of other labels whose score lies in the band below
each of these. Only a few rows for each anchor leave a task. What is copied to
the tasks are packed planes, a tenth of the vectors' size.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.llm import worker
from listwright.session import cut_lineage

ANCHORS = 128  # anchors scored together; their tables stay in the processor's cache
ROWS = 1024  # rows scored together
LONG = (1 << 63) - 1


def integers(vector: list[float], scale: float) -> np.ndarray:
    """floor(scale * x) of all components; beyond 62 bits as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(np.asarray(vector, dtype=np.float64) * scale)
    if scaled.size and np.abs(scaled).max() >= 2.0 ** 62:
        return np.array([math.floor(Fraction(x) * Fraction(scale)) for x in vector], dtype=object)
    return scaled.astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Bit planes of integers, lowest first; the last is the sign's. One byte holds eight components."""
    most = max(int(values.max()), -int(values.min()) - 1) if len(values) else 0
    bits = [((values >> p) & 1).astype(np.uint8) for p in range(most.bit_length() + 1)]
    return np.packbits(np.stack(bits), axis=1, bitorder="little").tobytes() if len(values) else b""


def unpack(packed: list[bytes], groups: list[int], width: int) -> np.ndarray:
    """Rows of packed planes with as many planes and groups each: (plane, group, row); the sign's plane is repeated on top."""
    shapes = [(len(b) // g if g else 0, g) for b, g in zip(packed, groups)]
    planes = max((n for n, _ in shapes), default=0)
    out = np.zeros((planes, width, len(packed)), dtype=np.uint8)
    by_shape: dict[tuple[int, int], list[int]] = {}
    for i, shape in enumerate(shapes):
        by_shape.setdefault(shape, []).append(i)
    for (n, g), rows in by_shape.items():
        if n:
            part = np.frombuffer(b"".join(packed[i] for i in rows), dtype=np.uint8).reshape(len(rows), n, g)
            out[:n, :g, rows] = part.transpose(1, 2, 0)
            out[n:, :g, rows] = part[:, -1, :].T[None]
    return out


class Tables:
    """Subset-sum tables of some anchors: [group][byte] -> one sum for each anchor."""

    def __init__(self, anchors: list[np.ndarray], groups: int, planes: int) -> None:
        largest = max((abs(int(x)) for a in anchors for x in a), default=0)
        self.bound = max(1, largest) * 8 * groups << planes  # of any score
        kind = np.int32 if self.bound < 1 << 31 else np.int64 if self.bound < 1 << 40 else object
        own = np.zeros((groups * 8, len(anchors)), dtype=kind)
        for i, a in enumerate(anchors):
            own[:len(a), i] = a
        self.sums = np.zeros((groups, 256, len(anchors)), dtype=kind)
        for bit in range(8):
            half = 1 << bit
            self.sums[:, half:2 * half] = self.sums[:, :half] + own[bit::8][:, None, :]

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """(anchor, row) scores of packed rows, exact."""
        n_planes, groups, rows = planes.shape
        total = np.zeros((rows, self.sums.shape[2]), dtype=self.sums.dtype)
        for p in range(n_planes - 1, -1, -1):
            if p < n_planes - 1:
                total <<= 1
            for g in range(groups):
                found = self.sums[g].take(planes[p, g], axis=0)
                if p == n_planes - 1:
                    total -= found
                else:
                    total += found
        return total.T


class Block:
    """The rows of one data block, by id; scores come with the row's place so that equal scores sort by id."""

    def __init__(self, ids: list[int], labels: list, packed: list[bytes], groups: list[int], width: int) -> None:
        order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
        self.ids = np.array(ids, dtype=np.int64)[order]
        self.labels = np.array(labels, dtype=object)[order]
        self.planes = unpack([packed[i] for i in order], [groups[i] for i in order], width)
        self.shift = max(1, int(len(ids)).bit_length())
        self.places = (1 << self.shift) - 1 - np.arange(len(ids), dtype=np.int64)

    def keys(self, anchors: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        """score << shift | place for each (anchor, row): greater is earlier."""
        tables = Tables(anchors, self.planes.shape[1], self.planes.shape[0])
        wide = np.int64 if tables.bound < 1 << (62 - self.shift) else object
        out = np.empty((len(anchors), len(rows)), dtype=wide)
        for start in range(0, len(rows), ROWS):
            part = rows[start:start + ROWS]
            out[:, start:start + ROWS] = (tables.scores(self.planes[:, :, part]).astype(wide) << self.shift) | self.places[part].astype(wide)
        return out

    def found(self, key: int) -> tuple[int, int]:
        """(id, score) of a key."""
        return int(self.ids[(1 << self.shift) - 1 - (key & ((1 << self.shift) - 1))]), key >> self.shift


def by_label(labels: list) -> dict:
    out: dict = {}
    for i, label in enumerate(labels):
        out.setdefault(label, []).append(i)
    return out


def best_of_label(block: Block, ids: list[int], labels: list, anchors: list[np.ndarray], k: int) -> list[tuple]:
    """(anchor, row, score): each anchor's first k rows of its own label in this block, itself left out."""
    out = []
    for label, group in by_label(labels).items():
        rows = np.flatnonzero(block.labels == label)
        for start in range(0, len(group), ANCHORS):
            part = group[start:start + ANCHORS]
            keys = block.keys([anchors[i] for i in part], rows)
            if keys.shape[1] > k + 1:
                keys = np.partition(keys, keys.shape[1] - k - 1, axis=1)[:, -k - 1:]
            for i, own in zip(part, np.sort(keys, axis=1)[:, ::-1].tolist()):
                others = [f for f in map(block.found, own) if f[0] != ids[i]][:k]
                out += [(ids[i], row, score) for row, score in others]
    return out


def in_bands(block: Block, ids: list[int], labels: list, anchors: list[np.ndarray], positives: list[list[tuple[int, int]]], k: int, low: int, high: int) -> list[tuple]:
    """(anchor, positive, row, positive's score, score): the first k rows of other labels in each positive's band."""
    out = []
    for label, group in by_label(labels).items():
        rows = np.flatnonzero(block.labels != label)
        for start in range(0, len(group), ANCHORS):
            part = group[start:start + ANCHORS]
            keys = np.sort(block.keys([anchors[i] for i in part], rows), axis=1)
            for i, own in zip(part, keys):
                for positive, score in positives[i]:
                    # low * score <= 100 * s <= high * score
                    least, most = -(-low * score // 100), high * score // 100
                    if least > most:
                        continue
                    top = _upto(own, (most << block.shift) | ((1 << block.shift) - 1))
                    for key in reversed(own[max(0, top - k):top].tolist()):
                        row, s = block.found(key)
                        if s < least:
                            break
                        out.append((ids[i], positive, row, score, s))
    return out


def _upto(keys: np.ndarray, key: int) -> int:
    """How many of the sorted keys are at most `key`."""
    if keys.dtype != object:
        key = max(-LONG, min(LONG, key))
    return int(np.searchsorted(keys, key, side="right"))


def _sortable(score: int) -> str:
    """Text that sorts as the numbers do, however many digits they have."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):06d}{digits}"
    return f"0{999_999 - len(digits):06d}" + "".join(str(9 - int(c)) for c in digits)


def _long(value: int) -> int:
    return max(-LONG, min(LONG, value))


def mine(
    vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 3,
    scale: float = 256.0, low: int = 50, high: int = 95, anchors_per_block: int = 1024, rows_per_block: int = 8192,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which `is_anchor` holds. An anchor's positives are
    its `positives` best other rows of the same label; its negatives for one of
    them are the `negatives` best rows of other labels whose score is between
    `low` and `high` per cent of the positive's. Equal scores go by the smaller
    id. Scores are inner products of the vectors of floor(scale * x).

    Rows with a null id, label or vector, or a null or non-finite component
    take no part; shorter vectors count as filled up with zeros; rows that
    repeat an id count once (with the least vector, then the least label);
    scores beyond a long are compared in full and returned as its ends. Fewer
    candidates give fewer rows, an empty table none; other columns and their
    names don't matter.
    """
    id_, v, l, asked = *worker.columns([key, vector, label]), is_anchor
    component = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))  # noqa: E731  NaN is above all
    usable = id_.isNotNull() & l.isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, component), F.lit(False))
    rows = vectors.where(usable).select(id_.cast("long").alias("id"), F.struct(v.cast("array<double>").alias("v"), l.cast("string").alias("l")).alias("r"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = rows.groupBy("id").agg(F.min("r").alias("r"), F.max("asked").alias("asked")).select("id", "r.v", "r.l", "asked")

    def packed(batches):
        for batch in batches:
            whole = [integers(x, scale) for x in batch.column("v").to_pylist()]
            planes = [pack(x) for x in whole]
            groups = [(len(x) + 7) // 8 for x in whole]
            kept = [x if a else None for x, a in zip(batch.column("v").to_pylist(), batch.column("asked").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("l"), pa.array(planes, pa.binary()), pa.array(groups, pa.int32()), pa.array(kept, pa.list_(pa.float64()))],
                names=["id", "l", "planes", "groups", "v"])

    data = cut_lineage(rows.mapInArrow(packed, "id long, l string, planes binary, groups int, v array<double>"))
    sizes = data.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("a")).first()
    n_data, n_anchor = sizes["n"] // rows_per_block + 1, sizes["a"] // anchors_per_block + 1
    of_data, of_anchor = F.pmod(F.xxhash64("id"), F.lit(n_data)).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_anchor)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = data.select(of_data.alias("p_d"), *[F.col(c).alias(f"p_{c}") for c in ("id", "l", "planes", "groups")]).withColumn("p_a", every(n_anchor))
    anchors = data.where("v IS NOT NULL").select(of_anchor.alias("a"), "id", "l", "v", "groups")

    def block_of(anchor_rows: pa.Table, data_rows: pa.Table) -> tuple[Block, dict]:
        own, other = anchor_rows.to_pydict(), data_rows.to_pydict()
        width = max([0, *own["groups"], *other["p_groups"]])
        return Block(other["p_id"], other["p_l"], other["p_planes"], other["p_groups"], width), own

    def first(anchor_rows: pa.Table, data_rows: pa.Table) -> pa.Table:
        block, own = block_of(anchor_rows, data_rows)
        found = best_of_label(block, own["id"], own["l"], [integers(x, scale) for x in own["v"]], positives)
        columns = list(zip(*found)) or [[]] * 3
        return pa.table({"anchor_id": pa.array(columns[0], pa.int64()), "row_id": pa.array(columns[1], pa.int64()), "score": pa.array([str(s) for s in columns[2]], pa.string()),
                         "place": pa.array([_sortable(s) for s in columns[2]], pa.string())})

    def second(anchor_rows: pa.Table, data_rows: pa.Table) -> pa.Table:
        block, own = block_of(anchor_rows, data_rows)
        wanted = [[(p["row_id"], int(p["score"])) for p in found] for found in own["found"]]
        found = in_bands(block, own["id"], own["l"], [integers(x, scale) for x in own["v"]], wanted, negatives, low, high)
        columns = list(zip(*found)) or [[]] * 5
        return pa.table({"anchor_id": pa.array(columns[0], pa.int64()), "positive_id": pa.array(columns[1], pa.int64()), "negative_id": pa.array(columns[2], pa.int64()),
                         "positive_score": pa.array([_long(s) for s in columns[3]], pa.int64()), "negative_score": pa.array([_long(s) for s in columns[4]], pa.int64()),
                         "place": pa.array([_sortable(s) for s in columns[4]], pa.string())})

    met = anchors.withColumn("d", every(n_data)).groupBy("a", "d").cogroup(blocks.groupBy("p_a", "p_d"))
    near = met.applyInArrow(first, "anchor_id long, row_id long, score string, place string")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("place"), "row_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    near = cut_lineage(near.groupBy("anchor_id").agg(F.collect_list(F.struct("row_id", "score")).alias("found")))
    with_positives = anchors.join(near, F.col("id") == F.col("anchor_id")).select("a", "id", "l", "v", "groups", "found")
    met = with_positives.withColumn("d", every(n_data)).groupBy("a", "d").cogroup(blocks.groupBy("p_a", "p_d"))
    hard = met.applyInArrow(second, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long, place string")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("place"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS anchor_id, p.vec_id AS row_id, q.label = p.label AS same, list_dot_product(q.e, p.e)::BIGINT AS score
               FROM v q JOIN v p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id),
    positives AS (SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE same
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, row_id))::INTEGER AS rank,
           row_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
"""
