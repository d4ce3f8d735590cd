"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. Two
fingerprints within four bits differ in at most two bits over the best two of
the three segments (pigeonhole). Each segment, filled up to 23 bits, is decoded
to a codeword of the perfect binary Golay code; a key joins the codeword
indices of two segments. A fingerprint gives the keys of itself and of all
words one bit away on these two segments, some ten keys a pair of segments:
two words within two bits meet at the word halfway between them, which gives
both the same key. Members of a key are then compared bit by bit.

Only distinct fingerprints are compared, and each group of a key reports
links to its components' least members and not all pairs. A key with too many
members is dealt out to pairs of blocks of its members, each a group of
bounded size; every pair of members still meets in one of them.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.llm import worker
from listwright.llm.components import components
from listwright.session import cut_lineage, scratch_path

SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, of the Golay code


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles.

    A-Z count as small letters, words end at ASCII white space; a text of
    fewer words is one shingle, one without words has the fingerprint 0.
    """
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(found) - words + 1)
    spans = zip(starts[:last].tolist(), ends[min(words, len(found)) - 1:].tolist())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in spans], repeat(seed)), np.uint64, last)
    counts = np.zeros(64, np.int64)
    for part in range(0, last, 8192):
        counts += np.unpackbits(hashes[part:part + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """The columns of `docs` but `text`, and `fp` long (the bits as a signed integer)."""
    others = [c for c in docs.columns if c not in (text, "fp")]
    source = docs.select(*worker.columns(others), worker.columns([text])[0].alias("fp"))
    schema = docs.select(*worker.columns(others)).schema.add("fp", "long")

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t, words, seed) for t in worker.texts(batch.column("fp"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(bits.view(np.int64))], names=[*others, "fp"])

    return source.mapInArrow(run, schema)


def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 23 single bits, and the error pattern of each remainder."""
    singles = []
    for bit in range(23):
        r = 1 << bit
        for high in range(22, 10, -1):
            if r >> high & 1:
                r ^= GENERATOR << (high - 11)
        singles.append(r)
    errors = np.zeros(2048, np.int64)
    for i in range(23):
        errors[singles[i]] = 1 << i
        for j in range(i):
            errors[singles[i] ^ singles[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[singles[i] ^ singles[j] ^ singles[k]] = 1 << i | 1 << j | 1 << k
    return np.array(singles), errors


def golay_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    singles, errors = worker.kept(("golay",), _golay)
    remainder = np.zeros_like(words)
    for bit in range(23):
        remainder ^= (words >> bit & 1) * singles[bit]
    return (words ^ errors[remainder]) >> 11


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `fps`, key) of all keys of each fingerprint."""
    near = []
    for start, width in SEGMENTS:
        segment = (fps >> np.uint64(start)).astype(np.int64) & ((1 << width) - 1)
        near.append(np.stack([golay_index(segment)] + [golay_index(segment ^ (1 << b)) for b in range(width)], axis=1))
    out = []
    for pair, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = near[x], near[y]
        keys = np.concatenate([a << 12 | b[:, :1], a[:, :1] << 12 | b[:, 1:]], axis=1) | pair << 24
        keys.sort(axis=1)
        first = np.ones(keys.shape, dtype=bool)
        first[:, 1:] = keys[:, 1:] != keys[:, :-1]
        out.append((np.nonzero(first)[0], keys[first]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _stars(fps: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links of each member to the first of its component in this group."""
    left, links = fps, []
    while len(left) > 1:
        root, left = left[0], left[1:]
        wave = [root]
        while wave and len(left):
            near = np.bitwise_count(left ^ wave.pop()) <= limit
            if near.any():
                found, left = left[near], left[~near]
                links += [(int(f), int(root)) for f in found]
                wave += list(found)
    return links


def _links_of_runs(group: np.ndarray, fps: np.ndarray, limit: int) -> pd.DataFrame:
    """Links within runs of equal `group`; the rows are sorted by it."""
    breaks = np.flatnonzero(group[1:] != group[:-1]) + 1
    starts = np.concatenate([[0], breaks])
    sizes = np.diff(np.concatenate([starts, [len(group)]]))
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    small = size_of <= 8
    for step in range(1, 8):
        at = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= limit]
        left.append(fps[at])
        right.append(fps[at + step])
    more = [link for s, n in zip(starts[sizes > 8], sizes[sizes > 8]) for link in _stars(fps[s:s + n], limit)]
    pairs = np.array(more, dtype=np.uint64).reshape(-1, 2)
    return pd.DataFrame({"a": np.concatenate([*left, pairs[:, 0]]).view(np.int64), "b": np.concatenate([*right, pairs[:, 1]]).view(np.int64)}).drop_duplicates()


def links(fps: DataFrame, max_distance: int = 4, block: int = 2048) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` within `max_distance` bits.

    Not every such pair is given, but each one's ends are connected by links,
    and every link is within the distance.
    """
    if not 0 <= max_distance <= 4:
        raise ValueError("the segments answer for distances up to 4")
    distinct = fps.select("fp").where("fp is not null").distinct()

    def emit(batches):
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in range(0, len(bits), 2048):
                at, keys = keys_of(bits[part:part + 2048])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(bits[part:part + 2048][at].view(np.int64))], names=["key", "fp"])

    def compare(frames):
        held_group, held_fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for frame in frames:
            group = np.concatenate([held_group, frame["group"].to_numpy()])
            values = np.concatenate([held_fps, frame["fp"].to_numpy().view(np.uint64)])
            done = np.searchsorted(group, group[-1]) if len(group) else 0  # the last group may go on
            held_group, held_fps = group[done:], values[done:]
            if done:
                yield _links_of_runs(group[:done], values[:done], max_distance)
        if len(held_group):
            yield _links_of_runs(held_group, held_fps, max_distance)

    members = distinct.mapInArrow(emit, "key long, fp long")
    large = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * block).select(
        F.col("key").alias("large_key"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = F.when(F.col("blocks").isNull(), F.array(F.col("key"))).otherwise(
        # a group's number: the key, and the two blocks that meet in it
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.xxhash64("key", F.least(own, other), F.greatest(own, other))))
    grouped = members.join(large, F.col("key") == F.col("large_key"), "left").select(F.explode(dealt).alias("group"), "fp")
    return grouped.repartition("group").sortWithinPartitions("group").mapInPandas(compare, "a long, b long")


def _named(classes: DataFrame, max_distance: int) -> DataFrame:
    """(fp, least, component) of each distinct fingerprint of `classes` (fp, least)."""
    of_class = components(links(classes, max_distance))
    return classes.join(of_class, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, max_distance: int = 4, seed: int = 42) -> DataFrame:
    """Per row of `docs`: key, fingerprint (16 hex digits), component_id.

    Rows link whose fingerprints differ in at most `max_distance` bits;
    `component_id` is the least key reachable. Null and empty texts have the
    fingerprint 0 and link like any other. A null key stays null and is no
    component's least unless all keys in it are null. Repeated rows give
    repeated results with one component; an empty table gives none.
    """
    own, t = worker.columns([key, text])
    rows = cut_lineage(fingerprints(docs.select(own.alias("key"), t.alias("text")), words=words, seed=seed))
    named = _named(cut_lineage(rows.groupBy("fp").agg(F.min("key").alias("least"))), max_distance)
    named = cut_lineage(named)
    # a component of one class has its least key already; the others' are few rows
    least = cut_lineage(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    ids = named.join(worker.sized(least.drop("n")), "component", "left").select(F.col("fp").alias("class_fp"), F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(ids, F.col("fp") == F.col("class_fp")).select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, max_distance: int = 4, seed: int = 42) -> DataFrame:
    """One row of each component of `near_duplicates`, whole: the one with the least key.

    Rows without a key stay only where no other row of their component has
    one. Rows that repeat the least key go by the fingerprint and then by the
    text's hash.

    Each text is read once for its fingerprint, which is written beside the
    row. Components are found from keys and fingerprints alone; the rows that
    go are then left out by an anti join with their (key, fingerprint), which
    moves no text while these fit a broadcast of checked size.
    """
    spark, at, names = docs.sparkSession, docs.columns.index(text), docs.columns
    whole = docs.select(F.struct(*worker.columns(names)).alias("row"), worker.columns([key])[0].alias("key"))

    def tag(batches):
        worker.only("golay")
        for batch in batches:
            bits = np.array([fingerprint(t, words, seed) for t in worker.texts(batch.column("row").field(at))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits.view(np.int64))], names=["row", "key", "fp"])

    path = scratch_path(spark, "simhash-rows")
    whole.mapInArrow(tag, T.StructType([*whole.schema.fields, T.StructField("fp", T.LongType())])).write.parquet(path)
    tagged = spark.read.parquet(path)
    pairs = cut_lineage(tagged.groupBy("key", "fp").agg(F.count(F.lit(1)).alias("n")))
    least = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key")).alias("least")
    named = _named(cut_lineage(pairs.groupBy("fp").agg(least)), max_distance)
    first = named.groupBy("component").agg(F.min(F.struct("least.unnamed", "least.key", "fp")).alias("first"))
    kept = cut_lineage(first.select(F.col("first.key").alias("kept_key"), F.col("first.fp").alias("kept_fp")))

    def matching(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, left["key"].eqNullSafe(right["kept_key"]) & (left["fp"] == right["kept_fp"]), how)

    def named_like(table: DataFrame) -> DataFrame:
        return cut_lineage(table.select(F.col("key").alias("kept_key"), F.col("fp").alias("kept_fp")))

    gone = named_like(matching(pairs, kept, "left_anti"))
    repeated = named_like(matching(pairs.where("n > 1"), kept, "left_semi"))
    staying = matching(tagged, worker.sized(gone), "left_anti")
    if repeated.isEmpty():
        return staying.select("row.*")
    rank = F.row_number().over(Window.partitionBy("key", "fp").orderBy(F.xxhash64(F.col("row").getField(text))))
    several = matching(tagged, worker.sized(repeated), "left_semi").withColumn("rank", rank).where("rank = 1")
    return matching(staying, worker.sized(repeated), "left_anti").select("row.*").unionByName(several.select("row.*"))
