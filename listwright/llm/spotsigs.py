"""SpotSigs document fingerprints.

A spot signature is a chain of content words that follow a common word (the
anchor): the anchor and the next `chain` words that are no common words
themselves. A document's fingerprint is the set of its signatures' 32-bit
hashes, written in ascending order as hexadecimal digits; likeness is the
Jaccard measure of two sets. Where common words are missing, as in lists or
foreign text, words whose checksum says so stand in; the first content words of
a text are a signature, so that only a text without words has none. All these
rules look at a few words only: an edit changes no signature farther away.

`similar` joins fingerprints: sets are partitioned by their length, a set
meets only partitions whose lengths still allow the threshold, through the
rarest of its signatures (as many as a match can't avoid), and a meeting counts
only if the signatures behind the shared one can still reach the threshold;
what is left is compared in full.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.llm import worker
from listwright.llm.components import components
from listwright.llm.frequent import frequent
from listwright.session import cut_lineage

# Common words of English, French, German and Spanish prose.
ANCHORS = frozenset("""
a an and are as at be been but by can do for from had has have he her his i if in into is it its no not of on or our she so that
the their them then there these they this to was we were what when which who will with would you your
au aux avec ce ces dans de des du elle en est et être il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui sa
se ses son sont sur un une vous
als am auch auf aus bei bin bis das dass dem den der die dies durch ein eine einem einen einer er es für hat ich ihr im ist kann
mit nach nicht noch nur oder sein sich sie sind über um und uns von vor war werden wie wir zu zum zur
al como con del desde donde el ella ellos era esta este fue ha hay la las lo los más me mi muy nos o para pero por porque se ser
si sin sobre su sus también te tiene todo una uno unos y ya
""".split())
SPARSE = 4  # without a common word for so many words, about one in so many others is an anchor
_WORD = re.compile(r"[^\W_]+")


def signatures(text: str, chain: int = 2, anchors: frozenset[str] = ANCHORS) -> np.ndarray:
    """The sorted distinct hashes of a text's spot signatures."""
    words = _WORD.findall(text.lower())
    found: set[tuple[str, ...]] = set()
    behind: tuple[str, ...] = ()  # the next content words; fewer where the text ends
    apart = 0  # words since the last anchor
    for word in reversed(words):
        if word in anchors:
            found.add((word, *behind))
            apart = 0
            continue
        apart += 1
        if apart >= SPARSE and zlib.crc32(word.encode()) % SPARSE == 0:
            found.add((word, *behind))
            apart = 0
        behind = (word, *behind[:chain - 1])
    if words:
        found.add(("", *behind))
    return np.array(sorted({xxhash.xxh32_intdigest(" ".join(c)) for c in found}), dtype=np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", out: str = "signatures", chain: int = 2) -> DataFrame:
    """Adds `out` array<long>, the sorted hashes. Null and empty texts, and texts
    without words, have none; other columns pass unchanged, one named `out` is
    replaced; repeated rows and empty tables need no rule."""
    names = [c for c in docs.columns if c != out]

    def run(batches):
        for batch in batches:
            sets = [signatures(t, chain).astype(np.int64) for t in worker.texts(batch.column(text))]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, values)], names=[*names, out])

    return docs.select(*worker.columns(names)).mapInArrow(run, docs.select(*worker.columns(names)).schema.add(out, T.ArrayType(T.LongType())))


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, chain: int = 2) -> DataFrame:
    """Per row of `docs`: key, class_id and n_links.

    Texts with equal signature sets are one class, named by its least key.
    `class_id` is the least class reachable over links of likeness of at least
    `threshold`, `n_links` the number of links of the row's own class. Rows
    without signatures are one class without links. A null key stays null.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0, at most 1")
    rows = cut_lineage(fingerprints(docs.select(*(c.alias(n) for c, n in zip(worker.columns([key, text]), ("key", "text")))), chain=chain).drop("text"))
    # a class is named by a digest of its set, so that a null or repeated key names none
    digest = F.xxhash64("signatures")
    sets = cut_lineage(rows.groupBy("signatures").agg(F.min("key").alias("least")).withColumn("id", digest))
    found = cut_lineage(links(sets.where(F.size("signatures") > 0), threshold))
    node = components(found).withColumnRenamed("component", "root")
    counts = found.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    named = sets.select("id", "least").join(node, F.col("id") == F.col("node"), "left").select("id", "least", F.coalesce("root", "id").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("class_id"))
    classes = named.join(least, "root").join(counts, "id", "left").select("id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.select("key", digest.alias("row_id")).join(classes, F.col("row_id") == F.col("id")).select(F.col("key").alias(key), "class_id", "n_links")


def _length_part(n: Column, threshold: float) -> Column:
    """Partition by set length: sets more than one partition apart differ too much in length."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(threshold)) if threshold < 1 else n.cast("double")).cast("int")


def _common(sets: DataFrame, min_share: float) -> dict[int, int]:
    """Place of the signatures with `min_share` of all, the most frequent last; a bounded table."""
    written = sets.select(F.array_join(F.col("signatures").cast("array<string>"), " ").alias("text"))
    found = frequent(written, "text", str.split, min_share, int(2 / min_share))
    return {int(s): len(found) - i for i, s in enumerate(found)}


def links(sets: DataFrame, threshold: float, min_share: float = 1e-5) -> DataFrame:
    """Links (a, b) between sets (id, signatures) of likeness of at least `threshold`.

    The order of signatures is that of their hashes, but for the most frequent
    ones (`min_share` of all), which come last. A match must share one of each
    set's first n - ceil(t * n) + 1 in any order, so the order decides nothing
    but how many sets meet. Signatures that no other set has among its first
    ones are left out before the sets are joined.
    """
    late = sets.sparkSession.sparkContext.broadcast(_common(sets, min_share))

    def first(batches):
        places = late.value
        for batch in batches:
            out = []
            for name, own in zip(batch.column("id").to_pylist(), batch.column("signatures")):
                ranked = sorted(own.as_py(), key=lambda s: (places.get(s, 0), s))
                n = len(ranked)
                out += [(name, n, i, s) for i, s in enumerate(ranked[:n - math.ceil(n * threshold - 1e-9) + 1])]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["id", "n", "at", "s"])

    entry = sets.select("id", "signatures").mapInArrow(first, "id long, n int, at int, s long")
    shared = entry.withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("s"))).where("sets > 1").drop("sets")
    shared = cut_lineage(shared.withColumn("part", _length_part(F.col("n"), threshold)))
    left = shared.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("at").alias("i"), "s", "part")
    right = shared.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("at").alias("j"), "s", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    met = left.join(right, ["s", "part"]).where(
        (F.col("nb") < F.col("na")) & (F.col("nb") >= F.col("na") * threshold - 1e-9) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    # behind the first shared signature no more can be shared than either set has left
    most = F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"))
    met = met.where(most >= (F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - 1e-9)
    pairs = met.select("a", "b").distinct()
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("signatures").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("signatures").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common / (F.size("sa") + F.size("sb") - common) >= threshold - 1e-12).select("a", "b")


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", chain: int = 2, rows_per_range: int = 10_000) -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last third (floor) replaced by the
    beginning of the next row in descending order of the integer key, as long
    or as much as there is; the last row's next is the first row. Rows of one
    key follow in the order of their texts' hashes, null keys come last, a
    null text counts as empty; a single row is its own next; an empty table
    gives no row.

    The rows are dealt to ranges and sorted within them, which is the only
    shuffle of texts (compressed). A key that more than `rows_per_range` rows
    repeat, null among them, is a range of its own and is dealt to parts by
    its texts' hashes. A range's first row also goes to the range that comes
    before it, so that every row meets its next one. The list of range ends,
    one number for `rows_per_range` rows, travels to the tasks.
    """
    least = -(1 << 63)
    context = docs.sparkSession.sparkContext
    own, t = worker.columns([key, text])
    order = F.coalesce(own.cast("long"), F.lit(least))
    keys = docs.select(order.alias("ord"))
    n_ranges = keys.count() // rows_per_range + 1
    inner = keys.stat.approxQuantile("ord", [i / n_ranges for i in range(1, n_ranges)], 0.2 / n_ranges) if n_ranges > 1 else []
    repeated = keys.groupBy("ord").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_range).collect() if n_ranges > 1 else []
    parts = {r["ord"]: -(-r["n"] // rows_per_range) for r in repeated}
    cuts = sorted({int(x) for x in inner} | set(parts) | {o - 1 for o in parts if o > least})
    widest = max(parts.values(), default=1)
    sent = context.broadcast((np.array(cuts, dtype=np.int64), parts, widest))

    def labels(ords: np.ndarray, ties: list[int] | None) -> np.ndarray:
        """Number of each row's range and part; a higher number comes before, but for the parts of a key."""
        ends, split, width = sent.value
        label = np.searchsorted(ends, ords).astype(np.int64) * width
        if split and ties is not None:
            label += [ties[i] * split[o] >> 63 if o in split else 0 for i, o in enumerate(ords.tolist())]
        return label

    def tie_of(text: bytes) -> int:
        return xxhash.xxh64_intdigest(text) >> 1

    def ranged(batches):
        for batch in batches:
            o = batch.column("ord").to_numpy()
            ties = [tie_of(x.encode()) for x in worker.texts(batch.column("text"))] if sent.value[1] else None
            yield pa.RecordBatch.from_arrays([pa.array(labels(o, ties)), batch.column("ord")], names=["part", "ord"])

    # texts are read here only where a key's rows have to be told apart
    seen = docs.select(order.alias("ord"), (t if parts else F.lit(None).cast("string")).alias("text"))
    firsts = seen.mapInArrow(ranged, "part long, ord long").groupBy("part").agg(F.max("ord").alias("ord")).collect()
    firsts = sorted(firsts, key=lambda r: (-r["ord"], r["part"]))
    # the part before each one, around the end; and the key of its first row
    before = context.broadcast({r["part"]: (r["ord"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)})

    def deal(batches):
        kept: dict[int, tuple] = {}
        pack = zstandard.ZstdCompressor(level=1).compress
        kind = None
        names = ["part", "extra", "ord", "tie", "key", "packed"]
        for batch in batches:
            kind = batch.schema.field("key").type
            o = batch.column("ord").to_numpy()
            texts = [x.encode() for x in worker.texts(batch.column("text"))]
            ties = [tie_of(x) for x in texts]
            packed = [pack(x) for x in texts]
            label = labels(o, ties)
            for i, (value, part) in enumerate(zip(o.tolist(), label.tolist())):
                if value == before.value[part][0] and (part not in kept or ties[i] < kept[part][0]):
                    kept[part] = (ties[i], packed[i])
            n = len(o)
            yield pa.RecordBatch.from_arrays([pa.array(label), pa.array([False] * n), batch.column("ord"), pa.array(ties, pa.int64()), batch.column("key"), pa.array(packed, pa.binary())], names=names)
        if kept:
            values, n = list(kept), len(kept)
            yield pa.RecordBatch.from_arrays([pa.array([before.value[v][1] for v in values], pa.int64()), pa.array([True] * n), pa.array([before.value[v][0] for v in values], pa.int64()), pa.array([kept[v][0] for v in values], pa.int64()), pa.nulls(n, kind), pa.array([kept[v][1] for v in values], pa.binary())], names=names)

    def describe(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        row = None  # the one that waits for its next
        for batch in batches:
            out = []
            for extra, name, packed in zip(batch.column("extra").to_pylist(), batch.column("key").to_pylist(), batch.column("packed")):
                if extra and row is None:
                    continue  # the range has its end already
                text = unpack(packed.as_py()).decode()
                own = signatures(text, chain)
                if row is not None:
                    out.append(_described(*row, text, own, chain))
                row = None if extra else (name, text, own)
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [batch.schema.field("key").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    kind = docs.select(own.alias("key")).schema["key"].dataType.simpleString()
    source = docs.select(order.alias("ord"), own.alias("key"), t.alias("text"))
    dealt = source.mapInArrow(deal, f"part long, extra boolean, ord long, tie long, key {kind}, packed binary")
    # neighbouring parts go to partitions one after the other
    number = F.broadcast(docs.sparkSession.createDataFrame([(r["part"], i) for i, r in enumerate(firsts)], "own_part long, number int"))
    dealt = dealt.join(number, F.col("part") == F.col("own_part")).drop("own_part").repartitionById(max(1, len(firsts)), F.col("number"))
    ready = dealt.sortWithinPartitions("part", "extra", F.desc("ord"), "tie").select("extra", "key", "packed")
    return ready.mapInArrow(describe, f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _described(name, text: str, own: np.ndarray, after: str, after_own: np.ndarray, chain: int) -> tuple:
    """One row of `edited_likeness`."""
    third = len(text) // 3
    edited = text[:len(text) - third] + after[:third]
    changed = signatures(edited, chain)
    return (name, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(changed), likeness(own, changed), likeness(own, after_own))
