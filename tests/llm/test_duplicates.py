"""SimHash groups, components and SpotSigs against brute force."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from listwright.llm import simhash, spotsigs
from listwright.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, limit):
    fps = np.array(fps, dtype=np.uint64)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= limit) + i + 1:
            parent[root(int(j))] = root(i)
    return [root(i) for i in range(len(fps))]


def same_groups(a, b):
    return len(set(a)) == len(set(b)) == len(set(zip(a, b)))


def test_fingerprint():
    for t in (None, "", " \n", "one", "One TWO", "a b c d", "a b c d e A B C D e " * 30, "É é ſ K x \x1cy \x0bz", "w " * 20000):
        assert simhash.fingerprint(t or "") == plain_fingerprint(t)


@pytest.mark.parametrize("limit, block", [(4, 2048), (4, 40), (1, 2048), (0, 2048)])
def test_links_join_what_is_close(spark, limit, block):
    rng = np.random.default_rng(limit)
    fps = []
    for base in rng.integers(0, 2**63, 120, dtype=np.uint64):
        x = base
        for _ in range(rng.integers(1, 12)):
            fps.append(int(x))
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= np.uint64(1) << np.uint64(bit)
    dense = int(rng.integers(0, 2**63))
    fps += [dense ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 30, (600, 2))]
    fps = sorted(set(np.array(fps + [0, 2**64 - 1], dtype=np.uint64).view(np.int64).tolist()))
    found = simhash.links(spark.createDataFrame(pd.DataFrame({"fp": fps})), limit, block).collect()
    distance = [bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") for r in found]
    assert all(d <= limit for d in distance)
    of = {r["node"]: r["component"] for r in components(spark.createDataFrame([(r["a"], r["b"]) for r in found], "a long, b long")).collect()}
    want = plain_components(np.array(fps, dtype=np.int64).view(np.uint64), limit)
    assert same_groups([of.get(x, x) for x in fps], want)


def test_near_duplicates(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here to there " * 20
    rows = [(9, base), (4, base + "end"), (5, base.upper()), (3, "other words are in this text " * 30), (8, None), (7, ""), (2, "   "), (None, base), (9, base), (6, "one"), (None, "alone here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(fps, 4)
    least = {g: min((k for (k, _), h in zip(rows, groups) if h == g and k is not None), default=None) for g in groups}
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got], key=key) == sorted(
        [(k, f"{f:016x}", least[g]) for (k, _), f, g in zip(rows, fps, groups)], key=key)
    first = simhash.keep_first(docs)
    assert first.columns == docs.columns
    kept = first.collect()
    assert len(kept) == len(set(groups))
    assert sorted([r["doc_id"] for r in kept], key=lambda x: (x is not None, x)) == sorted(least.values(), key=lambda x: (x is not None, x))
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).collect() == simhash.keep_first(empty).collect() == []


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(700)] + [(5, 5), (None, 3), (2000, 1000), (2000, 1000), (3000, 2000)]
    of = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert of == {**{i: 0 for i in range(701)}, 1000: 1000, 2000: 1000, 3000: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_signatures_are_local():
    rng = np.random.default_rng(0)
    words = ["the", "of", "and", *[f"w{i}" for i in range(300)]]
    text = " ".join(rng.choice(words, 900, p=[0.08] * 3 + [0.76 / 300] * 300))
    a, b = spotsigs.signatures(text), spotsigs.signatures(text[:-40])
    assert spotsigs.likeness(a, a) == 1.0 and spotsigs.likeness(a, b) > 0.9
    assert spotsigs.likeness(a, spotsigs.signatures(" ".join(rng.choice(words[3:], 900)))) < 0.1
    assert len(spotsigs.signatures("")) == len(spotsigs.signatures("?! ...")) == 0
    assert spotsigs.likeness(spotsigs.signatures(""), spotsigs.signatures("")) == 1.0


@pytest.mark.parametrize("rows_per_range", [10_000, 7])
def test_edited_likeness(spark, rows_per_range):
    rng = np.random.default_rng(1)
    words = ["the", "of", "und", "é🙂", *[f"w{i}" for i in range(50)]]
    rows = [(i * 3, " ".join(rng.choice(words, int(rng.integers(0, 60))))) for i in range(60)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, extra int").repartition(5)
    got = {r["doc_id"]: r for r in spotsigs.edited_likeness(docs, rows_per_range=rows_per_range).collect()}
    assert len(got) == len(rows)
    rows.sort(reverse=True)
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        own, changed, other = (set(spotsigs.signatures(x).tolist()) for x in (t, edited, after))
        r = got[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for value, s in ((r["near_edited"], changed), (r["near_next"], other)):
            assert value == pytest.approx(len(own & s) / len(own | s) if own | s else 1.0)
        assert r["fingerprint"] == "".join(f"{x:08x}" for x in sorted(own))


def test_edited_likeness_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, "a b the c d e"), (None, "the x y"), (None, None), (5, ""), (1, "a b the c d e")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in spotsigs.edited_likeness(docs).collect()) == [(0, 0), (0, 7), (1, 0), (1, 13), (1, 13), (5, 0)]
    one = spotsigs.edited_likeness(docs.where("doc_id = 5")).collect()
    assert [(r["near_edited"], r["near_next"]) for r in one] == [(1.0, 1.0)]
    assert spotsigs.edited_likeness(docs.limit(0)).collect() == []


@pytest.mark.parametrize("rows_per_range", [10_000, 5])
def test_repeated_and_null_keys_are_split(spark, rows_per_range):
    rows = [(None, f"the text number {i} of null") for i in range(40)] + [(7, f"a seventh text {i % 30} and more") for i in range(50)] + [(i, f"the row {i}") for i in range(20)] + [(-(1 << 63), "least of all keys")]
    docs = spark.createDataFrame(rows, "`a.id` long, text string").repartition(6)
    got = sorted(repr((r["a.id"], r["n_chars"], r["edited_sha256"])) for r in spotsigs.edited_likeness(docs, "a.id", rows_per_range=rows_per_range).collect())
    tie = lambda t: xxhash.xxh64_intdigest(t.encode()) >> 1
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), tie(r[1])))
    want = []
    for i, (k, t) in enumerate(order):
        edited = t[:len(t) - len(t) // 3] + order[(i + 1) % len(order)][1][:len(t) // 3]
        want.append(repr((k, len(t), hashlib.sha256(edited.encode()).hexdigest())))
    assert got == sorted(want)


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_similar(spark, threshold):
    rng = np.random.default_rng(2)
    words = ["the", "of", *[f"w{i}" for i in range(200)]]
    rows, text = [], []
    for i in range(120):
        text = list(rng.choice(words, 80, p=[0.15] * 2 + [0.7 / 200] * 200)) if i % 6 == 0 else text[:]
        if i % 6:
            text[int(rng.integers(80))] = "edit"
        rows.append((i, " ".join(text)))
    rows += [(500, rows[0][1]), (501, None), (502, ""), (None, rows[0][1])]
    got = spotsigs.similar(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()
    sets = {k: frozenset(spotsigs.signatures(t or "").tolist()) for k, t in rows}
    distinct = list(set(sets.values()))
    parent, n = {s: s for s in distinct}, dict.fromkeys(distinct, 0)

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if a and b and len(a & b) / len(a | b) >= threshold - 1e-12:
                n[a] += 1
                n[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, s in sets.items():
        if k is not None:
            least[root(s)] = min(k, least.get(root(s), k))
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in got} == {(k, least[root(s)], n[s]) for k, s in sets.items()}
    assert spotsigs.similar(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        spotsigs.similar(spark.createDataFrame([], "doc_id long, text string").withColumn("x", F.lit(1)), threshold=0)
