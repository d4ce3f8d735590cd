"""Hard negatives against plain inner products."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from listwright.llm import hard_negatives as hn

OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, every, positives=5, negatives=3):
    """rows: (id, vector, label); all pairs with Python integers."""
    usable = {}
    for i, v, label in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[1], r[2])):
        if all(x is not None and abs(x) < float("inf") for x in v):
            usable.setdefault(i, ([math.floor(Fraction(x) * 256) for x in v], label))
    score = lambda a, b: sum(x * y for x, y in zip(usable[a][0], usable[b][0]))
    out = []
    for a in usable:
        if a % every:
            continue
        same = sorted((-score(a, b), b) for b in usable if b != a and usable[b][1] == usable[a][1])[:positives]
        other = sorted((-score(a, b), b) for b in usable if usable[b][1] != usable[a][1])
        for p, b in same:
            found = [(s, c) for s, c in other if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(a, b, k, c, -p, -s) for k, (s, c) in enumerate(found, 1)]
    return sorted(out)


def mined(frame, every=50, **options):
    return sorted(tuple(r[c] for c in OUT) for r in hn.mine(frame, F.col("vec_id") % every == 0, **options).collect())


@pytest.mark.parametrize("sizes", [{}, {"anchors_per_block": 7, "rows_per_block": 150}])
def test_mining(spark, sizes):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 11))
    rows = [(int(i), (centres[rng.integers(4)] + rng.normal(size=11) * 0.4 * (i % 4)).tolist(), int(i % 3 if i % 5 else 0)) for i in range(700)]
    rows += [(700 + i, [0.5] * 11, i % 2) for i in range(200)]  # many equal rows: ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"rank": F.lit("x"), "id": F.lit(3), "a.b": F.lit(1)})
    got = mined(frame, 20, **sizes)
    assert got == plain(rows, 20) and len(got) > 100


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (50, [1.0], 1), (1, None, 1), (2, [float("nan"), 1.0], 1), (None, [1.0, 1.0], 1), (3, [], 1), (4, [None, 1.0], 1), (6, [0.9, 1.0], 2), (7, [0.7], 2),
            (0, [1.0, 2.0], 1), (100, [float("inf")], 2), (8, [-1.0, -1.0], 2), (9, [1.5, 0.5], None), (10, [1.0, 1.4], 2), (11, [0.0], 2), (12, [1.0, 1.2, 5.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = mined(frame)
    assert got == plain([(i, v if v is None else v + [0.0] * (3 - len(v)), label) for i, v, label in rows], 50) and got
    assert mined(frame.limit(0)) == []
    assert hn.mine(frame.limit(0), F.col("vec_id") % 50 == 0).columns == list(OUT)


def test_huge_components(spark):
    rows = [(0, [1e30, -3.0], 1), (1, [1e29, 7.0], 1), (2, [6e28, 1.0], 2), (3, [5.5e28, 1.0], 2), (4, [-1e200, 0.0], 2), (5, [9e28, 0.0], 2), (6, [9.6e28, 0.0], 2), (7, [1e10, 5.0], 1), (8, [-1.7e308, 0.0], 2)]
    top = 2**63 - 1
    want = [(a, b, k, c, min(top, p), min(top, n)) for a, b, k, c, p, n in plain(rows, 50)]
    assert mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == want and len(want) == 3


def test_lookups_are_inner_products():
    rng = random.Random(1)
    for bits in (3, 9, 40, 70):
        anchors = [np.array([rng.randrange(-(1 << bits), 1 << bits) for _ in range(13)], dtype=object if bits > 60 else np.int64) for _ in range(5)]
        rows = [np.array([rng.choice([0, -1, rng.randrange(-(1 << b), 1 << b)]) for _ in range(13)], dtype=object if bits > 60 else np.int64) for b in (1, bits, bits) for _ in range(4)]
        planes = hn.unpack([hn.pack(r) for r in rows], [2] * len(rows), 2)
        got = hn.Tables(anchors, 2, planes.shape[0]).scores(planes)
        assert [[int(x) for x in g] for g in got] == [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]


def test_sortable():
    numbers = sorted([0, 5, -5, 10, -10, 99, -99, 10**40, -(10**40), 10**40 + 1, 7, -1])
    assert sorted(numbers, key=hn._sortable) == numbers
