"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from listwright.llm import runs
from listwright.llm.queries import op11_runs

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of all maximal runs, period by period."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i:
                if j + q - i >= max(6, 4 * q) and not any(q % k == 0 and s <= i and j + q <= s + n for s, n, k in out):
                    out.append((i, j + q - i, q))
                i = j
            i += 1
    return sorted((s, n, q) for s, n, q in out)


def kept_words(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(rng):
    letters = rng.choice([1, 2, 3, 5, 40])
    words = [f"w{rng.randrange(letters)}" for _ in range(rng.choice([0, 1, 5, 6, 7, 30, 120]))]
    for _ in range(rng.randrange(4)):
        p = rng.randint(1, 11)
        unit = [f"w{rng.randrange(letters + 2)}" for _ in range(p)]
        at = rng.randint(0, len(words))
        words[at:at] = (unit * 9)[:rng.randint(2, 9 * p)]
    return words * rng.choice([1, 1, 1, 2, 5])


@pytest.mark.parametrize("candidates", [1 << 20, 7])
def test_random_texts(monkeypatch, candidates):
    monkeypatch.setattr(runs, "CANDIDATES", candidates)
    rng = random.Random(3)
    for _ in range(400 if candidates > 7 else 150):
        group = [random_words(rng) for _ in range(rng.randint(1, 5))]
        for words, (n, found, collapsed) in zip(group, runs._found(" \n".join(w) for w in group)):
            assert n == len(words) and found == plain_runs(words), words
            assert collapsed == " ".join(kept_words(words, found))


def test_powers_and_words_of_fibonacci():
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    for words in (["x"] * 5000, ["x", "y"] * 3000, b, b * 5, (["x"] * 40 + ["y"]) * 12):
        ((n, found, _),) = runs._found([" ".join(words)])
        assert found == plain_runs(words)


def test_grammar_expands_to_the_text():
    """Every nonterminal's places spell what its first place spells, and no pair of the start rules repeats."""
    rng = random.Random(5)
    words = [rng.randrange(6) for _ in range(3000)] * 2 + [7] * 100
    ids, text = np.array(words), np.repeat([0, 1], [len(words) // 2, len(words) - len(words) // 2])
    grammar = runs.Grammar(ids, text)
    nodes = np.concatenate(grammar.nodes)
    assert len(nodes) == grammar.count and (nodes[:, 0] < nodes[:, 1]).all() and (nodes[:, 1] < nodes[:, 2]).all()
    for number, starts in grammar.places:
        for i, start in zip(number.tolist(), starts.tolist()):
            first, _, end = nodes[i].tolist()
            assert (ids[first:end] == ids[start:start + end - first]).all() and text[start] == text[start + end - first - 1]
    assert (nodes[:, 2] - nodes[:, 0] > 2).any()


def test_long_text_in_linear_time():
    rng = random.Random(8)
    words = [str(rng.randrange(5000)) for _ in range(150_000)]
    words += words[:40_000] + ["p", "q", "r"] * 30_000
    ((n, found, _),) = runs._found([" ".join(words)])
    assert n == len(words) and (190_000, 90_000, 3) in found and all(q < 100 for _, _, q in found)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    s = q = length = exponent = None
    if found:
        s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
        exponent = 1000 * length // q
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(found), s, length, q, exponent, sha("".join(f"{x},{y},{z}\n" for x, y, z in found)), sha(" ".join(kept_words(words, found)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_plain_search(spark):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op11_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r["doc_id"]: expected(*r) for r in docs}
    assert sum(v[0] > 0 for v in got.values()) > 5


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 6), (4, "a " * 6), (5, "é ü " * 5 + "🙂\x0b🙂"), (None, "x y z " * 9), (6, "b " * 3000), (7, "one")] + [(i, "p q r s " * 9) for i in range(100, 160)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'k' AS runs", "1 AS `a.b`", "2 AS row").repartition(3)


def test_odd_rows(odd):
    rows = runs.digests(runs.planted(odd)).collect()
    assert sorted(map(repr, ((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows))) == sorted(repr((r["doc_id"], *expected(r["doc_id"], r["text"]))) for r in odd.collect())
    assert runs.digests(odd.limit(0)).collect() == []
    found = runs.find(odd)
    assert found.columns == ["doc_id", "text", "a.b", "row", "n_words", "runs", "collapsed"]
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[4]["collapsed"] == "a" and by_id[1]["collapsed"] == "" and by_id[1]["text"] is None
    assert [tuple(x) for x in by_id[None]["runs"]] == [(0, 27, 3)] and by_id[6]["row"] == 2
