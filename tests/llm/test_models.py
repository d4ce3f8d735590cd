"""Search, sharding, language identification, the pipeline and all registered queries."""

import hashlib
import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from listwright.llm import bpe, langid, packing, pii, quality_rules, runs, secret_scan, sharding, simhash, spotsigs, token_counts, topk
from listwright.llm.queries import ORACLE, QUERIES, SHARDS, byte_bpe

SF = "/root/testdata/sf0.001"


def plain_top(rows, k, every):
    ids = np.array([r[0] for r in rows])
    v = np.floor(256 * np.array([r[1] for r in rows], dtype=float)).astype(np.int64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = v @ v[i]
        best = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), int(scores[j])) for j in best]
    return out


def by_query(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("block_rows", [8192, 400])
def test_top_k(spark, block_rows):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 6))
    rows = [(int(i), (centres[rng.integers(12)] + rng.normal(size=6) * 0.05 * (i % 3)).tolist()) for i in range(1500)] + [(1500 + i, [1.0] * 6) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    assert by_query(topk.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=block_rows)) == plain_top(rows, 5, 50)


def test_top_k_of_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0]), (1, None), (2, [float("nan"), 1.0]), (None, [1.0, 1.0]), (3, []), (4, [None, 1.0]), (5, [1.5e308, 1.0]), (0, [1.0, 2.0]), (100, [float("inf")])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = 2**63 - 1
    assert by_query(topk.top_k(frame, F.col("vec_id") % 50 == 0)) == {0: [(5, top), (50, 65536), (3, 0)], 50: [(5, top), (0, 65536), (3, 0)]}
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def given_vectors(n=1000):
    import pyarrow.parquet as pq

    return np.floor(256 * np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist()[:n], dtype=float))


@pytest.mark.parametrize("kind", ["clusters", "given"])
def test_cover_tree_invariants(kind):
    """Nesting, covering and separation by scale, and radii that cover what lies below."""
    rng = np.random.default_rng(4)
    points = given_vectors() if kind == "given" else np.concatenate([rng.normal(size=(400, 5)), np.zeros((300, 5)), rng.normal(size=(300, 5)) * 1e-3 + 4])
    tree = topk.Tree(points)
    away = lambda a, b: np.linalg.norm(points[a][:, None] - points[b][None], axis=2)
    assert len(tree.levels) >= 4 and len(tree.levels[0]) == 1 and len(tree.levels[-1]) > 500
    for i, (scale, level, parents, radii, below) in enumerate(zip(tree.scales, tree.levels, tree.parents, tree.radii, tree.below)):
        apart = away(level, level)
        np.fill_diagonal(apart, np.inf)
        assert len(level) == 1 or apart.min() > scale * (1 - 1e-9) - 1e-6
        if i:
            assert (level[:len(tree.levels[i - 1])] == tree.levels[i - 1]).all() and (tree.below[i - 1] == parents[below]).all()
            assert (np.linalg.norm(points[level] - points[tree.levels[i - 1][parents]], axis=1) <= tree.scales[i - 1] + 1e-5).all()
        assert (np.linalg.norm(points - points[level[below]], axis=1) <= radii[below] + 1e-5).all()


def compared(points, every=10, k=5):
    frame = pd.DataFrame({"id": np.arange(len(points)), "v": list(points), "floor": None}).astype({"floor": "Float64"})
    asked = frame[frame["id"] % every == 0]
    found, _ = topk.search(asked, frame, k, 1.0)
    worst = found.groupby("query_id")["score"].min()
    again = asked.assign(floor=worst.loc[asked["id"]].to_numpy().astype(float))
    same, pairs = topk.search(again, frame, k, 1.0)
    assert found.equals(same)
    return pairs / (len(asked) * len(frame))


def test_clusters_are_pruned():
    """The share of pairs compared once the kth scores are known: small for clusters, all for even directions."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    centres *= 1000 / np.linalg.norm(centres, axis=1)[:, None]
    assert compared(np.floor(centres[rng.integers(40, size=2000)] + rng.normal(size=(2000, 24)) * 12)) < 0.1
    assert compared(given_vectors(2000)) <= 1.0


def test_blocks_apart_do_not_meet(spark):
    """Two far clusters and one vector that a third of the rows share."""
    rng = np.random.default_rng(6)
    rows = [(i, (np.array([50.0, 0, 0]) + rng.normal(size=3)).tolist()) for i in range(700)] + [(700 + i, (np.array([0, 50.0, 0]) + rng.normal(size=3)).tolist()) for i in range(700)] + [(1400 + i, [0.0, 0.0, 30.0]) for i in range(700)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert by_query(topk.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=150, scale=256.0)) == plain_top(rows, 5, 50)
    data, blocks = topk._dealt(frame.selectExpr("vec_id AS id", "embedding AS v"), 256.0, 150)
    sizes = [r["count"] for r in data.groupBy("block").count().collect()]
    assert max(sizes) < 260 and len(sizes) == len(blocks)
    floors = {b: 256.0**2 * 800 for b in blocks["block"]}
    assert sum(len(d) for _, d in topk._meeting(blocks, blocks, floors)) < 0.7 * len(blocks) ** 2


def test_claiming_order():
    """Slot by slot: the shards take turns, each takes the first free slot of its walk."""
    shards, size = [f"s{i}" for i in range(7)], 101
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    walks = [[(number(f"offset {s}") + k * (number(f"step {s}") % (size - 1) + 1)) % size for k in range(size)] for s in shards]
    owner = {}
    while len(owner) < size:
        for i, walk in enumerate(walks):
            free = [slot for slot in walk if slot not in owner]
            if free:
                owner[free[0]] = i
    assert sharding.lookup_table(shards, size) == [owner[i] for i in range(size)]


def test_lookup_table():
    shards = [f"s{i}" for i in range(10)]
    table = sharding.lookup_table(shards, 1009)
    sizes = [table.count(i) for i in range(10)]
    assert max(sizes) - min(sizes) <= 1 and -1 not in table
    fewer = sharding.lookup_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.15 * 1009
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_placement(spark, tmp_path):
    rows = [(i, "t", 5) for i in range(3000)] + [(7, "other", 5)] + [(None, f"t{i}", 5) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    placed = sharding.place(frame, "doc_id", SHARDS)
    got = placed.collect()
    assert len(got) == len(rows) and placed.columns == ["doc_id", "text", "slot", "shard"]
    assert len({r["shard"] for r in got if r["doc_id"] == 7}) == 1
    assert len({r["shard"] for r in got if r["doc_id"] is None}) > 40
    assert all(sharding.lookup_table(SHARDS)[r["slot"]] == r["shard"] for r in got)
    assert sharding.place(frame.limit(0), "doc_id", SHARDS).collect() == []
    odd = sharding.place(frame.selectExpr("doc_id AS `a.id`", "text AS place", "1 AS row", "2 AS shard"), "a.id", SHARDS)
    assert odd.columns == ["a.id", "place", "row", "slot", "shard"]
    assert sorted(r["slot"] for r in odd.where("`a.id` IS NOT NULL").collect()) == sorted(r["slot"] for r in got if r["doc_id"] is not None)
    sharding.write(frame, "doc_id", SHARDS, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_language_of_held_out_rows(documents):
    train, test = documents.where("doc_id % 2 = 0"), documents.where("doc_id % 2 = 1")
    rows = langid.identify(test, langid.train(train), host=F.col("source")).collect()
    assert len(rows) == test.count()
    assert sum(r["language"] == r["lang"] for r in rows) >= 0.99 * len(rows)


def test_evidence_is_fused(spark, documents):
    model = langid.train(documents)
    docs = spark.createDataFrame(
        [(1, "de la", "a.fr", "fr"), (2, "de la", "b.es", "es"), (3, None, "a.fr", "fr"), (4, "12 ##", None, None), (5, "de la", None, "xx"), (6, "漢字" * 50, "a.fr", None)]
        + [(100 + i, "elle est dans la maison que nous avons pour eux", "c.net", None) for i in range(50)] + [(200, "de la", "c.net", None)],
        "doc_id long, text string, host string, language string")
    rows = {r["doc_id"]: r for r in langid.identify(docs, model, host=F.col("host"), declared=F.col("language"), suffix=F.regexp_extract("host", r"\.([a-z]+)$", 1)).collect()}
    assert [rows[i]["language"] for i in (1, 2, 3, 4, 6)] == ["fr", "es", "und", "und", "und"]
    assert rows[200]["language"] == "fr" and rows[5]["language"] in ("fr", "es")
    assert langid.identify(docs.limit(0), model, host=F.col("host")).collect() == []


def test_posteriors_equal_the_plain_formula(spark, documents):
    """Every row's language and confidence against the formula written out, with two levels of hosts and declared languages."""
    rows = documents.where("doc_id % 3 = 0").withColumns({
        "h": F.concat(F.lit("h"), (F.col("doc_id") % 11).cast("string"), F.lit("."), F.col("source")), "d": F.col("source"),
        "say": F.when(F.col("doc_id") % 4 == 0, F.array(*map(F.lit, ("de", "fr", "xx")))[(F.col("doc_id") % 3).cast("int")]), "suf": F.when(F.col("doc_id") % 5 == 0, F.lit("at"))})
    extra = [(90_000, None, "en", "src1", 0, None, None, None, None), (90_001, "and the of", "en", "src1", 0, None, None, None, "mx")]
    rows = rows.union(spark.createDataFrame(extra, rows.schema))
    model = langid.train(documents)
    names = model.languages
    n = len(names)

    def likelihood(text):
        words = " ".join("".join(c if ord(c) >= 128 or c.isalpha() else " " for c in (text or "").lower()).split()).encode()
        data = b" " + words + b" "
        grams = [data[i:i + 3] for i in range(len(data) - 2)] if words else []
        slots = [((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 17 for a, b, c in grams]
        return 0.2 * np.array([sum(float(row[s]) for s in slots) for row in model.table]) if words else None

    def soft(x):
        x = np.exp(x - x.max())
        return x / x.sum()

    data = rows.collect()
    odds = [likelihood(r["text"]) for r in data]
    weights = [np.zeros(n) if o is None else soft(o) for o in odds]
    total = sum(weights) + 1.0
    total[-1] = 1.0
    total /= total.sum()
    total[-1] = min(total[-1], 1e-3)
    known = {c: i for i, c in enumerate(names[:-1])}

    def said(name, sure):
        if name not in known:
            return 0.0
        out = np.full(n, np.log((1 - sure) / (len(known) - 1)))
        out[known[name]] = np.log(sure)
        return out

    def smoothed(members, above):
        own = sum(members, np.zeros(n))
        return (own + 20 * above) / (own.sum() + 20)

    got = {r["doc_id"]: (r["language"], r["confidence"]) for r in langid.identify(rows, model, host=F.col("h"), domain=F.col("d"), declared=F.col("say"), suffix=F.col("suf")).collect()}
    assert len(got) == len(data)
    for r, o in zip(data, odds):
        if o is None:
            assert got[r["doc_id"]] == ("und", 1.0)
            continue
        domain = smoothed([w for x, w in zip(data, weights) if r["d"] is not None and x["d"] == r["d"] and x["h"] is not None or r["d"] is not None and x["d"] == r["d"]], total) if r["d"] is not None else total
        prior = smoothed([w for x, w in zip(data, weights) if x["h"] == r["h"]], domain) if r["h"] is not None else total
        after = soft(o + np.log(prior) + said(r["say"], 0.9) + said({"at": "de", "mx": "es"}.get(r["suf"]), 0.7))
        language, sure = got[r["doc_id"]]
        assert abs(sure - after.max()) < 1e-4 and after[names.index(language)] > after.max() - 1e-4


def test_rare_languages_are_known(spark):
    common = spark.range(100_000).selectExpr("concat('the word number ', id, ' and the other one of them') AS text", "'en' AS lang")
    rare = spark.createDataFrame([("la casa de los que cantan es muy grande y el perro también", "es")] * 3 + [("la mujer que canta en la calle es mi vecina", "es")], "text string, lang string")
    model = langid.train(common.union(rare), rows_per_language=50)
    assert model.languages == ["en", "es", "und"]
    again = langid.train(common.union(rare).repartition(5), rows_per_language=50)
    assert (again.table == model.table).all()
    docs = spark.createDataFrame([(1, "el perro de la vecina es grande y canta"), (2, "the other word and the number of them")], "doc_id long, text string")
    assert {r["doc_id"]: r["language"] for r in langid.identify(docs, model).collect()} == {1: "es", 2: "en"}
    with pytest.raises(ValueError):
        langid.train(spark.range(600).selectExpr("concat('x', id) AS text", "concat('l', id) AS lang"))


def test_long_text_across_parts(documents):
    model = langid.train(documents)
    text = "und die der " * 200_000
    parts = list(langid.slots(text))
    assert len(parts) == 3 and sum(map(len, parts)) == len(text) - 1 + 0 and model.languages[int(model.score(text).argmax())] == "de"


def test_document_evidence(spark):
    docs = spark.createDataFrame([(1, "<html lang=fr><p>x", "https://www.Shop.de/x"), (2, "a < b", "src1"), (3, None, None)], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in docs.select("doc_id", *[c.alias(n) for n, c in langid.document_evidence(docs).items()]).collect()}
    assert tuple(rows[1])[1:] == ("www.shop.de", "shop.de", "de", "fr") and tuple(rows[2])[1:] == ("src1", None, None, None) and tuple(rows[3])[1:] == (None,) * 4


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Language workers start where the package is not on their path."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
from listwright.session import build_session
from listwright.llm import langid
spark = build_session("far", **{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
docs = spark.createDataFrame([(1, "the man and the sea", "en"), (2, "el hombre y la mar", "es")], "doc_id long, text string, lang string")
assert [r["language"] for r in langid.identify(docs, langid.train(docs)).orderBy("doc_id").collect()] == ["en", "es"]
def probe(batches):
    import importlib.util
    for b in batches:
        yield b.select([0]).set_column(0, "doc_id", __import__("pyarrow").array([int(importlib.util.find_spec("listwright") is None)] * len(b), "int64"))
assert docs.mapInArrow(probe, "doc_id long").first()[0] == 1
"""
    script = tmp_path / "far.py"
    script.write_text(code)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def test_without_labels_nothing_is_known(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.train(docs).languages == ["und"]


def test_page_evidence(spark):
    pages = spark.createDataFrame([(1, "https://u@www.Shop.Example.de:80/x", "<!doctype html><HTML class=a lang='de-AT'><script>var x='en';</script><p>ein&nbsp;Text</p>"), (2, None, None), (3, "odd", "plain")], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in langid.page_evidence(pages).collect()}
    assert (rows[1]["host"], rows[1]["domain"], rows[1]["suffix"], rows[1]["declared"]) == ("www.shop.example.de", "example.de", "de", "de")
    assert rows[1]["text"].split() == ["ein", "Text"] and rows[3]["host"] is None and rows[2]["text"] is None


def test_pipeline_stages(spark, documents):
    extra = [(10_000, None, "en", "src0", None), (10_001, "", "en", None, 0), (10_002, "### 123", "en", "src0", 7), (10_003, "write to the man at me@x.org and he is there", "en", "src0", 44)]
    docs = documents.where("doc_id < 300").union(spark.createDataFrame(extra, documents.schema))
    rows = {r["doc_id"]: r for r in docs.collect()}
    found = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, SF)
        seen.append(found)
        if name != "pack":
            assert found.columns == docs.columns
    ids = [[r["doc_id"] for r in s.select("doc_id").collect()] for s in seen]
    assert set(rows) - set(ids[0]) == {10_000, 10_001, 10_002}
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(seen[0]).collect()}
    assert sorted(ids[1]) == sorted(set(groups.values())) == sorted(ids[2])
    clean = {r["doc_id"]: r for r in seen[2].collect()}
    assert clean[10_003]["text"] == "write to the man at [EMAIL] and he is there" and clean[10_003]["n_chars"] == 43
    assert set(ids[3]) == set(ids[2])
    assert sum(r["length"] for r in seen[3].collect()) == sum({r["doc_id"]: r["doc_tokens"] for r in seen[3].collect()}.values())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_queries_run_over_whole_tables(spark, name):
    query = corpus_pipeline.run if name == "pipeline" else QUERIES[name]
    frame = query(spark, SF)
    rows = frame.collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    if name in ("pipeline", "op2_packing"):
        assert {r["doc_id"] for r in rows} <= docs and rows
    elif "doc_id" in frame.columns:
        assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    else:
        assert rows


def test_any_column_names(spark):
    """Keys and texts whose names hold dots and quotes, beside columns named like inner ones."""
    docs = spark.createDataFrame([(1, "the token = abcdefgh of a@b.c", "en"), (2, None, "en"), (None, "the word of it", "en")], "`a.k` long, `t``x.y` string, `l.g` string")
    docs = docs.selectExpr("*", "1 AS key", "2 AS text", "3 AS row", "4 AS fp", "5 AS n")
    k, t = "a.k", "t`x.y"
    path = byte_bpe()
    for rows in (bpe.digests(docs, path, k, t), token_counts.token_counts(docs, path, k, t), packing.pack_texts(docs, path, k, t), secret_scan.summary(docs, k, t), simhash.near_duplicates(docs, k, t),
                 simhash.keep_first(docs, k, t), pii.summary(docs, k, t), pii.redact(docs, t), spotsigs.edited_likeness(docs, k, t), spotsigs.similar(docs, k, t), runs.digests(runs.planted(docs, k, t), k, t),
                 quality_rules.summary(docs, k, t), langid.identify(docs, langid.train(docs, t, "l.g"), t)):
        assert rows.count() >= 3 and (k in rows.columns)


@pytest.mark.parametrize("name", ORACLE)
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = QUERIES[name](spark, SF)
    names = sorted(frame.columns)
    assert sorted(tuple(r[c] for c in names) for r in frame.collect()) == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall())
