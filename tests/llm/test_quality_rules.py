"""Line-first quality rules against a plain version."""

import re
from collections import Counter

import pytest

from listwright.llm import quality_rules as qr

COLUMNS = (*qr.COUNTS, "base_failed", "kept", "n_lines_failed", "lost_chars")


def fails(line):
    items = line.count(" ") + 1
    separators = len(re.findall(qr.SEPARATOR, line))
    return (not re.search(qr.SENTENCE_END.replace("$)", r"\Z)"), line) or 2 * len(re.findall(qr.SYMBOL, line)) > items or 2 * line.count("!") > items
            or (separators >= 2 and 3 * separators >= items) or any(p in line.lower() for p in qr.BOILERPLATE))


def plain(text):
    text = text or ""
    words = re.findall(qr.WORD, text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(qr.WORD, line)]
    bad = [line for line in lines if fails(line)]
    lost = sum(map(len, bad))
    base = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(qr.SYMBOL, text)), len(lines) - len(set(lines)), len(repeated), base,
            not base and 2 * lost <= sum(map(len, lines)), len(bad), lost)


PROSE = "The house by the river was old, and nobody had lived there for years. \"Who goes there?\" she asked."
OTHER = "Further up the hill, a mill turned slowly; its owner had gone to town."
TEXTS = [
    None, "", " \n\t\x0b\f\r ", "word", PROSE, f"{PROSE}\nHome | News | Contact | About\n{OTHER}", "Home | News | Contact | About us | Log in | Help | More | Map | Jobs | Ads.",
    "WIN!! NOW!! BUY!! IT!! ALL!! OR!! NONE!! TODAY!! OR!! NEVER!!", "a*** b*** c### d&&& e$$$ f%%% g### h### i&&& j*** k.", "All rights reserved. " + PROSE, "no end mark here but many many words in one single line of text",
    "a b c d e a b c d e", "a a a a a a a a a a a a.", "one two three four five six. " * 3, f"\n\n{PROSE}\n\n\n{PROSE}\n", "ä" * 4000 + ". " + "w. " * 300, "x y z 1 2 3 4 5 6 7.\r\nx y z.\r\n",
    " ".join(f"w{i % 997}" for i in range(60_000)) + ".", "🙂 " * 30 + ".", "Cookie settings.\n" * 20, "a. " * 9 + " b. c d. e\x85f.",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, PROSE), (4, PROSE)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' AS kept", "1 AS `a.b`", "2 AS row", "3 AS t", "4 AS words").repartition(3)


def test_counts_and_verdicts(docs):
    rows = qr.summary(docs).collect()
    got = sorted(repr((r["doc_id"], *(r[c] for c in COLUMNS))) for r in rows)
    assert got == sorted(repr((r["doc_id"], *plain(r["text"]))) for r in docs.collect())
    assert qr.summary(docs.limit(0)).collect() == []


def test_plan_is_native(docs):
    plan = qr.summary(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


def test_cleaning(docs):
    out = qr.clean(docs)
    assert out.columns == ["doc_id", "text", "a.b", "row", "t", "words", "cleaned", "kept"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[5]["cleaned"] == f"{PROSE}\n{OTHER}" and rows[5]["kept"]
    assert rows[0]["cleaned"] == "" and rows[0]["text"] is None and not rows[0]["kept"] and not rows[6]["kept"] and not rows[7]["kept"]
    assert rows[4]["a.b"] == 1 and rows[4]["words"] == 4
    strict = {r["doc_id"]: r["kept"] for r in qr.clean(docs, max_lost=0.0).collect()}
    assert strict[4] and not strict[5]


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    verdicts = qr.summary(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    good, bad = ([r["kept"] for r in verdicts if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad) and bad
