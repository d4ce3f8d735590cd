"""Encoding, decoding, counting and packing against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from listwright.llm import bpe, packing, token_counts, worker
from listwright.llm.queries import byte_bpe

TEXTS = [
    None, "", " ", "the", "it's we'LL don't\n\n  x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext", "  \t \x1c\x85\xa0　 z ",
    "Ünïcödé ½²③ ǅ 漢字かな 한국어 العربية हिन्दी 🙂👩‍👩‍👧", "x" * 5000, "ab" * 3000 + " " * 3000 + "!?" * 999, "0123456789 " * 40, "the", "\x00\x01﻿￿",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_bpe())


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(byte_bpe())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "extra") for i, t in enumerate(TEXTS)] + [(None, "no key", "x")], "doc_id long, text string, ids string").repartition(3)


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, dtype="<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(alphabet="thersanding 'lo.0é\n", max_size=60))
def test_the_packings_encoder_is_the_same(library, text):
    packer = worker.kept(("test", "packing"), lambda: packing.Encoder(byte_bpe(), 1000))
    assert ids_of(packer.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_the_packings_encoder_checks_the_librarys_result(own):
    """Whatever the library gives, tokens that don't fit are encoded anew."""
    packer = packing.Encoder(byte_bpe(), 1000)
    text = "The thandering of unthinkable sentences " + "x" * 500
    packer.merge = lambda piece: [own.rank[c] for c in piece.encode().decode("latin-1")]
    assert packer.encode(text) == own.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(alphabet="thersanding 'lo.0é\n", max_size=60))
def test_encoding_is_the_librarys(own, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    packed = own.encode(text)
    assert ids_of(packed) == want
    assert own.decode(np.frombuffer(packed, dtype="<u4")).decode(errors="replace") == library.decode(want, skip_special_tokens=False) == text


def test_every_token_encodes_to_itself(own):
    assert [n for n, i in own.rank.items() if own.encode_piece(n.encode("latin-1").decode("utf-8", "replace")) != own.packed[i] and "�" not in n.encode("latin-1").decode("utf-8", "replace")] == []


def test_any_ids_decode_as_by_the_library(own, library):
    rng = np.random.default_rng(7)
    for n in (1, 2, 50, 1000):
        ids = rng.integers(0, 50257, n)
        assert own.decode(ids).decode(errors="replace") == library.decode(ids.tolist(), skip_special_tokens=False)


def test_encode_and_decode_frames(spark, docs, library):
    encoded = bpe.encode(docs, byte_bpe())
    assert encoded.columns == ["doc_id", "text", "ids"]
    back = bpe.decode(encoded, byte_bpe()).collect()
    assert len(back) == len(TEXTS) + 1
    assert all(r["decoded"] == (r["text"] or "") and r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids for r in back)
    odd = spark.createDataFrame([([1, None, 70000, -5, 2],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(odd, byte_bpe()).collect()] == [library.decode([1, 2]), "", ""]


def test_digests(docs, library):
    rows = bpe.digests(docs, byte_bpe()).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = "no key" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        ids = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.digests(docs.limit(0), byte_bpe()).collect() == []


@pytest.mark.parametrize("given_table", [None, {}, {" the": 1}])
def test_counts(docs, library, given_table):
    rows = token_counts.token_counts(docs, byte_bpe(), limit=100, table=given_table).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = "no key" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 100)
    assert token_counts.token_counts(docs.limit(0), byte_bpe()).collect() == []


def test_frequent_lengths_are_bounded_and_right(spark, library):
    docs = spark.createDataFrame([("the cat thntention " * 50 + f" once{i}",) for i in range(40)], "text string")
    table = token_counts.frequent_lengths(docs, byte_bpe(), min_share=0.01, table_limit=3)
    assert len(table) == 3 and " thntention" in table
    assert all(n == len(library.encode(p).ids) for p, n in table.items())


def check_pieces(rows, tokens_of, max_tokens, max_segments, max_loss=None, loss_of=None):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == {k for k, t in tokens_of.items() if t}
    for k, pieces in by_doc.items():
        ids, at = np.array(tokens_of[k], dtype="<u4"), 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= max_tokens and len(pieces) <= max_segments and all(p["sequence_length"] == at for p in pieces)
        if loss_of:
            assert sum(sum(loss_of[p["doc_id"]][p["start"]:p["start"] + p["length"]]) for p in pieces) <= max_loss
        padding += 0 if at & (at - 1) == 0 else max_tokens - at
    return padding


def test_pack_texts(spark, library):
    texts = [t or "" for t in TEXTS] + ["word " * (i % 700) for i in range(400)] + ["hi"] * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    tokens = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert check_pieces(packing.pack_texts(docs, byte_bpe()).collect(), tokens, 1024, 64) == 0
    few = packing.pack_texts(docs, byte_bpe(), max_segments=3, max_tokens=300, with_ids=True).collect()
    assert check_pieces(few, tokens, 300, 3) == 0
    assert all(len(r["ids"]) == r["length"] for r in few)
    assert packing.pack_texts(docs.limit(0), byte_bpe()).collect() == []
    null = packing.pack_texts(spark.createDataFrame([(None, None)], "doc_id long, text string"), byte_bpe()).collect()
    assert [(r["doc_id"], r["length"], r["doc_tokens"]) for r in null] == [(None, 1, 1)]


def test_pack_under_loss_limits(spark):
    rng = np.random.default_rng(3)
    rows, tokens, loss = [], {}, {}
    for i in range(500):
        n = int(rng.integers(0, 900))
        ids, marks = rng.integers(0, 50000, n).tolist(), (rng.random(n) < rng.random()).astype(int).tolist()
        rows.append((i, ids, marks if i % 7 else marks[:n // 2]))
        tokens[i], loss[i] = ids, marks if i % 7 else marks[:n // 2]
    rows += [(1000, None, None), (1001, [], [1]), (1002, [5, 6], None), (1003, [None, 4], [None, 1])]
    tokens |= {1002: [5, 6], 1003: [0, 4]}
    loss |= {1002: [], 1003: [0, 1]}
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss array<int>").repartition(2)
    found = packing.pack(frame, "doc_id", max_tokens=700, max_segments=5, max_loss=150).collect()
    check_pieces(found, tokens, 700, 5, 150, loss)


def test_a_worker_drops_what_other_purposes_left():
    worker.kept(("spent", 1), lambda: "a")
    worker.kept(("used", 1), lambda: "b")
    worker.only("used")
    assert worker.kept(("spent", 1), lambda: "made anew") == "made anew"
    assert worker.kept(("used", 1), lambda: "made anew") == "b"
