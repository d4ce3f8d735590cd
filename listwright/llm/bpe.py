"""Byte-level BPE: exact encoding by backtracking, decoding by an offset table.

Encoding. A sequence of tokens is the BPE encoding of its text exactly when
every adjacent pair is *compatible*, that is, when the encoding of the two
tokens' joint text is this pair. So the encoder walks over a pre-token, takes
at each position the longest token an Aho-Corasick automaton finds there; where
a pair is not compatible it tries shorter ones and steps back where none is
left. A prefix has only one encoding, hence a position that
failed once has failed for good and no position is left twice: the time is
linear in the text. Compatibility is decided by undoing merges from the pair's
border outwards and is remembered in a table.

Decoding. All tokens' bytes lie end to end in one array; the text of a row of
ids is one gather of byte positions computed from the tokens' offsets.

Results equal the tokenizers library's for ``encode(text,
add_special_tokens=False)`` and ``decode(ids, skip_special_tokens=False)``:
strings of special tokens inside a text become their ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.llm import worker

# The pattern that splits a text before the merges, here with the
# most frequent alternative first; no alternative starts with the same
# character class, so the order decides nothing but the contractions, which
# stay before the marks.
WORDS = " ?{L}++|'(?:s|t|re|ve|m|ll|d)| ?{N}++| ?[^{s}{l}{n}]++|[{s}]+(?![^{s}])|[{s}]+"

# Below this code point the classes are a few ranges, which the standard
# library matches twice as fast.
LATIN_END = 0x250


def _ranges(kind: str) -> str:
    """Code points below LATIN_END of a Unicode class, as ranges of a character class."""
    inside = [bool(regex.match(kind, chr(i))) for i in range(LATIN_END)] + [False]
    out, start = [], None
    for i, yes in enumerate(inside):
        if yes and start is None:
            start = i
        elif not yes and start is not None:
            out.append(f"\\u{start:04x}-\\u{i - 1:04x}")
            start = None
    return "".join(out)


class _Pieces(dict):
    """Pre-token -> packed ids, in two generations of bounded size.

    When the young one is full it becomes the old one; what is met again comes
    back from there, so frequent pre-tokens are never encoded twice.
    """

    def __init__(self, bpe: ByteBpe, limit: int) -> None:
        self.bpe, self.limit, self.old = bpe, limit, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = self.bpe.encode_piece(piece)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class ByteBpe:
    """A byte-level BPE of a tokenizers JSON file."""

    def __init__(self, path: str, cache: int = 300_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        # bytes that are not printable stand as characters from U+0100 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        char_of = {b: c for c, b in byte_of.items()}
        latin = {ord(c): b for c, b in byte_of.items()}
        # tokens are numbered by merge rank, after the 256 bytes
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        names = [chr(b) for b in range(256)] + [(a + b).translate(latin) for a, b in pairs]
        self.rank = {name: i for i, name in enumerate(names)}
        self.size = [len(name) for name in names]
        self.longest = max(self.size)
        # the longest shorter token a token begins with, -1 for single bytes
        self.shorter = [next((self.rank[name[:k]] for k in range(len(name) - 1, 0, -1) if name[:k] in self.rank), -1) for name in names]
        self.ids = [vocab[char_of[b]] for b in range(256)] + [vocab[a + b] for a, b in pairs]
        self.parts = [(i, i) for i in range(256)] + [(self.rank[a.translate(latin)], self.rank[b.translate(latin)]) for a, b in pairs]
        self.merged = {p: 256 + i for i, p in enumerate(self.parts[256:])}
        self.automaton = ahocorasick.Automaton()
        for name, i in self.rank.items():
            self.automaton.add_word(name, i)
        self.automaton.make_automaton()
        self.packed = [i.to_bytes(4, "little") for i in self.ids]
        self.compatible: dict[int, bool] = {}
        self.pieces = _Pieces(self, cache)

        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        letter, number, space = _ranges(r"\p{L}"), _ranges(r"\p{N}"), _ranges(r"\s")
        self.latin_words = re.compile(WORDS.format(L=f"[{letter}]", N=f"[{number}]", l=letter, n=number, s=space))
        self.words = regex.compile(WORDS.format(L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}", s=r"\s"))
        self.beyond = re.compile(f"[^\\x00-\\u{LATIN_END - 1:04x}]")

        token_bytes = {i: name.encode("latin-1") for i, name in zip(self.ids, names)} | {i: t.encode() for t, i in self.special.items()}
        last = max(token_bytes)
        lengths = np.array([len(token_bytes.get(i, b"")) for i in range(last + 1)], dtype=np.int64)
        self.lengths = lengths
        self.offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(token_bytes.get(i, b"") for i in range(last + 1)), dtype=np.uint8)

    def _check(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' joint text is this very pair.

        Merges are undone from the latest on; a merge across the border that
        would have come before those undone so far rules the pair out.
        """
        parts, merged = self.parts, self.merged
        before = len(parts)
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            if left > right:
                before, left = left, parts[left][1]
                if left == before:  # a single byte
                    before, right = right + 1, parts[right][0]
                    if right + 1 == before:
                        return True
            else:
                before, right = right + 1, parts[right][0]
                if right + 1 == before:
                    before, left = left, parts[left][1]
                    if left == before:
                        return True

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens may stand next to each other, from the table of pairs seen."""
        table, pair = self.compatible, left << 32 | right
        known = table.get(pair)
        if known is None:
            if len(table) >= 400_000:
                table.clear()
            known = table[pair] = self._check(left, right)
        return known

    def _longest_at(self, text: str, pos: int) -> int:
        """The longest token that starts at a position."""
        rest = text[pos:pos + self.longest]
        size = self.automaton.longest_prefix(rest)
        while (token := self.rank.get(rest[:size])) is None:  # on the way to a longer token
            size -= 1
        return token

    def _backtrack(self, text: str, out: list[int], token: int) -> list[int]:
        """The encoding; `out` are the longest tokens up to `token`, the first that doesn't fit."""
        end, size, shorter, known = len(text), self.size, self.shorter, self.compatible.get
        dead = bytearray(end + 1)
        pos = sum([size[t] for t in out])
        while True:
            token = shorter[token]
            while token < 0:  # nothing fits here: step back, never to return
                dead[pos] = 1
                token = out.pop()
                pos -= size[token]
                token = shorter[token]
            while not dead[pos + size[token]]:
                if out:
                    fits = known(out[-1] << 32 | token)
                    if fits is None:
                        fits = self.fits(out[-1], token)
                    if not fits:
                        break
                out.append(token)
                pos += size[token]
                if pos == end:
                    return out
                token = self._longest_at(text, pos)

    def encode_piece(self, piece: str) -> bytes:
        """Packed ids of one pre-token."""
        text = piece if piece.isascii() else piece.encode().decode("latin-1")
        whole = self.rank.get(text)
        if whole is not None:
            return self.packed[whole]
        # the longest tokens one behind the other are the encoding, up to two that don't fit
        out = [token for _, token in self.automaton.iter_long(text)]
        known, left = self.compatible.get, None
        for i, right in enumerate(out):
            if i:
                fits = known(left << 32 | right)
                if fits is None:
                    fits = self.fits(left, right)
                if not fits:
                    out = self._backtrack(text, out[:i], right)
                    break
            left = right
        packed = self.packed
        return b"".join([packed[t] for t in out])

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        return (self.words if self.beyond.search(text) else self.latin_words).findall(text)

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Ordinary text and the special token behind it, in turn."""
        start = 0
        if self.special_split is not None:
            for m in self.special_split.finditer(text):
                yield text[start:m.start()], self.special[m[0]]
                start = m.end()
        yield text[start:], None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for plain, special in self.segments(text):
            out += map(self.pieces.__getitem__, self.split(plain))
            if special is not None:
                out.append(special.to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a row of ids; those outside the vocabulary have none."""
        ids = ids[ids < len(self.lengths)].astype(np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or not ends[-1]:
            return b""
        return self.bytes[np.repeat(self.offsets[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()


def tokenizer(path: str) -> ByteBpe:
    """The tokenizer of `path` in this worker."""
    return worker.kept(("bpe", path), lambda: ByteBpe(path))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds `ids` array<int>, the token ids of column `text`.

    Null and empty texts give an empty array; rows are independent, so
    repeated rows, ties and empty tables need no rule, and other columns pass
    unchanged. A column already named `ids` is replaced.
    """
    kept = [c for c in docs.columns if c != ids]
    fields = docs.select(*worker.columns(kept)).schema.add(ids, T.ArrayType(T.IntegerType()))

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            rows = [np.frombuffer(bpe.encode(t), dtype=np.int32) for t in worker.texts(batch.column(text))]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            values = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, values)], names=[*kept, ids])

    return docs.select(*worker.columns(kept)).mapInArrow(run, fields)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds `text` string, what the token ids of array column `ids` spell.

    Null and empty arrays give the empty text, null elements and ids outside
    the vocabulary spell nothing; bytes that are no UTF-8 read as U+FFFD.
    """
    kept = [c for c in rows.columns if c != text]
    fields = rows.select(*worker.columns(kept)).schema.add(text, "string")

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            spelled = [bpe.decode(np.array([i for i in r.as_py() or [] if i is not None and i >= 0], dtype=np.int64)).decode(errors="replace") for r in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelled, pa.string())], names=[*kept, text])

    return rows.select(*worker.columns(kept)).mapInArrow(run, fields)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: key, n_tokens, ids_sha256, decoded_sha256.

    Encodes each text, decodes the ids and returns digests of both, so that
    whole ids never leave the worker. Null text is the empty text; a null key
    stays null; repeated rows give repeated results.
    """
    source = docs.select(*(c.alias(n) for c, n in zip(worker.columns([key, text]), ("key", "text"))))

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for t in worker.texts(batch.column("text")):
                packed = bpe.encode(t)
                spelled = bpe.decode(np.frombuffer(packed, dtype="<u4"))
                counts.append(len(packed) // 4)
                ids_digests.append(hashlib.sha256(packed).hexdigest())
                text_digests.append(hashlib.sha256(spelled.decode(errors="replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
