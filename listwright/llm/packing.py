"""Vector bin packing of token rows under limits on tokens, segments and loss.

Every sequence has three capacities: tokens, segments (pieces) and
loss-bearing tokens. Full-length pieces become sequences at once; what is left
of each row goes to a pool of bounded size. Sequences are filled one after the
other: of the pieces that fit all three remaining capacities the one with the
largest dot product of its demands and the remaining capacities (both as
shares, weighted by mean demand) goes in. When none fits, a piece is cut to
fill what is left. A sequence that can't be filled, because it has all its
segments or the pool has run dry, is dealt to sequences whose lengths are
powers of two, so that it needs no padding either.

Each partition packs its own rows in one pass with no shuffle: hot sources
change nothing, and a task that is run again gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from listwright.llm import worker
from listwright.llm.bpe import ByteBpe


class Encoder(ByteBpe):
    """The tokens to be packed.

    Pre-tokens met for the first time go to an installed BPE library, which
    merges by the rank of the result and not by a list of pairs. What it gives
    is the encoding exactly when all neighbouring tokens are compatible, so
    that is checked, and a pre-token that fails is encoded by ByteBpe. So are
    very long ones, whose time in the library is not linear.
    """

    def __init__(self, path: str, cache: int) -> None:
        super().__init__(path, cache)
        ranks = {name.encode("latin-1"): i for name, i in self.rank.items()}
        self.merge = tiktoken.Encoding("pre-tokens", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode_piece(self, piece: str) -> bytes:
        if len(piece) > 128:
            return super().encode_piece(piece)
        out, known, left = self.merge(piece), self.compatible.get, -1
        for right in out:
            if left >= 0:
                fits = known(left << 32 | right)
                if fits is None:
                    fits = self.fits(left, right)
                if not fits:
                    return super().encode_piece(piece)
            left = right
        packed = self.packed
        return b"".join([packed[t] for t in out])


# A piece: number of its row, first token, end, and the row's running count of
# loss-bearing tokens (None: every token but a piece's first bears loss).
Piece = tuple[int, int, int, np.ndarray | None]


def loss_of(piece: Piece) -> int:
    _, start, end, running = piece
    return max(0, end - start - 1) if running is None else int(running[end] - running[start])


def powers_of_two(pieces: list[Piece], limit: int) -> Iterator[list[Piece]]:
    """The same tokens in sequences of at most `limit` tokens whose lengths are powers of two."""
    left = sum(end - start for _, start, end, _ in pieces)
    pieces = pieces[::-1]
    while left:
        room = size = min(1 << (left.bit_length() - 1), 1 << (limit.bit_length() - 1))
        out = []
        while room:
            row, start, end, running = pieces.pop()
            cut = min(end, start + room)
            out.append((row, start, cut, running))
            if cut < end:
                pieces.append((row, cut, end, running))
            room -= cut - start
        left -= size
        yield out


class Packer:
    """Packs the pieces of one partition."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, pool: int = 1024) -> None:
        if min(max_tokens, max_segments) < 1 or max_loss < 0:
            raise ValueError("a sequence needs room for a token and a segment")
        self.capacity = np.array([max_tokens, max_segments, max_loss])
        self.pool_size, self.pool = pool, []

    def add(self, row: int, size: int, running: np.ndarray | None = None) -> Iterator[list[Piece]]:
        """Takes in a row of `size` tokens; gives the sequences that are finished."""
        tokens, _, loss = self.capacity.tolist()
        start = 0
        while size - start > tokens or size - start and loss_of((row, start, size, running)) > loss:
            end = min(size, start + tokens)
            piece = self._cut((row, start, end, running), tokens, loss)
            if piece[2] == start:
                raise ValueError("a token bears more loss than a sequence may hold")
            if piece[2] - start == tokens:
                yield [piece]
            else:
                self.pool.append(piece)
            start = piece[2]
        if size > start:
            self.pool.append((row, start, size, running))
        if len(self.pool) >= self.pool_size:
            yield from self._fill(last=False)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._fill(last=True)

    @staticmethod
    def _cut(piece: Piece, tokens: int, loss: int) -> Piece:
        """The longest beginning of a piece within both limits."""
        row, start, end, running = piece
        end = min(end, start + tokens)
        if running is None:
            end = min(end, start + loss + 1)
        else:
            end = start + int(np.searchsorted(running[start:end + 1] - running[start], loss, side="right")) - 1
        return row, start, end, running

    def _fill(self, last: bool) -> Iterator[list[Piece]]:
        """Packs the pool; unless it is the last time, keeps a quarter to choose from."""
        pieces = self.pool
        demand = np.array([(p[2] - p[1], 1, loss_of(p)) for p in pieces], dtype=np.int64).reshape(-1, 3)
        share = demand / np.maximum(self.capacity, 1)
        weights = share.mean(axis=0) if len(pieces) else np.zeros(3)
        free = np.ones(len(pieces), dtype=bool)
        n_free, keep = len(pieces), 0 if last else self.pool_size // 4
        tokens = int(self.capacity[0])
        while n_free > keep:
            room, out = self.capacity.copy(), []
            while n_free and room[0] and room[1]:
                score = np.where(free & (demand <= room).all(axis=1), share @ (weights * room / np.maximum(self.capacity, 1)), -1.0)
                best = int(score.argmax())
                if score[best] >= 0:
                    out.append(pieces[best])
                    room -= demand[best]
                    free[best], n_free = False, n_free - 1
                    continue
                # none fits: the largest one fills what is left
                best = int(np.where(free, demand[:, 0], -1).argmax())
                piece = self._cut(pieces[best], int(room[0]), int(room[2]))
                row, start, end, running = piece
                if end == start:
                    break
                out.append(piece)
                room -= (end - start, 1, loss_of(piece))
                pieces[best] = rest = (row, end, pieces[best][2], running)
                demand[best] = (rest[2] - rest[1], 1, loss_of(rest))
                share[best] = demand[best] / np.maximum(self.capacity, 1)
            if room[0] == 0 or tokens - room[0] == 1 << (int(tokens - room[0]).bit_length() - 1):
                yield out
            else:
                yield from powers_of_two(out, tokens)
        self.pool = [pieces[i] for i in np.flatnonzero(free)]


def _pack(source: DataFrame, rows_of, key: str, max_tokens: int, max_segments: int, max_loss: int, with_ids: bool) -> DataFrame:
    """Packs what `rows_of` gives for each batch: (packed ids, running loss or None) per row."""
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "segment"]

    def run(batches):
        packer = Packer(max_tokens, max_segments, max_loss)
        next_sequence = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}  # row -> key, packed ids, tokens not yet in a sequence
        number = 0

        def placed(sequences):
            nonlocal next_sequence
            for pieces in sequences:
                total, offset = sum(end - start for _, start, end, _ in pieces), 0
                for segment, (row, start, end, _) in enumerate(pieces):
                    entry = held[row]
                    ids = entry[1][4 * start:4 * end]
                    yield (entry[0], start, end - start, zlib.crc32(ids), len(entry[1]) // 4, next_sequence, offset, total, segment,
                           np.frombuffer(ids, dtype=np.int32) if with_ids else None)
                    offset += end - start
                    entry[2] -= end - start
                    if not entry[2]:
                        del held[row]
                next_sequence += 1

        def table(rows):
            columns = list(zip(*rows)) if rows else [[]] * 10
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:9])]
            return pa.RecordBatch.from_arrays([*arrays, *([pa.array(columns[9], pa.list_(pa.int32()))] if with_ids else [])], names=names + ["ids"] * with_ids)

        kind = None
        for batch in batches:
            kind = batch.schema.field("key").type
            for name, (packed, running) in zip(batch.column("key").to_pylist(), rows_of(batch)):
                rows = []
                if packed:
                    held[number] = [name, packed, len(packed) // 4]
                    rows += placed(packer.add(number, len(packed) // 4, running))
                    number += 1
                if rows:
                    yield table(rows)
        if kind is not None:
            yield table(list(placed(packer.finish())))

    schema = f"`{key}` {source.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    return source.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def pack_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 0, max_tokens: int = 1024, max_segments: int = 64, max_loss: int = 1024, with_ids: bool = False, cached: int = 200_000) -> DataFrame:
    """Tokenises and packs texts; one row per piece.

    A row's tokens are those of its text, then `end_id`; every token but the
    first of a piece bears loss. Columns: key, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, sequence_length, segment and, if wanted,
    the piece's ids. Null and empty texts are the end token alone; a null key
    stays null; repeated rows are packed each for itself; an empty table has
    no piece. A worker remembers the tokens of up to twice `cached` pre-tokens,
    which take about 150 bytes each; the number changes the speed alone.
    """
    last = end_id.to_bytes(4, "little")
    source = docs.select(*(c.alias(n) for c, n in zip(worker.columns([key, text]), ("key", "text"))))

    def rows_of(batch):
        bpe = worker.kept(("packing", path, cached), lambda: Encoder(path, cached))
        return ((bpe.encode(t) + last, None) for t in worker.texts(batch.column("text")))

    return _pack(source, rows_of, key, max_tokens, max_segments, max_loss, with_ids)


def pack(rows: DataFrame, key: str, ids: str = "ids", loss: str = "loss", max_tokens: int = 2048, max_segments: int = 32, max_loss: int = 1024, with_ids: bool = True) -> DataFrame:
    """Packs token rows of instruction data: `ids` array<int>, `loss` array of 0/1.

    A null or short `loss` counts as 0 for the tokens it lacks; null and empty
    `ids` give no piece. Otherwise as `pack_texts`.
    """
    source = rows.select(*(c.cast(kind).alias(n) if kind else c.alias(n) for c, n, kind in zip(worker.columns([key, ids, loss]), ("key", "ids", "loss"), (None, "array<int>", "array<int>"))))

    def rows_of(batch):
        for i, l in zip(batch.column("ids"), batch.column("loss")):
            tokens = np.array([x or 0 for x in i.as_py() or []], dtype=np.int32)
            running = np.zeros(len(tokens) + 1, dtype=np.int64)
            marks = np.array([bool(x) for x in l.as_py() or []][:len(tokens)], dtype=np.int64)
            running[1:len(marks) + 1] = np.cumsum(marks)
            running[len(marks) + 1:] = running[len(marks)]
            yield tokens.tobytes(), running

    return _pack(source, rows_of, key, max_tokens, max_segments, max_loss, with_ids)
