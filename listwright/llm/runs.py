"""Periodic runs of words by a Re-Pair grammar.

A run is a stretch of words with smallest period q that is at least four
periods and six words long and can't be longer. The words' ids are compressed
by Re-Pair: pairs of neighbouring symbols that occur twice or more become a
nonterminal, the more frequent pair first where two overlap, until no pair is
left that repeats. What remains, the start rule, is halved again and again, and
each half counts as a nonterminal used once.

Every run lies in the expansion of some nonterminal and crosses the boundary
between its two halves there. So each nonterminal's expansion is searched once,
at its first place in the text, for runs across its boundary: for each period q
up to a quarter of the expansion, a run needs two periods on one side of the
boundary, and few periods pass the comparison of a few words; the run is then
followed word by word to both sides. What a nonterminal has found holds at all
places it derives, which were noted when its pair was replaced. The runs of all
places are sorted by period and start, and those inside others of the same
period are merged into them; the rest are the maximal ones.

A text is one row and all of its work is in one task: the time is linear in
the text but for the halvings, and memory is a few numbers a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.llm import worker

LEAST_WORDS = 6
LEAST_PERIODS = 4
GROUP_WORDS = 1 << 17  # texts are worked on together up to so many words
CANDIDATES = 1 << 20  # periods compared together
RUNS = "array<struct<start:int,length:int,period:int>>"


def _distinct_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each key's group, the groups' sizes, and the places in the order of their groups."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.cumsum(new) - 1
    sizes = np.bincount(number)
    group = np.empty(len(keys), dtype=np.int64)
    group[order] = number
    return group, sizes, order


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A fixed shuffle of numbers, to break ties the same way wherever a pair stands."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(24)


class Grammar:
    """Re-Pair of the texts that lie one behind the other in `ids`.

    `text` is the number of each word's text; no symbol reaches over its end.
    `nodes` are (start, boundary, end) of the first place of each nonterminal,
    `places` its other starts.
    """

    def __init__(self, ids: np.ndarray, text: np.ndarray) -> None:
        # symbols of different texts differ, so each text has a grammar of its own
        _, _, symbols = np.unique(text.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids, return_index=True, return_inverse=True)
        self.nodes: list[np.ndarray] = []
        self.places: list[tuple[np.ndarray, np.ndarray]] = []  # (number of the node, start)
        self.count = 0
        starts = np.arange(len(ids), dtype=np.int64)
        ends = starts + 1
        self._replace(symbols.astype(np.int64), starts, ends, text)

    def _replace(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> None:
        fresh = int(symbols.max(initial=-1)) + 1
        live = np.ones(len(symbols), dtype=bool)  # the texts in which pairs may still repeat
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            frequent = np.bincount(symbols, minlength=fresh)[symbols] > 1
            at = np.flatnonzero(frequent[:-1] & frequent[1:] & (text[1:] == text[:-1]))
            left, right = symbols[at], symbols[at + 1]
            # of a row of equal symbols every other pair counts
            equal = np.flatnonzero(left == right)
            if len(equal):
                run_start = np.ones(len(equal), dtype=bool)
                run_start[1:] = (at[equal[1:]] != at[equal[:-1]] + 1) | (left[equal[1:]] != left[equal[:-1]])
                first = np.maximum.accumulate(np.where(run_start, np.arange(len(equal)), 0))
                keep = np.ones(len(at), dtype=bool)
                keep[equal[(np.arange(len(equal)) - first) % 2 == 1]] = False
                at, left, right = at[keep], left[keep], right[keep]
            keys = left * fresh + right
            group, sizes, _ = _distinct_places(keys)
            twice = sizes[group] > 1
            at, keys, weight = at[twice], keys[twice], sizes[group[twice]]
            if len(at):
                # where pairs overlap, the more frequent one is replaced
                order = np.minimum(weight, (1 << 22) - 1).astype(np.int64) << 40 | _mixed(keys).astype(np.int64)
                beats = np.ones(len(at), dtype=bool)
                beside = at[1:] == at[:-1] + 1
                beats[1:] &= ~beside | (order[1:] > order[:-1]) | (keys[1:] == keys[:-1])
                beats[:-1] &= ~beside | (order[:-1] > order[1:])
                at, keys = at[beats], keys[beats]
                group, sizes, _ = _distinct_places(keys)
                twice = sizes[group] > 1
                at, keys = at[twice], keys[twice]
            # texts without a replacement are finished
            changed = np.zeros(int(text[-1]) + 1, dtype=bool)
            changed[text[at]] = True
            live = changed[text]
            if not live.all():
                done.append((starts[~live], ends[~live], text[~live]))
            if not len(at):
                break
            group, sizes, order = _distinct_places(keys)
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            one = at[order[firsts]]
            self.nodes.append(np.stack([starts[one], starts[one + 1], ends[one + 1]], axis=1))
            self.places.append((self.count + group, starts[at]))
            self.count += len(sizes)
            symbols[at] = fresh + group
            ends[at] = ends[at + 1]
            fresh += len(sizes)
            live[at + 1] = False
            symbols, starts, ends, text = symbols[live], starts[live], ends[live], text[live]
        for part in done:
            self._halve(*part)

    def _halve(self, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> None:
        """Nodes of the start rules: both halves of a part, their halves and so on."""
        if not len(starts):
            return
        new = np.ones(len(text), dtype=bool)
        new[1:] = text[1:] != text[:-1]
        low = np.flatnonzero(new)
        high = np.append(low[1:], len(text))
        while True:
            more = high - low >= 2
            more &= ends[high - 1] - starts[low] >= LEAST_WORDS
            low, high = low[more], high[more]
            if not len(low):
                return
            middle = (low + high) // 2
            self.nodes.append(np.stack([starts[low], starts[middle], ends[high - 1]], axis=1))
            self.places.append((self.count + np.arange(len(low)), starts[low]))
            self.count += len(low)
            low, high = np.concatenate([low, middle]), np.concatenate([middle, high])


def _stretch(ids: np.ndarray, at: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The largest [start, end) within [low, high) around `at` where words q apart are equal."""
    end, step = at, 16
    while end + q < high:
        size = min(step, high - q - end)
        bad = np.flatnonzero(ids[end:end + size] != ids[end + q:end + q + size])
        if len(bad):
            end += int(bad[0])
            break
        end, step = end + size, step * 4
    start, step = at, 16
    while start > low:
        size = min(step, start - low)
        bad = np.flatnonzero(ids[start - size:start] != ids[start - size + q:start + q])
        if len(bad):
            start -= size - 1 - int(bad[-1])
            break
        start, step = start - size, step * 4
    return start, end + q


def _crossing(ids: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the node, (start, end, period)) of runs across the boundaries of nodes."""
    owners, found = [], []
    most = (nodes[:, 2] - nodes[:, 0]) // LEAST_PERIODS
    before = np.concatenate([[0], np.cumsum(most)])
    last, known = -1, []
    # so many (node, period) at a time, those of a large node in several turns
    for at in range(0, int(before[-1]), CANDIDATES):
        end = min(at + CANDIDATES, int(before[-1]))
        first, stop = int(np.searchsorted(before, at, side="right")) - 1, int(np.searchsorted(before, end, side="left"))
        node = np.repeat(np.arange(first, stop), np.minimum(before[first + 1:stop + 1], end) - np.maximum(before[first:stop], at))
        q = np.arange(at, end) - before[node] + 1
        low, middle, high = nodes[node, 0], nodes[node, 1], nodes[node, 2]
        # two periods behind the boundary, or two before it
        behind = np.flatnonzero(middle + 2 * q <= high)
        b, m = q[behind], middle[behind]
        ok = ids[m] == ids[m + b]
        behind, b, m = behind[ok], b[ok], m[ok]
        behind = behind[(ids[m + b - 1] == ids[m + 2 * b - 1]) & (ids[m + b // 2] == ids[m + b + b // 2])]
        ahead = np.flatnonzero(middle - 2 * q >= low)
        b, m = q[ahead], middle[ahead]
        ok = ids[m - 1] == ids[m - 1 - b]
        ahead, b, m = ahead[ok], b[ok], m[ok]
        ahead = ahead[(ids[m - b] == ids[m - 2 * b]) & (ids[m - 1 - b // 2] == ids[m - 1 - b - b // 2])]
        side = np.concatenate([np.zeros(len(behind), np.int64), np.ones(len(ahead), np.int64)])
        both = np.concatenate([behind, ahead])
        order = np.lexsort((side, both))
        for s, i in zip(side[order].tolist(), both[order].tolist()):
            n, p = int(node[i]), int(q[i])
            if n != last:
                last, known = n, []
            lo, mid, hi = nodes[n].tolist()
            # a multiple of a smaller period within that one's run is no smallest period
            if any(start <= mid and end >= mid + 2 * p for start, end, _ in known) if s == 0 else any(end >= mid and start <= mid - 2 * p for start, end, _ in known):
                continue
            start, stretch = _stretch(ids, mid if s == 0 else mid - p, p, lo, hi)
            if stretch - start >= 2 * p and not any(start >= a and stretch <= b and p % k == 0 for a, b, k in known):
                known.append((start, stretch, p))
                if stretch - start >= max(LEAST_WORDS, LEAST_PERIODS * p):
                    owners.append(n)
                    found.append((start, stretch, p))
    return np.array(owners, dtype=np.int64), np.array(found, dtype=np.int64).reshape(-1, 3)


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Maximal (start, end, period): those inside others of the same period are left out."""
    order = np.lexsort((-end, start, period))
    out: list[list[int]] = []
    for s, e, q in zip(start[order].tolist(), end[order].tolist(), period[order].tolist()):
        if out and out[-1][2] == q and s <= out[-1][1] - q:  # they share a period or more
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, q])
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def runs_of(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of texts that lie one behind the other, by start, then period."""
    if len(ids) < LEAST_WORDS:
        return np.empty((0, 3), dtype=np.int64)
    grammar = Grammar(ids, text)
    if not grammar.nodes:
        return np.empty((0, 3), dtype=np.int64)
    nodes = np.concatenate(grammar.nodes)
    large = np.flatnonzero(nodes[:, 2] - nodes[:, 0] >= LEAST_WORDS)
    owners, found = _crossing(ids, nodes[large])
    if not len(found):
        return found
    owners = large[owners]
    # all places of the nodes that found something
    node, start = (np.concatenate(parts) for parts in zip(*grammar.places))
    asked = np.zeros(len(nodes), dtype=bool)
    asked[owners] = True
    node, start = node[asked[node]], start[asked[node]]
    order = np.argsort(node, kind="stable")
    node, start = node[order], start[order]
    low, high = np.searchsorted(node, owners, side="left"), np.searchsorted(node, owners, side="right")
    row = np.repeat(np.arange(len(owners)), high - low)
    place = np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
    shift = start[place] - nodes[owners[row], 0]
    merged = _merged(found[row, 0] + shift, found[row, 1] + shift, found[row, 2])
    return merged[np.lexsort((merged[:, 2], merged[:, 0]))]


def _dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) > 0


def _found(texts: Iterator[str]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """(number of words, runs, text without repeated periods) of each text, in order."""
    def solve(group: list[list[bytes]]):
        sizes = np.array([len(words) for words in group])
        every = pa.array([w for words in group for w in words], pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(len(group)), sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        own: list[list[tuple[int, int, int]]] = [[] for _ in group]
        for start, end, q in runs_of(every, text).tolist():
            i = int(np.searchsorted(offsets, start, side="right")) - 1
            own[i].append((start - int(offsets[i]), end - start, q))
        for words, runs in zip(group, own):
            n = len(words)
            if runs:
                words = [words[i] for i in np.flatnonzero(~_dropped(n, runs)).tolist()]
            yield n, runs, b" ".join(words).decode()

    group, held = [], 0
    for t in texts:
        words = t.encode().split()  # at ASCII white space
        group.append(words)
        held += len(words)
        if held >= GROUP_WORDS:
            yield from solve(group)
            group, held = [], 0
    if group:
        yield from solve(group)


def find(docs: DataFrame, text: str = "text", words: str = "n_words", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Adds the number of words, `runs` (start, length, period; by start, then period) and `collapsed`.

    `collapsed` has the words that no run holds after its first period, joined
    by one space. Words are separated by ASCII white space. Null and empty
    texts have no word and no run and are collapsed to the empty text. Rows
    are independent, so repeated rows and empty tables need no rule; other
    columns pass unchanged whatever their names, those named like a result
    are replaced.
    """
    names = [c for c in docs.columns if c not in (words, runs, collapsed)]
    source = docs.select(F.struct(*worker.columns(names)).alias("row"), *(c.alias("t") for c in worker.columns([text])))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("period", pa.int32())]))

    def run(batches):
        for batch in batches:
            rows = list(_found(worker.texts(batch.column("t"))))
            found = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for _, r, _ in rows], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([n for n, _, _ in rows], pa.int64()), found, pa.array([c for _, _, c in rows], pa.string())], names=["row", "n", "r", "c"])

    fields = T.StructType([source.schema["row"], T.StructField("n", T.LongType()), T.StructField("r", T._parse_datatype_string(RUNS)), T.StructField("c", T.StringType())])
    done = source.mapInArrow(run, fields)
    return done.select(*[F.col("row").getField(c).alias(c) for c in names], F.col("n").alias(words), F.col("r").alias(runs), F.col("c").alias(collapsed))


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) with a periodic tail in the texts that the key's checksum names.

    With h = crc32 of the key as decimal text and g = floor(h / 10), texts with
    h % 10 = 0 repeat their words from a = g % n on with period
    1 + floor((n - a) / (3 + g % 8)). Null keys and texts without words stay.
    """
    own, t = worker.columns([key, text])
    white = F.lit(" \t\n\x0b\f\r")
    h = F.crc32(own.cast("string").cast("binary"))
    rows = docs.select(own.alias("key"), F.coalesce(t, F.lit("")).alias("t"), h.alias("h"))
    chosen = (F.col("h") % 10 == 0) & (F.btrim("t", white) != "")
    rows = rows.withColumn("w", F.when(chosen, F.split(F.btrim("t", white), r"[\x20\x09-\x0D]+")))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    rows = rows.withColumn("a", (g % n).cast("int"))
    rows = rows.withColumn("p", (F.floor((n - F.col("a")) / (g % 8 + 3)) + 1).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    tail = F.array_join(F.transform("w", lambda _, i: F.get("w", place(i))), " ")
    return rows.select(F.col("key").alias(key), F.when(F.col("w").isNotNull(), tail).otherwise(F.col("t")).alias(text))


def _text(run: Column) -> Column:
    return F.concat_ws(",", run["start"], run["length"], run["period"])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    Of equally long runs the first, then the one with the smaller period counts;
    without a run the four are null.
    """
    own, t = worker.columns([key, text])
    found = find(docs.select(own.alias("key"), t.alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    found = found.select("key", "runs", "collapsed", longest.alias("most"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(_text(r), F.lit("\n"))), "")
    length, period = F.col("most.length").cast("long"), (-F.col("most.q")).cast("long")
    return found.select(
        F.col("key").alias(key), F.size("runs").cast("long").alias("n_runs"), (-F.col("most.s")).cast("long").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
