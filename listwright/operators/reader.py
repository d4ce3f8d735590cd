"""Reading one HTML text into text pieces and elements (the task-side helper)."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from html import parser, unescape
from html.parser import HTMLParser
from itertools import accumulate

import numpy as np
import pyarrow as pa

from listwright.rules import SILENT_TAGS, VERBATIM_TAGS, VOID_TAGS


class PageReader(HTMLParser):
    """Feeds the open-element stack; end tags close everything above them.

    Counts of the open elements by name answer in constant time whether an end
    tag closes anything and whether text stands below a verbatim element.
    """

    def __init__(self, html: str, attributes: frozenset[str] | None):
        super().__init__(convert_charrefs=True)
        self.attributes = attributes
        self.pieces: list[str] = []
        self.rows: list[list] = []  # tag, attrs, first, last, end, sole
        self.kids: list[int] = []
        self.open: list[int] = []
        self.open_by_tag: Counter[str] = Counter()
        self.verbatim = 0
        self.text: list[str] = []
        self.silent = 0
        self.feed(html)
        self.close()
        self._flush()
        self._close_down_to(0)

    def parse_marked_section(self, i, report=1):
        """As the base does; an unknown section is skipped up to its end."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            if end >= 0:
                self._other_node(self.rawdata[i:end])
            return end + 1 if end >= 0 else -1

    def _child(self, piece: int) -> None:
        """Count a child of the innermost element; ``piece`` < 0 if not text."""
        if self.open:
            top = self.open[-1]
            self.kids[top] += 1
            self.rows[top][5] = piece if self.kids[top] == 1 else -1

    def _flush(self) -> None:
        if not self.text:
            return
        text = "".join(self.text)
        self.text.clear()
        if not text:
            return
        if self.silent:
            self._child(-1)
            return
        if text.isspace() and not self.verbatim:
            text = "\n" if "\n" in text else " "
        self.pieces.append(text)
        self._child(len(self.pieces) - 1)

    def _close_down_to(self, depth: int) -> None:
        while len(self.open) > depth:
            i = self.open.pop()
            row = self.rows[i]
            row[3], row[4] = len(self.pieces), len(self.rows)
            self.open_by_tag[row[0]] -= 1
            self.silent -= row[0] in SILENT_TAGS
            self.verbatim -= row[0] in VERBATIM_TAGS
            # a single child element lends its own single text to the parent
            if self.open and self.kids[self.open[-1]] == 1:
                self.rows[self.open[-1]][5] = row[5]

    def handle_starttag(self, tag, attrs):
        self._flush()
        self._child(-1)
        kept = {k: v or "" for k, v in attrs if self.attributes is None or k in self.attributes}
        if "class" in kept:
            kept["class"] = " ".join(kept["class"].split())
        self.open.append(len(self.rows))
        self.rows.append([tag, kept, len(self.pieces), 0, 0, -1])
        self.kids.append(0)
        self.open_by_tag[tag] += 1
        self.silent += tag in SILENT_TAGS
        self.verbatim += tag in VERBATIM_TAGS
        if tag in VOID_TAGS:
            self._close_down_to(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        depth = len(self.open)
        self.handle_starttag(tag, attrs)
        self._close_down_to(depth)

    def handle_endtag(self, tag):
        self._flush()
        if not self.open_by_tag[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]][0] == tag:
                self._close_down_to(depth)
                return

    def handle_data(self, data):
        self.text.append(data)

    def _other_node(self, data):
        self._flush()
        self._child(-1)

    handle_comment = handle_decl = handle_pi = unknown_decl = _other_node


# the markup nearly all pages consist of: what stands between a "<" and its ">"
_GAP = r"[ \t\n\r\f]"
_NAME = r"[a-zA-Z][-a-zA-Z0-9_:.]*+"
_ATTRS = rf"""(?:{_GAP}++{_NAME}(?:="[^"<]*+"|='[^'<]*+')?+(?={_GAP}|/?>))*+"""
HEAD = re.compile(rf"(?:(\x00?+)(/?+)({_NAME})({_ATTRS}){_GAP}*+(/?+)|!(?:--[^-<>]*+--|(?i:doctype)[^<>]*+))>")
# scripts and styles; their content is no markup
RAW = re.compile(
    rf"<(script|style)({_ATTRS}){_GAP}*+>[^<]*+(?:<(?!(?i:/\s*script|/\s*style|script|!--))[^<]*+)*+</\1{_GAP}*+>")
ATTRIBUTE = re.compile(rf"""({_NAME})(?:="([^"]*)"|='([^']*)')?""")
# a head with one plain attribute, and where heads stand
ONE_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9]*+) ([a-z][-a-z]*+)="([^"<>&\x00]*+)\"""")
TOKENS = re.compile("<([^<>]*+)>")
# elements whose content some parsers do not read as markup; pages with other uses of them go to PageReader
_RAW_TAGS = frozenset("script style textarea xmp iframe noembed noframes plaintext noscript".split())
_value = getattr(parser, "_unescape_attrvalue", unescape)
# markup that stays known: heads and the characters of each
HEADS, HEAD_CHARS = 4096, 200
_STARTS, _STANDS, _ENDS, _OTHER = range(4)


def is_carried(tag: str, kept: dict[str, str], tags: frozenset[str] | None) -> bool:
    """Elements to keep: all, or those of the given tags; "*" stands for any tag with an attribute kept."""
    return tags is None or tag in tags or bool(kept) and "*" in tags


def _read_head(found: re.Match, attributes: frozenset[str] | None, tags: frozenset[str] | None) -> tuple | None:
    """(kind, tag, attribute names, values, carried, special); None for markup that PageReader must read."""
    raw, close, tag, attrs, empty = found.groups()
    if tag is None:
        return _OTHER, "", (), (), False, False
    tag = tag.lower()
    if close:
        return None if raw or attrs or empty else (_ENDS, tag, (), (), False, False)
    if tag in _RAW_TAGS and not raw:
        return None
    kept = {}
    for key, value, quoted in ATTRIBUTE.findall(attrs):
        key = key.lower()
        if attributes is None or key in attributes:
            value = value or quoted
            kept[key] = _value(value) if "&" in value else value
    if "class" in kept:
        kept["class"] = " ".join(kept["class"].split())
    stands = raw or empty or tag in VOID_TAGS
    return _STANDS if stands else _STARTS, tag, tuple(kept), tuple(kept.values()), is_carried(tag, kept, tags), tag in SILENT_TAGS or tag in VERBATIM_TAGS


def _new_head(
    chunk: str, head: str, attributes: frozenset[str] | None, tags: frozenset[str] | None, heads: dict[str, tuple]
) -> tuple[tuple | None, int]:
    """:func:`_read_head` of markup not among ``heads``, and where it ends in the chunk; it is known from now on."""
    one = ONE_ATTRIBUTE.fullmatch(head)
    if one and one[1] not in _RAW_TAGS:
        tag, key, value = one.groups()
        kept = {key: " ".join(value.split()) if key == "class" else value} if attributes is None or key in attributes else {}
        known = (_STANDS if tag in VOID_TAGS else _STARTS, tag, tuple(kept), tuple(kept.values()), is_carried(tag, kept, tags),
                 tag in SILENT_TAGS or tag in VERBATIM_TAGS)
        end = len(head) + 1
    else:
        found = HEAD.match(chunk)
        known = found and _read_head(found, attributes, tags)
        if not known:
            return None, 0
        end = found.end()
    if end == len(head) + 1 <= HEAD_CHARS:
        if len(heads) >= HEADS:
            heads.clear()
        heads[head] = known
    return known, end


def read_heads(
    html: str, attributes: frozenset[str] | None, tags: frozenset[str] | None = None, heads: dict[str, tuple] | None = None
) -> tuple[list, ...] | None:
    """Tags, attribute names, values and sizes of :func:`read_plain` alone, for rules that look at no text; None as there."""
    if "\x00" in html:
        return None
    if "<script" in html or "<style" in html:
        html = RAW.sub("<\x00\\1\\2>", html)
    heads = {} if heads is None else heads
    found = _known_heads(TOKENS.findall(html), html, attributes, tags, heads)
    if found is None:
        # some head holds a ">", or the page is none of ordinary markup
        found, chunks = [], iter(html.split("<"))
        next(chunks)
        for chunk in chunks:
            head, whole, _ = chunk.partition(">")
            known = heads.get(head) if whole else None
            if known is None:
                known, _ = _new_head(chunk, head, attributes, tags, heads)
                if not known:
                    return None
            found.append(known)
    names, keys, values, sizes = [], [], [], []
    for head in found:
        if head[4]:
            names.append(head[1])
            keys += head[2]
            values += head[3]
            sizes.append(len(head[2]))
    return names, keys, values, sizes


def _known_heads(
    marks: list[str], html: str, attributes: frozenset[str] | None, tags: frozenset[str] | None, heads: dict[str, tuple]
) -> list[tuple] | None:
    """What the heads of a page say, None if not all of its "<" begin one of :data:`TOKENS` that is a whole head."""
    if len(marks) != html.count("<"):
        return None
    known = list(map(heads.get, marks))
    if None in known:
        for i, head in enumerate(marks):
            if known[i] is None:
                known[i], end = _new_head(head + ">", head, attributes, tags, heads)
                if end != len(head) + 1:
                    return None
    return known


def read_plain(
    html: str, attributes: frozenset[str] | None, tags: frozenset[str] | None = None, heads: dict[str, tuple] | None = None
) -> tuple[list, ...] | None:
    """The columns of :class:`PageReader` for a page of ordinary markup, None for any other.

    Other pages are those with unquoted attribute values, stray "<", marked
    sections and the like; what a page holds is the same either way.  ``heads``
    holds markup read before, for the same ``attributes`` and ``tags``.
    """
    if "\x00" in html:
        return None
    if "<script" in html or "<style" in html:
        html = RAW.sub("<\x00\\1\\2>", html)
    heads = {} if heads is None else heads
    pieces, depths = [], []
    names, keys, values, sizes = [], [], [], []
    firsts, lasts, ends, soles = [], [], [], []
    opened, open_by_tag = [], {}  # tag, place in the columns or -1, nodes before its content
    # nodes: texts, elements and others so far; an element with one piece has no other content if
    # there are only as many nodes below it as lead to that piece
    silent = verbatim = nodes = 0

    chunks = iter(html.split("<"))
    text = next(chunks)
    while True:
        if text:
            if "&" in text:
                text = unescape(text)
            if text:
                nodes += 1
                if not silent:
                    if not verbatim and text.isspace():
                        text = "\n" if "\n" in text else " "
                    pieces.append(text)
                    depths.append(len(opened))
        chunk = next(chunks, None)
        if chunk is None:
            break
        head, whole, text = chunk.partition(">")
        known = heads.get(head) if whole else None
        if known is None:
            known, end = _new_head(chunk, head, attributes, tags, heads)
            if not known:
                return None
            text = chunk[end:]
        kind, tag, head_keys, head_values, carried, special = known
        if kind == _ENDS:
            if not open_by_tag.get(tag):
                continue
            name = ""
            while name != tag:
                name, n, before, special = opened.pop()
                open_by_tag[name] -= 1
                if special:
                    silent -= name in SILENT_TAGS
                    verbatim -= name in VERBATIM_TAGS
                if n >= 0:
                    first, last = firsts[n], len(pieces)
                    lasts[n], ends[n] = last, len(names)
                    if last == first + 1 and nodes - before == depths[first] - len(opened):
                        soles[n] = first
            continue
        nodes += 1
        if kind == _OTHER:
            continue
        n = -1
        if carried:
            n = len(names)
            names.append(tag)
            keys += head_keys
            values += head_values
            sizes.append(len(head_keys))
            at = len(pieces)
            firsts.append(at)
            lasts.append(at)
            ends.append(n + 1)
            soles.append(-1)
        if kind == _STARTS:
            opened.append((tag, n, nodes, special))
            open_by_tag[tag] = open_by_tag.get(tag, 0) + 1
            if special:
                silent += tag in SILENT_TAGS
                verbatim += tag in VERBATIM_TAGS
    while opened:
        _, n, before, _ = opened.pop()
        if n >= 0:
            first, last = firsts[n], len(pieces)
            lasts[n], ends[n] = last, len(names)
            if last == first + 1 and nodes - before == depths[first] - len(opened):
                soles[n] = first
    return pieces, names, keys, values, sizes, firsts, lasts, ends, soles


def read_sparse(
    html: str, attributes: frozenset[str] | None, tags: frozenset[str], heads: dict[str, tuple] | None = None
) -> tuple[list, ...] | None:
    """:func:`read_plain` for pages most of whose elements are not carried, None for pages left to that.

    Elements are followed only below carried ones.  Left to :func:`read_plain` are pages where an end tag there may
    close something around the carried element, and pages with text that is silent or verbatim.
    """
    if "\x00" in html:
        return None
    if "<script" in html or "<style" in html:
        html = RAW.sub("<\x00\\1\\2>", html)
    heads = {} if heads is None else heads
    parts = TOKENS.split(html)
    texts, marks = parts[::2], parts[1::2]
    known = _known_heads(marks, html, attributes, tags, heads)
    if known is None:
        return None
    if "&" in html:
        # no reference goes beyond a "<", so all texts at once, unless that gives more of them
        plain = unescape("<".join(texts)).split("<")
        texts = plain if len(plain) == len(texts) else [unescape(text) if "&" in text else text for text in texts]
    seen = list(accumulate([1 if text else 0 for text in texts]))  # pieces up to and with each text
    names, keys, values, sizes = [], [], [], []
    firsts, lasts, ends, soles = [], [], [], []
    passed, total = -1, len(marks)
    for start in [i for i, head in enumerate(known) if head[4] or head[5]]:
        if start <= passed:
            continue
        kind, tag, head_keys, head_values, carried, special = known[start]
        if special and kind == _STARTS:
            return None
        if not carried:
            continue
        following = known[start + 1] if start + 1 < total else (_OTHER, "")
        if kind == _STANDS or following[0] == _ENDS and following[1] == tag:
            passed = start + (kind == _STARTS)
            names.append(tag)
            keys += head_keys
            values += head_values
            sizes.append(len(head_keys))
            first, last = seen[start], seen[passed]
            firsts.append(first)
            lasts.append(last)
            ends.append(len(names))
            soles.append(first if last > first else -1)
            continue
        opened, open_by_tag, depths = [], {}, {}  # as in read_plain, from this element on
        nodes, passed = 0, start
        while True:
            kind, tag, head_keys, head_values, carried, special = known[passed]
            if kind == _ENDS:
                if not open_by_tag.get(tag):
                    return None
                last = seen[passed]
                name = ""
                while name != tag:
                    name, n, before = opened.pop()
                    open_by_tag[name] -= 1
                    if n >= 0:
                        first = firsts[n]
                        lasts[n], ends[n] = last, len(names)
                        if last == first + 1 and nodes - before == depths[first] - len(opened):
                            soles[n] = first
                if not opened:
                    break
            else:
                nodes += 1
                if kind == _STARTS and special:
                    return None
                n = -1
                if carried:
                    n = len(names)
                    names.append(tag)
                    keys += head_keys
                    values += head_values
                    sizes.append(len(head_keys))
                    firsts.append(seen[passed])
                    lasts.append(seen[passed])
                    ends.append(n + 1)
                    soles.append(-1)
                if kind == _STARTS:
                    opened.append((tag, n, nodes))
                    open_by_tag[tag] = open_by_tag.get(tag, 0) + 1
            passed += 1
            if texts[passed]:
                nodes += 1
                depths[seen[passed] - 1] = len(opened)
            if passed == total:
                last = seen[passed]
                while opened:
                    _, n, before = opened.pop()
                    if n >= 0:
                        first = firsts[n]
                        lasts[n], ends[n] = last, len(names)
                        if last == first + 1 and nodes - before == depths[first] - len(opened):
                            soles[n] = first
                break
    pieces = [("\n" if "\n" in text else " ") if text.isspace() else text for text in texts if text]
    return pieces, names, keys, values, sizes, firsts, lasts, ends, soles


def read_page(
    html: str, attributes: frozenset[str] | None, tags: frozenset[str] | None = None, heads: dict[str, tuple] | None = None
) -> tuple[list, ...]:
    """Pieces, and the elements column by column; ``sizes`` counts the attributes of each element.

    With ``tags`` there are only the elements of :func:`is_carried`.
    """
    # where any tag may be carried most are, and following all of them once is faster
    plain = None if tags is None or "*" in tags else read_sparse(html, attributes, tags, heads)
    if plain is None:
        plain = read_plain(html, attributes, tags, heads)
    if plain is not None:
        return plain
    page = PageReader(html, attributes)
    rows = page.rows
    if tags is not None:
        carried = [is_carried(row[0], row[1], tags) for row in rows]
        before = [0, *accumulate(map(int, carried))]
        rows = [[*row[:4], before[row[4]], row[5]] for row, stays in zip(rows, carried) if stays]
    kept = [row[1] for row in rows]
    spans = ([row[i] for row in rows] for i in range(2, 6))
    return (page.pieces, [row[0] for row in rows], [k for a in kept for k in a], [v for a in kept for v in a.values()],
            [len(a) for a in kept], *spans)


def page_lines(pieces: list[str]) -> list[str]:
    """Visible text lines: trimmed, empty ones dropped."""
    return [line for part in "\n".join(pieces).splitlines() if (line := part.strip())]


def folded(lines: list[str]) -> str:
    """The lines one below the other, accents off and other non-ASCII dropped."""
    text = "\n".join(lines)
    if text.isascii():
        return text
    return "\n".join(
        line if line.isascii() else unicodedata.normalize("NFKD", line).encode("ascii", "ignore").decode() for line in lines)


def normalised(lines: list[str], keep: str, plain: str | None = None) -> list[str]:
    """Labels of many lines: accents off, lower case, no punctuation except ``keep``, single spaces.

    ``plain`` are the lines :func:`folded`, if known.
    """
    if not lines:
        return []
    gone = {cp: None for cp in range(128) if not (chr(cp).isalnum() or chr(cp).isspace() or chr(cp) in "_" + keep)}
    spaces = {cp: " " for cp in range(128) if chr(cp).isspace() and chr(cp) != "\n"}
    text = (folded(lines) if plain is None else plain).lower().translate(gone | spaces)
    while "  " in text:
        text = text.replace("  ", " ")
    return text.replace(" \n", "\n").replace("\n ", "\n").strip(" ").split("\n")


def picked(lines: list[str], wanted: frozenset[str] | list[re.Pattern]) -> list[int]:
    """Places of the lines that are among ``wanted``, or in which a match of its patterns ends.

    The patterns see all lines, each with a line end before and behind it; the one behind is the next line's, so a
    match may hold the one before only.
    """
    if isinstance(wanted, frozenset):
        return [i for i, line in enumerate(lines) if line in wanted]
    joined = "\n".join(["", *lines, ""])
    found = [match.end() - 2 for pattern in wanted for match in pattern.finditer(joined)]
    if not found:
        return []
    # where the line end behind each line stands, without the first one
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1) - 1
    return np.searchsorted(ends, found).tolist()


# pages read at a time, whatever the size of Spark's batches
SLICE = 256


def read_batch(
    html: pa.Array, attributes: frozenset[str] | None, tags: frozenset[str] | None = None, keep: str | None = None,
    heads: dict[str, tuple] | None = None, texts: bool = True, picks: dict[str, tuple] | None = None, joined: tuple[str, ...] = (),
) -> pa.Array:
    """One Arrow batch of pages to one Arrow batch of documents."""
    heads = {} if heads is None else heads
    slices = (html.slice(i, SLICE) for i in range(0, max(len(html), 1), SLICE))
    return pa.concat_arrays([read_slice(part, attributes, tags, keep, heads, texts, picks, joined) for part in slices])


def read_slice(
    html: pa.Array, attributes: frozenset[str] | None, tags: frozenset[str] | None = None, keep: str | None = None,
    heads: dict[str, tuple] | None = None, texts: bool = True, picks: dict[str, tuple] | None = None, joined: tuple[str, ...] = (),
) -> pa.Array:
    """A slice of pages to documents, column by column; with their lines, labels and what is joined or picked of them if ``keep`` is given.

    Without ``texts`` there are no pieces, and elements have no places of pieces or of other elements.
    """
    columns = ([], [], [], [], [], [], [], [], [])
    pieces, names, keys, values, sizes, *numbers = columns
    pos, piece_offsets, element_offsets, missing = [], [0], [0], []
    lines, line_offsets, page_texts = [], [0], []
    for text in html.to_pylist():
        missing.append(text is None)
        page = ([],)
        if text is not None:
            heads_alone = None if texts else read_heads(text, attributes, tags, heads)
            page = read_page(text, attributes, tags, heads) if heads_alone is None else ([], *heads_alone)
            for column, more in zip(columns if texts else columns[:5], page if texts else ([], *page[1:])):
                column += more
            pos += range(len(names) - element_offsets[-1])
        if keep is not None:
            lines += page_lines(page[0])
        if "page_text" in joined:
            page_texts.append(" ".join([piece for part in page[0] if (piece := part.strip())]))
        piece_offsets.append(len(pieces))
        element_offsets.append(len(names))
        line_offsets.append(len(lines))
    int32, string = pa.int32(), pa.string()

    def lists(offsets: list[int], items: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets, int32), items)

    attr_offsets = [0, *accumulate(sizes)]
    attrs = pa.MapArray.from_arrays(pa.array(attr_offsets, int32), pa.array(keys, string), pa.array(values, string))
    places = [pa.array(n, int32) if texts else pa.nulls(len(names), int32) for n in numbers]
    fields = [pa.array(pos, int32), pa.array(names, string), attrs, *places]
    elements = pa.StructArray.from_arrays(fields, ["pos", "tag", "attrs", "first", "last", "end", "sole"])
    document = {"pieces": lists(piece_offsets, pa.array(pieces, string)), "elements": lists(element_offsets, elements)}
    if keep is not None:
        plain = folded(lines)
        labels = normalised(lines, keep, plain)
        document["lines"] = lists(line_offsets, pa.array(lines, string))
        document["labels"] = lists(line_offsets, pa.array(labels, string))
    if "page_text" in joined:
        document["page_text"] = pa.array(page_texts, string)
    if keep is not None:
        if "label_text" in joined:
            document["label_text"] = pa.array(
                [" ".join(filter(None, labels[a:b])) for a, b in zip(line_offsets, line_offsets[1:])], string)
        views = {"line": lines, "label": labels}
        for name, tests in (picks or {}).items():
            document[name] = _places({i for view, wanted in tests.items() for i in picked(views[view], wanted)}, line_offsets)
    return pa.StructArray.from_arrays(list(document.values()), list(document), mask=pa.array(missing, pa.bool_()))


def _places(found: set[int], line_offsets: list[int]) -> pa.Array:
    """Picked lines of a slice as 1-based places on their pages."""
    at, starts = np.array(sorted(found), np.int32), np.array(line_offsets, np.int32)
    offsets = np.searchsorted(at, starts).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(at - np.repeat(starts[:-1], np.diff(offsets)) + np.int32(1)))


def batch_reader(
    attributes: frozenset[str] | None, tags: frozenset[str] | None = None, keep: str | None = None, texts: bool = True,
    picks: dict[str, tuple] | None = None, joined: tuple[str, ...] = (),
):
    """The function Spark calls with Arrow batches of HTML texts."""
    heads: dict[str, tuple] = {}

    def read(batch):
        return read_batch(batch, attributes, tags, keep, heads, texts, picks, joined)

    read.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return read
