"""Picks read from a batch of XML documents at once, by array operations.

A plain document (elements, attributes, text and the five named references, behind a declaration and an empty DOCTYPE)
is decided here: tags are found by their brackets, paired by their depth, and the automaton of `xmlpull` goes down
level by level, all elements of a level in one step. Everything else, and whatever may not be well-formed, is left to the readers of single documents.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from patloom.functions.xmlpull import Puller

# What may stand in a tag of a plain document.
_NAME = r"[A-Za-z_][A-Za-z0-9._-]*"
_ATTRIBUTE = rf"""[ \t\n]+({_NAME})[ \t\n]*=[ \t\n]*(?:"([^"&\t\n]*)"|'([^'&\t\n]*)')"""
_START = re.compile(rf"({_NAME})((?:{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)})*)[ \t\n]*(/?)")
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_END = re.compile(rf"/({_NAME})[ \t\n]*")
_DECLARATION = re.compile(
    r"""\?xml[ \t\n]+version[ \t\n]*=[ \t\n]*(?:"1\.0"|'1\.0')(?:[ \t\n]+encoding[ \t\n]*=[ \t\n]*(?:"(?i:utf-8)"|'(?i:utf-8)'))?[ \t\n]*\?"""
)
_DOCTYPE = re.compile(rf"""!DOCTYPE[ \t\n]+{_NAME}(?:[ \t\n]+SYSTEM[ \t\n]+(?:"[^"]*"|'[^']*'))?[ \t\n]*(?:\[[ \t\n]*\][ \t\n]*)?""")
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))  # the last one last
_UNFIT = [code for code in range(32) if code not in b"\t\n"]
_MARKS = bytes(code in (*_UNFIT, *b"<>&\xef") for code in range(256))  # bytes that are looked at
_SPACES = "".join(char for char in map(chr, range(sys.maxunicode + 1)) if char.isspace())
MOST_BYTES = 32 << 20  # of a batch; a larger one is read document by document

_BAD, _OPEN, _CLOSE, _EMPTY, _XML, _TYPE = range(6)


def _tag(content: bytes) -> tuple[int, str, dict[str, str]]:
    """What a tag is, its name and its attributes."""
    try:
        tag = content.decode()
    except UnicodeDecodeError:
        return _BAD, "", {}
    if start := _START.fullmatch(tag):
        name, rest, empty = start.groups()
        given = _ATTRIBUTES.findall(rest) if rest else ()
        attributes = {key: double or single for key, double, single in given}
        if len(attributes) < len(given) or "xmlns" in attributes:
            return _BAD, "", {}
        return _EMPTY if empty else _OPEN, name, attributes
    if end := _END.fullmatch(tag):
        return _CLOSE, end[1], {}
    return _XML if _DECLARATION.fullmatch(tag) else _TYPE if _DOCTYPE.fullmatch(tag) else _BAD, "", {}


def _between(buffer: pa.Buffer, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes from each begin to its end; none begins before the one before has ended."""
    edges = np.column_stack((begins, ends)).ravel().astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), max(len(edges) - 1, 0), [None, pa.py_buffer(edges), buffer])
    return every.take(pa.array(np.arange(0, len(edges), 2)))


def _blank(texts: pa.Array) -> np.ndarray:
    lengths = pc.binary_length(pc.utf8_trim(texts, characters=" \t\n"))
    return lengths.to_numpy(zero_copy_only=False) == 0


def _offsets(groups: np.ndarray, count: int) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.bincount(groups, minlength=count)))).astype(np.int32)


def _heads(groups: np.ndarray) -> np.ndarray:
    """Where a sorted array has the first of each value."""
    return np.flatnonzero(np.diff(groups, prepend=-1))


class _Batch:
    """The plain documents of a batch as arrays: tags in order, elements in order, and for each element what it is to the picks."""

    def __init__(self, puller: Puller, documents: pa.Array) -> None:
        self.puller, self.count = puller, len(documents)
        bounds = np.frombuffer(documents.buffers()[1], np.int32)[documents.offset : documents.offset + self.count + 1].astype(np.int64)
        self.buffer = documents.buffers()[2] or pa.py_buffer(b"")
        self.data, self.bounds = np.frombuffer(self.buffer, np.uint8)[: bounds[-1]], bounds
        self.plain = documents.is_valid().to_numpy(zero_copy_only=False) & (np.diff(bounds) > 0)
        self._check_bytes()
        self._find_tags()
        self._pair()
        self._walk()

    def _spoil(self, places: np.ndarray) -> None:
        """Documents with something at these places are not plain."""
        places = places[places >= self.bounds[0]]
        self.plain[np.searchsorted(self.bounds, places, "right") - 1] = False

    def _check_bytes(self) -> None:
        data, begins = self.data, self.bounds[:-1]
        size = len(data)
        raw = data[begins[0] :].tobytes()
        marks = np.flatnonzero(np.frombuffer(raw.translate(_MARKS), bool)) + begins[0]
        kinds = data[marks]
        self._spoil(marks[kinds < 32])
        self.opening, self.closing = marks[kinds == ord("<")], marks[kinds == ord(">")]
        self.plain &= data[np.minimum(begins, size - 1)] == ord("<")
        high = marks[kinds == 0xEF]
        high = high[high + 2 < size]
        self._spoil(high[(data[high + 1] == 0xBF) & (data[high + 2] >= 0xBE)])  # U+FFFE, U+FFFF
        marks = marks[kinds == ord("&")]
        self.referring = len(marks) > 0
        known = np.zeros(len(marks), bool)
        for reference, _ in _REFERENCES:
            long = marks + len(reference) <= size
            for k, byte in enumerate(reference.encode()):
                long &= data[np.minimum(marks + k, size - 1)] == byte
            known |= long
        self._spoil(marks[~known])
        try:
            raw.decode()
        except UnicodeDecodeError:
            for i in np.flatnonzero(self.plain):
                try:
                    data[begins[i] : self.bounds[i + 1]].tobytes().decode()
                except UnicodeDecodeError:
                    self.plain[i] = False

    def _find_tags(self) -> None:
        data, bounds, opening, closing = self.data, self.bounds, self.opening, self.closing
        ends = closing[closing >= 2]
        self._spoil(ends[(data[ends - 1] == ord("]")) & (data[ends - 2] == ord("]"))])
        doc = np.searchsorted(bounds, opening, "right") - 1
        limit = np.minimum(np.append(opening[1:], len(data)), bounds[doc + 1])
        closed = np.append(closing, len(data))[np.searchsorted(closing, opening)]
        self._spoil(opening[closed >= limit])
        kept = self.plain[doc]
        opening, closed, limit, doc = opening[kept], closed[kept], limit[kept], doc[kept]
        coded = _between(self.buffer, opening + 1, closed).dictionary_encode()
        texts = _between(self.buffer, closed + 1, limit).cast(pa.string())
        self.tags = [_tag(content) for content in coded.dictionary.to_pylist()]
        self.names: dict[str, int] = {}
        kinds = np.array([kind for kind, _, _ in self.tags], np.int8)
        named = np.array([self.names.setdefault(name, len(self.names)) for _, name, _ in self.tags], np.int64)
        code = coded.indices.to_numpy()
        kind = kinds[code]
        # A declaration comes first, a DOCTYPE first or behind it, with nothing but blanks behind them.
        first = np.diff(doc, prepend=-1) > 0
        second = np.append(False, first[:-1] & (kind[:-1] == _XML)) & ~first if len(first) else first
        head = (kind == _XML) | (kind == _TYPE)
        wrong = (kind == _BAD) | ((kind == _XML) & ~first) | ((kind == _TYPE) & ~first & ~second)
        at = np.flatnonzero(head | np.append(np.diff(doc) > 0, True)[: len(doc)])  # and behind the last tag
        wrong[at] |= ~_blank(texts.take(pa.array(at)))
        self.plain[doc[wrong]] = False
        kept = np.flatnonzero(~head & self.plain[doc])
        # An empty element opens, with no text, and closes.
        empty = kind[kept] == _EMPTY
        tag = np.repeat(kept, 1 + empty)
        again = np.zeros(len(tag), bool)
        again[1:] = tag[1:] == tag[:-1]
        opens = (kind[tag] != _CLOSE) & ~again
        self.texts = pa.concat_arrays([texts, pa.array([""])])
        self.text = np.where(opens & (kind[tag] == _EMPTY), len(texts), tag)
        self.doc, self.code, self.opens, self.name = doc[tag], code[tag], opens, named[code[tag]]

    def _drop(self) -> None:
        kept = self.plain[self.doc]
        for what in ("doc", "code", "opens", "name", "text", "depth"):
            setattr(self, what, getattr(self, what)[kept])

    def _pair(self) -> None:
        """Elements, each with its end; documents whose tags do not pair are dropped."""
        step = np.where(self.opens, 1, -1)
        self.depth = np.cumsum(step)
        heads = _heads(self.doc)
        self.depth -= np.repeat(self.depth[heads] - step[heads], np.diff(np.append(heads, len(self.doc))))
        last = np.append(np.diff(self.doc) > 0, True)[: len(self.doc)]
        self.plain[self.doc[(self.depth < 1) != last]] = False  # the root closes with the last tag, and nothing before
        self.plain[self.doc[self.depth < 0]] = False
        held = np.zeros(self.count, bool)
        held[self.doc] = True
        self.plain &= held
        while True:
            self._drop()
            level = np.where(self.opens, self.depth, self.depth + 1)
            order = np.argsort(level, kind="stable")
            starts, ends = order[0::2], order[1::2]  # of one level, in turn
            wrong = self.name[starts] != self.name[ends]
            if not wrong.any():
                break
            self.plain[self.doc[starts[wrong]]] = False
        end_of = np.empty(len(level), np.int64)
        end_of[starts] = ends
        self.at = np.flatnonzero(self.opens)
        self.end, self.level = end_of[self.at], level[self.at]
        self.of, self.called = self.doc[self.at], self.name[self.at]

    def _scopes(self) -> dict[int, np.ndarray]:
        """For each pick with a scope the elements that are it, the first of each document."""
        found = {}
        for name, wanted in self.puller.scopes.items():
            for pick, test in wanted:
                fits = (self.called == self.names.get(name, -1)) & (self.level > 1)
                if test:
                    passed = np.array([attributes.get(test[0]) == test[1] for _, _, attributes in self.tags], bool)
                    fits &= passed[self.code[self.at]]
                elements = np.flatnonzero(fits)
                found[pick] = elements = elements[_heads(self.of[elements])]
                plan = self.puller.plans[pick]
                if plan.take == "blocks" and name in plan.names:
                    self.plain[self.of[elements]] = False
        return found

    def _walk(self) -> None:
        """What each element is to the picks, level by level."""
        puller, names = self.puller, list(self.names)
        for name in puller.anchors & self.names.keys():  # one inside itself is left to the tree
            same = np.flatnonzero((self.called == self.names[name]) & (self.level > 1))
            inside = self.at[same[1:]] < np.maximum.accumulate(self.end[same])[:-1]
            self.plain[self.of[same[1:][inside]]] = False
        self.scoped = self._scopes()
        scopes = np.zeros(len(self.at), np.int64)
        for pick, elements in self.scoped.items():
            scopes[elements] |= 1 << pick
        state, self.met = np.full(len(self.at), puller.first_state), np.zeros(len(self.at), np.int64)
        order = np.argsort(self.level, kind="stable")
        edges = np.flatnonzero(np.diff(self.level[order], prepend=0, append=0))
        known = {(): 0}
        for above, begin, stop in zip(edges, edges[1:], edges[2:]):
            upper, here = order[above:begin], order[begin:stop]
            parent = upper[np.searchsorted(self.at[upper], self.at[here]) - 1]
            cases, case = np.unique(state[parent] * len(names) + self.called[here], return_inverse=True)
            moves = []
            for one in cases.tolist():
                key = one // len(names), names[one % len(names)]
                inside, met, _, _ = puller.moves.get(key) or puller._move(*key)
                moves.append((inside, known.setdefault(met, len(known))))
            state[here], self.met[here] = np.array(moves)[case].T
            within = here[scopes[here] > 0]
            cases, case = np.unique(np.column_stack((state[within], scopes[within])), axis=0, return_inverse=True)
            opened = [puller._scoped(one, [i for i in range(len(puller.plans)) if picks >> i & 1]) for one, picks in cases.tolist()]
            state[within] = np.array(opened, np.int64)[case.ravel()]
        self.known = list(known)

    def _those(self, kind: str, pick: int, part: int = -1) -> np.ndarray:
        """The elements that are something to a pick."""
        return np.flatnonzero(np.array([(kind, pick, part) in met for met in self.known], bool)[self.met])

    def _cleaned(self, texts: pa.Array, strip: bool) -> pa.Array:
        referring = pc.match_substring(texts, "&") if self.referring else None
        if referring is not None and pc.any(referring).as_py():
            some = texts.filter(referring)
            for reference, char in _REFERENCES:
                some = pc.replace_substring(some, reference, char)
            texts = pc.replace_with_mask(texts, referring, some)
        return pc.utf8_trim(texts, characters=_SPACES) if strip else texts

    def _leads(self, elements: np.ndarray, strip: bool) -> pa.Array:
        return self._cleaned(self.texts.take(pa.array(self.text[self.at[elements]])), strip)

    def _one_of(self, groups: np.ndarray, count: int, values: pa.Array) -> pa.Array:
        """The first value of each group; null where there is none."""
        heads = _heads(groups)
        places = np.zeros(count, np.int64)
        none = np.ones(count, bool)
        places[groups[heads]], none[groups[heads]] = heads, False
        return values.take(pa.array(places, mask=none))

    def _listed(self, elements: np.ndarray, values: pa.Array, pick: int) -> pa.Array:
        none = None
        if pick in self.scoped:
            none = np.ones(self.count, bool)
            none[self.of[self.scoped[pick]]] = False
        return pa.ListArray.from_arrays(pa.array(_offsets(self.of[elements], self.count)), values, mask=None if none is None else pa.array(none))

    def _wholes(self, elements: np.ndarray, plan) -> pa.Array:
        """The whole text of each element."""
        begins, ends = self.at[elements], self.end[elements]
        sizes = ends - begins
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pieces = self.text[np.repeat(begins, sizes) + steps]
        owner = np.repeat(np.arange(len(elements)), sizes)
        lengths = pc.binary_length(self.texts).to_numpy()
        some = lengths[pieces] > 0
        texts = self._cleaned(self.texts.take(pa.array(pieces[some])), False)
        lists = pa.ListArray.from_arrays(pa.array(_offsets(owner[some], len(elements))), texts)
        joined = pc.binary_join(lists, "" if plan.take == "blocks" else " ")
        return pc.utf8_trim(joined, characters=_SPACES) if plan.take == "blocks" and plan.strip else joined

    def _part(self, pick: int, part: int, rows: np.ndarray) -> pa.Array:
        """A part of all rows of a pick: one text of each, or all."""
        plan = self.puller.plans[pick]
        elements = self._those("part", pick, part)
        row = np.searchsorted(rows, elements, "right") - 1
        if plan.take == "lists":
            return pa.ListArray.from_arrays(pa.array(_offsets(row, len(rows))), self._leads(elements, plan.strip))
        if plan.parts[part][1]:  # below the first only
            heads = self._those("count", pick, part)
            kept = np.searchsorted(heads, elements, "right") - np.searchsorted(heads, rows[row]) == 1
            elements, row = elements[kept], row[kept]
        return self._one_of(row, len(rows), self._leads(elements, plan.strip))

    def column(self, pick: int, kind: pa.DataType) -> pa.Array:
        """A pick of all documents. Only that of the plain ones means anything."""
        plan = self.puller.plans[pick]
        if plan.take == "attribute":
            roots = _heads(self.doc)
            given = [self.tags[code][2].get(plan.pick.path) for code in self.code[roots].tolist()]
            values = pa.array([value.strip() if value is not None and plan.strip else value for value in given], pa.string())
            return self._one_of(self.doc[roots], self.count, values)
        if plan.take == "first":
            elements = self._those("lead", pick)
            elements = elements[_heads(self.of[elements])]
            return self._one_of(self.of[elements], self.count, self._leads(elements, plan.strip))
        if plan.take == "texts":
            elements = self._those("lead", pick)
            lengths = pc.binary_length(self.texts).to_numpy()
            elements = elements[lengths[self.text[self.at[elements]]] > 0]
            return self._listed(elements, self._leads(elements, plan.strip), pick).cast(kind)
        if plan.take in ("pieces", "blocks"):
            elements = self._those("whole", pick)
            return self._listed(elements, self._wholes(elements, plan), pick).cast(kind)
        rows = self._those("row", pick)
        inner = kind.value_type
        parts = [self._part(pick, k, rows).cast(inner.field(k).type) for k in range(len(plan.parts))]
        return self._listed(rows, pa.StructArray.from_arrays(parts, fields=list(inner)), pick).cast(kind)


def read_plain(puller: Puller, documents: pa.Array, kinds: list[pa.DataType]) -> tuple[list[pa.Array], np.ndarray] | None:
    """The columns of all picks, and which documents were plain: only their values mean anything. None if there are none."""
    if pa.types.is_string(documents.type):
        documents = documents.view(pa.binary())
    if not pa.types.is_binary(documents.type) or not 0 < (pc.sum(pc.binary_length(documents)).as_py() or 0) <= MOST_BYTES:
        return None
    batch = _Batch(puller, documents)
    if not batch.plain.any():
        return None
    return [batch.column(pick, kind) for pick, kind in enumerate(kinds)], batch.plain
