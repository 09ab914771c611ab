"""XML structure to Spark structs.

Spark's own XML functions cannot give the text before the first child of each of many elements,
nor the whole text below one, and fail on a DOCTYPE. So one small Arrow function walks a document
and returns what a list of `Pick`s asks for, as a struct. What the values mean (pairing, joining,
trimming, dates) is left to Spark expressions on that struct.
"""

from __future__ import annotations

import functools
import gc
import xml.etree.ElementTree as ET
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from patloom.functions.xmlbatch import read_plain
from patloom.functions.xmlpull import Puller


@dataclass(frozen=True)
class Pick:
    """One thing to take from a document.

    take:
      attribute  root attribute `path`, null if absent
      first      leading text of the first element at `path`: null if absent, '' if it has none
      texts      leading texts of all elements at `path` that have one
      blocks     whole text of each descendant whose local name is in `path` (blank-separated)
      pieces     all text pieces of each element at `path`, joined by a blank
      rows       one struct per element at `path`: leading text of the first element at each part
      lists      one struct per element at `path`: leading texts of all elements at each part
    within: take from the first element at this path; the value is null where there is none.
    """

    name: str
    take: str
    path: str
    parts: tuple[tuple[str, str], ...] = ()
    within: str | None = None
    strip: bool = True

    def spark_type(self) -> T.DataType:
        if self.take in ("attribute", "first"):
            return T.StringType()
        if self.take in ("rows", "lists"):
            inner = T.StringType() if self.take == "rows" else T.ArrayType(T.StringType())
            return T.ArrayType(T.StructType([T.StructField(name, inner) for name, _ in self.parts]))
        return T.ArrayType(T.StringType())

    @property
    def anchor(self) -> str | None:
        """The tag that the path starts from anywhere in the document, if it does."""
        return self.path[3:].split("/", 1)[0] if self.path.startswith(".//") and self.within is None else None


Index = dict[str, list[ET.Element]]


def _reader(pick: Pick) -> Callable[[ET.Element, Index], object]:
    """The function that takes a pick from a root and the index of its anchor elements."""
    parts = [(name, *sub.partition("[1]/")[::2]) for name, sub in pick.parts]
    clean = (lambda text: None if text is None else text.strip()) if pick.strip else (lambda text: text)
    anchor, within, path = pick.anchor, pick.within, pick.path
    below = path[3 + len(anchor) :].removeprefix("/") if anchor else path
    below = f"./{below}" if below.startswith("/") else below  # `a//b`: any depth below an anchor

    def starts(root: ET.Element, index: Index) -> Sequence[ET.Element] | None:
        if anchor:
            return index.get(anchor, ())
        scope = root if within is None else root.find(within)
        return None if scope is None else (scope,)

    def elements(root: ET.Element, index: Index) -> list[ET.Element] | None:
        found = starts(root, index)
        if found is None or not below:
            return found
        return [el for start in found for el in start.findall(below)]

    def of_each(value: Callable[[ET.Element], object], kept: Callable[[ET.Element], object] = lambda el: True):
        def read(root: ET.Element, index: Index) -> list | None:
            found = elements(root, index)
            return None if found is None else [value(el) for el in found if kept(el)]

        return read

    def row(el: ET.Element) -> dict[str, str | None]:
        values = {}
        for name, sub, inner in parts:
            at = el.find(sub) if inner else el  # `a[1]/b`: below the first a only
            values[name] = None if at is None else clean(at.findtext(inner or sub))
        return values

    def first(root: ET.Element, index: Index) -> str | None:
        texts = (start.findtext(below) if below else start.text or "" for start in starts(root, index) or ())
        return clean(next((text for text in texts if text is not None), None))

    def blocks(root: ET.Element, index: Index) -> list[str] | None:
        names, found = set(path.split()), starts(root, index)
        if found is None:
            return None
        return [clean("".join(el.itertext())) for el in found[0].iter() if el.tag.rpartition("}")[2] in names]

    return {
        "attribute": lambda root, index: clean(root.get(path)),
        "first": first,
        "texts": of_each(lambda el: clean(el.text), kept=lambda el: el.text),
        "pieces": of_each(lambda el: " ".join(el.itertext())),
        "blocks": blocks,
        "rows": of_each(row),
        "lists": of_each(lambda el: {name: [clean(e.text or "") for e in el.findall(sub)] for name, sub, _ in parts}),
    }[pick.take]


def _tree_values(document: str | bytes, picks: Sequence[Pick]) -> list:
    """The values of all picks by way of a tree; rows as lists in the order of their parts."""
    root = ET.fromstring(document)
    anchors, index = {pick.anchor for pick in picks if pick.anchor}, {}
    for el in root.iter():  # one walk finds the anchors of all picks, in document order
        if el.tag in anchors and el is not root:
            index.setdefault(el.tag, []).append(el)
    values = [_reader(pick)(root, index) for pick in picks]
    return [[list(row.values()) for row in value] if pick.parts else value for pick, value in zip(picks, values)]


@functools.cache
def _puller(picks: tuple[Pick, ...]) -> Puller:
    return Puller(picks)


def _column(pick: Pick, values: list) -> pa.Array:
    """One pick of all documents as an Arrow array; rows are built part by part."""
    kind = to_arrow_type(pick.spark_type())
    if not pick.parts:
        return pa.array(values, kind)
    offsets, rows = [], []
    for value in values:
        offsets.append(None if value is None else len(rows))
        rows.extend(value or ())
    inner = kind.value_type
    parts = [pa.array([row[k] for row in rows], inner.field(k).type) for k in range(len(pick.parts))]
    return pa.ListArray.from_arrays(pa.array([*offsets, len(rows)], pa.int32()), pa.StructArray.from_arrays(parts, fields=list(inner)))


def xml_struct(picks: Sequence[Pick]) -> Callable[[Column], Column]:
    """A function from a column of XML (string, or binary in its declared encoding) to a struct.

    The struct has one field per pick, and `error`: null, or why the document could not be
    parsed, in which case the other fields are null. A bad document never fails the job. The plain documents of a batch
    are read together (`xmlbatch`), others in one pass each (`xmlpull`); one that neither decides is made a tree of.
    """
    picks = tuple(picks)
    result = T.StructType([T.StructField(pick.name, pick.spark_type()) for pick in picks]).add("error", "string")

    kinds = [to_arrow_type(pick.spark_type()) for pick in picks]

    def singly(documents: pa.Array) -> list[pa.Array]:
        """The columns of documents that are read one by one, the errors last."""
        puller, found, errors = _puller(picks), [], []
        collecting = gc.isenabled()
        gc.disable()  # there are no cycles, and a batch of values is many objects to walk
        try:
            for document in documents:
                raw, error = document.as_py(), None
                try:
                    values = puller.read(raw)
                except Exception:
                    try:
                        values = _tree_values(raw, picks)
                    except Exception as problem:  # any bad document is set aside, with the reason
                        values, error = [None] * len(picks), f"{type(problem).__name__}: {problem}"
                found.append(values)
                errors.append(error)
        finally:
            if collecting:
                gc.enable()
        columns = [_column(pick, [values[i] for values in found]) for i, pick in enumerate(picks)]
        return [*columns, pa.array(errors, pa.string())]

    @F.arrow_udf(result)
    def parse(documents: pa.Array) -> pa.Array:
        read = read_plain(_puller(picks), documents, kinds)
        if read is None:
            columns = singly(documents)
        else:
            columns, plain = [*read[0], pa.nulls(len(documents), pa.string())], read[1]
            if not plain.all():
                # Each row from the one reading or the other.
                other = np.cumsum(~plain) - 1 + len(documents)
                place = pa.array(np.where(plain, np.arange(len(documents)), other))
                rest = singly(documents.filter(pa.array(~plain)))
                columns = [pa.concat_arrays([one, two]).take(place) for one, two in zip(columns, rest)]
        return pa.StructArray.from_arrays(columns, fields=list(to_arrow_type(result)))

    return parse
