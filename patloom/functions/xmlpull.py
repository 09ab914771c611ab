"""Picks read from an XML document in one pass, without a tree.

The paths of all picks are one automaton over element names, whose states are made as documents need them. What an
element opens (a text that is wanted, a row, a scope) hangs on its state, so an element that no path
meets costs two look-ups. Documents of unusual form (an anchor inside itself, an entity that is not
declared, anything that is not well-formed) are left to the tree, which says what they mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from xml.parsers import expat


class Unusual(Exception):
    """A document that the one pass does not decide."""


def _steps(path: str) -> list[tuple[bool, str]]:
    """Steps of a path: whether at any depth, and the name."""
    out, deep = [], False
    for part in path.removeprefix("./").lstrip("/").split("/"):
        if not part:
            deep = True
            continue
        out.append((deep, part))
        deep = False
    return [(True, out[0][1]), *out[1:]] if path.startswith(".//") else out


def _predicate(name: str) -> tuple[str, tuple[str, str] | None]:
    """`abstract[@id='abst']` as its name, attribute and value."""
    if "[@" not in name:
        return name, None
    plain, rest = name.split("[@")
    attribute, value = rest.rstrip("]").split("=")
    return plain, (attribute, value.strip("'\""))


class _Plan:
    """A pick as steps, and those of its parts."""

    def __init__(self, pick) -> None:
        self.pick, self.take, self.strip = pick, pick.take, pick.strip
        self.names = frozenset(pick.path.split()) if pick.take == "blocks" else frozenset()
        self.scope = None
        if pick.within:
            (_, name), *more = _steps(pick.within)
            if more:
                raise ValueError(f"{pick.within}: a scope is one element")
            self.scope = _predicate(name)
        self.steps = [] if pick.take in ("attribute", "blocks") else _steps(pick.path)
        if any("[" in name for _, name in self.steps):
            raise ValueError(f"{pick.path}: only the scope may have a condition")
        self.parts = []
        for _, sub in pick.parts:
            head, marked, tail = sub.partition("[1]/")
            self.parts.append((([head] + tail.split("/")) if marked else sub.split("/"), bool(marked)))

    def empty(self):
        if self.take in ("attribute", "first") or self.scope:
            return None
        return []


class Puller:
    """Reads documents with one automaton; `values` are those of the picks, in their order."""

    def __init__(self, picks: Sequence) -> None:
        self.plans = [_Plan(pick) for pick in picks]
        self.anchors = {plan.steps[0][1] for plan in self.plans if plan.steps and not plan.scope}
        self.scopes: dict[str, list[tuple[int, tuple[str, str] | None]]] = {}
        for i, plan in enumerate(self.plans):
            if plan.scope:
                self.scopes.setdefault(plan.scope[0], []).append((i, plan.scope[1]))
        # A state is a set of (pick, part or -1, steps taken): what may come next inside an element.
        self.states: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.moves: dict[tuple[int, str], tuple] = {}
        self.first_state = self._number(frozenset((i, -1, 0) for i, plan in enumerate(self.plans) if plan.steps and not plan.scope))

    def _number(self, items: frozenset) -> int:
        if items not in self.numbers:
            self.numbers[items] = len(self.states)
            self.states.append(items)
        return self.numbers[items]

    def _move(self, state: int, tag: str) -> tuple:
        """The state inside a child, what the child is ((kind, pick, part) of all that meet it), and whether it may be an anchor or scope."""
        inside, met = set(), []
        for pick, part, taken in self.states[state]:
            plan = self.plans[pick]
            if part < 0 and plan.take == "blocks":  # in the scope of the blocks
                inside.add((pick, part, taken))
                if tag.rpartition("}")[2] in plan.names:
                    met.append(("whole", pick, -1))
                continue
            if part < 0:
                deep, name = plan.steps[taken]
                if deep:
                    inside.add((pick, part, taken))
                if name != tag:
                    continue
                taken += 1
                if taken < len(plan.steps):
                    inside.add((pick, -1, taken))
                    continue
                if plan.take in ("rows", "lists"):
                    met.append(("row", pick, -1))
                    inside.update((pick, k, 0) for k in range(len(plan.parts)))
                else:
                    met.append(("whole" if plan.take == "pieces" else "lead", pick, -1))
                continue
            path, marked = plan.parts[part]
            if path[taken] != tag:
                continue
            if marked and taken == 0:
                met.append(("count", pick, part))
            if taken + 1 < len(path):
                inside.add((pick, part, taken + 1))
            else:
                met.append(("part", pick, part))
        met.sort(key=lambda one: one[0] != "row")  # a row opens before its parts
        self.moves[state, tag] = move = (self._number(frozenset(inside)), tuple(met), tag in self.anchors, self.scopes.get(tag))
        return move

    def _scoped(self, state: int, picks: Sequence[int]) -> int:
        return self._number(self.states[state] | {(i, -1, 0) for i in picks})

    def read(self, document: str | bytes) -> list:
        """The values of all picks. Raises `Unusual`, or whatever the parser does, where the tree has to say."""
        plans, moves = self.plans, self.moves
        values = [plan.empty() for plan in plans]
        stack: list[int] = []
        texts: list[str] = []
        leads: list[tuple] = []  # who wants the text before the next tag
        wholes: list[tuple[int, int, int, list[str]]] = []  # depth, pick, place in its list, pieces so far
        rows: dict[int, list] = {}
        counts: dict[tuple[int, int], int] = {}
        opened: list[tuple[int, str]] = []  # depth and name of the anchors that are open

        def flush() -> None:
            text = "".join(texts)
            texts.clear()
            if wholes and text:
                for _, _, _, pieces in wholes:
                    pieces.append(text)
            for kind, pick, part in leads:
                plan = plans[pick]
                clean = text.strip() if plan.strip else text
                if kind == "part":
                    row = rows[pick]
                    if plan.take == "lists":
                        row[part].append(clean)
                    elif row[part] is None and counts.get((pick, part), 1) == 1:
                        row[part] = clean
                elif plan.take == "first":
                    if values[pick] is None:
                        values[pick] = clean
                elif text:
                    values[pick].append(clean)
            leads.clear()

        def start(tag: str, attributes: dict) -> None:
            if leads or wholes:
                flush()
            elif texts:
                texts.clear()
            if not stack:
                for i, plan in enumerate(plans):
                    if plan.take == "attribute":
                        value = attributes.get(plan.pick.path)
                        values[i] = value.strip() if value is not None and plan.strip else value
                stack.append(self.first_state)
                return
            state, met, anchor, scoped = moves.get((stack[-1], tag)) or self._move(stack[-1], tag)
            if anchor:
                if any(name == tag for _, name in opened):
                    raise Unusual
                opened.append((len(stack), tag))
            if met:
                for one in met:
                    kind, pick, part = one
                    if kind == "lead" or kind == "part":
                        leads.append(one)
                    elif kind == "row":
                        plan = plans[pick]
                        rows[pick] = row = [[] if plan.take == "lists" else None for _ in plan.parts]
                        values[pick].append(row)
                        for k in range(len(plan.parts)):
                            counts.pop((pick, k), None)
                    elif kind == "count":
                        counts[pick, part] = counts.get((pick, part), 0) + 1
                    else:
                        values[pick].append(None)
                        wholes.append((len(stack), pick, len(values[pick]) - 1, []))
            if scoped:
                new = [i for i, test in scoped if values[i] is None and (test is None or attributes.get(test[0]) == test[1])]
                if new:
                    for i in new:
                        values[i] = []
                        if plans[i].take == "blocks" and tag.rpartition("}")[2] in plans[i].names:
                            raise Unusual
                    state = self._scoped(state, new)
            stack.append(state)

        def end(tag: str) -> None:
            if leads or wholes:
                flush()
            elif texts:
                texts.clear()
            stack.pop()
            depth = len(stack)
            while wholes and wholes[-1][0] == depth:
                _, pick, at, pieces = wholes.pop()
                plan = plans[pick]
                whole = ("" if plan.take == "blocks" else " ").join(pieces)
                values[pick][at] = whole.strip() if plan.take == "blocks" and plan.strip else whole
            if opened and opened[-1][0] == depth:
                opened.pop()

        def other(data: str) -> None:
            if data.startswith("&"):
                raise Unusual

        parser = expat.ParserCreate(None, "}")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler = start, end
        parser.CharacterDataHandler, parser.DefaultHandlerExpand = texts.append, other
        parser.Parse(document, True)
        return values
