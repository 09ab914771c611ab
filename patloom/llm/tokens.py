"""Token counts of a BPE vocabulary with word ends, by a finite-state transducer and without making the tokens.

The input is a stream of symbols: a byte, or a byte that ends a piece (a word, a number, a run of other signs).
After each symbol, the last token of what has been read so far follows from the earlier places at which a token may
still be open: of the tokens that end here exactly one goes with the last token before it (that is, no merge
across their border comes before the merges that made them). So a state is the set of open places, each as a place in the
trie of tokens, the last token before it and the number of tokens up to it, less those up to now. A
transition carries the change in the number of tokens, and the end of a piece leads back to the first state.

States are made as texts need them (the whole machine would have far more than a corpus meets), and kept in a hash
table that numpy looks up. Texts are cut into chunks of equal length, all of which take a step at once. A chunk is a map from
the state at its begin to a state at its end and a count. A chunk with the end of a piece ends in the same state
wherever it began; so its part behind that end runs first, and the parts before follow from the states at their
begins. Chunks inside one long piece start from a guess; the maps found are put together from the left again until no
begin changes.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.registry import query, table
from patloom.llm.words import filled, slices

CHUNK = 64  # symbols
STATES = 200_000  # kept in a task; beyond it the machine is built anew
LIMIT = 2048  # tokens
LETTER, DIGIT, SPACE, OTHER = range(4)
EMPTY = np.uint64(2**64 - 1)
NEVER = 1 << 60  # rank of a merge that does not come

# ---- Fixed values: what the vocabulary file must say for this reader ------------------------
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS_OF_ONE = "stmd"
ENDINGS_OF_TWO = ("re", "ve", "ll")
# -------------------------------------------------------------------------------------------


def byte_signs() -> list[str]:
    """The sign that stands for each byte in the file: itself if it can be printed, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Machine:
    """The transducer over symbols 0 to 511, with the states met so far."""

    def __init__(self, model: dict) -> None:
        ids, end = model["vocab"], model["end_of_word_suffix"]
        names = byte_signs()
        spelled = {ids[sign]: (b,) for b, sign in enumerate(names)} | {ids[sign + end]: (256 + b,) for b, sign in enumerate(names)}
        self.pairs: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            one, two, whole = ids[a], ids[b], ids[a + b]
            self.pairs[one, two] = rank
            self.parts.setdefault(whole, (one, two, rank))
            spelled.setdefault(whole, spelled[one] + spelled[two])
        self.lefts, self.rights, self.fits = {}, {}, {}
        self.trie: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for token in self._made(spelled):
            node = 0
            for symbol in spelled[token]:
                self.inner[node] = True
                key = node << 9 | symbol
                if key not in self.trie:
                    self.trie[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.trie[key]
            self.token[node] = token
        self.clear()

    def _made(self, spelled: dict) -> Iterator[int]:
        """The tokens that their own text is encoded as: others are never seen."""
        made = {token for token in spelled if token not in self.parts}
        for token, (a, b, _) in self.parts.items():
            if a in made and b in made and self._undisturbed(a, b, whole=True):
                made.add(token)
        yield from made

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of a token while it is made, and the rank of the merge that ends each."""
        if token not in known:
            out, limit, at = [], NEVER, token
            while True:
                out.append((at, limit))
                if at not in self.parts:
                    break
                limit, at = self.parts[at][2], self.parts[at][side]
            known[token] = out
        return known[token]

    def _undisturbed(self, a: int, b: int, whole: bool = False) -> bool:
        """Whether no merge over the border of two tokens comes before those that make them."""
        for x, x_ends in self._edge(a, 1, self.rights):
            for y, y_ends in self._edge(b, 0, self.lefts):
                rank = self.pairs.get((x, y), NEVER)
                # Of equal merges the left one comes first.
                if rank < x_ends and rank <= y_ends and rank != NEVER and not (whole and x == a and y == b):
                    return False
        return True

    def _fit(self, a: int, b: int) -> bool:
        key = a << 20 | b
        if key not in self.fits:
            self.fits[key] = self._undisturbed(a, b)
        return self.fits[key]

    def clear(self) -> None:
        """Only the first state, where a piece begins."""
        self.states: list[tuple] = [((0, -1, 0),)]
        self.numbers = {self.states[0]: 0}
        self.fits.clear()
        self.held, self.keys, self.values = 0, np.full(1 << 12, EMPTY), np.zeros((1 << 12, 2), np.int32)

    def step(self, number: int, symbol: int) -> tuple[int, int]:
        """The state after a symbol, and the change in the number of tokens."""
        change, last, open_ = 0, -1, []
        for node, before, count in self.states[number]:
            node = self.trie.get(node << 9 | symbol)
            if node is None:
                continue
            token = self.token[node]
            if last < 0 and token >= 0 and (before < 0 or self._fit(before, token)):
                last, change = token, count + 1
            if self.inner[node]:
                open_.append((node, before, count))
        if last < 0:
            raise ValueError(f"no token ends at symbol {symbol}")
        if symbol >= 256:
            return 0, change
        state = (*((node, before, count - change) for node, before, count in open_), (0, last, 0))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state], change

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the table, or the free one where it belongs."""
        mask = len(self.keys) - 1
        at = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - mask.bit_length())).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[at[left]]
            left = left[(there != keys[left]) & (there != EMPTY)]
            at[left] = (at[left] + 1) & mask
        return at

    def _add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that the table does not hold."""
        if 2 * (self.held + len(keys)) > len(self.keys):
            old = self.keys != EMPTY
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            size = 1 << int(4 * len(keys)).bit_length()
            self.held, self.keys, self.values = 0, np.full(size, EMPTY), np.zeros((size, 2), np.int32)
        self.held += len(keys)
        while len(keys):
            at = self._place(keys)
            self.keys[at] = keys  # of several keys for a place the last one gets it
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values = keys[~won], values[~won]

    def steps(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of many rows."""
        keys = states.astype(np.uint64) << np.uint64(9) | symbols.astype(np.uint64)
        at = self._place(keys)
        missing = self.keys[at] != keys
        if missing.any():
            new = np.unique(keys[missing])
            self._add(new, np.array([self.step(int(k) >> 9, int(k) & 511) for k in new], np.int32))
            at = self._place(keys)
        found = self.values[at]
        return found[:, 0], found[:, 1]

    def run(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state at the end and the count of each run of symbols, from its state at the begin."""
        order = np.argsort(-sizes, kind="stable")
        states, counts, starts, sizes = entries[order].copy(), np.zeros(len(order), np.int64), starts[order], -sizes[order]
        for i in range(int(-sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(sizes, -i))  # runs longer than i
            states[:n], more = self.steps(states[:n], symbols[starts[:n] + i])
            counts[:n] += more
        back = np.argsort(order)
        return states[back], counts[back]

    def counts(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of consecutive texts, given their symbols and how many each has."""
        if len(self.states) > STATES:
            self.clear()
        chunks = -(-sizes // CHUNK)
        text = np.repeat(np.arange(len(sizes)), chunks)
        inside = (np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)) * CHUNK
        starts = np.repeat(np.cumsum(sizes) - sizes, chunks) + inside
        ends = np.minimum(starts + CHUNK, np.repeat(np.cumsum(sizes), chunks))
        # Where a piece first begins in each chunk; the end of the chunk if none does.
        begins = np.flatnonzero(np.concatenate([[True], symbols[:-1] >= 256])) if len(symbols) else np.zeros(0, np.int64)
        at = np.searchsorted(begins, starts)
        first = np.minimum(np.append(begins, len(symbols))[at], ends)
        exits, counts = self.run(symbols, first, ends - first, np.zeros(len(starts), np.int64))
        # The heads: a chunk without the begin of a piece goes through whole, so its end depends on its begin.
        heads = np.flatnonzero(first > starts)
        whole, entry = first[heads] == ends[heads], np.full(len(heads), -1)
        whole &= symbols[ends[heads] - 1] < 256  # else the piece ends with the chunk, in the first state
        weights = np.zeros(len(heads), np.int64)
        while True:
            given = exits[heads - 1]
            todo = np.flatnonzero(given != entry)
            if not len(todo):
                break
            entry[todo] = given[todo]
            rows = heads[todo]
            out, weights[todo] = self.run(symbols, starts[rows], first[rows] - starts[rows], given[todo])
            exits[rows[whole[todo]]] = out[whole[todo]]
        counts[heads] += weights
        return np.bincount(text, counts, len(sizes)).astype(np.int64) if len(text) else np.zeros(len(sizes), np.int64)


class Reader:
    """Texts to symbols, as the vocabulary file normalises and splits them."""

    def __init__(self, file: str) -> None:
        self.file, spec = file, json.loads(file)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, bytes_ = spec["pre_tokenizer"]["pretokenizers"]
        fits = kinds == ["NFC", "Replace", "Lowercase"] and split["pattern"]["Regex"] == PIECES
        if not fits or bytes_["type"] != "ByteLevel" or any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("a vocabulary of another kind")
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.opening = [t["content"][:2] for t in spec["added_tokens"]]
        self.kinds, self.newer = self._kinds()
        self.machine = Machine(spec["model"])

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.file)

    def _kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """Letter, digit, space or other, by code point, and which ones this Python's tables do not know yet.

        Those are asked of the library, whose tables may be newer.
        """
        points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000])
        signs, kinds = "".join(map(chr, points)), np.full(0x110000, OTHER, np.uint8)
        for kind, name in ((LETTER, "L"), (DIGIT, "N"), (SPACE, "White_Space")):
            for found in regex.finditer(rf"\p{{{name}}}+", signs):
                kinds[points[found.start() : found.end()]] = kind
        unknown = [p for p in points if unicodedata.category(chr(p)) == "Cn"]
        asked = [p for p in unknown if kinds[p] != OTHER]
        kinds[unknown] = OTHER
        given = "".join(f"a{chr(p)}{chr(p)}a! " for p in asked)
        ends = [span[1] for _, span in self.library.pre_tokenizer.pre_tokenize_str(given)]
        pieces = np.bincount(np.searchsorted(np.arange(6, 6 * len(asked) + 1, 6), np.array(ends, np.int64)), minlength=len(asked) + 1)
        for point, n in zip(asked, pieces):
            kinds[point] = {2: LETTER, 5: DIGIT, 3: SPACE}.get(int(n), OTHER)
        newer = np.zeros(0x110000, bool)
        newer[unknown] = True
        return kinds, newer

    def normalised(self, text: str) -> tuple[str, int]:
        """The text as it is split, and the number of special tokens taken out of it."""
        special = 0
        if any(opening in text for opening in self.opening):
            text, special = self.special.subn("\n", text)
        if text.isascii():
            return text.lower(), special
        if self.newer[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.library.normalizer.normalize_str(text), special
        # Every sigma in the same lower case, wherever it stands.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower(), special

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of normalised texts and how many each text has."""
        joined = "\n".join([*texts, "\n\n"])
        if joined.isascii():
            points = np.frombuffer(joined.encode(), np.uint8)
        else:
            points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = self.kinds[points]
        before = np.concatenate([[SPACE], kinds[:-1]])
        begins = (kinds != SPACE) & ((kinds != before) | (kinds == DIGIT))
        quote = np.flatnonzero((points == ord("'")) & begins)
        one, two = points[quote + 1], points[quote + 2]
        short = np.isin(one, [ord(c) for c in ENDINGS_OF_ONE])
        long = np.zeros(len(quote), bool)
        for a, b in ENDINGS_OF_TWO:
            long |= (one == ord(a)) & (two == ord(b))
        begins[quote[short | long] + 1] = False
        behind = np.concatenate([quote[short] + 2, quote[long] + 3])
        begins[behind] |= kinds[behind] == LETTER
        kept = kinds != SPACE
        ending = kept & np.concatenate([begins[1:] | (kinds[1:] == SPACE), [True]])
        # An end in the middle of nothing: the sign before a piece that begins.
        if points.dtype != np.uint8:
            widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            data = np.frombuffer(joined.encode(), np.uint8)
            last = np.zeros(len(data), bool)
            last[np.cumsum(widths)[ending] - 1] = True
            stays = np.repeat(kept, widths)
            out, sizes = data[stays] + np.uint16(256) * last[stays], kept * widths
        else:
            out, sizes = points[kept] + np.uint16(256) * ending[kept], kept
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        return out, offsets[starts + lengths] - offsets[starts]

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        plain, special = zip(*map(self.normalised, texts)) if texts else ((), ())
        return self.machine.counts(*self.symbols(list(plain))) + np.array(special, np.int64)


_READERS: dict[str, Reader] = {}  # of this process, so that tasks of one worker share the machine


def reader(file: str) -> Reader:
    """The reader of a vocabulary file's content."""
    seal = hashlib.sha256(file.encode()).hexdigest()
    if seal not in _READERS:
        _READERS.clear()
        _READERS[seal] = Reader(file)
    return _READERS[seal]


def token_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every text, as the library counts them.

    The file at `path` is read once, by the driver, and sent to the tasks (1.7 MB). Strings of special tokens inside a text
    are one token each. A null or empty text has no bytes and no tokens; a null key is a key like others and
    repeated rows are rows of their own. Texts stay in their tasks, whatever their length. Other columns do not matter.
    """
    kind = dict(df.dtypes)[key]
    file = df.sparkSession.sparkContext.broadcast(Path(path).read_text("utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = reader(file.value)
        for batch in batches:
            texts = filled(batch.column(1))
            counts = [counter.counts(texts.slice(a, b - a).to_pylist()) for a, b in slices(texts)]
            n = pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, n, pa.compute.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("doc_id", key)


def public_words() -> str:
    """Path of the installed public vocabulary with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op12_tokens")
def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of all documents."""
    return token_counts(table(spark, sf_dir, "documents"), public_words())
