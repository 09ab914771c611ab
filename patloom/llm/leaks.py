"""Benchmark items in documents, also with other numbers, names and units.

Texts become templates: words without outer punctuation, lower-cased, with a typed placeholder for numbers, for
names (capitalised words inside a sentence) and for units behind numbers. Windows of `WINDOW` template words of the items meet equal windows of the
documents by hash, and so do windows of their real words, since what is a name depends on case and
place; a bitmap of fixed size, made from the item windows, keeps all others inside the tasks that
read the documents. Windows on one diagonal (the same shift between item and document) make a
match, if what stands in the slots is consistent: within a run of windows that touch, each value of the item's slots has one
value in the document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patloom.llm.prefilter import bitmap, hits
from patloom.llm.registry import query, table, written
from patloom.llm.words import Powers, Words, byte_values, filled, gram_hashes, hash_runs, lists, mixed, slices, words_of

WINDOW = 13  # words; a shorter item is one window
LEAST = 5  # words of the shortest item that is looked for with other slots
LITERAL = 0.6  # share of a window that must be words, not placeholders, to be looked for with other slots

# ---- Fixed values: units of measure -------------------------------------------------------
UNITS = (
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg t oz lb lbs gram grams kilogram kilograms ton tons pound pounds ml cl "
    "dl l liter liters litre litres gallon gallons s sec min h hr second seconds minute minutes hour hours day days "
    "week weeks month months year years k c f degree degrees w kw mw v a hz khz mhz ghz j kj cal kcal pa kpa bar "
    "b kb mb gb tb usd eur gbp dollar dollars euro euros cent cents percent mph kmh"
).split()
# -------------------------------------------------------------------------------------------

NUMBER, NAME, UNIT = (int(x) for x in mixed(np.array([101, 102, 103], np.uint64)))
PUNCTUATION = bytes(x for x in range(33, 127) if not chr(x).isalnum())


def _set(of: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(of)] = True
    return mask


def _lowered(data: np.ndarray) -> np.ndarray:
    """Latin letters with marks in lower case; those of ASCII are folded by their hash."""
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    return np.where(second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 0x20, data).astype(np.uint8)


class Templates:
    """Template words of the texts of a slice."""

    def __init__(self, words: Words, values: np.ndarray, powers: Powers) -> None:
        data = words.data
        starts, ends = words.starts.copy(), words.ends.copy()
        outer = _set(PUNCTUATION)
        for side, at, step in ((starts, 0, 1), (ends, -1, -1)):
            live = np.flatnonzero(ends > starts)
            while len(live):
                live = live[outer[data[side[live] + at]]]
                side[live] += step
                live = live[ends[live] > starts[live]]
        kept = ends > starts
        before = np.concatenate([[0], np.cumsum(kept)])
        self.first = before[words.first]
        old_start, old_end = words.starts[kept], words.ends[kept]
        starts, ends = starts[kept], ends[kept]
        lowered = _lowered(data)
        exact = hash_runs(lowered, starts, ends, values, powers)

        sums = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        digits, lines = sums(_set(b"0123456789")[data]), sums(data == 10)
        number = digits[ends] > digits[starts]
        opening = np.ones(len(starts), bool)
        opening[1:] = _set(b".!?:")[data[old_end[:-1] - 1]] | (lines[old_start[1:]] > lines[old_end[:-1]])
        opening[self.first[:-1][np.diff(self.first) > 0]] = True
        marked = lowered != data
        upper = _set(bytes(range(65, 91)))[data] | marked
        uppers = sums(upper)
        leading = upper[starts] | marked[np.minimum(starts + 1, len(data) - 1)] & (data[starts] == 0xC3)
        # A name has one capital, its first letter: words all in capitals are words.
        capital = leading & (uppers[ends] - uppers[starts] == 1) & (ends - starts > 1 + (data[starts] == 0xC3))
        name = capital & ~opening & ~number
        units = words_of(pa.array(UNITS), values, powers).hashes
        unit = np.zeros(len(starts), bool)
        unit[1:] = np.isin(exact[1:], units) & number[:-1]
        unit[self.first[:-1][np.diff(self.first) > 0]] = False
        unit &= ~name & ~number
        self.slot = number | name | unit
        self.exact = exact
        self.words = np.select([number, name, unit], [np.uint64(NUMBER), np.uint64(NAME), np.uint64(UNIT)], exact).astype(np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and text of all windows of a size inside one text: of template words, with enough literal ones, or of real words if the size is negative."""
        real, size = size < 0, abs(size)
        grams = gram_hashes(self.exact if real else self.words, size) ^ np.uint64(size + 64 * real)
        starts = np.arange(len(grams))
        text = np.searchsorted(self.first, starts, "right") - 1
        good = starts + size <= self.first[text + 1]
        if not real:
            good &= self.literal(starts, size)
        return grams[good], starts[good], text[good]

    def literal(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Whether enough words of a window are no placeholders."""
        spoken = np.concatenate([[0], np.cumsum(~self.slot)])
        return spoken[starts + size] - spoken[starts] >= LITERAL * size

    def seals(self) -> np.ndarray:
        """A hash of each text's real and template words."""
        whole = [blake2b(self.exact[a:b].tobytes() + self.words[a:b].tobytes(), digest_size=8).digest() for a, b in zip(self.first[:-1], self.first[1:])]
        return np.frombuffer(b"".join(whole), np.int64)

    def slots(self, start: int, size: int) -> np.ndarray:
        """What stands in the slots of a window."""
        return self.exact[start : start + size][self.slot[start : start + size]]


def _windows(sizes: Sequence[int] | None, words, whole: int = WINDOW):
    """(id, text, seal) to windows; without sizes each text has its own, of real words too (negative sizes), and the seal is made here.

    With sizes, what stands in the slots of a window of real words is left out: it is that of the other side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        for batch in batches:
            texts = filled(batch.column(1))
            for begin, end in slices(texts):
                template = Templates(words_of(texts.slice(begin, end - begin), values, powers), values, powers)
                own = np.minimum(np.diff(template.first), whole)
                seals = batch.column(2).slice(begin, end - begin) if sizes is not None else pa.array(template.seals())
                there = np.unique(own[own > 0]).tolist()
                for size in sizes if sizes is not None else [*(n for n in there if n >= LEAST), *(-n for n in there)]:
                    hashes, starts, text = template.windows(size)
                    wanted = own[text] == abs(size) if sizes is None else hits(words.value, hashes)
                    hashes, starts, text = hashes[wanted], starts[wanted], text[wanted]
                    empty = size < 0 and sizes is not None
                    slots = [template.slots(start, 0 if empty else abs(size)) for start in starts]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(text + begin)),
                            seals.take(pa.array(text)),
                            pa.array(np.full(len(starts), size, np.int32)),
                            pa.array(hashes.view(np.int64)),
                            pa.array((starts - template.first[text]).astype(np.int32)),
                            lists(np.concatenate([np.zeros(0, np.uint64), *slots]), np.array([len(x) for x in slots], np.int64)),
                        ],
                        ["id", "seal", "size", "window", "at", "slots"],
                    )

    return run


def _schema(df: DataFrame) -> str:
    return f"id {df.dtypes[0][1]}, seal bigint, size int, window bigint, at int, slots array<bigint>"


def places(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(id, seal, item, first_word, end_word, windows, kind): as `leaks`, with the hash of the document's text, `seal`."""
    given = items.select(F.col(item).alias("id"), F.col(text).cast("string"), F.lit(0).cast("long"))
    looked = given.mapInArrow(_windows(None, None), _schema(given))
    # Items of one seal are one; those that only begin alike keep all their windows.
    looked = written(
        looked.groupBy("seal", "size", "window", "at", "slots").agg(F.min("id").alias("item")).select("item", "size", "window", F.col("at").alias("item_at"), F.col("slots").alias("told")),
        "item-windows",
    )
    sizes = [row["size"] for row in looked.select("size").distinct().collect()]  # at most 2 * WINDOW
    words = docs.sparkSession.sparkContext.broadcast(bitmap(looked.select("window")))
    read = docs.select(F.col(doc).alias("id"), F.col(text).cast("string").alias("text")).withColumn("seal", F.xxhash64("text"))
    found = read.mapInArrow(_windows(sizes, words), _schema(read))
    met = found.join(looked, ["size", "window"])
    met = met.withColumn("slots", F.when(F.col("size") < 0, F.col("told")).otherwise(F.col("slots"))).select(
        "id",
        "seal",
        "item",
        (F.col("at") - F.col("item_at")).alias("shift"),
        (F.col("size") < 0).alias("real"),
        (F.abs("size") < LEAST).alias("short"),
        "at",
        (F.col("at") + F.abs("size")).alias("end"),
        F.arrays_zip("told", "slots").alias("pairs"),
    )
    # A match holds no more windows than its item has; sets, so that repeated rows do not add up. Windows of real words are
    # judged on their own: they stand there word for word, whatever the slots beside them hold.
    match = ("id", "seal", "item", "shift")
    own = (*match, "real")
    windows = met.groupBy(*own, "at").agg(F.max("end").alias("end"), F.bool_and("short").alias("short"), F.flatten(F.collect_set("pairs")).alias("pairs"))
    # Windows that touch are a run.
    order = Window.partitionBy(*own).orderBy("at")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = windows.withColumn("begins", (F.col("at") > before).cast("int"))
    runs = begins.withColumn("run", F.sum(F.coalesce("begins", F.lit(1))).over(order)).groupBy(*own, "run")
    gathered = runs.agg(
        F.min("at").alias("first_word"),
        F.max("end").alias("end_word"),
        F.count("*").cast("int").alias("windows"),
        F.bool_and("short").alias("short"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda pair: pair["told"])))
    same = F.forall("pairs", lambda pair: pair["told"] == pair["slots"])
    count = lambda side: F.coalesce(F.sum(F.when(side, F.col("windows"))), F.lit(0))
    matches = gathered.filter(consistent).groupBy(*match).agg(
        F.min("first_word").alias("first_word"),
        F.max("end_word").alias("end_word"),
        F.greatest(count(F.col("real")), count(~F.col("real"))).cast("int").alias("windows"),
        F.bool_and("short").alias("short"),
        F.bool_and(same).alias("same"),
    )
    kind = F.when(F.col("short"), "short").when(F.col("same"), "exact").otherwise("reparameterised")
    return matches.select("id", "seal", "item", "first_word", "end_word", "windows", kind.alias("kind"))


def leaks(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(doc, item, first_word, end_word, windows, kind): where an item stands in a document.

    `kind` is `short` for an item of fewer than 5 words, which may stand anywhere by chance; `exact` where the windows found
    hold the same in their slots, else `reparameterised`. Words are counted without
    those that are punctuation only. Items with the same words and placeholders throughout are one, known by the least id. An item or document
    that is null or has no words matches nothing. All windows match equal real words, whatever their number and
    case; those of 5 words or more that are not mostly placeholders match with other slots too. Within a run of such windows that
    touch, each value of the item must have one value in the document; windows of equal real words count whatever stands beside them. Rows of one document id and equal text
    count together, rows of other texts on their own, also without an id.
    """
    return places(docs, items, doc, item, text).drop("seal").withColumnsRenamed({"id": doc, "item": item})


@query("op10_leaks")
def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places of all documents where a benchmark item stands."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
