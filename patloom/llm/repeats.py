"""Repeated passages, by a sparse suffix array.

Of all suffixes only those at minimisers are retained: in each run of `least` words (the shortest passage that
counts) the word position whose `GRAM` words have the least hash. Equal runs retain the same position.

1. The retained suffixes are sorted by their first words (as hashes: any order of words will do) and each is compared with its neighbours.
   One whose first words no neighbour has lies in no repeated passage, and is dropped. That leaves a small part of the corpus.
2. The others are extended to the left and right: each run of `least` words that has the retained position as its
   minimiser. The runs are sorted and compared with their neighbours in turn. Of equal runs the first in order of document id and position
   stays, the others repeat it; overlapping and adjoining runs make one span.

So a word is in a span if and only if a run of `least` words around it occurs earlier. Whole copies of
a text are found before, as neighbours in the order of their digests, and are not compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.llm.ordered import neighbours, repeated
from patloom.llm.prefilter import maybe_among, parted
from patloom.llm.registry import query, table, written
from patloom.llm.words import Powers, Words, byte_values, filled, gram_hashes, lists, slices, words_of

LEAST = 50  # words
GRAM = 8
PLACE_BITS = 28  # word positions in a slice

SPAN = "start_word int, end_word int"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of `width` values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[: len(values) - done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def minimisers(words: Words, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all runs of `least` words inside a text, the position that each retains, and all grams.

    Of equal grams in a run the leftmost counts.
    """
    grams = gram_hashes(words.hashes, gram)
    if len(grams) >> PLACE_BITS:
        raise ValueError(f"a text of more than {1 << PLACE_BITS} words")
    sizes = np.diff(words.first)
    starts = np.concatenate(
        [np.arange(a, a + n - least + 1) for a, n in zip(words.first[:-1], sizes) if n >= least] or [np.zeros(0, np.int64)]
    )
    if not len(starts):
        return starts, starts, grams
    keys = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    places = sliding_min(keys, least - gram + 1)[starts] & np.uint64((1 << PLACE_BITS) - 1)
    return starts, places.astype(np.int64), grams


def _retained(least: int, gram: int):
    """(text) and ids to the retained positions of each text and the hashes there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(fold=False), Powers()
        for batch in batches:
            texts = filled(batch.column(3))
            counts, places, grams = [], [], []
            sizes = []
            for start, stop in slices(texts):
                words = words_of(texts.slice(start, stop - start), values, powers)
                _, kept, hashes = minimisers(words, least, gram)
                kept = np.unique(kept)
                counts.append(np.diff(np.searchsorted(kept, words.first)))
                places.append(kept - np.repeat(words.first[:-1], counts[-1]))
                grams.append(hashes[kept])
                sizes.append(np.diff(words.first))
            together = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
            n = together(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(together(sizes, np.int32)),
                    lists(together(places, np.int32), n),
                    lists(together(grams, np.uint64), n),
                ],
                ["doc_id", "one", "two", "n_words", "places", "grams"],
            )

    return run


def _runs(least: int, gram: int):
    """(ids, text, places) to the hash and start of each run that retains one of the places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(fold=False), Powers()
        for batch in batches:
            texts = filled(batch.column(2))
            for start, stop in slices(texts):
                words = words_of(texts.slice(start, stop - start), values, powers)
                starts, kept, _ = minimisers(words, least, gram)
                wanted = batch.column(3).slice(start, stop - start)
                text_of = np.repeat(np.arange(stop - start), np.diff(wanted.offsets.to_numpy()))
                wanted = np.unique(wanted.flatten().to_numpy() + words.first[text_of])
                starts = starts[np.isin(kept, wanted)]
                of = np.searchsorted(words.first, starts, "right") - 1
                rows = batch.select([0, 1]).slice(start, stop - start).take(pa.array(of))
                hashes = gram_hashes(words.hashes, least)[starts] if len(starts) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(hashes.view(np.int64)), pa.array((starts - words.first[of]).astype(np.int32))],
                    ["doc_id", "one", "run", "start_word"],
                )

    return run


def _sealed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, one, two, text): two hashes stand for the text. A null text is empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(F.lit(1), whole).alias("one"), F.xxhash64(F.lit(2), whole).alias("two"), whole.alias("text")
    )


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(doc_id, one, start_word, end_word, first_doc_id, first_start_word) of all repeating spans.

    Words are runs of other than ASCII white space, compared with case. Spans are numbered by words, the
    end is exclusive. `first_doc_id` and `first_start_word` say where the span's first run occurs first, which may be
    earlier in the same document. `one` is a hash of the text, so that rows of one id and different
    texts are told apart; rows that agree in both are one document. A text of fewer than `least` words has no spans, even as a copy; a
    row without an id has none and is nobody's first.
    """
    sealed = _sealed(docs, key, text).filter(F.col("doc_id").isNotNull())
    kind = dict(sealed.dtypes)["doc_id"]
    ids = f"doc_id {kind}, one bigint, two bigint"
    kept = written(
        sealed.mapInArrow(_retained(least, gram), f"{ids}, n_words int, places array<int>, grams array<bigint>").filter(
            F.col("n_words") >= least
        ),
        "retained",
    )
    # Whole copies: the document of least id stays, and its suffixes alone are looked at.
    texts = neighbours(kept, ["one", "two"], ["doc_id"], "texts")
    copies = texts.filter(F.col("doc_id") != F.col("first_doc_id")).select("doc_id", "one", "n_words", "first_doc_id").distinct()
    own = texts.filter(F.col("doc_id") == F.col("first_doc_id"))
    suffixes = own.select("doc_id", "one", F.explode(F.arrays_zip("places", "grams")).alias("at")).select("doc_id", "one", "at.places", "at.grams")
    met = repeated(suffixes, ["grams"], ["doc_id", "places"], "suffixes")
    extended = written(met.groupBy("doc_id", "one").agg(F.collect_set("places").alias("places")), "extended")
    runs = written(
        maybe_among(sealed, extended, "doc_id")
        .join(extended, ["doc_id", "one"])
        .select("doc_id", "one", "text", "places")
        .mapInArrow(_runs(least, gram), f"doc_id {kind}, one bigint, run bigint, start_word int"),
        "runs",
    )
    # A document that is there twice has each run twice at one place, which is no repeat.
    place = F.struct("doc_id", "start_word", "one")
    origin = F.struct(*(F.col(f"first_{c}").alias(c) for c in ("doc_id", "start_word", "one")))
    equal = neighbours(runs, ["run"], ["doc_id", "start_word", "one"], "equal-runs", single=False)
    again = equal.filter(place != origin).select("doc_id", "one", "run", "start_word", origin.alias("origin"))
    spans = _islands(again, least)
    whole = copies.select(
        "doc_id",
        "one",
        F.lit(0).alias("start_word"),
        F.col("n_words").alias("end_word"),
        "first_doc_id",
        F.lit(0).alias("first_start_word"),
    )
    return spans.unionByName(whole)


def _islands(again: DataFrame, least: int) -> DataFrame:
    """Runs of one document that overlap or adjoin as one span."""
    of = W.partitionBy("doc_id", "one").orderBy("start_word")
    apart = (F.col("start_word") - F.lag("start_word").over(of) > least).cast("int")
    numbered = again.withColumn("island", F.sum(F.coalesce(apart, F.lit(0))).over(of))
    return numbered.groupBy("doc_id", "one", "island").agg(
        F.min("start_word").alias("start_word"),
        (F.max("start_word") + least).alias("end_word"),
        F.min_by("origin.doc_id", "start_word").alias("first_doc_id"),
        F.min_by("origin.start_word", "start_word").alias("first_start_word"),
    ).drop("island")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values, powers = byte_values(fold=False), Powers()
    for batch in batches:
        texts, spans = filled(batch.column(0)), batch.column(1).to_pylist()
        out = []
        for start, stop in slices(texts):
            words = words_of(texts.slice(start, stop - start), values, powers)
            ends = np.append(words.text_starts[1:], len(words.data))
            for d in range(stop - start):
                at, left = int(words.text_starts[d]), []
                starts = np.append(words.starts[words.first[d] : words.first[d + 1]], ends[d])
                for a, b in sorted((s["start_word"], s["end_word"]) for s in spans[start + d]):
                    left.append(words.data[at : starts[a]].tobytes())
                    at = int(starts[b])
                left.append(words.data[at : ends[d]].tobytes())
                out.append(b"".join(left).decode())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns[2:]], ["text", *batch.schema.names[2:]])


def without_spans(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the words of their spans, and the white space behind them, cut out.

    All columns stay; only texts with spans change. A document of which no word stays is left out.
    """
    # A document has no more spans than words; a set, so that rows of one id and text count once.
    cuts = written(spans.groupBy("doc_id", "one").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans")), "cuts")
    whole = F.coalesce(F.col(text), F.lit(""))
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    sealed = docs.select(
        row,
        F.col(key).alias("doc_id"),
        F.xxhash64(F.lit(1), whole).alias("one"),
    )
    maybe, rest = parted(sealed, cuts, "doc_id")  # only texts that may have spans move
    met = maybe.join(cuts, ["doc_id", "one"], "left")
    alone = rest.select("row").unionByName(met.filter("spans IS NULL").select("row"))
    fields = docs.schema.simpleString()
    cut = met.filter("spans IS NOT NULL").select(F.col("row")[text].alias("text"), "spans", "row")
    shorter = cut.mapInArrow(_cut, f"text string, row {fields}").filter(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))
    kept = alone.unionByName(shorter.select(F.col("row").withField(f"`{text}`", F.col("text")).alias("row")))
    return kept.select("row.*")


# Every run of 50 words whole; texts that are there before are one span, and their runs count once.
OP1 = r"""
with texts as (
  select distinct doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents where doc_id is not null),
long as (select *, min(doc_id) over (partition by text) as first_doc_id from texts where len(words) >= 50),
runs as (
  select doc_id, text, unnest(range(len(words) - 49)) as start, words from long where doc_id = first_doc_id),
named as (select doc_id, text, start, array_to_string(words[start + 1:start + 50], ' ') as run from runs),
met as (
  select doc_id, text, start,
    first(struct_pack(doc_id := doc_id, start := start)) over (partition by run order by doc_id, start, text) as origin
  from named),
again as (select * from met where struct_pack(doc_id := doc_id, start := start) <> origin),
apart as (select *, case when start - lag(start) over (partition by doc_id, text order by start) > 50 then 1 else 0 end as gap from again),
islands as (select *, sum(gap) over (partition by doc_id, text order by start) as island from apart),
spans as (
  select doc_id, min(start) as start_word, max(start) + 50 as end_word,
    min_by(origin.doc_id, start) as first_doc_id, min_by(origin.start, start) as first_start_word
  from islands group by doc_id, text, island)
select doc_id, start_word::int as start_word, end_word::int as end_word, first_doc_id, first_start_word::int as first_start_word from spans
union all
select doc_id, 0::int, len(words)::int, first_doc_id, 0::int from long where doc_id <> first_doc_id
"""


@query("op1_repeats", OP1)
def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spans of 50 words or more of documents that occur earlier."""
    spans = repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start_word", "end_word", "first_doc_id", "first_start_word")
