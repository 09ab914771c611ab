"""Ranked lexical search: the best documents for each query text, by integer term weights.

1. Texts are cut into terms once. What is kept of a document is its vector: the query terms in it, how often each
   occurs, and its length. Number of documents, their length and each term's document count are sums over these.
2. A vector's coordinates become impacts (weight times saturated frequency). Its two greatest ones say what the
   document is like: documents are dealt by ranges of them, so that like ones come together.
3. A task takes its documents in segments and inverts each into one posting list per term. A list is ordered by the
   greatest coordinate that its documents have besides the list's own term and cut into blocks, so that a block holds documents that
   are alike. The summary of a block is the maximum of every coordinate over its documents.
4. Lists are opened from the heaviest term on. A document in a block scores at most the sum of the summary over the
   query's terms whose lists are still to come (had it a term of an earlier list, it was met there). If that bound fails to
   reach the query's tenth best score, the block is skipped; if the bound of all lists to come fails, so are they. All
   other documents are scored whole. Bounds are sums of the same integers as the scores, so they are exact.
5. The best of every task meet in one ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.llm.registry import query, table, written
from patloom.llm.words import Powers, byte_values, filled, lists, slices, words_of

BREAKS = (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))  # ASCII but letters and digits
BEST = 10
QUERY_BYTES = 1 << 20  # of query texts that are searched together; more take more passes
SEGMENT_POSTINGS = 1 << 20
BLOCK_DOCS = 64
SUMMARY_CELLS = 1 << 20  # of all blocks of a list; blocks are larger where a list would take more


def terms_of(texts: pa.Array, values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the terms of some texts, one text after the other, and where each text's begin (and the last ends).

    A term is a run of letters and digits of ASCII, A to Z in lower case, and of all other characters beyond ASCII.
    """
    words = words_of(texts, values, powers, BREAKS)
    return words.hashes, words.first


class Queries:
    """Query texts as sparse rows over their own terms, which are numbered by their hashes."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        self.ids = ids
        hashes, first = terms_of(filled(pa.array(texts, pa.string())), byte_values(), Powers())
        self.vocabulary, terms = np.unique(hashes, return_inverse=True)
        owners = np.repeat(np.arange(len(ids)), np.diff(first))
        keys, self.times = np.unique(owners * max(1, len(self.vocabulary)) + terms, return_counts=True)
        owner, self.terms = np.divmod(keys, max(1, len(self.vocabulary)))
        self.first = np.searchsorted(owner, np.arange(len(ids) + 1))
        # The other way round: which queries have a term, and how often.
        by_term = np.argsort(self.terms, kind="stable")
        self.askers, self.asked = owner[by_term], self.times[by_term]
        self.begin = np.searchsorted(self.terms[by_term], np.arange(len(self.vocabulary) + 1))


def _vectors(queries: Queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        size = len(queries.vocabulary)
        for batch in batches:
            texts = filled(batch.column(1))
            lengths, counts, terms, times = [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for start, stop in slices(texts):
                hashes, first = terms_of(texts.slice(start, stop - start), values, powers)
                lengths.append(np.diff(first))
                owner = np.repeat(np.arange(stop - start), lengths[-1])
                at = np.minimum(np.searchsorted(queries.vocabulary, hashes), size - 1)
                hit = queries.vocabulary[at] == hashes
                keys, n = np.unique(owner[hit] * size + at[hit], return_counts=True)
                counts.append(np.bincount(keys // size, minlength=stop - start))
                terms.append(keys % size)
                times.append(n)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            length = pa.array(np.concatenate(lengths) if lengths else n, pa.int64())
            columns = [batch.column(0), length, *(lists(np.concatenate(x).astype(np.int32), n) for x in (terms, times))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "length", "terms", "times"])

    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and where each list begins (and the last ends)."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _impacts(weights: np.ndarray, documents: int, total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, first = _flat(batch.column(2))
            times, counts = _flat(batch.column(3))[0].astype(np.int64), np.diff(first)
            length = batch.column(1).to_numpy()
            norm = 25 + 75 * length * documents // total
            values = weights[terms] * (1_000_000_000 * times // (1000 * times + 8 * np.repeat(norm, counts)))
            owner = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((terms, -values, owner))
            leads = [np.where(counts > i, terms[order[np.minimum(first[:-1] + i, len(order) - 1)]], -1) for i in (0, 1)] if len(order) else []
            leads = [pa.array(x.astype(np.int32)) for x in leads] or [pa.array(np.full(len(counts), -1, np.int32))] * 2
            columns = [batch.column(0), *leads, batch.column(2), lists(values, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "lead", "second", "terms", "impacts"]).filter(pa.array(counts > 0))

    return run


class Segment:
    """Some documents and their posting lists."""

    def __init__(self, batches: list[pa.RecordBatch], size: int) -> None:
        """`batches` of (id, lead, second, terms, impacts), `size` the number of terms there are."""
        table_ = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        self.ids, self.size = table_.column(0), size
        leads = [table_.column(i).to_numpy() for i in (1, 2)]
        self.terms, self.first = _flat(table_.column(3))
        self.impacts = _flat(table_.column(4))[0]
        owner = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        other = np.where(leads[0][owner] != self.terms, leads[0][owner], leads[1][owner])
        order = np.lexsort((owner, other, self.terms))  # a list's documents by what else they hold
        self.docs = owner[order]
        self.begin = np.searchsorted(self.terms[order], np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        np.maximum.at(self.most, self.terms, self.impacts)

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of all coordinates of some documents, and how many each has."""
        counts = self.first[docs + 1] - self.first[docs]
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(self.first[docs], counts) + inside, counts

    def blocks(self, term: int, places: np.ndarray, coordinates: int) -> tuple[np.ndarray, int, np.ndarray]:
        """(documents, documents in a block, summaries) of a term's list; `places` numbers the coordinates wanted."""
        docs = self.docs[self.begin[term] : self.begin[term + 1]]
        width = max(BLOCK_DOCS, -(-len(docs) * coordinates // SUMMARY_CELLS))
        at, counts = self.rows(docs)
        columns = places[self.terms[at]]
        wanted = columns >= 0
        block = np.repeat(np.arange(len(docs)) // width, counts)
        summary = np.zeros((-(-len(docs) // width), coordinates), np.int64)
        np.maximum.at(summary, (block[wanted], columns[wanted]), self.impacts[at[wanted]])
        return docs, width, summary

    def scores(self, docs: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The scores of some documents, `times` being how often the query has each term."""
        at, counts = self.rows(docs)
        return np.add.reduceat(times[self.terms[at]] * self.impacts[at], np.cumsum(counts) - counts)


class Search:
    """The best documents so far of every query."""

    def __init__(self, queries: Queries, weights: np.ndarray, best: int) -> None:
        self.queries, self.best = queries, best
        self.order = np.argsort(-weights, kind="stable")  # lists are opened from the heaviest term on
        self.place = np.argsort(self.order)
        self.needed = np.ones(len(queries.ids), np.int64)  # the score below which a document does not count
        self.found: list[list[tuple]] = [[] for _ in queries.ids]
        self.opened = self.skipped = 0  # blocks

    def add(self, segment: Segment, number: int) -> None:
        asked = self.queries
        to_come = np.zeros(len(asked.ids), np.int64)
        np.add.at(to_come, np.repeat(np.arange(len(asked.ids)), np.diff(asked.first)), asked.times * segment.most[asked.terms])
        for term in self.order[segment.most[self.order] > 0]:
            span = slice(asked.begin[term], asked.begin[term + 1])
            askers = asked.askers[span]
            alive = askers[to_come[askers] >= self.needed[askers]]
            if len(alive):
                self._open(segment, number, int(term), alive)
            to_come[askers] -= asked.asked[span] * segment.most[term]

    def _open(self, segment: Segment, number: int, term: int, alive: np.ndarray) -> None:
        asked, own = self.queries, {}
        for q in alive:
            row = slice(asked.first[q], asked.first[q + 1])
            still = self.place[asked.terms[row]] >= self.place[term]
            own[q] = (asked.terms[row][still], asked.times[row][still])
        wanted = np.unique(np.concatenate([terms for terms, _ in own.values()]))
        places = np.full(segment.size, -1)
        places[wanted] = np.arange(len(wanted))
        docs, width, summary = segment.blocks(term, places, len(wanted))
        for q in alive:
            terms, times = own[q]
            bounds = summary[:, places[terms]] @ times
            there = bounds >= self.needed[q]
            self.opened, self.skipped = self.opened + int(there.sum()), self.skipped + int((~there).sum())
            if there.any():
                self._score(segment, number, q, docs[np.repeat(there, width)[: len(docs)]])

    def _score(self, segment: Segment, number: int, q: int, docs: np.ndarray) -> None:
        asked, times = self.queries, np.zeros(segment.size, np.int64)
        row = slice(asked.first[q], asked.first[q + 1])
        times[asked.terms[row]] = asked.times[row]
        scores = segment.scores(docs, times)
        good = scores >= self.needed[q]
        if not good.any():
            return
        docs, scores = docs[good], scores[good]
        ids = segment.ids.take(pa.array(docs)).to_pylist()
        held = {*self.found[q], *((-s, i is None, i, number, d) for s, i, d in zip(scores.tolist(), ids, docs.tolist()))}
        self.found[q] = sorted(held, key=lambda r: (r[0], r[1], 0 if r[1] else r[2], r[3:]))[: self.best]
        if len(self.found[q]) == self.best:
            self.needed[q] = -self.found[q][-1][0]


def _search(queries: Queries, weights: np.ndarray, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, held, postings, number, kind = Search(queries, weights, best), [], 0, 0, None
        for batch in batches:
            if not len(batch):
                continue
            kind = batch.schema.field(0).type
            held.append(batch)
            postings += len(batch.column(3).flatten())
            if postings >= SEGMENT_POSTINGS:
                search.add(Segment(held, len(weights)), number)
                held, postings, number = [], 0, number + 1
        if held:
            search.add(Segment(held, len(weights)), number)
        rows = [(q, row) for q, found in enumerate(search.found) for row in found]
        if rows:
            columns = [pa.array([q for q, _ in rows], pa.int32()), pa.array([r[2] for _, r in rows], kind), pa.array([-r[0] for _, r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    return run


def _searched(docs: DataFrame, queries: Queries, best: int) -> DataFrame:
    """(query, id, score) of the best documents of each task, for (id, text)."""
    kind = dict(docs.dtypes)["id"]
    vectors = written(docs.mapInArrow(_vectors(queries), f"id {kind}, length bigint, terms array<int>, times array<int>"), "vectors")
    documents, total = vectors.agg(F.count_if(F.col("length") > 0), F.sum("length")).first()
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()  # a row per query term
    weights = np.zeros(len(queries.vocabulary), np.int64)
    for term, n in zip(*(counts.column(i).to_pylist() for i in (0, 1))):
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    shape = f"id {kind}, lead int, second int, terms array<int>, impacts array<bigint>"
    impacts = written(vectors.filter("length > 0").mapInArrow(_impacts(weights, documents, total or 1), shape), "impacts")
    # Alike documents side by side; those that are alike in both are told apart, so that they fill more than one task.
    like = ["lead", "second", "place"]
    dealt = impacts.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*like).sortWithinPartitions(*like).drop("place")
    return dealt.mapInArrow(_search(queries, weights, best), f"query int, id {kind}, score bigint")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item key, rank, key, score): for each item the `best` documents of highest score above 0, rank 1 the highest.

    The score is the sum, over the item's terms with repeats, of the term's weight times its saturated frequency in the
    document, in whole numbers. Equal scores go by ascending key, null last. Every row is a document, also a
    repeated one or one with a null key; a null text has no terms and is no document of the statistics. Items are rows that agree in key and
    text taken as one; an item without terms has no documents. Other columns do not matter.

    Items are searched in blocks of about `QUERY_BYTES` of text, whose terms are what is sent to the tasks; each block is a
    pass over the documents. Terms are known by 64-bit hashes.
    """
    given = items.select(F.col(item_key).alias("item"), F.col(item_text).cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    given = written(given, "items")
    size = given.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = -(-size // QUERY_BYTES)
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    numbered = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, blocks)))
    kinds = dict(given.dtypes)["item"], dict(rows.dtypes)["id"]
    out = docs.sparkSession.createDataFrame([], f"item {kinds[0]}, rank int, id {kinds[1]}, score bigint")
    for block in range(blocks):
        held = given.filter(numbered == block).collect()  # of bounded size
        queries = Queries([r["item"] for r in held], [r["text"] for r in held])
        if not len(queries.vocabulary):
            continue
        order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        placed = _searched(rows, queries, best).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        names = docs.sparkSession.createDataFrame([(i, r["item"]) for i, r in enumerate(held)], f"query int, item {kinds[0]}")
        out = out.unionByName(placed.join(F.broadcast(names), "query").drop("query"))  # as many names as the block has items
    return out.select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP13 = f"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') as terms from documents),
sizes as (select r, doc_id, len(terms) as n from docs where len(terms) > 0),
whole as (select count(*) as docs_n, sum(n)::bigint as total from sizes),
asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term from benchmark) group by item_id, term),
held as (
  select r, term, count(*) as tf from (select r, unnest(terms) as term from docs) where term in (select term from asked) group by r, term),
weights as (
  select term, floor(1000 * ln((2 * docs_n + 2) / (2 * count(*) + 1)))::bigint as w from held, whole group by term, docs_n),
impacts as (
  select h.r, h.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs_n) // total))) as impact
  from held h join weights using (term) join sizes using (r), whole),
scores as (
  select item_id, r, sum(times * impact)::bigint as score from asked join impacts using (term) group by item_id, r),
placed as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank
  from scores join sizes using (r) where score > 0)
select item_id, rank, doc_id, score from placed where rank <= 10
"""


@query("op13_search", OP13)
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
