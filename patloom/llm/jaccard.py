"""N-gram Jaccard join of whole documents, with vertical partitioning.

The global order of n-grams is that of their 64-bit hashes, cut into fragments. Documents with equal
n-gram sets form a class, and classes are joined:

1. The head of the order says which documents can have a partner at all. A class shows its `HEAD` first
   n-grams. Two sets with Jaccard 0.8 or more share at least `NEED` of them: for sets of up to 20 by
   counting, for larger ones but for a chance below 1e-12, since each n-gram of the union is shared with
   probability 0.8 or more wherever the hash puts it. A class that shares fewer n-grams with all others together is out.
2. The sets of the others are cut into fragments. Every n-gram is counted in its fragment, and a class shows
   its rarest fifth: any partner shares one of these, and the first that two share bounds their overlap.
3. Buckets of classes that meet are not expanded into pairs. A few members, those with the most n-grams that
   others have as well, act as pivots and are paired with all members that the bounds allow; what has been linked is
   one component, and further pivots are taken from the smallest components until no bucket
   holds two components with a pair that was not counted.
4. Each pair is counted once: the n-grams of either document that lie in one fragment are intersected, every
   fragment on its own, and the partial overlaps are summed per pair. A pair that half of the fragments rule out reads no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.llm.components import components
from patloom.llm.prefilter import inside, parted
from patloom.llm.registry import query, table, written
from patloom.llm.words import Powers, byte_values, filled, gram_hashes, lists, mixed, slices, words_of

WORDS = 5
HEAD = 48
NEED = 16
FRAGMENT_BITS = 3
PIVOTS = 4


def _sets(texts: pa.Array, n: int, values: np.ndarray, powers: Powers) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; fewer words than n make one n-gram."""
    for start, stop in slices(texts):
        words = words_of(texts.slice(start, stop - start), values, powers)
        grams = gram_hashes(words.hashes, n)
        for a, b in zip(words.first[:-1], words.first[1:]):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            else:
                yield gram_hashes(words.hashes[a:b], b - a) if b > a else grams[:0]


def _summaries(n: int, head: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        for batch in batches:
            size, one, two, heads = [], [], [], []
            for grams in _sets(filled(batch.column(1)), n, values, powers):
                size.append(len(grams))
                one.append(np.sum(grams, dtype=np.uint64))
                two.append(np.sum(mixed(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))
                heads.append(grams[:head])
            together = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
            digests = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int32()), *digests, lists(together, np.array([len(h) for h in heads], np.int64))],
                ["doc_id", "seal", "n", "one", "two", "head"],
            )

    return run


def _fragments(n: int, bits: int, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        for batch in map(kept, batches):
            sets = list(_sets(filled(batch.column(0)), n, values, powers))
            cuts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
            one = [np.sum(g, dtype=np.uint64) for g in sets]
            two = [np.sum(mixed(g ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) for g in sets]
            counts = np.concatenate([np.diff(np.append(np.searchsorted(g, cuts), len(g))) for g in sets] or [np.zeros(0, np.int64)])
            wide = lambda x: pa.array(np.repeat(np.array(x, np.uint64), len(cuts)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([len(g) for g in sets], np.int32), len(cuts))),
                    wide(one),
                    wide(two),
                    pa.array(np.tile(np.arange(len(cuts), dtype=np.int32), len(sets))),
                    lists(np.concatenate(sets or [np.zeros(0, np.uint64)]), counts),
                ],
                ["n", "one", "two", "fragment", "grams"],
            )

    return run


def need(n: Column) -> Column:
    """How many n-grams of their heads two linked sets share, one of them of size n."""
    return F.least(F.lit(NEED), F.ceil(n * 4 / 5)).cast("int")


def close(n: Column, m: Column, common: Column) -> Column:
    """Whether sets of these sizes with so many n-grams in common, at most, can have Jaccard 0.8 or more."""
    return common * 9 >= (n + m) * 4


def candidates(heads: DataFrame) -> DataFrame:
    """The nodes of those classes (node, n, head) whose heads share enough n-grams with others."""
    tokens = heads.select("node", "n", F.explode("head").alias("token"))
    # Written, as below, so that both sides of the join are shuffled for it: only then Spark splits a hot key.
    shared = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1").select("token"), "shared")
    counted = tokens.join(shared, "token").groupBy("node", "n").agg(F.count(F.lit(1)).alias("shared"))
    return counted.filter(F.col("shared") >= need(F.col("n"))).select("node")


def buckets(fragments: DataFrame) -> DataFrame:
    """(token, node, n, common): the n-grams at which classes have to meet.

    The n-grams of a class are ranked by how many classes have them, rarest first; any partner shares one of
    the first fifth. `common` is how many n-grams the two can share at most if they meet here first.
    """
    tokens = fragments.select("node", "n", F.explode("grams").alias("token"))
    shared = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "shared")
    own = W.partitionBy("node")
    ranked = tokens.join(shared, "token").select(
        "token",
        "node",
        "n",
        # The n-grams that no other class has come before all of these.
        (F.count(F.lit(1)).over(own) - F.row_number().over(own.orderBy("often", "token")) + 1).cast("int").alias("common"),
    )
    return ranked.filter(F.col("common") * 5 >= F.col("n") * 4)


def overlaps(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb, ...) with `more`, the n-grams that their sets share, and `seen_a`, `seen_b`, those that each has: counted by fragment and summed."""
    left = fragments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("left"))
    right = fragments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("right"))
    parts = pairs.join(left, "a").join(right, ["b", "fragment"])
    count = F.size(F.array_intersect("left", "right"))
    sums = (F.sum(value).alias(name) for value, name in ((count, "more"), (F.size("left"), "seen_a"), (F.size("right"), "seen_b")))
    return parts.groupBy(*pairs.columns).agg(*sums)


def linked(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) of Jaccard 0.8 or more.

    One half of the fragments is counted first. A pair that could not link even if all n-grams of the smaller rest were shared goes
    no further.
    """
    half = F.col("fragment") < (1 << FRAGMENT_BITS - 1)
    most = F.col("more") + F.least(F.col("na") - F.col("seen_a"), F.col("nb") - F.col("seen_b"))
    first = overlaps(pairs, fragments.filter(half)).filter(close(F.col("na"), F.col("nb"), most))
    rest = first.select("a", "b", "na", "nb", F.col("more").alias("shared"))
    found = overlaps(written(rest, "halves"), fragments.filter(~half))
    shared = F.col("shared") + F.col("more")
    return found.filter(shared * 100 >= (F.col("na") + F.col("nb") - shared) * 80).select("a", "b")


def fitting(rows: DataFrame) -> DataFrame:
    """Bucket rows that may have a partner: even the smallest set of the bucket must be close enough."""
    least = rows.groupBy("token").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("often")).filter("often > 1")
    met = rows.join(least, "token")
    return met.filter(close(F.col("n"), F.col("least"), F.col("common"))).drop("least", "often")


def _pairs(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """Distinct pairs of a pivot and another member of its bucket, of another component and fitting size."""
    told = pivots.select(
        "token", F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("common").alias("most"), F.col("label").alias("other")
    )
    fits = close(F.col("n"), F.col("m"), F.least("common", "most"))
    met = rows.join(told, "token").filter((F.col("label") != F.col("other")) & fits)
    low = F.col("node") < F.col("pivot")
    pick = lambda yes, no: F.when(low, F.col(yes)).otherwise(F.col(no))
    return met.select(
        pick("node", "pivot").alias("a"), pick("pivot", "node").alias("b"), pick("n", "m").alias("na"), pick("m", "n").alias("nb")
    ).distinct()


def class_links(met: DataFrame, fragments: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """(node, label): components of the classes that meet in buckets (token, node, n, common).

    A bucket in which k members link with none of the others takes k rounds of pivots at most, four times
    as many in each round; every pair of unlinked members of a bucket is counted in the end.
    """
    rows, labels, counted = fitting(met).withColumn("label", F.col("node")), None, None
    columns = ["token", "node", "n", "common"]
    while True:
        ranked, order = rows, [F.col("common") / F.col("n") * -1, F.col("node")]
        if labels is not None:  # members of small components first
            sizes = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("size"))
            ranked, order = rows.join(sizes, ["token", "label"]), [F.col("size"), *order]
        first = F.row_number().over(W.partitionBy("token").orderBy(*order))
        chosen = written(ranked.withColumn("rank", first).filter(F.col("rank") <= pivots).select(*columns, "label"), "pivots")
        pairs = _pairs(rows, chosen)
        if counted is not None:
            pairs = pairs.join(counted, ["a", "b"], "left_anti")  # no pair is counted twice
        pairs = written(pairs, "pairs")
        counted = pairs.select("a", "b") if counted is None else counted.unionByName(pairs.select("a", "b"))
        links = linked(pairs, fragments)
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = components(links)
        left = rows.select(*columns).join(chosen.select("token", "node"), ["token", "node"], "left_anti")
        left = fitting(left).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed_up = left.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
        rows = written(left.join(mixed_up.select("token"), "token", "left_semi").select(*columns, "label"), "left")
        if rows.isEmpty():
            return labels
        pivots *= 4


def text_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, seal, n_shingles, component_id, label), one row per input row; `seal` is a hash of the text.
    `label` tells components apart that have one least id, as where an id has several texts.

    Words are runs of other than ASCII white space, ASCII letters lower-cased. A set holds the distinct
    runs of `words` words; a shorter text is one run. Texts link at Jaccard 0.8; components take the least
    id reachable. A text without words links with nothing, a row without an id neither: its component
    is null. Rows of one id and different texts are documents of their own, which may fall into different components.
    """
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("seal"))
    kind = dict(texts.dtypes)["doc_id"]
    node = F.xxhash64("one", "two", "n")
    summaries = texts.mapInArrow(_summaries(words, HEAD), f"doc_id {kind}, seal bigint, n int, one bigint, two bigint, head array<bigint>")
    sets = written(summaries.withColumn("node", node), "sets")
    classes = sets.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    # Joined by id as well, so that the rows of a large class are not gathered for it.
    heads = sets.filter("n > 0").join(classes, ["node", "doc_id"]).select("node", "n", "head")
    needed = written(classes.join(candidates(heads), "node").select("node", "doc_id"), "candidates")
    grams = (
        texts.filter("doc_id IS NOT NULL")
        .select("text", F.xxhash64("doc_id").alias("hash"))
        .mapInArrow(_fragments(words, FRAGMENT_BITS, inside(needed, "doc_id")), "n int, one bigint, two bigint, fragment int, grams array<bigint>")
        .select(node.alias("node"), "n", "fragment", "grams")
    )
    # Rows that share an id with a candidate, and repeated rows, go here.
    fragments = written(grams.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node", "fragment"]), "fragments")
    labels = class_links(written(buckets(fragments), "buckets"), fragments)
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    to = named.select("node", "label").join(least, "label").select("node", "component_id", "label")
    rows = sets.select("doc_id", "seal", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(to, "node", "left")
    return rows.select(
        "doc_id",
        "seal",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        "label",
    )


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, n_shingles, component_id) of `text_components`."""
    return text_components(docs, key, text, words).drop("seal", "label").withColumnRenamed("doc_id", key)


def one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each component: that of least id, then text hash.

    Of repeated rows one stays. Texts without words and rows without an id all stay, as they link with nothing.
    Only rows that may go are moved.
    """
    found = text_components(docs, key, text).filter("n_shingles > 0 AND doc_id IS NOT NULL")
    rows = written(found.groupBy("label", "doc_id", "seal").agg(F.count(F.lit(1)).alias("often")), "members")
    kept = rows.groupBy("label").agg(F.min(F.struct("doc_id", "seal")).alias("kept"))
    judged = rows.join(kept, "label").select(
        F.col("doc_id").alias(key), "seal", "often", (F.struct("doc_id", "seal") == F.col("kept")).alias("stays")
    )
    touched = written(judged.filter("NOT stays OR often > 1"), "touched")
    maybe, rest = parted(docs, touched, key)
    # The row as a struct: its columns cannot clash with those needed here.
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    told = touched.select(F.col(key).alias("doc_id"), "seal", "stays")
    met = maybe.select(whole, F.col(key).alias("doc_id"), F.xxhash64(text).alias("seal")).join(told, ["doc_id", "seal"], "left")
    alone = met.filter("stays IS NULL").select("row.*")
    repeated = met.filter("stays").withColumn("at", F.row_number().over(W.partitionBy("doc_id", "seal").orderBy("seal")))
    return rest.unionByName(alone).unionByName(repeated.filter("at = 1").select("row.*"))


# All pairs that share a run, counted whole, and what links reach.
OP6 = r"""
with recursive told as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
runs as (
  select distinct doc_id, case when len(words) >= 5 then array_to_string(words[i + 1:i + 5], ' ') else array_to_string(words, ' ') end as run
  from (select doc_id, words, unnest(range(greatest(1, len(words) - 4))) as i from told where len(words) > 0)),
sizes as (select doc_id, count(*) as n from runs group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from runs a join runs b on a.run = b.run and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (
  select a, b from pairs join sizes na on na.doc_id = a join sizes nb on nb.doc_id = b where 100 * shared >= 80 * (na.n + nb.n - shared)),
edges as (select a, b from links union all select b, a from links),
reached as (select a as doc_id, b as other from edges union select r.doc_id, e.b from reached r join edges e on e.a = r.other)
select t.doc_id, coalesce(any_value(s.n), 0) as n_shingles, least(t.doc_id, coalesce(min(r.other), t.doc_id)) as component_id
from told t left join sizes s using (doc_id) left join reached r using (doc_id) group by t.doc_id
"""


@query("op6_jaccard", OP6)
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by their distinct five-word runs."""
    return jaccard_components(table(spark, sf_dir, "documents"))
