"""Ranked search against plain scoring of everything."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import lowered
from compare import connect, differences
from pyspark.sql import functions as F

from patloom.llm import ORACLES, QUERIES, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, best=10):
    """{item: [(id, score)]}"""
    held = [(key, Counter(TERM.findall(lowered(text)))) for key, text in docs]
    held = [(key, terms, sum(terms.values())) for key, terms in held if terms]
    n, total = len(held), sum(size for *_, size in held)
    df = Counter(term for _, terms, _ in held for term in terms)
    out = {}
    for item, text in items:
        scores = []
        for key, terms, size in held:
            m = 100 - 75 + (75 * size * n) // total
            score = 0
            for term, times in Counter(TERM.findall(lowered(text))).items():
                if term in terms:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1_000_000_000 * terms[term]) // (1000 * terms[term] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key if key is not None else 0))
        out[item] = [(None if none else key, -score) for score, none, key in sorted(scores)[:best]]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "é", "中文", "ABC", "abc", "x1y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, rng.choice([" ", ". ", "-", "\x7f"]).join(rng.choices(words, weights, k=rng.randrange(1, 120)))) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(40)] + [(n + 50, ""), (n + 51, None), (n + 52, "...")]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (repr(r.item_id), r.rank)):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_of_small_segments_and_blocks(spark, monkeypatch, seed):
    for name, value in (("SEGMENT_POSTINGS", 800), ("BLOCK_DOCS", 3), ("SUMMARY_CELLS", 500), ("QUERY_BYTES", 2000)):
        monkeypatch.setattr(search, name, value)
    docs, rng = corpus(seed, 400), random.Random(seed + 10)
    items = [(i, " ".join(rng.choices(docs[rng.randrange(300)][1].split(), k=rng.randrange(1, 30)))) for i in range(60)]
    items += [(100, docs[0][1]), (101, ""), (102, None), (103, "nowhere"), (104, "w1 w1 w1 W1")]
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = search.ranked(given, spark.createDataFrame(items + items[:3], "item_id long, text string"))
    want = plain(docs, items)
    assert found(out) == {k: v for k, v in want.items() if v}


def test_blocks_are_skipped_only_where_nothing_is_lost(monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 4)
    docs = [d for d in corpus(3, 3000) if d[1]]
    items = [(i, docs[i * 37][1]) for i in range(30)]
    queries = search.Queries([i for i, _ in items], [t for _, t in items])
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs])], ["id", "text"])
    vectors = list(search._vectors(queries)([batch]))
    length, terms = vectors[0].column(1).to_numpy(), vectors[0].column(2).flatten().to_numpy()
    n, total = int((length > 0).sum()), int(length.sum())
    df = np.bincount(terms, minlength=len(queries.vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df])
    run = search.Search(queries, weights, 10)
    run.add(search.Segment(list(search._impacts(weights, n, total)(vectors)), len(weights)), 0)
    assert run.skipped > run.opened > 0
    want = plain(docs, items)
    assert {i: [(r[2], -r[0]) for r in rows] for i, rows in enumerate(run.found)} == want


def test_odd_rows_ties_and_empty_tables(spark, odd, nothing):
    docs = odd.withColumn("impacts", F.lit(1)).withColumn("lead", F.lit("x"))
    items = [(1, "same row of text"), (2, "long5 LONG6 long7 long7"), (3, "id no"), (4, None), (5, "another")]
    given = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash"))
    want = plain([(r.doc_id, r.text) for r in odd.collect()], items)
    assert found(search.ranked(docs, given)) == {k: v for k, v in want.items() if v}
    assert search.ranked(docs.limit(0), given).collect() == [] and search.ranked(docs, given.limit(0)).collect() == []


def test_one_text_everywhere_goes_by_id(spark):
    docs = spark.range(5000).select((4999 - F.col("id")).alias("doc_id"), F.lit("alpha beta gamma").alias("text")).unionByName(
        spark.range(6000, 11000).select(F.col("id").alias("doc_id"), F.lit("delta").alias("text"))
    )
    out = found(search.ranked(docs, spark.createDataFrame([(1, "beta delta"), (2, "alpha")], "item_id int, text string")))
    assert [i for i, _ in out[2]] == list(range(10)) and [i for i, _ in out[1]] == list(range(6000, 6010))


def test_op13_against_sql(spark, tables):
    assert differences(QUERIES["op13_search"](spark, tables), connect(tables), ORACLES["op13_search"]) == []
