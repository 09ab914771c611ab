"""Merkle manifests against a plain tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from patloom.llm import ORACLES, QUERIES, manifest
from patloom.llm.manifest import folded, proof_digest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        out += [("L", level[at - 1])] if at % 2 else [("R", x) for x in level[at + 1 : at + 2]] or [("R", "")]
        at //= 2
    return out


def plain(rows):
    """[(doc_id, leaf, subroot, root, steps)] of rows."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"], leaf(row)))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = levels([h for _, h in groups[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    return [
        (key, h, trees[lang][-1][0], top[-1][0], siblings(trees[lang], i) + siblings(top, g))
        for g, lang in enumerate(langs)
        for i, (key, h) in enumerate(groups[lang])
    ]


def fold(node, steps):
    for side, other in steps:
        node = sha(other, node) if side == "L" else sha(node, other)
    return node


def steps_of(row):
    return [("L", s.left) if s.left else ("R", s.right) for s in row.steps]


def check(df):
    rows = [r.asDict() for r in df.select(*COLUMNS).collect()]
    found = manifest.manifest(df).select("*", proof_digest(F.col("steps")).alias("proof"), folded(F.col("leaf"), F.col("steps")).alias("again")).collect()
    key = lambda r: (repr(r[0]), r[1], r[2], [list(s) for s in r[4]])
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, steps_of(r)) for r in found), key=key) == sorted(plain(rows), key=key)
    for r in found:
        assert r.again == r.root == fold(r.leaf, steps_of(r))
        assert r.proof == sha(*(s for _, s in steps_of(r)))


def rows_of(sizes, seed=1):
    rng, out = random.Random(seed), []
    for lang, n in sizes.items():
        out += [(rng.randrange(10**6), rng.choice(["web", "é", None, ""]), lang, rng.choice([None, 3, -1]), rng.choice(["a", "", None, "long " * 20])) for _ in range(n)]
    rng.shuffle(out)
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_several_rounds_of_small_blocks(spark, monkeypatch):
    for name, value in (("DIGIT", 2), ("DIGITS", 2), ("BLOCK", 16)):
        monkeypatch.setattr(manifest, name, value)
    check(spark.createDataFrame(rows_of({"en": 300, None: 17, "de": 16, "fr": 1, "": 2, "zz": 33, "é": 257}), SCHEMA).repartition(5))


@pytest.mark.parametrize("sizes", [{"en": 1}, {None: 2}, {"a": 5000}, {"a": 4096, "b": 4097}])
def test_sizes_at_the_borders(spark, sizes):
    check(spark.createDataFrame(rows_of(sizes), SCHEMA))


def test_odd_rows_and_one_key_everywhere(spark, odd, nothing):
    docs = odd.withColumn("source", F.lit(None).cast("string")).withColumn("steps", F.lit(1))
    check(docs)
    assert manifest.manifest(docs.limit(0)).collect() == []
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"), F.lit("t").alias("text"))
    check(same)


def test_carried_leaf_tells_what_was_changed(spark):
    rows = rows_of({"en": 40, "de": 3})
    df = spark.createDataFrame(rows, SCHEMA)
    out = manifest.manifest(df, carried=F.when(F.col("doc_id") % 2 == 0, F.lit("x" * 64))).collect()
    assert {r.doc_id for r in out if r.carried} == {r[0] for r in rows if r[0] % 2 == 0}


def test_op11_against_sql_and_plain(spark, tables):
    run = QUERIES["op11_manifest"](spark, tables)
    assert differences(run, connect(tables), ORACLES["op11_manifest"]) == []
    documents = [r.asDict() for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    by_id = {d["doc_id"]: d for d in documents}
    want = {key: (h, sub, root, steps) for key, h, sub, root, steps in plain(documents)}
    for r in run.collect():
        h, sub, root, steps = want[r.doc_id]
        bad = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        changed = leaf({**by_id[r.doc_id], "n_chars": by_id[r.doc_id]["n_chars"] + 1}) if bad else h
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (h, sub, root, sha(*(s for _, s in steps)))
        assert r.folded_root == fold(changed, steps) and r.verified is not bad
