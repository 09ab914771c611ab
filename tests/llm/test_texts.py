"""Encoding, licences, quality, fingerprints, archives."""

import hashlib
import random
import textwrap

import numpy as np
import pytest
import tiktoken
from compare import connect, differences
from pyspark.sql import functions as F

from patloom.llm import ORACLES, QUERIES, bpe, fingerprints, licences, quality, warc
from patloom.llm.bpe import decode_ids, encode_texts, round_trip

RANKS, PATTERN = bpe.public_vocabulary()


@pytest.fixture(scope="module")
def reference():
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_agrees_on_odd_texts(reference):
    tokens = bpe.read_ranks(RANKS)
    codec = bpe.Codec(tokens, *bpe.pair_table(tokens), PATTERN)
    rng = random.Random(1)
    chars = "ab 'sté\n\t\x1c\x85​中文🙂Ⅷ٣!?　é́'ll're \r"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", "a" * 5000, "ab" * 700, " " * 3000 + "x", "the" * 400, "!" * 2000]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert codec.decode(np.frombuffer(ids, "<u4")) == text.encode()


def test_op2_and_round_trip_of_odd_rows(spark, tables, odd, nothing, reference):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe"](spark, tables).collect():
        ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    back = decode_ids(encode_texts(odd, RANKS, PATTERN), RANKS, PATTERN)
    assert all(bytes(r.decoded) == (r.row.row.text or "").encode() for r in back.collect())
    assert round_trip(odd, RANKS, PATTERN, with_ids=True).filter("size(ids) != n_tokens").count() == 0
    assert round_trip(nothing, RANKS, PATTERN).collect() == []


def test_op8_finds_all_notices_and_no_others(spark, tables, odd, nothing):
    found = {r.doc_id for r in QUERIES["op8_licences"](spark, tables).collect()}
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert found == {r.doc_id for r in docs.filter(F.col("text").rlike("(?i)(licensed under|released under)")).collect()}
    assert licences.licence_notices(odd).collect() == [] and licences.licence_notices(nothing).collect() == []


def test_licences_of_embedded_notices(spark):
    rng = random.Random(2)
    filler = [" ".join(f"word{rng.randrange(900)}" for _ in range(30)) + "." for _ in range(40)]
    rows = [(i, text) for i, text in enumerate(filler)]
    rows += [(100, filler[0] + "\n" + licences.NOTICES["MIT"][2]), (101, filler[1] + " " + licences.NOTICES["GPL"][0]), (102, "The license of the public in general was granted.")]
    found = licences.licence_notices(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.family) for r in found) == [(100, "MIT"), (101, "GPL")]


def test_licences_of_wrapped_notices_and_at_any_place(spark):
    rows, want, rng = [], [], random.Random(4)
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            for form in (textwrap.fill(notice, 72, break_on_hyphens=False), textwrap.indent(textwrap.fill(notice, 60, break_on_hyphens=False), " * "), textwrap.fill(notice, 30, break_on_hyphens=False)):
                want.append((len(rows), family))
                rows.append((len(rows), "word0 word1.\n\n" + form + "\n\nword2 word3."))
    for notice, family in ((licences.NOTICES["MIT"][2], "MIT"), (licences.NOTICES["GPL"][1], "GPL"), (licences.NOTICES["ISC"][0], "ISC")):
        for before in range(48):
            want.append((len(rows), family))
            rows.append((len(rows), " ".join([*(f"word{rng.randrange(900)}" for _ in range(before)), notice, "word1 word2"])))
    both = len(rows)
    rows.append((both, licences.NOTICES["GPL"][1] + " " + licences.NOTICES["LGPL"][0] + "\n" + licences.NOTICES["MIT"][0] + " " + licences.NOTICES["MIT"][0]))
    want += [(both, "GPL"), (both, "LGPL"), (both, "MIT"), (both, "MIT")]
    found = licences.licence_notices(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.family) for r in found) == want


def test_op7_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op7_quality"](spark, sf).collect()}
    held = [(rows[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert len(held) > 50 and sum(r.predicted == q for r, q in held) >= 0.97 * len(held)


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (8, 0), (7, None), (99, 1), (None, 1)], "doc_id long, quality int")
    scores = quality.quality_scores(odd, labels).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality.accepted(odd, labels, threshold=0.0).count() == odd.count()
    assert quality.accepted(odd, labels).columns == odd.columns
    assert quality.quality_scores(nothing, labels).collect() == []
    assert quality.accepted(odd, labels.limit(0)).count() == odd.count()  # no label: the prior, one half


def edits(rows):
    """What the edited texts have to be, for rows with ids of their own."""
    rows = sorted(rows)
    for at, (key, text) in enumerate(rows):
        quarter, following = len(text) // 4, rows[(at + 1) % len(rows)][1]
        yield key, text[: len(text) - quarter] + following[:quarter]


def test_op3_edits_and_likeness(spark, tables):
    rows = {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, tables).collect()}
    docs = [(d.doc_id, d.text or "") for d in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    for key, edited in edits(docs):
        assert rows[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    same = {}
    for key, text in docs:
        assert same.setdefault(text, rows[key].fingerprint) == rows[key].fingerprint
    near = [r.near_edited > r.near_next for r in rows.values()]
    assert sum(near) > 0.9 * len(near)


def test_likeness_is_that_of_the_paragraph_sets():
    import pyarrow as pa

    from patloom.llm.words import Powers, byte_values

    rng = random.Random(3)
    lines = [f"line {i} of many" for i in range(4000)]
    texts = ["\n".join(rng.sample(lines, n)) for n in (0, 1, 1, 5, 40, 40, 3000, 3000, 2)]
    digests = fingerprints.paragraph_digests(pa.array(texts), byte_values(False), Powers())
    left, right = (np.array(x) for x in zip(*((i, j) for i in range(len(texts)) for j in range(len(texts)))))
    got = fingerprints.likeness(digests, fingerprints.sketch(digests), left, right)
    for i, j, value in zip(left, right, got):
        a, b = (set(texts[k].split("\n")) - {""} for k in (i, j))
        assert value == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


def test_fingerprints_of_odd_rows(spark, odd, nothing):
    rows = fingerprints.compared_with_edits(odd).collect()
    assert len(rows) == odd.count()
    of = {(r.doc_id, r.n_chars): r for r in rows}
    assert of[(3, 0)].fingerprint == of[(2, 0)].fingerprint and of[(2, 0)].near_next == 1.0
    plain = "Plain text of a few words. And more of it."
    first = of[(9, len(plain))]  # the last in order; the first one follows
    assert first.edited_sha256 == hashlib.sha256((plain[: len(plain) - len(plain) // 4] + plain[: len(plain) // 4]).encode()).hexdigest()
    assert fingerprints.compared_with_edits(nothing).collect() == []
    assert len(fingerprints.compared_with_edits(odd.filter("doc_id IS NULL")).collect()) == 2


def test_op4_against_sql(spark, tables):
    assert differences(QUERIES["op4_warc"](spark, tables), connect(tables), ORACLES["op4_warc"]) == []


def test_warc_of_odd_pages(spark, tmp_path):
    big = "<p>" + "x" * 200
    pages = [(1, "u", big), (2, None, big), (2, None, big), (3, "a\r\nWARC-Type: x", big), (None, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "é" * 49), (7, "u", "é" * 49), (8, "u", "y" * 2_000_000), (9, "u", "a\r\n\r\nb" * 40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({n: F.lit(n) for n in ("digest", "shard", "record", "refers_to", "n")}).repartition(3)
    path, index = str(tmp_path / "w"), str(tmp_path / "i")
    warc.write_archives(df, path, index, archive_bytes=1 << 20)
    got = warc.read_records(warc.read_index(spark, index)).collect()
    texts = {p[0]: p[2] or "" for p in pages}
    assert sorted(r.page_id or 0 for r in got) == sorted(p[0] or 0 for p in pages)
    for r in got:
        text = texts.get(r.page_id, big).encode()
        assert (r.digest, r.bytes) == (hashlib.sha256(text).hexdigest(), len(text))
        revisit = r.page_id in (2, 3, None)
        assert (r.record_type, r.refers_to) == (("revisit", 1) if revisit else ("response", None))
        assert (r.payload is None) if revisit else bytes(r.payload) == text
    one = warc.read_records(warc.read_index(spark, index).filter("page_id IN (4, 8)")).collect()
    assert sorted(r.page_id for r in one) == [4, 8]
    warc.write_archives(df.limit(0), str(tmp_path / "e"), str(tmp_path / "ei"))
    assert warc.read_records(warc.read_index(spark, str(tmp_path / "ei"))).collect() == []


def test_licences_that_look_like_others_and_short_ones(spark):
    rng = random.Random(6)
    filler = lambda: " ".join(f"word{rng.randrange(900)}" for _ in range(40))
    header = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    library = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License."
    older = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 1 of it, no other."
    told = [(header, {"GPL"}), (library, {"LGPL"}), (older, {"GPL"}), ("This code is available under the MIT license, see the LICENSE file.", {"MIT"}), ("Licensed under MIT.", {"MIT"}), ("Distributed under the GNU General Public License v2.0 or later.", {"GPL"}), ("This is free and unencumbered software released into the public domain.", {"Unlicense"}), ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at their site.", {"EPL"})]
    told += [("He was granted a license to marry, free of charge, to any person.", set()), ("The terms of the public, as published by the foundation.", set())]
    rows = [(i, f"{filler()}\n{textwrap.fill(text, 60)}\n{filler()}") for i, (text, _) in enumerate(told)]
    found = {}
    for r in licences.licence_notices(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    assert found.pop(2, {"GPL"}) == {"GPL"}  # a header of no known version may stay unknown, but is none of LGPL
    assert [found.get(i, set()) for i in range(len(told)) if i != 2] == [families for i, (_, families) in enumerate(told) if i != 2]
