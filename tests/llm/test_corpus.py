"""Near duplicates, repeats, leaks and the pipeline against brute force."""

import hashlib
import random

import brute
import numpy as np
import pytest
import tiktoken

import corpus_pipeline
from patloom.llm import QUERIES, bpe, jaccard, leaks, repeats
from patloom.llm.components import components


def texts_of(spark, tables):
    return [(d.doc_id, d.text) for d in spark.read.parquet(f"{tables}/documents.parquet").collect()]


def as_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (2000, 7)]
    want = {}
    for a, b in pairs:
        if a != b:
            one, two = want.get(a, {a}), want.get(b, {b})
            for x in one | two:
                want[x] = one | two
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: min(of) for x, of in want.items()}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_op6_on_the_table(spark, tables):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op6_jaccard"](spark, tables).collect()}
    assert got == brute.components(texts_of(spark, tables))


@pytest.mark.parametrize("pivots", [1, 4])
def test_jaccard_groups_of_edited_copies(spark, pivots, monkeypatch):
    monkeypatch.setattr(jaccard.class_links, "__defaults__", (pivots,))
    rows = brute.near_copies(pivots)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(as_table(spark, rows)).collect()}
    assert got == brute.components(rows)


def test_jaccard_of_odd_rows(spark, odd, nothing):
    found = jaccard.jaccard_components(odd).collect()
    assert len(found) == odd.count()
    of = {(r.doc_id, r.n_shingles): r.component_id for r in found}
    assert of[(6, 59_996)] == 5 if (6, 59_996) in of else of[(6, 977)] == 5
    assert of[(9, 6)] == 1 and of[(2, 0)] == 2 and of[(None, 1)] is None and of[(7, 1)] == 7
    assert jaccard.jaccard_components(nothing).collect() == []
    kept = jaccard.one_per_component(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 8]
    assert jaccard.one_per_component(nothing).collect() == []


def test_op1_on_the_table(spark, tables):
    got = {}
    for r in QUERIES["op1_repeats"](spark, tables).collect():
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    assert {key: sorted(spans) for key, spans in got.items()} == brute.repeats(texts_of(spark, tables))


def passages(seed):
    """Texts of few words, with passages around the least length shared at random places, also inside one text."""
    rng = random.Random(seed)
    shared = [brute.sentence(rng, n) for n in (48, 49, 50, 51, 60, 130)]
    rows = []
    for _ in range(60):
        parts = [brute.sentence(rng, rng.randrange(30)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append("  ".join(parts) if rng.random() < 0.5 else "\n".join(parts))
    return list(enumerate(rows + ["again " * 120, "again " * 70, rows[3], rows[3]]))


def test_repeats_of_passages_and_their_removal(spark):
    rows = passages(1)
    docs = as_table(spark, rows)
    spans = repeats.repeated_spans(docs)
    got = {}
    for r in spans.collect():
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    want = brute.repeats(rows)
    assert {key: sorted(of) for key, of in got.items()} == want
    left = {r.doc_id: r.text for r in repeats.without_spans(docs, spans).collect()}
    for key, text in rows:
        words = brute.WORD.findall(text)
        kept = [w for i, w in enumerate(words) if not any(a <= i < b for a, b in want.get(key, []))]
        assert brute.WORD.findall(left.get(key, "")) == kept
        assert key in want or left[key] == text
    assert set(left) == {key for key, text in rows if key not in want or sum(b - a for a, b in want[key]) < len(brute.WORD.findall(text))}


def test_repeats_of_odd_rows(spark, odd, nothing):
    spans = repeats.repeated_spans(odd)
    assert {(r.doc_id, r.end_word, r.first_doc_id) for r in spans.collect() if r.start_word == 0} == {(6, 60_000, 5)}
    left = repeats.without_spans(odd, spans)
    assert left.columns == odd.columns
    # The long text repeats itself: only its first round of words stays, and nothing of its copy.
    assert {r.doc_id: r.text for r in left.collect()}[5].split()[-1] == "long976"
    assert left.filter("doc_id = 6").count() == 0 and left.count() == odd.count() - 1
    assert repeats.repeated_spans(nothing).collect() == [] and repeats.without_spans(nothing, spans).collect() == []


def test_op10_finds_all_items(spark, tables):
    docs = [(key, " ".join(text.split()).lower()) for key, text in texts_of(spark, tables)]
    items = [(r.item_id, " ".join(r.text.split()).lower()) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    want = {(key, item) for item, told in items for key, text in docs if told in text}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op10_leaks"](spark, tables).collect()} == want and want


ITEM = "On Monday the farmer called Anna sold 12 kg of apples to Peter and then 30 kg of pears to Anna for 7 dollars each"


def test_leaks_with_other_slots(spark, odd, nothing):
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "too short"), (6, "a short item of six words")], "item_id long, text string")
    swapped = ITEM.replace("Anna", "Maria").replace("Peter", "Karl").replace("12 kg", "15 lb").replace("30 kg", "99 lb").replace("7", "8")
    rows = [
        (1, "Before it. " + ITEM + " And after."),
        (2, "Before it. " + swapped.upper().lower().replace("maria", "Maria").replace("karl", "Karl") + " And after."),
        (3, swapped),
        (4, ITEM.replace("Anna", "Maria", 1)),  # one name became two
        (5, "Nothing of the kind " * 20),
        (6, "Here is A SHORT, item of six WORDS!"),
        (None, ITEM),
    ]
    found = leaks.leaks(as_table(spark, rows), items).collect()
    assert sorted(((r.doc_id, r.item_id, r.kind) for r in found), key=repr) == sorted(
        [(1, 1, "exact"), (3, 1, "reparameterised"), (4, 1, "exact"), (6, 6, "exact"), (None, 1, "exact"), (2, 1, "reparameterised")], key=repr
    )
    assert leaks.leaks(odd, items).collect() == [] and leaks.leaks(nothing, items).collect() == []
    assert leaks.leaks(odd, items.limit(0)).collect() == []


def test_leaks_word_for_word_beside_another_slot_and_short_items(spark, tmp_path):
    item = "one day a farmer bought 3 cows and 3 goats from the old man who lived behind the hill with his three sons"
    docs = [(1, "It began so: " + item.replace("3 goats", "4 goats")), (2, "a zugzwang in chess"), (3, "who was napoleon? nobody knows")]
    items = [(1, item), (2, "Zugzwang"), (3, "Who was Napoleon?")]
    found = leaks.leaks(as_table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.kind) for r in found) == [(1, 1, "exact"), (2, 2, "short"), (3, 3, "short")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.decontamination(spark, as_table(spark, docs), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in left) == [2, 3]


def found_pairs(spark, docs, items):
    found = leaks.leaks(as_table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    return sorted((r.doc_id, r.item_id) for r in found)


def test_leaks_of_items_with_few_literal_words(spark):
    texts = ["Compute 12 + 34 * 56 - 78 / 90 and give the result", "Convert 5 km 300 m and 2 km 40 m to metres", "the members are Anna Peter Maria Karl Hugo Emma Paul Ida Otto Lena Max Eva Tom Kim Ben", "Who was Napoleon?", "Zugzwang"]
    docs = [(i, f"Some words before it. {text} Some words behind it.") for i, text in enumerate(texts)]
    docs += [(10, texts[0].replace("12", "13")), (11, "Who was Wellington?"), (12, "12 34 56 78 90"), (13, "")]
    assert found_pairs(spark, docs, list(enumerate(texts))) == [(i, i) for i in range(len(texts))]


def test_leaks_of_names_in_other_case_or_place(spark):
    what = "What is the capital of France and when was it founded?"
    long = "Last week Anna and Peter met Maria and Karl near Paris while Hugo and Emma took Paul and Ida to Rome with Otto"
    docs = [(1, what.lower()), (2, "Then he asked him " + what), (3, what.upper()), (4, long.lower()), (5, "Yes, " + long.upper()), (6, long), (7, what.replace("France", "Spain"))]
    assert found_pairs(spark, docs, [(1, what), (2, long)]) == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (7, 1)]


def test_leaks_with_slots_that_fall_together_and_runs_on_their_own(spark):
    sold = "the farmer sold 3 cows and 5 goats at the market and then went home"
    first = "one day the old farmer sold 3 cows at the market and then went home again to"
    rest = "his wife who was glad that 3 goats were still there behind the house by the river"
    gap = "where words stand that nobody else has ever put in this order until they came to"
    item = f"{first} {gap} {rest}"
    docs = [
        (1, sold.replace("3", "4").replace("5", "4")),  # two values became one
        (2, item.replace("3 goats", "4 goats").replace(gap, " ".join(f"new{'abcdefghijklmnop'[i]}" for i in range(len(gap.split()))))),
        (3, sold), (3, sold.replace("3", "8")), (3, sold.replace("5", "9")),  # texts of one id
        (None, sold.replace("3", "6")), (None, sold.replace("3", "7")),
    ]
    found = leaks.leaks(as_table(spark, docs), spark.createDataFrame([(1, sold), (2, item)], "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.kind) for r in found), key=repr) == sorted(
        [(1, 1, "reparameterised"), (2, 2, "reparameterised"), (3, 1, "exact"), *[(3, 1, "reparameterised"), (None, 1, "reparameterised")] * 2], key=repr
    )


def test_leaks_of_items_that_begin_alike(spark):
    stem = "Which of the many rivers of this part of the world is the longest one of all?"
    whole = stem + " (a) the first one (b) the second one (c) none of the two that were named"
    items = [(1, whole), (2, stem), (3, stem.upper()), (4, stem), (5, "Which of the")]
    assert found_pairs(spark, [(1, stem), (2, "He said: " + whole), (3, "none of it")], items) == [(d, i) for d in (1, 2) for i in (1, 2, 5)]


def test_pipeline_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    kept = corpus_pipeline.written(corpus_pipeline.quality(spark, docs, tables), "t")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id: r.text for r in kept.collect()}
    assert all(good[key] == texts[key] for key in good)
    assert sum((key in good) == bool(q) for key, q in labels.items()) >= 0.95 * len(labels)

    near = corpus_pipeline.written(corpus_pipeline.near_duplicates(spark, kept, tables), "t")
    want = {key: text for (key, (_, top)), text in ((item, good[item[0]]) for item in brute.components(list(good.items())).items()) if key == top}
    assert {r.doc_id: r.text for r in near.collect()} == want

    cut = corpus_pipeline.written(corpus_pipeline.repeats(spark, near, tables), "t")
    spans = brute.repeats(list(want.items()))
    left = {}
    for key, text in want.items():
        words = [w for i, w in enumerate(brute.WORD.findall(text)) if not any(a <= i < b for a, b in spans.get(key, []))]
        if words or not brute.WORD.findall(text):
            left[key] = words
    assert {r.doc_id: brute.WORD.findall(r.text) for r in cut.collect()} == left
    assert cut.filter("n_chars != char_length(text)").count() == 0 and cut.columns == docs.columns

    clean = corpus_pipeline.written(corpus_pipeline.decontamination(spark, cut, tables), "t")
    items = [" ".join(r.text.split()).lower() for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    have = {r.doc_id: r.text for r in cut.collect()}
    assert {r.doc_id for r in clean.collect()} == {key for key, text in have.items() if not any(item in " ".join(text.split()).lower() for item in items)}

    ranks, pattern = bpe.public_vocabulary()
    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(ranks))}, special_tokens={})
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, tables).collect()}
    assert set(rows) == {r.doc_id for r in clean.collect()}
    for key, row in rows.items():
        ids = coder.encode_ordinary(have[key])
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_decontamination_by_id_and_text(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, ITEM), (1, "A clean text of the same id."), (None, "It was " + ITEM), (None, "A clean text."), (None, None), (2, None), (3, "Clean.")]
    left = corpus_pipeline.decontamination(spark, as_table(spark, rows), str(tmp_path)).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([rows[1], *rows[3:]], key=repr)


def test_pipeline_of_odd_rows(spark, odd, nothing, tables):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, tables), "odd")
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).count() == docs.count()


def test_pairs_are_counted_once_and_half_of_the_fragments_rule_most_out(spark, monkeypatch):
    rng = random.Random(9)
    pool = [brute.sentence(rng, 12, 5000) for _ in range(40)]
    rows = [(i, " ".join(rng.sample(pool, 30))) for i in range(60)]  # alike, but none links
    sizes, plain = {"pairs": 0, "halves": 0}, jaccard.written

    def watched(df, name):
        table = plain(df, name)
        if name in sizes:
            sizes[name] += table.count()
        return table

    monkeypatch.setattr(jaccard, "written", watched)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(as_table(spark, rows)).collect()}
    assert got == {key: top for key, (_, top) in brute.components(rows).items()}
    assert 0 < sizes["pairs"] <= 60 * 59 // 2 and sizes["halves"] < sizes["pairs"] / 4
