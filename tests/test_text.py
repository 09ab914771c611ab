"""Text functions against plain Python on chosen and on drawn texts."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patloom.functions import text as t
from patloom.functions.lemmas import lemmatise, noun_lemmas


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    return [row[0] for row in df.orderBy("n").select(make(F.col("v"))).collect()]


def test_strip(spark):
    values = ["  a b ", "\t\n a  ", "", " \r\n", "\x1c\x85a\x1f", "a"]
    assert column(spark, values, t.strip) == [value.strip() for value in values]


def python_words(text):
    return re.findall(r"\b\w+\b", re.sub(r"[^\w\s]", "", text.lower()))


TEXTS = ["Don't stop-me now!", "a_b 1.5 x y z", "É çà ß", "", "  ", "...", "one\ntwo\tthree\x85four\x1cfive", "(A) [b] {c}"]


def test_words(spark):
    assert column(spark, TEXTS, t.words) == [python_words(text) for text in TEXTS]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs", "Mn", "Mc"], exclude_characters="İ")), min_size=50, max_size=50))
def test_words_drawn(spark, texts):
    assert column(spark, texts, t.words) == [python_words(text) for text in texts]


def test_normalise(spark):
    got = column(spark, ["The dogs don't bark at THE moon", None, "", "the a an"], t.normalise)
    assert got == ["dogs dont bark moon", "No text provided", "", ""]


def test_own_stopwords(spark):
    assert column(spark, ["a b c a"], lambda v: t.normalise(v, ["a"])) == ["b c"]
    assert column(spark, ["a b c a"], lambda v: t.normalise(v, [])) == ["a b c a"]


def test_stopwords_are_looked_up_by_hash(spark):
    df = spark.createDataFrame([("a",)], "v string").select(t.normalise(F.col("v")))
    assert "INSET" in df._jdf.queryExecution().optimizedPlan().toString()


def test_compose(spark):
    df = spark.createDataFrame([("T", None, "D", "A", "")], "title_en string, abstract string, description string, applicants string, inventors string")
    assert df.select(t.compose()).first()[0] == "Title: T\nAbstract: \nDescription: D\nApplicants: A\nInventors: "


@pytest.mark.parametrize("size, overlap", [(2000, 200), (10, 3), (1, 0), (5, 4)])
def test_chunks(spark, size, overlap):
    lengths = [0, 1, 4, 5, 6, 9, 10, 11, 17, 1799, 1800, 1801, 2000, 2001, 5000]
    if size < 5:
        lengths = lengths[:9]
    lists = [[str(i) for i in range(length)] for length in lengths]
    df = spark.createDataFrame(list(enumerate(lists)), "n int, v array<string>")
    got = [row[0] for row in t.with_chunks(df, F.col("v"), size=size, overlap=overlap).orderBy("n").select("chunks").collect()]
    step = size - overlap
    assert got == [[" ".join(words[at : at + size]) for at in range(0, len(words), step)] for words in lists]


def test_chunk_size_is_checked():
    with pytest.raises(ValueError):
        t.chunk_tokens(None, 10, 10)
    with pytest.raises(ValueError):
        t.bpe_chunks(lambda: None, 10, 10)


def test_array_is_computed_once_before_an_explode(spark, tables):
    import __spark_entry__ as registered

    plan = registered.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_bpe_chunks(spark):
    tiktoken = pytest.importorskip("tiktoken")

    def load():
        ranks = {bytes([i]): i for i in range(256)}
        ranks.update({b"th": 256, b"the": 257})
        return tiktoken.Encoding("small", pat_str=r"\w+|\s+|[^\w\s]+", mergeable_ranks=ranks, special_tokens={})

    text = "the other there, the end"
    encoding = load()
    tokens = encoding.encode(text)
    expected = [encoding.decode(tokens[at : at + 5]) for at in range(0, len(tokens), 3)]
    assert column(spark, [text, "", None], t.bpe_chunks(load, size=5, overlap=2)) == [expected, [], []]


NOUNS = ["dog", "church", "wolf", "man", "city", "glass", "box", "quiz", "boss", "bos", "wa", "bush", "ssd", "s"]


def lemma_of(words, exceptions=()):
    """The public noun rules in plain Python."""
    from patloom.functions.lemmas import NOUN_ENDINGS

    def rules(forms):
        return [form[: -len(old)] + new for form in forms for old, new in NOUN_ENDINGS if form.endswith(old)]

    found = {}
    irregular = {}
    for word, lemma in exceptions:
        irregular.setdefault(word, []).append(lemma)
    for word in words:
        if word in irregular:
            hits = [form for form in [word, *irregular[word]] if form in NOUNS]
        else:
            forms = rules([word])
            hits = [form for form in [word, *forms] if form in NOUNS]
            while not hits and forms:
                forms = rules(forms)
                hits = [form for form in forms if form in NOUNS]
        if hits:
            found[word] = min(hits, key=len)
    return found


def test_noun_lemmas(spark):
    words = "dogs dog churches wolves men women cities glasses boxes quizzes boss was bushes glassesses xyz dogss geese oxen s ss".split()
    exceptions = [("geese", "dog"), ("oxen", "ox"), ("men", "boss")]
    df = spark.createDataFrame([(word,) for word in words], "word string")
    nouns = spark.createDataFrame([(word,) for word in NOUNS], "word string")
    assert {tuple(r) for r in noun_lemmas(df, nouns).collect()} == set(lemma_of(words).items())
    irregular = spark.createDataFrame(exceptions, "word string, lemma string")
    assert {tuple(r) for r in noun_lemmas(df, nouns, irregular).collect()} == set(lemma_of(words, exceptions).items())


@pytest.mark.parametrize("bound", [10, 0])
def test_lemmatise_both_ways(spark, bound):
    rows = [(1, ["dogs", "run", "dogs"]), (2, []), (3, None), (4, ["x", None, "men"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("dogs", "dog"), ("men", "man"), ("run", "run")], "word string, lemma string")
    got = {r.id: r.tokens for r in lemmatise(df, "tokens", lemmas, ["id"], broadcast_rows=bound).collect()}
    assert got == {1: ["dog", "run", "dog"], 2: [], 3: None, 4: ["x", None, "man"]}
