"""Text functions, chunks and vectors over the documents."""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import functions as F

from patloom.functions.embedding import with_embedding
from patloom.functions.lemmas import NOUN_ENDINGS, lemmatise, noun_lemmas
from patloom.functions.text import (
    ENGLISH_STOPWORDS,
    NO_TEXT,
    blank_separated,
    bpe_chunks,
    compose,
    drop_stopwords,
    explode_chunks,
    normalise,
    public_encoding,
    strip,
    token_list,
    with_chunks,
    words,
)
from patloom.functions.us import decode_text
from patloom.operators.pooling import or_zero
from patloom.plans.ep import embedded
from patloom.operators.rows import explode_once
from patloom.queries.registry import heavy, query, table

# Fragments of the SQL.
CLEAN = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_\s\p{{Z}}\x1c-\x1f\x{{85}}]', '', 'g')"
WORDS = "regexp_extract_all(" + CLEAN + r", '[\p{{L}}\p{{N}}_]+')"
STOP = "[" + ", ".join(f"'{word}'" for word in ENGLISH_STOPWORDS) + "]"
KEPT = f"list_filter({WORDS}, lambda x: NOT list_contains({STOP}, x))"
LETTERS = string.ascii_lowercase


def chunk_sql(tokens: str, source: str, size: int, step: int) -> str:
    """One row per chunk of the token lists that `source` has under `tokens`."""
    return f"""SELECT doc_id, (start // {step})::INT AS chunk_pos,
        array_to_string({tokens}[start + 1 : start + {size}], ' ') AS chunk_text
      FROM (SELECT doc_id, {tokens}, unnest(range(0, len({tokens}), {step})) AS start FROM ({source}))"""


@query("T1_words", f"SELECT doc_id, array_to_string({WORDS.format('text')}, ' ') AS words FROM documents")
def all_words(spark, sf_dir):
    joined = F.array_join(words(F.col("text")), " ")
    return heavy(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", joined.alias("words"))


@query(
    "T1_T2_normalise",
    f"""
    SELECT doc_id, coalesce(array_to_string({KEPT.format('given')}, ' '), '{NO_TEXT}') AS normal
    FROM (SELECT doc_id, CASE WHEN source <> 'src0' THEN text END AS given FROM documents)
    """,
)
def normalised(spark, sf_dir):
    given = F.when(F.col("source") != "src0", F.col("text"))
    documents = heavy(spark, sf_dir, "documents", "doc_id", "source", "text")
    return documents.select("doc_id", normalise(given).alias("normal"))


@query(
    "T1_strip",
    r"""
    SELECT doc_id, line, regexp_replace(line, '^\s+|\s+$', '', 'g') AS stripped FROM (
      SELECT doc_id, replace(chr(9) || source || ' ' || chr(10) || lang || chr(13) || chr(10), 'e', chr(10)) AS line
      FROM documents)
    """,
)
def stripped(spark, sf_dir):
    line = F.replace(F.concat(F.lit("\t"), "source", F.lit(" \n"), "lang", F.lit("\r\n")), F.lit("e"), F.lit("\n"))
    lines = table(spark, sf_dir, "documents").select("doc_id", line.alias("line"))
    return lines.withColumn("stripped", strip(F.col("line")))


RULES = ", ".join(f"('{old}', '{new}', {rank})" for rank, (old, new) in enumerate(NOUN_ENDINGS, 1))
LEMMAS = f"""
  rules(old, new, rank) AS (VALUES {RULES}),
  words AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS word FROM documents),
  nouns AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS word FROM benchmark),
  made(word, round, rank, form) AS (
    SELECT word, 0, 0, word FROM words
    UNION ALL
    SELECT word, round + 1, r.rank, form[1 : len(form) - len(old)] || new FROM made, rules r WHERE suffix(form, old)),
  lemmas AS (SELECT word, arg_min(form, (greatest(round, 1), len(form), rank)) AS lemma FROM made
    WHERE form IN (SELECT word FROM nouns) GROUP BY word)
"""


def _lemmas(spark, sf_dir):
    """Lemmas of all words of the documents, the words of the benchmark being the known nouns."""

    def distinct(name):
        texts = heavy(spark, sf_dir, name, "text")
        return explode_once(texts, [], words(F.col("text")), "pos", "word").select("word").distinct()

    return noun_lemmas(distinct("documents"), distinct("benchmark"))


@query("T3_noun_lemmas", f"WITH RECURSIVE {LEMMAS} SELECT word, lemma FROM lemmas")
def lemma_table(spark, sf_dir):
    return _lemmas(spark, sf_dir)


LEMMATISED = f"""WITH RECURSIVE {LEMMAS},
  tokens AS (SELECT doc_id, unnest(kept) AS word, unnest(range(len(kept))) AS pos
             FROM (SELECT doc_id, {KEPT.format('text')} AS kept FROM documents))
  SELECT d.doc_id, coalesce(string_agg(coalesce(lemma, t.word), ' ' ORDER BY pos), '') AS normal
  FROM documents d LEFT JOIN tokens t USING (doc_id) LEFT JOIN lemmas l ON l.word = t.word GROUP BY d.doc_id
"""


def _lemmatised(spark, sf_dir, **bounds):
    kept = drop_stopwords(words(F.col("text")))
    tokens = heavy(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", kept.alias("tokens"))
    swapped = lemmatise(tokens, "tokens", _lemmas(spark, sf_dir), ["doc_id"], **bounds)
    return swapped.select("doc_id", F.array_join("tokens", " ").alias("normal"))


@query("T3_lemmatise", LEMMATISED)
def lemmatised(spark, sf_dir):
    return _lemmatised(spark, sf_dir)


@query("T3_lemmatise_large_table", LEMMATISED)
def lemmatised_by_join(spark, sf_dir):
    """The way taken where the lemma table is too large to broadcast."""
    return _lemmatised(spark, sf_dir, broadcast_rows=0)


@query(
    "T4_compose",
    """
    SELECT doc_id, 'Title: ' || source || chr(10) || 'Abstract: ' || coalesce(nullif(lang, 'de'), '') || chr(10)
      || 'Description: ' || text || chr(10) || 'Applicants: ' || n_chars || chr(10) || 'Inventors: ' AS composed
    FROM documents
    """,
)
def composed(spark, sf_dir):
    fields = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("title_en"),
        F.nullif(F.col("lang"), F.lit("de")).alias("abstract"),
        F.col("text").alias("description"),
        F.col("n_chars").cast("string").alias("applicants"),
        F.lit(None).cast("string").alias("inventors"),
    )
    return fields.select("doc_id", compose().alias("composed"))


BLANKS = "list_filter(string_split(text, ' '), lambda x: x <> '')"


def normal_words(text):
    return token_list(drop_stopwords(words(text)))


def _chunked(spark, sf_dir, size, overlap):
    documents = heavy(spark, sf_dir, "documents", "doc_id", "text")
    chunked = with_chunks(documents, blank_separated(F.col("text")), size=size, overlap=overlap)
    return explode_chunks(chunked.drop("text"))


@query("T5_chunks", chunk_sql("w", f"SELECT doc_id, {BLANKS} AS w FROM documents", 2000, 1800))
def chunks(spark, sf_dir):
    return _chunked(spark, sf_dir, 2000, 200)


@query("T5_small_chunks", chunk_sql("w", f"SELECT doc_id, {BLANKS} AS w FROM documents", 200, 180))
def small_chunks(spark, sf_dir):
    return _chunked(spark, sf_dir, 200, 20)


@query("T1_T5_normalised_chunks", chunk_sql("w", f"SELECT doc_id, {KEPT.format('text')} AS w FROM documents", 2000, 1800))
def normalised_chunks(spark, sf_dir):
    documents = heavy(spark, sf_dir, "documents", "doc_id", "text")
    return explode_chunks(with_chunks(documents, normal_words(F.col("text"))).drop("text"))


@query("T5_token_chunks", "SELECT doc_id, text FROM documents")
def token_chunks(spark, sf_dir):
    """Chunks of 2,000 byte pair tokens, one behind the other: put together they are the text again."""
    documents = heavy(spark, sf_dir, "documents", "doc_id", "text")
    chunks = bpe_chunks(public_encoding, overlap=0)(F.col("text"))
    return documents.select("doc_id", F.array_join(chunks, "").alias("text"))


def letter_model():
    """A stand-in for a sentence model: how often each letter occurs in a text."""
    return lambda texts: np.array([[text.count(letter) for letter in LETTERS] for text in texts], dtype="float64")


def letters_sql(chunks_sql: str, documents: str = "documents") -> str:
    return f"""WITH chunks AS ({chunks_sql}), letters(pos, letter) AS (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(LETTERS))})
    SELECT d.doc_id, l.pos, round(coalesce(m.mean, 0), 6) AS mean FROM (SELECT doc_id FROM {documents}) d, letters l LEFT JOIN (
      SELECT doc_id, pos, avg(len(chunk_text) - len(replace(chunk_text, letter, ''))) AS mean FROM chunks, letters
      GROUP BY doc_id, pos) m ON m.doc_id = d.doc_id AND m.pos = l.pos"""


def by_position(df, vector="embedding"):
    return explode_once(df, ["doc_id"], vector, "pos", "mean").withColumn("mean", F.round("mean", 6))


@query(
    "T6_A3_embed_and_pool",
    letters_sql(chunk_sql("w", f"SELECT doc_id, {KEPT.format('text')} AS w FROM documents", 200, 180)),
)
def embed_and_pool(spark, sf_dir):
    documents = heavy(spark, sf_dir, "documents", "doc_id", "text")
    chunked = with_chunks(documents, normal_words(F.col("text")), size=200, overlap=20)
    return by_position(with_embedding(chunked, "chunks", letter_model, width=len(LETTERS)))


@query(
    "T4_T7_embed_records",
    letters_sql(
        chunk_sql(
            "w",
            f"""SELECT doc_id, {KEPT.format('composed')} AS w FROM (SELECT doc_id, 'Title: ' || source || chr(10) || 'Abstract: '
              || lang || chr(10) || 'Description: ' || text || chr(10) || 'Applicants: ' || chr(10) || 'Inventors: ' AS composed
              FROM documents)""",
            2000,
            1800,
        )
    ),
)
def embed_records(spark, sf_dir):
    nothing = F.lit(None).cast("string")
    records = heavy(spark, sf_dir, "documents", "doc_id", "source", "lang", "text").select(
        "doc_id",
        F.col("source").alias("title_en"),
        F.col("lang").alias("abstract"),
        F.col("text").alias("description"),
        nothing.alias("applicants"),
        nothing.alias("inventors"),
    )
    return by_position(embedded(records, letter_model, width=len(LETTERS)))


@query(
    "T7_zero_vector",
    """
    SELECT d.doc_id, len(coalesce(e.embedding, list_transform(range(1024), lambda x: 0::FLOAT))) AS width,
           CASE WHEN e.vec_id IS NULL THEN 0 ELSE round(e.embedding[1]::DOUBLE, 6) END AS first_value
    FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id
    """,
)
def zero_vector(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>"))
    joined = table(spark, sf_dir, "documents").select("doc_id").join(vectors, "doc_id", "left")
    filled = joined.select("doc_id", or_zero(F.col("embedding"), 1024).alias("vector"))
    width = F.size("vector").cast("bigint").alias("width")
    return filled.select("doc_id", width, F.round(F.col("vector")[0], 6).alias("first_value"))


@query(
    "S5_decode",
    r"SELECT doc_id, regexp_replace(text, '[^\x00-\x{ff}]', '?', 'g') AS text FROM documents",
)
def decoded(spark, sf_dir):
    text = F.regexp_replace("text", r"[^\x00-\xff]", "?")
    content = F.when(F.col("lang").isin("fr", "de"), F.encode(text, "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    encoded = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return encoded.select("doc_id", decode_text(F.col("content")).alias("text"))
