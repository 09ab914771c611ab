"""Declared schemas: nothing is inferred from the data, an absent value is null."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _arrays(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.ArrayType(T.StringType(), containsNull=True)) for name in names]


# A listing of published files, as text.
LISTING = T.StructType(_strings("file_name", "published_at"))

# One XML entry of an archive. `error` is set, and `content` null, where it could not be read.
ENTRY = T.StructType(
    [
        *_strings("archive", "member", "entry"),
        T.StructField("content", T.BinaryType()),
        *_strings("error"),
    ]
)

# Where a document comes from; every record carries it.
ORIGIN = ("archive", "member", "entry", "doc_pos")

# The European record.
EP_RECORD = T.StructType(
    [
        *_strings("doc_id", "title_en", "title_de", "title_fr"),
        T.StructField("doc_number", T.LongType()),
        *_strings(
            "lang",
            "country",
            "abstract",
            "description",
            "claims",
            "ipc_classifications",
            "cpc_classifications",
            "international_application_number",
            "applicants",
            "inventors",
            "int_classifications",
            "date_publication",
            "year_publication",
            "date_filing",
            "year_filing",
            "priority_number",
            "priority_date",
            "representatives",
            "correction_code",
            "correction_description",
            "references_cited",
            "proprietors",
        ),
    ]
)

# ---- Fixed values: the columns of the European record that the insert keeps ----------------
EP_INSERT_COLUMNS = (
    "doc_id",
    "title_en",
    "title_de",
    "title_fr",
    "doc_number",
    "lang",
    "country",
    "abstract",
    "description",
    "claims",
    "ipc_classifications",
    "cpc_classifications",
    "international_application_number",
    "applicants",
    "inventors",
    "int_classifications",
    "date_publication",
    "date_filing",
)

# The US record.
US_RECORD = T.StructType(
    [
        *_strings("title"),
        *_arrays("classifications", "classification_versions"),
        *_strings("abstract_text"),
        *_strings(*(f"{ref}_{part}" for ref in ("pub_ref", "app_ref") for part in ("country", "doc_number", "kind", "date"))),
        *_arrays("assignees_orgnames", "assignees_cities", "assignees_countries"),
        *_arrays("inventors_last_names", "inventors_first_names", "inventors_cities", "inventors_countries"),
        *_strings("description_text"),
    ]
)

EMBEDDING_DIM = 1024
