"""The US patent record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patloom.functions.text import strip
from patloom.functions.xmlparse import Pick, xml_struct
from patloom.operators.rows import explode_once
from patloom.schemas import US_RECORD

# ---- Fixed values: where the published format keeps each field ---------------------------
_REFERENCE = (("country", "country"), ("doc_number", "doc-number"), ("kind", "kind"), ("date", "date"))
_PLACE = (("city", "address[1]/city"), ("country", "address[1]/country"))
_CPC = (
    ("section", "section"),
    ("class", "class"),
    ("subclass", "subclass"),
    ("main_group", "main-group"),
    ("subgroup", "subgroup"),
)
_VERSION = (("version", "cpc-version-indicator/date"),)
US_PICKS = (
    Pick("title", "first", ".//invention-title", strip=False),
    Pick("cpc", "rows", ".//classification-cpc", _CPC + _VERSION, strip=False),
    Pick("abstract", "texts", ".//p", within=".//abstract", strip=False),
    Pick("pub_ref", "rows", ".//publication-reference/document-id", _REFERENCE, strip=False),
    Pick("app_ref", "rows", ".//application-reference/document-id", _REFERENCE, strip=False),
    Pick("assignees", "rows", ".//assignee/addressbook", (("orgname", "orgname"), *_PLACE), strip=False),
    Pick(
        "inventors",
        "rows",
        ".//inventor/addressbook",
        (("last_name", "last-name"), ("first_name", "first-name"), *_PLACE),
        strip=False,
    ),
    Pick("description", "pieces", ".//description//p", strip=False),
)
CPC_FORMAT = "%s%s%s %s/%s"
# One document: declaration, DOCTYPE, a root named us-patent-…, up to the first such closing tag.
DOCUMENT = (
    r"(?s)(<\?xml[^>]+>\s*<!DOCTYPE[^>]+>\s*<us-patent-[a-z-]+[^>]*>.*?</us-patent-[a-z-]+>)"
)
# -------------------------------------------------------------------------------------------

_parse = xml_struct(US_PICKS)


def decode_text(content: Column) -> Column:
    """Bytes as UTF-8 or, where they are not valid UTF-8, as ISO-8859-1."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def split_documents(files: DataFrame, text: str = "text", out: str = "xml") -> DataFrame:
    """One row per patent document of a text that holds many, with its position."""
    kept = [name for name in files.columns if name != text]
    found = F.regexp_extract_all(F.col(text), F.lit(DOCUMENT), F.lit(1))
    return explode_once(files, kept, found, "doc_pos", out)


def full_cpc(entries: Column) -> Column:
    """CPC entries that have all five parts, each with its version."""

    def full(entry: Column) -> Column:
        present = F.lit(True)
        for part, _ in _CPC:
            present = present & entry[part].isNotNull()
        return present

    return F.filter(entries, full)


def format_cpc(entry: Column) -> Column:
    return F.format_string(CPC_FORMAT, *(entry[part] for part, _ in _CPC))


def one_line(text: Column) -> Column:
    """Newlines and tabs to blanks, runs of blanks to one, none at the ends."""
    return strip(F.regexp_replace(F.translate(text, "\n\t", "  "), " +", " "))


def _rules(x: Column) -> dict[str, Column]:
    cpc = full_cpc(x["cpc"])
    rules = {
        "title": x["title"],
        "classifications": F.transform(cpc, format_cpc),
        "classification_versions": F.transform(cpc, lambda entry: entry["version"]),
        "abstract_text": strip(F.array_join(x["abstract"], " ")),
        "description_text": one_line(F.array_join(x["description"], " ")),
    }
    for ref in ("pub_ref", "app_ref"):
        first = F.try_element_at(x[ref], F.lit(1))
        rules.update({f"{ref}_{part}": first[part] for part, _ in _REFERENCE})
    people = {
        "assignees": {"orgnames": "orgname", "cities": "city", "countries": "country"},
        "inventors": {"last_names": "last_name", "first_names": "first_name", "cities": "city", "countries": "country"},
    }
    for who, columns in people.items():
        rules.update({f"{who}_{column}": x[who][part] for column, part in columns.items()})
    return rules


def parse_us(raw: DataFrame, xml: str = "xml", keep_bad_xml: bool = True) -> DataFrame:
    """Parse a column of single US documents: the other columns, the record, and `error`.

    As `parse_ep`: a row with an error has no record but keeps its XML in `bad_xml`.
    """
    kept = [name for name in raw.columns if name not in (xml, "error")]
    earlier = F.col("error") if "error" in raw.columns else F.lit(None).cast("string")
    parsed = raw.select(*kept, F.col(xml).alias("__xml"), earlier.alias("__earlier"), _parse(F.col(xml)).alias("__x"))
    parsed = parsed.withColumn("error", F.coalesce("__earlier", F.col("__x.error")))
    good = F.col("error").isNull()
    rules = _rules(F.col("__x"))
    bad_xml = [F.when(~good, F.col("__xml")).alias("bad_xml")] if keep_bad_xml else []
    return parsed.select(
        *kept,
        *(F.when(good, rules[f.name]).cast(f.dataType).alias(f.name) for f in US_RECORD.fields),
        "error",
        *bad_xml,
    )
