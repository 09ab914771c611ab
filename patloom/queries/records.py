"""Records: XML built from the tables, split and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from patloom.functions.ep import parse_ep
from patloom.functions.us import parse_us, split_documents
from patloom.queries.build import US_HEAD, day, each, escaped, leaf, lines, tag
from patloom.queries.registry import heavy, query, table
from patloom.schemas import EP_RECORD, US_RECORD

TEXT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TEXTS = ("abstract", "description", "claims")


def _orders(spark, sf_dir):
    orders = heavy(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _party(name, *place):
    return tag("B741", leaf("snm", name), tag("adr", *place)) if name is not None else tag("B741", tag("adr", *place))


def ep_order_xml():
    """An order with its customer as a European document."""
    published, filed = day("o_orderdate"), F.date_format(F.date_sub(F.to_date("o_orderdate"), 30), "yyyyMMdd")
    name, segment, priority = F.col("c_name"), F.col("c_mktsegment"), F.col("o_orderpriority")
    nation, status = F.col("c_nationkey"), F.col("o_orderstatus")
    bibliography = tag(
        "SDOBI",
        tag(
            "B100",
            tag(
                "B150",
                leaf("B151", status),
                tag("B155", leaf("B1551", "de"), leaf("B1552", "nicht"), leaf("B1551", "en"), leaf("B1552", priority)),
            ),
        ),
        tag("B200", tag("B220", leaf("date", filed))),
        tag("B300", leaf("B310", nation), tag("B320", leaf("date", filed))),
        tag("B400", tag("B405", leaf("date", F.concat(F.lit(" "), published)))),
        tag(
            "B500",
            tag("B510", leaf("B511", status), leaf("B512", ""), leaf("B512", priority)),
            tag("B510EP", *(tag("classification-ipcr", leaf("text", part)) for part in (status, priority))),
            tag("B520EP", tag("classifications-cpc", tag("classification-cpc", leaf("text", segment)))),
            tag(
                "B540",
                *(leaf("B541", "en"), leaf("B542", name)),
                *(leaf("B541", "DE"), leaf("B542", segment)),
                *(leaf("B541", "de"), leaf("B542", priority)),
                leaf("B541", "fr"),
            ),
            tag("B560", *(tag("B561", leaf("text", part)) for part in (F.col("o_custkey"), name))),
        ),
        tag(
            "B700",
            tag("B710", tag("B711", leaf("snm", name)), tag("B711", leaf("snm", segment))),
            tag("B720", tag("B721", leaf("snm", name))),
            tag("B730", tag("B731", leaf("snm", name), tag("adr", leaf("city", segment), leaf("ctry", nation)))),
            tag("B740", _party(name, leaf("ctry", nation)), _party(None, leaf("city", segment))),
        ),
        tag("B800", tag("B860", tag("B861", tag("dnum", leaf("anum", F.col("o_custkey")))))),
    )
    lang = F.when(status == "P", "").otherwise(' lang="en"')
    number = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    root = F.concat(F.lit('<ep-patent-document id=" EP'), F.col("o_orderkey"), F.lit('" doc-number="'), number)
    return F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>'), root, F.lit('" country="EP"'), lang, F.lit(">"), bibliography, F.lit("</ep-patent-document>"))


@query(
    "X_bibliography",
    """
    SELECT 'EP' || o_orderkey AS doc_id, c_name AS title_en, o_orderpriority AS title_de, '' AS title_fr,
      o_orderkey AS doc_number, CASE WHEN o_orderstatus <> 'P' THEN 'en' END AS lang, 'EP' AS country,
      o_orderstatus || '; ' || o_orderpriority AS ipc_classifications, c_mktsegment AS cpc_classifications,
      o_custkey::VARCHAR AS international_application_number, c_name || '; ' || c_mktsegment AS applicants,
      c_name AS inventors, o_orderstatus || '; ' || o_orderpriority AS int_classifications,
      strftime(o_orderdate, '%Y%m%d') AS date_publication, strftime(o_orderdate, '%Y') AS year_publication,
      strftime(o_orderdate::DATE - 30, '%Y%m%d') AS date_filing, strftime(o_orderdate::DATE - 30, '%Y') AS year_filing,
      c_nationkey::VARCHAR AS priority_number, strftime(o_orderdate::DATE - 30, '%Y%m%d') AS priority_date,
      c_name || ', , ' || c_nationkey || '; ' || c_mktsegment AS representatives, o_orderstatus AS correction_code,
      o_orderpriority AS correction_description, o_custkey || '; ' || c_name AS references_cited,
      c_name || ', ' || c_mktsegment || ', ' || c_nationkey AS proprietors
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def ep_bibliography(spark, sf_dir):
    raw = _orders(spark, sf_dir).select(ep_order_xml().cast("binary").alias("content"))
    return parse_ep(raw, keep_bad_xml=False).select(*(name for name in EP_RECORD.names if name not in TEXTS))


def ep_document_xml():
    """A document as the texts of a European one: its lines as paragraphs, with markup and lists."""
    text = lines(F.col("text"))
    abstract = tag("abstract", each(text, lambda line: tag("p", escaped(line), "<b>cut</b> rest")), id="abst")
    items = tag("ul", leaf("li", F.col("source")), leaf("li", F.col("n_chars")))
    paragraphs = each(text, lambda line: tag("p", escaped(line), "<i>!</i>"))
    description = tag("description", leaf("heading", F.col("lang")), paragraphs, leaf("p", "\t"), items, id="desc")
    claims = each(text, lambda line: tag("claim", tag("claim-text", escaped(line), leaf("claim-text", F.col("lang")))))
    return tag(
        "ep-patent-document",
        tag("abstract", leaf("p", "another"), id="abst2"),
        abstract,
        description,
        tag("claims", claims, id="claims01"),
        id=F.concat(F.lit("EP"), "doc_id"),
        doc_number=F.col("doc_id"),
    )


# What the XML keeps of a text, and its lines.
KEPT = r"regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')"
LINES = f"string_split({KEPT}, chr(10))"
BLANK = r"[\s\p{Z}\x1c-\x1f\x{85}]"


def sql_strip(value: str) -> str:
    return f"regexp_replace({value}, '^{BLANK}+|{BLANK}+$', '', 'g')"


EP_TEXTS = f"""
    SELECT 'EP' || doc_id AS doc_id,
      array_to_string(list_transform(list_filter({LINES}, lambda x: x <> ''), lambda x: {sql_strip('x')}), ' ') AS abstract,
      lang || chr(10) || array_to_string(list_transform({LINES}, lambda x: {sql_strip("x || '!'")}), chr(10)) || chr(10)
        || source || n_chars || chr(10) || source || chr(10) || n_chars AS description,
      array_to_string(list_transform({LINES}, lambda x: CASE WHEN x = '' THEN lang ELSE {sql_strip('x')} || ' ' || lang END), ' ')
        AS claims
    FROM documents"""


@query("X_texts", EP_TEXTS)
def ep_texts(spark, sf_dir):
    raw = heavy(spark, sf_dir, "documents", *TEXT_COLUMNS).select(ep_document_xml().cast("binary").alias("content"))
    return parse_ep(raw, keep_bad_xml=False).select("doc_id", *TEXTS)


@query(
    "F3_quarantine",
    """
    SELECT doc_id, lang IN ('de', 'fr') AS is_bad,
      CASE lang WHEN 'de' THEN 'parse' WHEN 'fr' THEN 'not a document number: n' || doc_id END AS reason
    FROM documents
    """,
)
def quarantine(spark, sf_dir):
    number = F.when(F.col("lang") == "fr", F.concat(F.lit("n"), "key")).otherwise(F.col("key").cast("string"))
    closing = F.when(F.col("lang") == "de", "</x>").otherwise("</d>")
    xml = F.concat(F.lit('<d id="1" doc-number="'), number, F.lit('"><p>'), escaped(F.col("text")), F.lit("</p>"), closing)
    documents = heavy(spark, sf_dir, "documents", *TEXT_COLUMNS).withColumnRenamed("doc_id", "key")
    parsed = parse_ep(documents.select("key", xml.alias("content")), keep_bad_xml=False)
    error = F.col("error")
    return parsed.select(
        F.col("key").alias("doc_id"),
        error.isNotNull().alias("is_bad"),
        F.when(error.startswith("ParseError"), "parse").otherwise(error).alias("reason"),
    )


def _reference(name, *content):
    return tag(name, tag("document-id", *content))


def us_order_xml(kind: str):
    """An order with its customer as a US document of a kind."""
    segment, name, nation = F.col("c_mktsegment"), F.col("c_name"), F.col("c_nationkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    half = tag("classification-cpc", leaf("section", status), leaf("class", "01"))
    whole = tag(
        "classification-cpc",
        tag("cpc-version-indicator", leaf("date", day("o_orderdate"))),
        *(leaf("section", status), leaf("class", nation), leaf("subclass", "B")),
        *(leaf("main-group", F.col("o_custkey")), leaf("subgroup", "02")),
    )
    number = F.concat(F.lit(kind), "o_orderkey")
    return tag(
        "us-patent-grant",
        tag(
            "us-bibliographic-data-grant",
            _reference(
                "publication-reference",
                *(leaf("country", "US"), leaf("doc-number", number), leaf("kind", kind), leaf("date", day("o_orderdate"))),
            ),
            F.when(status == "P", "").otherwise(_reference("application-reference", leaf("doc-number", F.col("o_custkey")))),
            tag("classifications-cpc", half, whole),
            tag("invention-title", escaped(name), "<i>cut</i> rest", id="t"),
            tag(
                "assignees",
                tag("assignee", tag("addressbook", leaf("orgname", name), tag("address", leaf("city", segment)))),
                tag("assignee", tag("addressbook", leaf("last-name", "only"))),
            ),
            tag(
                "inventors",
                tag(
                    "inventor",
                    tag("addressbook", leaf("last-name", segment), leaf("first-name", kind), tag("address", leaf("country", nation))),
                ),
            ),
        ),
        tag("abstract", leaf("p", priority), tag("p", escaped(segment), "<b>x</b>"), leaf("p", "")),
        tag("description", leaf("p", name), tag("p", "a\n\t", leaf("b", priority), "  end")),
        lang="EN",
    )


def us_order_file():
    """A file of two documents of the order, with something else between them."""
    between = F.lit(US_HEAD + "<sequence-cwu>no patent</sequence-cwu>\n")
    return F.concat(F.lit(US_HEAD), us_order_xml("A1"), between, F.lit(US_HEAD), us_order_xml("B1"))


@query(
    "S6_split",
    """
    SELECT o_orderkey, pos::INT AS doc_pos, kind FROM orders, (VALUES (0, 'A1'), (1, 'B1')) AS t(pos, kind)
    """,
)
def split(spark, sf_dir):
    documents = split_documents(_orders(spark, sf_dir).select("o_orderkey", us_order_file().alias("text")))
    kind = F.regexp_extract("xml", "<kind>(.*?)</kind>", 1).alias("kind")
    return documents.select("o_orderkey", "doc_pos", kind)


def flat(name: str):
    """An array column as text: items joined by a bar, nulls as a dash."""
    return F.array_join(F.col(name), "|", "-").alias(name)


ARRAYS = [f.name for f in US_RECORD.fields if f.dataType.typeName() == "array"]


@query(
    "Y_bibliography",
    """
    SELECT o_orderkey, pos::INT AS doc_pos, c_name AS title,
      o_orderstatus || c_nationkey || 'B ' || o_custkey || '/02' AS classifications,
      strftime(o_orderdate, '%Y%m%d') AS classification_versions, o_orderpriority || ' ' || c_mktsegment AS abstract_text,
      'US' AS pub_ref_country, kind || o_orderkey AS pub_ref_doc_number, kind AS pub_ref_kind,
      strftime(o_orderdate, '%Y%m%d') AS pub_ref_date, CAST(NULL AS VARCHAR) AS app_ref_country,
      CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END AS app_ref_doc_number,
      CAST(NULL AS VARCHAR) AS app_ref_kind, CAST(NULL AS VARCHAR) AS app_ref_date,
      c_name || '|-' AS assignees_orgnames, c_mktsegment || '|-' AS assignees_cities, '-|-' AS assignees_countries,
      c_mktsegment AS inventors_last_names, kind AS inventors_first_names, '-' AS inventors_cities,
      c_nationkey::VARCHAR AS inventors_countries, c_name || ' a ' || o_orderpriority || ' end' AS description_text
    FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES (0, 'A1'), (1, 'B1')) AS t(pos, kind)
    """,
)
def us_bibliography(spark, sf_dir):
    documents = split_documents(_orders(spark, sf_dir).select("o_orderkey", us_order_file().alias("text")))
    records = parse_us(documents, keep_bad_xml=False)
    fields = [flat(name) if name in ARRAYS else F.col(name) for name in US_RECORD.names]
    return records.select("o_orderkey", "doc_pos", *fields)


def us_document_xml():
    """A document as the texts of a US one."""
    text = lines(F.col("text"))
    number = leaf("doc-number", F.col("doc_id"))
    return tag(
        "us-patent-grant",
        _reference("publication-reference", number, leaf("kind", F.col("source"))),
        tag("abstract", each(text, lambda line: tag("p", escaped(line), "<b>cut</b>"))),
        tag("description", each(text, lambda line: tag("p", escaped(line), "<b>in</b>\n\ttail"))),
        lang=F.col("lang"),
    )


US_TEXTS = f"""
    SELECT doc_id::VARCHAR AS pub_ref_doc_number, source AS pub_ref_kind,
      {sql_strip(f"array_to_string(list_filter({LINES}, lambda x: x <> ''), ' ')")} AS abstract_text,
      {sql_strip(rf"regexp_replace(translate(array_to_string(list_transform({LINES}, lambda x: CASE WHEN x = '' THEN '' ELSE x || ' ' END || 'in tail'), ' '), chr(9), ' '), ' +', ' ', 'g')")}
        AS description_text
    FROM documents"""


@query("Y_texts", US_TEXTS)
def us_texts(spark, sf_dir):
    text = F.concat(F.lit(US_HEAD), us_document_xml())
    documents = split_documents(heavy(spark, sf_dir, "documents", *TEXT_COLUMNS).select(text.alias("text")))
    return parse_us(documents, keep_bad_xml=False).select(
        "pub_ref_doc_number", "pub_ref_kind", "abstract_text", "description_text"
    )
