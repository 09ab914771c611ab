"""US records: decoding, splitting, fields."""

import pytest
from pyspark.sql import functions as F

from patloom.functions.us import decode_text, parse_us, split_documents
from patloom.plans.us import unique_records
from patloom.schemas import US_RECORD

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE us-patent-grant SYSTEM "x.dtd" [ ]>\n'
BODY = """<us-patent-grant lang="EN" file="US1">
<us-bibliographic-data-grant>
<publication-reference><document-id><country>US</country><doc-number>D1</doc-number><kind>B2</kind><date>20240102</date></document-id></publication-reference>
<publication-reference><document-id><country>XX</country></document-id></publication-reference>
<application-reference><document-id><doc-number>17</doc-number><kind/></document-id></application-reference>
<classifications-cpc>
<classification-cpc><cpc-version-indicator><date>20130101</date></cpc-version-indicator><section>A</section><class>01</class><subclass>B</subclass><main-group>1</main-group><subgroup>02</subgroup></classification-cpc>
<classification-cpc><section>A</section><class>01</class><subclass>B</subclass><main-group>1</main-group></classification-cpc>
<classification-cpc><section>H</section><class>04</class><subclass>L</subclass><main-group>9</main-group><subgroup>00</subgroup></classification-cpc>
</classifications-cpc>
<invention-title id="t"> Cut here <i>italics</i> rest</invention-title>
<assignees><assignee><addressbook><orgname>Acme</orgname><address><city>Bonn</city><country>DE</country></address></addressbook></assignee>
<assignee><addressbook><last-name>Solo</last-name></addressbook></assignee>
<assignee><addressbook><orgname>Two</orgname><address><country>FR</country></address><address><city>Rome</city></address></addressbook></assignee></assignees>
<inventors><inventor><addressbook><last-name>Doe</last-name><first-name>J</first-name><address><city>Rome</city></address></addressbook></inventor></inventors>
</us-bibliographic-data-grant>
<abstract><p> An <b>x</b> end</p><p><b>y</b></p><p>last </p></abstract>
<description><p>One<b>bold</b>two\n\tthree</p><heading>no</heading><p>  four &lt;five&gt;</p></description>
</us-patent-grant>"""
BARE = "<us-patent-grant><us-bibliographic-data-grant/></us-patent-grant>"


def parse(spark, *documents):
    return parse_us(spark.createDataFrame(list(enumerate(documents)), "n int, xml string")).orderBy("n").collect()


def test_full_record(spark):
    row = parse(spark, HEAD + BODY)[0].asDict()
    expected = {
        "title": " Cut here ",
        "classifications": ["A01B 1/02", "H04L 9/00"],
        "classification_versions": ["20130101", None],
        "abstract_text": "An  last",
        "pub_ref_country": "US",
        "pub_ref_doc_number": "D1",
        "pub_ref_kind": "B2",
        "pub_ref_date": "20240102",
        "app_ref_country": None,
        "app_ref_doc_number": "17",
        "app_ref_kind": "",
        "app_ref_date": None,
        "assignees_orgnames": ["Acme", None, "Two"],
        "assignees_cities": ["Bonn", None, None],
        "assignees_countries": ["DE", None, "FR"],
        "inventors_last_names": ["Doe"],
        "inventors_first_names": ["J"],
        "inventors_cities": ["Rome"],
        "inventors_countries": [None],
        "description_text": "One bold two three four <five>",
    }
    assert set(expected) == set(US_RECORD.names)
    assert {name: row[name] for name in expected} == expected
    assert row["error"] is None


def test_absent_is_null_and_lists_are_empty(spark):
    row = parse(spark, HEAD + BARE)[0]
    for field in US_RECORD.fields:
        empty = {"array": [], "string": None}[field.dataType.typeName()]
        assert row[field.name] == ("" if field.name == "description_text" else empty), field.name


def test_malformed_between_good_ones(spark):
    broken = "<us-patent-grant><a></us-patent-grant>"
    text = "junk" + (HEAD + BODY) + "\n" + (HEAD + broken) + (HEAD + BARE)
    files = spark.createDataFrame([("e.xml", text)], "entry string, text string")
    rows = parse_us(split_documents(files)).orderBy("doc_pos").collect()
    assert [r["error"] is None for r in rows] == [True, False, True]
    assert rows[1]["bad_xml"].endswith(broken) and rows[1]["title"] is None


@pytest.mark.parametrize(
    "text, count",
    [
        ("", 0),
        (HEAD + BARE, 1),
        (HEAD + BARE + HEAD + BARE, 2),
        (BARE, 0),  # no declaration
        (HEAD + "<sequence-cwu>x</sequence-cwu>" + HEAD + BARE, 1),
        (HEAD + "<us-patent-application></us-patent-application>", 1),
        # a document that is not closed runs into the next, and the match has both
        (HEAD + "<us-patent-grant>open" + HEAD + BARE, 1),
    ],
)
def test_split(spark, text, count):
    files = spark.createDataFrame([("e.xml", text)], "entry string, text string")
    assert split_documents(files).count() == count


def test_decode(spark):
    rows = [("é".encode(),), ("é".encode("latin-1"),), (b"plain",)]
    got = spark.createDataFrame(rows, "content binary").select(decode_text(F.col("content"))).collect()
    assert [r[0] for r in got] == ["é", "é", "plain"]


def test_unique_per_archive_null_is_one_key_and_errors_stay(spark):
    rows = [
        ("a.zip", "e", 0, "1", None),
        ("a.zip", "e", 1, "1", None),
        ("b.zip", "e", 0, "1", None),
        ("a.zip", "e", 2, None, None),
        ("a.zip", "e", 3, None, None),
        ("a.zip", "e", 4, None, "bad"),
        ("a.zip", "e", 5, None, "bad"),
    ]
    df = spark.createDataFrame(rows, "archive string, entry string, doc_pos int, pub_ref_doc_number string, error string")
    kept = {(r["archive"], r["doc_pos"]) for r in unique_records(df).collect()}
    assert kept == {("a.zip", 0), ("b.zip", 0), ("a.zip", 2), ("a.zip", 4), ("a.zip", 5)}
    kept = {(r["archive"], r["doc_pos"]) for r in unique_records(df, keep_null_keys=True).collect()}
    assert kept == {("a.zip", 0), ("b.zip", 0), ("a.zip", 2), ("a.zip", 3), ("a.zip", 4), ("a.zip", 5)}
