"""Batches read at once against the tree, on documents of any form, well-formed and not."""

import random

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_type
from test_xmlpull import MARKS, TEXTS, names

from patloom.functions import ep, us, xmlparse
from patloom.functions.xmlbatch import read_plain
from patloom.functions.xmlpull import Puller

PLAIN_TEXTS = ["", "x", "  y ", "&amp;lt;", "\n", "é ", "a > b", "&lt;p&gt;", "\x85"]
PROLOGS = ["", '<?xml version="1.0" encoding="UTF-8"?>', "<?xml version='1.0'?>\n<!DOCTYPE r SYSTEM \"x.dtd\" [ ]>\n", " ", "\n<!DOCTYPE r>"]


def document(rng, tags, texts, depth):
    out = []
    for _ in range(rng.randrange(5)):
        tag, mark, behind = rng.choice(tags), rng.choice(MARKS), rng.choice(texts)
        inside = document(rng, tags, texts, depth - 1) if depth else ""
        empty = f"<{tag}{mark}/>{behind}"
        out.append(empty if rng.random() < 0.1 else f"<{tag}{mark}>{rng.choice(texts)}{inside}</{tag}>{behind}")
    return "".join(out)


def some_document(rng, tags, texts):
    some = rng.sample(tags, min(len(tags), rng.choice([4, 8, 40])))
    xml = f'<root xmlns:b="u" id=" EP1 " doc-number="5">' if texts is TEXTS else "<root id=' EP1 ' doc-number=\"5\">"
    return f"{rng.choice(PROLOGS)}{xml}{document(rng, some, texts, rng.randrange(1, 7))}</root>{rng.choice(['', ' '])}"


def spoilt(rng, xml):
    """A document with a few characters taken out, doubled, or put in."""
    for _ in range(rng.randrange(1, 3)):
        at = rng.randrange(len(xml))
        xml = xml[:at] + rng.choice(["", xml[at] * 2, *"<>&/\"' =]\r\x01￾"]) + xml[at + rng.randrange(2) :]
    return xml


def read(picks, documents):
    """For each document its values, or None where it was not read with the others."""
    kinds = [to_arrow_type(pick.spark_type()) for pick in picks]
    got = read_plain(Puller(picks), documents, kinds)
    if got is None:
        return [None] * len(documents)
    columns = [column.to_pylist() for column in got[0]]
    assert all(column.type == kind for column, kind in zip(got[0], kinds))
    return [[column[i] for column in columns] if plain else None for i, plain in enumerate(got[1])]


def tree(picks, xml):
    values = xmlparse._tree_values(xml, picks)
    rows = [[name for name, _ in pick.parts] for pick in picks]
    return [[dict(zip(row, one)) for one in value] if row else value for row, value in zip(rows, values)]


@pytest.mark.parametrize("picks", [ep.EP_PICKS, us.US_PICKS])
@pytest.mark.parametrize("kind", [pa.string(), pa.binary()])
def test_same_values_as_the_tree(picks, kind):
    rng, tags, decided = random.Random(11), names(picks), 0
    plain_tags = [tag for tag in tags if ":" not in tag]
    for _ in range(25):
        made = [some_document(rng, plain_tags, PLAIN_TEXTS) for _ in range(30)]
        made += [spoilt(rng, rng.choice(made)) for _ in range(60)] + [some_document(rng, tags, TEXTS) for _ in range(10)] + [None, ""]
        rng.shuffle(made)
        documents = pa.array(["<r/>", *(x if x is None or kind == pa.string() else x.encode() for x in made)], kind)[1:]
        for xml, got in zip(documents.to_pylist(), read(picks, documents)):
            if got is not None:
                assert got == tree(picks, xml), xml
                decided += 1
    assert decided > 300


def test_plain_documents_are_not_read_one_by_one():
    """Those of the published form are all decided as a batch."""
    party = "<snm>A &amp; B</snm><adr><city>Paris</city><ctry>FR</ctry></adr>"
    xml = (
        '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE d SYSTEM "d.dtd" [ ]>\n<d id="EP1" doc-number="1" lang="en">'
        f"<B700><B710><B711>{party}</B711></B710><B740><B741>{party}</B741><B741><snm/></B741></B740></B700>"
        '<abstract id="x"><p>no</p></abstract><abstract id="abst"><p>one<b>cut</b></p><p/><p> two </p></abstract>'
        '<description id="desc"><heading>H</heading><p>a<i>b</i>c<p>d</p></p><ul><li>e</li></ul></description></d>'
    )
    for got in read(ep.EP_PICKS, pa.array([xml] * 3)):
        value = dict(zip((pick.name for pick in ep.EP_PICKS), got))
        assert value["id"] == "EP1" and value["applicants"] == ["A & B"] and value["proprietors"] == [] and value["claims"] is None
        assert value["representatives"] == [
            {"name": "A & B", "city": "Paris", "country": "FR"},
            {"name": "", "city": None, "country": None},
        ]
        assert value["abstract"] == ["one", "two"] and value["description"] == ["H", "abcd", "d", "e", "e"]


@pytest.mark.parametrize(
    "content",
    [b"<d>\xff</d>", b"<d>\xc3", b"\xa9</d>", b"\xef\xbb\xbf<d/>", b"<d>\xed\xa0\x80</d>", b'<?xml version="1.0" encoding="latin-1"?><d>\xe9</d>'],
)
def test_bytes_of_other_encodings_are_not_decided(content):
    got = read(ep.EP_PICKS, pa.array([b"<d>a</d>", content, b"<d>b</d>"]))
    assert [one is None for one in got] == [False, True, False]


def test_odd_rows_keep_their_places(spark):
    made = ["<d id='1'/>", "<d", "<d id='3'><!--c--></d>", None, "<d id='5'>\r</d>", "<d id='6'/>"]
    df = spark.createDataFrame(list(enumerate(made)), "i int, xml string").coalesce(1)
    got = {row.i: row.x for row in df.select("i", xmlparse.xml_struct(ep.EP_PICKS)("xml").alias("x")).collect()}
    assert [got[i].id for i in range(6)] == ["1", None, "3", None, "5", "6"]
    assert [got[i].error is None for i in range(6)] == [True, False, True, False, True, True]


@pytest.mark.parametrize("made", [[], [""], [None, ""], ["<d"], ["x"], ["<?xml?>"], ["<d></e>", "<d>"], ["<d/><d/>"], ["<d/>x"], ["</d><d>"]])
def test_batches_without_a_plain_document(made):
    assert read(us.US_PICKS, pa.array(made, pa.string())) == [None] * len(made)
