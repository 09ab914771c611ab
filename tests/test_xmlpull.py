"""The one pass against the tree, on documents of any form."""

import random
import re

import pytest

from patloom.functions import ep, us, xmlparse
from patloom.functions.xmlpull import Puller, Unusual

TEXTS = ["", "x", "  y ", "&amp;", "<!--c-->z", "a<!--c-->b", "<![CDATA[<q>]]>", "\n", "é&#13;"]
MARKS = ["", ' id="abst"', ' id="desc"', ' id="claims01"', ' lang="x"']


def names(picks):
    paths = [x for p in picks for x in (p.path, p.within or "", *(sub for _, sub in p.parts))]
    return sorted({w for path in paths for w in re.findall(r"[A-Za-z][\w-]*", path.split("[@")[0])}) + ["other", "b:p"]


def document(rng, tags, depth):
    out = []
    for _ in range(rng.randrange(5)):
        tag = rng.choice(tags)
        inside = document(rng, tags, depth - 1) if depth else ""
        out.append(f"<{tag}{rng.choice(MARKS)}>{rng.choice(TEXTS)}{inside}</{tag}>{rng.choice(TEXTS)}")
    return "".join(out)


@pytest.mark.parametrize("picks", [ep.EP_PICKS, us.US_PICKS])
def test_same_values_as_the_tree(picks):
    rng, puller, tags, decided = random.Random(7), Puller(picks), names(picks), 0
    for i in range(6000):
        # Few names at a time, so that paths are met to their ends.
        some = rng.sample(tags, min(len(tags), rng.choice([4, 8, 40])))
        xml = f'<root xmlns:b="u" id=" EP{i} " doc-number="5">{document(rng, some, rng.randrange(1, 7))}</root>'
        want = xmlparse._tree_values(xml, picks)
        try:
            assert puller.read(xml) == want, xml
            decided += 1
        except Unusual:
            pass
    assert decided > 2500


def test_published_paths_are_decided():
    party = "<snm>A &amp; B</snm><adr><city>Paris</city><ctry>FR</ctry></adr>"
    xml = (
        '<d id="EP1" doc-number="1" lang="en"><B540><B541>de</B541><B542>Titel</B542><B541>en</B541><B542>Title</B542></B540>'
        f"<B700><B710><B711>{party}</B711></B710><B740><B741>{party}</B741><B741><snm/></B741></B740></B700>"
        '<abstract id="x"><p>no</p></abstract><abstract id="abst"><p>one<b>cut</b></p><p/><p> two </p></abstract>'
        '<description id="desc"><heading>H</heading><p>a<i>b</i>c<p>d</p></p><ul><li>e</li></ul></description></d>'
    )
    puller = Puller(ep.EP_PICKS)
    got = dict(zip((p.name for p in ep.EP_PICKS), puller.read(xml)))
    assert got["titles"] == [[["de", "en"], ["Titel", "Title"]]] and got["applicants"] == ["A & B"]
    assert got["representatives"] == [["A & B", "Paris", "FR"], ["", None, None]] and got["proprietors"] == []
    assert got["abstract"] == ["one", "two"] and got["claims"] is None
    assert got["description"] == ["H", "abcd", "d", "e", "e"]


@pytest.mark.parametrize("xml", ['<!DOCTYPE d SYSTEM "x"><d>&odd;</d>', "<d><B540><B540/></B540></d>"])
def test_what_is_unusual_is_left_to_the_tree(xml):
    with pytest.raises(Unusual):
        Puller(ep.EP_PICKS).read(xml)


def test_errors_read_as_before(spark):
    bad = ["<d", "", '<!DOCTYPE d SYSTEM "x"><d>&odd;</d>', b'<?xml version="1.0" encoding="nope"?><d/>'.decode()]
    df = spark.createDataFrame([(i, bytearray(x.encode())) for i, x in enumerate(bad)], "i int, content binary")
    parse = xmlparse.xml_struct(ep.EP_PICKS)
    got = {r.i: r.x for r in df.select("i", parse("content").alias("x")).collect()}
    assert [got[i].error.split(":")[0] for i in range(3)] == ["ParseError"] * 3 and got[3].error and got[0].titles is None
    assert "undefined entity" in got[2].error
