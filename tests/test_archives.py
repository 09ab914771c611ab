"""Archives, by path and by content."""

import pytest
from archives import tarred, zipped

from patloom.functions.us import decode_text, split_documents
from patloom.sources.archives import (
    explode_nested,
    list_files,
    read_flat,
    read_flat_documents,
    read_nested,
    spread_documents,
)
from patloom.sources.files import list_documents, read_documents
from pyspark.sql import functions as F

HEAD = '<?xml version="1.0"?>\n<!DOCTYPE us-patent-grant SYSTEM "x.dtd">\n'


@pytest.fixture(scope="module")
def nested(tmp_path_factory):
    folder = tmp_path_factory.mktemp("nested")
    inner1 = zipped({"a/EP1.xml": b"<a>1</a>", "TOC.xml": b"<toc/>", "x/MYTOC.xml": b"<toc/>", "p.pdf": b"%"})
    inner2 = zipped({"EP1.xml": b"<a>2</a>", "EP3.XML": b"<a/>"})
    with_doc = {"DOC/EPA/one.zip": inner1, "DOC/two.bin": inner2, "OTHER/three.zip": inner1, "DOC/loose.xml": b"<a/>"}
    (folder / "EPRTBJV2024000001001001.zip").write_bytes(zipped(with_doc))
    (folder / "EPRTBJV2024000002001001.tar").write_bytes(tarred({"./" + k: v for k, v in with_doc.items()}))
    (folder / "EPRTBJV2024000003001001.zip").write_bytes(zipped({"A/one.zip": inner1, "two.zip": inner2}))
    (folder / "EPRTBJV2024000004001001.zip").write_bytes(b"no zip at all")
    (folder / "EPRTBJV2024000005001001.tar").write_bytes(tarred({"DOC/bad.zip": inner1[:40] + b"\0" * 60 + inner1[100:]}))
    (folder / "notes.rar").write_bytes(b"?")
    return str(folder)


EXPECTED = {
    ("EPRTBJV2024000001001001.zip", "DOC/EPA/one.zip", "a/EP1.xml", b"<a>1</a>"),
    ("EPRTBJV2024000001001001.zip", "DOC/two.bin", "EP1.xml", b"<a>2</a>"),
    ("EPRTBJV2024000002001001.tar", "./DOC/EPA/one.zip", "a/EP1.xml", b"<a>1</a>"),
    ("EPRTBJV2024000002001001.tar", "./DOC/two.bin", "EP1.xml", b"<a>2</a>"),
    ("EPRTBJV2024000003001001.zip", "A/one.zip", "a/EP1.xml", b"<a>1</a>"),
    ("EPRTBJV2024000003001001.zip", "two.zip", "EP1.xml", b"<a>2</a>"),
}
BAD = {"EPRTBJV2024000004001001.zip", "EPRTBJV2024000005001001.tar", "notes.rar"}


def good(df):
    return {(r.archive, r.member, r.entry, bytes(r.content)) for r in df.collect() if not r.error}


def bad(df):
    return {r.archive for r in df.collect() if r.error}


def test_nested_by_path(spark, nested):
    df = read_nested(list_files(spark, nested))
    assert good(df) == EXPECTED
    assert bad(df) == BAD


def test_nested_by_content(spark, nested):
    df = explode_nested(spark.read.format("binaryFile").load(nested))
    assert good(df) == EXPECTED
    assert bad(df) == BAD


def test_without_doc_rule(spark, nested):
    df = read_nested(list_files(spark, nested, "*1001001.zip"), doc_rule=False)
    assert {r.member for r in df.collect()} == {"DOC/EPA/one.zip", "DOC/two.bin", "OTHER/three.zip"}


def test_listing_reads_no_bytes(spark, nested):
    plan = list_files(spark, nested)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_many_tasks_for_one_archive(spark, nested):
    df = read_nested(list_files(spark, nested, "*000001001001.zip"), tasks=7)
    assert df.rdd.getNumPartitions() == 7


@pytest.fixture(scope="module")
def flat(tmp_path_factory):
    folder = tmp_path_factory.mktemp("flat")
    doc = lambda n: HEAD + f"<us-patent-grant>{n}</us-patent-grant>\n"
    many = "".join(doc(n) + HEAD + "<sequence-cwu/>" for n in range(200))
    (folder / "ipg240102.zip").write_bytes(zipped({"one.xml": many, "sub/two.xml": doc(9), "r.txt": "x"}))
    latin = (doc("é") + doc("ü")).encode("latin-1")
    (folder / "ipg240109_r1.zip").write_bytes(zipped({"TOC.xml": doc("toc"), "l.xml": latin}))
    (folder / "ipg240116.zip").write_bytes(b"PK broken")
    return str(folder)


def test_flat(spark, flat):
    rows = read_flat(list_files(spark, flat)).collect()
    assert {(r.archive, r.entry) for r in rows if not r.error} == {
        ("ipg240102.zip", "one.xml"),
        ("ipg240109_r1.zip", "TOC.xml"),
        ("ipg240109_r1.zip", "l.xml"),
    }
    assert [r.archive for r in rows if r.error] == ["ipg240116.zip"]


def test_streamed_documents_equal_the_whole_text_split(spark, flat):
    files = list_files(spark, flat)
    whole = read_flat(files).filter("error is null").select("archive", "entry", decode_text(F.col("content")).alias("text"))
    expected = {tuple(r) for r in split_documents(whole).select("archive", "entry", "doc_pos", "xml").collect()}
    rows = spread_documents(read_flat_documents(files), archives=3, tasks=5).collect()
    assert {(r.archive, r.entry, r.doc_pos, r.xml) for r in rows if not r.error} == expected
    assert len(expected) == 203 and any("é" in r[3] for r in expected)
    assert [r.archive for r in rows if r.error] == ["ipg240116.zip"]


def test_streamed_split_at_every_block_edge(monkeypatch):
    import io
    import zipfile

    from patloom.sources import archives

    text = HEAD + "<us-patent-grant>é</us-patent-grant>" + HEAD + "<us-patent-grant>ü</us-patent-grant>"
    outer = zipfile.ZipFile(io.BytesIO(zipped({"a.xml": text})))
    plain = archives._text_blocks

    for width in range(1, 40):

        def blocks(outer, name, encoding, width=width):
            whole = "".join(plain(outer, name, encoding))
            return iter([whole[i : i + width] for i in range(0, len(whole), width)])

        monkeypatch.setattr(archives, "_text_blocks", blocks)
        assert [r["xml"][-24:-18] for r in archives._documents(outer, "a.xml")] == ["rant>é", "rant>ü"]


def test_xml_files(spark, tmp_path):
    (tmp_path / "w1").mkdir()
    for name in ("w1/a.xml", "w1/TOC.xml", "w1/b.XML", "c.xml", "d.txt", "aTOC.xml"):
        (tmp_path / name).write_bytes(name.encode())
    got = {(r.entry, bytes(r.content)) for r in read_documents(spark, str(tmp_path)).collect()}
    assert got == {("a.xml", b"w1/a.xml"), ("c.xml", b"c.xml")}
    assert list_documents(spark, str(tmp_path)).count() == 2
