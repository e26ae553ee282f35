"""Malformed pages and failing reads of a multistream dump."""

import bz2
import os

import pytest

from loomgraph.sources import dump

PAGE = "<page><title>T{0}</title><ns>0</ns><id>{0}</id><revision><timestamp>t</timestamp><text>x &lt;page&gt; &lt;/page&gt; {0}</text></revision></page>\n"


def ids(xml):
    return [p[0] for p in dump.parse_pages(xml.encode())]


@pytest.mark.parametrize("bad", [PAGE.format(2).replace("<ns>", "<ns").replace("x &lt;", "x & <"), PAGE.format(2).replace("</page>", "")])
def test_malformed_page_is_left_out_alone(bad):
    assert ids(PAGE.format(1) + bad + PAGE.format(3)) == [1, 3]
    assert ids(PAGE.format(1) + PAGE.format(3) + bad) == [1, 3]


def test_namespace_that_is_no_number():
    assert [p[:3] for p in dump.parse_pages(PAGE.format(2).replace("<ns>0", "<ns>zero").encode())] == [(2, "T2", None)]


def test_pages_with_root_and_escaped_tags():
    got = list(dump.parse_pages(("<mediawiki xmlns='u'><siteinfo/>" + PAGE.format(1) + PAGE.format(2) + "</mediawiki>").encode()))
    assert got == [(i, f"T{i}", 0, None, "t", f"x <page> </page> {i}") for i in (1, 2)]


@pytest.fixture
def multistream(tmp_path):
    streams = [bz2.compress((PAGE.format(1) + PAGE.format(2).replace("</title>", "") + PAGE.format(3)).encode()), b"no bz2 at all", bz2.compress(PAGE.format(4).encode())]
    path, index = tmp_path / "w-multistream.xml.bz2", tmp_path / "index.txt"
    path.write_bytes(b"".join(streams))
    at = [0, len(streams[0]), len(streams[0]) + len(streams[1])]
    index.write_text("".join(f"{a}:{i}:t\n" for i, a in enumerate([*at, 10**9])))
    return str(path), str(index)


def test_multistream_with_malformed_page_and_stream(spark, multistream):
    assert sorted(r.id for r in dump.read_multistream(spark, *multistream).collect()) == [1, 3, 4]


def test_what_is_left_out_is_told(spark, multistream):
    got = dump.read_multistream(spark, *multistream, problems=True).collect()
    assert sorted((r.id, r.problem) for r in got if r.id) == [(1, None), (3, None), (4, None)]
    assert sorted(r.problem for r in got if r.problem) == ["page", "stream"]


def test_index_lines_and_pages_without_an_end(spark, tmp_path):
    packed = bz2.compress((PAGE.format(1) + PAGE.format(2).replace("</page>", "")).encode())
    (tmp_path / "d.xml.bz2").write_bytes(packed)
    (tmp_path / "i.txt").write_text("0:1:a\nno line\nx:2:b\n0:2:c\n")
    got = dump.read_multistream(spark, str(tmp_path / "d.xml.bz2"), str(tmp_path / "i.txt"), problems=True).collect()
    assert sorted(str(r.problem) for r in got) == ["None", "index line", "index line", "page"]


def test_xml_source_tells_malformed_pages(spark, tmp_path):
    (tmp_path / "w.xml").write_text("<mediawiki>" + PAGE.format(1) + PAGE.format(2).replace("<id>2</id>", "<id>x</id>") + PAGE.format(3) + "</mediawiki>")
    got = dump.read_xml(spark, str(tmp_path / "w.xml"), problems=True).collect()
    assert sorted((r.id or 0, r.problem or "") for r in got) == [(0, "page"), (1, ""), (3, "")]
    assert dump.read_xml(spark, str(tmp_path / "w.xml"), with_timestamp=False).where("timestamp is not null").count() == 0


ODD = [(1, 1, "A & <B>", 0, None, "t", " x\r\ny ]]> &amp; "), (2, 2, "Ünï \"q\"", None, "To \"it\" & <b>", None, None), (3, 4294967295, "c", -1, None, None, "bad \x01 char"), (4, 7, "d", 14, None, "t", "")]


def test_multistream_round_trip(spark, tmp_path):
    more = [(10 + i, 10 + i, f"T{i}", 0, None, "t", "é" * i) for i in range(250)]
    pages = spark.createDataFrame(ODD + more, dump.PAGES).repartition(5)
    files = dump.write_multistream(pages, str(tmp_path / "out"), files=3, per_stream=20)
    assert len(files) == 3 and sum(f[2] for f in files) == 254
    assert all(dump.index_path(f[0]) == f[1] for f in files)
    got = dump.read_multistream(spark, [f[0] for f in files], [f[1] for f in files])
    want = [(1, "A & <B>", 0, None, "t", "x\r\ny ]]> &amp;"), (2, "Ünï \"q\"", None, "To \"it\" & <b>", None, None), (4294967295, "c", -1, None, None, "bad \ufffd char"), (7, "d", 14, None, "t", None)]
    want += [(i, t, n, r, s, x.strip() or None) for _, i, t, n, r, s, x in more]
    key = lambda r: r[0]
    assert sorted((tuple(r) for r in got.drop("pos").collect()), key=key) == sorted(want, key=key)
    order = [r.id for r in got.orderBy("pos").collect()]
    assert order == [r[1] for r in ODD + more]
    alone = dump.read_multistream(spark, *files[0][:2])
    assert alone.count() == files[0][2]


def test_storage_errors_fail_the_task(spark, multistream):
    """An index that names a stream in a file that is gone by the time it is read."""
    pages = dump.read_multistream(spark, *multistream)
    os.remove(multistream[0])
    with pytest.raises(Exception, match="No such file"):
        pages.collect()
