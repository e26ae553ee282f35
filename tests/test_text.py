import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.templates import infoboxes, infoboxes_of, parts_of, strip_templates, strip_templates_of


def one(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("[[A]] and [[B|b]]", ["A", "B"]),
        ("[[A#s|x]]", ["A#s"]),
        ("[[A\nB]]", ["A\nB"]),
        ("[[Image:hill|left|[[Oak]]", ["Image:hill"]),
        ("[[]] [[|x]]", []),
        ("", []),
        (None, None),
    ],
)
def test_links(spark, text, want):
    assert one(spark, T.links, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("[[Category:A]][[Category:B|k]][[Category:A]]", ["A", "B", "A"]),
        ("[[Category:Lakes of\nthe North]]", ["Lakes of the North"]),
        ("[[category:A]]", []),
        ("[[Category: two  spaces ]]", ["two  spaces"]),
        ("[[Category:  ]]", []),
    ],
)
def test_categories(spark, text, want):
    assert one(spark, T.categories, text) == want


def test_images(spark):
    assert one(spark, T.images, "[[File:a.png|thumb|x]] [[image:b.jpg]] [[FILE:c.svg||]]") == ["a.png", "b.jpg", "c.svg"]


def test_external_links(spark):
    assert one(spark, T.external_links, "[https://a.b c] [http://x] https://bare [ftp://no]") == ["https://a.b", "http://x"]


def test_sections(spark):
    assert one(spark, T.sections, "x\n== A ==\n=== B c ===\n= no =\n==D==") == ["A", "B c", "D"]


def test_see_also(spark):
    text = "[[X]]\n== See also ==\n* [[Rust]]\n* [[ Python |p]]\n== References ==\n[[Y]]"
    assert one(spark, T.see_also_links, text) == ["Rust", "Python"]
    assert one(spark, T.see_also_links, "[[X]]") == []
    assert one(spark, T.links_before_see_also, text) == 1
    assert one(spark, T.links_before_see_also, "[[X]]") is None
    assert one(spark, T.see_also_start, "==  see ALSO==") == 1


def test_link_that_crosses_the_header(spark):
    assert one(spark, T.links_before_see_also, "[[A|b\n== See also ==\nc]] [[D]]") == 1
    assert one(spark, T.links_before_see_also, "[[A\n== See also ==\n]] [[D]]") == 1
    assert one(spark, T.links_before_see_also, "[[A] x\n== See also ==\n[[D]]") == 0


@pytest.mark.parametrize(("text", "want"), [("{{disambig}}", True), ("{{Disambiguation|x}}", True), ("{{Given name}}", True), ("{{disambigs}}", False), ("disambig", False), ("{{dab}}", True)])
def test_disambiguation(spark, text, want):
    assert one(spark, T.is_disambiguation, text) is want


@pytest.mark.parametrize(("x", "want"), [("Category:A", True), ("File:x", True), ("MediaWiki:x", True), ("Talk:x", False), (":Category:A", False), ("category:A", False), ("Categorya", False)])
def test_namespaces(spark, x, want):
    assert one(spark, T.is_namespace_link, x) is want


def test_small_functions(spark):
    assert one(spark, T.without_anchor, "A#b#c") == "A"
    assert one(spark, T.without_anchor, "#b") == ""
    assert one(spark, T.sanitized, "a  b") == "a  b"
    assert one(spark, T.sanitized, " a \r\n  b ") == "a b"
    assert one(spark, T.trimmed, "  a b \n") == "a b"
    assert one(spark, T.escaped, "a'b\\c") == "a\\'b\\\\c"
    assert [one(spark, T.format_size, n, "long") for n in (0, 1023, 1024, 1536, 1048576, 5 * 1024**3)] == ["0B", "1023B", "1.0K", "1.5K", "1.0M", "5.0G"]
    assert one(spark, T.format_number, 1234567, "long") == "1,234,567"
    assert [one(spark, T.is_shard_file, n) for n in ("nodes_000.csv", "nodes_00.csv", "_000.csv", "nodes_0000.csv", "nodes.csv")] == [True, False, False, False, False]


def test_page_type(spark):
    cases = [("x", 0, "t", "Redirect"), (None, 0, "File:t", "Article"), (None, 6, "t", "Special"), (None, None, "Category:t", "Special"), (None, None, "t", "Article")]
    df = spark.createDataFrame(cases, "r string, ns int, title string, want string")
    assert df.where(T.page_type(F.col("r"), F.col("ns"), F.col("title")) != F.col("want")).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [("a{{b}}c", "ac"), ("a{{b{{c}}d}}e", "ae"), ("{{a}}{{b}}", ""), ("a{b}c", "a{b}c"), ("a}}b", "a}}b"), ("a{{b", "a"), ("a {{é {{x}}", "a "), ("", "")],
)
def test_strip_templates(text, want):
    assert strip_templates(text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("{{Infobox a\n| k = v\n| e =\n}}", [("Infobox a", [("k", "v"), ("e", "")])]),
        ("{{infobox_b|d={{birth date|1|2}}|x=[[A|b]]}}", [("infobox_b", [("d", "{{birth date|1|2}}"), ("x", "[[A")])]),
        ("{{Infobox|k=v|k=w}}", [("Infobox", [("k", "v"), ("k", "w")])]),
        ("{{Infobox a|=v|no}}", [("Infobox a", [])]),
        ("{{Infoboxes a|k=v}}", []),
        ("{{Infobox\ta}}", []),
        ("{{Infobox a {{Infobox b|k=v}}", [("Infobox b", [("k", "v")])]),
        ("{{Infobox a|k={{Infobox b|q=1}}}}", [("Infobox a", [("k", "{{Infobox b|q=1}}")])]),
        ("{{Infobox", []),
        ("{{Infobox ü|ñ=é}}", [("Infobox ü", [("ñ", "é")])]),
    ],
)
def test_infoboxes(text, want):
    assert [(b["infobox_type"], [(f["key"], f["value"]) for f in b["fields"]]) for b in infoboxes(text)] == want


def test_lead(spark):
    assert one(spark, T.lead, " a \n\n b\n== H ==\nc") == "a\nb"
    assert one(spark, T.lead, "a") == "a"


def test_templates_by_pieces_of_a_batch(spark):
    """A batch of many texts gives the functions' own results, a piece at a time, with memory that does not follow the batch."""
    texts = [None, "", "{{unclosed", "é{{Infobox a|k = {{n|1}}|v=}}" * 3 + "b", "x" * 1_500_000 + "{{t}}y"] + [f"{{{{Infobox d|n = {i}}}}}é" + "lead " * 600 for i in range(5000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    text = F.col("text")
    got = df.select("id", strip_templates_of(text).alias("s"), infoboxes_of(text).alias("b"), parts_of(text).alias("p")).collect()
    assert [r.id for r in got] == list(range(len(texts)))
    for t, r in zip(texts, got, strict=True):
        want = (None, None) if t is None else (strip_templates(t), infoboxes(t))
        assert (r.s, None if r.b is None else [x.asDict(True) for x in r.b]) == want
        assert (r.p.stripped, r.p.infoboxes) == (r.s, r.b)
    batch = pa.array([texts[-1]] * 10_000)
    for f in (parts_of, infoboxes_of, strip_templates_of):
        rows = 0
        tracemalloc.start()
        for out in f.func(iter([batch])):
            rows += len(out)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(batch) and peak < 8 << 20, peak
