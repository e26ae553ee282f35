import bz2
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from loomgraph.operators import extract as E
from loomgraph.plans import cli, program
from loomgraph.sources import csv_tables, dump, store
from loomgraph.streaming.ingest import ingest, stream_pages

PAGE = "<page><title>{}</title><ns>{}</ns><id>{}</id>{}<revision><id>9{}</id><timestamp>2024-01-0{}T00:00:00Z</timestamp><text>{}</text></revision></page>"
LANG = """{{Infobox language
| name = Fern
| by = A B
}}
Fern is a language. See [[Moss (language)]] and [[D++|D]].

Made by [[Nobody]].

[[File:Fern.svg|thumb|Logo]] [https://fern.example Site]

== See also ==
* [[Moss (language)]]

== References ==
x

[[Category:Languages]]
[[Category:Plants &amp; such]]"""
ITEMS = [
    PAGE.format("Fern (language)", 0, 1, "", 1, 1, LANG),
    PAGE.format("Moss (language)", 0, 2, "", 2, 2, "Moss. See [[Fern]].\n\n[[Category:Languages]]"),
    PAGE.format("Fern", 0, 3, '<redirect title="Fern (language)" />', 3, 3, "#REDIRECT [[Fern (language)]]"),
    PAGE.format("File:Fern.svg", 6, 4, "", 4, 4, "A file"),
    PAGE.format("Category:Languages", 14, 5, "", 5, 5, ""),
]


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    base = tmp_path_factory.mktemp("dumps")
    (base / "wiki.xml.bz2").write_bytes(bz2.compress(f"<mediawiki>{''.join(ITEMS)}</mediawiki>".encode()))
    first, second = bz2.compress("".join(ITEMS[:2]).encode()), bz2.compress("".join(ITEMS[2:]).encode())
    (base / "w-multistream.xml.bz2").write_bytes(first + second)
    lines = f"0:1:Fern (language)\n0:2:Moss: x\nnot an index line\n{len(first)}:3:Fern\n{len(first)}:4:File:Fern.svg\n"
    (base / "w-multistream-index.txt.bz2").write_bytes(bz2.compress(lines.encode()))
    return base


def test_both_readers_agree(spark, dumps):
    a, b = dump.read_dump(spark, f"{dumps}/wiki.xml.bz2"), dump.read_dump(spark, f"{dumps}/w-multistream.xml.bz2")
    assert rows(a.drop("pos")) == rows(b.drop("pos"))
    got = {r.id: r for r in b.collect()}
    assert got[3].redirect_to == "Fern (language)"
    assert got[5].text is None
    assert got[1].text.startswith("{{Infobox")
    assert "Plants & such" in got[1].text


def test_reader_details(spark, dumps, tmp_path):
    with pytest.raises(FileNotFoundError):
        dump.read_dump(spark, f"{dumps}/none.xml")
    assert dump.index_path("a/x-multistream.xml.bz2", lambda p: p == "a/x-multistream-index.txt.bz2") == "a/x-multistream-index.txt.bz2"
    assert dump.index_path("x.xml.bz2", lambda p: True) is None
    assert dump.read_dump(spark, f"{dumps}/w-multistream.xml.bz2", with_text=False).where("text is not null").count() == 0
    assert list(dump.parse_pages(b"<page><title>A</title><id>x</id></page><page><title>B</title><id>2</id></page>")) == [(2, "B", None, None, None, None)]
    assert list(dump.parse_pages(b"<page><broken")) == []
    pages = list(dump.parse_pages(b'<page><title>A &amp; B</title><id>1</id><redirect title="C &amp; D"/><revision><text>old</text></revision><revision><id>7</id><text> new </text></revision></page>'))
    assert pages == [(1, "A & B", None, "C & D", None, "new")]


def test_extraction_numbers(spark, dumps):
    got = E.stats(dump.read_dump(spark, f"{dumps}/wiki.xml.bz2")).first().asDict()
    assert got == {"articles": 2, "blobs": 2, "infoboxes": 1, "edges": 2, "see_also_edges": 1, "invalid_links": 2, "categories": 2, "category_edges": 3, "images": 1, "image_edges": 1, "external_links": 1, "external_link_edges": 1}


def test_edges_exactly(spark, dumps):
    t = E.tables(dump.read_dump(spark, f"{dumps}/wiki.xml.bz2"))
    assert rows(t["edges"].drop("key")) == [(1, 2, "LINKS_TO"), (1, 2, "SEE_ALSO"), (2, 1, "LINKS_TO")]
    assert rows(t["article_categories"].drop("key")) == [(1, "Languages", "HAS_CATEGORY"), (1, "Plants & such", "HAS_CATEGORY"), (2, "Languages", "HAS_CATEGORY")]
    assert rows(t["nodes"].drop("key")) == [(1, "Fern (language)", "Page"), (2, "Moss (language)", "Page")]


def test_blobs_roundtrip(spark, dumps):
    arts = E.articles(dump.read_dump(spark, f"{dumps}/wiki.xml.bz2"))
    kept = {r.id: json.loads(r.json) for r in E.blob_json(E.blobs(arts)).collect()}
    assert kept[1]["infoboxes"] == [{"infobox_type": "Infobox language", "fields": [["name", "Fern"], ["by", "A B"]]}]
    assert kept[1]["sections"] == ["See also", "References"]
    assert set(kept[2]) == {"id", "title", "abstract_text", "categories", "timestamp"}
    back = {r.id: r for r in E.read_blobs(E.blob_json(E.blobs(arts))).collect()}
    assert back[2].infoboxes == []
    assert back[2].is_disambiguation is False


def test_pipeline_end_to_end(spark, dumps, tmp_path):
    out = str(tmp_path / "out")
    got = program.pipeline(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, shards=3, blob_shards=10))
    assert got["load"] == {"articles": 2, "links": 3}
    assert (got["analytics"]["nodes"], got["analytics"]["edges"]) == (2, 3)
    names = {p.name for p in Path(out).iterdir()}
    assert {"nodes.csv", "edges.csv", "article_images.csv"} <= names
    assert len(list(Path(out, "shards").glob("*.csv"))) == 24
    assert Path(out, "nodes.csv").read_text().splitlines()[0] == "id:ID,title,:LABEL"
    at = f"{out}/graph.store"
    assert [r.title for r in store.top_by_rank(store.article(spark, at), 1).collect()] == ["Fern (language)"]  # a tie: each gets all of the other
    assert rows(store.article(spark, at).select("id", "degree")) == [(1, 3), (2, 3)]
    assert rows(store.neighbours(spark, at, 2)) == [(1, "Fern (language)")]
    assert rows(store.by_title(store.article(spark, at), "Moss (language)").select("id")) == [(2,)]
    report = program.stats(spark, out)
    assert (report["blobs"], report["archived"]) == (2, 24)
    assert (got["extract"]["skipped_pages"], got["extract"]["skipped_streams"]) == (0, 0)
    again = program.extract(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, shards=3, blob_shards=10, resume=True))
    assert again == got["extract"]
    program.blob_files(spark, out, f"{out}/files")
    assert json.loads(Path(out, "files/001/1.json").read_text())["title"] == "Fern (language)"


def test_manifest_goes_stale(spark, dumps, tmp_path):
    source = tmp_path / "w.xml"
    source.write_bytes(bz2.decompress((dumps / "wiki.xml.bz2").read_bytes()))
    from loomgraph.plans.manifest import Manifest

    m = Manifest(spark, str(tmp_path / "o"), str(source), {})
    assert m.done("a") is None
    m.record("a", {"n": 1})
    assert m.done("a") == {"n": 1}
    assert Manifest(spark, str(tmp_path / "o"), str(source), {"limit": 3}).done("a") is None
    source.write_text("<mediawiki></mediawiki>")
    assert Manifest(spark, str(tmp_path / "o"), str(source), {}).done("a") is None
    (tmp_path / "o/.manifest/a.json").write_text("{")
    (tmp_path / "o/.manifest/.a.json.crc").unlink(missing_ok=True)
    assert m.done("a") is None
    m.clear()
    assert not (tmp_path / "o/.manifest").exists()


def test_resume_goes_on_after_the_last_committed_table(spark, dumps, tmp_path, monkeypatch):
    out, tables = str(tmp_path / "r"), []
    real = csv_tables._export

    def failing(df, base, *rest):
        tables.append(base)
        if base == "article_images" and tables.count(base) == 1:
            raise OSError("disk full")
        return real(df, base, *rest)

    monkeypatch.setattr(csv_tables, "_export", failing)
    o = program.Extract(f"{dumps}/wiki.xml.bz2", out, shards=2, blob_shards=4, resume=True)
    with pytest.raises(OSError, match="disk full"):
        program.extract(spark, o)
    parsed = Path(out, ".pages/_SUCCESS").stat().st_mtime
    assert program.extract(spark, o)["articles"] == 2
    assert [tables.count(b) for b in ("nodes", "edges", "article_images", "article_external_links")] == [1, 1, 2, 1]
    limited = program.extract(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, shards=2, limit=1, dry_run=True))
    assert limited["articles"] == 1
    assert Path(out, ".pages/_SUCCESS").stat().st_mtime == parsed  # other options do not parse the dump again
    after = program.extract(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, after=1, dry_run=True))
    assert after["articles"] == 1
    import shutil

    shutil.rmtree(f"{out}/.pages")
    assert program.extract(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, dry_run=True))["articles"] == 2


def test_cancel(spark):
    from threading import Thread
    from time import sleep

    from pyspark import inheritable_thread_target

    failed = []

    def job():
        program.grouped(spark, "extract")
        try:
            spark.range(10**13).selectExpr("sum(id % 7)").collect()
        except Exception as e:
            failed.append(str(e))

    t = Thread(target=inheritable_thread_target(spark)(job))
    t.start()
    sleep(3)
    program.cancel(spark)
    t.join(60)
    assert failed and "cancel" in failed[0].lower()


def test_dry_run_and_limit(spark, dumps, tmp_path):
    out = str(tmp_path / "dry")
    got = program.extract(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, dry_run=True, limit=1))
    assert got["articles"] == 1
    assert not Path(out, "nodes.csv").exists()
    with pytest.raises(ValueError):
        program.extract(spark, program.Extract("", out))


SHARDS = {"nodes": "1,A,Page", "edges": "1,1,LINKS_TO", "categories": None, "article_categories": "1,Common,HAS_CATEGORY", "image_nodes": "a.png,a.png,Image", "article_images": "1,a.png,HAS_IMAGE", "external_link_nodes": "http://a,http://a,ExternalLink", "article_external_links": "1,http://a,HAS_LINK"}


def test_merge_of_shards(spark, tmp_path):
    from loomgraph.config import TABLES

    for i in range(8):
        for base, (header, _) in TABLES.items():
            lines = [f"Common,Common,Category\nCat{i},\"Cat {i}, \"\"x\"\"\",Category"] if base == "categories" else [SHARDS[base]]
            (tmp_path / f"{base}_{i:03d}.csv").write_text("\n".join([",".join(header), *lines]) + "\n")
    csv_tables.merge(spark, str(tmp_path))
    assert csv_tables.read(spark, str(tmp_path), "categories", None).count() == 9
    assert csv_tables.read(spark, str(tmp_path), "nodes", None).count() == 8
    assert csv_tables.read(spark, str(tmp_path), "image_nodes", None).count() == 1
    assert rows(csv_tables.read(spark, str(tmp_path), "categories", None).where("id = 'Cat3'")) == [("Cat3", 'Cat 3, "x"', "Category")]
    (tmp_path / "edges_004.csv").unlink()
    with pytest.raises(FileNotFoundError):
        csv_tables.merged(spark, str(tmp_path))


def test_export_keeps_every_row_whatever_the_session_limits(spark, tmp_path):
    df = spark.range(10).selectExpr("id as key", "id", "concat('T,', id) as title", "'Page' as label")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 2)
    try:
        csv_tables.export({"nodes": df}, str(tmp_path), 2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert csv_tables.read(spark, str(tmp_path), "nodes").count() == 10
    assert sorted(p.name for p in tmp_path.glob("*.csv")) == ["nodes_000.csv", "nodes_001.csv"]
    with pytest.raises(ValueError):
        csv_tables.export({"nodes": df}, str(tmp_path), 1001)
    assert (csv_tables.shown(None), csv_tables.shown(3)) == ("single-file", "sharded (3 shards)")


def test_store_keeps_the_last_complete_version(spark, tmp_path):
    at = str(tmp_path)
    arts, links = spark.createDataFrame([(1, "A"), (2, "B")], "id long, title string"), spark.createDataFrame([(1, 2)], "src long, dst long")
    store.create(arts, links, at, rows_a_file=1)
    held = store.article(spark, at)
    rank = spark.createDataFrame([(1, 0.5, 1, 3)], "id long, pagerank double, community long, degree long")
    store.write_metrics(spark, at, rank)
    assert rows(store.article(spark, at)) == [(1, "A", 0.5, 1, 3), (2, "B", None, None, None)]
    assert held.count() == 2  # the version before is still there
    (tmp_path / "article-000002").mkdir()  # a write that crashed
    assert rows(store.article(spark, at).select("id", "degree")) == [(1, 3), (2, None)]
    store.write_metrics(spark, at, rank.withColumn("degree", rank.degree + 1))
    assert rows(store.article(spark, at).select("degree")) == [(4,), (None,)]
    assert sorted(p.name for p in tmp_path.glob("article-*")) == ["article-000001", "article-000003"]


def test_layout(spark, tmp_path):
    folder = csv_tables.Folder(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        csv_tables.layout(folder)
    (tmp_path / "nodes.csv").write_text("")
    assert csv_tables.layout(folder) is None
    for i in (0, 1, 3):
        (tmp_path / f"nodes_{i:03d}.csv").write_text("")
    assert csv_tables.layout(folder) == 2
    assert csv_tables.file_names("edges", 2) == ["edges_000.csv", "edges_001.csv"]


def test_store_refuses_to_overwrite(spark, dumps, tmp_path):
    out = str(tmp_path / "o")
    program.extract(spark, program.Extract(f"{dumps}/wiki.xml.bz2", out, shards=2))
    assert program.load(spark, out) == {"articles": 2, "links": 3}
    with pytest.raises(Exception, match="(?i)already exists"):
        program.load(spark, out)
    assert program.load(spark, out, clean=True) == {"articles": 2, "links": 3}


def test_cli(spark, dumps, tmp_path, capsys):
    out = str(tmp_path / "c")
    assert cli.main(["extract", "-i", f"{dumps}/w-multistream.xml.bz2", "-o", out, "--csv-shards", "1"], spark)["articles"] == 2
    assert cli.main(["stats", "-o", out], spark)["blobs"] == 2
    spark.sparkContext.setLogLevel("ERROR")


def test_streaming_ingest(spark, dumps, tmp_path):
    pages = dump.read_dump(spark, f"{dumps}/wiki.xml.bz2")
    for part in ("id <= 1", "id > 1"):
        pages.where(part).write.mode("append").parquet(f"{tmp_path}/in")
        ingest(stream_pages(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(60)
    assert rows(spark.read.parquet(f"{tmp_path}/out/links").select("id", "target")) == rows(E.link_targets(E.articles(pages)).select("id", "target"))
    assert spark.read.parquet(f"{tmp_path}/out/categories").count() == 3


def test_lookups_read_few_row_groups(spark, tmp_path, monkeypatch):
    """Neighbours of both directions, a hub in parts, and how many row groups can hold what is looked up."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(store, "HUB", 100)
    monkeypatch.setattr(store, "_SMALL", {})
    for t in ("article", "near_out", "near_in"):
        monkeypatch.setitem(store._LAYOUT, t, store._LAYOUT[t] | {"parquet.block.size": 4000, "parquet.page.size": 1000})
    arts = spark.range(1, 3001).select("id", F.concat(F.lit("T"), F.col("id").cast("string")).alias("title"))
    links = spark.range(1, 9001).select((F.col("id") % 3000 + 1).alias("src"), (F.col("id") * 7 % 3000 + 1).alias("dst")).unionByName(spark.range(1, 1001).select(F.lit(5).cast("long").alias("src"), (F.col("id") * 2).alias("dst")))
    links = links.unionByName(spark.createDataFrame([(5, 9999), (7, 8), (7, 8)], "src long, dst long"))
    at = f"{tmp_path}/s"
    store.create(arts, links, at)
    pairs = [(r.src, r.dst) for r in links.collect() if r.dst <= 3000]
    for x in (5, 7, 8, 2999, 12345):
        assert rows(store.neighbours(spark, at, x)) == sorted(((b, f"T{b}") for a, b in pairs if a == x), key=str)
        assert rows(store.neighbours(spark, at, x, "in")) == sorted(((a, f"T{a}") for a, b in pairs if b == x), key=str)
    near = spark.read.parquet(store._current(spark, at, "near_out"))
    assert near.where("id = 5").count() > 5 and near.agg(F.max(F.size("near"))).first()[0] < 200

    def groups(table, column, value):
        """(row groups, those whose range of the column holds the value)"""
        n = fit = 0
        for f in Path(store._current(spark, at, table)).glob("*.parquet"):
            meta = pq.ParquetFile(f).metadata
            i = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(i).statistics
                n, fit = n + 1, fit + (s.min <= value <= s.max)
        return n, fit

    for table, column, value in (("near_out", "id", 700), ("near_in", "id", 700), ("article", "title", "T700")):
        n, fit = groups(table, column, value)
        assert n >= 8 and fit <= 2, (table, n, fit)
    plan = store.neighbours(spark, at, 700)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,700)" in plan and "Exchange" not in plan
    with pytest.raises(ValueError):
        store.neighbours(spark, at, 1, "both")


@pytest.fixture(scope="module")
def large_dump(tmp_path_factory):
    """60 streams of 5 pages with links among them, a damaged stream, and an index with a line that is none."""
    base = tmp_path_factory.mktemp("large")
    packed, lines = b"", ["nothing\n"]
    for s in range(60):
        items = "".join(PAGE.format(f"P{i}", 0, i, "", i, 1, f"[[P{i * 7 % 300}]] [[Nowhere]] [[Category:C{i % 9}]]") for i in range(5 * s + 1, 5 * s + 6))
        lines += [f"{len(packed)}:{i}:P{i}\n" for i in range(5 * s + 1, 5 * s + 6)]
        packed += bz2.compress(items.encode()) if s != 30 else b"no stream"
    (base / "x-multistream.xml.bz2").write_bytes(packed)
    (base / "x-multistream-index.txt.bz2").write_bytes(bz2.compress("".join(lines).encode()))
    (base / "plain.xml").write_text("<mediawiki>" + "".join(PAGE.format(f"P{i}", 0, i, "", i, 1, f"[[P{i * 7 % 300}]] [[Category:C{i % 9}]]" + "x" * 9000) for i in range(1, 401)) + "</mediawiki>")
    return base


def _tables(spark, out):
    return {b: rows(csv_tables.read(spark, out, b)) for b in ("nodes", "edges", "categories", "article_categories")}


COUNTERS = ("articles", "edges", "invalid_links", "categories", "skipped_pages", "skipped_streams", "skipped_index_lines")


@pytest.mark.parametrize("name", ["x-multistream.xml.bz2", "plain.xml"])
def test_a_run_that_is_killed_in_a_stage_goes_on(spark, large_dump, tmp_path, monkeypatch, name):
    """Batches are committed one by one: after a failure in the fourth, those before are not read again, and the tables are those of an uninterrupted run."""
    from loomgraph.streaming import ingest as I

    whole = program.extract(spark, program.Extract(f"{large_dump}/{name}", f"{tmp_path}/whole", shards=2))
    read, real = [], I.read_ranges

    def failing(ranges, exact):
        read.append(ranges.count())
        if len(read) == 4 and name.startswith("x"):
            raise RuntimeError("killed")
        return real(ranges, exact)

    monkeypatch.setattr(I, "read_ranges", failing)
    o = program.Extract(f"{large_dump}/{name}", f"{tmp_path}/batches", shards=2, interval=30)
    if name.startswith("x"):
        with pytest.raises(Exception, match="killed"):
            program.extract(spark, o)
        assert len(read) == 4 and sum(read[:3]) == 18
    parts = program.extract(spark, o)
    assert {k: parts[k] for k in COUNTERS} == {k: whole[k] for k in COUNTERS}
    if name.startswith("x"):
        assert len(read) == 11 and sum(read) == 66  # ten batches of six streams, one of them twice
        assert (parts["skipped_streams"], parts["skipped_index_lines"], parts["articles"]) == (1, 1, 295)
    assert _tables(spark, f"{tmp_path}/batches") == _tables(spark, f"{tmp_path}/whole")
    program.extract(spark, o)
    assert len(read) == (11 if name.startswith("x") else len(read))


def test_the_flag_of_the_command_line_sets_the_batch(spark, large_dump, tmp_path):
    from loomgraph.sources.csv_tables import Folder

    cli.main(["extract", "-i", f"{large_dump}/x-multistream.xml.bz2", "-o", f"{tmp_path}/o", "--checkpoint-interval", "100", "--csv-shards", "1"], spark)
    assert Folder(spark, f"{tmp_path}/o/.pages").names() == ["batch=-1", "batch=0", "batch=1", "batch=2"]
    # Another interval is another plan; nothing of the first stays.
    cli.main(["extract", "-i", f"{large_dump}/x-multistream.xml.bz2", "-o", f"{tmp_path}/o", "--checkpoint-interval", "200", "--csv-shards", "1", "--no-cache"], spark)
    assert Folder(spark, f"{tmp_path}/o/.pages").names() == ["batch=-1", "batch=0", "batch=1"]
    with pytest.raises(ValueError):
        program.Extract("a", "b", interval=0).validate()


def test_counters_come_from_the_writes(spark, large_dump, dumps, tmp_path, monkeypatch):
    """Those of an extraction equal those of the counting pass, which is not run; tables without rows count 0; a resumed run reports the same."""
    for name in (f"{large_dump}/x-multistream.xml.bz2", f"{dumps}/wiki.xml.bz2"):
        want = E.stats(dump.read_dump(spark, name)).first().asDict()
        out = f"{tmp_path}/{Path(name).name}"
        with monkeypatch.context() as m:
            m.setattr(E, "marks", None)
            got = program.extract(spark, program.Extract(name, out, shards=2, blob_shards=4))
        assert {k: got[k] for k in want} == want
        again = program.extract(spark, program.Extract(name, out, shards=2, blob_shards=4, resume=True))
        assert again == got
    assert want["infoboxes"] == 1 and {"image_edges", "invalid_links"} <= set(got)


def test_progress_is_told_while_a_program_runs(spark, large_dump, tmp_path, capsys):
    assert program.progress(spark)["percent"] == 0.0
    cli.main(["--progress", "0.02", "extract", "-i", f"{large_dump}/plain.xml", "-o", f"{tmp_path}/o", "--csv-shards", "2"], spark)
    told = [json.loads(x) for x in capsys.readouterr().err.splitlines() if x.startswith("{")]
    assert any(p["tasks"] for p in told) and all(0 <= p["percent"] <= 100 for p in told)


def test_merged_files_keep_the_order_of_shards_and_rows(spark, large_dump, tmp_path):
    out = f"{tmp_path}/m"
    program.extract(spark, program.Extract(f"{large_dump}/x-multistream.xml.bz2", out, shards=3))
    shards = {b: [Path(out, n).read_text().split("\n", 1)[1] for n in csv_tables.file_names(b, 3)] for b in ("nodes", "edges", "categories")}
    csv_tables.merge(spark, out)
    for b in ("nodes", "edges"):
        assert Path(out, f"{b}.csv").read_text().split("\n", 1)[1] == "".join(shards[b])
    once = list(dict.fromkeys(x for part in shards["categories"] for x in part.splitlines()))
    assert Path(out, "categories.csv").read_text().splitlines()[1:] == once
