"""The readers of dumps that split files, and the data source, against the XML source."""

import bz2
import os
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from loomgraph.sources import dump


def page(i, text):
    return dump.page_xml(i, f"Title {i} & é", i % 3 if i % 5 else None, f"To {i}" if i % 7 == 0 else None, "2024-01-01T00:00:00Z" if i % 2 else None, text)


def texts(n, seed=1):
    rng = random.Random(seed)
    return [" ".join(str(rng.random()) for _ in range(rng.choice([1, 40, 400]))) + (" </page> <page> & é日" if i % 4 == 0 else "") for i in range(n)]


def body(n, first=1):
    return [page(first + i, t) for i, t in enumerate(texts(n, first))]


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "title", "ns", "redirect_to", "timestamp", "text").collect())


def key(r):
    return (r[0], *map(str, r))


@pytest.fixture
def small_splits(spark):
    """Splits of 50,000 bytes, so that small files are read by several tasks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("packed", ["plain", "one stream", "streams", "cut anywhere"])
def test_splits_read_what_the_xml_source_reads(spark, tmp_path, small_splits, packed):
    xml = ("<mediawiki>\n<siteinfo/>" + "".join(body(600)) + "</mediawiki>").encode()
    name, raw = "d.xml", xml
    if packed != "plain":
        name = "d.xml.bz2"
        cuts = {"one stream": [len(xml)], "streams": [0, *(i * 100_003 for i in range(1, 12))], "cut anywhere": sorted(random.Random(4).sample(range(len(xml)), 9))}[packed]
        raw = b"".join(bz2.compress(xml[a:b], 1) for a, b in zip([0, *cuts], [*cuts, len(xml)]) if a < b)
    (tmp_path / name).write_bytes(raw)
    path = str(tmp_path / name)
    want = rows(dump.read_xml(spark, path))
    assert len(want) == 600
    split = dump.read_split(spark, path)
    assert split.rdd.getNumPartitions() > 3
    assert rows(split) == want
    assert [r.id for r in split.orderBy("pos").collect()] == list(range(1, 601))
    assert split.select("pos").distinct().count() == 600
    dump.dump_source(spark)
    for size in (20_000, 333_333, 10**9):
        source = spark.read.format("wikidump").option("splitbytes", size).option("piecebytes", 7000).load(path)
        assert rows(source) == want
        assert [r.id for r in source.orderBy("pos").collect()] == list(range(1, 601))


@pytest.fixture(scope="module")
def forty(tmp_path_factory):
    """40 multistream files: names with spaces, percent and plus signs, and base names that are equal in two folders."""
    base = tmp_path_factory.mktemp("dumps")
    dumps, indexes = [], []
    for n in range(40):
        folder = base / ("a b" if n % 2 else "c+d 100%25")
        folder.mkdir(exist_ok=True)
        name = f"wiki {n // 2}-multistream"
        parts, at, lines = [b"<mediawiki>\n"], 0, []
        packed = bz2.compress(parts[0])
        for s in range(3):
            pages = body(5, 1000 * n + 10 * s + 1)
            lines += [f"{len(packed)}:{1000 * n + 10 * s + 1 + i}:T: x\n" for i in range(5)]
            packed += bz2.compress("".join(pages).encode())
        packed += bz2.compress(b"</mediawiki>")
        (folder / f"{name}.xml.bz2").write_bytes(packed)
        (folder / f"{name}-index.txt.bz2").write_bytes(bz2.compress("".join(lines).encode()))
        dumps.append(str(folder / f"{name}.xml.bz2"))
        indexes.append(str(folder / f"{name}-index.txt.bz2"))
    return dumps, indexes, [1000 * n + 10 * s + 1 + i for n in range(40) for s in range(3) for i in range(5)]


def test_forty_files_by_their_indexes(spark, forty):
    dumps, indexes, ids = forty
    got = dump.read_multistream(spark, dumps, indexes)
    assert [r.id for r in got.orderBy("pos").collect()] == ids
    assert got.select("pos").distinct().count() == len(ids)
    assert all(dump.index_path(d) == i for d, i in zip(dumps, indexes))


def test_forty_files_as_a_source_and_by_splits(spark, forty, tmp_path):
    dumps, _, ids = forty
    dump.dump_source(spark)
    import json

    got = spark.read.format("wikidump").option("paths", json.dumps(dumps)).load()
    assert [r.id for r in got.orderBy("pos").collect()] == ids
    whole = spark.read.format("wikidump").load(os.path.dirname(dumps[1]))
    assert sorted(r.id for r in whole.collect()) == sorted(i for i in ids if i // 1000 % 2)
    assert [r.id for r in dump.read_split(spark, dumps).orderBy("pos").collect()] == ids
    with pytest.raises(FileNotFoundError):
        dump.read_split(spark, str(tmp_path / "none.xml"))


def test_an_index_without_its_dump_is_an_error(spark, forty, tmp_path):
    dumps, indexes, _ = forty
    (tmp_path / "empty.txt").write_text("no line\n10000000000:1:beyond\n")
    with pytest.raises(ValueError, match="empty.txt"):
        dump.read_multistream(spark, dumps[:2], [indexes[0], str(tmp_path / "empty.txt")])
    with pytest.raises(FileNotFoundError):
        dump.read_multistream(spark, dumps[:1], [str(tmp_path / "gone.txt")])


def test_a_file_system_that_only_spark_knows(spark, forty, tmp_path):
    """viewfs is none of pyarrow's."""
    dumps, _, ids = forty
    folder = tmp_path / "in"
    folder.mkdir()
    os.symlink(dumps[0], folder / "w-multistream.xml.bz2")
    os.symlink(dumps[0].replace(".xml.bz2", "-index.txt.bz2"), folder / "w-multistream-index.txt.bz2")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.dumps.link./in", f"file://{folder}")
    got = dump.read_dump(spark, "viewfs://dumps/in/w-multistream.xml.bz2")
    assert [r.id for r in got.orderBy("pos").collect()] == [i for i in ids if i < 1000]


def test_columns_and_filters_reach_the_parser(spark, forty):
    dumps, _, ids = forty
    dump.dump_source(spark)
    few = spark.read.format("wikidump").schema("title string, id long").load(dumps[3])
    assert few.columns == ["title", "id"] and sorted(r.id for r in few.collect()) == [i for i in ids if i // 1000 == 3]
    # The parser itself, as a task runs it: what is not asked for is not kept, and rows that a filter drops are never made.
    made = Counter()
    real = dump._page

    def counted(piece, with_text, with_timestamp):
        made[with_text, with_timestamp] += 1
        return real(piece, with_text, with_timestamp)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(dump, "_page", counted)
        reader = dump.DumpReader(few.schema, {"path": dumps[3]})
        assert list(reader.pushFilters([dump.GreaterThan(("id",), 3010), dump.EqualTo(("title",), "x")])) == [dump.EqualTo(("title",), "x")]
        (part,) = reader.partitions()
        (batch,) = reader.read(part)
        assert batch.schema.names == ["title", "id"] and all(i > 3010 for i in batch.column("id").to_pylist()) and batch.num_rows == 10
    assert set(made) == {(False, False)}
    filtered = spark.read.format("wikidump").load(dumps[3]).where("id > 3010 and ns = 1")
    assert sorted(r.id for r in filtered.collect()) == sorted(i for i in ids if 3010 < i < 4000 and i % 5 and i % 3 == 1)
    assert "PushedFilters: []" not in filtered._jdf.queryExecution().executedPlan().toString()


def test_what_a_source_leaves_out_is_told(spark, tmp_path):
    good, bad = page(1, "x"), page(2, "y").replace("</title>", "")
    no_end = page(3, "z").replace("</page>", "")
    parts = [bz2.compress((good + bad).encode()), bz2.compress((no_end + page(4, "w")).encode()), bz2.compress(page(5, "v").encode())[:-20] + b"0" * 20, bz2.compress(page(6, "u").encode())]
    (tmp_path / "d.xml.bz2").write_bytes(b"".join(parts))
    dump.dump_source(spark)
    got = spark.read.format("wikidump").schema("id long, problem string").load(str(tmp_path / "d.xml.bz2")).collect()
    assert sorted((r.id or 0, r.problem or "") for r in got if r.id != 5) == [(0, "page"), (0, "page"), (0, "stream"), (1, ""), (4, ""), (6, "")]
    (tmp_path / "d.xml").write_text("<mediawiki>" + good + bad + no_end + page(4, "w") + "</mediawiki>")
    for r in (dump.read_split(spark, str(tmp_path / "d.xml"), problems=True), spark.read.format("wikidump").schema("id long, problem string").load(str(tmp_path / "d.xml"))):
        assert sorted((r.id or 0, r.problem or "") for r in r.collect()) == [(0, "page"), (0, "page"), (1, ""), (4, "")]
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("wikidump").schema("nothing long").load(str(tmp_path / "d.xml")).collect()


def test_writers_take_a_batch_by_pieces(spark, tmp_path):
    """All pages of a batch of many are written, whatever is null in them, and the rows that are Python objects at a time do not follow the batch."""
    long = "long " * 300_000
    pages = [(i, i, f"Title {i}", None if i % 3 == 0 else i % 5, "To" if i % 4 == 0 else None, None if i % 7 == 0 else "2024", None if i % 11 == 0 else long + "end" if i == 500 else f"{i} " + "é word " * 300) for i in range(1, 1500)]
    df = spark.createDataFrame(pages, dump.PAGES).coalesce(1)
    dump.write_xml(df, f"{tmp_path}/plain")
    want = sorted((p[1:6] + (p[6] and p[6].strip(),) for p in pages), key=key)
    assert sorted((tuple(r) for r in dump.read_split(spark, f"{tmp_path}/plain").drop("pos").collect()), key=key) == want
    names = dump.write_multistream(df, f"{tmp_path}/multi", files=1, per_file=10**6)
    assert sorted((tuple(r) for r in dump.read_multistream(spark, names[0][0], names[0][1]).drop("pos").collect()), key=key) == want
    batch = pa.RecordBatch.from_pydict({"id": range(10_000), "text": ["x" * 3000 for _ in range(10_000)]})
    tracemalloc.start()
    n = sum(len(piece) for piece in dump._row_pieces(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 10_000 and peak < 8 << 20, peak
