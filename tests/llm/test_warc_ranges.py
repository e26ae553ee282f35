"""Ranges on file systems that only Spark can open, and revisits by what they refer to."""

import hashlib
import os
import random
import uuid

import pytest

from llm_help import plain, same_as_sql
from loomgraph.llm import warc
from loomgraph.llm.common import shared_dir
from test_warc_damage import member, stored_member

CUT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=["700", "5000", "16m"])
def cut(request, spark):
    spark.conf.set(CUT, request.param)
    yield request.param
    spark.conf.unset(CUT)


def some_pages(spark):
    rng = random.Random(8)
    html = [None, "", "x" * 9000, "é\x1f\x8b"] + ["".join(rng.choices("abcdefgh<>é ", k=rng.randrange(3000))) for _ in range(30)]
    return spark.createDataFrame([(i, f"u{i}", rng.choice(html)) for i in range(90)], "page_id long, url string, html string").repartition(3)


def test_query_reads_ranges_without_pyarrow(spark, monkeypatch, tmp_path, cut):
    """The query once read whole files where pyarrow cannot open the folder."""
    read = warc.read_warc

    def not_whole(*a, whole=False, **b):
        assert not whole, "read by file"
        return read(*a, whole=whole, **b)

    monkeypatch.setattr(warc, "openable", lambda path: False)
    monkeypatch.setattr(warc, "read_warc", not_whole)
    some_pages(spark).write.parquet(f"{tmp_path}/pages.parquet")
    pages = spark.read.parquet(f"{tmp_path}/pages.parquet")
    same_as_sql(warc.op1_warc(spark, str(tmp_path)), warc.SQL, pages=pages)


def test_ranges_are_cut_by_spark(spark, cut):
    folder = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    files = warc.write_warc(some_pages(spark), folder, sink=True)
    assert plain(warc.by_splits(spark, folder)) == plain(warc.read_warc(spark, files))
    text = spark.read.options(lineSep=warc.MAGIC.decode("latin-1"), encoding="ISO-8859-1").text(folder)
    assert (text.rdd.getNumPartitions() > 2 * files.count()) == (cut != "16m")


def test_what_ranges_cannot_tell_is_read_in_one_pass(spark, tmp_path, cut):
    """Magic inside payloads, archives inside payloads, damage, and bytes before the first member, in files beside a clean one."""
    rng = random.Random(5)
    inner = b"x" * 400 + b"".join(member(900 + i, b"in") for i in range(4)) + b"y" * 300
    false = b"".join(rng.randbytes(50) + warc.MAGIC for _ in range(40))
    parts = [member(30 + i, rng.randbytes(200)) for i in range(5)]
    flipped = bytearray(parts[1])
    flipped[150] ^= 255
    blobs = {
        "clean": b"".join(member(i, os.urandom(300)) for i in range(9)),
        "archive": member(10, b"a") + member(11, inner, stored_member) + member(12, b"c" * 50),
        "magic": b"".join(member(20 + i, false, stored_member) for i in range(5)),
        "damage": parts[0] + bytes(flipped) + parts[2] + b"zz" + parts[3][2:] + parts[4][:-9],
        "before": b"junk" + member(40, b"j") + member(41, b"k"),
    }
    for name, blob in blobs.items():
        (tmp_path / f"{name}{warc.SUNK}").write_bytes(blob)
        (tmp_path / f"{name}.warc.gz").write_bytes(blob)
    folder = f"file://{tmp_path}"
    want = sorted([*range(9), 10, 11, 12, *range(20, 25), 30, 32, 40, 41])
    assert sorted(r.page_id for r in warc.by_splits(spark, folder, payload=False).collect()) == want
    rows = plain(warc.read_warc(spark, spark.createDataFrame([(f"{folder}/{n}{warc.SUNK}", len(b)) for n, b in blobs.items()], "path string, bytes long")))
    assert plain(warc.by_splits(spark, folder)) == rows
    assert plain(warc.listed(spark, folder, sink=True)) == sorted(rows * 2, key=str)


def test_revisits_are_resolved(spark, tmp_path):
    """A revisit tells what its response holds; it is not intact if there is none, or of another length or digest."""
    sha = lambda b: hashlib.sha1(b).digest()
    revisit = lambda i, payload, to: warc.packed(warc.record(i, "u", payload, sha(payload), to, False))
    other_length = warc.packed(warc.record(6, "u", b"longer", sha(b"full"), 1, False))
    broken = warc.packed(warc.record(7, "u", b"real", sha(b"stated"), 7, True))
    blob = member(1, b"full") + revisit(2, b"full", 1) + revisit(3, b"full", 99) + revisit(4, b"else", 1) + other_length + broken
    (tmp_path / "a.warc.gz").write_bytes(blob)
    read = warc.read_warc(spark, spark.createDataFrame([(str(tmp_path / "a.warc.gz"), len(blob))], "path string, bytes long"))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.intact) for r in warc.resolved(read).collect()}
    full = warc.base32(sha(b"full"))
    assert got == {
        1: (4, full, True), 2: (4, full, True), 3: (4, full, False), 4: (4, warc.base32(sha(b"else")), False),
        6: (4, full, False), 7: (4, warc.base32(sha(b"real")), False),
    }
