"""Damaged and embedded members, and the committed sink."""

import hashlib
import os
import zlib

import pytest

from llm_help import plain
from loomgraph.llm import warc
from loomgraph.llm.common import shared_dir


def stored_member(b):
    """A member whose bytes lie uncompressed, so whatever is inside shows."""
    p = zlib.compressobj(0, zlib.DEFLATED, 31)
    return p.compress(b) + p.flush()


def member(i, payload, pack=warc.packed):
    return pack(warc.record(i, "u", payload, hashlib.sha1(payload).digest(), i, True))


def read(spark, path, blob, step):
    path.write_bytes(blob)
    archives = spark.createDataFrame([(str(path), len(blob))], "path string, bytes long")
    got = [r.page_id for r in warc.read_warc(spark, archives, range_bytes=step).collect()]
    return sorted(got), sorted((r.at, r.bytes) for r in warc.damaged(warc.spans(spark, archives, range_bytes=step)).collect())


@pytest.mark.parametrize("step", [333, 5000, 10**6])
def test_bytes_that_look_like_the_magic(spark, tmp_path, step):
    inner = b"".join(os.urandom(50) + warc.MAGIC for _ in range(40))
    blob = b"".join(member(i, inner, stored_member) for i in range(5))
    assert read(spark, tmp_path / "a.warc.gz", blob, step) == ([0, 1, 2, 3, 4], [])


@pytest.mark.parametrize("step", [150, 700, 10**6])
def test_archive_inside_a_payload(spark, tmp_path, step):
    """Whole records inside a stored payload are part of it, wherever ranges begin."""
    inner = b"x" * 400 + b"".join(member(90 + i, b"in") for i in range(4)) + b"y" * 300
    blob = member(1, b"a") + member(2, inner, stored_member) + member(3, b"c" * 50)
    assert read(spark, tmp_path / "a.warc.gz", blob, step) == ([1, 2, 3], [])


@pytest.mark.parametrize("step", [120, 10**6])
def test_damaged_members_cost_themselves_alone(spark, tmp_path, step):
    parts = [member(i, os.urandom(200)) for i in range(5)]
    at = [sum(map(len, parts[:i])) for i in range(6)]
    flipped = bytearray(parts[1])
    flipped[150] ^= 255
    no_magic = b"zz" + parts[3][2:]
    blob = parts[0] + bytes(flipped) + parts[2] + no_magic + parts[4][:-9]
    assert read(spark, tmp_path / "a.warc.gz", blob, step) == ([0, 2], [(at[1], len(parts[1])), (at[3], len(parts[3])), (at[4], len(parts[4]) - 9)])


def test_sink_of_spark_and_reading_by_file(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 300)
    monkeypatch.setattr(warc, "CHUNKS_A_FILE", 3)
    pages = spark.createDataFrame([(i, f"u{i}", "é" * (i % 7) * 9) for i in range(60)], "page_id long, url string, html string").repartition(3)
    folder = f"{shared_dir(spark)}/sunk"
    files = warc.write_warc(pages, folder, sink=True)
    assert files.count() > 3
    by_range = warc.read_warc(spark, files, range_bytes=500)
    own = warc.read_warc(spark, warc.write_warc(pages, f"{shared_dir(spark)}/own"))
    assert plain(by_range) == plain(own) == plain(warc.listed(spark, folder, sink=True)) == plain(warc.listed(spark, folder))


def test_foreign_records():
    raw = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length: x\r\n\r\nsoftware: a\r\n\r\nb"
    fields, payload = warc.parsed(raw)
    assert (fields[0], fields[2], fields[6], fields[7]) == (None, "warcinfo", None, "<urn:uuid:1>")
    assert payload == b"software: a\r\n\r\nb"
