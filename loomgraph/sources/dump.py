"""MediaWiki XML dumps as pages: pos, id, title, ns, redirect_to, timestamp, text.

Three readers, all in parallel:

* ``read_split`` takes any dump, plain or bz2, from any file system that Spark reads. Spark cuts the files at page ends (of a single bz2 stream,
  Hadoop's codec finds the blocks), and each task parses the pages that end in its split.
* ``spark.read.format("wikidump")`` (``dump_source``) is a data source whose partitions are byte ranges of files that pyarrow can open: it finds the bz2 streams that begin in
  a range, parses what the requested schema asks for, and takes comparisons of id and ns as filters.
* ``read_multistream`` follows the indexes of a multistream dump, of one file or many, and tells streams that are none.

``read_xml`` goes through Spark's XML source, one task for each file. ``read_dump`` picks: the index where there is one and pyarrow opens the file, else splits.

Positions grow with the order of files and the place in them: bytes before, shifted by 10 bits, and a count of pages (no byte of a dump holds 1,024 pages, packed or not).

Deliberate choices: redirect targets are unescaped like titles; a malformed page is left out alone; a stream whose bytes are no bz2 gives no pages (where splits are read it
fails the task), and a storage that fails to read them fails the task; the last revision's text and timestamp count. What is left out is not silent: with ``problems=True`` a reader has
a row for each of these, without an id, and with what is wrong in the column ``problem`` ("page", "stream", "index line").

``write_multistream`` writes pages as such a dump: many files, each written by one task with its index.
"""

from __future__ import annotations

import bz2
import json
import re
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from urllib.parse import quote, unquote
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

PAGES = "pos long, id long, title string, ns int, redirect_to string, timestamp string, text string"
_XML = "id long, title string, ns int, redirect struct<_title:string>, revision array<struct<timestamp:string,text:struct<_VALUE:string,`_xml:space`:string>>>, _corrupt string"


def read_xml(spark: SparkSession, path: str, *, with_text: bool = True, with_timestamp: bool = True, problems: bool = False) -> DataFrame:
    """Pages of a plain or compressed dump. Without text, or timestamp, none is kept by the parser."""
    schema = _XML if with_text else _XML.replace(",text:struct<_VALUE:string,`_xml:space`:string>", "")
    raw = spark.read.format("xml").option("rowTag", "page").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(schema).load(path)
    last = F.element_at("revision", -1)
    text = F.nullif(F.regexp_replace(last["text"]["_VALUE"], r"(?dU)\A\s+|\s+\z", ""), F.lit("")) if with_text else F.lit(None).cast("string")
    stamp = last["timestamp"] if with_timestamp else F.lit(None).cast("string")
    fine = F.expr("id is not null and title is not null and id between 0 and 4294967295")
    pages = [F.monotonically_increasing_id().alias("pos"), "id", "title", "ns", F.col("redirect._title").alias("redirect_to"), F.when(F.size("revision") > 0, stamp).alias("timestamp"), F.when(F.size("revision") > 0, text).alias("text")]
    if not problems:
        return raw.where(fine).select(*pages)
    rows = raw.select(fine.alias("fine"), *pages)
    return rows.select("pos", *(F.when(F.col("fine"), F.col(c)).alias(c) for c in ("id", "title", "ns", "redirect_to", "timestamp", "text")), F.when(~F.col("fine"), F.lit("page")).alias("problem"))


_START, _END = re.compile(rb"<page[\s>]"), re.compile(rb"</page\s*>")


def _page_pieces(xml: bytes) -> Iterator[bytes]:
    """Each page's bytes. Within a text the tags are escaped, so a tag always cuts; a page without an end is left out."""
    starts = [m.start() for m in _START.finditer(xml)]
    for at, following in zip(starts, [*starts, len(xml)][1:], strict=True):
        if end := _END.search(xml, at, following):
            yield xml[at : end.end()]


def _page(piece: bytes, with_text: bool, with_timestamp: bool) -> tuple | None:
    """(id, title, ns, redirect_to, timestamp, text); None if the page is malformed or has no id or title."""
    local = lambda e: e.tag.rpartition("}")[2]
    try:
        e = ET.fromstring(piece)
    except ET.ParseError:
        return None
    kids = {local(k): k for k in reversed(list(e))}  # the first of each
    page_id, title = (kids["id"].text or "").strip() if "id" in kids else "", kids["title"].text if "title" in kids else None
    ns = (kids["ns"].text or "").strip() if "ns" in kids else ""
    ns = int(ns) if re.fullmatch(r"[+-]?[0-9]{1,9}", ns) else None
    revisions = [k for k in e if local(k) == "revision"]
    parts = {local(k): k for r in revisions for k in r}
    text = (parts["text"].text or "").strip() or None if "text" in parts and with_text else None
    if not (page_id.isdecimal() and int(page_id) < 2**32 and title):
        return None
    stamp = parts["timestamp"].text if "timestamp" in parts and with_timestamp else None
    return int(page_id), title, ns, kids["redirect"].get("title") if "redirect" in kids else None, stamp, text


def parse_pages(xml: bytes, *, with_text: bool = True, with_timestamp: bool = True, bad: list[int] | None = None) -> Iterator[tuple]:
    """(id, title, ns, redirect_to, timestamp, text) of the pages in a piece of a dump, with or without its root element. bad: gets the ordinals of pages left out."""
    n = 0
    for n, piece in enumerate(_page_pieces(xml), 1):
        page = _page(piece, with_text, with_timestamp)
        if page is not None:
            yield page
        elif bad is not None:
            bad.append(n)
    if bad is not None:
        bad += range(n + 1, len(_START.findall(xml)) + 1)  # pages without an end


def index_path(dump: str, exists=None) -> str | None:
    """The index beside a multistream dump, if there is one."""
    if "multistream" not in dump or not dump.endswith(".xml.bz2"):
        return None
    path = dump.removesuffix(".xml.bz2") + "-index.txt.bz2"
    return path if (exists or _exists)(path) else None


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """A path as Spark takes it (not encoded), for pyarrow."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(quote(path, safe=":/@?&=")) if "://" in path else (pafs.LocalFileSystem(), path)


def _exists(path: str) -> bool:
    try:
        fs, at = _opened(path)
    except (pa.ArrowException, OSError):  # not one of pyarrow's, or its library is not there
        return False
    return fs.get_file_info(at).type == pafs.FileType.File


def _listed(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """Full path and size of the files that Spark reads from paths (files, folders or globs), in order of paths, then names."""
    out = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.globStatus(p) or []
        if not len(found):
            raise FileNotFoundError(path)
        for top in found:
            inside = [f for f in fs.listStatus(top.getPath()) if not f.isDirectory()] if top.isDirectory() else [top]
            files = [(f.getPath().toString(), f.getLen()) for f in inside if not f.getPath().getName().startswith(("_", "."))]
            out += sorted(files)
    return out


def _full(file_path: str) -> str:
    """A path of a file's metadata column as the file system writes it."""
    return unquote(file_path)


SHIFT = 10
COLUMNS = [c.split()[0] for c in PAGES.split(", ")] + ["problem"]
_ARROW = {"pos": pa.int64(), "id": pa.int64(), "title": pa.string(), "ns": pa.int32(), "redirect_to": pa.string(), "timestamp": pa.string(), "text": pa.string(), "problem": pa.string()}


def _arrow(rows: list[tuple], columns: list[str]) -> pa.RecordBatch:
    """Rows of COLUMNS, of which some columns are taken."""
    at = [COLUMNS.index(c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _ARROW[c]) for i, c in zip(at, columns, strict=True)], columns)


def read_split(spark: SparkSession, path: str | list[str], *, with_text: bool = True, with_timestamp: bool = True, problems: bool = False) -> DataFrame:
    """Pages of dumps that Spark splits: plain files, and bz2 at block marks. A page that lacks only its end tag at the end of a file counts as whole."""
    paths = [path] if isinstance(path, str) else list(path)
    files = _listed(spark, paths)
    before = dict(zip((f for f, _ in files), accumulate((n for _, n in files), initial=0), strict=False))  # one entry for each file
    columns = COLUMNS if problems else COLUMNS[:-1]
    pieces = spark.read.option("lineSep", "</page>").text([f for f, _ in files]).select(F.col("value").cast("binary").alias("value"), "_metadata.file_path", "_metadata.file_block_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0
        for b in batches:
            rows, size = [], 0
            for xml, file, start in zip(b.column("value"), b.column("file_path").to_pylist(), b.column("file_block_start").to_pylist(), strict=True):
                if (file, start) != held:
                    held, n, first = (file, start), 0, before[_full(file)] + start << SHIFT
                whole, bad = xml.as_py() + b"</page>", []
                for p in parse_pages(whole, with_text=with_text, with_timestamp=with_timestamp, bad=bad):
                    rows.append((first + n, *p, None))
                    size += len(whole)
                    n += 1
                for _ in bad if problems else ():
                    rows.append((first + n, *[None] * 6, "page"))
                    n += 1
                if size > 4 << 20:
                    yield _arrow(rows, columns)
                    rows, size = [], 0
            if rows:
                yield _arrow(rows, columns)

    return pieces.mapInArrow(run, PAGES + (", problem string" if problems else ""))


def ranges_of(lines: DataFrame, size: int) -> DataFrame:
    """start, length of the streams named by index lines (offset:id:title); lines that are not such are skipped.

    The index holds about one offset for a hundred pages, and its order is global, so this window is over some 10^5 rows.
    """
    starts = _starts(lines).select("start").distinct()
    return starts.select("start", F.expr(f"lead(start, 1, {size}L) over (order by start) - start as length"))


def _starts(lines: DataFrame, *more: str) -> DataFrame:
    parts = F.split("value", ":", 3)
    return lines.where(F.size(parts) == 3).select(*more, parts[0].try_cast("bigint").alias("start")).where("start is not null")


def read_multistream(spark: SparkSession, dump: str | list[str], index: str | list[str], *, with_text: bool = True, with_timestamp: bool = True, tasks: int | None = None, problems: bool = False) -> DataFrame:
    """Pages of a multistream dump of any number of files, each with its index; each task takes ranges of streams. Positions follow the order of the files.

    An index that names no stream of its dump is an error, as is a dump without one.
    """
    dumps, indexes = ([x] if isinstance(x, str) else list(x) for x in (dump, index))
    sizes, own = [_listed(spark, [d])[0][1] for d in dumps], [_listed(spark, [i])[0][0] for i in indexes]
    before = list(accumulate(sizes, initial=0))
    names = spark.createDataFrame([(i, n, s) for n, (i, s) in enumerate(zip(own, sizes, strict=True))], "name string, file int, size long")  # one row for each file
    lines = spark.read.text(indexes).withColumn("name", F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))).join(F.broadcast(names), "name")
    starts = _starts(lines, "file", "size").where(F.col("start").between(0, F.col("size") - 1)).distinct()
    ranges = starts.select("start", F.expr("coalesce(lead(start) over (partition by file order by start), size) - start as length"), "file")
    named = {r.file for r in ranges.select("file").distinct().collect()}  # one row for each file
    if lost := [i for n, i in enumerate(indexes) if n not in named]:
        raise ValueError(f"no streams in {lost}")
    tasks = tasks or spark.sparkContext.defaultParallelism * 4
    columns = COLUMNS if problems else COLUMNS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, f = None, None
        for b in batches:
            for start, length, n in zip(b.column("start").to_pylist(), b.column("length").to_pylist(), b.column("file").to_pylist(), strict=True):
                if n != held:
                    fs, at = _opened(dumps[n])
                    held, f = n, fs.open_input_file(at)
                packed = f.read_at(length, start)  # an error of the storage fails the task, which is run again
                bad, what = [], "page"
                try:
                    xml = bz2.decompress(packed)
                except (OSError, ValueError):
                    xml, bad, what = b"", [1], "stream"
                first = before[n] + start << SHIFT
                rows = [(first + i, *p, None) for i, p in enumerate(parse_pages(xml, with_text=with_text, with_timestamp=with_timestamp, bad=bad))]
                if problems:
                    rows += [(first + i, *[None] * 6, what) for i in bad]
                if rows:
                    yield _arrow(rows, columns)

    pages = ranges.repartitionByRange(tasks, "file", "start").mapInArrow(run, PAGES + (", problem string" if problems else ""))
    if not problems:
        return pages
    return pages.unionByName(_odd(lines))


def _odd(lines: DataFrame) -> DataFrame:
    """A row for each line that is none of an index."""
    odd = lines.where("size(split(value, ':', 3)) < 3 or try_cast(split(value, ':', 3)[0] as bigint) is null")
    return odd.select(*(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in PAGES.split(", ")), F.lit("index line").alias("problem"))


def odd_lines(spark: SparkSession, index: str) -> DataFrame:
    return _odd(spark.read.text(index))


# --- the data source -------------------------------------------------------------------------------------------------

_STREAM = re.compile(rb"BZh[1-9]1AY&SY|BZh[1-9]\x17\x72\x45\x38\x50\x90")
_TAIL, _BEGUN = 16, re.compile(rb"<(p(a(g(e)?)?)?)?\Z")


@dataclass
class Range(InputPartition):
    """Bytes start to end of a file, before which the dump has ``before`` bytes."""

    path: str
    start: int
    end: int
    before: int


class _Cutter:
    """Pages in bytes that come piece by piece: (place of the start tag in all that came, the page's bytes, or None if it has no end)."""

    def __init__(self) -> None:
        self.held, self.base = b"", 0

    @property
    def pending(self) -> bool:
        """Whether a start tag, or what may be the beginning of one, waits for more."""
        return _START.search(self.held) is not None or _BEGUN.search(self.held) is not None

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple[int, bytes | None]]:
        self.held += data
        at = 0
        while m := _START.search(self.held, at):
            following = _START.search(self.held, m.end())
            end = _END.search(self.held, m.end(), following.start() if following else len(self.held))
            if end:
                yield self.base + m.start(), self.held[m.start() : end.end()]
                at = end.end()
            elif following or last:
                yield self.base + m.start(), None
                at = following.start() if following else len(self.held)
            else:
                at = m.start()
                break
        else:
            at = max(at, len(self.held) - _TAIL)  # a tag that has only begun
        self.held, self.base = self.held[at:], self.base + at


def _plain_pages(f, r: Range, piece: int) -> Iterator[tuple[int, bytes | None]]:
    """(position, page) of the pages whose start tag begins in the range."""
    cut, at, size = _Cutter(), r.start, f.size()
    while at < size and (at < r.end + _TAIL or cut.pending):
        data = f.read_at(min(piece, size - at), at)
        at += len(data)
        for place, page in cut.feed(data, at >= size):
            if r.start + place >= r.end:
                return
            yield r.before + r.start + place << SHIFT, page


def _streams(f, r: Range, piece: int) -> Iterator[tuple[int, bytes | None]]:
    """(where its stream begins, unpacked bytes) piece by piece, of the streams that begin in the range and, as long as they are asked for, of those after; None: the stream is damaged."""
    size, at = f.size(), r.start
    window, base = b"", at

    def upto(end: int) -> bool:
        """Have the window reach to a place, if the file does."""
        nonlocal window
        if base + len(window) < end and base + len(window) < size:
            window += f.read_at(min(max(piece, end - base - len(window)), size - base - len(window)), base + len(window))
        return base + len(window) >= min(end, size)

    while at < size:
        window, base = window[at - base :] if 0 <= at - base <= len(window) else b"", at
        upto(at + 10)
        m = _STREAM.search(window)
        if not m:
            if at >= r.end:
                return
            at = max(at + 1, base + len(window) - 9)
            if base + len(window) >= size:
                return
            continue
        begin = base + m.start()
        window, base = window[m.start() :], begin
        packed, used, unpacked = bz2.BZ2Decompressor(), 0, True
        try:
            while not packed.eof:
                if packed.needs_input:
                    upto(base + used + piece)
                    data = window[used : used + piece]
                    if not data:
                        raise EOFError
                    used += len(data)
                else:
                    data = b""
                if out := packed.decompress(data, piece):
                    yield begin, out
                if used > piece and not packed.eof:  # what was taken need not be held
                    window, base, used = window[used:], base + used, 0
            at = base + used - len(packed.unused_data)
        except (OSError, EOFError, ValueError):
            yield begin, None
            at = begin + 1


def _packed_pages(f, r: Range, piece: int) -> Iterator[tuple[int, bytes | None | str]]:
    """(position, page) of the pages that begin in streams of the range; "stream" in place of a page: a damaged one."""
    cut, marks, n = _Cutter(), [], 0
    total = 0
    for begin, data in _streams(f, r, piece):
        if begin >= r.end and not (marks and cut.pending):
            return
        if data is None:
            if begin < r.end:
                yield r.before + begin << SHIFT, "stream"
            for place, page in cut.feed(b"", True):
                yield _place(marks, place, r), page
            continue
        if not marks or marks[-1][1] != begin:
            marks.append([total, begin, 0])
            del marks[:-2]  # a page that is cut now began in the stream before, at most
        total += len(data)
        for place, page in cut.feed(data):
            if begin >= r.end and place >= marks[-1][0] and marks[-1][1] == begin:
                return
            yield _place(marks, place, r), page
    for place, page in cut.feed(b"", True):
        yield _place(marks, place, r), page


def _place(marks: list[list[int]], place: int, r: Range) -> int:
    mark = next((m for m in reversed(marks) if m[0] <= place), marks[0])
    mark[2] += 1
    return (r.before + mark[1] << SHIFT) + mark[2] - 1


_TESTS = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b, In: lambda a, b: a in b}


class DumpReader(DataSourceReader):
    """Reads the columns of the schema that was asked for; text and timestamps that are not in it are not kept by the parser."""

    def __init__(self, schema: StructType, options: dict):
        self.columns = list(schema.names)
        if odd := set(self.columns) - set(COLUMNS):
            raise ValueError(f"a dump has no columns {sorted(odd)}")
        self.problems, self.tests = "problem" in self.columns, []
        self.split, self.piece = int(options.get("splitbytes", 64 << 20)), int(options.get("piecebytes", 1 << 20))
        self.exact = bool(options.get("exact"))
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of id and ns are applied before a page's row is made; the rest goes back to Spark."""
        for f in filters:
            attribute = getattr(f, "attribute", None)
            if type(f) in _TESTS and attribute in (("id",), ("ns",)) and not self.problems:
                self.tests.append((attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Range]:
        out, before = [], 0
        for path in self.paths:
            fs, at = _opened(path)
            info = fs.get_file_info(at)
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(path)
            kinds = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(at))
            scheme = path[: len(path) - len(at)] if path.endswith(at) else ""
            for x in sorted((x for x in kinds if x.type == pafs.FileType.File and not x.base_name.startswith(("_", ".")) and "-index" not in x.base_name), key=lambda x: x.path):
                cuts = [*range(0, x.size, self.split), x.size]
                out += [Range(scheme + x.path, a, b, before) for a, b in zip(cuts, cuts[1:], strict=False)]
                before += x.size
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, at = _opened(partition.path)
        fits = [(COLUMNS.index(c), _TESTS[kind], value) for c, kind, value in self.tests]
        rows, size = [], 0
        with fs.open_input_file(at) as f:
            if self.exact and not _STREAM.match(f.read_at(10, partition.start)):
                rows.append((partition.before + partition.start << SHIFT, *[None] * 6, "stream"))
            pages = (_packed_pages if partition.path.endswith(".bz2") else _plain_pages)(f, partition, self.piece)
            for pos, piece in pages:
                page = _page(piece, "text" in self.columns, "timestamp" in self.columns) if isinstance(piece, bytes) else None
                if page is None and not self.problems:
                    continue
                row = (pos, *page, None) if page else (pos, *[None] * 6, piece or "page" if isinstance(piece, str) else "page")
                if all(row[i] is not None and test(row[i], value) for i, test, value in fits):
                    rows.append(row)
                    size += len(piece or b"")
                if size > 4 << 20:
                    yield _arrow(rows, self.columns)
                    rows, size = [], 0
        if rows:
            yield _arrow(rows, self.columns)


class DumpSource(DataSource):
    """wikidump: options path (a file, or a folder of them) or paths (a JSON list), splitbytes (of a partition, 64 MB). Columns: PAGES and, if asked for, problem."""

    @classmethod
    def name(cls) -> str:
        return "wikidump"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema: StructType) -> DumpReader:
        return DumpReader(schema, self.options)


def dump_source(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed into it."""
    spark.dataSource.register(DumpSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


#: Bytes of a dump that a page takes, for batches where no index tells: an estimate that sets their size only.
PAGE_BYTES = 4096
PLAN = "path string, start long, end long, before long, batch long"


def batches_of(spark: SparkSession, dump: str, index: str | None, pages: int) -> DataFrame:
    """PLAN: byte ranges of a dump, in batches of about so many pages: by the index where there is one, else of equal ranges."""
    files = _listed(spark, [dump])
    if index:
        ((path, size),) = files
        lines = _starts(spark.read.text(index)).where(F.col("start").between(0, size - 1)).groupBy("start").agg(F.count(F.lit(1)).alias("n"))
        # One row for each stream, some 10^5 of them, so both windows are over one small table.
        ranges = lines.select("start", F.expr(f"lead(start, 1, {size}L) over (order by start) as end"), F.expr("sum(n) over (order by start) - n as held"))
        return ranges.select(F.lit(path).alias("path"), "start", "end", F.lit(0).cast("long").alias("before"), F.expr(f"held div {pages}").alias("batch"))
    reader = DumpReader(StructType.fromDDL(PAGES), {"paths": json.dumps([f for f, _ in files]), "splitbytes": max(pages * PAGE_BYTES // 8, 1 << 20)})
    rows = [(r.path, r.start, r.end, r.before, n // 8) for n, r in enumerate(reader.partitions())]  # one for each range
    return spark.createDataFrame(rows, PLAN)


def read_ranges(ranges: DataFrame, exact: bool) -> DataFrame:
    """PAGES and problem of the ranges of a plan; exact: each begins where an index says that a stream does."""
    schema = StructType.fromDDL(PAGES + ", problem string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = DumpReader(schema, {"path": "", "exact": exact})
        for b in batches:
            for r in b.to_pylist():
                yield from reader.read(Range(r["path"], r["start"], r["end"], r["before"]))

    return ranges.select("path", "start", "end", "before").mapInArrow(run, schema)


def read_dump(spark: SparkSession, dump: str, *, index: str | None = None, with_text: bool = True, problems: bool = False) -> DataFrame:
    """Pages of a dump, by its index where one is given or lies beside it and pyarrow can open the file, else by splits."""
    (path, _), *_ = _listed(spark, [dump])
    index = index or index_path(dump)
    if index and _exists(path):
        return read_multistream(spark, dump, index, with_text=with_text, problems=problems)
    return read_split(spark, dump, with_text=with_text, problems=problems)


_NOT_XML = re.compile("[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")


def page_xml(page_id: int, title: str, ns: int | None, redirect_to: str | None, timestamp: str | None, text: str | None) -> str:
    """One page of a dump. Characters that XML cannot hold become U+FFFD."""
    body = lambda x: escape(_NOT_XML.sub("\ufffd", x), {"\r": "&#13;"})
    parts = [f"<title>{body(title)}</title>"] + ([f"<ns>{ns}</ns>"] if ns is not None else []) + [f"<id>{page_id}</id>"]
    if redirect_to is not None:
        parts.append(f"<redirect title={quoteattr(_NOT_XML.sub(chr(0xFFFD), redirect_to), {chr(13): '&#13;', chr(10): '&#10;', chr(9): '&#9;'})} />")
    revision = ([f"<timestamp>{body(timestamp)}</timestamp>"] if timestamp is not None else []) + ([f'<text xml:space="preserve">{body(text)}</text>'] if text is not None else ["<text />"])
    return f"<page>{''.join(parts)}<revision>{''.join(revision)}</revision></page>\n"


#: Bytes of a batch's pages that are Python objects at a time; a longer page is taken alone and whole.
PIECE_BYTES = 1 << 20


def _row_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of batches whose column text is the last, PIECE_BYTES of text or one row at a time."""
    for b in batches:
        at, held = 0, 0
        for i, n in enumerate([*pc.fill_null(pc.binary_length(b.column("text")), 0).to_pylist(), PIECE_BYTES]):
            if i > at and held + n > PIECE_BYTES:
                yield list(zip(*(c.to_pylist() for c in b.slice(at, i - at).columns), strict=True))
                at, held = i, 0
            held += n


def write_xml(pages: DataFrame, folder: str, compression: str = "none") -> None:
    """Pages as XML in files of Spark's text sink, one root element each, plain or packed as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = lambda x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["value"])
        yield lines(["<mediawiki>"])
        for piece in _row_pieces(batches):
            yield lines([page_xml(*row).rstrip("\n") for row in piece])
        yield lines(["</mediawiki>"])

    rows = pages.where("id is not null and title is not null").select("id", "title", F.col("ns").cast("string").alias("ns"), "redirect_to", "timestamp", "text")
    rows.mapInArrow(run, "value string").write.option("maxRecordsPerFile", 0).option("compression", compression).text(folder)


#: Pages in one file of a dump that is written here, about: a task writes a file, so its share does not grow with the dump.
FILE_PAGES = 10_000


def write_multistream(pages: DataFrame, folder: str, *, files: int, per_stream: int = 100, per_file: int = FILE_PAGES) -> list[tuple[str, str, int]]:
    """(dump, index, pages) of the files written: pages in order of pos, ``per_stream`` in each bz2 stream. files: at least, where pages are enough; more where there are more than ``per_file`` pages for each.

    Each task attempt writes files under names of its own and reports them, and only reported ones are returned (one short row for each file).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dump = f"{folder}/part-{uuid.uuid4().hex}-multistream.xml.bz2"
        fs, at = _opened(dump)
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        held, lines, offset, n, first = [], [], 0, 0, None
        out = None

        def flush() -> None:
            nonlocal offset
            packed = bz2.compress("".join(x for _, _, x in held).encode())
            lines.extend(f"{offset}:{i}:{t}\n" for i, t, _ in held)
            out.write(packed)
            offset += len(packed)
            held.clear()

        for piece in _row_pieces(batches):
            for pos, page_id, title, *rest in piece:
                if out is None:
                    out, first = fs.open_output_stream(at, compression=None), pos
                held.append((page_id, title.replace("\n", " "), page_xml(page_id, title, *rest)))
                n += 1
                if len(held) == per_stream:
                    flush()
        if out is None:
            return
        if held:
            flush()
        out.close()
        index = dump.removesuffix(".xml.bz2") + "-index.txt.bz2"
        with fs.open_output_stream(_opened(index)[1], compression=None) as f:
            f.write(bz2.compress("".join(lines).encode()))
        yield pa.RecordBatch.from_pylist([{"first": first, "dump": dump, "index": index, "pages": n}])

    rows = pages.where("id is not null and title is not null").select("pos", "id", "title", "ns", "redirect_to", "timestamp", "text")
    files = max(files, -(-rows.select("pos").count() // per_file))
    done = rows.repartitionByRange(files, "pos").sortWithinPartitions("pos").mapInArrow(run, "first long, dump string, index string, pages long").collect()
    return [(r.dump, r["index"], r.pages) for r in sorted(done)]


__all__ = ["PAGES", "DumpSource", "dump_source", "index_path", "parse_pages", "page_xml", "ranges_of", "read_dump", "read_multistream", "read_split", "read_xml", "write_multistream", "write_xml"]
