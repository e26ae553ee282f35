"""WARC archives: a writer of one gzip member for each record, and a splittable reader.

Reader: archives are cut into byte ranges, one task row each. A task looks for the gzip magic in its range and decodes the
start of each candidate; the first that turns out as a WARC header is where the range enters the chain of members, each of which
begins where the one before ends. A task owns the records that start inside its range and reads past its end to finish the last.
Compressed bytes that look like the magic fail the decoding. A whole record that lies inside a payload (an archive in an archive,
stored uncompressed) does not: so entries are checked against the chain from the file's first byte, by where
the range before was left, and ranges that entered elsewhere are measured again from there (``spans``). What the reader returns
is therefore what one pass from the first byte returns.

Damage: a member that is cut off or fails its checksum costs itself alone. The reader goes on at the next
candidate after its first byte, and ``damaged`` lists the places and lengths that were passed over. Records inside the payload of a
damaged member are then found as records.

Writer: equal payloads (by SHA-1) of at least ``least`` bytes are stored once, as the response of the largest page_id; others
are revisits that refer to it. Digests are grouped before any payload moves, and payloads then meet them in one join
that adaptive execution can split. Where pyarrow can open the folder, each task attempt writes files under names of its own and
reports them; only reported files are read, so lost executors and repeated attempts leave no record twice. Any other Hadoop file system
is written through Spark's own committed text sink, in chunks of whole members that an empty member ends. There, too, byte ranges are read:
Spark's text source cuts files into them, with the gzip magic as line separator, so each range begins at its first magic
and reads past its end to finish the last piece. Pieces are joined to members; a file of which any range
has a piece that belongs to no whole member (the magic inside compressed bytes at a border, an archive in a payload, damage) is read again
in one pass from its first byte. Spark would not cut files named .gz or .gzip, so sunk archives are named ``.warc.members`` (of gzip); others' ``.warc.gz``
files on such a file system are still read by the binaryFile source, a task for each file.

Revisits hold no payload: ``resolved`` gives them the length and digest that were computed of the response they refer to.

Defined results: a null html is an empty payload; a null url has no target line, and control characters in one are escaped; repeated rows give a record
each, and rows that share id and payload with the response are responses too; a null page_id is never referred to unless all ids of its payload are null; an empty
table gives no rows; a payload is held whole by one worker, whatever its length; other columns, also of clashing names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, pieces, shared_dir, stored, table

MAGIC, EOL = b"\x1f\x8b\x08", b"\r\n"
URN = "urn:loomgraph:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE_BYTES, FILE_BYTES, OUT_BYTES, STEP_BYTES = 16 << 20, 1 << 30, 8 << 20, 1 << 18
#: Tasks of a reader at most; beyond, each takes several ranges.
MOST_TASKS = 100_000
#: The committed sink: bytes of a chunk at least, and chunks in a file at most.
CHUNK_BYTES, CHUNKS_A_FILE = 1 << 20, 64
#: The suffix of its files.
SUNK = ".warc.members"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, is_response: bool, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One record, not yet compressed. The HTTP head of a revisit still tells the payload's length."""
    head = EOL.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = head + payload if is_response else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{base32(sha1)}")
    if not is_response:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{'' if refers_to is None else refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + EOL + EOL + block + EOL + EOL


def packed(raw: bytes, level: int = 6) -> bytes:
    """One gzip member."""
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def openable(path: str) -> bool:
    """Whether pyarrow knows the path's scheme and can reach it."""
    try:
        opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _members(batches: Iterator[pa.RecordBatch], least: int, level: int) -> Iterator[bytes]:
    for b in pieces(batches, "html"):
        for page_id, url, html, sha1, to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "first")), strict=True):
            payload = html.encode()
            yield packed(record(page_id, url, payload, sha1, to, len(payload) < least or page_id == to), level)


def _own_files(rows: DataFrame, folder: str, least: int, level: int) -> DataFrame:
    """Files opened by pyarrow, as each task attempt reports them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, n, done = None, "", 0, 0, []
        for member in _members(batches, least, level):
            if out is None:
                path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
                fs, at = opened(path)
                fs.create_dir(at.rpartition("/")[0], recursive=True)
                out, size, n = fs.open_output_stream(at, compression=None), 0, 0  # members are compressed here
            out.write(member)
            size, n = size + len(member), n + 1
            if size >= FILE_BYTES:
                out.close()
                done.append((path, size, n))
                out = None
        if out is not None:
            out.close()
            done.append((path, size, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path", "bytes", "records"])

    return rows.mapInArrow(run, "path string, bytes long, records long").repartition(1)  # one short row for each file


def _sunk_files(rows: DataFrame, folder: str, least: int, level: int) -> DataFrame:
    """Files of Spark's text sink: its line separator, an empty gzip member, ends each chunk of members. Then they get their names."""
    spark, empty = rows.sparkSession, packed(b"", level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for member in _members(batches, least, level):
            held.append(member)
            size += len(member)
            if size >= CHUNK_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["b"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["b"])

    work = f"{folder}/.work-{uuid.uuid4().hex}"
    chunks = rows.mapInArrow(run, "b binary").select(F.col("b").cast("string").alias("value"))
    chunks.write.options(lineSep=empty.decode("latin-1"), encoding="ISO-8859-1", compression="none", maxRecordsPerFile=CHUNKS_A_FILE).text(work)
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(work)
    fs, files = at.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for f in fs.listStatus(at):
        if f.getPath().getName().startswith("part-") and f.getLen():
            path = f"{folder}/{f.getPath().getName().removesuffix('.txt')}{SUNK}"
            if not fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(path)):
                raise OSError(f"cannot name {path}")
            files.append((path, f.getLen(), None))
    fs.delete(at, True)
    return spark.createDataFrame(files, "path string, bytes long, records long")


def write_warc(pages: DataFrame, folder: str, *, least: int = 0, level: int = 6, sink: bool | None = None) -> DataFrame:
    """Write pages(page_id, url, html) to folder; the files written: path, bytes, records (null from the sink). sink: use Spark's; by default where pyarrow cannot open the folder."""
    attach(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1(F.col("html").cast("binary"))))
    first = rows.groupBy("sha1").agg(F.max("page_id").alias("first"))
    rows = rows.join(first, "sha1").select("page_id", "url", "html", "sha1", "first")
    sink = not openable(folder) if sink is None else sink
    return stored((_sunk_files if sink else _own_files)(rows, folder, least, level), "archives")


class Source:
    """Bytes of one archive from a place on, fetched as needed."""

    def __init__(self, read, size: int):
        self.read, self.size, self.held, self.at = read, size, b"", 0

    def span(self, lo: int, hi: int) -> bytes:
        """Bytes lo to hi, which never go back beyond what a caller has finished with."""
        hi = min(hi, self.size)
        if lo < self.at or not self.held:
            self.held, self.at = b"", lo
        if hi > self.at + len(self.held):
            have = self.at + len(self.held)
            want = min(max(hi, have + STEP_BYTES), self.size)
            self.held, self.at = self.held[lo - self.at :] + self.read(have, want - have), lo
        return self.held[lo - self.at : hi - self.at]


def _begins(source: Source, at: int) -> bool:
    """Whether the start of a member at a place decodes to a WARC header."""
    pack, out, place = zlib.decompressobj(31), b"", at
    while len(out) < 7 and not pack.eof and place < source.size:
        piece = source.span(place, place + (1 << 9))
        place += len(piece)
        try:
            out += pack.decompress(piece, 64)
        except zlib.error:
            return False
    return out.startswith(b"WARC/1.")


def _candidate(source: Source, at: int, end: int) -> int | None:
    """The first place in [at, end) where a record seems to begin."""
    while at < end:
        window = source.span(at, min(at + STEP_BYTES, end) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += hit
        if at < end and _begins(source, at):
            return at
        at += 1
    return None


def _member(source: Source, at: int) -> tuple[bytes, int] | None:
    """What the member at a place holds, and the place after it; None if it is damaged or no record (an empty one may stand between records)."""
    pack, out, place = zlib.decompressobj(31), [], at
    known = 0
    while not pack.eof and place < source.size:
        piece = source.span(place, place + (1 << 12 if not known else STEP_BYTES))
        try:
            got = pack.decompress(piece)
        except zlib.error:
            return None
        place += len(piece)
        out.append(got)
        if known < 7:
            known = sum(map(len, out))
            if known >= 7 and not b"".join(out).startswith(b"WARC/1."):
                return None
    return (b"".join(out), place - len(pack.unused_data)) if pack.eof and (known >= 7 or not known) else None


def chain(source: Source, at: int, end: int) -> Iterator[tuple[int, int, bytes | None]]:
    """(start, after, record; None for damage) from a place on, until a member starts at ``end`` or beyond."""
    end = min(end, source.size)
    while at < end:
        if found := _member(source, at):
            raw, after = found
            if raw:
                yield at, after, raw
        else:
            after = _candidate(source, at + 1, source.size)
            after = source.size if after is None else after
            yield at, after, None
        at = after


FIELDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean, record_id string"


def parsed(raw: bytes) -> tuple[tuple, bytes]:
    """The fields of a record and its payload; intact: the payload has the digest that the record states (null: it states none)."""
    head, _, rest = raw.partition(EOL + EOL)
    lines = dict(line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    fields = {k.strip().lower(): v.strip() for k, v in lines.items()}
    length = fields.get("content-length", "")
    block = rest[: int(length)] if length.isdecimal() else rest
    is_http = fields.get("content-type", "").startswith("application/http")
    http, _, payload = block.partition(EOL + EOL) if is_http else (b"", b"", block)
    id_of = lambda name: int(m[1]) if (m := re.fullmatch(rf"<{URN}(-?\d+)>", fields.get(name, ""))) else None
    kind, stated, name = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:"), fields.get("warc-record-id")
    if kind == "revisit":
        told = re.search(rb"(?i)^content-length: *(\d+)", http, re.MULTILINE)
        return (id_of("warc-record-id"), fields.get("warc-target-uri"), kind, int(told[1]) if told else None, stated, id_of("warc-refers-to"), True, name), b""
    digest = base32(hashlib.sha1(payload).digest())
    return (id_of("warc-record-id"), fields.get("warc-target-uri"), kind, len(payload), digest, None, digest == stated if stated else None, name), payload


def _each_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Source, dict]]:
    for b in batches:
        for row in b.to_pylist():
            fs, at = opened(row["path"])
            with fs.open_input_file(at) as f:
                yield Source(lambda lo, n, f=f: f.read_at(n, lo), row["bytes"]), row


def _dealt(rows: DataFrame, archives: DataFrame, range_bytes: int) -> DataFrame:
    """Ranges over tasks, one each: their rows are small, so adaptive execution would put them all into one if no number were named."""
    n = archives.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.lit(1))).first()[0]
    return rows.repartition(min(max(1, int(n)), MOST_TASKS), "path", "start")


SPANS = "path string, bytes long, start long, entry long, exit long, damage array<struct<at:bigint,bytes:bigint>>"


def spans(spark: SparkSession, archives: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """SPANS: for each range of archives(path, bytes) its first record (entry; null: none starts there), the first member after it (exit), and the damage between."""
    attach(spark)
    kind = pa.list_(pa.struct([("at", pa.int64()), ("bytes", pa.int64())]))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source, row in _each_range(batches):
            end = min(row["start"] + range_bytes, row["bytes"])
            entry = row["entry"] if row["told"] else _candidate(source, row["start"], end)
            exit_, damage = None, []
            if entry is not None:
                exit_ = entry
                for at, after, raw in chain(source, entry, end):
                    exit_ = after
                    if raw is None:
                        damage.append({"at": at, "bytes": after - at})
            yield pa.RecordBatch.from_arrays([pa.array([row["path"]]), *(pa.array([x], pa.int64()) for x in (row["bytes"], row["start"], entry, exit_)), pa.array([damage], kind)], ["path", "bytes", "start", "entry", "exit", "damage"])

    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {range_bytes}L)")).alias("start"))
    todo = ranges.select("*", F.lit(None).cast("long").alias("entry"), F.lit(False).alias("told"))
    held = stored(_dealt(todo, archives, range_bytes).mapInArrow(measured, SPANS), "spans")
    while True:
        # Each range must be entered where the one before was left; the first of a file at its first byte.
        left = F.expr("coalesce(max(exit) over (partition by path order by start rows between unbounded preceding and 1 preceding), 0L)")
        placed = held.withColumn("left", left).withColumn("wanted", F.when(F.col("left") < F.least(F.col("start") + range_bytes, "bytes"), F.col("left")))
        wrong = placed.where("not (entry <=> wanted)")
        if wrong.isEmpty():
            return held
        again = wrong.select("path", "bytes", "start", F.col("wanted").alias("entry"), F.lit(True).alias("told"))
        again = _dealt(again, archives, range_bytes).mapInArrow(measured, SPANS)
        held = stored(placed.where("entry <=> wanted").select(*held.columns).unionByName(again), "spans")


def damaged(spans_: DataFrame) -> DataFrame:
    """path, at, bytes of what a reader passes over."""
    return spans_.select("path", F.explode("damage").alias("d")).select("path", "d.*")


def _shape(payload: bool) -> tuple[str, Callable[[list], pa.RecordBatch]]:
    """The schema of records and what makes a batch of rows (all fields and the payload, which is left out unless asked for)."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in FIELDS.split(", ")] + ["payload"]
    n = len(names) if payload else len(names) - 1

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(n)], names[:n])

    return FIELDS + (", payload binary" if payload else ""), batch


def read_warc(spark: SparkSession, archives: DataFrame, *, payload: bool = True, range_bytes: int = RANGE_BYTES, whole: bool = False) -> DataFrame:
    """All records of archives(path, bytes), or (content) if they are read whole: FIELDS, and the payload if asked for."""
    attach(spark)
    schema, batch = _shape(payload)

    def out(sources: Iterator[tuple[Source, int, int]]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for source, entry, end in sources:
            for _, _, raw in chain(source, entry, end):
                if raw is None:
                    continue
                fields, body = parsed(raw)
                rows.append((*fields, body))
                size += len(body) if payload else 0
                if size >= OUT_BYTES or len(rows) >= 4096:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return out((source, row["entry"], row["start"] + range_bytes) for source, row in _each_range(batches))

    def by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return out((Source(lambda lo, n, c=c: c[lo : lo + n], len(c)), 0, len(c)) for b in batches for c in b.column("content").to_pylist())

    if whole:
        return archives.mapInArrow(by_file, schema)
    entered = spans(spark, archives, range_bytes=range_bytes).where("entry is not null").select("path", "bytes", "start", "entry")
    return _dealt(entered, archives, range_bytes).mapInArrow(by_range, schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes | None]]:
    """(path, record; None: the range has a piece that belongs to no whole member) from the pieces b between magics of ranges (path, start), each in order."""
    at, pack, out, lost = None, None, [], False
    for b in batches:
        for piece, *here in zip(*(b.column(c).to_pylist() for c in ("b", "path", "start")), strict=True):
            if here != at:
                if pack:
                    yield at[0], None
                at, pack, lost = here, None, False
                if here[1] == 0:  # what stands before the first magic of the file
                    if lost := piece != b"":
                        yield here[0], None
                    continue
            if lost:
                continue
            if not pack:
                pack, out = zlib.decompressobj(31), []
            try:
                out.append(pack.decompress(MAGIC + piece))
            except zlib.error:
                lost = True
            if pack.eof:
                raw = b"".join(out)
                lost = bool(pack.unused_data) or not (raw.startswith(b"WARC/1.") or not raw)
                if raw and not lost:
                    yield here[0], raw
                pack = None
            if lost:
                yield here[0], None
                pack = None
    if pack:
        yield at[0], None


def by_splits(spark: SparkSession, folder: str, *, payload: bool = True) -> DataFrame:
    """The records of the SUNK archives in a folder, by the ranges of Spark's text source; files that it cannot tell apart, in one pass each."""
    attach(spark)
    schema, batch = _shape(payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, paths, size = [], [], 0

        def flushed() -> pa.RecordBatch:
            return batch(rows).append_column("path", pa.array(paths, pa.string())).append_column("broken", pa.array([r[-1] is None for r in rows]))

        for path, raw in _joined(pieces(batches, "b")):
            fields, body = parsed(raw) if raw else ((None,) * 8, None)
            rows.append((*fields, body))
            paths.append(path)
            size += len(body or b"") if payload else 0
            if size >= OUT_BYTES or len(rows) >= 4096:
                yield flushed()
                rows, paths, size = [], [], 0
        if rows:
            yield flushed()

    cut = spark.read.options(lineSep=MAGIC.decode("latin-1"), encoding="ISO-8859-1", pathGlobFilter=f"*{SUNK}").text(folder)
    cut = cut.select(F.col("value").cast("binary").alias("b"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    held = stored(cut.mapInArrow(run, f"{schema}, path string, broken boolean"), "records")
    broken = held.where("broken").select("path").distinct()
    again = sorted(unquote(r.path.rpartition("/")[2]) for r in broken.collect())
    names = [x for x in held.columns if x not in ("path", "broken")]
    if not again:
        return held.select(*names)
    whole = spark.read.format("binaryFile").load([f"{folder}/{x}" for x in again]).select("content")
    return held.join(F.broadcast(broken), "path", "left_anti").select(*names).unionByName(read_warc(spark, whole, payload=payload, whole=True))


def resolved(records: DataFrame) -> DataFrame:
    """records with payload_bytes and payload_digest of each revisit as computed of the response that it refers to; intact: there is one of the stated digest, itself intact, as long as the revisit tells."""
    held = stored(records.drop("payload"), "records")
    to = held.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"))
    to = to.agg(F.max("payload_bytes").alias("n"), F.min(F.coalesce("intact", F.lit(True))).alias("good"))
    revisits = held.where("record_type = 'revisit'").withColumnRenamed("payload_digest", "stated").join(to, ["refers_to", "stated"], "left")
    good = F.coalesce(F.col("good") & F.col("n").eqNullSafe(F.col("payload_bytes")), F.lit(False))
    revisits = revisits.withColumns({"payload_bytes": F.coalesce("n", "payload_bytes"), "payload_digest": F.col("stated"), "intact": good})
    return held.where("not record_type <=> 'revisit'").unionByName(revisits.select(*held.columns))


def listed(spark: SparkSession, folder: str, *, payload: bool = True, sink: bool | None = None) -> DataFrame:
    """The records of all archives in a folder, by ranges; those named .warc.gz where pyarrow cannot open the scheme, by file."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    files = [(f.getPath().toString(), f.getLen()) for f in found if f.getPath().getName().endswith((".warc.gz", SUNK))]
    if not openable(files[0][0] if files else folder) if sink is None else sink:
        cut = by_splits(spark, folder, payload=payload)
        if all(path.endswith(SUNK) for path, _ in files):
            return cut
        whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("content")
        return cut.unionByName(read_warc(spark, whole, payload=payload, whole=True))
    return read_warc(spark, spark.createDataFrame(files, "path string, bytes long"), payload=payload)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    archives = write_warc(pages, folder)
    read = read_warc(spark, archives, payload=False) if openable(folder) else listed(spark, folder, payload=False)
    return resolved(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
d AS (SELECT p.page_id, n, p.h, first,
      [CAST('0x' || substr(p.h, 5 * i + 1, 5) AS BIGINT) FOR i IN range(8)] AS v FROM p JOIN m ON p.h = m.h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v[CAST(j // 4 + 1 AS INTEGER)] // CAST(power(32, 3 - j % 4) AS BIGINT) % 32 + 1 AS INTEGER), 1) FOR j IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, TRUE AS intact
FROM d
"""
