"""WARC archives as seekable Zstandard bundles.

``write_archive`` makes a WARC/1.1 record of every page. A payload of at least
LEAST bytes is stored once, in the ``response`` record of the smallest page id;
other pages with that payload become ``revisit`` records, which hold its
digest, length and the record they refer to. Only narrow columns (ids, digests,
lengths) meet for that decision; payloads move in one aggregation that keeps a
payload once for each digest, before the shuffle.

A bundle is a file of independent Zstandard frames of about FRAME bytes of
whole records. Its last frame is a skippable one with the seek table of the
public seekable format: compressed and plain size of every frame, then their
number, a descriptor and the magic number. The index maps a record to its
bundle, frame and the offset inside the frame's plain bytes, so ``fetch`` reads
and decompresses the frames of the asked records only, and ``read_archive``
deals ranges of frames to tasks, by the table in each footer.

Tasks write bundles straight into the shared folder, each attempt under a name
of its own; the index is a table that Spark commits. A bundle counts only if
the index names it, so what a lost executor left behind is never read. The
folder is opened with Arrow's file systems (local or shared mounts, HDFS, S3,
GCS).

Defined results: a null payload is empty; an empty or short payload is always
a response. A null id is larger than any other and its record refers to the
record, not to an id. Of rows that repeat the smallest id of a payload one is
the response and the others revisit it. Rows that are wholly equal have a
record each. A null url leaves the target out; control characters in a url are
percent-encoded, so no url can end a header. One record may be of any length:
it makes a frame of its own. An empty table writes no bundle. Columns other
than id, url and payload are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from indicata.llm.common import attach, discard, materialize, ship
from indicata.session import scratch_path

#: Shortest payload that is stored once only.
LEAST = 100
#: Plain bytes of a frame, compressed bytes of a bundle, and of a reader's range.
FRAME, BUNDLE, RANGE = 1 << 20, 256 << 20, 16 << 20
LEVEL = 3
#: Date of records where the caller names none (pages carry no time).
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the public formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

INDEX = ("page_id long, record_id string, bundle string, frame int, frame_start long, frame_size long, "
         "offset long, length long")
RECORD = ("page_id long, record_id string, record_type string, url string, payload_bytes long, "
          "payload_digest string, refers_to long, refers_to_record string, payload binary")


# -- one record ---------------------------------------------------------------

def record_id(page_id: int | None, row: int) -> str:
    """Name of a record: the page and the row, as equal rows have a record each."""
    return f"urn:page:{'none' if page_id is None else page_id}:{row}"


def page_of(record: str) -> int | None:
    name = record.split(":")[2]
    return None if name == "none" else int(name)


def clean_url(url: str) -> str:
    """A url that cannot end its header line."""
    return re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def header(kind: str, fields: list[tuple[str, str]], block: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {block}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record_bytes(record: str, url: str | None, digest: str, size: int, payload: bytes | None,
                 refers: str | None, date: str) -> bytes:
    """A response with its payload, or a revisit (no payload) of ``refers``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [("WARC-Record-ID", f"<{record}>"), ("WARC-Date", date), ("Content-Type", HTTP_TYPE),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        fields.insert(1, ("WARC-Target-URI", clean_url(url)))
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers}>")]
        return header("revisit", fields, len(http)) + http + b"\r\n\r\n"
    return header("response", fields, len(http) + len(payload)) + http + payload + b"\r\n\r\n"


def info_bytes(bundle: str, date: str) -> bytes:
    body = f"software: indicata\r\nformat: WARC File Format 1.1\r\nfilename: {bundle}\r\n".encode()
    fields = [("WARC-Record-ID", f"<urn:bundle:{bundle}>"), ("WARC-Date", date),
              ("Content-Type", "application/warc-fields")]
    return header("warcinfo", fields, len(body)) + body + b"\r\n\r\n"


def parse_record(data: memoryview, at: int) -> tuple[dict[str, str], memoryview, int]:
    """Fields and block of the record at ``at``, and where the next one starts."""
    end = _find(data, b"\r\n\r\n", at)
    lines = bytes(data[at:end]).decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(fields["Content-Length"])
    if bytes(data[stop:stop + 4]) != b"\r\n\r\n":
        raise ValueError(f"record at {at} does not end where it says")
    return fields, data[start:stop], stop + 4


def _find(data: memoryview, what: bytes, at: int) -> int:
    """Place of ``what``, looked for in growing steps (headers are short)."""
    step = 4096
    while True:
        i = bytes(data[at:at + step]).find(what)
        if i >= 0:
            return at + i
        if at + step >= len(data):
            raise ValueError("a header does not end")
        step *= 4


def read_record(fields: dict[str, str], block: memoryview, payloads: bool) -> tuple:
    """Values of RECORD; the payload of a response is held against its digest."""
    record = fields["WARC-Record-ID"][1:-1]
    end = _find(block, b"\r\n\r\n", 0) + 4
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(r"(?m)^Content-Length: (\d+)", bytes(block[:end]).decode()).group(1))
    refers, payload = fields.get("WARC-Refers-To"), None
    if fields["WARC-Type"] == "response":
        payload = block[end:]
        found = hashlib.sha256(payload).hexdigest()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"payload of {record} is damaged")
    refers = refers and refers[1:-1]
    return (page_of(record), record, fields["WARC-Type"], fields.get("WARC-Target-URI"), size, digest,
            refers and page_of(refers), refers,
            bytes(payload) if payloads and payload is not None else None)


# -- bundles ------------------------------------------------------------------

def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """Arrow's file system of a shared path, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pa.fs.LocalFileSystem(), path
    return pa.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


class BundleWriter:
    """Frames of whole records, written as they fill, and the seek table."""

    def __init__(self, folder: str, date: str):
        self.fs, folder = file_system(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.start = 0
        self.parts: list[bytes] = [info_bytes(self.name, date)]
        self.plain = len(self.parts[0])
        self.waiting: list[tuple] = []
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, page_id: int | None, record: str, data: bytes) -> list[tuple]:
        """Appends a record; index rows of the frame that it filled, if any."""
        self.waiting.append((page_id, record, self.plain, len(data)))
        self.parts.append(data)
        self.plain += len(data)
        return self.flush() if self.plain >= FRAME else []

    def flush(self) -> list[tuple]:
        if not self.waiting:
            return []
        frame = self.zstd.compress(b"".join(self.parts))
        self.out.write(frame)
        rows = [(page, record, self.name, len(self.sizes), self.start, len(frame), offset, length)
                for page, record, offset, length in self.waiting]
        self.sizes.append((len(frame), self.plain))
        self.start += len(frame)
        self.parts, self.plain, self.waiting = [], 0, []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        return rows


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame at the end of a bundle: where its frames are."""
    body = b"".join(struct.pack("<II", packed, plain) for packed, plain in sizes)
    body += struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(f: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of a bundle's frames, by its footer."""
    end = f.size()
    f.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE or flags & 0x80:
        raise ValueError("no seek table")
    f.seek(end - 9 - 8 * n)
    out, start = [], 0
    for packed, plain in struct.iter_unpack("<II", f.read(8 * n)):
        out.append((start, packed, plain))
        start += packed
    return out


def _plain(f: pa.NativeFile, start: int, packed: int) -> memoryview:
    f.seek(start)
    return memoryview(zstandard.ZstdDecompressor().decompress(f.read(packed)))


# -- Spark --------------------------------------------------------------------

def records_to_write(pages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``(page_id, row, url, digest, size, payload, refers)`` of every page, and
    the tables to discard once they are written. ``payload`` is null in
    revisits, ``refers`` in responses."""
    html = F.coalesce("html", F.lit(""))
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.sha2(html, 256).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"), html.cast("binary").alias("payload"))
    long = F.col("size") >= LEAST
    narrow = materialize(full.select(
        "page_id", F.monotonically_increasing_id().alias("row"), "url", "digest", "size",
        F.when(~long, F.col("payload")).alias("payload")), "warc-rows")
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    groups = materialize(narrow.filter(long).groupBy("digest").agg(
        least.alias("first"), F.count("*").alias("n")).select(
        "digest", F.col("first.page_id").alias("first_page"), F.col("first.row").alias("first_row"), "n"),
        "warc-groups")
    told = attach(narrow, groups, ["digest"], "n", F.col("row"))
    first = F.col("row") == F.col("first_row")
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("first_page").cast("string"), F.lit("none")),
                    F.lit(":"), F.col("first_row").cast("string"))
    columns = ["page_id", "row", "url", "digest", "size"]
    light = told.filter(~long | ~first).select(*columns, "payload", F.when(long, name).alias("refers"))
    # A payload once for each digest: partial aggregates drop copies before the shuffle.
    bodies = full.filter(long).groupBy("digest").agg(F.first("payload").alias("payload"))
    heads = told.filter(long & first).select(*columns)
    heavy = heads.join(bodies, "digest").select(*columns, "payload", F.lit(None).cast("string").alias("refers"))
    return light.unionByName(heavy), [narrow, groups]


def write_archive(pages: DataFrame, folder: str | None = None, date: str = DATE) -> tuple[str, DataFrame]:
    """Writes the archive of ``pages (page_id, url, html)``; its folder and index."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows, spent = records_to_write(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: BundleWriter | None = None
        for b in batches:
            index = []
            for page, row, url, digest, size, payload, refers in zip(*b.columns, strict=True):
                out = out or BundleWriter(folder, date)
                page, record = page.as_py(), record_id(page.as_py(), row.as_py())
                index += out.add(page, record, record_bytes(
                    record, url.as_py(), digest.as_py(), size.as_py(), payload.as_py(), refers.as_py(), date))
                if out.start >= BUNDLE:
                    index += out.close()
                    out = None
            yield _batch(index, INDEX)
        if out is not None:
            yield _batch(out.close(), INDEX)

    fs = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(fs)
    index = materialize(rows.mapInArrow(write, INDEX), "warc-index")
    discard(*spent)
    return folder, index


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
                                      [n for n, _ in fields])


def read_archive(folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles that ``index`` names, one row each (RECORD).

    A task reads a range of frames: the index tells how many bytes a bundle
    has, the bundle's own footer which frames lie in a range.
    """
    ends = index.groupBy("bundle").agg(F.max(F.col("frame_start") + F.col("frame_size")).alias("end"))
    ranges = ends.select("bundle", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("end") - 1, F.lit(RANGE).cast("long"))).alias("start"))
    tasks = max(1, ranges.count())  # a number of its own, as ranges are few bytes but much work

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for b in batches:
            for bundle, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with fs.open_input_file(f"{path}/{bundle}") as f:
                    for at, packed, _ in frames_of(f):
                        if start <= at < start + RANGE:
                            yield _batch(_records(_plain(f, at, packed), payloads), RECORD)

    return ranges.repartition(tasks, "bundle", "start").mapInArrow(read, RECORD)


def _records(data: memoryview, payloads: bool) -> list[tuple]:
    rows, at = [], 0
    while at < len(data):
        fields, block, at = parse_record(data, at)
        if fields["WARC-Type"] != "warcinfo":
            rows.append(read_record(fields, block, payloads))
    return rows


def fetch(folder: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of the pages in ``ids (page_id)``: their frames are read, no others."""
    asked = index.join(ids.select("page_id").distinct(), "page_id", "left_semi")
    frames = asked.groupBy("bundle", "frame").agg(
        F.min("frame_start").alias("start"), F.min("frame_size").alias("size"),
        F.collect_list("offset").alias("offsets"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for b in batches:
            for bundle, _, start, size, offsets in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with fs.open_input_file(f"{path}/{bundle}") as f:
                    data = _plain(f, start, size)
                yield _batch([read_record(*parse_record(data, at)[:2], True) for at in sorted(offsets)], RECORD)

    return frames.repartition(max(1, frames.count()), "bundle", "frame").mapInArrow(read, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archive and reads it back: a row for each record, no payloads."""
    folder, index = write_archive(pages)
    return read_archive(folder, index, payloads=False)


def open_archive(spark: SparkSession, index_path: str) -> DataFrame:
    """The index of an archive written before."""
    return spark.read.schema(INDEX).parquet(index_path)


ship(__name__)
