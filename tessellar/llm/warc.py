"""WARC archives, written and read by a PySpark Python data source.

Writing: each record is a gzip member of its own, as WARC readers expect, in files that tasks stage and the driver's commit moves to
their places. Of records with equal payloads of at least
``revisit_bytes`` bytes, that with the largest page_id is a ``response``; the others are ``revisit`` records that
refer to it and repeat its digest and length in their headers, without the payload. Null payloads are empty; rows
with a null or repeated page_id each get a record, and all that share the largest id of a payload are responses.

Reading: ``spark.read.format("warc").load(folder)`` plans a partition for each file, takes equality and IN filters
on ``record_type`` and on header columns into the scan, parses headers first, and steps over the payload of a record that the filters drop, or
of any record if the option ``payload`` is false: with a seek where the archive isn't compressed or its members tell their length, as
those written here do. Any other gzip file is decoded throughout. Header texts are percent-encoded where
they hold control characters.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from tessellar.llm.common import materialize

#: Parts of a record.
VERSION, EOL = "WARC/1.0", "\r\n"
DATE = "2026-01-01T00:00:00Z"
SCHEMA = "record_type string, page_id long, url string, refers_to long, payload_digest string, payload_bytes long, payload binary"
#: header -> column; the others are passed over
HEADERS = {"WARC-Type": "record_type", "WARC-Record-ID": "page_id", "WARC-Target-URI": "url", "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "payload_digest", "X-Payload-Length": "payload_bytes"}


def records(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """page_id and the text of its record, without the blank line that ends it."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary"))})
    # copies are told by keys alone; payloads then meet them by page, so that a page that many have goes to no one task
    keys = materialize(p.filter(F.col("bytes") >= revisit_bytes).select("page_id", "digest", "bytes"))
    first = keys.groupBy("digest", "bytes").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("_n")).filter("_n > 1 and owner is not null").drop("_n")
    visits = keys.join(first, ["digest", "bytes"]).filter(~F.col("owner").eqNullSafe(F.col("page_id"))).distinct().toDF("_digest", "_bytes", "_page", "owner")
    p = p.join(visits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    visit = F.col("owner").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(EOL + EOL))
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "%", "%25"), "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(visit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url)),
        F.lit(f"WARC-Date: {DATE}"),
        F.when(visit, F.concat(F.lit("WARC-Refers-To: "), name("owner"))),
        F.when(visit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(visit, 0).otherwise(F.col("bytes"))).cast("string")),
    ]
    text = F.concat(F.concat_ws(EOL, *lines), F.lit(EOL + EOL), http, F.when(visit, "").otherwise(F.col("html")))
    return p.select("page_id", text.alias("value"))


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own. Its extra field ``sl`` tells the member's length and the record's (0: too long to tell), so that
    a reader can step over it without decoding it."""
    body = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = body.compress(record) + body.flush()
    sizes = (EXTRA + len(body) + 8, len(record))
    head = struct.pack("<4BIBB H2sH II", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, *(sizes if max(sizes) < 1 << 32 else (0, 0)))
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


#: bytes of a member before its body
EXTRA = 24


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes the records of column ``value``. Tasks write below ``_staged`` under names of their own; files of tasks that count are moved to
    their places when all are done, so a task that failed or ran twice leaves nothing behind."""

    def __init__(self, options: dict):
        self.path, self.per_file, self.gzip = options["path"], int(options.get("per_file", 20_000)), options.get("compression", "gzip") != "none"

    def write(self, iterator):
        fs, base = open_fs(self.path)
        fs.create_dir(f"{base}/_staged", recursive=True)
        files, out, n = [], None, 0
        for b in iterator:
            for value in b.column("value"):
                if out is None or n == self.per_file:
                    if out is not None:
                        out.close()
                    files.append(f"{TaskContext.get().partitionId():06d}-{len(files):04d}-{uuid.uuid4().hex}.warc" + (".gz" if self.gzip else ""))
                    out, n = fs.open_output_stream(f"{base}/_staged/{files[-1]}", compression=None), 0
                record = value.as_py().encode() + b"\r\n\r\n"
                out.write(member(record) if self.gzip else record)
                n += 1
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        fs, base = open_fs(self.path)
        fs.create_dir(base, recursive=True)
        for m in messages:
            for name in m.files if m else ():
                fs.move(f"{base}/_staged/{name}", f"{base}/{name}")
        self.abort(messages)
        fs.open_output_stream(f"{base}/_SUCCESS").close()

    def abort(self, messages):
        fs, base = open_fs(self.path)
        if fs.get_file_info(f"{base}/_staged").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/_staged")


def write_warc(pages: DataFrame, path: str, revisit_bytes: int = 1000, per_file: int = 20_000, compression: str = "gzip") -> None:
    """Archives of at most ``per_file`` records in a folder: ``.warc.gz`` with a gzip member for each record, or ``.warc`` without
    compression."""
    pages.sparkSession.dataSource.register(WarcSource)
    out = records(pages, revisit_bytes).select("value").write.format("warc").mode("append")
    out.option("per_file", per_file).option("compression", compression).save(path)


class Piece(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def parse(stream, wanted: list[tuple[str, frozenset]], payload: bool) -> Iterator[tuple]:
    """Records of an open archive as rows of SCHEMA. ``wanted``: (column, values allowed)."""
    fields = list(HEADERS.values())
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        row: dict = {}
        length = 0
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            if name == "Content-Length":
                length = int(value)
            elif name in HEADERS:
                row[HEADERS[name]] = value
        for c in ("page_id", "refers_to"):
            if c in row:
                row[c] = int(x) if (x := row[c][len("<urn:page:") : -1]) else None
        row["url"] = unquote(row["url"]) if "url" in row else None
        row["payload_digest"] = row.get("payload_digest", "").removeprefix("sha1:") or None
        row["payload_bytes"] = int(row["payload_bytes"]) if "payload_bytes" in row else None
        if not payload or row["record_type"] == "revisit" or any(row.get(c) not in v for c, v in wanted):
            stream.skip(length)
            body = None
        else:
            body = stream.read(length).partition(b"\r\n\r\n")[2]
        if all(row.get(c) in v for c, v in wanted):
            yield (*(row.get(c) for c in fields), body)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() != "false"
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in HEADERS.values():
                self.wanted.append((f.attribute[0], frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self):
        fs, base = open_fs(self.path)
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True)) if fs.get_file_info(base).type == pafs.FileType.Directory else [fs.get_file_info(base)]
        names = sorted((-x.size, x.path) for x in found if x.type == pafs.FileType.File and not x.base_name.startswith(("_", ".")))
        return [Piece(p) for _, p in names] or [Piece("")]

    def read(self, partition):
        if not partition.path:
            return
        fs, _ = open_fs(self.path)
        with open_file(fs, partition.path) as raw:
            rows, held = [], 0
            for row in parse((_Members if partition.path.endswith(".gz") else _Buffered)(raw), self.wanted, self.payload):
                rows.append(row)
                held += len(row[-1] or b"") + 200
                if held > 1 << 23:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


class _Buffered:
    """Lines, reads and forward skips over a file, a block at a time; a skip seeks where the file can."""

    def __init__(self, raw, block: int = 1 << 20):
        self.raw, self.block, self.data, self.at = raw, block, b"", 0

    def back(self, data: bytes) -> None:
        """Put back what was read too much."""
        self.at -= len(data)

    def _more(self, n: int) -> bool:
        got = self.raw.read(max(n, self.block))
        self.data, self.at = self.data[self.at :] + got, 0
        return bool(got)

    def readline(self) -> bytes:
        while (end := self.data.find(b"\n", self.at)) < 0:
            if not self._more(self.block):
                end = len(self.data) - 1
                break
        line, self.at = self.data[self.at : end + 1], end + 1
        return line

    def read(self, n: int) -> bytes:
        while len(self.data) - self.at < n and self._more(n - (len(self.data) - self.at)):
            pass
        out, self.at = self.data[self.at : self.at + n], self.at + n
        return out

    def skip(self, n: int) -> None:
        have = len(self.data) - self.at
        if n <= have:
            self.at += n
        elif self.raw.seekable():
            self.data, self.at = b"", 0
            self.raw.seek(self.raw.tell() + n - have)
        else:
            while n > 0 and (got := len(self.read(min(n, self.block)))):
                n -= got


class _Members:
    """Lines, reads and forward skips over the members of a gzip file. Members are decoded as far as they are read; a skip to the
    end of one that tells its length is a seek."""

    def __init__(self, raw, block: int = 1 << 16):
        self.raw, self.block, self.data, self.at, self.body = _Buffered(raw, block), block, b"", 0, None

    def _open(self) -> bool:
        head = self.raw.read(10)
        if len(head) < 10:
            return False
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        self.left, self.plain, flags = None, None, head[3]
        if flags & 4:
            extra = self.raw.read(int.from_bytes(self.raw.read(2), "little"))
            if extra[:4] == b"sl\x08\x00" and flags == 4 and any(sizes := struct.unpack("<II", extra[4:12])):
                self.left, self.plain = sizes[0] - 12 - len(extra), sizes[1]
        for bit in (8, 16):
            while flags & bit and self.raw.read(1) not in (b"\0", b""):
                pass
        if flags & 2:
            self.raw.read(2)
        self.body, self.fresh = zlib.decompressobj(-15), True
        return True

    def _more(self, _: int) -> bool:
        while self.body is not None or self._open():
            # the headers first
            size = 4096 if self.fresh else self.block
            got = self.raw.read(size if self.left is None else min(size, self.left - 8))
            self.fresh = False
            out = self.body.decompress(got)
            if self.left is not None:
                self.left -= len(got)
            if self.body.eof:
                self.raw.back(self.body.unused_data)
                self.raw.read(8)
                self.body = None
            elif not got:
                raise ValueError("a gzip member ends early")
            if self.plain is not None:
                self.plain -= len(out)
            if out:
                self.data, self.at = self.data[self.at :] + out, 0
                return True
        return False

    readline = _Buffered.readline
    read = _Buffered.read

    def skip(self, n: int) -> None:
        n -= (have := min(n, len(self.data) - self.at))
        self.at += have
        # what is left after the skip is the blank lines that end a record
        if n and self.body is not None and self.left is not None and self.plain - n <= 4:
            self.raw.skip(self.left)
            self.body, n = None, 0
        while n > 0 and (got := len(self.read(min(n, self.block)))):
            n -= got


def batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*HEADERS.values(), "payload"])


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("file:///", "/", 1) if path.startswith("file:/") else path)


def open_file(fs: pafs.FileSystem, path: str):
    return fs.open_input_file(path)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records below a folder, or of one file."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
