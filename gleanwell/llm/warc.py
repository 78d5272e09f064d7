"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans a partition per group of files, parses each record's headers first and goes on to
the payload only for records that the pushed predicates leave. Written files are gzip members, one
per record, whose extra field holds the member's length, so an unwanted record is jumped over
without reading or inflating the rest of it. Other gzip and plain archives are read as well. A
record that is cut off, or whose declared length or digest does not fit, fails the read by name.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
    StringStartsWith, WriterCommitMessage,
)

from gleanwell.llm.common import filesystem, shared_folder

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
)
HEADER_COLUMNS = {  # columns that can be tested on the headers alone
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
}
LENGTH = "X-Payload-Length"  # a revisit's payload length, which its block does not have
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
FILE_BYTES = 32 << 20
SMALLEST = 100  # bytes below which equal payloads are not worth a revisit
FIRST = 4096  # bytes read of a member for its headers


# ---------------------------------------------------------------- records as bytes


def packed(block: bytes) -> bytes:
    """A gzip member that names its own length in the extra field ``WL``."""
    deflate = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = deflate.compress(block) + deflate.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sH", 12, b"WL", 8)
    size = len(head) + 8 + len(body) + 8
    return head + struct.pack("<Q", size) + body + struct.pack("<II", zlib.crc32(block), len(block) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """One WARC record: a response with its HTTP message, or a revisit with headers only."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    clean = lambda v: str(v).replace("\r", "%0D").replace("\n", "%0A")
    lines = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if row["target_uri"] is not None:
        lines.append(("WARC-Target-URI", row["target_uri"]))
    lines.append(("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"))
    if revisit:
        lines += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", REVISIT), (LENGTH, row["payload_bytes"])]
    block = b"" if revisit else HTTP % len(payload) + payload
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(head: bytes) -> dict[str, str]:
    """The named fields of a record head."""
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip()] = value.strip()
    return fields


def bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


# ---------------------------------------------------------------- records from files


class DamagedArchive(ValueError):
    """A record that is cut off or contradicts its own headers, with its place; nothing of it is returned."""


def records(file: pa.NativeFile, size: int, wanted) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records whose fields pass ``wanted``; others are passed by.

    A record whose head or block is not all there, whose length is no number or whose compression is
    broken raises ``DamagedArchive``: an archive is read whole or not at all. Empty files and blank
    lines between records are no records.
    """
    at = 0
    while at < size:
        file.seek(at)
        first = file.read(FIRST)
        try:
            if first[:2] != b"\x1f\x8b":
                at, found = _plain(file, at, size, first, wanted)
            elif len(first) > 24 and first[3] & 4 and first[12:14] == b"WL":
                (length,) = struct.unpack_from("<Q", first, 16)
                if not 24 < length <= size - at:
                    raise DamagedArchive("the member is cut off")
                found = _member(file, first, length, wanted)
                at += length
            else:
                at, found = _stream(file, at, wanted)
        except (DamagedArchive, zlib.error) as wrong:
            raise DamagedArchive(f"record at byte {at}: {wrong}") from wrong
        if found:
            yield found


def _split(data: bytes) -> tuple[dict[str, str], int] | None:
    end = data.find(b"\r\n\r\n")
    return (parsed(data[:end]), end + 4) if end >= 0 else None


def _length(fields: dict[str, str]) -> int:
    text = fields.get("Content-Length", "")
    if not (text.isascii() and text.isdigit()):
        raise DamagedArchive(f"Content-Length is {text[:40]!r}")
    return int(text)


def _whole(block: bytes, length: int) -> bytes:
    if len(block) < length:
        raise DamagedArchive(f"{len(block)} of {length} bytes are there")
    return block


def _plain(file, at: int, size: int, data: bytes, wanted):
    while not data.lstrip(b"\r\n") and (more := file.read(FIRST)):
        data += more
    skip = len(data) - len(data.lstrip(b"\r\n"))
    if skip == len(data):
        return size, None
    while (head := _split(data[skip:])) is None:
        more = file.read(FIRST)
        if not more:
            raise DamagedArchive("the head does not end")
        data += more
    fields, start = head
    length = _length(fields)
    if at + skip + start + length > size:
        raise DamagedArchive(f"{size - at - skip - start} of {length} bytes are there")
    after = at + skip + start + length + 4
    if not wanted(fields):
        return after, None
    file.seek(at + skip + start)
    return after, (fields, _whole(file.read(length), length))


def _member(file, first: bytes, length: int, wanted):
    inflate = zlib.decompressobj(-15)
    data, left = inflate.decompress(first[24:length], FIRST), length - min(len(first), length)
    while (head := _split(data)) is None:
        rest = inflate.unconsumed_tail
        if not rest:
            rest = file.read(min(FIRST, left))
            left -= len(rest)
        more = inflate.decompress(rest, FIRST)
        if not more and (not rest or inflate.eof):
            raise DamagedArchive("the head does not end")
        data += more
    fields, start = head
    size = _length(fields)
    if not wanted(fields):
        return None
    data += inflate.decompress(inflate.unconsumed_tail + (file.read(left) if left else b"")) + inflate.flush()
    if not inflate.eof:
        raise DamagedArchive("the member does not end")
    return fields, _whole(data[start : start + size], size)


def _stream(file, at: int, wanted):
    file.seek(at)
    inflate, data, head, keep, read = zlib.decompressobj(31), b"", None, True, 0
    while not inflate.eof and (piece := file.read(1 << 16)):
        read += len(piece)
        out = inflate.decompress(piece)
        if keep:
            data += out
            if head is None and (head := _split(data)):
                keep = wanted(head[0])
    if not inflate.eof:
        raise DamagedArchive("the member does not end")
    if head is None:
        raise DamagedArchive("the head does not end")
    after, size = at + read - len(inflate.unused_data), _length(head[0])
    if not keep:
        return after, None
    return after, (head[0], _whole(data[head[1] : head[1] + size], size))


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The entity body of an HTTP block, else the block itself."""
    if fields.get("Content-Type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# ---------------------------------------------------------------- the data source


class WarcFiles(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` = content, digest (length and digest recomputed, bytes not
    returned) or none (headers only: declared length and digest); ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"])


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.mode = options.get("payload", "content")
        self.bytes = int(options.get("partitionBytes", 64 << 20))
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADER_COLUMNS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((HEADER_COLUMNS[column], "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((HEADER_COLUMNS[column], "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((HEADER_COLUMNS[column], "starts", (f.value,)))
            else:
                yield f

    def wanted(self, fields: dict[str, str]) -> bool:
        for field, kind, values in self.tests:
            value = bare(fields.get(field))
            if value is None or (value not in values if kind == "in" else not value.startswith(values)):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        store, base = filesystem(self.path)
        scheme = self.path[: len(self.path.rstrip("/"))]
        found = store.get_file_info(fs.FileSelector(base, recursive=False, allow_not_found=True))
        files = sorted((f for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))), key=lambda f: f.base_name)
        groups, held = [[]], 0
        for f in files:
            if groups[-1] and held + f.size > self.bytes:
                groups.append([])
                held = 0
            groups[-1].append(f"{scheme}/{f.base_name}")
            held += f.size
        return [WarcFiles(g) for g in groups]

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path in partition.paths:
            store, inner = filesystem(path)
            with store.open_input_file(inner) as file:
                for fields, block in records(file, file.size(), self.wanted):
                    rows.append(self.row(fields, block))
                    held += len(block)
                    if len(rows) >= 2048 or held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
        yield batch_of(rows)

    def row(self, fields: dict[str, str], block: bytes) -> tuple:
        declared = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None
        payload, size = None, int(fields.get(LENGTH, -1))
        if size < 0 and self.mode == "none":
            size = int(fields.get("Content-Length", 0)) - len(block.partition(b"\r\n\r\n")[0]) - 4
        elif size < 0:
            payload = payload_of(fields, block)
            found = hashlib.sha256(payload).hexdigest()
            if fields.get("WARC-Payload-Digest", "").startswith("sha256:") and declared != found and "WARC-Truncated" not in fields:
                raise DamagedArchive(f"record {fields.get('WARC-Record-ID', 'without id')}: the payload's digest is not the declared one")
            size, declared = len(payload), found
        named = [bare(fields.get(f)) for f in HEADER_COLUMNS.values()]
        return (*named, declared, size, list(fields.items()), payload if self.mode == "content" else None)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    text = pa.string()
    types = [text, text, text, text, text, pa.int64(), pa.map_(text, text), pa.binary()]
    names = [*HEADER_COLUMNS, "payload_digest", "payload_bytes", "headers", "payload"]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    """Tasks write under names that no reader lists; a commit of all renames them."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = filesystem(self.path)
        store.create_dir(base, recursive=True)
        names, out, held = [], None, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None:
                        names.append(uuid.uuid4().hex)
                        out, held = store.open_output_stream(f"{base}/{names[-1]}.partial"), 0
                    data = packed(record_bytes(row))
                    out.write(data)
                    held += len(data)
                    if held >= FILE_BYTES:
                        out.close()
                        out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        store, base = filesystem(self.path)
        store.create_dir(base, recursive=True)
        for name in (n for m in messages if m for n in m.names):
            store.move(f"{base}/{name}.partial", f"{base}/{name}.warc.gz")

    def abort(self, messages: list) -> None:
        store, base = filesystem(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(f"{base}/{name}.partial")


def register(spark: SparkSession) -> None:
    """Make the format known and let predicates reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def load(spark: SparkSession, folder: str, payload: str = "content") -> DataFrame:
    """The records of a folder, as one frame that may be filtered in several ways.

    Spark keeps the predicates it pushed last with the relation and reuses them where a later plan
    pushes none. The test for a type, which every record has, makes every plan push afresh; a
    frame from ``spark.read`` itself should be loaded anew for each use.
    """
    register(spark)
    table = spark.read.format("warc").option("payload", payload).load(folder)
    return table.filter(F.col("record_type").isNotNull())


# ---------------------------------------------------------------- pages to archives and back


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A record per page: of equal payloads of 100 bytes and more, the smallest id is the response.

    Null pages are empty. Null ids never are the smallest; rows that share the smallest id are all
    responses, as are all rows of a payload without any id. The smallest id is found on digests
    alone, combined in every task; the payloads meet it in a join that splits hot digests.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"), F.col(url).alias("target_uri"), body.alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    least = (
        rows.filter(F.col("payload_bytes") >= SMALLEST).groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND least IS NOT NULL").drop("n")
    )
    placed = rows.join(least, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= SMALLEST), "left")
    revisit = F.col("least").isNotNull() & ~F.col("id").eqNullSafe(F.col("least"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return placed.select(
        name(F.col("id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.when(revisit, name(F.col("least"))).alias("refers_to"), "payload_digest", "payload_bytes",
        F.lit(None).cast("map<string,string>").alias("headers"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, folder: str | None = None, **columns) -> str:
    """Write the pages as WARC files and return their folder."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or shared_folder(spark, "warc")
    page_records(pages, **columns).write.format("warc").mode("append").save(folder)
    return folder


def page_summary(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, read from the archives.

    Responses are decoded and their digests computed anew; revisits are read by headers alone.
    """
    full = load(spark, folder, "digest").filter(F.col("record_type") == "response")
    light = load(spark, folder, "none").filter(F.col("record_type") == "revisit")
    number = lambda c: F.substring(c, 10, 30).try_cast("long")
    return full.unionByName(light).select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
