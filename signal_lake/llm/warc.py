"""Web archives in Zstandard, one frame per record, with a shared dictionary.

Method: an archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself a Zstandard frame
or as it is; then comes one frame per record. Reading streams a file through a decompressor that is given the dictionary,
takes frame by frame, and checks each record: the version line, the headers, the block's length against Content-Length, the
closing blank lines, and the digests. What breaks a rule is a row with its ``error``, never a missing row.

Writing: pages of equal payload of at least ``LEAST`` bytes are one response, the one of the smallest id, and revisits that refer to it.
Pages stay in the partition that they reach through one salted join; each task writes archives of about
``ROLL`` bytes to the shared folder under a name of its own and returns their paths, so a task that runs again leaves
files nobody reads. The dictionary is trained on a bounded sample (``SAMPLE`` pages, ``SAMPLE_BYTES`` each) and
affects sizes only.

Results for odd input: a NULL payload is an empty one. A NULL url is an empty one. Rows with an equal id are records of their
own; if they share a payload, one is the response and the others revisit that id. A NULL id comes after all others and
stays NULL. An empty table gives no archive and no rows. Columns other than id, url and payload are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.llm.common import prepare
from signal_lake.operators.skew import with_group_min
from signal_lake.session import shared_dir, stage

MAGIC, FRAME = 0x184D2A5D, 0xFD2FB528
LEAST = 100
ROLL = 64 << 20
DICTIONARY, SAMPLE, SAMPLE_BYTES = 64 << 10, 256, 16 << 10
READ = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/1\.[01]")


class BrokenArchive(ValueError):
    """What is wrong with a file as a whole; records read before stand."""


# --- one record -------------------------------------------------------------------------------


def page_name(page: object) -> str:
    """The id as part of a record id; '' for a NULL."""
    return "" if page is None else quote(str(page), safe="")


def _digest(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode().rstrip("=")


def digest_hex(value: str) -> str:
    """Bare lower-case hex of a labelled base-32 digest."""
    name, _, digits = value.partition(":")
    if name.lower() != "sha256":
        raise ValueError(f"digest of kind {name!r}")
    return base64.b32decode(digits.upper() + "=" * (-len(digits) % 8)).hex()


def format_record(page: str, url: str, payload: bytes, refers_to: tuple[str, str] | None, at: str) -> bytes:
    """One record; ``refers_to`` (id and address of the response) makes it a revisit, without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    headers = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", f"<urn:page:{page}>"),
        ("WARC-Target-URI", quote(url, safe=_SAFE)),
        ("WARC-Date", at),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to[0]}>"), ("WARC-Refers-To-Target-URI", quote(refers_to[1], safe=_SAFE))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


_SAFE = "!#$&'()*+,/:;=?@[]~"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    def http(self) -> tuple[dict[str, str], bytes]:
        """Headers and body of the message in the block."""
        head, blank, body = self.block.partition(b"\r\n\r\n")
        if not blank or not head.startswith(b"HTTP/"):
            raise ValueError("the block holds no HTTP message")
        return _headers(head.split(b"\r\n")[1:]), body


def _headers(lines: list[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"no header: {line[:60]!r}")
        found[name.decode().lower()] = value.strip().decode()
    return found


def parse_record(data: bytes) -> Record:
    """The one record that ``data`` must be, checked."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not _VERSION.fullmatch(lines[0]):
        raise ValueError("no WARC version line or no end of headers")
    headers = _headers(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"{name} is missing")
    if not headers["content-length"].isdecimal():
        raise ValueError("content-length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, not {length}, or no blank lines after it")
    record = Record(headers, rest[:length])
    if "warc-block-digest" in headers and digest_hex(headers["warc-block-digest"]) != hashlib.sha256(record.block).hexdigest():
        raise ValueError("the block's digest differs")
    if record.kind == "response":
        http, body = record.http()
        if "content-length" in http and http["content-length"] != str(len(body)):
            raise ValueError("the payload's length differs")
        if "warc-payload-digest" in headers and digest_hex(headers["warc-payload-digest"]) != hashlib.sha256(body).hexdigest():
            raise ValueError("the payload's digest differs")
    return record


# --- one file ---------------------------------------------------------------------------------


def head_frame(dictionary: bytes) -> bytes:
    """The skippable frame an archive starts with."""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", MAGIC, len(packed)) + packed


def read_frames(source: io.RawIOBase | pa.NativeFile) -> Iterator[bytes]:
    """The contents of the frames after the dictionary, one by one; holds one frame at a time."""
    data = source.read(8)
    dictionary = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == MAGIC:
        size = struct.unpack("<I", data[4:])[0]
        packed = source.read(size)
        if len(packed) != size:
            raise BrokenArchive("the dictionary's frame is cut off")
        if packed[:4] == struct.pack("<I", FRAME):
            packed = zstandard.ZstdDecompressor().decompressobj().decompress(packed)
        dictionary, data = zstandard.ZstdCompressionDict(packed), b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    data = bytes(data) or bytes(source.read(READ))
    while data:
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as error:
                raise BrokenArchive(f"a frame can't be decoded: {error}") from error
            if frame.eof:
                data = bytes(frame.unused_data)
                break
            data = bytes(source.read(READ))
            if not data:
                raise BrokenArchive("the last frame is cut off")
        yield b"".join(parts)
        data = data or bytes(source.read(READ))


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (pafs.LocalFileSystem(), path)


# --- whole tables -----------------------------------------------------------------------------


def train_dictionary(pages: DataFrame, payload: Column) -> bytes:
    """A dictionary from about ``SAMPLE`` pages, chosen by a hash; b'' if they are too few to train on."""
    total = pages.count()
    share = min(1.0, SAMPLE / max(1, total))
    chosen = F.pmod(F.xxhash64(payload), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    sample = pages.where(chosen).select(F.substring(payload, 1, SAMPLE_BYTES).alias("part")).limit(4 * SAMPLE)
    parts = sorted({r["part"].encode("utf-8", "surrogatepass") for r in sample.collect() if r["part"]})
    size = sum(map(len, parts))
    if len(parts) < 16 or size < 8 << 10:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY, size // 8), parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(
    pages: DataFrame, id_column: str, url_column: str, payload_column: str, folder: str, at: str = "2024-01-01T00:00:00Z", least: int = LEAST
) -> DataFrame:
    """Write all pages and return a row per archive: (path, records, bytes). The result is a written table."""
    spark = pages.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(payload_column), F.lit(""))
    dictionary = train_dictionary(pages, text)
    rows = pages.select(F.col(id_column).alias("page"), F.coalesce(F.col(url_column), F.lit("")).alias("url"), text.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256))))
    # The number tells equal rows apart; it is written, so that it is the same wherever it is read.
    path = f"{shared_dir(spark)}/stage/pages-{uuid.uuid4().hex}"
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    numbered = rows.withColumn("order", F.struct(F.col("page").isNull().alias("unnumbered"), "page", "row", "url"))
    first = with_group_min(numbered, ["digest"], "order", "first")
    first = first.select("page", "url", "payload", F.col("first.page").alias("to"), F.col("first.url").alias("to_url"), (F.col("row") != F.col("first.row")).alias("again"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, compressor = b"", zstandard.ZstdCompressor(level=3)
        if dictionary:
            head, compressor = head_frame(dictionary), zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        files, _ = open_fs(folder)
        files.create_dir(open_fs(folder)[1], recursive=True)
        done, sink, path, records, size = [], None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    path, records, size = f"{folder}/{uuid.uuid4().hex}.warc.zst", 0, len(head)
                    sink = files.open_output_stream(open_fs(path)[1], compression=None)
                    sink.write(head)
                payload = row["payload"].encode("utf-8", "surrogatepass")
                refers = (page_name(row["to"]), row["to_url"]) if row["again"] else None
                frame = compressor.compress(format_record(page_name(row["page"]), row["url"], payload, refers, at))
                sink.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= ROLL:
                    sink.close()
                    done.append((path, records, size))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((path, records, size))
        columns = [[d[i] for d in done] for i in range(3)]
        yield pa.record_batch([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["path", "records", "bytes"])

    return stage(first.mapInArrow(write, "path string, records bigint, bytes bigint"), "archives")


RECORD = "path string, record_id string, record_type string, target string, refers_to string, payload_bytes bigint, payload_digest string, error string"


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the files named by ``path``, and one per defect."""
    prepare(archives.sparkSession)

    def rows_of(path: str) -> Iterator[tuple]:
        files, name = open_fs(path)
        with files.open_input_stream(name, compression=None) as source:
            try:
                for data in read_frames(source):
                    try:
                        record = parse_record(data)
                        http, body = record.http() if record.block else ({}, b"")
                        whole = record.kind == "response"
                        size = len(body) if whole else int(http["content-length"]) if "content-length" in http else None
                        digest = digest_hex(record.headers["warc-payload-digest"]) if "warc-payload-digest" in record.headers else hashlib.sha256(body).hexdigest() if whole else None
                        target = unquote(record.headers.get("warc-target-uri", ""))
                        yield path, record.headers["warc-record-id"], record.kind, target, record.headers.get("warc-refers-to"), size, digest, None
                    except ValueError as error:
                        yield path, None, None, None, None, None, None, str(error)
            except BrokenArchive as error:
                yield path, None, None, None, None, None, None, str(error)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split() for f in RECORD.split(", ")]
        kinds = [pa.int64() if kind == "bigint" else pa.string() for _, kind in fields]

        def packed(some: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], [name for name, _ in fields])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                some: list[tuple] = []
                for row in rows_of(path):
                    some.append(row)
                    if len(some) == 1024:
                        yield packed(some)
                        some = []
                if some:
                    yield packed(some)

    paths = archives.select("path")
    return paths.repartition(max(1, archives.count()), "path").mapInArrow(read, RECORD)


def list_archives(pages_folder: str, spark) -> DataFrame:
    """Archives under a folder that Spark can list; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.zst").load(pages_folder).select("path")


def page_number(record_id: Column, kind: str) -> Column:
    """The id that ``page_name`` was given."""
    text = F.url_decode(F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1))
    return F.when(text != "", text).cast(kind)


def round_trip(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Write all pages, read the archives back; a defect ends the job."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    kind = pages.schema[id_column].dataType.simpleString()
    records = read_archives(write_archives(pages, id_column, url_column, payload_column, folder))
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat("path", F.lit(": "), "error")).cast("bigint")).otherwise(F.col("payload_bytes"))
    return records.select(
        page_number(F.col("record_id"), kind).alias(id_column), sound.alias("payload_bytes"), "payload_digest", "record_type",
        page_number(F.col("refers_to"), kind).alias("refers_to"),
    )
