"""WARC archives as Zstandard frames: writer and reader.

An archive starts with a skippable frame that holds the dictionary, then has one frame per record, so a record can be
decoded alone. A task collects frames until they reach ``archive_bytes`` and hands them to Spark's text writer as one row,
a file each, so archives are bounded (a larger record is an archive of its own) and plain ``.warc.zst`` in whatever store
Spark writes to. The line end that Spark adds is an empty skippable frame, which every Zstandard decoder steps over.

Of records with equal payloads of at least ``least`` bytes those with the smallest page_id are responses and the
others revisits of it, without payload; smaller ones are all responses. Every record has an identifier of its own, the
date of the writing, and its page_id in X-Page-ID.

The reader walks along the block headers of a frame to its end, decodes that frame alone and checks the record: version,
mandatory fields, lengths and digest. What is not sound gives a row with its problem; the rest of an archive is lost only
where no frame follows.

Nulls: a null html is an empty payload, a null url an empty target; a null page_id is kept, and never a revisit's
target unless the group has no other. Repeated rows give repeated records. Extra columns are ignored. An empty table gives
archives without records or no archive, and no row.
"""

from __future__ import annotations

import hashlib
import re
import struct
import time
import uuid
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.skew import spread_join
from staylens.llm.storage import new_path, table, written
from staylens.llm.workers import map_batches

DICT_MAGIC = b"\x5d\x2a\x4d\x18"
#: An empty skippable frame; all its bytes are ASCII, so Spark's text writer takes it as a line separator.
SEPARATOR = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
LEAST_BYTES = 100
#: The dictionary is trained on at most so many records of a task, of at most so many bytes each.
DICT_SAMPLES, DICT_SAMPLE_BYTES, DICT_BYTES = 200, 16_384, 32_768
LEVEL = 3
#: Compressed bytes after which an archive ends.
ARCHIVE_BYTES = 16_000_000
#: Rows that are read back at a time.
ROWS_AT_ONCE = 10_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_ok boolean, problem string"


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def _one_line(text: str | None) -> str:
    return re.sub(r"[\r\n]+", " ", text or "")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, refers_url: str | None = None, date: str = "1970-01-01T00:00:00Z", name: str = "") -> bytes:
    """One WARC/1.1 record; a revisit if refers_to is given. ``name`` tells apart the records of one page."""
    block = payload if refers_to is None else b""
    number = uuid.UUID(bytes=hashlib.sha256(f"{page_id} {digest} {date} {name}".encode()).digest()[:16], version=4)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{number}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Target-URI: {_one_line(refers_url)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(value: bytes, name: str) -> int:
    if not value.isdigit():
        raise WarcError(f"{name} is not a number")
    return int(value)


def _page(value: bytes | None, name: str) -> int | None:
    if value is None or not re.fullmatch(rb"(-?\d+)?", value):
        raise WarcError(f"{name} is malformed")
    return int(value) if value else None


#: What the named fields, without which a record is not one, have to look like.
MANDATORY = {
    b"warc-type": rb"\S+",
    b"warc-record-id": rb"<[a-z][a-z0-9+.-]*:[^<>\s]+>",
    b"warc-date": rb"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z",
    b"content-length": rb"\d+",
}


def parse_record(raw: bytes) -> tuple:
    """page_id, payload_bytes, digest, type, refers_to, url of a decoded record; WarcError if it is not sound."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("header does not end")
    first, *lines = head.split(b"\r\n")
    if first != b"WARC/1.1":
        raise WarcError("version line is not WARC/1.1")
    fields: dict[bytes, bytes] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or name.strip() != name or name.lower() in fields:
            raise WarcError("header line is malformed or repeated")
        fields[name.lower()] = value.strip()
    for name, pattern in MANDATORY.items():
        if not re.fullmatch(pattern, fields.get(name, b"")):
            raise WarcError(f"{name.decode()} is absent or malformed")
    block = raw[len(head) + 4 :]
    length = _number(fields.get(b"content-length", b""), "Content-Length")
    if len(block) != length + 4 or block[length:] != b"\r\n\r\n":
        raise WarcError("Content-Length differs from the block")
    block = block[:length]
    kind = fields.get(b"warc-type", b"").decode()
    algorithm, _, digest = fields.get(b"warc-payload-digest", b"").decode().partition(":")
    full = _number(fields.get(b"x-payload-length", b""), "X-Payload-Length")
    if algorithm != "sha256" or not re.fullmatch("[0-9a-f]{64}", digest):
        raise WarcError("payload digest is malformed")
    refers = None
    if kind == "response":
        if full != length or hashlib.sha256(block).hexdigest() != digest:
            raise WarcError("payload differs from its digest")
    elif kind == "revisit":
        if length:
            raise WarcError("revisit has a payload")
        if fields.get(b"warc-profile", b"").decode() != REVISIT_PROFILE:
            raise WarcError("revisit has no known profile")
        refers = _page(fields.get(b"x-refers-to-page-id"), "X-Refers-To-Page-ID")
    else:
        raise WarcError("record type is unknown")
    url = fields.get(b"warc-target-uri", b"").decode("utf-8", "replace")
    return _page(fields.get(b"x-page-id"), "X-Page-ID"), full, digest, kind, refers, url


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading skippable frame and the dictionary in it; no dictionary where the samples do not carry one."""
    try:
        found = zstandard.train_dictionary(DICT_BYTES, samples) if len(samples) >= 8 else None
    except zstandard.ZstdError:
        found = None
    content = found.as_bytes() if found else b""
    return DICT_MAGIC + struct.pack("<I", len(content)) + content, found


def frame_end(view: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, by its block headers."""
    head = bytes(view[at : at + 18])
    try:
        to = at + zstandard.frame_header_size(head)
        checked = zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError as e:
        raise WarcError(f"frame at {at}: {e}") from e
    last = False
    while not last:
        if to + 3 > len(view):
            raise WarcError(f"frame at {at} is cut off")
        block = int.from_bytes(view[to : to + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        if kind == 3:
            raise WarcError(f"frame at {at} has a reserved block")
        to += 3 + (1 if kind == 1 else size)
    to += 4 * checked
    if to > len(view):
        raise WarcError(f"frame at {at} is cut off")
    return to


def frames(archive: bytes) -> Iterator[bytes | WarcError]:
    """Decoded records of one archive, a frame at a time, or why one cannot be decoded; WarcError where no frame follows."""
    view = memoryview(archive)
    if bytes(view[:4]) != DICT_MAGIC or len(view) < 8:
        raise WarcError("archive does not start with a dictionary frame")
    size = struct.unpack("<I", view[4:8])[0]
    if 8 + size > len(view):
        raise WarcError("dictionary frame is cut off")
    trained = zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size])) if size else None
    decoder = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    at = 8 + size
    while at < len(view):
        magic = bytes(view[at : at + 4])
        if magic == FRAME_MAGIC:
            to = frame_end(view, at)
            one = decoder.decompressobj()
            try:
                out = one.decompress(view[at:to])
                yield out if one.eof else WarcError(f"frame at {at} does not end")
            except zstandard.ZstdError as e:
                yield WarcError(f"frame at {at}: {e}")
            at = to
        elif len(magic) == 4 and 0x184D2A50 <= struct.unpack("<I", magic)[0] <= 0x184D2A5F and at + 8 <= len(view):
            at += 8 + struct.unpack("<I", view[at + 4 : at + 8])[0]
        else:
            raise WarcError(f"no frame starts at {at}")


def with_targets(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, digest, refers_to and refers_url of each page.

    Groups are found by a pre-aggregated count per digest, without the payloads; the rows of a payload that many pages share
    are dealt to several tasks.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest")
    )
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    groups = (
        rows.filter(F.octet_length("html") >= least)
        .groupBy("digest")
        .agg(F.min(known).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url"), "n")
    )
    groups = written(groups, "equal-payloads")
    again = F.col("page_id") != F.col("first")
    return spread_join(rows, groups.drop("n"), "digest", "page_id", "left", counted=groups.select("digest", "n")).select(
        "page_id", "url", "html", "digest", F.when(again, F.col("first")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_url")
    )


def write_archives(rows: DataFrame, path: str, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Rows of with_targets() as archives under path, dated as given or now."""
    date = date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for i, u, h, d, r, w, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield record(i, u, h.encode(), d, r, w, date, str(name))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = records(batches)
        held = [x for _, x in zip(range(DICT_SAMPLES), stream)]
        lead, trained = dictionary_frame([x[:DICT_SAMPLE_BYTES] for x in held])
        packer = zstandard.ZstdCompressor(LEVEL, dict_data=trained) if trained else zstandard.ZstdCompressor(LEVEL)
        out, size = [], 0
        for raw in chain(held, stream):
            out.append(packer.compress(raw))
            size += len(out[-1])
            if size >= archive_bytes:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join([lead, *out])], pa.binary())], names=["archive"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join([lead, *out])], pa.binary())], names=["archive"])

    framed = rows.withColumn("name", F.monotonically_increasing_id()).transform(map_batches, encoded, "archive binary")
    one = framed.select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
    one.option("lineSep", SEPARATOR.decode("latin-1")).text(path)


def _checked(archive: bytes) -> Iterator[tuple]:
    try:
        for raw in frames(archive):
            try:
                if isinstance(raw, WarcError):
                    raise raw
                yield (*parse_record(raw), True, None)
            except WarcError as e:
                yield (None,) * 6 + (False, str(e))
    except WarcError as e:
        yield (None,) * 6 + (False, str(e))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under path; an unsound record or archive gives a row with its problem."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows = _checked(archive.as_buffer())
                while part := list(islice(rows, ROWS_AT_ONCE)):
                    columns = zip(*part, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("content")
    return files.transform(map_batches, decoded, SCHEMA)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    """Contract query: every page written as a record, then read back."""
    path = new_path(spark, "warc")
    write_archives(with_targets(table(spark, sf_dir, "pages")), path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_ok", "problem"
    )


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, octet_length(encode(h)) AS n, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN n >= {LEAST_BYTES} AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {LEAST_BYTES} AND page_id <> f THEN f END AS refers_to, true AS record_ok, NULL::VARCHAR AS problem
FROM g
"""
