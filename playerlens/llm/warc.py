"""WARC archives compressed with zstandard: one frame for each record, dictionary in front.

An archive starts with a skippable frame that holds the dictionary (possibly none). Every record is
a frame of its own. Spark's text sink writes the frames, so archives can lie in any store Spark
reaches; its record separator is an empty skippable frame, which decoders pass over. One archive is
made of each partition. Archives are read as binary files, one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlens.llm.text import sample_of

# The magic numbers of a data frame, of skippable frames (the low four bits are free)
# and of the one that holds a dictionary.
_FRAME, _SKIP, _DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
#: An empty skippable frame; all its bytes are ASCII, as Spark's separator has to be.
SEPARATOR = struct.pack("<II", _SKIP, 0).decode("ascii")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"
_CRLF = b"\r\n"


def train_dictionary(
    pages: DataFrame, *, sample_rows: int = 500, sample_chars: int = 20_000, size: int = 64 << 10
) -> bytes:
    """A dictionary from at most ``sample_rows`` payloads, the first ``sample_chars`` of each.

    Empty when there is too little to train on.
    """
    html = pages.select(F.substring("html", 1, sample_chars).alias("html")).filter("html <> ''")
    sample = [r[0].encode() for r in sample_of(html, "html", sample_rows).collect()]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, sample)) // 4), sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def with_references(pages: DataFrame, *, min_bytes: int = 1000) -> DataFrame:
    """``page_id, url, html, digest, refers_to`` for the writer.

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest id is the
    response, and the others refer to it. Repeated rows of that id are responses too; pages without
    an id refer to it like others, and are responses when no page of the group has an id.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html).alias("digest")
    )
    large = base.filter(F.octet_length("html") >= min_bytes)
    # Groups of one need no reference; the join has a row for each repeated payload only.
    last = large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    last = last.filter("n > 1 AND last IS NOT NULL").select("digest", "last")
    joined = base.join(last, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit with its HTTP head alone."""
    http = _CRLF.join(
        [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(html), b"", b""]
    )
    block = http if refers_to is not None else http + html
    named = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{named}>",
        f"WARC-Date: {_DATE}",
        # A line break in a URL would end the header.
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines = "\r\n".join([*head, "", ""]).encode("utf-8", "surrogatepass")
    return lines + block + _CRLF + _CRLF


def _frames(dictionary: bytes, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        started = False
        for batch in batches:
            for at in range(0, len(batch), 64):
                rows = batch.slice(at, 64).to_pylist()
                frames = [coder.compress(record(**r)) for r in rows]
                if rows and not started:
                    started = True
                    frames.insert(0, struct.pack("<II", _DICTIONARY, len(dictionary)) + dictionary)
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["value"])

    return run


def write_archives(
    pages: DataFrame, path: str, *, dictionary: bytes | None = None, min_bytes: int = 1000, level: int = 3
) -> None:
    """Write ``page_id, url, html`` rows as archives below ``path``; a null payload is an empty one."""
    if dictionary is None:
        dictionary = train_dictionary(pages)
    frames = with_references(pages, min_bytes=min_bytes).mapInArrow(_frames(dictionary, level), "value binary")
    # The bytes pass through the sink unchanged; the cast does not decode them.
    frames.select(F.col("value").cast("string")).write.option("lineSep", SEPARATOR).text(path)


class Corrupt(ValueError):
    pass


def frames(data: bytes) -> Iterator[tuple[int, bool, bytes]]:
    """Offset, whether it is skippable, and bytes (of a skippable frame: its content) of each frame."""
    at, view = 0, memoryview(data)
    while at < len(data):
        if len(data) - at < 8:
            raise Corrupt(f"{len(data) - at} stray bytes at {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == _SKIP:
            end = at + 8 + size
            if end > len(data):
                raise Corrupt(f"frame at {at} is cut off")
            yield at, True, bytes(view[at + 8 : end])
        elif magic == _FRAME:
            parameters = zstandard.get_frame_parameters(data[at : at + 18])
            end = at + zstandard.frame_header_size(data[at : at + 18])
            last = False
            while not last:
                if end + 3 > len(data):
                    raise Corrupt(f"frame at {at} is cut off")
                header = int.from_bytes(view[end : end + 3], "little")
                last, kind, length = header & 1, header >> 1 & 3, header >> 3
                end += 3 + (1 if kind == 1 else length)
            end += 4 * parameters.has_checksum
            if end > len(data):
                raise Corrupt(f"frame at {at} is cut off")
            yield at, False, bytes(view[at:end])
        else:
            raise Corrupt(f"no frame at {at}")
        at = end


def parse(data: bytes) -> dict:
    """Headers and payload of a record; raises when its form, lengths or digest are wrong."""
    head, found, rest = data.partition(_CRLF + _CRLF)
    lines = head.split(_CRLF)
    if not found or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise Corrupt("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Corrupt("a header line has no colon")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise Corrupt(f"{name} is missing")
    if not headers["content-length"].isdigit():
        raise Corrupt("content-length is no number")
    length = int(headers["content-length"])
    if rest[length:] != _CRLF + _CRLF:
        raise Corrupt(f"content-length is {length}, the block has {len(rest) - 4} bytes")
    http, found, payload = rest[:length].partition(_CRLF + _CRLF)
    declared = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
    if headers["warc-type"] not in ("response", "revisit") or not found or not declared:
        return {"headers": headers, "payload": rest[:length], "size": length}
    size = int(declared[1])
    if headers["warc-type"] == "response":
        digest = headers.get("warc-payload-digest", "")
        if size != len(payload):
            raise Corrupt(f"the payload has {len(payload)} bytes, its head says {size}")
        if digest and digest != f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}":
            raise Corrupt("the payload digest is wrong")
    return {"headers": headers, "payload": payload, "size": size}


_COLUMNS = pa.schema(
    {
        "path": pa.string(),
        "offset": pa.int64(),
        "record_type": pa.string(),
        "record_id": pa.string(),
        "uri": pa.string(),
        "refers_to": pa.string(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "payload": pa.binary(),
        "error": pa.string(),
    }
)


def _hex(digest: str | None) -> str | None:
    if not digest or not digest.startswith("sha1:"):
        return None
    try:
        return base64.b32decode(digest[5:]).hex()
    except ValueError:
        return None


def _records(path: str, data: bytes, max_record: int) -> Iterator[dict]:
    decoder = zstandard.ZstdDecompressor()
    try:
        for n, (at, skippable, frame) in enumerate(frames(data)):
            row = {"path": path, "offset": at, "error": None}
            if skippable:
                if n == 0 and data[:4] == struct.pack("<I", _DICTIONARY) and frame:
                    if frame[:4] == struct.pack("<I", _FRAME):
                        frame = zstandard.ZstdDecompressor().decompress(frame, max_output_size=max_record)
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frame))
                continue
            try:
                read = parse(decoder.decompress(frame, max_output_size=max_record))
            except (Corrupt, zstandard.ZstdError) as e:
                yield row | {"error": str(e)}
                continue
            headers = read["headers"]
            yield row | {
                "record_type": headers["warc-type"],
                "record_id": headers["warc-record-id"],
                "uri": headers.get("warc-target-uri"),
                "refers_to": headers.get("warc-refers-to"),
                "payload_bytes": read["size"],
                "payload_digest": _hex(headers.get("warc-payload-digest")),
                "payload": read["payload"],
            }
    except (Corrupt, zstandard.ZstdError) as e:
        yield {"path": path, "error": str(e)}


def _read(max_record: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(*(batch.column(i) for i in range(2)), strict=True):
                rows = []
                for row in _records(path.as_py(), data.as_py(), max_record):
                    rows.append(row)
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_pylist(rows, schema=_COLUMNS)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_COLUMNS)

    return run


def read_archives(spark: SparkSession, path: str, *, max_record: int = 256 << 20) -> DataFrame:
    """One row for each record, with ``error`` set where a record is damaged.

    After a damaged frame boundary nothing more can be found in that archive; that is one row too.
    ``payload_bytes`` of a revisit is the length its HTTP head states; its payload is empty. A record
    of more than ``max_record`` bytes is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    kinds = "path string, offset long, record_type string, record_id string, uri string, refers_to string"
    kinds += ", payload_bytes long, payload_digest string, payload binary, error string"
    return files.mapInArrow(_read(max_record), kinds)
