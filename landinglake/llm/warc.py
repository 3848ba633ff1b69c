"""WARC derivatives: a metadata and a plain-text conversion record for every response record.

Both name the response they come from (WARC-Refers-To), keep its target URI and date, and carry the
digest of their own block; the metadata record also lists the response's payload digest, its HTTP
status and headers, title, language and links. Both keep the response's WARC headers, with its own
payload and block digests as columns too. A written record names them ``WARC-Source-...`` (a
leading ``WARC-`` is not repeated, and ``Refers-To``, the target URI and the date are fields of the
record itself), as most of them would say something else about the derived record. Records become WARC files through Spark's text
writer, whose line separator is the end of a WARC record, and come back with ``read_warc``.

Every row is handled by itself, so nothing is shuffled. Edge cases: a null payload reads as empty
and still gives both records; a null URI or header is left out, and line ends in a header read as spaces; bytes that are not in the declared
character set are replaced; a body that is compressed or chunked, as its HTTP head says, is unpacked for
its text and read as it is where that fails; a very long body is one row's work; repeated responses give repeated records with equal ids; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
RESPONSES = ("record_id string, target_uri string, date string, headers map<string,string>, "
             "http_head string, payload binary")
DERIVED = ("record_id string, warc_type string, refers_to string, target_uri string, date string, "
           "content_type string, content_length bigint, block_digest string, "
           "source_digest string, source_headers map<string,string>, "
           "source_payload_digest string, source_block_digest string, block string")

# Content that is not text, tags that begin a new line, and what is left of a tag.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)",
                     re.S | re.I)
_BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer"
    r"|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th"
    r"|thead|title|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"<(?:/?[a-z!?][^>]*)>", re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANGUAGE = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PRE = re.compile(r"(<pre\b[^>]*>.*?(?:</pre\s*>|\Z))", re.S | re.I)
_LINE_END = re.compile(r"\r\n?|\f")
_CODED = re.compile(r"^(content|transfer)-encoding\s*:\s*([^\r\n]*)", re.M | re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_name(*parts: str | None) -> str:
    """A record id that depends on the parts alone."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def html_text(page: str) -> str:
    """Visible text: one line per block element, white space within lines collapsed. A line end of
    the source is white space like any other, but for those inside ``pre``."""
    parts = _PRE.split(_HIDDEN.sub(" ", page))
    marked = [_LINE_END.sub("\n", part) if number % 2 else " ".join(re.split(r"\s+", part))
              for number, part in enumerate(parts)]
    visible = _TAG.sub("", _BREAKS.sub("\n", "".join(marked)))
    lines = (" ".join(html.unescape(line).split()) for line in visible.split("\n"))
    return "\n".join(line for line in lines if line)


def _unchunked(body: bytes) -> bytes:
    """A body in HTTP chunks put together; what does not parse as chunks is kept."""
    found, at = [], 0
    while at < len(body):
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end if end >= 0 else len(body)].split(b";")[0].strip(), 16)
        except ValueError:
            return b"".join(found) + body[at:] if found else body
        if end < 0 or size < 0 or not size:
            break
        found.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(found)


def _inflated(body: bytes, window: int) -> bytes:
    """What can be read of a compressed body, however many members it has."""
    found = []
    while body:
        unpacker = zlib.decompressobj(window)
        try:
            found.append(unpacker.decompress(body))
        except zlib.error:
            break
        body = unpacker.unused_data
    return b"".join(found)


def unpacked(payload: bytes, http_head: str) -> bytes:
    """The payload without the chunks and compression that its HTTP head declares."""
    coded = {kind.lower(): [c.strip().lower() for c in value.split(",") if c.strip()]
             for kind, value in _CODED.findall(http_head)}
    if "chunked" in coded.get("transfer", []):
        payload = _unchunked(payload)
    for coding in reversed(coded.get("content", [])):
        if coding in ("gzip", "x-gzip"):
            payload = _inflated(payload, 31) or payload
        elif coding == "deflate":
            payload = _inflated(payload, 15) or _inflated(payload, -15) or payload
    return payload


def _decoded(payload: bytes, content_type: str) -> str:
    named = _CHARSET.search(content_type)
    try:
        charset = codecs.lookup(named.group(1)).name if named else "utf-8"
        return payload.decode(charset, "replace")
    except (LookupError, ValueError):  # unknown, or no text encoding
        return payload.decode("utf-8", "replace")


def _one_line(text: str) -> str:
    return " ".join(text.split())


def metadata_fields(page: str, http_head: str, payload_digest: str) -> str:
    """The application/warc-fields block of a metadata record."""
    status, *headers = (http_head or "").split("\r\n")
    fields = [("payload-digest", payload_digest)]
    if status:
        fields.append(("http-status", _one_line(status)))
    fields += [("http-header", _one_line(header)) for header in headers if header.strip()]
    visible = _HIDDEN.sub(" ", page)
    for name, pattern in (("title", _TITLE), ("language", _LANGUAGE)):
        found = pattern.search(visible)
        if found:
            fields.append((name, _one_line(html.unescape(found.group(1)))))
    fields += [("outlink", _one_line(html.unescape("".join(link)))) for link
               in _LINK.findall(visible)]
    return "".join(f"{name}: {value}\r\n" for name, value in fields)


def _header(headers: list[tuple[str, str | None]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name), None)


def derive(responses: DataFrame) -> DataFrame:
    """``DERIVED``: the metadata and the conversion record of each of ``RESPONSES``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = ["record_id", "warc_type", "refers_to", "target_uri", "date", "content_type",
                  "content_length", "block_digest", "source_digest", "source_headers",
                  "source_payload_digest", "source_block_digest", "block"]
        types = {"content_length": pa.int64(), "source_headers": pa.map_(pa.string(), pa.string())}
        for batch in batches:
            rows = []
            for source in batch.to_pylist():
                payload, head = source["payload"] or b"", source["http_head"] or ""
                payload_digest = digest(payload)
                headers = source["headers"] and list(source["headers"])
                given = [_header(headers or [], f"warc-{part}-digest")
                         for part in ("payload", "block")]
                page = _decoded(unpacked(payload, head), head)
                for kind, content_type, block in (
                        ("metadata", "application/warc-fields",
                         metadata_fields(page, head, payload_digest)),
                        ("conversion", "text/plain; charset=utf-8", html_text(page))):
                    block = block.encode("utf-8", "replace")
                    rows.append((record_name(kind, source["record_id"]), kind, source["record_id"],
                                 source["target_uri"], source["date"], content_type, len(block),
                                 digest(block), payload_digest, headers, *given,
                                 block.decode()))
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, types.get(n, pa.string())) for c, n in zip(columns, schema)],
                names=schema)

    wanted = [c.split()[0] for c in RESPONSES.split(", ")]
    return responses.select(*wanted).mapInArrow(build, DERIVED)


def page_responses(pages: DataFrame, date: str, key: str = "page_id") -> DataFrame:
    """``RESPONSES`` for crawled pages (page_id, url, html), as a crawler would have stored them."""
    name = F.sha1(F.concat_ws("|", F.col(key).cast("string"), "url"))
    parts = [F.substring(name, 1, 8), F.substring(name, 9, 4),
             F.concat(F.lit("5"), F.substring(name, 14, 3)),
             F.concat(F.lit("8"), F.substring(name, 18, 3)), F.substring(name, 21, 12)]
    record_id = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8")
    return pages.select(
        record_id.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.create_map(F.lit("WARC-Type"), F.lit("response")).alias("headers"),
        head.alias("http_head"), F.coalesce(F.col("html"), F.lit("")).cast("binary")
        .alias("payload"))


def warc_text(records: DataFrame) -> Column:
    """A derived record as WARC text, without the two line ends that close it."""
    def header(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))

    own = ["warc-record-id", "warc-target-uri", "warc-date"]
    source = F.filter(F.map_entries(records["source_headers"]), lambda e: e["value"].isNotNull()
                      & ~F.lower(e["key"]).isin(own))
    fields = F.transform(source, lambda e: F.concat(
        F.lit("WARC-Source-"), F.regexp_replace(e["key"], "^(?i:WARC-)", ""), F.lit(": "),
        F.regexp_replace(e["value"], "[\r\n]+", " "), F.lit("\r\n")))
    return F.concat_ws(
        "", F.lit(f"{VERSION}\r\n"), header("WARC-Type", records["warc_type"]),
        header("WARC-Record-ID", records["record_id"]),
        header("WARC-Refers-To", records["refers_to"]),
        header("WARC-Target-URI", records["target_uri"]), header("WARC-Date", records["date"]),
        header("WARC-Block-Digest", records["block_digest"]), F.array_join(fields, ""),
        header("Content-Type", records["content_type"]),
        header("Content-Length", records["content_length"].cast("string")), F.lit("\r\n"),
        records["block"])


def write_warc(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Write derived records as WARC files, one per task."""
    records.select(warc_text(records)).write.option("lineSep", RECORD_END) \
        .option("compression", compression).text(folder)


def _members(content: bytes) -> Iterator[bytes]:
    """The members of a gzip file one after the other, or a plain file as it is."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    left = memoryview(content)
    while len(left):
        unpacker = zlib.decompressobj(31)
        yield unpacker.decompress(left)
        left = left[len(left) - len(unpacker.unused_data):] if unpacker.eof else left[:0]
        while len(left) and left[0] == 0:  # padding between members
            left = left[1:]


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file, gzipped or not.

    A gzip member is unpacked when the one before is used up, so a file whose records are members
    each, as is usual, needs room for one record beside the file.
    """
    buffer = b""
    members = _members(content)
    while True:
        at = buffer.find(b"WARC/")
        end = buffer.find(b"\r\n\r\n", at) if at >= 0 else -1
        if end >= 0:
            lines = buffer[at:end].decode("utf-8", "replace").split("\r\n")[1:]
            headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            length = next((v for k, v in headers.items() if k.lower() == "content-length"), "")
            length = int(length) if length.isdigit() else 0
        more = b"" if end >= 0 and len(buffer) >= end + 4 + length else next(members, None)
        if more:
            buffer += more
        elif end < 0 and more is None:
            return
        elif end >= 0 and (more is None or len(buffer) >= end + 4 + length):
            yield headers, buffer[end + 4:end + 4 + length]
            buffer = buffer[end + 4 + length:]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of every record of the WARC files at ``path``; a file, of at most 2 GB,
    is one task's."""

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                found = list(parse_warc(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([list(h.items()) for h, _ in found],
                              pa.map_(pa.string(), pa.string())),
                     pa.array([b for _, b in found], pa.binary())], names=["headers", "block"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, "headers map<string,string>, block binary")


def _named(name: str) -> Column:
    """A header's value, whatever the case its name is written in."""
    found = F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == name)
    return F.get(found, F.lit(0))["value"]


def responses(records: DataFrame) -> DataFrame:
    """``RESPONSES`` among records as ``read_warc`` gives them."""
    block = F.col("block")
    # The head ends at the first empty line; Latin-1 keeps one character per byte.
    end = F.instr(F.decode(block, "ISO-8859-1"), "\r\n\r\n")
    return records.filter(F.lower(_named("warc-type")) == "response").select(
        _named("warc-record-id").alias("record_id"),
        _named("warc-target-uri").alias("target_uri"),
        _named("warc-date").alias("date"), "headers",
        F.when(end > 0, F.decode(F.substring(block, F.lit(1), end - 1), "ISO-8859-1"))
        .alias("http_head"),
        F.when(end > 0, F.substring(block, end + 4, F.length(block))).otherwise(block)
        .alias("payload"))
