"""WARC archives written and read by Spark, with a reader that salvages damaged files.

Writing: a record per page, as text lines of a Spark text table (the last
byte of a record's closing CRLF CRLF is the line separator), so the files
land wherever Spark can write, with its commit protocol.  Payloads that occur
again become revisits of the page with the largest id.

Reading: archives (plain, or of gzip members with any number of records) are
walked record by record.  Where a check fails - version line, header, length,
closing bytes, digest, gzip stream or checksum - the reader looks for the next
version line or gzip member that starts a valid record, logs the bytes in
between as a gap and goes on from there.  It does the same inside a gzip
member, with what could be unpacked of it; of a member that is itself damaged
only records that pass a digest of their own count.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.groups import column
from zonecast.llm.shared import materialize

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 128 << 20        # of one archive; a longer record is an archive of its own
LARGE_RECORD = 8 << 20
_HEADER_BYTES = 2048             # more than the headers of a record, its url aside
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"


def _record_id(page: Column, other: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page.cast("string"), other)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def warc_records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
                 date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: a WARC record per row, short of its last line feed.

    A null html is an empty payload.  Payloads of at least 1000 bytes that are
    equal are stored once, with the largest page_id; rows without page_id are
    always stored.  A null url leaves the header out; line breaks in a url are
    percent-encoded.  Other columns are ignored.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page"),
                        F.replace(F.replace(F.col(url).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "n": F.octet_length("html").cast("long")})
    big = rows.where((F.col("n") >= MIN_REVISIT_BYTES) & F.col("page").isNotNull())
    first = big.groupBy("digest", "n").agg(F.max("page").alias("keeper"), F.min("page").alias("least"))
    first = materialize(first.where("keeper > least").drop("least"), "warc-keepers")
    rows = rows.join(first, ["digest", "n"], "left")
    revisit = F.coalesce(F.col("page") < F.col("keeper"), F.lit(False))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    rows = rows.withColumns({"revisit": revisit, "block": F.when(revisit, head).otherwise(F.concat(head, F.col("html")))})

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))
    value = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page"), F.concat_ws(" ", "digest", "url"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1("block"))),
        line("WARC-Page-ID", F.col("page").cast("string")),
        line("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("keeper"), F.lit("")))),
        line("WARC-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("keeper").cast("string"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(_CRLF), F.col("block"), F.lit("\r\n\r"))
    return rows.select(value.alias("value"))


def write_warc(pages: DataFrame, path: str, *, archive_bytes: int = ARCHIVE_BYTES, large: int = LARGE_RECORD, **names) -> None:
    """Write :func:`warc_records` as archives of at most ``archive_bytes`` below ``path``.

    A file takes so many records that even the longest ones fit.  Records of
    over ``large`` bytes go to files of their own kind, so that a few of them
    do not make all files small; a record beyond the bound stands alone.
    """
    size = F.octet_length(F.coalesce(F.col(names.get("html", "html")).cast("string"), F.lit(""))).cast("long")
    size = size + 3 * F.octet_length(F.coalesce(F.col(names.get("url", "url")).cast("string"), F.lit(""))) + _HEADER_BYTES
    longest = pages.agg(F.max(F.when(size <= large, size)).alias("small"), F.max(F.when(size > large, size)).alias("large")).first()
    records = warc_records(pages, **names).withColumn("long", F.octet_length("value") > large)
    for is_large, most in ((False, longest["small"]), (True, longest["large"])):
        if most or not is_large:
            # records of the larger kind are told by their real size, which is at most the estimate
            bound = max(most or 0, 0 if is_large else min(large, longest["large"] or 0)) or 1
            (records.where(F.col("long") == is_large).select("value").write.mode("append").option("lineSep", "\n")
             .option("maxRecordsPerFile", max(1, archive_bytes // bound)).text(path))


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_PIECE = 1 << 16
_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


class _Damaged(ValueError):
    pass


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for one in raw.split(b"\r\n"):
        name, sep, value = one.partition(b":")
        if not sep:
            raise _Damaged("header line without a colon")
        out[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isascii() and text.lstrip("-").isdigit() else None


def _digest_of(value: str | None) -> str | None:
    kind, _, digest = (value or "").partition(":")
    return digest.lower() if kind.lower() == "sha1" and re.fullmatch("[0-9a-fA-F]{40}", digest) else None


def parse_record(data: bytes, at: int, verified: bool = False) -> tuple[dict, int]:
    """The record that starts at ``at`` and where it ends; raises ``ValueError`` if a check fails.

    With ``verified`` a record without a block digest fails too.
    """
    m = _VERSION.match(data, at)
    if not m:
        raise _Damaged("no version line")
    end = data.find(b"\r\n\r\n", m.end())
    if end < 0:
        raise _Damaged("header does not end")
    headers = _headers(data[m.end():end])
    n = _number(headers.get("content-length"))
    if n is None or n < 0:
        raise _Damaged("no content length")
    begin, stop = end + 4, end + 4 + n
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise _Damaged("record is cut or its length is wrong")
    block = data[begin:stop]
    want = _digest_of(headers.get("warc-block-digest"))
    if want and hashlib.sha1(block).hexdigest() != want:
        raise _Damaged("block digest differs")
    if verified and not want:
        raise _Damaged("nothing vouches for the record")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = _headers(head.partition(b"\r\n")[2]) if b"\r\n" in head else {}
    kind = headers.get("warc-type", "")
    stated = _digest_of(headers.get("warc-payload-digest"))
    if kind == "revisit":
        size, digest = _number(http.get("content-length")), stated
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if stated and digest != stated:
            raise _Damaged("payload digest differs")
    return {"type": kind, "record_id": headers.get("warc-record-id"), "url": headers.get("warc-target-uri"),
            "page_id": _number(headers.get("warc-page-id")), "payload_bytes": size, "payload_digest": digest,
            "refers_to": _number(headers.get("warc-refers-to-page-id")), "payload": payload}, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int | None, str]:
    """What can be unpacked of the gzip member that starts at ``at``, where it ends (None if its stream breaks), and what is wrong with it."""
    z, parts, end = zlib.decompressobj(-15), [], _gzip_body(data, at)
    try:
        while end < len(data) and not z.eof:
            parts.append(z.decompress(data[end:end + _PIECE]))
            end = min(end + _PIECE, len(data))
    except zlib.error as e:
        return b"".join(parts), None, f"gzip: {e}"
    inner, end = b"".join(parts), end - len(z.unused_data)
    if not z.eof or end + 8 > len(data):
        return inner, None, "gzip member is cut"
    checksum, size = struct.unpack("<II", data[end:end + 8])
    wrong = zlib.crc32(inner) != checksum or len(inner) & 0xFFFFFFFF != size
    return inner, end + 8, "gzip: checksum differs" if wrong else ""


def _gzip_body(data: bytes, at: int) -> int:
    """Where the deflate stream of a gzip member begins; raises ``ValueError`` if its header is none."""
    flags = data[at + 3] if at + 10 <= len(data) else 0xFF
    if flags & 0xE0:
        raise _Damaged("no gzip header")
    p = at + 10
    if flags & 4:
        p += 2 + int.from_bytes(data[p:p + 2], "little")
    for bit in (8, 16):                      # name, comment
        if flags & bit:
            stop = data.find(b"\0", p)
            if stop < 0:
                raise _Damaged("gzip header does not end")
            p = stop + 1
    return p + 2 * bool(flags & 2)


def salvage(data: bytes, verified: bool = False):
    """Yield ``(offset, end, record)`` for every valid record and ``(offset, end, reason)`` for every gap.

    Together they cover ``data``, but that the records and gaps of a gzip
    member all have the member's own place; the place inside the unpacked
    member is in the record's ``inner`` or the gap's reason.  With
    ``verified`` only records with a block digest are valid.
    """
    at, bad, reason = 0, None, ""
    while at < len(data):
        try:
            if data[at:at + 3] == b"\x1f\x8b\x08":
                inner, end, wrong = _member(data, at)
                found = list(salvage(inner, bool(wrong) or verified))
                if wrong and not any(isinstance(r, dict) for _, _, r in found):
                    raise _Damaged(wrong)
                rows = [{**r, "inner": a} if isinstance(r, dict) else f"in the member, bytes {a} to {b}: {r}" for a, b, r in found]
                if wrong:
                    rows.append(wrong)
                if end is None:          # the member breaks off: what follows is searched for the next start
                    m = _START.search(data, at + 1)
                    while m and not _starts(data, m.start()):
                        m = _START.search(data, m.start() + 1)
                    end = m.start() if m else len(data)
            else:
                record, end = parse_record(data, at, verified)
                rows = [record]
        except ValueError as e:
            if bad is None:
                bad, reason = at, str(e)
            m = _START.search(data, at + 1)
            at = m.start() if m else len(data)
            continue
        if bad is not None:
            yield bad, at, reason
            bad = None
        for row in rows:
            yield at, end, row
        at = end
    if bad is not None:
        yield bad, len(data), reason


def _starts(data: bytes, at: int) -> bool:
    """Whether a valid record, or a member that holds one, starts at ``at``."""
    try:
        if data[at:at + 3] != b"\x1f\x8b\x08":
            parse_record(data, at)
            return True
        inner, _, wrong = _member(data, at)
        return any(isinstance(r, dict) for _, _, r in salvage(inner, bool(wrong)))
    except ValueError:
        return False


_FIELDS = (("type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("page_id", pa.int64()),
           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()))


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every valid record below ``path`` and, as rows of type ``gap``, what had to be left out.

    Columns: archive, offset, end (bytes in the archive), inner (place in the
    unpacked gzip member), type, record_id, url, page_id, payload_bytes,
    payload_digest, refers_to, payload, reason (of a gap).  An empty file has
    no rows.  A task holds one archive at a time, so archives should be
    bounded, as :func:`write_warc` makes them; Spark's reader takes up to 2 GB.
    """
    kinds = "archive string, offset long, end long, inner long, type string, record_id string, url string, page_id long, " \
            "payload_bytes long, payload_digest string, refers_to long, payload binary, reason string"

    def out(name, part):
        found = [r if isinstance(r, dict) else {"type": "gap"} for _, _, r in part]
        values = [pa.array([f.get(c) if c != "payload" or payloads else None for f in found], t) for c, t in _FIELDS]
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(part)), pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
             pa.array([f.get("inner") for f in found], pa.int64()), *values,
             pa.array([r[2] if isinstance(r[2], str) else None for r in part], pa.string())],
            names=["archive", "offset", "end", "inner", *[c for c, _ in _FIELDS], "reason"])

    def run(batches):
        for batch in batches:
            for name, content in zip(column(batch, "path"), column(batch, "content"), strict=True):
                part, size = [], 0
                for row in salvage(content.as_py()):
                    part.append(row)
                    size += len(row[2]["payload"]) if isinstance(row[2], dict) else 0
                    if len(part) >= 500 or size >= _PIECE << 8:
                        yield out(name.as_py(), part)
                        part, size = [], 0
                if part:
                    yield out(name.as_py(), part)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, kinds)
