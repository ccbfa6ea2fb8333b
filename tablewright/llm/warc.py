"""WARC archives: one gzip member per record, written by tasks and read back record by record.

The writer puts each page into an HTTP response record, or into a revisit record that refers to the page with the same
payload. The reader goes through an archive once, inflates member by member, frames each record by its content length
and verifies its digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import col, make_rows, store
from tablewright.session import cut_lineage, scratch_path

#: Payloads of fewer bytes are never revisits.
MIN_BYTES = 0
#: A task goes on to another archive beyond this size, so that one task reads an archive in minutes.
MAX_ARCHIVE_BYTES = 256 * 2**20
CHUNK = 2**20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
DATE = "1970-01-01T00:00:00Z"
_PAGE = re.compile(r"<urn:page(-text)?:([^<>]*)>").fullmatch

Id = int | str


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(page_id: Id) -> str:
    return f"<urn:page:{page_id}>" if isinstance(page_id, int) else f"<urn:page-text:{quote(page_id)}>"


def page_of(found: str | None) -> Id | None:
    match = _PAGE(found or "")
    return match and (unquote(match[2]) if match[1] else int(match[2]))


def record(page_id: Id | None, url: str | None, payload: bytes, refers_to: Id | None, date: str = DATE) -> bytes:
    """One record as a gzip member. Ids are numbers, or text that is percent-encoded. A revisit keeps the HTTP head, with the payload's length, and leaves out the payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {urn(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {quote(url, safe=_URL)}"] if url else []),
        *([f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return press.compress(raw) + press.flush()


_URL = "!#$%&'()*+,/:;=?@[]~"


def planned(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html and refers_to: the smallest page_id with an equal payload of ``min_bytes`` at least, where it is another.

    Null html is an empty payload. Rows without an id are never revisits, and repeated rows with the smallest id are all
    responses. Ids of any type that casts to text and back are compared in their own type. Payloads are compared by their SHA-1; only pages whose payload occurs more than once are looked up.
    """
    rows = pages.select(
        col("page_id"), col("url").cast("string").alias("url"), F.coalesce(col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("sha1", F.unhex(F.sha1("html")))
    first = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    other = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return rows.join(first, "sha1", "left").select("page_id", "url", "html", other.alias("refers_to"))


def write_archives(plan: DataFrame, folder: str, max_bytes: int = MAX_ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``planned`` pages under ``folder``; path of each archive and its records.

    An attempt writes under names of its own, and only the archives of attempts that succeeded are in the result.
    """

    def work(batches):
        fs, top = store(folder)
        fs.create_dir(top, recursive=True)
        done, out, path, n = [], None, "", 0
        for columns in batches:
            for page_id, url, html, refers_to in zip(*columns, strict=True):
                if out is None:
                    path, n = f"{top}/{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(path, compression=None)
                ids = [x if x is None else read(x) for x in (page_id, refers_to)]
                out.write(record(ids[0], url, html.encode(), ids[1]))
                n += 1
                if out.tell() >= max_bytes:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield [[p for p, _ in done], [n for _, n in done]]

    read = int if isinstance(plan.schema["page_id"].dataType, T.IntegralType) else str
    plan = plan.select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"))
    return cut_lineage(make_rows(plan, [("path", pa.string()), ("records", pa.int64())], work))


def members(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member, inflated chunk by chunk."""
    offset, rest, at_end = 0, b"", False
    while True:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not rest:
                rest = stream.read(CHUNK)
                at_end = not rest
            if at_end:
                if used:
                    raise ValueError(f"the member at {offset} is cut short")
                return
            parts.append(inflate.decompress(rest))
            used += len(rest) - len(inflate.unused_data)
            rest = inflate.unused_data
        yield offset, b"".join(parts)
        offset += used


def parsed(content: bytes) -> dict:
    """A record's fields, after its frame and digests are verified."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {fields['warc-record-id']}: its block is not {length} bytes long")
    block = rest[:length]
    if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"record {fields['warc-record-id']}: the block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"record {fields['warc-record-id']}: the payload differs")
    return {
        "page_id": page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size,
        "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": page_of(fields.get("warc-refers-to")),
        "payload": payload,
    }


KINDS = [
    ("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
]


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The records of the archives (path) below ``folder``, in tasks that read one archive after the other.

    Ids are text. A broken frame or digest ends the job with the record's name.
    """

    def work(batches):
        fs, _ = store(folder)
        for columns in batches:
            for path in columns[0]:
                rows = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for offset, content in members(stream):
                        x = parsed(content)
                        x.update((k, x[k] if x[k] is None else str(x[k])) for k in ("page_id", "refers_to"))
                        rows.append((path, offset, *(x[n] for n, _ in KINDS[2:])))
                        if len(rows) == 1000:
                            yield [list(c) for c in zip(*rows, strict=True)]
                            rows = []
                if rows:
                    yield [list(c) for c in zip(*rows, strict=True)]

    return make_rows(archives.select("path").repartition(max(1, archives.count()), "path"), KINDS, work)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives and read them back, with ids in the type they came in.

    An empty table writes none and gives no rows. Every row stays, repeated ones and those without an id too; columns
    other than page_id, url and html are not looked at.
    """
    folder = folder or scratch_path(pages.sparkSession, "archives")
    plan = planned(pages)
    kind = plan.schema["page_id"].dataType
    back = read_archives(write_archives(plan, folder), folder)
    return back.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
