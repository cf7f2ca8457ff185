"""WARC archives with an index: written first, then read back by sorted byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import map_batches, written
from costflow.scratch import scratch_dir

#: Payloads below this many bytes are stored each, also if equal.
MIN_REVISIT_BYTES = 1000
#: An archive file is closed once it is this long.
FILE_BYTES = 1 << 30
#: Records of one stretch of a file are read by one task.
STRETCH_BYTES = 8 << 20
#: Ranges closer than this are read at once, up to READ_BYTES.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"

INDEX_SCHEMA = "page_id long, url string, record_type string, digest string, file string, offset long, length long"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


# -- one record ----------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """The bytes of one record; a revisit holds the HTTP head and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": f"<urn:page:{refers_to}>" if revisit else None,
        "Content-Type": RESPONSE_TYPE,
        "Content-Length": str(len(block)),
    }
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode().split("\r\n")[1:])
    return {k.lower(): v.strip() for k, v in pairs}


def _page_number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def parse(raw: bytes) -> dict:
    """A record's fields, and its payload (None for a revisit).

    Length and digest of a response are those of the payload that was read, which
    must be the header's; a revisit has the header's alone.
    """
    head, rest = raw.split(b"\r\n\r\n", 1)
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    told = int(_fields(http)["content-length"]), base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    size, digest = told if revisit else (len(payload), hashlib.sha1(payload).hexdigest())
    if (size, digest) != told:
        raise ValueError(f"{fields['warc-record-id']}: a payload of {size} bytes and digest {digest} was read, the header says {told}")
    return {
        "page_id": _page_number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page_number(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


# -- write ---------------------------------------------------------------------


def decided(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit) for `pages` (page_id, url, html).

    Originals are found from digests alone; the few that have copies join the
    pages by digest, and adaptive execution splits the rows of a hot digest.
    """
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copied = (
        rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("original"))
        .where("n > 1 and original is not null")
    )
    originals = written(copied.select("digest", "original"), "originals")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(originals, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("original")).alias("refers_to"), revisit.alias("revisit")
    )


def _write_task(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, offset = None, "", 0
        for batch in batches:
            index = []
            for page_id, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or offset >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    files, path = _open(name)
                    files.create_dir(path.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(path, compression=None)
                data = gzip.compress(record(page_id, url, payload, digest, refers_to, revisit, date), 4, mtime=0)
                out.write(data)
                index.append((page_id, url, "revisit" if revisit else "response", digest, name, offset, len(data)))
                offset += len(data)
            if index:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                columns = [pa.array(list(c), k) for c, k in zip(zip(*index, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "record_type", "digest", "file", "offset", "length"])
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes one record per row of `pages` below `folder`; the index as a written table.

    Of payloads that are equal and of at least MIN_REVISIT_BYTES, the one with
    the largest page_id is a response and the others revisit it; all others are
    responses. Every record is a gzip member of its own. A task writes files of
    fresh names, and only those of tasks that succeeded are in the index, so a
    retried task leaves no false entry.

    Null html is an empty payload, a null url an absent field. Rows without a
    page_id revisit a row that has one, else they are responses. Rows that repeat
    the largest page_id are all responses. Other columns are not read. An empty
    table gives an empty index.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    return written(map_batches(decided(pages), _write_task(folder, date), INDEX_SCHEMA), "warc_index")


# -- read ----------------------------------------------------------------------


def coalesced(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, int]]:
    """(file, start, end, rows in it): sorted ranges joined over small gaps."""
    current = None
    for file, offset, length in rows:
        end = offset + length
        if current and current[0] == file and offset - current[2] <= GAP_BYTES and max(end, current[2]) - current[1] <= READ_BYTES:
            current = (file, current[1], max(end, current[2]), current[3] + 1)
        else:
            if current:
                yield current
            current = (file, offset, end, 1)
    if current:
        yield current


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened, name = None, None
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        at = 0
        for file, start, end, n in coalesced(rows):
            if file != name:
                if opened is not None:
                    opened.close()
                files, path = _open(file)
                opened, name = files.open_input_file(path), file
            data = opened.read_at(end - start, start)
            found = [parse(gzip.decompress(data[o - start : o - start + k])) for _, o, k in rows[at : at + n]]
            at += n
            columns = [pa.array([r[c] for r in found], k) for c, k in zip(found[0], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, list(found[0]))
    if opened is not None:
        opened.close()


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of the index rows given.

    Rows of a stretch of a file meet in one task, sorted; neighbouring ranges
    are read at once. `payload` is null for a revisit. Tasks go by the bytes to
    read, not by the size of the index.
    """
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    total = index.agg(F.sum("length")).first()[0] or 0
    dealt = index.select("file", "offset", "length").repartition(max(1, ceil(total / STRETCH_BYTES)), F.col("file"), stretch)
    wanted = dealt.sortWithinPartitions("file", "offset")
    return map_batches(wanted, _read_task, RECORD_SCHEMA)
