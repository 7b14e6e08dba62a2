"""WARC archives, index first.

Tasks write records, each a gzip member of its own, to files in the shared
folder and return one index row per record: file, offset, length, URL, digest.
Reading starts from index rows: they are sorted by file and offset, neighbouring
byte ranges are coalesced into one read, and only the chosen records are parsed.

Records with equal payloads of at least `min_revisit` bytes are one response,
that with the smallest page_id, and revisits that refer to it; a null page_id
comes last, and rows that repeat the smallest page_id are responses each. A null
payload is empty, a null URL is left out of the record. An empty table writes no
file. Payloads of any size are one record each. A task that is run again writes
files of its own; only files that the index names belong to the archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import slices
from pairloom.session import checkpointed, scratch_path

_DATE = "2024-01-01T00:00:00Z"
_ID = "<urn:page:{}>"
#: Bytes of an archive after which a task begins another, most bytes of one read, and gap that a read bridges.
_FILE, _READ, _GAP = 1 << 30, 4 << 20, 64 << 10


def file_system(uri: str):
    """A file system that every executor reaches, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, kind: str) -> bytes:
    """One WARC record, uncompressed. A revisit carries the digest and length of its payload, not the payload."""
    body = b"" if kind == "revisit" else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {_DATE}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~-._"))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_ID.format(refers_to)}",
        ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(head) + len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + head + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def with_revisits(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """`page_id, url, html, digest, kind, refers_to` of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    held = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("html")).withColumn(
        "digest", F.sha2("html", 256)
    )
    # Digests alone are grouped; only those with several pages meet the payloads again.
    several = (
        held.where(F.octet_length("html") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
        .where("pages > 1")
        .select("digest", "first")
    )
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return held.join(several, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(later, "revisit").otherwise("response").alias("kind"),
        F.when(later, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 100) -> DataFrame:
    """Write a record per row under `folder`; the index, one row per record, is checkpointed."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, out, at = "", None, 0
        try:
            for piece in slices(batches, "html"):
                rows = []
                for page_id, url, html, digest, sort, refers in zip(*(c.to_pylist() for c in piece.columns)):
                    if out is None or at >= _FILE:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record(page_id, url, html, digest, refers, sort)) + packer.flush()
                    out.write(member)
                    rows.append((name, at, len(member), page_id, url, digest, sort))
                    at += len(member)
                columns = list(zip(*rows))
                kinds = [pa.string(), pa.int64(), pa.int64(), piece.schema.field("page_id").type, *[pa.string()] * 3]
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["file", "offset", "length", "page_id", "url", "digest", "kind"],
                )
        finally:
            if out is not None:
                out.close()

    marked = with_revisits(pages, min_revisit)
    return checkpointed(
        marked.mapInArrow(
            write, f"file string, offset bigint, length bigint, page_id {kind}, url string, digest string, kind string"
        )
    )


def coalesced(ranges: list[tuple[str, int, int]]) -> list[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted `(file, offset, length)` as reads `(file, begin, end, [(offset, length)])`."""
    reads: list[tuple[str, int, int, list[tuple[int, int]]]] = []
    for file, offset, length in ranges:
        if reads and reads[-1][0] == file and offset - reads[-1][2] <= _GAP and offset + length - reads[-1][1] <= _READ:
            own = reads[-1]
            own[3].append((offset, length))
            reads[-1] = (file, own[1], max(own[2], offset + length), own[3])
        else:
            reads.append((file, offset, offset + length, [(offset, length)]))
    return reads


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """`record_id, url, kind, digest, payload_bytes, refers_to, payload` of the records the index rows name.

    The digest of a response is computed from the payload that was read and must
    equal the one in its header.
    """
    fields = ["record_id", "url", "kind", "digest", "payload_bytes", "refers_to", "payload"]
    kinds = [*[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]

    def bare(urn: str | None) -> str | None:
        return None if urn is None else urn.removeprefix("<urn:page:").removesuffix(">") or None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, source = None, None
        for batch in batches:
            ranges = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for file, begin, end, members in coalesced(ranges):
                if file != name:
                    name, source = file, system.open_input_file(f"{root}/{file}")
                raw = source.read_at(end - begin, begin)
                rows = []
                for offset, length in members:
                    member = raw[offset - begin : offset - begin + length]
                    headers, payload = parse(zlib.decompress(member, 31))
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(headers["X-Payload-Length"])
                    if headers["WARC-Type"] == "response":
                        found = hashlib.sha256(payload).hexdigest()
                        if found != digest or len(payload) != size:
                            raise ValueError(f"damaged record at {file}:{offset}")
                    rows.append(
                        (
                            bare(headers["WARC-Record-ID"]),
                            headers.get("WARC-Target-URI"),
                            headers["WARC-Type"],
                            digest,
                            size,
                            bare(headers.get("WARC-Refers-To")),
                            payload,
                        )
                    )
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    return ordered.sortWithinPartitions("file", "offset").mapInArrow(
        read,
        "record_id string, url string, kind string, digest string, payload_bytes bigint, refers_to string, payload binary",
    )


def round_trip(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Write all pages to a new folder of archives and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, min_revisit), folder)
