"""Web pages into WARC archives and back.

A record is a gzip member of its own. Pages with equal payloads share one response, the one with the
smallest page_id; the others are revisit records that name it and hold headers only.

Archives are written by Spark's own text writer, so a lost task leaves no file behind and any
store that Spark writes to will do. That writer ends each line with a separator, here a zero byte.
The last byte of a gzip member is the highest of its length, zero below 16 MiB: there the
separator is that byte. Behind a longer member it is padding, which gzip allows.

The reader goes through an archive in order: it inflates small pieces, reads headers up to the blank
line, takes as many bytes as Content-Length says, and checks both digests.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table, with_group
from millrace.session import shared_folder

END = "\0"
PIECE = 1 << 16
#: Archives hold about this many bytes of payload.
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
READ_SCHEMA = (
    "record_id string, record_type string, refers_to string, target string, "
    "payload binary, payload_bytes long, payload_digest string"
)


class BadRecord(ValueError):
    """An archive that is cut short, or a record whose digest is not that of its bytes."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(
    page_id: int | None, url: str | None, payload: bytes, length: int, digest: str,
    refers_to: int | None, kind: str,
) -> bytes:
    """One gzip member. A revisit holds the response's headers and no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {length}\r\n\r\n"
    ).encode()
    block = http + (payload if kind == "response" else b"")
    target = quote(url or "", safe="%:/?#[]@!$&'()*+,;=~") or record_id(page_id)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{record_id(refers_to)}>")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def without_end(member: bytes) -> bytes:
    """What the writer is given, so that with its separator the member stands in the file."""
    return member[:-1] if member[-1] == 0 else member


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            rows = batch.slice(at, 256).to_pylist()
            members = [without_end(record(
                r["page_id"], r["url"], r["payload"], r["payload_bytes"], r["payload_digest"],
                r["refers_to"], r["record_type"],
            )) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])


def _headers(lines: bytes) -> dict[str, str]:
    fields = (line.partition(b":") for line in lines.split(b"\r\n")[1:] if line)
    return {k.strip().lower().decode(errors="replace"): v.strip().decode(errors="replace") for k, _, v in fields}


def _fail(reason: str):
    raise BadRecord(reason)


def records(archive: bytes) -> Iterator[dict]:
    """The records of an archive, one gzip member after the other."""
    view, at = memoryview(archive), 0
    while at < len(view):
        if view[at] == 0:  # padding between members
            at += 1
            continue
        inflater, held = zlib.decompressobj(31), bytearray()
        split, wanted, fields = -1, None, {}
        while not inflater.eof:
            if at >= len(view):
                _fail("the archive ends within a record")
            piece = view[at:at + PIECE]
            held += inflater.decompress(piece)
            at += len(piece) - len(inflater.unused_data)
            if split < 0 and (split := held.find(b"\r\n\r\n")) >= 0:
                fields = _headers(bytes(held[:split]))
                if not fields.get("content-length", "").isdigit():
                    _fail("a record does not say how long it is")
                wanted = int(fields["content-length"])
        if wanted is None or len(held) != split + 4 + wanted + 4 or held[-4:] != b"\r\n\r\n":
            _fail("a record is not as long as it says")
        yield _checked(fields, bytes(held[split + 4:split + 4 + wanted]))


def _sha1_in(field: str | None) -> str | None:
    """The digest that a field names, if it is a SHA-1 in base 32; those of other kinds are not checked."""
    kind, _, digest = (field or "").partition(":")
    return digest if kind.lower() == "sha1" and len(digest) == 32 else None


def _checked(fields: dict[str, str], block: bytes) -> dict:
    """A record, after the lengths and digests that it has were checked.

    The payload of a response over HTTP is what follows its head, and of any other record the block. What was sent in
    chunks, or cut off by who recorded it, has no length or digest to be held to.
    """
    kind = fields.get("warc-type")
    if kind is None:
        _fail("a record has no type")
    digest = _sha1_in(fields.get("warc-payload-digest"))
    if (own := _sha1_in(fields.get("warc-block-digest"))) and sha1_base32(block) != own:
        _fail("a block does not have its digest")
    payload, said = block, None
    if kind in ("response", "revisit") and fields.get("content-type", "").lower().startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _headers(head)
        said = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        if "transfer-encoding" in http or "warc-truncated" in fields:
            said = digest = None
    whole = kind != "revisit"
    if whole and (said not in (None, len(payload)) or digest and sha1_base32(payload) != digest):
        _fail("a payload does not have its digest")
    return {
        "record_id": fields.get("warc-record-id", "").strip("<>") or None, "record_type": kind,
        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
        "target": fields.get("warc-target-uri"), "payload": payload if whole else None,
        "payload_bytes": len(payload) if whole else said,
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
    }


def read_archives(spark: SparkSession, path: str, payloads: bool = True, names: str = "part-*") -> DataFrame:
    """All records of the archives below ``path``, of any type and writer; a damaged one is an error.

    ``names`` is a glob of their file names. Digests and lengths that a record has are checked, and what it does not
    say is NULL; a revisit's payload_bytes are those its HTTP head names. An archive is held in memory while it is
    read. A NULL payload is that of a revisit, or of any record if ``payloads`` is off; digests are
    checked all the same.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
        ("target", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ])

    def read(batches):
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for row in records(archive.as_buffer()):
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 300
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path)
    return files.select("content").mapInArrow(read, READ_SCHEMA)


def base32(hex_digest: Column) -> Column:
    """A SHA-1 in hex as upper-case base 32, digit by digit."""
    bits = F.concat(*[
        F.lpad(F.conv(F.substring(hex_digest, at, 10), 16, 2), 40, "0") for at in range(1, 41, 10)
    ])
    fives = F.regexp_extract_all(bits, F.lit("[01]{5}"), F.lit(0))
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.array_join(F.transform(
        fives, lambda five: F.substring(alphabet, F.conv(five, 2, 10).cast("int") + 1, 1)
    ), "")


def with_roles(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Pages with payload_bytes, payload_digest, record_type and refers_to.

    Payloads are equal when their lengths, SHA-1 and SHA-256 are. Among equal ones of at least
    ``smallest`` bytes the smallest page_id is the response, a NULL one if there is no other. Of
    repeated rows with that page_id all are responses, so no record refers to itself.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    digests = pages.select(
        "page_id", F.sha1(payload).alias("_sha1"), F.unhex(F.sha2(payload, 256)).alias("_sha2"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    ).distinct()
    roles = with_group(
        digests, ["_sha2", "_sha1", "payload_bytes"], ["page_id"],
        {"_part": F.min("page_id")}, {"_first": F.min("_part")},
    )
    response = (F.col("payload_bytes") < smallest) | F.col("page_id").eqNullSafe(F.col("_first"))
    return roles.select(
        "page_id", "_sha2", "payload_bytes", base32(F.col("_sha1")).alias("payload_digest"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("_first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, smallest: int = 0) -> None:
    """A WARC record for each row of ``pages`` (page_id, url, html), in files below ``path``.

    Payloads cross one shuffle, straight to the archive that they are for.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = max(1, -(-size // ARCHIVE_BYTES))
    rows = pages.select(
        F.col("page_id").alias("_page"), "url", payload.alias("_payload")
    ).withColumn("_digest", F.unhex(F.sha2("_payload", 256)))
    rows = rows.withColumn("_key", F.xxhash64("_page", "_digest")).repartition(archives, "_key")
    roles = with_roles(pages, smallest).withColumn("_key", F.xxhash64("page_id", "_sha2"))
    joined = rows.join(
        roles.repartition(archives, "_key").hint("shuffle_hash"),
        (rows["_key"] == roles["_key"]) & rows["_page"].eqNullSafe(roles["page_id"])
        & (rows["_digest"] == roles["_sha2"]),
    ).select(
        "page_id", "url", "payload_bytes", "payload_digest", "refers_to", "record_type",
        F.when(F.col("record_type") == "response", F.col("_payload")).otherwise(F.lit(b""))
        .alias("payload"),
    )
    members = joined.mapInArrow(_write, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", END).text(path)


@query("op4_warc", """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS h FROM pages
    ), g AS (
        SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first_id FROM p
    )
    SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr(
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(list_sum(list_transform(range(0, 5), lambda j:
                   CASE WHEN (instr('0123456789abcdef',
                                    substr(sha1(h), CAST((5 * i + j) // 4 + 1 AS INTEGER), 1)) - 1)
                             & (8 >> CAST((5 * i + j) % 4 AS INTEGER)) > 0
                        THEN 16 >> CAST(j AS INTEGER) ELSE 0 END)) AS INTEGER) + 1, 1)), '')
               AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM g
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    number = lambda name: F.expr(f"CAST(nullif(substring({name}, 10), '') AS BIGINT)")
    return read_archives(spark, path, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
