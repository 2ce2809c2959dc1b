"""WARC archives: a writer, and a reader that salvages what it can from damaged ones."""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, map_arrow
from eventfares.settings import new_path

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 2000
RECORD_DATE = "2000-01-01T00:00:00Z"
ID_FORMAT = "<urn:page:%s>"

# Signs of the format.
VERSION = b"WARC/1."
MEMBER = b"\x1f\x8b\x08"
HEAD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MEMBERS = pa.schema([("member", pa.binary())])
_RECORDS = pa.schema(
    [
        ("archive", pa.string()),
        ("kind", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("reason", pa.string()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to", pa.string()),
        ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("inner_offset", pa.int64()),
        ("inner_length", pa.int64()),
    ]
)


# Writing


def write_warc(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT_BYTES) -> None:
    """Write `pages(page_id, url, html)` below `path`, one gzip member per record.

    Of records whose payloads are equal and of at least `min_revisit` bytes, those with the largest
    page id are responses and the others revisit them; shorter ones are all responses. A null html
    is an empty payload; a null url has no target URI. A null page id is written as such and ranks
    below all others; rows that repeat a page id and its payload are written alike. Other columns
    are not looked at, and no pages leave an empty folder of archives.
    """
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    marked = pages.withColumn("sha", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    marks = marks_of(marked).where(F.col("n") >= min_revisit)
    held = marks.groupBy("sha", "n").agg(F.max("page_id").alias("keep_id"), F.count("*").alias("copies"))
    revisits = (
        marks.join(held.where("copies > 1 and keep_id is not null"), ["sha", "n"])
        .where("page_id is null or page_id < keep_id")
        .select(F.col("page_id").alias("r_page"), F.col("sha").alias("r_sha"), "keep_id")
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("sha") == F.col("r_sha"))
    rows = marked.join(revisits, same, "left").select("page_id", "url", "payload", "keep_id")
    members = map_arrow(rows, _write_members, _MEMBERS)
    # The text writer puts down raw bytes. Every member ends in a zero byte (see `_member`), which
    # is taken off here and put back as the line separator.
    lines = members.select(F.expr("substr(member, 1, octet_length(member) - 1)").cast("string").alias("value"))
    lines.write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def marks_of(marked: DataFrame) -> DataFrame:
    return marked.select("page_id", "sha", "n")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, keep_id: int | None) -> bytes:
    """One record in the clear. With a `keep_id` it is a revisit of that page, without payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if keep_id is None else 'revisit'}",
        f"WARC-Record-ID: {ID_FORMAT % ('null' if page_id is None else page_id)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: {digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if keep_id is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {ID_FORMAT % keep_id}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append("WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode())
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + HEAD_END + block + HEAD_END


def _member(record: bytes) -> bytes:
    """`record` as gzip. Ends in a zero byte: a member ends with its length, lowest byte first, and
    one of 16 MiB or more is followed by an empty member."""
    member = _gzip(record)
    return member if member[-1] == 0 else member + _gzip(b"")


def _gzip(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _write_members(batches):
    for batch in batches:
        # Few at a time, as a batch may hold long payloads.
        for start in range(0, batch.num_rows, 64):
            rows = batch.slice(start, 64).to_pylist()
            yield batch_of(_MEMBERS, [_member(record_bytes(r["page_id"], r["url"], r["payload"], r["keep_id"])) for r in rows])


# Reading


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives below `path`.

    `kind` is `record` or `gap`; `offset` and `length` are its bytes in `archive`. Archives may be
    plain or have one or more records in a gzip member. A record counts when its member unpacks, its
    head and lengths are sound, and its block and payload have the digests they claim. After a
    failed check the reader looks for the next gzip sign or version line from which a sound record
    can be read; the bytes between are one gap, with the first `reason`. In a member it looks for the
    next version line in the unpacked bytes, so a fault costs no other record: `inner_offset` and
    `inner_length` are the unpacked bytes of a member's record or gap. Of a member that does not
    unpack to its end, the records before the fault count if they have a digest that was checked;
    the gap then starts at the fault. (Digests do not cover a record's head.) A revisit has the length
    and digest of the payload it stands for. An archive is read as one row, so it is at most 2 GB,
    and a task holds one at a time. `payloads=False` leaves the payload null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)

    def scan(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from _rows(archive, memoryview(content.as_buffer()), payloads)

    return map_arrow(files.select("path", "content"), scan, _RECORDS)


def records(archive: DataFrame) -> DataFrame:
    return archive.where("kind = 'record'").drop("kind", "reason")


def gaps(archive: DataFrame) -> DataFrame:
    return archive.where("kind = 'gap'").select("archive", "offset", "length", "reason", "inner_offset", "inner_length")


def whole(archive: DataFrame) -> DataFrame:
    """The records of archives that should have no gap. A gap fails the query and is named."""
    parts = [F.lit("gap in"), "archive", F.lit("at"), "offset", F.lit("of"), "length", F.lit("bytes:"), "reason"]
    # One filter, so that no other is put before it.
    sound = F.when(F.col("kind") == "gap", F.raise_error(F.concat_ws(" ", *parts)).cast("boolean"))
    return archive.where(sound.otherwise(F.col("kind") == "record")).drop("kind", "reason")


def _rows(archive: str, data: memoryview, payloads: bool):
    held, size = [], 0
    for kind, offset, length, found, *inner in _salvage(data):
        if kind == "gap":
            held.append((archive, kind, offset, length, found, *[None] * 7, *inner))
        else:
            payload = found.pop("payload")
            held.append((archive, kind, offset, length, None, *found.values(), payload if payloads else None, *inner))
            size += len(payload) if payloads else 0
        if len(held) >= 1000 or size >= 8 << 20:
            yield batch_of(_RECORDS, *zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield batch_of(_RECORDS, *zip(*held, strict=True))


class Damaged(ValueError):
    """A check of a record failed."""


def salvage(data: memoryview):
    """`("record", offset, length, fields)` and `("gap", offset, length, reason)`, in order."""
    for found in _salvage(data):
        yield found[:4]


def _salvage(data: memoryview):
    """As `salvage`, each with its offset and length in the unpacked member, or nulls."""
    whole = data.obj if isinstance(data.obj, bytes) and len(data.obj) == len(data) else bytes(data)
    at, gap, reason, inner = 0, None, None, (None, None)
    while at < len(whole):
        try:
            found, end, fault = _read_at(whole, at)
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = _next_sign(whole, at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason, *inner
            gap, inner = None, (None, None)
        for kind, value, *place in found:
            yield kind, at, end - at, value, *place
        at = end
        if fault is not None:
            gap, (reason, *inner) = end, fault
            at = _next_sign(whole, end)
    if gap is not None:
        yield "gap", gap, len(whole) - gap, reason, *inner


def _next_sign(data: bytes, start: int) -> int:
    places = [p for p in (data.find(MEMBER, start), data.find(VERSION, start)) if p >= 0]
    return min(places, default=len(data))


def _read_at(data: bytes, at: int) -> tuple[list[tuple], int, tuple | None]:
    """What the member or plain record at `at` has, where it ends, and the gap that follows if it
    does not unpack further: its reason, and its unpacked offset and length."""
    if not data.startswith(MEMBER, at):
        fields, end = _record(data, at)
        return [("record", fields, None, None)], end, None
    plain, end, error = _unpack(data, at)
    found = list(_inside(plain, checked=error is not None))
    kinds = [x[0] for x in found]
    if "record" not in kinds and (found or error):
        raise Damaged(error or found[0][1])
    if error is None:
        return found, end, None
    # The gap after the last record is that of the fault.
    tail = found.pop()[2:] if kinds[-1] == "gap" else (len(plain), 0)
    # A member that lacks bytes may have unpacked some of the next one's.
    return found, min(end, _next_sign(data, at + 1)), (error, *tail)


def _inside(plain: bytes, checked: bool):
    """`(kind, fields or reason, offset, length)` of the records and gaps of a member's bytes."""
    at, gap, reason = 0, None, None
    while at < len(plain):
        try:
            fields, end = _record(plain, at, checked)
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = plain.find(VERSION, at + 1)
            at = len(plain) if at < 0 else at
            continue
        if gap is not None:
            yield "gap", reason, gap, at - gap
            gap = None
        yield "record", fields, at, end - at
        at = end
    if gap is not None:
        yield "gap", reason, gap, len(plain) - gap


def _unpack(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, str | None]:
    """The bytes of the member at `at` up to its end or a fault, where that is, and the fault."""
    unpack, out = zlib.decompressobj(31), []
    while not unpack.eof:
        piece = data[at : at + step]
        if not piece:
            return b"".join(out), at, "member is cut short"
        before = unpack.copy()
        try:
            out.append(unpack.decompress(piece))
        except zlib.error:
            # Byte by byte, so that nothing before the fault is lost.
            for k in range(len(piece)):
                try:
                    out.append(before.decompress(piece[k : k + 1]))
                except zlib.error:
                    return b"".join(out), at + k, "member does not unpack"
            raise
        at += len(piece)
    return b"".join(out), at - len(unpack.unused_data), None


def _record(data: bytes, at: int, checked: bool = False) -> tuple[dict, int]:
    """The record at `at` and its end. With `checked` it must have a digest that can be checked."""
    if not data.startswith(VERSION, at):
        raise Damaged("no version line")
    head_end = data.find(HEAD_END, at)
    if head_end < 0:
        raise Damaged("head has no end")
    head = _fields(data[at:head_end])
    length = head.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    start = head_end + len(HEAD_END)
    end = start + int(length)
    if data[end : end + len(HEAD_END)] != HEAD_END:
        raise Damaged("block does not end where it should")
    block = data[start:end]
    sound = _check(head.get("warc-block-digest"), block, "block")
    payload, http = _payload(head, block)
    digest = head.get("warc-payload-digest")
    if head.get("warc-type") == "revisit":
        claimed = http.get("content-length", "")
        n_bytes = int(claimed) if claimed.isascii() and claimed.isdigit() else None
        sha = _hex(digest)
    else:
        sound = _check(digest, payload, "payload") or sound
        n_bytes, sha = len(payload), hashlib.sha1(payload).hexdigest()
    if checked and not sound:
        raise Damaged("no digest to check the record by")
    fields = {
        "record_type": head.get("warc-type"),
        "record_id": head.get("warc-record-id"),
        "refers_to": head.get("warc-refers-to"),
        "target_uri": head.get("warc-target-uri"),
        "payload_bytes": n_bytes,
        "payload_digest": sha,
        "payload": payload,
    }
    return fields, end + len(HEAD_END)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines) if colon}


def _payload(head: dict, block: bytes) -> tuple[bytes, dict]:
    """The block without its HTTP head, if it has one, and that head."""
    if not head.get("content-type", "").startswith("application/http"):
        return block, {}
    http, end, payload = block.partition(HEAD_END)
    if not end:
        raise Damaged("HTTP head has no end")
    return payload, _fields(http)


def _hex(digest: str | None) -> str | None:
    kind, _, value = (digest or "").partition(":")
    if kind != "sha1":
        return None
    try:
        return (bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())).hex()
    except ValueError as error:
        raise Damaged("digest cannot be read") from error


def _check(digest: str | None, data: bytes, what: str) -> bool:
    """Whether there is a digest to check. Those of other kinds than SHA-1 are not checked."""
    expected = _hex(digest)
    if expected is not None and hashlib.sha1(data).hexdigest() != expected:
        raise Damaged(f"{what} digest differs")
    return expected is not None


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record, written and read back. Fails if an archive has a gap."""
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found = whole(read_warc(spark, path, payloads=False))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("bigint"))
    return found.select(
        as_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        as_id("refers_to").alias("refers_to"),
    )


OP1_SQL = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keep_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keep_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keep_id THEN keep_id END AS refers_to
FROM g
"""
