"""Web archives: a writer with payload revisits and a salvage reader.

The writer makes one gzip member per record, members parted by a NUL byte
(padding that gzip readers skip), in files that Spark writes on any storage.
The reader checks every member and record; after a failed check it searches
for the next place where a member or a version line begins and all checks
pass, goes on from there, and reports the bytes between as a quarantined gap.
The search also runs inside a member, over what of its text can be inflated,
so one damaged record or a lost tail costs only what it holds.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.common import importable, load, slices
from candleflow.session import materialize, scratch_path

MIN_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
STEP = 1 << 16
#: Bytes of html written as one value, and such values in one archive.
CHUNK_BYTES = 4 << 20
CHUNKS = 64


# ---- writing ---------------------------------------------------------------

def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html; other columns are ignored) with digest,
    size, type and refers_to.  Of payloads that are equal and hold at least
    ``min_bytes`` bytes, the row with the largest page_id is the response and
    the others revisit it; a null page_id is smaller than any other, and rows
    that repeat the response's page_id are responses too.  Only digests that
    occur twice come into the join, one row each; a digest held by a third of
    all pages makes a skewed join, whose large side Spark splits."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("size"),
    )
    first = (rows.where(F.col("size") >= min_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").select("digest", "response", F.lit(True).alias("shared")))
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", "size",
        F.when(revisit, "revisit").otherwise("response").alias("type"), F.when(revisit, F.col("response")).alias("refers_to"))


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record; a revisit carries the head of the response and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    uri = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: {_base32(bytes.fromhex(digest))}", f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
        f"Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member of its own."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _members(batches: Iterator[pa.RecordBatch], gzip: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(iter([batch]), "html", CHUNK_BYTES):
            out = []
            for r in part.to_pylist():
                data = record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["type"], r["refers_to"])
                out.append(member(data) if gzip else data)
            yield pa.record_batch([pa.array([b"\0".join(out)], pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT, gzip: bool = True, chunks: int = CHUNKS) -> None:
    """Write a record for each row of ``pages`` to archives at ``path``; see
    :func:`with_revisits` for which become revisits.  A null html is an empty
    payload, a null url is replaced by a name made from the page_id; an empty
    table gives no archive.

    Records are written in values of about ``CHUNK_BYTES`` bytes of html (a
    longer page is one of its own), ``chunks`` of which fill an archive, so an
    archive is bounded by bytes, not by its number of records."""
    spark = pages.sparkSession
    importable(spark)
    rows = with_revisits(pages, min_bytes)
    # The text writer stores the bytes of a string as they are; its line separator is the padding.
    (rows.mapInArrow(lambda it: _members(it, gzip), "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", chunks).text(path))


# ---- reading ---------------------------------------------------------------

class Damage(Exception):
    """A failed check; ``end``: where the damaged unit ends, if that is known."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def parse_record(data: bytes, at: int, sure: bool = False) -> tuple[dict, int]:
    """The record that begins at ``at`` and the place after it.  ``sure``: only
    if it carries a digest of its bytes, as the text around it is doubtful."""
    if not data.startswith(VERSION, at):
        raise Damage("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damage("header without end")
    fields = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise Damage("no content length")
    start = stop + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damage("block without end")
    block = data[start:end]
    want = fields.get("warc-block-digest")
    if want and want != _base32(hashlib.sha1(block).digest()):
        raise Damage("block digest differs")
    payload = block.partition(b"\r\n\r\n")[2]
    want = fields.get("warc-payload-digest")
    if want and fields.get("warc-type") == "response" and want != _base32(hashlib.sha1(payload).digest()):
        raise Damage("payload digest differs")
    if sure and "warc-block-digest" not in fields and not (want and fields.get("warc-type") == "response"):
        raise Damage("no digest in a damaged member")
    return {"fields": fields, "payload": payload}, end + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """The text of the gzip member that begins at ``at``, where it ends, and
    what is wrong with it.  The text of a broken member is what comes before
    the break, and its end is the last place read."""
    z, pos, parts = zlib.decompressobj(31), at, []
    while not z.eof and pos < len(data):
        before = z.copy()
        try:
            parts.append(z.decompress(data[pos : pos + STEP]))
            pos += STEP
        except zlib.error as error:
            # Byte by byte up to the break, whose step loses all it inflates.
            try:
                while True:
                    parts.append(before.decompress(data[pos : pos + 1]))
                    pos += 1
            except zlib.error:
                return b"".join(parts), pos, f"member: {error}"[:80]
    if not z.eof:
        return b"".join(parts), len(data), "member without end"
    return b"".join(parts), min(pos, len(data)) - len(z.unused_data), None


def records_of(text: bytes, broken: bool = False) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, record, None) of each good record of a member's text and
    (start, end, None, reason) of each gap, in order.  In a ``broken`` member
    a record counts if a digest of its own holds and the text goes on behind
    it; what is left at the break is no gap of the text."""
    at, gap, reason = 0, None, None
    while at < len(text):
        try:
            one, end = parse_record(text, at, broken)
            if broken and end == len(text):
                break
        except Damage as damage:
            if gap is None:
                gap, reason = at, str(damage)
            at = text.find(VERSION, at + 1)
            at = len(text) if at < 0 else at
            continue
        if gap is not None:
            yield gap, at, None, reason
            gap = None
        yield at, end, one, None
        at = end
    if gap is not None and not broken:
        yield gap, len(text), None, reason


class Search:
    """The next places of a mark in growing order; each stretch is searched once."""

    def __init__(self, data: bytes, mark: bytes):
        self.data, self.mark, self.at = data, mark, -1

    def after(self, place: int) -> int:
        if self.at < place:
            found = self.data.find(self.mark, place)
            self.at = found if found >= 0 else len(self.data)
        return self.at


def _same(one: dict) -> bytes:
    """A digest of a record, to know it again."""
    return hashlib.sha1(repr(sorted(one["fields"].items())).encode() + one["payload"]).digest()


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, record, None) of each good record and (start, end, None,
    reason) of each gap, in order; NUL padding is neither.

    The records of a member have its place.  If some of a damaged member are
    good, a gap at the member's place names each stretch of its text that is
    lost; a member whose end is lost is a gap from its start on, besides the
    records read from it."""
    at, gap, reason = 0, None, None
    held: set[bytes] = set()  # records read from a broken member, which may show their bytes uncompressed
    members, versions = Search(data, MAGIC), Search(data, VERSION)
    while at < len(data):
        if gap is None and data[at] == 0:
            at += 1
            continue
        found, fault, known = [], None, None
        if data.startswith(MAGIC, at):
            text, end, fault = inflate(data, at)
            found = list(records_of(text, fault is not None))
            good = any(one for _, _, one, _ in found)
            if fault is None and not good and found:
                fault, known = found[0][3], end
        else:
            try:
                one, end = parse_record(data, at)
                if gap is not None and _same(one) in held:
                    raise Damage("read before")
                found, good = [(at, end, one, None)], True
            except Damage as damage:
                fault, good = str(damage), False
        if gap is not None and (good or fault is None):
            yield gap, at, None, reason
            gap = None
            held = held if fault else set()
        if good:
            for start, stop, one, why in found:
                yield at, end, one, f"{why}, bytes {start} to {stop} of the member's text" if why else None
        if fault is None:
            at = end
            continue
        if gap is None:
            gap, reason = at, fault
        if known is None:
            held.update(_same(one) for _, _, one, _ in found if one)
        after = known or at + 1
        at = min(members.after(after), versions.after(after))
    if gap is not None:
        yield gap, len(data), None, reason


READ = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gap", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("url", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
READ_DDL = ("path string, start long, stop long, gap string, record_type string, record_id string, url string, page_id long, "
            "payload_bytes long, payload_digest string, refers_to long, payload binary")


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _digest_hex(text: str | None) -> str | None:
    """Hex of a labelled SHA-1, which archives hold in base 32 or in hex."""
    value = (text or "").removeprefix("sha1:")
    try:
        return base64.b32decode(value).hex() if len(value) == 32 else value.lower() or None
    except ValueError:
        return None


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            rows, held = [], 0
            for start, stop, one, gap in salvage(data):
                f = one["fields"] if one else {}
                rows.append((
                    name, start, stop, gap, f.get("warc-type"), f.get("warc-record-id"), f.get("warc-target-uri"), _number(f.get("page-id")),
                    _number(f.get("payload-length")) if f.get("warc-type") == "revisit" else len(one["payload"]) if one else None,
                    _digest_hex(f.get("warc-payload-digest")), _number(f.get("refers-to-page-id")), one["payload"] if one and payloads else None,
                ))
                held += len(rows[-1][-1] or b"") + 200
                if held > 8 << 20:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), READ.types, strict=True)], schema=READ)
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), READ.types, strict=True)], schema=READ)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records and gaps of the archives at ``path``, gzip or plain: path,
    start, stop (the bytes taken), gap (the reason, for a gap), record_type,
    record_id, url, page_id, payload_bytes, payload_digest, refers_to,
    payload.  A file is read by one task, so archives should stay well under
    2 GB, as the writer's do (256 MB of html, or one longer page)."""
    importable(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda it: _read(it, payloads), READ_DDL)


def op5_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page, written to archives and read back by the salvage
    reader; gaps, if there were any, would be rows of the written log."""
    path = scratch_path(spark, "warc")
    write_archives(load(spark, sf_dir, "pages"), path)
    log = materialize(read_archives(spark, path, payloads=False), "warc-log")
    return log.where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql() -> str:
    """What is read back, from the pages themselves."""
    return f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as payload_digest, strlen(coalesce(html, ''))::bigint as payload_bytes from pages),
r as (select payload_digest, max(page_id) as response, count(*) as n from p where payload_bytes >= {MIN_REVISIT} group by 1)
select page_id, payload_bytes, p.payload_digest,
       case when n > 1 and page_id is distinct from response then 'revisit' else 'response' end as record_type,
       case when n > 1 and page_id is distinct from response then response end as refers_to
from p left join r on p.payload_digest = r.payload_digest and payload_bytes >= {MIN_REVISIT}"""
