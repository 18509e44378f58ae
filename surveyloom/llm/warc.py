"""WARC archives: writing with revisits and segments, and reading back.

Writing. Of pages with equal payloads of at least ``SMALL`` bytes the one
with the smallest id becomes a response and the others revisits of it; smaller
payloads are all responses. A response's block is an HTTP message in chunked
transfer framing; a block longer than ``SEGMENT`` is cut into a first record
and continuation records. Spark's text writer stores the records, so any file
system works; each file is gzip-compressed as a whole.

Reading. Records are parsed file by file in a stream. Segments are grouped by
their origin's id, ordered by segment number and joined; numbers without a gap
and the total length of the last segment are verified, then the chunk frames
are taken off. A record that fails this is returned with ``complete`` false and
no payload; an archive whose records don't follow each other is an error.

Edge cases: a null html is an empty payload; a null url leaves the target out;
a null id is an id like any other (its own ``page_id`` is null) and counts as
the largest; every row has a record: of rows with the same id and payload the
one with the smallest url (null last) bears the page's plain record id, the
others add their url's digest and a number to it; rows with the same id and
other payloads are pages of their own; empty tables give archives without
records; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import shared_dir, table, written

SMALL = 100
SEGMENT, CHUNK, RECORDS_A_FILE = 32_768, 8_192, 10_000
#: Bytes of records that Python hands over at once; pages handed on at once; marked pages that are broadcast (150 bytes each).
HANDED, PAGES, BROADCAST_MARKS = 1 << 22, 500, 50_000
VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
#: What all versions' records begin with.
START = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
BETWEEN = "\r\n\r\n"

RECORD = (
    "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, origin string,"
    " segment int, total_length long, block binary"
)
PAGE = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, complete boolean, payload binary"


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%b\r\n" % (len(p := payload[k : k + CHUNK]), p) for k in range(0, len(payload), CHUNK)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken. Chunk extensions and trailers are allowed."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        found = re.match(rb"\s*([0-9A-Fa-f]+)\s*(;.*)?$", body[at:end]) if end >= 0 else None
        if not found:
            return None
        size = int(found[1], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        parts.append(body[at : at + size])
        at += size + 2
        if len(parts[-1]) < size or body[at - 2 : at] != b"\r\n":
            return None


def http_payload(block: bytes) -> bytes | None:
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")) else body


def record(fields: dict[str, object], block: bytes) -> bytes:
    """One record without the two line ends that follow it."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block


def page_records(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> Iterator[bytes]:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    fields = {"WARC-Record-ID": record_id, "WARC-Date": DATE, "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response"}
    if refers_to is not None:
        yield record({"WARC-Type": "revisit", **fields, "WARC-Profile": PROFILE, "WARC-Refers-To": refers_to}, HTTP + b"\r\n")
        return
    block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= SEGMENT:
        yield record({"WARC-Type": "response", **fields}, block)
        return
    yield record({"WARC-Type": "response", **fields, "WARC-Segment-Number": 1}, block[:SEGMENT])
    for k, at in enumerate(range(SEGMENT, len(block), SEGMENT), 2):
        last = len(block) if at + SEGMENT >= len(block) else None
        own = f"{record_id[:-1]}:{k}>"
        yield record({"WARC-Type": "continuation", "WARC-Record-ID": own, "WARC-Date": DATE, "WARC-Segment-Origin-ID": record_id, "WARC-Segment-Number": k, "WARC-Segment-Total-Length": last}, block[at : at + SEGMENT])


def repeats(rows: DataFrame) -> DataFrame:
    """A record for each of the rows that share their page_id and payload with others; only responses bear html."""
    large = F.octet_length("html") >= SMALL
    rows = rows.select("page_id", "digest", "url", "record_id", "refers_to", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), F.coalesce(large, F.lit(False)).alias("large"))
    # equal rows are one with a number; of these the one with the smallest url holds the page's record id
    equal = rows.groupBy("page_id", "digest", "url", "record_id", "refers_to", "large").agg(F.first("html").alias("html"), F.count(F.lit(1)).alias("n"))
    equal = written(equal, "page-repeats")
    key = F.struct(F.col("url").isNull().alias("null"), "url")
    least = equal.groupBy(F.col("record_id").alias("of")).agg(F.min(key).alias("least"))
    equal = equal.join(least, F.col("record_id") == F.col("of")).withColumn("least", F.col("least").eqNullSafe(key))
    places = equal.select("record_id", "digest", "url", "refers_to", "large", "least", "html", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("number"))
    plain = F.col("least") & (F.col("number") == 1)
    own = F.concat(F.expr("substring(record_id, 1, length(record_id) - 1)"), F.lit(":"), F.sha2(F.concat(F.when(F.col("url").isNull(), "0").otherwise("1"), F.coalesce("url", F.lit(""))), 256), F.lit(":"), F.col("number").cast("string"), F.lit(">"))
    refers_to = F.coalesce("refers_to", F.when(F.col("large") & ~plain, F.col("record_id")))
    return places.select(F.when(plain, F.col("record_id")).otherwise(own).alias("record_id"), "url", F.when(refers_to.isNull(), F.col("html")).alias("html"), "digest", refers_to.alias("refers_to"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html) as archives below ``path``."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha2(html, 256).alias("digest"))
    keys = pages.select("page_id", "digest", F.octet_length(html).alias("size"))
    keys = written(keys.groupBy("page_id", "digest").agg(F.first("size").alias("size"), (F.count(F.lit(1)) > 1).alias("repeated")), "page-keys")
    firsts = keys.where(F.col("size") >= SMALL).groupBy("digest").agg(F.min("page_id").alias("first"), F.lit(True).alias("shared"))
    again = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(":"), "digest", F.lit(">"))
    # only pages that aren't plain responses are marked; the html moves only if these are too many to broadcast
    marks = keys.join(firsts, "digest", "left").withColumn("refers_to", F.when(again, record_id("first"))).where("repeated OR refers_to IS NOT NULL")
    marks = written(marks.select(F.col("page_id").alias("key"), F.col("digest").alias("key_digest"), "refers_to", "repeated"), "page-marks")
    n_marks = marks.count()
    if n_marks <= BROADCAST_MARKS:
        marks = F.broadcast(marks)
    same = pages["page_id"].eqNullSafe(marks["key"]) & (pages["digest"] == marks["key_digest"])
    one = pages.join(marks, same, "left").withColumn("record_id", record_id("page_id"))
    if n_marks and not keys.where("repeated").isEmpty():
        columns = ["record_id", "url", "html", "digest", "refers_to"]
        twice = repeats(one.where("repeated"))
        one = one.where("repeated IS NULL OR NOT repeated").select(columns).unionByName(twice.select(columns))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(k, PAGES) for x in batches for k in range(0, x.num_rows, PAGES)):
            out, held = [], 0
            for row in zip(*batch.columns, strict=True):
                record_id, url, text, digest, refers_to = (x.as_py() for x in row)
                for x in page_records(record_id, url, (text or "").encode("utf-8"), digest, refers_to):
                    out.append(x)
                    held += len(x)
                if held > HANDED:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    out = one.select("record_id", "url", "html", "digest", "refers_to").mapInArrow(records, "value binary")
    out.select(F.col("value").cast("string")).write.option("lineSep", BETWEEN).option("maxRecordsPerFile", RECORDS_A_FILE).option("compression", "gzip").text(path)


def record_row(head: list[bytes], block: bytes) -> tuple:
    """A record from its header lines (without the version) and its block."""
    fields: dict[str, str] = {}
    for line in head:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        fields[k.strip().lower()] = v.strip()
    get = fields.get
    digest, segment, total = get("warc-payload-digest"), get("warc-segment-number"), get("warc-segment-total-length")
    return (
        get("warc-record-id"), get("warc-type"), get("warc-target-uri"), digest and digest.rpartition(":")[2], get("warc-refers-to"),
        get("warc-segment-origin-id"), segment and int(segment), total and int(total), block,
    )


def content_length(head: bytes) -> int:
    found = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head.replace(b"\r", b""))
    if not found:
        raise ValueError(f"a record has no Content-Length: {head[:80]!r}")
    return int(found[1])


def parsed(raw: bytes) -> Iterator[tuple]:
    """Records of one uncompressed archive."""
    at = 0
    while at < len(raw):
        if raw[at : at + len(START)] != START:
            if raw[at : at + 1].strip():
                raise ValueError(f"no record begins with {raw[at : at + 40]!r}")
            at += 1
            continue
        end = raw.index(b"\r\n\r\n", at)
        size = content_length(raw[at:end])
        yield record_row(raw[at:end].split(b"\r\n")[1:], raw[end + 4 : end + 4 + size])
        at = end + 4 + size


def streamed(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple]:
    """Records of (file, piece) rows: what stands between two ``START`` in a file, in its order. Blocks that hold that text are put together again."""
    file, held, need = None, None, None
    for path, piece in pieces:
        if path != file:
            if held is not None:
                raise ValueError(f"{file} ends within a record")
            if piece.strip():
                raise ValueError(f"no record begins with {piece[:40]!r} in {path}")
            file = path
            continue
        if held is None:
            held, need = bytearray(piece), None
        else:
            held += START
            held += piece
        end = held.find(b"\r\n\r\n") if need is None else need[0]
        if end < 0:
            continue
        need = need or (end, end + 4 + content_length(bytes(held[:end])))
        if len(held) >= need[1]:
            if held[need[1] :].strip():
                raise ValueError(f"a record of {path} is longer than it says")
            yield record_row(bytes(held[:end]).split(b"\r\n")[1:], bytes(held[end + 4 : need[1]]))
            held = None
    if held is not None:
        raise ValueError(f"{file} ends within a record")


def whole_block(blocks: list[dict], total: int | None) -> bytes | None:
    """Segments (already in order) joined, or None if one is missing or the length differs."""
    if [x["segment"] for x in blocks] != list(range(1, len(blocks) + 1)):
        return None
    block = b"".join(x["block"] for x in blocks)
    return block if total == len(block) else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit record below ``path``, with the payload of responses.

    Files named ``*.gz`` are streamed, whatever their size. Files named ``*.warc`` aren't compressed and are read whole: each
    must fit in a task.
    """

    names = [x.strip().split()[0] for x in RECORD.split(",")]
    types = [*[pa.string()] * 6, pa.int32(), pa.int64(), pa.binary()]

    def handed(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for x in rows:
            out.append(x)
            held += len(x[-1])
            if held > HANDED:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from handed(streamed((p.as_py(), v.as_py()) for batch in batches for p, v in zip(*batch.columns, strict=True)))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from handed(x for batch in batches for v in batch.column(0) for x in parsed(v.as_py()))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.strip().split()[0] for x in PAGE.split(",")]
        for batch in (x.slice(k, PAGES) for x in batches for k in range(0, x.num_rows, PAGES)):
            payloads = []
            for kind, segments, total in zip(batch.column(1), batch.column(5), batch.column(6), strict=True):
                parts, total = segments.as_py(), total.as_py()
                block = parts[0]["block"] if parts[0]["segment"] is None else whole_block(parts, total)
                payload = None if block is None else http_payload(block)
                payloads.append((payload is not None, payload if kind.as_py() == "response" else None))
            complete, payload = zip(*payloads, strict=True) if payloads else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(complete, pa.bool_()), pa.array(payload, pa.binary())], names=names)

    # gzip files are not split, so a task reads each from front to back, a piece at a time
    own = {"recursiveFileLookup": "true"}
    pieces = spark.read.options(**own, pathGlobFilter="*.gz", lineSep=START.decode()).text(path)
    found = pieces.select(F.col("_metadata.file_path"), F.col("value").cast("binary")).mapInArrow(compressed, RECORD)
    files = spark.read.format("binaryFile").options(**own, pathGlobFilter="*.warc").load(path)
    found = found.unionByName(files.where(F.col("length") > 0).select("content").mapInArrow(plain, RECORD))
    head = ["record_id", "record_type", "target_uri", "payload_digest", "refers_to"]
    part = F.struct("segment", "block")
    single = found.where("segment IS NULL").select(*head, F.array(part).alias("segments"), "total_length")
    segmented = (
        found.where("segment IS NOT NULL")
        .groupBy(F.coalesce("origin", "record_id").alias("record_id"))
        .agg(
            *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in head[1:]],
            F.sort_array(F.collect_list(part)).alias("segments"), F.max("total_length").alias("total_length"),
        )
    )
    return single.unionByName(segmented).mapInArrow(decoded, PAGE)


def verified_digest() -> Column:
    """The payload's digest, over rows of ``read_warc``; an error where segments are missing, framing is broken or the payload is another one."""
    named = F.coalesce("record_id", F.lit("a record without an id"))
    broken = F.raise_error(F.concat(named, F.lit(": a segment is missing or its framing is broken")))
    other = F.raise_error(F.concat(named, F.lit(": the payload isn't that of its digest")))
    whole = F.when(F.col("record_type") == "revisit", F.col("payload_digest")).when(F.sha2("payload", 256) == F.col("payload_digest"), F.col("payload_digest"))
    return F.when(~F.col("complete"), broken.cast("string")).otherwise(F.coalesce(whole, other.cast("string")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), path)
    back = read_warc(spark, path).withColumn("digest", verified_digest())
    page_id = lambda c: F.split(c, ":")[2].try_cast("long")
    seen = written(
        back.select("record_id", "record_type", "digest", "refers_to", F.octet_length("payload").cast("long").alias("own_bytes")), "warc-read"
    )
    of = seen.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("own_bytes").alias("first_bytes"))
    lost = F.raise_error(F.concat("record_id", F.lit(": the record that it refers to is missing"))).cast("long")
    return seen.join(of, "refers_to", "left").select(
        page_id("record_id").alias("page_id"), F.coalesce("own_bytes", "first_bytes", lost).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", page_id("refers_to").alias("refers_to"),
    )


OP3_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages
), q AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
    first_value(page_id) OVER w AS first, row_number() OVER w = 1 AS is_first
  FROM p WINDOW w AS (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR is_first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND NOT is_first THEN first END AS refers_to
FROM q
"""
