"""WARC archives: writing pages as segmented, chunked records, and reading the archives back.

Writing: a page is one `response` record, or a `revisit` record if an equal payload of at least
REVISIT_BYTES stands under a smaller page id. The payload of a response is framed by chunked transfer
coding and cut into segments of SEGMENT_BYTES: the first is the response record, the others are
`continuation` records that name it as their origin, with a segment number, the last one with the total
length. Records of a page may land in different files; an archive holds at most RECORDS_PER_FILE records,
so its size is bounded. Archives are written by Spark to the shared folder (each file one gzip stream).

Reading: a task splits an archive into records by their lengths. Records without segments are decoded on
the spot. Segments are gathered by origin, ordered by number and checked: numbers without a gap, the total
length as stated; then the chunk framing is removed. A page whose segments stand in one archive is joined by
the task that reads it, and only its origin is shuffled, so that a segment repeated elsewhere is found;
segments of pages that reach over several archives are shuffled themselves (the number of segments of a page
bounds the group). A revisit finds its payload's length by joining the response that it names, on ids alone.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import prepare, run_path, written

SEGMENT_BYTES = 2 << 10
CHUNK_BYTES = 512
REVISIT_BYTES = 100
RECORDS_PER_FILE = 4096
VERSION = b"WARC/1.1"
_HEADER_END = b"\r\n\r\n"
# The field names of the format.
TYPE, RECORD, LENGTH, TARGET, DATE = "WARC-Type", "WARC-Record-ID", "Content-Length", "WARC-Target-URI", "WARC-Date"
DIGEST, NUMBER, ORIGIN = "WARC-Payload-Digest", "WARC-Segment-Number", "WARC-Segment-Origin-ID"
TOTAL, REFERS, PROFILE, KIND = "WARC-Segment-Total-Length", "WARC-Refers-To-Target-URI", "WARC-Profile", "Content-Type"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RESPONSE_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_WRITTEN_AT = "2024-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer coding."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped. A broken frame raises ValueError."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block, its transfer coding undone."""
    head, gap, body = block.partition(_HEADER_END)
    if not gap:
        raise ValueError("response without a head")
    if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head):
        return dechunked(body)
    return body


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the blank lines that end it (they separate records)."""
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in fields], f"{LENGTH}: {len(block)}".encode()]
    return b"\r\n".join(lines) + _HEADER_END + block


def page_records(page: str, url: str, payload: bytes, digest: str, refers_to: str | None, row: str) -> Iterator[bytes]:
    """The records of one page; `row` makes their ids unique where a page id is repeated."""
    name = f"<urn:page:{page}:{row}>"
    own = [(TARGET, f"urn:page:{page}"), ("WARC-Source-URI", url), (DATE, _WRITTEN_AT), (DIGEST, f"sha256:{digest}")]
    if refers_to is not None:
        fields = [(TYPE, "revisit"), (RECORD, name), *own, (PROFILE, SAME_PAYLOAD), (REFERS, f"urn:page:{refers_to}")]
        yield record([*fields, (KIND, "application/http; msgtype=response")], _REVISIT_HEAD)
        return
    block = _RESPONSE_HEAD + chunked(payload)
    fields = [(TYPE, "response"), (RECORD, name), *own, (KIND, "application/http; msgtype=response")]
    if len(block) <= SEGMENT_BYTES:
        yield record(fields, block)
        return
    count = -(-len(block) // SEGMENT_BYTES)
    yield record([*fields, (NUMBER, "1")], block[:SEGMENT_BYTES])
    for i in range(1, count):
        more = [(TYPE, "continuation"), (RECORD, f"<urn:page:{page}:{row}:{i + 1}>"), (TARGET, f"urn:page:{page}"), (DATE, _WRITTEN_AT)]
        more += [(ORIGIN, name), (NUMBER, str(i + 1))] + ([(TOTAL, str(len(block)))] if i == count - 1 else [])
        yield record(more, block[i * SEGMENT_BYTES : (i + 1) * SEGMENT_BYTES])


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary), digest and refers_to of each row of pages (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    url = F.col("url") if "url" in pages.columns else F.lit(None)
    safe = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"[\x00-\x1F\x7F]", " ")
    sized = pages.select(F.col("page_id").cast("long").alias("page_id"), safe.alias("url"), payload.alias("payload"))
    sized = sized.withColumn("digest", F.sha2("payload", 256))
    # Only digests that stand more than once can have revisits; this table has ids alone.
    copies = (
        sized.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    return sized.join(copies, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the pages' records under `path`, a folder that all executors share."""
    prepare(pages.sparkSession)
    blocks.arrow_batches(pages.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to", "row")]
            out, held = [], 0
            for page, url, payload, digest, refers, row in zip(*columns, strict=True):
                origin = None if refers is None else str(refers)
                for made in page_records("" if page is None else str(page), url, payload, digest, origin, str(row)):
                    out.append(made)
                    held += len(made)
                    if held > blocks.BLOCK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    numbered = with_revisits(pages).withColumn("row", F.monotonically_increasing_id())
    records = numbered.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    # The writer copies the bytes as they are; the separator is the pair of blank lines after a record.
    (
        records.write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an uncompressed archive: fields by lower-case name, and the block."""
    at = 0
    while at < len(archive):
        if archive[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = archive.find(_HEADER_END, at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in archive[at:end].split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields[LENGTH.lower()])
        start = end + len(_HEADER_END)
        if start + size > len(archive):
            raise ValueError("record is cut short")
        yield fields, archive[start : start + size]
        at = start + size


def reassembled(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of (number, total, part) segments; a gap, a repeat or a wrong total raises ValueError."""
    ordered = sorted(segments, key=lambda s: s[0])
    if [s[0] for s in ordered] != list(range(1, len(ordered) + 1)):
        raise ValueError("segments are missing or repeated")
    block = b"".join(s[2] for s in ordered)
    if ordered[-1][1] != len(block):
        raise ValueError("segments have another total length")
    return block


_RECORD = "kind string, page string, origin string, number int, total long, digest string, refers string, part binary, whole boolean"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS)


def _complete(segments: list[tuple]) -> bool:
    """Whether the rows are all segments of a page, each once."""
    return [s[3] for s in segments] == list(range(1, len(segments) + 1)) and segments[-1][4] is not None


def read_records(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    """Rows of the archives' records. With `whole` the decoded payloads of records without segments and of pages
    that an archive holds all segments of. Else the other segments as they are, and a row without number and part
    for each page whose segments were joined.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for content in batch.column("content"):
                raw = content.as_py()
                rows, pages = [], {}
                for fields, block in records_of(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw):
                    get = fields.get
                    kind, number, total = get(TYPE.lower()), get(NUMBER.lower()), get(TOTAL.lower())
                    origin = get(ORIGIN.lower()) or get(RECORD.lower())
                    digest = (get(DIGEST.lower()) or "").rpartition(":")[2] or None
                    own = (kind, get(TARGET.lower()), origin, number and int(number), total and int(total), digest, get(REFERS.lower()))
                    if number is not None:
                        pages.setdefault(origin, []).append((*own, block, False))
                    elif whole:
                        rows.append((*own, b"" if kind == "revisit" else payload_of(block), True))
                for origin, segments in pages.items():
                    segments.sort(key=lambda s: s[3])
                    if not _complete(segments):
                        rows += [] if whole else segments
                    elif whole:
                        kind, page, _, _, _, digest, _, _, _ = segments[0]
                        payload = payload_of(reassembled([(s[3], s[4], s[7]) for s in segments]))
                        rows.append((kind, page, origin, None, None, digest, None, payload, True))
                    else:
                        rows.append((None, None, origin, None, None, None, None, None, False))
                yield _batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _RECORD)


_FIELDS = pa.schema(
    [("kind", pa.string()), ("page", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
     ("digest", pa.string()), ("refers", pa.string()), ("part", pa.binary()), ("whole", pa.bool_())]
)


def _page(uri: str) -> Column:
    return F.nullif(F.regexp_extract(uri, r"^urn:page:(-?[0-9]*)$", 1), F.lit("")).cast("long")


def _joined(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A page of each row's segments."""
    for batch in frames:
        made = []
        for row in batch.to_pylist():
            segments = row["segments"]
            if any(r["number"] is None for r in segments):
                raise ValueError(f"{row['origin']}: segments are repeated in another archive")
            head = next((r for r in segments if r["number"] == 1), None)
            if head is None:
                raise ValueError(f"{row['origin']}: the first segment is missing")
            payload = payload_of(reassembled([(r["number"], r["total"], r["part"]) for r in segments]))
            made.append((head["kind"], head["page"], row["origin"], None, None, head["digest"], None, payload, True))
        yield _batch(made)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload (binary, null for a revisit), payload_digest, record_type, refers_to of each page.

    A missing or repeated segment, a wrong total length, a broken chunk or a payload that differs from its
    digest fails the read: nothing is dropped in silence.
    """
    columns = ["kind", "page", "digest", "refers", "part"]
    whole = read_records(spark, path, True).select(*columns)
    segment = F.struct("kind", "page", "number", "total", "digest", "part")
    spread = read_records(spark, path, False).groupBy("origin").agg(F.collect_list(segment).alias("segments"))
    # A page that was joined where it was read, and has no other segment, is done.
    spread = spread.where((F.size("segments") > 1) | F.col("segments")[0]["number"].isNotNull())
    pages = whole.unionByName(spread.mapInArrow(_joined, _RECORD).select(*columns))
    proven = F.when(
        (F.col("kind") == "revisit") | (F.sha2("part", 256) == F.col("digest")), F.col("digest")
    ).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.coalesce("page", F.lit("")))))
    return pages.select(
        _page("page").alias("page_id"),
        F.when(F.col("kind") != "revisit", F.col("part")).alias("payload"),
        proven.alias("payload_digest"),
        F.col("kind").alias("record_type"),
        _page("refers").alias("refers_to"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages (page_id, url, html; more columns are ignored) to archives and read them back.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to per row, as the archives
    have them. A null html is an empty payload. Payloads under REVISIT_BYTES are always responses. Rows
    that repeat the smallest page id of equal payloads are all responses; a null page id is never the
    response that others name unless all are null. An empty table gives an empty table. A revisit's length
    comes from the response that it names, by its digest and page; a response that is missing is an error.
    """
    spark = pages.sparkSession
    path = run_path(spark, "warc")
    write_archives(pages, path)
    slim = read_pages(spark, path).withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload")
    slim = written(slim, "pages")
    named = slim.where("record_type = 'response'").groupBy(
        F.col("payload_digest").alias("named_digest"), F.col("page_id").alias("named_page")
    )
    named = named.agg(F.max("payload_bytes").alias("full"))
    revisits = slim.where("record_type = 'revisit'").join(
        named, (F.col("payload_digest") == F.col("named_digest")) & F.col("refers_to").eqNullSafe(F.col("named_page")), "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    lost = F.raise_error(F.concat(F.lit("no response for the revisit of page "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    revisits = revisits.withColumn("payload_bytes", F.coalesce("full", lost.cast("long"))).select(*columns)
    return slim.where("record_type = 'response'").select(*columns).unionByName(revisits)


ORACLE_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
named AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM sized)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM named
"""
