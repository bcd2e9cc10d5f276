"""WARC archives of pages: written as segmented, chunked records and put together again.

An archive is a gzip file of WARC/1.1 records, written and committed by Spark's text writer. A
response holds its payload in chunked transfer framing; a record whose block is longer than a segment
goes on in continuation records, which name their origin, their number and, in the last one, the
total length. Equal payloads are stored once; the others are revisits without a payload.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import stored
from tidelake.session import shared_folder

LEAST_SHARED = 1000  # bytes of a payload that is worth a revisit record
SEGMENT = 16_384  # characters of a block in one record
CHUNK = 4_096  # characters in a chunk
RECORDS_PER_FILE = 20_000
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "\r\n"
END = "\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"

PAGE = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("intact", pa.bool_())])
PAGE_FIELDS = ("page_id long, record_type string, refers_to long, payload binary, "
               "payload_bytes long, payload_digest string, intact boolean")
PART_FIELDS = "origin string, segment int, total long, header string, block binary"


def name_of(page_id: int | None, row: int | str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{row}>"


def page_of(name: str | None) -> int | None:
    found = (name or "").removeprefix("<urn:page:").split(":")[0].rstrip(">")
    return int(found) if found not in ("", "null") else None


def chunked(body: str, size: int = CHUNK) -> str:
    """The body in chunked transfer framing, cut between characters."""
    parts = [body[n:n + size] for n in range(0, len(body), size)]
    return "".join(f"{len(p.encode()):x}{LINE}{p}{LINE}" for p in parts) + f"0{END}"


def unchunked(framed: bytes) -> tuple[bytes, bool]:
    """The body of a chunked framing, and whether the framing was whole."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            return b"".join(out), False
        try:
            size = int(framed[at:end].split(b";")[0], 16)
        except ValueError:
            return b"".join(out), False
        if size == 0:
            return b"".join(out), True
        if len(framed) < end + 2 + size:
            return b"".join(out), False
        out.append(framed[end + 2:end + 2 + size])
        at = end + 4 + size


def _record(headers: list[tuple[str, str | None]], block: str) -> str:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v is not None),
             f"Content-Length: {len(block.encode())}"]
    return LINE.join(lines) + END + block


def records(page_id: int | None, row: int, url: str | None, html: str | None,
            refers_to: int | None) -> Iterator[str]:
    """The records of a page, without the empty lines that follow a record."""
    body, name = html or "", name_of(page_id, row)
    digest = hashlib.sha1(body.encode()).hexdigest()
    # A line break in an address would end the header line.
    target = url and url.replace("\r", "%0D").replace("\n", "%0A")
    shared = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), *shared, ("WARC-Profile", PROFILE),
                       ("WARC-Refers-To", f"<urn:page:{refers_to}>")],
                      f"HTTP/1.1 200 OK{LINE}Content-Length: {len(body.encode())}{END}")
        return
    block = (f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}"
             f"Transfer-Encoding: chunked{END}{chunked(body)}")
    if len(block) <= SEGMENT:
        yield _record([("WARC-Type", "response"), *shared], block)
        return
    parts = [block[n:n + SEGMENT] for n in range(0, len(block), SEGMENT)]
    yield _record([("WARC-Type", "response"), *shared, ("WARC-Segment-Number", "1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        total = str(len(block.encode())) if n == len(parts) else None
        yield _record([("WARC-Type", "continuation"),
                       ("WARC-Record-ID", name_of(page_id, f"{row}-{n}")), ("WARC-Date", DATE),
                       ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n)),
                       ("WARC-Segment-Total-Length", total)], part)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split(LINE)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(head["content-length"])
        yield head, archive[start:stop]
        at = stop + 4


def _page(head: dict[str, str], block: bytes, whole: bool) -> dict:
    """A page from the headers of its first record and its full block."""
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    http, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (
        line.partition(":") for line in http.decode().split(LINE)[1:])}
    page = {"page_id": page_of(head["warc-record-id"]), "record_type": head["warc-type"]}
    if head["warc-type"] == "revisit":
        return page | {"refers_to": page_of(head.get("warc-refers-to")), "payload": None,
                       "payload_bytes": int(fields["content-length"]), "payload_digest": digest,
                       "intact": whole}
    if fields.get("transfer-encoding", "").lower() == "chunked":
        body, framed = unchunked(body)
        whole = whole and framed
    found = hashlib.sha1(body).hexdigest()
    return page | {"refers_to": None, "payload": body, "payload_bytes": len(body),
                   "payload_digest": found, "intact": whole and found == digest}


def _batches(rows: Iterator[dict], schema: pa.Schema, size: str) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[size] or b"") + 200
        if weight > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   html: str = "html", least: int = LEAST_SHARED) -> str:
    """Write a record per row and return the folder of the archives.

    Payloads are the html in UTF-8, a null one is empty. Of rows with equal payloads of at least
    `least` bytes the ones with the largest key are responses and the others revisit it; a null key
    is smaller than any other, and rows that share the largest key are all responses. Only digests
    are grouped; pages move at most once, to meet the keys of shared payloads.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        body.alias("html"), F.monotonically_increasing_id().alias("row"),
        F.when(F.octet_length(body) >= least, F.sha2(body, 256)).alias("digest"))
    shared = rows.where("digest is not null").groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")).where(
        "n > 1 and first is not null").select("digest", "first")
    joined = rows.join(stored(shared, "shared", folder), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, weight = [], 0
            for page in batch.to_pylist():
                for record in records(**page):
                    held.append(record)
                    weight += len(record)
                if weight > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                    held, weight = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    joined.select("page_id", "row", "url", "html", refers.alias("refers_to")).mapInArrow(
        write, "value string").write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(f"{folder}/warc")
    return f"{folder}/warc"


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, record_type, refers_to, payload, payload_bytes, payload_digest, intact.

    Records that are whole become pages where they are read. Segments are grouped by the record
    they continue, which may lie in another archive, ordered by their number, and joined; intact is
    false if a segment is missing or repeated, the total length or the digest differs, or the
    framing breaks off. A folder without records gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select(
        "content")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
        for batch in batches:
            for content in batch.column("content"):
                yield from parse(gzip.decompress(content.as_py()))

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((_page(head, block, True) for head, block in parsed(batches)
                             if "warc-segment-number" not in head), PAGE, "payload")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({"origin": head.get("warc-segment-origin-id", head["warc-record-id"]),
                 "segment": int(head["warc-segment-number"]),
                 "total": int(head.get("warc-segment-total-length", -1)),
                 "header": "\n".join(f"{k}:{v}" for k, v in head.items()), "block": block}
                for head, block in parsed(batches) if "warc-segment-number" in head)
        yield from _batches(rows, pa.schema([
            ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
            ("header", pa.string()), ("block", pa.binary())]), "block")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for parts in batch.column("parts"):
                    yield assemble(parts.as_py())

        yield from _batches(rows(), PAGE, "payload")

    parts = files.mapInArrow(segments, PART_FIELDS).groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "total", "header", "block")))
        .alias("parts"))
    return files.mapInArrow(singles, PAGE_FIELDS).unionByName(
        parts.select("parts").mapInArrow(joined, PAGE_FIELDS))


def assemble(parts: list[dict]) -> dict:
    """A page from its segments in order of their numbers."""
    block = b"".join(p["block"] for p in parts)
    whole = [p["segment"] for p in parts] == list(range(1, len(parts) + 1))
    whole = whole and parts[-1]["total"] == len(block)
    head = dict(line.split(":", 1) for line in parts[0]["header"].split("\n"))
    return _page(head, block, whole)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives and read the archives back."""
    folder = folder or shared_folder(pages.sparkSession)
    return read_archives(pages.sparkSession, write_archives(pages, folder))
