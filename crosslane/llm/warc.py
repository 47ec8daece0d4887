"""WARC archives: writing with revisits and segments, and reading back with segment reassembly.

Records are written by Spark's text sink with the end of a WARC record as line separator, so that
every part file is a WARC file. Long blocks are cut into segments: the first record keeps its type,
the others are continuations. Reading puts continuations together by origin identifier, orders them
by segment number, checks the total length and decodes the chunked transfer framing.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import new_path, with_group, written

#: Payloads from this size on are stored once; longest block of one segment; bytes of a chunk.
LEAST_SHARED, SEGMENT_BYTES, CHUNK_BYTES = 1000, 16_384, 4096
#: Records of one part file; with SEGMENT_BYTES this bounds what a reading task holds.
RECORDS_PER_FILE = 2000
#: Type of the row that stands for what can't be read of a file.
TORN = "torn"
_END = "\r\n\r\n"
_DATE = "2024-09-01T00:00:00Z"


def record_types(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", url_col: str | None = None) -> DataFrame:
    """Id, url and body of the pages with _digest (SHA-1), _bytes and _holder, the largest id of the records with an equal payload of
    LEAST_SHARED bytes at least, where that is another row's. Null is an empty payload.

    Of rows that repeat the largest id with the same payload, one is the response and the others revisit it.
    """
    body = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    rows = written(pages.select(*dict.fromkeys([id_col, *([url_col] if url_col else []), body_col])).withColumn("_row", F.monotonically_increasing_id()).withColumn("_digest", F.sha1(body)).withColumn("_bytes", F.octet_length(body).cast("long")), "pages")
    groups = (
        rows.where(F.col("_bytes") >= LEAST_SHARED).groupBy("_digest")
        .agg(F.max(F.struct(F.col(id_col).alias("id"), F.col("_row").alias("row"))).alias("_most"), F.count("*").alias("_n"))
    )
    groups = written(groups.where("_n > 1"), "payloads")
    total = rows.count()
    joined = with_group(rows, groups, ["_digest"], "_n", total)
    revisit = F.col("_n").isNotNull() & (F.col("_bytes") >= LEAST_SHARED) & (F.col("_most.row") != F.col("_row"))
    return joined.withColumn("_revisit", F.coalesce(revisit, F.lit(False))).withColumn("_holder", F.when(F.col("_revisit"), F.col("_most.id"))).withColumn("_holder_row", F.when(F.col("_revisit"), F.col("_most.row"))).drop("_most", "_n")


def _uuid(kind: str, row: int, page: object) -> str:
    h = hashlib.md5(f"{kind}:{row}:{page}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c := body[i : i + size]), c) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The body of a chunked message; extensions and trailers are passed over. Truncated framing is an error."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(data[at : at + size])
        at += size + 2


def _head(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def records(page: object, row: int, url: str | None, body: bytes, holder: object, holder_row: int | None, segment: int) -> Iterator[bytes]:
    """The record of one page, without the separator at its end; several where its block is longer than ``segment``."""
    sha = hashlib.sha1(body)
    digest = "sha1:" + base64.b32encode(sha.digest()).decode()
    own = _uuid("response", row, page)
    # A URI has neither white space nor line ends.
    uri = "".join(f"%{ord(c):02X}" if c <= " " else c for c in url) if url else f"urn:page:{page}"
    base = [("WARC-Record-ID", own), ("WARC-Date", _DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("X-Page-ID", "" if page is None else page)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if holder_row is not None:
        yield _head([("WARC-Type", "revisit"), *base, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _uuid("response", holder_row, holder)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(http))]) + http
        return
    block = http + chunked(body)
    kind = [("WARC-Type", "response"), *base, ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment:
        yield _head([*kind, ("Content-Length", len(block))]) + block
        return
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield _head([*kind, ("WARC-Segment-Number", 1), ("Content-Length", len(parts[0]))]) + parts[0]
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if n == len(parts) else []
        yield _head([("WARC-Type", "continuation"), ("WARC-Record-ID", _uuid(f"segment{n}", row, page)), ("WARC-Date", _DATE), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), *last, ("Content-Length", len(part))]) + part


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", segment: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` as WARC files under ``path``: one response or revisit record each (see record_types)."""
    typed = record_types(pages, id_col, body_col, url_col).select(F.col(id_col), "_row", F.col(url_col), F.col(body_col), "_holder", "_holder_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page, row, url, body, holder, holder_row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for r in records(page, row, url, (body or "").encode(), holder, holder_row, segment):
                    out.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    # The sink writes the bytes of its column as they are; a segment may end within a character.
    typed.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file. At a tear a ValueError is raised, after
    the records before it."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        numbers = [fields.get(k, "0") for k in ("content-length", "warc-segment-number", "warc-segment-total-length")]
        if "content-length" not in fields or not all(n.isascii() and n.isdigit() for n in numbers):
            raise ValueError(f"a length or number can't be read at byte {at}")
        size = int(numbers[0])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError(f"the record at byte {at} is cut off")
        if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the end of the record at byte {at} is missing")
        yield fields, block
        at = end + 8 + size


def unzipped(data: bytes) -> tuple[bytes, str | None]:
    """The bytes of gzip members that follow one another, as far as they can be read, and what is wrong with them."""
    whole: list[bytes] = []
    while data:
        z = zlib.decompressobj(31)
        try:
            for i in range(0, len(data), 1 << 20):
                whole.append(z.decompress(data[i : i + (1 << 20)]))
                if z.eof:
                    data = z.unused_data + data[i + (1 << 20) :]
                    break
            else:
                return b"".join(whole), "the gzip file is cut off"
        except zlib.error:
            return b"".join(whole), "the gzip file is damaged"
    return b"".join(whole), None


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    framed = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]))
    return unchunked(body) if framed else body


_FIELDS = "record_id string, origin_id string, segment int, total long, type string, uri string, page string, digest string, refers_to string, block binary, fault string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the WARC files under ``path`` (.warc or gzip), continuations too, one row each. A file that is torn or damaged
    gives the records before the tear and a row of type ``torn`` with a ``fault``; other files are read as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _FIELDS.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, types[x.split()[1]]) for n, x in zip(names, _FIELDS.split(", "), strict=True)])
        for batch in batches:
            for data in batch.column(0).to_pylist():
                fault, rows = None, []
                if data[:2] == b"\x1f\x8b":
                    data, fault = unzipped(data)
                try:
                    for f, block in parse(data):
                        get = f.get
                        rows.append((get("warc-record-id"), get("warc-segment-origin-id") or get("warc-record-id"), int(get("warc-segment-number", 0)), int(t) if (t := get("warc-segment-total-length")) else None, get("warc-type"), get("warc-target-uri"), get("x-page-id"), get("warc-payload-digest"), get("warc-refers-to"), block, None))
                except ValueError as e:
                    fault = f"{fault}; {e}" if fault else str(e)
                if fault:
                    rows.append((None, None, 0, None, TORN, None, None, None, None, b"", fault))
                cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("length") > 0).select("content").mapInArrow(run, _FIELDS)


def reassemble(parts: DataFrame) -> DataFrame:
    """Whole records: segments grouped by origin identifier, in order of their number, of checked total length.

    Adds ``complete``: whether segments 1 to n are all there, once each, and add up to the stated length;
    the block of an incomplete record is what is there. A record that isn't segmented passes by without a shuffle.
    A group holds one record, whose size bounds it.
    """
    whole = parts.where("segment = 0")
    # Of a segment that was captured twice, one is taken.
    once = parts.where("segment > 0").dropDuplicates(["origin_id", "segment"])
    head = F.col("segment") == 1
    one = lambda c: F.max(F.when(head, F.col(c))).alias(c)
    joined = once.groupBy("origin_id").agg(
        *[one(c) for c in ("record_id", "type", "uri", "page", "digest", "refers_to")],
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("_parts"), F.max("total").alias("total"), F.max("segment").alias("_n"),
    )
    # All parts are put together in one step, their bytes as they are: adding one to another would copy the block once for each segment.
    blocks = F.array_join(F.transform("_parts", lambda p: p["block"].cast("string")), "").cast("binary")
    joined = joined.withColumn("block", blocks).withColumn("complete", F.coalesce((F.size("_parts") == F.col("_n")) & (F.octet_length("block") == F.col("total")) & F.col("record_id").isNotNull(), F.lit(False)))
    kept = ["record_id", "type", "uri", "page", "digest", "refers_to", "block", "complete", "fault"]
    return whole.withColumn("complete", F.lit(True)).select(*kept).unionByName(joined.withColumn("fault", F.lit(None).cast("string")).select(*kept))


def payloads(whole: DataFrame) -> DataFrame:
    """Add payload_bytes, payload_digest (hex SHA-1 of the decoded payload) and fault, and drop the block. A revisit has no
    payload of its own: both are null, as they are for a record with a fault: a tear, missing segments, broken framing, or a payload
    whose digest isn't the stated one. Other records aren't held up by it."""

    def read(kind: str, block: bytes, complete: bool, said: str | None, fault: str | None) -> tuple[int | None, str | None, str | None]:
        if fault:
            return None, None, fault
        if not complete:
            return None, None, "segments are missing"
        if kind == "revisit":
            return None, None, None
        try:
            body = http_payload(block)
        except ValueError as e:
            return None, None, str(e)
        sha = hashlib.sha1(body)
        if said and said != "sha1:" + base64.b32encode(sha.digest()).decode():
            return None, None, "the payload isn't the one that was digested"
        return len(body), sha.hexdigest(), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n in ("type", "block", "complete", "digest", "fault")}
            found = [read(*x) for x in zip(get["type"], get["block"], get["complete"], get["digest"], get["fault"], strict=True)]
            keep = [n for n in batch.schema.names if n not in ("block", "complete", "fault")]
            cols = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in keep), *cols], names=[*keep, "payload_bytes", "payload_digest", "fault"])

    kept = [f for f in whole.schema.fields if f.name not in ("block", "complete", "fault")]
    return whole.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", payload_bytes long, payload_digest string, fault string")


def resolved(read: DataFrame) -> DataFrame:
    """Give revisits the payload of the record that they refer to; ``refers_to_page`` is that record's page. Tears stay as rows."""
    rows = written(read, "read")
    revisits = rows.where("type = 'revisit'").drop("payload_bytes", "payload_digest")
    held = rows.where("type = 'response'").select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest", F.col("page").alias("refers_to_page"))
    asked = revisits.groupBy("refers_to").agg(F.count("*").alias("_n"))
    groups = written(held.join(asked, "refers_to"), "held")
    total = rows.count()
    answer = with_group(revisits, groups, ["refers_to"], "_n", total).drop("_n")
    return rows.where(F.col("type").isin("response", TORN)).withColumn("refers_to_page", F.lit(None).cast("string")).unionByName(answer)


def op7_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = new_path(spark, "warc")
    write_archives(pages, path)
    back = resolved(payloads(reassemble(read_records(spark, path))))
    return back.where(F.col("type") != TORN).select(
        F.col("page").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_to_page").try_cast("long").alias("refers_to")
    )


ORACLE = {
    "op7_warc_roundtrip": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to
FROM m
"""
}
QUERIES = {"op7_warc_roundtrip": op7_warc_roundtrip}
