"""Web archives: written with segmented, chunk-framed records, and reassembled when read.

A page's response is one HTTP message whose body has chunked transfer framing. A block above a size is cut into
segments: the response record carries the first, `continuation` records carry the rest under the identifier of their
origin. Pages with a payload that a page of a larger id has too become `revisit` records without a body. Archives are
gzip files of records as the WARC 1.1 standard lays them out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.llm.common import cut, map_batches

_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = ("record string, type string, origin string, segment int, total long, page_id long, refers_to long, "
           "digest string, block binary, problem string")
_OWN = re.compile(r"urn:page:(-?\d*)(?::|$)")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes, chunk: int) -> bytes:
    """The payload as chunks of at most `chunk` bytes, cut between characters, and the closing empty chunk."""
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in _cut(payload, chunk)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """The payload of a body in chunks; trailers and chunk extensions are skipped, anything else raises ValueError."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("bad chunk size")
        n = int(size, 16)
        at = line + 2
        if not n:
            if not (body[at:at + 2] == b"\r\n" or body.endswith(_END.encode())):
                raise ValueError("no end after the last chunk")
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk differs from its size")
        out.append(body[at:at + n])
        at += n + 2


def _cut(data: bytes, most: int) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + most)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def _record(kind: str, name: str, block: bytes, **fields: object) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def _uri(url: str | None) -> str:
    """A header value: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def records(pages: DataFrame, smallest: int = 0, segment: int = 1 << 16, chunk: int = 1 << 14,
            date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """`value`: the text of each record, without the line ends that close it.

    Of pages with equal payloads of at least `smallest` bytes, those with the largest page_id (one, unless rows
    repeat) are responses, the others revisits of it. A null html is an empty payload; a null page_id is below any other.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long"), "url", body.alias("payload")).withColumn(
        "sha", F.sha1("payload")).withColumn("row", F.monotonically_increasing_id())
    last = keyed.filter(F.length("payload") >= smallest).groupBy("sha").agg(
        F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").select("sha", "last")
    marked = keyed.join(last, "sha", "left").select(
        "page_id", "url", "row", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("of"),
        F.when(F.col("page_id").eqNullSafe(F.col("last")) | F.col("last").isNull(), F.col("payload")).alias("payload"), "sha")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for r in batch.to_pylist():
                name = f"urn:page:{'' if r['page_id'] is None else r['page_id']}:{r['row']}"
                common = {"WARC_Date": date, "WARC_Target_URI": _uri(r["url"]),
                          "WARC_Payload_Digest": "sha1:" + base64.b32encode(bytes.fromhex(r["sha"])).decode()}
                if r["of"] is not None:
                    out.append(_record("revisit", name, b"", **common, WARC_Profile=_PROFILE,
                                       WARC_Refers_To=f"<urn:page:{r['of']}>"))
                    continue
                block = _HTTP.encode() + framed(r["payload"], chunk)
                parts = _cut(block, segment)
                many = len(parts) > 1
                out.append(_record("response", name, parts[0], **common, Content_Type="application/http;msgtype=response",
                                   WARC_Segment_Number=1 if many else None))
                for k, part in enumerate(parts[1:], 2):
                    out.append(_record(
                        "continuation", f"{name}:{k}", part, WARC_Date=date, WARC_Target_URI=_uri(r["url"]),
                        WARC_Segment_Origin_ID=f"<{name}>", WARC_Segment_Number=k,
                        WARC_Segment_Total_Length=len(block) if k == len(parts) else None))
            return pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        return work
    return map_batches(marked, make, "value string")


def write_archives(pages: DataFrame, path: str, file_records: int = 1024, **options) -> None:
    """Writes `.gz` archives of at most `file_records` records, so that a reader holds one at a time."""
    (records(pages, **options).write.option("lineSep", _END).option("compression", "gzip")
     .option("maxRecordsPerFile", file_records).text(path))


def _parse(archive: bytes):
    """The records of one archive; raises where it is broken."""
    file = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(archive)))
    while True:
        line = file.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            fields[key.lower()] = value.strip()
        if not {"warc-record-id", "warc-type", "content-length"} <= fields.keys():
            raise ValueError("a record lacks a required field")
        n = int(fields["content-length"])
        block = file.read(n)
        if len(block) != n or file.read(4) != _END.encode():
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        yield fields, block


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: identifier, type, origin (its own for first or only segments), segment, and block.

    `page_id` and `refers_to` are those that `records` writes into identifiers, and null for records of other writers.
    An archive that breaks off gives its sound records and a row of type `broken` whose `problem` says where.
    """
    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def bare(text: str | None) -> str | None:
        return text.strip("<>") if text else None

    def page(name: str | None) -> int | None:
        own = _OWN.match(name or "")
        return number(own[1]) if own else None
    schema = pa.schema([
        ("record", pa.string()), ("type", pa.string()), ("origin", pa.string()), ("segment", pa.int32()),
        ("total", pa.int64()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()),
        ("block", pa.binary()), ("problem", pa.string())])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for name, archive in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    for f, block in _parse(archive):
                        record, kind, sha = bare(f["warc-record-id"]), f["warc-type"], f.get("warc-payload-digest")
                        out.append({
                            "record": record, "type": kind, "origin": bare(f.get("warc-segment-origin-id")) or record,
                            "segment": number(f.get("warc-segment-number")), "total": number(f.get("warc-segment-total-length")),
                            "page_id": page(record) if kind != "continuation" else None,
                            "refers_to": page(bare(f.get("warc-refers-to"))), "digest": sha.partition(":")[2] if sha else None,
                            "block": block})
                except (ValueError, OSError, EOFError, zlib.error) as e:
                    out.append({"type": "broken", "problem": f"{name}: {e}"})
            return pa.RecordBatch.from_pylist(out, schema)
        return work
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return map_batches(files, make, _RECORD, rows=1)


def _contents(found: DataFrame, keep: bool) -> DataFrame:
    """`record_type`, `page_id`, `refers_to`, `digest`, `payload`, `payload_bytes`, `payload_digest`, `problem`: a row for every
    response, its segments joined, and revisits and broken archives as they are; without `keep` the payload itself is null.

    Only two passes read the archives: one for segments, one for all else.
    """
    whole, none = F.col("type").isin("response", "continuation"), F.lit(None)
    kind = F.when(whole, "response").otherwise(F.col("type")).alias("record_type")
    alone = found.filter((whole & F.col("segment").isNull()) | F.col("type").isin("revisit", "broken")).select(
        kind, "page_id", "refers_to", "digest", F.coalesce("problem", F.lit("")).alias("fault"), F.array("block").alias("blocks"))
    parts = F.sort_array(F.collect_list(F.struct("segment", "block")))
    joined = (found.filter(whole & F.col("segment").isNotNull()).groupBy("origin").agg(
        F.max("page_id").alias("page_id"), F.max("digest").alias("digest"), F.max("total").alias("total"),
        parts.alias("parts")))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.length(p["block"]))
    numbers = F.transform("parts", lambda p: p["segment"])
    fault = (F.when(numbers != F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1))), "segments are missing or doubled")
             .when(F.col("total").isNull(), "the last segment is missing")
             .when(length != F.col("total"), "the length differs from the total").otherwise(""))
    joined = joined.select(F.lit("response").alias("record_type"), "page_id", none.cast("long").alias("refers_to"), "digest",
                           fault.alias("fault"), F.col("parts.block").alias("blocks"))
    fields = pa.schema([
        ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("problem", pa.string())])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for r in batch.to_pylist():
                payload, problem = None, r["fault"] or None
                if not problem and r["record_type"] == "response":
                    head, _, body = b"".join(r["blocks"]).partition(_END.encode())
                    try:
                        payload = unframed(body) if b"transfer-encoding: chunked" in head.lower() else body
                    except ValueError as e:
                        problem = str(e)
                sha = None if payload is None else digest(payload)
                if sha and r["digest"] and sha != r["digest"]:
                    problem = "the digest differs"
                out.append({"record_type": r["record_type"], "page_id": r["page_id"], "refers_to": r["refers_to"],
                            "digest": r["digest"], "payload": payload if keep else None,
                            "payload_bytes": None if payload is None else len(payload), "payload_digest": sha,
                            "problem": problem})
            return pa.RecordBatch.from_pylist(out, fields)
        return work
    return map_batches(alone.unionByName(joined), make, "record_type string, page_id long, refers_to long, digest string, "
                       "payload binary, payload_bytes long, payload_digest string, problem string", rows=8)


def payloads(found: DataFrame) -> DataFrame:
    """`page_id`, `digest`, `payload`, `payload_bytes`, `payload_digest`, `problem` for every response (records of other types
    are passed over).

    Segments are grouped by origin (one page each), ordered by number and joined. `problem` says why a payload is
    null: a segment is missing or doubled, the joined length differs from the total the last one states, the framing is
    broken; or that the payload's digest differs from the header's.
    """
    return _contents(found, keep=True).filter("record_type = 'response'").select(
        "page_id", "digest", "payload", "payload_bytes", "payload_digest", "problem")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`, `problem` for each page archived.

    A revisit takes its payload's facts from the response it refers to, and a problem if there is none. A response
    with a problem keeps its row, and an archive that breaks off adds one of `record_type` broken without a page.
    What a page's row needs is stored once in the shared folder, without the payload, so that archives are not read for
    each kind of row again.
    """
    whole = cut(_contents(read_records(spark, path), keep=False).drop("payload"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    targets = whole.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("digest")).agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    revisits = whole.filter("record_type = 'revisit'").select("page_id", "digest", "record_type", "refers_to").join(
        targets, ["refers_to", "digest"], "left").withColumn(
        "problem", F.when(F.col("payload_digest").isNull(), "its response is missing"))
    none = F.lit(None).cast("long")
    rest = whole.filter("record_type <> 'revisit'").withColumn("refers_to", none).withColumn(
        "page_id", F.when(F.col("record_type") == "response", F.col("page_id")))
    return rest.select(*columns).unionByName(revisits.select(*columns))
