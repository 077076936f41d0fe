"""WARC archives with segmented records.

Writing.  Every page becomes one record whose block is an HTTP response with
the payload in chunked transfer framing.  A block above ``segment_bytes`` is
cut: the first record and its ``continuation`` records carry a segment number,
continuations name the first one's id, the last tells the total length.  Of
pages with equal payloads of at least ``min_bytes`` bytes the one with the
largest id is the response; the others are ``revisit`` records without
payload that name the response's page and address.  Spark's own writer puts the records into gzipped files of at most
``RECORDS`` records in the shared folder; two line ends separate records.

Reading.  Files are split into records by Content-Length.  Continuations are
grouped with their origin by its id, ordered by segment number and joined; the
total length is verified; the HTTP head is cut off, chunked framing decoded
and the payload digest verified.  A revisit gets the size of the payload that
it refers to.

Defined results: a null payload is empty; rows that repeat a page and its
payload get the same record type and each a record of its own; a null id is
smaller than any other; an empty table gives an archive without records.  Only
the columns named are read.  A record whose segments are missing or whose
length or digest differs is returned with ``intact`` false and what was found.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pandas as pd
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from huddle.llm.shared import side, written
from huddle.session import shared_path

RECORDS = 4096
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
BATCH = 256
#: Shared payloads whose keepers (digest, id, address) are broadcast, and copies of one that a join gives to one key.
KEEPERS, COPIES = 50_000, 20_000
CRLF = b"\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARSED = "record_id string, type string, page long, refers_to long, digest string, segment int, origin string, total long, block binary"
READ = "page long, type string, refers_to long, digest string, segments int, payload binary, intact boolean"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out = bytearray()
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += b"%x" % len(part) + CRLF + part + CRLF
    return bytes(out + b"0" + END)


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    out, at = bytearray(), 0
    while True:
        stop = body.find(CRLF, at)
        try:
            size = int(body[at:stop].split(b";")[0], 16) if stop >= 0 else -1
        except ValueError:
            return None
        if size <= 0:
            return bytes(out) if size == 0 else None
        out += body[stop + 2 : stop + 2 + size]
        if body[stop + 2 + size : stop + 4 + size] != CRLF:
            return None
        at = stop + 4 + size


def record(kind: str, record_id: str, block: bytes, **more) -> bytes:
    """One record without the line ends behind it."""
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:uuid:" + record_id.encode() + b">", b"WARC-Date: 2000-01-01T00:00:00Z"]
    head += [f"{k.replace('_', '-')}: {v}".replace("\r", "%0D").replace("\n", "%0A").encode() for k, v in more.items() if v is not None]
    head.append(b"Content-Type: application/http; msgtype=response")
    head.append(b"Content-Length: %d" % len(block))
    return CRLF.join(head) + END + block


def page_records(page: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_to_url: str | None, revisit: bool, segment_bytes: int) -> list[bytes]:
    digest = "sha1:" + base32_sha1(payload)
    own = {"WARC_Target_URI": url, "X_Page_Id": page, "WARC_Payload_Digest": digest}
    first = str(uuid.uuid4())
    if revisit:
        return [record("revisit", first, b"HTTP/1.1 200 OK" + END, **own, WARC_Profile=PROFILE, WARC_Refers_To_Target_URI=refers_to_url, X_Refers_To_Page_Id=refers_to)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [record("response", first, block, **own)]
    out = [record("response", first, parts[0], **own, WARC_Segment_Number=1)]
    for n, part in enumerate(parts[1:], 2):
        total = len(block) if n == len(parts) else None
        out.append(record("continuation", str(uuid.uuid4()), part, WARC_Segment_Origin_ID=f"<urn:uuid:{first}>", WARC_Segment_Number=n, WARC_Segment_Total_Length=total))
    return out


def _keepers(rows: DataFrame, min_bytes: int) -> DataFrame:
    """sha, copies, keeper, keeper_url of the payloads that several rows share; no payload is shuffled."""
    found = rows.where(F.length("payload") >= min_bytes).groupBy("sha").agg(F.count("*").alias("copies"), F.max(F.struct("page", "url")).alias("best"))
    return found.where("copies > 1").select("sha", "copies", F.col("best.page").alias("keeper"), F.col("best.url").alias("keeper_url"))


def _with_keepers(rows: DataFrame, keepers: DataFrame, limit: int = KEEPERS) -> DataFrame:
    """The rows and the keepers of their payloads.  Up to ``limit`` keepers go to the rows.  Beyond, both
    meet by payload, where one of more than COPIES rows is dealt to that many more keys: which are so is
    broadcast, at most rows / COPIES of them."""
    if keepers.count() <= limit:
        return rows.join(F.broadcast(keepers), "sha", "left")
    blocks = F.ceil(F.col("copies") / COPIES).cast("long")
    hot = keepers.where(F.col("copies") > COPIES).select("sha", blocks.alias("blocks"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(hot), "sha", "left")
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("row"), F.col("blocks")), F.lit(0))).drop("row", "blocks")
    spread = keepers.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return rows.join(spread, ["sha", "salt"], "left").drop("salt")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> str:
    """Write one record per page (and its continuations) below ``path``."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    rows = _with_keepers(rows, written(_keepers(rows, min_bytes), "warc-keepers"))
    rows = rows.withColumn("revisit", F.col("copies").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page")))

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, BATCH) for i in range(0, batch.num_rows, BATCH)):
                out = [x for row in part.to_pylist() for x in page_records(**row, segment_bytes=segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = rows.select("page", "url", "payload", F.col("keeper").alias("refers_to"), F.col("keeper_url").alias("refers_to_url"), "revisit").mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)
    return path


def parse(data: bytes):
    """The records of a file as dicts of PARSED's columns."""
    at = 0
    while at < len(data):
        stop = data.find(END, at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = {}
        for line in data[at:stop].split(CRLF)[1:]:
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode()] = v.strip().decode()
        begin = stop + len(END)
        end = begin + int(head["content-length"])
        number = lambda k: int(head[k]) if k in head else None  # noqa: B023, E731
        yield {
            "record_id": head["warc-record-id"], "type": head["warc-type"], "page": number("x-page-id"), "refers_to": number("x-refers-to-page-id"),
            "digest": head.get("warc-payload-digest"), "segment": number("warc-segment-number"), "origin": head.get("warc-segment-origin-id"),
            "total": number("warc-segment-total-length"), "block": data[begin:end],
        }
        at = end
        while data.startswith(CRLF, at):
            at += len(CRLF)


def opened(row: dict, block: bytes, segments: int, whole: bool) -> dict:
    """A READ row from a record's joined block."""
    head, _, body = block.partition(END)
    payload = None
    if row["type"] == "response":
        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    digest = (row["digest"] or "").removeprefix("sha1:") or None
    fits = row["type"] == "revisit" or (payload is not None and base32_sha1(payload) == digest)
    return {"page": row["page"], "type": row["type"], "refers_to": row["refers_to"], "digest": digest, "segments": segments, "payload": payload, "intact": bool(whole and fits)}


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record: page, type, refers_to, digest, segments, payload, intact."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")

    def split(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                data = gzip.decompress(data) if name.endswith(".gz") else data
                some = []
                for row in parse(data):
                    some.append(row)
                    if len(some) == BATCH:
                        yield pa.RecordBatch.from_pylist(some, schema=parsed)
                        some = []
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema=parsed)

    text, number = pa.string(), pa.int64()
    parsed = pa.schema([("record_id", text), ("type", text), ("page", number), ("refers_to", number), ("digest", text), ("segment", pa.int32()), ("origin", text), ("total", number), ("block", pa.binary())])
    read = pa.schema([("page", number), ("type", text), ("refers_to", number), ("digest", text), ("segments", pa.int32()), ("payload", pa.binary()), ("intact", pa.bool_())])
    records = written(files.mapInArrow(split, PARSED), "warc-records")

    def single(batches):
        for batch in batches:
            for part in (batch.slice(i, BATCH) for i in range(0, batch.num_rows, BATCH)):
                yield pa.RecordBatch.from_pylist([opened(r, r["block"], 1, True) for r in part.to_pylist()], schema=read)

    def joined(segments: pd.DataFrame) -> pd.DataFrame:
        segments = segments.sort_values("segment").drop_duplicates("segment")
        block = b"".join(segments["block"])
        first, last = segments.iloc[0].to_dict(), segments.iloc[-1]
        whole = list(segments["segment"]) == list(range(1, len(segments) + 1)) and last["total"] == len(block)
        first = {k: None if not isinstance(v, bytes) and pd.isna(v) else v for k, v in first.items()}
        return pd.DataFrame([opened(first, block, len(segments), whole)]).astype({"page": "Int64", "refers_to": "Int64"})

    grouped = records.where("segment is not null").withColumn("of", F.coalesce("origin", "record_id")).groupBy("of").applyInPandas(joined, READ)
    return records.where("segment is null").mapInArrow(single, READ).union(grouped)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Archive all pages and read them back: page, payload_bytes, digest, type, refers_to, segments, intact."""
    spark = pages.sparkSession
    path = write_archive(pages, shared_path(spark, "warc", uuid.uuid4().hex), id_col, url_col, html_col, min_bytes, segment_bytes)
    rows = written(read_archive(spark, path).select("page", "type", "refers_to", "digest", "segments", F.length("payload").cast("long").alias("bytes"), "intact"), "warc-read")
    kept = rows.where("type = 'response'").groupBy(F.col("page").alias("refers_to"), "digest").agg(F.max("bytes").alias("kept_bytes"), F.min("intact").alias("kept_intact"))
    # only what revisits refer to, counted before it is broadcast
    asked = rows.where("type = 'revisit'").select("refers_to", "digest").distinct()
    revisits = rows.where("type = 'revisit'").join(side(written(kept.join(asked, ["refers_to", "digest"]), "warc-kept"), KEEPERS), ["refers_to", "digest"], "left")
    columns = ["page", "type", "refers_to", "digest", "segments", "bytes", "intact"]
    revisits = revisits.withColumn("bytes", F.col("kept_bytes")).withColumn("intact", F.col("intact") & F.coalesce("kept_intact", F.lit(False)))
    return rows.where("type = 'response'").select(*columns).union(revisits.select(*columns)).withColumnRenamed("bytes", "payload_bytes")
