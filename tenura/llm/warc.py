"""WARC archives: writing, reading back, and reassembly of segmented records.

Writing: every page becomes a record whose block is an HTTP response with the page's html in
chunked transfer framing.  Of pages with equal payloads of at least ``least_revisit`` bytes,
that with the smallest page_id is the ``response``; the others are ``revisit`` records that refer
to it and carry no payload.  A block longer than ``segment_bytes`` is cut into segments: the
record holds segment 1, ``continuation`` records hold the rest under the origin's record id, and
the last states the total length.  Spark's text writer puts the records into gzip files, its line
separator being the blank lines that end a WARC record.

Reading: files are read by Spark with the version line as separator, one gzip file in one
task and in order, so a record is complete when its stated length is; a version line
inside a payload is only part of it.  Segments are grouped by origin id, ordered by segment
number and joined; missing or repeated numbers, a wrong total length, broken chunk framing or a
payload that does not match its digest raise an error.  Revisits take their payload's length from
the record that they refer to.

Defined results: a null html is an empty payload; null page ids are written without an id, come
last in the choice of the response and are read back as null; of repeated rows one is the
response; an empty table gives no records; only page_id, url and html are read, so other
columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.common import ready, salted
from tenura.session import cut, scratch_path

# The version line, the end of a record and the profile of equal payloads.
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

LEAST_REVISIT = 100
SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 8 * 1024


def http_block(payload: bytes | None, chunk_bytes: int) -> bytes:
    """An HTTP response with the payload in chunks; without a payload only its head."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if payload is None:
        return head
    parts = [payload[i : i + chunk_bytes] for i in range(0, len(payload), chunk_bytes)]
    return head + b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(block: bytes) -> bytes:
    """The payload of an HTTP response in chunked framing."""
    at = block.index(b"\r\n\r\n") + 4
    if b"transfer-encoding: chunked" not in block[:at].lower():
        return block[at:]
    out = []
    while True:
        stop = block.index(b"\r\n", at)
        size = int(block[at:stop].split(b";")[0], 16)
        at = stop + 2
        if size == 0:
            break
        out.append(block[at : at + size])
        if len(out[-1]) != size or block[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk framing is broken")
        at += size + 2
    return b"".join(out)


def warc_records(fields: list[tuple[str, str]], kind: str, record_id: str, block: bytes, segment_bytes: int) -> list[bytes]:
    """The record and its continuations, without the end that the writer adds."""

    def record(kind: str, record_id: str, more: list[tuple[str, str]], part: bytes) -> bytes:
        head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", DATE), *more]
        head.append(("Content-Length", str(len(part))))
        return (VERSION + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + part

    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)] or [b""]
    if len(parts) == 1:
        return [record(kind, record_id, fields, block)]
    out = [record(kind, record_id, [*fields, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Segment-Origin-ID", f"<urn:uuid:{record_id}>"), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        own = f"{record_id[:24]}{(int(record_id[24:], 16) + n) % (1 << 48):012x}"
        out.append(record("continuation", own, more, part))
    return out


def _records(segment_bytes: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                fields = []
                if row["url"] is not None:
                    uri = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
                    fields.append(("WARC-Target-URI", uri))
                if row["page_id"] is not None:
                    fields.append(("X-Page-ID", str(row["page_id"])))
                fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{row['digest']}")]
                kind, payload = "response", row["payload"]
                if row["refers"] is not None:
                    kind, payload = "revisit", None
                    fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:uuid:{row['refers']}>")]
                out += warc_records(fields, kind, row["record_id"], http_block(payload, chunk_bytes), segment_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def _uuid(*parts: object) -> object:
    h = F.md5(F.concat_ws(":", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts])


def write_archives(
    pages: DataFrame,
    path: str,
    least_revisit: int = LEAST_REVISIT,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write a record per page into gzip files below ``path``, a folder that all executors reach."""
    ready(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.monotonically_increasing_id().alias("row"),
        F.col("page_id").alias("id"),
    )
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))).alias("best")
    groups = (
        rows.where(F.length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(best, F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("best.row").alias("first_row"), _uuid(F.col("best.id").cast("string"), F.col("best.row")).alias("first"))
    )
    met = salted(rows, groups, "digest", F.col("row"))
    refers = F.when(F.col("first_row") != F.col("row"), F.col("first"))
    told = met.select("page_id", "url", "payload", "digest", _uuid("page_id", "row").alias("record_id"), refers.alias("refers"))
    records = told.mapInArrow(_records(segment_bytes, chunk_bytes), "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", END).option("compression", "gzip").text(path)


READ = (
    "record_id string, kind string, page_id string, url string, digest string, refers string, "
    "origin string, segment int, total long, block binary"
)


def parsed(record: bytes) -> tuple | None:
    """The fields of READ from a record without its version line; None while it is incomplete."""
    stop = record.find(b"\r\n\r\n")
    if stop < 0:
        return None
    head = dict(line.split(": ", 1) for line in record[:stop].decode().split("\r\n"))
    start, length = stop + 4, int(head["Content-Length"])
    if len(record) < start + length + len(END):
        return None
    if record[start + length :] != END.encode():
        raise ValueError("a record is longer than it states")
    bare = lambda name: head[name].removeprefix("<urn:uuid:").removesuffix(">") if name in head else None
    digest = head.get("WARC-Payload-Digest")
    return (
        bare("WARC-Record-ID"), head["WARC-Type"], head.get("X-Page-ID"), head.get("WARC-Target-URI"),
        digest and digest.removeprefix("sha256:"), bare("WARC-Refers-To"), bare("WARC-Segment-Origin-ID"),
        int(head["WARC-Segment-Number"]) if "WARC-Segment-Number" in head else None,
        int(head["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in head else None,
        record[start : start + length],
    )


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string()] * 7 + [pa.int32(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in READ.split(", ")]
    held, file = None, None
    for batch in batches:
        out = []
        for path, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if path != file:  # what stands before the first version line of a file is empty
                if held is not None:
                    raise ValueError("a file ends within a record")
                if piece:
                    raise ValueError("a file does not begin with a version line")
                file = path
                continue
            held = piece if held is None else held + VERSION.encode() + piece
            if (record := parsed(held)) is not None:
                out.append(record)
                held = None
        columns = zip(*out, strict=True) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    if held is not None:
        raise ValueError("a file ends within a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, kind, page_id, url, digest, refers, payload of every record, segments joined.

    A revisit has a null payload; see ``resolved``.
    """
    ready(spark)
    lines = spark.read.option("lineSep", VERSION).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    records = lines.mapInArrow(_parse, READ)
    fields = ["record_id", "kind", "page_id", "url", "digest", "refers"]
    whole = records.where("segment is null").select(*fields, "block")
    parts = records.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in fields[1:]],
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    joined = parts.withColumn("block", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.block))"))
    sound = (F.length("block") == F.col("total")) & (
        F.col("parts.segment") == F.sequence(F.lit(1), F.size("parts"))
    )
    failed = F.raise_error(F.concat(F.lit("segments missing, repeated or of wrong length: "), "record_id")).cast("binary")
    joined = joined.withColumn("block", F.when(F.coalesce(sound, F.lit(False)), F.col("block")).otherwise(failed))
    every = whole.unionByName(joined.select(*fields, "block"))

    def decoded(blocks: pd.Series) -> pd.Series:
        return blocks.map(lambda b: None if b is None else unchunked(b))

    payload = F.pandas_udf(decoded, "binary")(F.when(F.col("kind") == "response", F.col("block")))
    return every.select(*fields, payload.alias("payload"))


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; revisits take them from their response."""
    sha = F.sha2("payload", 256)
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest: "), "record_id")).cast("string")
    narrow = cut(
        records.select(
            "record_id", "kind", "page_id", "refers", F.length("payload").cast("long").alias("bytes"),
            F.when(F.col("payload").isNull() | (sha == F.col("digest")), F.col("digest")).otherwise(wrong).alias("digest"),
        )
    )
    responses, revisits = narrow.where("kind = 'response'"), narrow.where("kind = 'revisit'").drop("bytes")
    asked = revisits.select("refers").distinct()
    answers = responses.select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), "bytes", F.col("digest").alias("found")
    )
    met = salted(revisits, asked.join(answers, "refers"), "refers", F.col("record_id"))
    lost = F.raise_error(F.concat(F.lit("a revisit does not match what it refers to: "), "record_id")).cast("string")
    met = met.withColumn("digest", F.when(F.col("found") == F.col("digest"), F.col("digest")).otherwise(lost))
    out = responses.withColumn("refers_to", F.lit(None).cast("string"))
    names = ["page_id", "bytes", "digest", "kind", "refers_to"]
    return out.select(names).unionByName(met.select(names)).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to",
    )


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archives, read them back and return ``resolved`` with ids of the pages' type."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    found = resolved(read_archives(spark, path))
    return found.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
