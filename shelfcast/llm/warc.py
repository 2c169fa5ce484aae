"""WARC archives of web pages, with equal payloads written once and revisited.

Headers (page, payload digest, size) are grouped by digest. The smallest page of a group holds the payload as ``response``, the
others become ``revisit`` records that refer to it; payloads under ``least`` bytes are always written. Every record gets
fresh headers. Reading back joins the revisits to the originals by payload digest.

Spark's own writer and reader touch the store, so archives may lie wherever Spark reaches, and a lost task is simply run again.
A task writes one archive, or several where it has more than ``per_archive`` records. Groups are cut by a salt of the page, and
each part is summed up before the shuffle, so that one payload with a third of all pages meets no single task.

Defined results: null html is an empty payload; null page_id comes last and is null when read; rows that share the smallest
page_id of a group are all responses; null url has no target header, control characters in it are percent-encoded; an
empty table gives archives without records; other columns, whatever their names, do not enter the archives. A damaged archive
raises an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.store import arrow_rows, saved
from shelfcast.llm.text import column

SALTS = 256
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, record_type string, target string, date string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
CHUNK = 1 << 20


def _salt(of: Column) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(SALTS))


def _spread(rows: DataFrame, value: Column) -> DataFrame:
    """(digest, salt, low, n): the smallest value and the count of each digest, once for every salt that its rows have."""
    parts = rows.groupBy("digest", "salt").agg(F.min(value).alias("low"), F.count(F.lit(1)).alias("n"))
    parts = saved(parts, "warc-parts")
    whole = parts.groupBy("digest").agg(F.min("low").alias("low"), F.sum("n").alias("n"))
    return parts.select("digest", "salt").join(whole, "digest")


def resolved_pages(pages: DataFrame, *, least: int = 100) -> DataFrame:
    """page_id, url, html, digest, record_type and refers_to of every row of ``pages(page_id, url, html)``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"), _salt(F.col("page_id")).alias("salt"))
    groups = _spread(rows.where(F.octet_length("html") >= least), F.col("page_id")).where("n > 1")
    groups = saved(groups.select(F.col("digest").alias("of"), F.col("salt").alias("its"), "low"), "warc-groups")
    joined = rows.join(groups, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("its")), "left")
    revisit = F.col("low").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("low"))
    kind = F.when(revisit, "revisit").otherwise("response")
    return joined.select("page_id", "url", "html", "digest", kind.alias("record_type"), F.when(revisit, F.col("low")).alias("refers_to"))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(page_id.cast("string")), F.lit("")), F.lit(">"))


def _page(urn: Column, kind: str) -> Column:
    name = F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)
    return F.when(F.length(name) > 0, F.url_decode(name)).cast(kind)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))


def record_text(date: str) -> Column:
    """A record without its closing line breaks, of the columns of ``resolved_pages``."""
    original = F.col("record_type") == "response"
    escaped = F.col("url")
    for code in [*range(32), 127]:
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    url = F.when(F.col("url").rlike(r"[\x00-\x1F\x7F]"), escaped).otherwise(F.col("url"))
    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END)
    )
    block = F.when(original, F.concat(answer, F.col("html"))).otherwise(answer)
    return F.concat(
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(~original, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(~original, _urn(F.col("refers_to")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def write_archives(pages: DataFrame, path: str, *, least: int = 100, date: str = "2024-01-01T00:00:00Z", per_archive: int = 20_000) -> None:
    """Write every row of ``pages`` as a record; the archives in the folder ``path`` are compressed with gzip."""
    records = resolved_pages(pages, least=least).select(record_text(date).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes | None:
        if self.fields.get("warc-type") == "revisit":
            return None
        if self.fields.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


def _inflated(content: bytes) -> Iterator[bytes]:
    """The content in pieces, decompressed if it is gzip, of one member or many."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + CHUNK] for i in range(0, len(content), CHUNK))
        return
    left, member = memoryview(content), zlib.decompressobj(31)
    while len(left):
        data = member.decompress(left[:CHUNK])
        taken = min(CHUNK, len(left)) - len(member.unused_data)
        left = left[taken:]
        yield data
        if member.eof:
            member = zlib.decompressobj(31)
        elif not len(left):
            raise ValueError("the archive ends inside a gzip member")


def records_of(content: bytes) -> Iterator[Record]:
    """The records of an archive; holds one record and a piece of the archive at a time."""
    held, at, stream = bytearray(), 0, _inflated(content)

    def more(reason: str) -> None:
        nonlocal at
        del held[:at]
        at = 0
        piece = next(stream, None)
        if piece is None:
            raise ValueError(f"the archive ends inside {reason}")
        held.extend(piece)

    while True:
        while len(held) == at:
            piece = next(stream, None)
            if piece is None:
                return
            del held[:at]
            at = 0
            held.extend(piece)
        looked = at
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            before = at
            looked = max(at, len(held) - 3)
            more("a header")
            looked -= before
        first, *lines = bytes(held[at:end]).decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size, at = int(fields["content-length"]), end + 4
        while len(held) - at < size + 4:
            more("a block")
        if held[at + size : at + size + 4] != b"\r\n\r\n":
            raise ValueError("a block is not as long as its header says")
        yield Record(fields, bytes(held[at : at + size]))
        at += size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder as they are there: a revisit has no payload, its digest is the header's.

    Of other records digest and size are worked out from the payload; one that differs from its header raises an error.
    """
    arrow_rows(spark, 1)
    names = [f.split(" ")[0] for f in RECORD.split(", ")]
    schema = pa.schema([(n, {"payload": pa.binary(), "payload_bytes": pa.int64()}.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for content in column(batch, "content"):
                for r in records_of(content.as_buffer().to_pybytes()):
                    payload, told = r.payload, r.fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    digest = told if payload is None else hashlib.sha256(payload).hexdigest()
                    if told not in (None, digest):
                        raise ValueError(f"the payload of {r.fields.get('warc-record-id')} is not the one of its digest")
                    n = None if payload is None else len(payload)
                    rows.append((*(r.fields.get(k) for k in ("warc-record-id", "warc-type", "warc-target-uri", "warc-date", "warc-refers-to")), digest, n, payload))
                    size += n or 0
                    if size > 4 * CHUNK or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def joined_revisits(records: DataFrame, *, payload: bool = False) -> DataFrame:
    """``records`` with the size, and if asked for the payload, of revisits taken from the original of the same digest."""
    found = ["payload_bytes", "payload"][: 1 + payload]
    rows = records.select("record_id", "record_type", "target", "date", "refers_to", F.col("payload_digest").alias("digest"), *found)
    rows = rows.withColumn("salt", _salt(F.col("record_id")))
    originals = rows.where("record_type <> 'revisit'").groupBy("digest").agg(F.first(F.struct(*found)).alias("its"))
    wanted = rows.where("record_type = 'revisit'").select("digest", "salt").distinct()
    theirs = wanted.join(originals, "digest").select(F.col("digest").alias("of"), F.col("salt").alias("at"), "its")
    on = (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("at")) & (F.col("record_type") == "revisit")
    whole = [F.coalesce(c, F.col(f"its.{c}")).alias(c) for c in found]
    return rows.join(theirs, on, "left").select("record_id", "record_type", "target", "date", "refers_to", F.col("digest").alias("payload_digest"), *whole)


def read_pages(spark: SparkSession, path: str, kind: str = "bigint", *, html: bool = True) -> DataFrame:
    """The pages of an archive folder, revisits resolved: page_id, url, payload_bytes, payload_digest, record_type, refers_to, html.

    Without ``html`` the payloads are left out, and only sizes and digests move between tasks.
    """
    records = read_archives(spark, path)
    if not html:
        records = saved(records.drop("payload"), "warc-heads")
    whole = joined_revisits(records, payload=html)
    text = [F.col("payload").cast("string").alias("html")] if html else []
    return whole.select(
        _page(F.col("record_id"), kind).alias("page_id"), F.col("target").alias("url"), "payload_bytes", "payload_digest", "record_type",
        _page(F.col("refers_to"), kind).alias("refers_to"), *text,
    )
