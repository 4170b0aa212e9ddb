"""WARC archives: written by Spark's text sink, read back by boundary-chain verification.

A record is a header, an empty line, the payload and two line ends. Archives are read in
splits, line by line. Any line that looks like the start of a record is a candidate; its
header says where its successor must begin. Candidates that lie within a split are taken
there; what crosses into following splits is completed from their first bytes. Pointer
jumping from the start of each file then finds the candidates that a chain of successors
reaches. The others are payload that only looks like records.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.session import stage, staging_dir

END = "\r\n\r\n"
#: The letters of base32 and of base 32 numbers.
_BASE32, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_START = re.compile(rb"WARC/1\.[01]\r?$")
_FIELD = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+:|[ \t]")
#: Records in one archive file.
PER_FILE = 20_000


def base32_sha1(payload: Column) -> Column:
    """The bare base32 SHA-1 of a binary column: ten hexadecimal digits are eight letters."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def write_archives(pages: DataFrame, path: str, least_revisit: int = 0) -> None:
    """One record for each row ``page_id, url, html`` of ``pages`` under ``path``.

    The payload is the html in UTF-8; null is empty. Of records with equal payloads of at
    least ``least_revisit`` bytes the one with the smallest page_id is a response; the
    others are revisits without payload which name it and the payload's length and digest.
    Pages without an id are responses. Line ends inside a url are dropped.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), base32_sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    same = rows.filter((F.col("size") >= least_revisit) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("many"))
    # only repeated payloads, written out: small ones are broadcast by their measured size
    same = stage(same.filter("many > 1").select("digest", "first"), "repeated")
    rows = rows.join(same, "digest", "left")
    revisit = F.coalesce((F.col("first") != F.col("page_id")) & (F.col("size") >= least_revisit), F.lit(False))
    name = F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace("url", r"[\r\n]", "")
    lines = [
        F.lit("WARC/1.1"),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit("WARC-Date: 2000-01-01T00:00:00Z"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:x-page:"), F.col("first").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("X-Payload-Length: "), F.col("size"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("size"))),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(END), F.when(revisit, "").otherwise(F.col("html")))
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", PER_FILE).text(path)


def parsed(data: bytes) -> tuple[bytes, int, int] | None:
    """Header, its length and the payload's length of a record that begins ``data``; None
    while the header has no end or is none."""
    at = data.find(b"\n\r\n")
    if at < 0:
        return None
    header = data[: at + 1]
    lines = header.split(b"\n")[:-1]
    if not _START.match(lines[0]) or not all(_FIELD.match(x) for x in lines[1:]):
        return None
    found = re.search(rb"(?im)^content-length[ \t]*:[ \t]*([0-9]+)[ \t]*\r?$", header)
    return (header, at + 3, int(found[1])) if found and len(found[1]) < 19 else None


class _Split:
    """The candidates of one split, from its lines in order."""

    def __init__(self, path: str, block: int, size: int, whole_leads: bool):
        self.path, self.block, self.size, self.whole_leads = path, block, size, whole_leads
        self.at, self.lead, self.leading = 0, bytearray(), True
        self.held, self.base = bytearray(), 0  # bytes from the earliest open candidate on
        self.heading = None  # start of the candidate whose header is being read
        self.open: list[tuple[int, int, int, bytes]] = []  # end, start, header's length, header

    def row(self, kind: str, at: int = 0, header: bytes | None = None, data: bytes | None = None, length: int = 0, **more):
        return {"path": self.path, "block": self.block, "size": self.size, "kind": kind, "at": at,
                "header": header.decode("utf-8", "replace") if header is not None else None, "length": length, "data": data, "whole": False} | more

    def line(self, line: bytes) -> Iterator[dict]:
        begins = line[:5] == b"WARC/" and _START.match(line)
        if self.heading is not None and (begins or (line != b"\r" and not _FIELD.match(line))):
            self.heading = None  # not a header after all
            self._trim()
        if begins:
            if not self.open:
                self.held, self.base = bytearray(), self.at
            self.heading = self.at
        if self.leading or self.whole_leads:
            self.lead += line + b"\n"
        if self.open or self.heading is not None:
            self.held += line + b"\n"
        self.at += len(line) + 1
        if self.heading is not None and line == b"\r":
            start, self.heading = self.heading, None
            if found := parsed(bytes(self.held[start - self.base :])):
                header, head, length = found
                heapq.heappush(self.open, (start + head + length, start, head, header))
                if self.leading and not self.whole_leads:
                    del self.lead[start:]
                self.leading = False
            self._trim()
        while self.open and self.open[0][0] <= self.at:
            end, start, head, header = heapq.heappop(self.open)
            yield self.row("record", start, header, bytes(self.held[start + head - self.base : end - self.base]), end + 4 - start)
            self._trim()

    def _trim(self) -> None:
        starts = [x[1] for x in self.open] + ([self.heading] if self.heading is not None else [])
        keep = min(starts, default=self.base + len(self.held))
        if keep - self.base > len(self.held) // 2:
            del self.held[: keep - self.base]
            self.base = keep

    def ended(self) -> Iterator[dict]:
        starts = [x[1] for x in self.open] + ([self.heading] if self.heading is not None else [])
        for start in starts:
            yield self.row("part", start, data=bytes(self.held[start - self.base :]))
        yield self.row("split", self.at, data=bytes(self.lead), whole=self.leading or self.whole_leads)


_SCHEMA = "path string, block long, size long, kind string, at long, header string, length long, data binary, whole boolean"
_ARROW = pa.schema([("path", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("kind", pa.string()), ("at", pa.int64()),
                    ("header", pa.string()), ("length", pa.int64()), ("data", pa.binary()), ("whole", pa.bool_())])


def _scanned(spark: SparkSession, path: str, whole_leads: bool) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))

    def scan(batches):
        now, rows, held = None, [], 0
        for batch in batches:
            paths, blocks, sizes, values = (batch.column(i) for i in range(4))
            for i, (block, size) in enumerate(zip(blocks.to_pylist(), sizes.to_pylist(), strict=True)):
                if now is None or block != now.block or (i == 0 or paths[i] != paths[i - 1]) and paths[i].as_py() != now.path:
                    if now:
                        rows += now.ended()
                    now = _Split(paths[i].as_py(), block, size, whole_leads)
                for row in now.line(values[i].as_py()):
                    rows.append(row)
                    held += len(row["data"])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, held = [], 0
        if now:
            rows += now.ended()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return lines.mapInArrow(scan, _SCHEMA)


def _completed(parts: DataFrame) -> DataFrame:
    """Records from the bytes of candidates that left their split: ``short`` if some lack.
    (It is null for records within a split.)"""

    def complete(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if found := parsed(r["data"]):
                    header, head, length = found
                    payload = r["data"][head : head + length]
                    rows.append({"path": r["path"], "size": r["size"], "offset": r["offset"], "header": header.decode("utf-8", "replace"),
                                 "length": head + length + 4, "payload": payload, "short": len(payload) < length})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("path", pa.string()), ("size", pa.int64()), ("offset", pa.int64()), ("header", pa.string()), ("length", pa.int64()), ("payload", pa.binary()), ("short", pa.bool_())])
    return parts.select("path", "size", "offset", "data").mapInArrow(complete, "path string, size long, offset long, header string, length long, payload binary, short boolean")


def reachable(links: DataFrame) -> DataFrame:
    """``path, offset`` of the rows of ``links`` (``path, offset, next``) that pointers reach
    from offset 0 of their file. Each round doubles every pointer's reach, so there are as
    many rounds as the longest chain's length has binary digits."""
    now = stage(links.select("path", "offset", F.col("next").alias("to"), (F.col("offset") == 0).alias("hit")), "jumps")
    while not now.filter("to is not null").isEmpty():
        there = now.select("path", F.col("offset").alias("to"), F.col("to").alias("further"))
        hits = now.filter("hit and to is not null").select("path", F.col("to").alias("offset"), F.lit(True).alias("new")).distinct()
        moved = now.join(there, ["path", "to"], "left").join(hits, ["path", "offset"], "left")
        now = stage(moved.select("path", "offset", F.col("further").alias("to"), (F.col("hit") | F.coalesce("new", F.lit(False))).alias("hit")), "jumps")
    return now.filter("hit").select("path", "offset")


def read_archives(spark: SparkSession, path: str, *derived: Column, payload: bool = True, _ends: DataFrame | None = None) -> DataFrame:
    """``path, offset, header, payload`` of the true records under ``path``, and columns
    ``derived`` from these. Without ``payload`` that column is dropped early and not shuffled.

    Records whose payload the file does not hold to its end are left out, and so is all that
    follows the first break of a file's chain. A folder without records gives no rows.
    """
    whole_leads = _ends is not None
    scanned = stage(_scanned(spark, path, whole_leads).withColumnRenamed("at", "offset").filter("kind <> 'record'"), "parts")
    splits = scanned.filter("kind = 'split'")
    order = "partition by path order by block"
    splits = stage(splits.selectExpr(
        "path", "block", "data as lead", "offset as bytes", f"row_number() over ({order}) as place",
        f"coalesce(sum(offset) over ({order} rows between unbounded preceding and 1 preceding), 0) as base",
        f"min(if(whole, null, struct(block, 1))) over ({order} rows between 1 following and unbounded following).block as stop_block",
        "max(block) over (partition by path) as last_block"), "splits")
    base = splits.select("path", "block", "base", "place")
    stops = splits.select("path", F.col("block").alias("stop_block"), F.col("place").alias("stop"))
    parts = scanned.filter("kind = 'part'").select("path", "block", "size", "offset", "data")
    parts = parts.join(splits.select("path", "block", "base", "place", F.coalesce("stop_block", "last_block").alias("stop_block")), ["path", "block"]).join(stops, ["path", "stop_block"])
    needs = parts.withColumn("offset", F.col("base") + F.col("offset"))
    if whole_leads:  # up to the split that holds the record's last byte
        spans = _ends.join(splits, "path").filter("base < end and base + bytes >= end").select("path", "offset", F.col("place").alias("enough"))
        needs = needs.join(spans, ["path", "offset"], "left").withColumn("stop", F.coalesce("enough", "place"))
    wanted = needs.filter("stop > place").select("path", "offset", F.explode(F.sequence(F.col("place") + 1, F.col("stop"))).alias("place"))
    leads = wanted.join(splits.select("path", "place", "lead"), ["path", "place"])
    leads = leads.groupBy("path", "offset").agg(F.sort_array(F.collect_list(F.struct("place", "lead"))).alias("l"))
    joined = F.aggregate("l", F.lit(b""), lambda a, x: F.concat(a, x["lead"]))
    whole = needs.join(leads, ["path", "offset"], "left").select("path", "size", "offset", F.concat("data", F.coalesce(joined, F.lit(b""))).alias("data"))

    inside = _scanned(spark, path, whole_leads).filter("kind = 'record'").select("path", "block", "size", "at", "header", "length", F.col("data").alias("payload"))
    columns = [*derived, *([F.col("payload")] if payload else [])]
    inside = inside.select("path", "block", "size", "at", "header", "length", *columns)
    inside = inside.join(base, ["path", "block"]).withColumn("offset", F.col("base") + F.col("at")).withColumn("short", F.lit(None).cast("boolean"))
    across = _completed(whole).select("path", "size", "offset", "header", "length", *columns, "short")
    every = stage(inside.select(*across.columns).unionByName(across).withColumn("next", F.col("offset") + F.col("length")), "candidates")
    true = reachable(every.select("path", "offset", "next"))
    records = every.join(true, ["path", "offset"]).filter("next <= size")
    if not whole_leads and not records.filter("short").isEmpty():
        # a payload that crosses splits holds a record itself: take whole splits as leads
        ends = records.filter("short is not null").select("path", "offset", (F.col("next") - 4).alias("end"))
        return read_archives(spark, path, *derived, payload=payload, _ends=stage(ends, "ends"))
    return records.filter("short is null or not short").drop("size", "length", "short", "next")


def field(name: str) -> Column:
    """A header field's value; null without it."""
    found = F.regexp_extract("header", rf"(?im)^{name}[ \t]*:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)
    return F.when(found != "", found)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` of each record. A response's
    length and digest are those of the payload that was read."""
    spark = pages.sparkSession
    path = f"{staging_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    read = read_archives(
        spark, path, F.octet_length("payload").cast("long").alias("got_bytes"), base32_sha1(F.col("payload")).alias("got_digest"), payload=False)
    number = r"^<urn:x-page:(-?[0-9]+)>$"
    kind = field("WARC-Type")
    return read.select(
        F.regexp_extract(field("WARC-Record-ID"), number, 1).try_cast("long").alias("page_id"),
        F.when(kind == "revisit", field("X-Payload-Length").cast("long")).otherwise(F.col("got_bytes")).alias("payload_bytes"),
        F.when(kind == "revisit", F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "")).otherwise(F.col("got_digest")).alias("payload_digest"),
        kind.alias("record_type"),
        F.regexp_extract(field("WARC-Refers-To"), number, 1).try_cast("long").alias("refers_to"),
    )
