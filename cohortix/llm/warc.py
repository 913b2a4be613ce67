"""Web archives: pages to WARC records, and records assembled to one nested row per capture.

Every page is a transaction of three records: its request, its response (or a revisit of an
equal payload stored before), and metadata. Request and metadata name the response in
``WARC-Concurrent-To``. The archives are gzip files written by Spark's text writer, a record
per row, so they lie in any store Spark reaches and a lost executor leaves nothing half done.

Reading streams the lines of an archive through a parser that counts content bytes, so no
archive and no line structure of a payload is held or trusted. Records of a transaction may
lie in different archives and in any order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import fresh, ready
from cohortix.session import written

HEAVY = 2_000  # at most so many keys hold a row in HEAVY each
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
          "content_type string, payload_digest string, payload_bytes long, head string, payload binary, fields binary, intact boolean")
_record = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("head", pa.string()), ("payload", pa.binary()), ("fields", pa.binary()), ("intact", pa.bool_())])
BATCH_BYTES = 8 << 20
HUBS = ("response", "revisit", "resource")


def base32_sha1(c: Column) -> Column:
    """SHA-1 in upper-case base32, five hexadecimal digits to four letters."""
    parts = [F.lpad(F.conv(F.substring(F.sha1(c), 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    # conv writes 0-9A-V, base32 A-Z2-7
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def joined_by_heavy(left: DataFrame, right: DataFrame, key: str, value: str, spread: str, counts: DataFrame) -> DataFrame:
    """Left join of ``value`` on ``key`` (unique on the right) when one key may hold a third of the left rows.

    ``counts`` has ``key, n``. Keys that hold more than one row in ``HEAVY`` are at most
    ``HEAVY`` by count, so what they get is broadcast, and in the shuffle of the others their
    rows lie by ``spread``, a string column.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = F.broadcast(counts.where(F.col("n") * HEAVY > total).select(key))
    lies, early = fresh(left, "lies"), fresh(left, "early")
    few = right.join(heavy, key, "left_semi").select(key, F.col(value).alias(early))
    marked = left.join(F.broadcast(few), key, "left").withColumn(
        lies, F.when(F.col(early).isNull(), F.col(key)).otherwise(F.concat(F.lit("\n"), F.col(spread))))
    rest = right.select(F.col(key).alias(lies), value)
    return marked.join(rest, lies, "left").withColumn(value, F.coalesce(value, early)).drop(lies, early)


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least_bytes: int = 0, date: str = DATE) -> None:
    """Write request, response or revisit, and metadata of every row as gzip archives below ``path``.

    Missing payload is empty. Of rows with equal payloads (by SHA-256) of at least
    ``least_bytes`` bytes the one with the smallest id is the response and the others revisit
    it; missing ids come last, and among rows of the smallest id the first read is taken.
    Shorter payloads are all responses. Repeated rows are captures of their own. The id and the
    exact url lie in the metadata record; in ``WARC-Target-URI`` control characters and
    spaces of the url are percent-encoded, and a missing url leaves it out. ``pages`` must read
    the same twice, as a table does. An empty table writes no record. Other columns are ignored.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.monotonically_increasing_id().alias("row"))
    size = F.octet_length("payload").cast("long")
    rows = rows.withColumns({"same": F.when(size >= least_bytes, F.sha2("payload", 256)), "size": size,
                             "place": F.col("row").cast("string")})
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row"))
    groups = written(rows.where("same is not null").groupBy("same").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1"), "same")
    linked = joined_by_heavy(rows, groups, "same", "first", "place", groups)
    again = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))

    def urn(row: Column, what: str) -> Column:
        h = F.sha1(F.concat_ws("|", F.lit(what), row.cast("string"), F.coalesce("same", F.lit("")), F.lit(path)))
        cut = [F.substring(h, a, b) for a, b in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-8"), cut[3], F.lit("-"), cut[4], F.lit(">"))

    codes = [*range(33), 127]
    uri = F.col("url")
    for code in codes:
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    row = F.col("row")
    named = linked.withColumns({
        "hub": urn(row, "response"), "again": again, "uri": F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")),
        "digest": base32_sha1(F.col("payload")),
        "about": F.to_json(F.struct("page_id", "url"), {"ignoreNullFields": "false"})})
    host = F.coalesce(F.regexp_extract("uri", r"//([^/?#\r]+)", 1), F.lit(""))

    def record(kind: Column, record_id: Column, more: Column, content_type: str, block: Column, length: Column) -> Column:
        # written as bytes: the payload need not be valid UTF-8
        head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id,
                        F.lit(f"\r\nWARC-Date: {date}\r\n"), F.coalesce("uri", F.lit("")), more,
                        F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))
        return F.concat(head.cast("binary"), block)

    beside = F.concat(F.lit("WARC-Concurrent-To: "), F.col("hub"), F.lit("\r\n"))
    asked = F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_extract("uri", r"//[^/?#\r]+([^\r]*)", 1), F.lit("")), F.lit("/")),
                     F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")).cast("binary")
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                      F.col("size").cast("string"), F.lit("\r\n\r\n")).cast("binary")
    block = F.when(F.col("again"), answer).otherwise(F.concat(answer, F.col("payload")))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"))
    first_urn = urn(F.col("first.row"), "response")
    revisits = F.concat(F.lit(f"WARC-Profile: {REVISIT}\r\nWARC-Refers-To: "), first_urn, F.lit("\r\n"))
    about = F.col("about").cast("binary")
    records = F.array(
        record(F.lit("request"), urn(row, "request"), beside, "application/http; msgtype=request", asked, F.octet_length(asked)),
        record(F.when(F.col("again"), "revisit").otherwise("response"), F.col("hub"),
               F.concat(digest, F.when(F.col("again"), revisits).otherwise("")),
               "application/http; msgtype=response", block, F.octet_length(block)),
        record(F.lit("metadata"), urn(row, "metadata"), beside, "application/json", about, F.octet_length(about)))
    (named.select(F.explode(records).alias("record")).select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


class _Parser:
    """Records out of the lines of one archive; only what of a record has come is held."""

    def __init__(self, payloads: bool):
        self.payloads = payloads
        self.head: list[bytes] | None = None
        self.body: list[bytes] = []
        self.left = 0

    def line(self, line: bytes) -> dict | None:
        if self.head is None:
            if line.startswith(b"WARC/"):
                self.head = []
            elif line.strip():
                raise ValueError(f"not the beginning of a WARC record: {line[:80]!r}")
            return None
        if self.left == 0 and not self.body:
            if line.rstrip(b"\r"):
                self.head.append(line.rstrip(b"\r"))
                return None
            self.fields = self._fields(self.head)
            self.left = int(self.fields.get("content-length", ["0"])[0])
            return self._done() if self.left == 0 else None
        self.body.append(line)
        self.left -= len(line) + 1
        # the line end that Spark has taken may be the first byte after the content
        return self._done() if self.left <= 0 else None

    def close(self) -> dict | None:
        if self.head is None:
            return None
        if self.left != 0 or not self.body:
            raise ValueError("an archive ends within a record")
        return self._done()

    @staticmethod
    def _fields(lines: list[bytes]) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        name = None
        for line in lines:
            text = line.decode("utf-8", "replace")
            if text[:1] in " \t" and name:  # a folded line
                out[name][-1] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            out.setdefault(name, []).append(value.strip())
        return out

    def _done(self) -> dict:
        f, size = self.fields, int(self.fields.get("content-length", ["0"])[0])
        block = b"\n".join(self.body)
        if self.left == 0 and len(block) == size - 1:
            block += b"\n"
        block, rest = block[:size], block[size:]
        if rest.strip():
            raise ValueError("a record is longer than its Content-Length")
        self.head, self.body, self.left = None, [], 0
        one = {k: v[0] for k, v in f.items()}
        kind, content = one.get("warc-type"), one.get("content-type", "")
        head, payload = None, block
        if content.startswith("application/http"):
            top, gap, payload = block.partition(b"\r\n\r\n")
            head = top.decode("utf-8", "replace")
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        said = one.get("warc-payload-digest", "")
        said = said.removeprefix("sha1:") if said.startswith("sha1:") else ""
        return {
            "record_id": one.get("warc-record-id"), "type": kind, "concurrent_to": f.get("warc-concurrent-to", []),
            "refers_to": one.get("warc-refers-to"), "target_uri": one.get("warc-target-uri"), "date": one.get("warc-date"),
            "content_type": content, "payload_digest": said if kind == "revisit" else own,
            "payload_bytes": None if kind == "revisit" else len(payload), "head": head,
            "payload": payload if self.payloads and kind in ("response", "resource") else None,
            "fields": block if kind == "metadata" else None,
            "intact": None if kind == "revisit" or not said else said == own}


def read_records(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """The records of the gzip archives below ``path``, one row each, in ``RECORD``'s columns.

    Archives may be compressed whole or per record. ``payload`` holds the entity of responses
    (with ``payloads``), ``fields`` the block of metadata records, ``head`` the HTTP header.
    ``payload_digest`` is counted from the payload, but for revisits it is the stated one;
    ``intact`` tells whether both agree, where both exist. A truncated archive, or one with
    anything between records, fails the job. Plain archives are refused: Spark would cut them
    within records.
    """
    ready(spark)
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path).select(
        F.col("value").cast("binary").alias("line"), F.xxhash64("_metadata.file_path").alias("file"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, out, held = _Parser(payloads), None, [], 0
        for batch in batches:
            files = batch.column(1).to_pylist()
            for line, now in zip(batch.column(0).to_pylist(), files):
                if now != file:
                    if record := parser.close():
                        out.append(record)
                    file = now
                if record := parser.line(line):
                    out.append(record)
                    held += len(record["payload"] or b"") + 500
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, _record)
                        out, held = [], 0
        if record := parser.close():
            out.append(record)
        if out:
            yield pa.RecordBatch.from_pylist(out, _record)

    return lines.mapInArrow(records, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture, response, requests, metadata``.

    A response, revisit or resource record is a capture; requests and metadata join it through
    concurrent-to identifiers, whichever side names the other, directly or through one record
    between (metadata beside a request). Members whose capture is not in the archives are
    rows without a response, together with those that name the same identifier. Records
    of other types (warcinfo, conversion, ...) and records without an id take no part.
    """
    records = written(records, "records")
    hub = F.col("type").isin(*HUBS)
    known = records.where(F.col("record_id").isNotNull())
    hubs = known.where(hub).select(F.col("record_id").alias("capture"), F.struct(
        "record_id", "type", "refers_to", "target_uri", "date", "content_type", "head", "payload_digest", "payload_bytes",
        "payload", "intact").alias("response"))
    members = known.where(F.col("type").isin("request", "metadata"))
    names = known.where(hub).select(F.col("record_id").alias("capture"))
    said = members.select("record_id", F.explode_outer("concurrent_to").alias("other"))
    # both directions of the identifiers; a member with a hub beside it is placed
    direct = said.join(names, said.other == names.capture).select("record_id", "capture").union(
        known.where(hub).select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture")))
    direct = direct.groupBy("record_id").agg(F.min("capture").alias("capture"))
    between = direct.select(F.col("record_id").alias("other"), F.col("capture").alias("through"))
    through = said.join(between, "other", "left").groupBy("record_id").agg(
        F.min("through").alias("through"), F.min("other").alias("other"))
    places = through.join(direct, "record_id", "left").select(
        "record_id", F.coalesce("capture", "through", "other", "record_id").alias("capture"))
    placed = members.join(places, "record_id")

    def listed(kind: str, *columns: str) -> DataFrame:
        return placed.where(F.col("type") == kind).groupBy("capture").agg(
            F.sort_array(F.collect_list(F.struct("record_id", *columns))).alias("of"))

    requests = listed("request", "target_uri", "date", "head").withColumnRenamed("of", "requests")
    metadata = listed("metadata", "date", "content_type", "fields").withColumnRenamed("of", "metadata")
    return hubs.join(requests, "capture", "full").join(metadata, "capture", "full").select("capture", "response", "requests", "metadata")


def resolved(found: DataFrame) -> DataFrame:
    """Give each capture ``original``: of a revisit the capture it refers to (without payload).

    ``original`` is null for other captures and where that record is not in the archives.
    """
    found = written(found, "captures")
    firsts = found.where("response.type <> 'revisit'").select(
        F.col("capture").alias("refers"), F.struct("capture", F.col("response.payload_bytes").alias("payload_bytes"), "metadata").alias("original"))
    named = found.withColumn("refers", F.col("response.refers_to"))
    counts = written(named.where("refers is not null").groupBy("refers").agg(F.count("*").alias("n")), "refers")
    return joined_by_heavy(named, firsts, "refers", "original", "capture", counts).drop("refers")
