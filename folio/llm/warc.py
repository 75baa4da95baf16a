"""WARC archives through a chunked record table.

Writing is a native plan: the payload of a record is cut into segments, each a row of (record identifier,
chunk number), and each row becomes one WARC record (a response or revisit first, then continuation records).
Spark's text writer with the record end as line separator writes them as .warc.gz files, so any file system
that Spark knows will do and lost executors are covered by its commit protocol.

Reading streams an archive as pieces in file order through a parser that never holds more than one piece: it
yields rows of (record identifier, chunk number) with the digest and the byte count so far; the row marked
`last` carries those of the full payload.

Defined results: a null payload is empty; records whose identifier equals the smallest of their group of equal
payloads are responses (so repeated rows are all responses), the others revisits; null identifiers rank last and
read back as null; payloads under min_bytes are always responses; an empty table gives empty archives; control
characters and spaces in a target URI are percent-encoded; columns of the input with other names are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import common

END = "\r\n\r\n"
SALTS = 64
# The digits of base 32 as conv() writes them and as RFC 4648 does.
CONV32, RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CHUNKS = (
    "record_id string, chunk_no long, record_type string, refers_to string, target_uri string, n_bytes long, digest string, "
    "declared_bytes long, declared_digest string, last boolean"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary column in base 32: 40 bits at a time."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV32, RFC32)


def with_roles(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """records (record_key long, target_uri, payload binary) with payload_bytes, payload_digest, record_type and refers_to.

    The smallest key of each group of equal payloads is found by two levels of minima, over (payload, salt) and
    then over the salts, and joined back by (payload, salt): a payload of a third of all rows is spread over SALTS keys.
    """
    r = records.select("record_key", "target_uri", F.coalesce("payload", F.lit(b"")).alias("payload")).withColumns(
        {"__same": F.sha2("payload", 256), "__salt": F.pmod(F.hash("record_key"), F.lit(SALTS))}
    )
    by_salt = r.groupBy("__same", "__salt").agg(F.min("record_key").alias("__first"))
    first = by_salt.withColumn("__first", F.min("__first").over(Window.partitionBy("__same")))
    role = F.when(F.length("payload") < min_bytes, "response").when(F.col("record_key").eqNullSafe(F.col("__first")), "response").otherwise("revisit")
    return (
        r.join(first, ["__same", "__salt"])
        .withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload")), "record_type": role})
        .withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("__first")))
        .drop("__same", "__salt", "__first")
    )


def archive_rows(roles: DataFrame, segment_bytes: int = 1 << 20, date: str = "2024-01-01T00:00:00Z", name: str = "urn:page:") -> DataFrame:
    """One column `value`: the text of one WARC record in each row, without its end. The segments of a payload follow each other."""
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    is_response = F.col("record_type") == "response"
    step = F.lit(segment_bytes)
    cuts = F.when(is_response, F.greatest(F.ceil(F.col("payload_bytes") / step), F.lit(1))).otherwise(1).cast("int")
    rid = text(name, F.coalesce(F.col("record_key").cast("string"), F.lit("")))
    safe = F.regexp_replace(F.coalesce("target_uri", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    r = roles.withColumns({"__n": cuts, "__id": rid, "__uri": safe})
    # The array of segments is made first so that the exploded rows hold a segment each, not the payload.
    pieces = F.when(
        is_response, F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda i: F.substr(F.col("payload"), (i * step + 1).cast("int"), step))
    ).otherwise(F.array(F.lit(b"")))
    r = r.select("__n", "__id", "__uri", "record_type", "refers_to", "payload_bytes", "payload_digest", F.posexplode(pieces).alias("__i", "__piece"))
    http = F.when(F.col("__i") == 0, text("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.col("payload_bytes").cast("string"), END)).otherwise("")
    r = r.withColumn("__block", F.concat(http.cast("binary"), F.col("__piece")))
    first = text(
        "WARC-Type: ", F.col("record_type"), "\r\nWARC-Record-ID: <", F.col("__id"), ">\r\nContent-Type: application/http; msgtype=response",
        "\r\nWARC-Payload-Digest: sha1:", F.col("payload_digest"),
        F.when(F.col("record_type") == "revisit", text("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <", name, F.coalesce(F.col("refers_to").cast("string"), F.lit("")), ">")).otherwise(""),
        F.when(F.col("__n") > 1, "\r\nWARC-Segment-Number: 1").otherwise(""),
    )
    later = text(
        "WARC-Type: continuation\r\nWARC-Record-ID: <", F.col("__id"), "#", (F.col("__i") + 1).cast("string"), ">\r\nWARC-Segment-Origin-ID: <", F.col("__id"),
        ">\r\nWARC-Segment-Number: ", (F.col("__i") + 1).cast("string"),
        F.when(F.col("__i") + 1 == F.col("__n"), text("\r\nWARC-Segment-Total-Length: ", F.col("payload_bytes").cast("string"))).otherwise(""),
    )
    head = text(
        "WARC/1.1\r\n", F.when(F.col("__i") == 0, first).otherwise(later), "\r\nWARC-Target-URI: ", F.col("__uri"), "\r\nWARC-Date: ", date,
        "\r\nWARC-Block-Digest: sha1:", base32_sha1(F.col("__block")), "\r\nContent-Length: ", F.length("__block").cast("string"), END,
    )
    return r.select(F.concat(head.cast("binary"), F.col("__block")).cast("string").alias("value"))


def write(rows: DataFrame, to: str) -> str:
    """Write archive_rows() as .warc.gz files in the folder `to`: one for each task, so that the segments of a payload stay in one file."""
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 0).text(to)
    return to


class Parser:
    """Takes an archive in pieces and gives its payload chunks; holds a header or one piece at a time."""

    def __init__(self, chunk_bytes: int = 1 << 20):
        self.most, self.buf, self.left, self.skip, self.open, self.now = chunk_bytes, b"", 0, 0, None, None

    def feed(self, data: bytes) -> Iterator[dict]:
        self.buf = self.buf + data if self.buf else data
        while self.buf:
            if self.skip:
                cut = min(self.skip, len(self.buf))
                self.buf, self.skip = self.buf[cut:], self.skip - cut
            elif self.now is None:
                head, found, rest = self.buf.partition(b"\r\n\r\n")
                if not found:
                    return
                self.buf = rest
                self._begin(head)
                if not self.left:
                    yield from self._take(b"")
            elif self.now["http"] and not self.now["in_payload"]:
                head, found, rest = self.buf[: self.left].partition(b"\r\n\r\n")
                if not found and len(self.buf) < self.left:
                    return
                if found:
                    self.left -= len(head) + 4
                    self.buf = self.buf[len(head) + 4 :]
                    self.now["declared_bytes"] = next((int(x[15:]) for x in head.split(b"\r\n") if x[:15].lower() == b"content-length:"), None)
                self.now["in_payload"] = True
                if not self.left:
                    yield from self._take(b"")
            else:
                cut = min(self.left, len(self.buf), self.most)
                piece, self.buf = self.buf[:cut], self.buf[cut:]
                self.left -= cut
                yield from self._take(piece)

    def _begin(self, head: bytes) -> None:
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record here: {lines[0][:60]!r}")
        f = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        self.left = int(f["content-length"])
        plain = lambda k: f[k].strip("<>") if k in f else None
        http = f.get("content-type", "").startswith("application/http")
        if f.get("warc-type") == "continuation" and self.open and self.open["record_id"] == plain("warc-segment-origin-id"):
            self.now = self.open
            self.now |= {"more": "warc-segment-total-length" not in f}
        else:
            self.now = {
                "record_id": plain("warc-record-id"), "record_type": f.get("warc-type"), "refers_to": plain("warc-refers-to"), "target_uri": f.get("warc-target-uri"),
                "declared_digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None, "declared_bytes": None, "http": http,
                "in_payload": not http, "more": "warc-segment-number" in f, "sha1": hashlib.sha1(usedforsecurity=False), "n_bytes": 0, "chunk_no": 0,
            }

    def _take(self, piece: bytes) -> Iterator[dict]:
        now = self.now
        now["sha1"].update(piece)
        now["n_bytes"] += len(piece)
        ended = not self.left
        last = ended and not now["more"]
        yield now | {"digest": base64.b32encode(now["sha1"].digest()).decode(), "last": last, "data": piece}
        now["chunk_no"] += 1
        if ended:
            self.open, self.now, self.skip = (None if last else now), None, 4


def read(spark: SparkSession, path: str, data: bool = False) -> DataFrame:
    """The chunked record table (CHUNKS; with data also the bytes of each chunk) of the archives in a folder.

    Compressed archives are not split, so a task gets the pieces of a file in order. A piece ends at each
    record end, hence is no longer than a segment as long as archives are written in segments.
    """
    names = [x.split()[0] for x in CHUNKS.split(", ")] + ["data"] * data
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = CHUNKS + ", data binary" * data
    fields = [pa.field(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")]
    lines = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("v"), F.col("_metadata.file_path").alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parser, rows, held = None, None, [], 0
        for batch in batches:
            for v, f in zip(batch.column(0), batch.column(1).to_pylist()):
                if f != at:
                    at, parser = f, Parser()
                for x in parser.feed(v.as_py() + b"\r\n\r\n"):
                    rows.append({k: x[k] for k in names})
                    held += len(x["data"]) if data else 0
                    if len(rows) >= 10_000 or held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    return lines.mapInArrow(common.lean(run), schema)


def round_trip(records: DataFrame, min_bytes: int = 0, segment_bytes: int = 1 << 20) -> DataFrame:
    """Write records (record_key long, target_uri, payload) as archives in the shared folder; the last chunk row of each record read back."""
    spark = records.sparkSession
    to = write(archive_rows(with_roles(records, min_bytes), segment_bytes), f"{common.shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read(spark, to).where("last")


def digest_query(pages: DataFrame, min_bytes: int = 0, segment_bytes: int = 1 << 20) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of pages (page_id, url, html) after a round trip,
    and whether the bytes read agree with the digest that was written.

    The contents of a revisit are those read from the response of the identifier and digest it names (null if there is none): each of these with
    a salt meets the response once, and revisits meet that by all three, so a response of a third of all rows is spread."""
    key = lambda c: F.when(F.length(c) > len("urn:page:"), F.substring(c, len("urn:page:") + 1, 40)).cast("long")
    records = pages.select(F.col("page_id").alias("record_key"), F.col("url").alias("target_uri"), F.col("html").cast("binary").alias("payload"))
    back = common.materialize(round_trip(records, min_bytes, segment_bytes).drop("target_uri", "chunk_no", "last"), "warc-read")
    response = back.where("record_type <> 'revisit'").select(
        key(F.col("record_id")).alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"), F.col("digest").eqNullSafe(F.col("declared_digest")).alias("intact"),
    )
    again = back.where("record_type = 'revisit'").withColumn("__salt", F.pmod(F.hash("record_id"), F.lit(SALTS)))
    named = ["refers_to", "declared_digest"]
    once = back.where("record_type <> 'revisit'").groupBy(F.col("record_id").alias(named[0]), F.col("digest").alias(named[1])).agg(F.min("n_bytes").alias("payload_bytes"))
    met = again.select(*named, "__salt").distinct().join(once, named)
    revisit = again.join(met, [*named, "__salt"], "left").select(
        key(F.col("record_id")).alias("page_id"), "payload_bytes", F.when(F.col("payload_bytes").isNotNull(), F.col("declared_digest")).alias("payload_digest"), "record_type",
        key(F.col("refers_to")).alias("refers_to"), F.col("payload_bytes").isNotNull().alias("intact"),
    )
    return response.unionByName(revisit)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, h,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '') AS digest,
  min(page_id) OVER (PARTITION BY b) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to, true AS intact FROM d
"""
