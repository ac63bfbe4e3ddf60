"""WARC archives: writing with segmented records, and reassembly.

Writing. A page's HTTP response block carries its payload in chunked transfer
framing. Blocks over ``segment`` bytes are cut: the first piece is the
``response`` record (segment 1), the others are ``continuation`` records that
name it as their origin, the last with the total length. Of equal payloads the
one with the largest page_id is stored, the others are ``revisit`` records.
Files come from Spark's text writer (gzip): a record is one value, the blank
lines that end it are the separator.

Reading. Archives are read as whole files of bounded size and cut into records
by Content-Length alone. Records of one origin are grouped, ordered by
segment number, checked for gaps and against the total length, joined, and the
HTTP block is split and its chunked framing decoded. An incomplete or broken
chain gives a row with an ``error`` and a null payload.

Defined results: a null page html is an empty payload; rows that repeat a
page_id are separate records, and of equal payloads with equal largest ids one
is the response; a null page_id is written without an id and sorts lowest.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage_path, staged

CRLF = b"\r\n"
SEGMENT = 16_384
CHUNK = 4096
FILE_RECORDS = 2000
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    out = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join(out) + b"0" + CRLF + CRLF


def dechunk(body: bytes) -> bytes:
    """Payload of a chunked body; extensions and trailers are skipped. Raises
    ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if n < 0 or at + n > len(body):
            raise ValueError("chunk beyond the body")
        if n == 0:
            return b"".join(out)
        out.append(body[at:at + n])
        at += n
        if body[at:at + 2] != CRLF:
            raise ValueError("chunk without end")
        at += 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def page_records(page_id, uid: str, url, payload: bytes, sha: str, refers_uid, segment: int):
    """Records of one page: a revisit, or a response and its continuations."""
    rid = f"<urn:uuid:{uid}>"
    base = [("WARC-Record-ID", rid), ("WARC-Date", DATE),
            ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")),
            ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{sha}"), ("X-Payload-Length", len(payload))]
    if refers_uid is not None:
        return [record([("WARC-Type", "revisit"), *base,
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", f"<urn:uuid:{refers_uid}>")], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + chunked(payload, CHUNK))
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    if len(parts) == 1:
        return [record([("WARC-Type", "response"), *base], block)]
    out = [record([("WARC-Type", "response"), *base, ("WARC-Segment-Number", 1)], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = hashlib.md5(f"{uid}/{n}".encode()).hexdigest()
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", DATE),
                           ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", n),
                           ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)], part))
    return out


def _write(segment: int):
    def run(batches):
        for pdf in batches:
            out = []
            for pid, uid, url, html, sha, to in zip(pdf["page_id"], pdf["uid"], pdf["url"], pdf["html"],
                                                    pdf["sha"], pdf["to_uid"]):
                payload = html.encode("utf-8", "surrogatepass") if isinstance(html, str) else b""
                out += page_records(pid, uid, url if isinstance(url, str) else None, payload, sha,
                                    to if isinstance(to, str) else None, segment)
                if sum(map(len, out[-64:])) > 1 << 22:
                    yield pd.DataFrame({"value": out})
                    out = []
            yield pd.DataFrame({"value": out})
    return run


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as gzip WARC files under ``path``."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    sha = F.sha1(html)
    row = ["sha", "n", "pid", "uk"]
    small = pages.select(F.col("page_id").alias("pid"), sha.alias("sha"), F.length(html).alias("n"),
                         F.xxhash64("url").alias("uk")).groupBy(*row).agg(F.count(F.lit(1)).alias("c"))
    # equal payloads: the largest page_id stays; one row per payload seen
    # twice. Written first, so that the planner knows its size: where few
    # payloads repeat, the pages themselves need not move
    keep = staged(small.groupBy("sha", "n").agg(F.max(F.struct("pid", "uk")).alias("top"), F.sum("c").alias("times"),
                                                F.max("c").alias("most"))
                  .where("times > 1").select(F.col("sha").alias("k_sha"), "top", "most"), "warc-repeated")
    uid = lambda *c: F.md5(F.concat_ws("/", *[x.cast("string") for x in c]))
    d = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("pid"), "url", "html",
                     sha.alias("sha"), F.length(html).alias("n"), F.xxhash64("url").alias("uk"))
    d = d.join(keep, F.col("sha") == F.col("k_sha"), "left")
    # rows that agree in everything get a serial number
    once = F.coalesce(F.col("most") == 1, F.lit(True))
    d = d.where(once).withColumn("serial", F.lit(1)).unionByName(
        d.where(~once).withColumn("serial", F.row_number().over(Window.partitionBy(*row).orderBy(F.lit(0)))))
    same = F.col("pid").eqNullSafe(F.col("top.pid")) & (F.col("uk") == F.col("top.uk")) & (F.col("serial") == 1)
    again = F.col("top").isNotNull() & (F.col("n") >= least_bytes) & ~same
    d = d.withColumn("to_uid", F.when(again, uid(F.col("top.pid"), F.col("sha"), F.col("top.uk"), F.lit(1))))
    d = d.withColumn("uid", uid(F.col("pid"), F.col("sha"), F.col("uk"), F.col("serial")))
    b32 = _base32(F.col("sha"))
    (d.select("page_id", "uid", "url", "html", b32.alias("sha"), "to_uid")
     .mapInPandas(_write(segment), "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _base32(sha_hex):
    """Upper-case base32 of a SHA-1 in hex: four letters per five digits."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for i in range(8):
        n = F.conv(F.substring(sha_hex, 5 * i + 1, 5), 16, 10).cast("int")
        for s in (15, 10, 5, 0):
            out.append(F.substring(letters, F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*out)


def parse(data: bytes):
    """Records of an archive: (fields by lower-case name, block)."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if head < 0:
            return
        lines = data[at:head].split(CRLF)
        fields = {}
        for line in lines[1:]:
            k, _, v = line.partition(b":")
            fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
        n = int(fields.get("content-length", 0))
        yield fields, data[head + 4:head + 4 + n]
        at = head + 4 + n + 4


def _read(batches):
    for pdf in batches:
        for path, data in zip(pdf["path"], pdf["content"]):
            data = zlib.decompress(data, 47) if data[:2] == b"\x1f\x8b" else bytes(data)
            out, held = [], 0
            for f, block in parse(data):
                rid = f.get("warc-record-id")
                out.append((f.get("warc-segment-origin-id", rid), int(f.get("warc-segment-number", 1)),
                            int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                            "warc-segment-number" in f, f.get("warc-type"), f.get("x-page-id"),
                            f.get("warc-refers-to"), f.get("warc-payload-digest"), f.get("x-payload-length"), block))
                held += len(block)
                if held > 1 << 22:
                    yield pd.DataFrame(out, columns=_COLS)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=_COLS)


_COLS = ["origin", "number", "total", "segmented", "kind", "page_id", "refers_to", "said", "said_bytes", "block"]
_SCHEMA = ("origin string, number int, total long, segmented boolean, kind string, page_id string, "
           "refers_to string, said string, said_bytes string, block binary")


def _decode(batches):
    for pdf in batches:
        out = []
        for kind, block, error in zip(pdf["kind"], pdf["block"], pdf["error"]):
            payload, why = None, error if isinstance(error, str) else None
            if kind == "response" and why is None:
                head, _, body = bytes(block).partition(b"\r\n\r\n")
                try:
                    payload = dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body
                except ValueError as e:
                    why = f"chunked framing: {e}"
            out.append((payload, why, digest(payload) if payload is not None else None,
                        len(payload) if payload is not None else None))
        part = pdf.drop(columns=["block", "error"])
        for i, c in enumerate(["payload", "error", "digest", "payload_bytes"]):
            part[c] = [x[i] for x in out]
        part["payload_bytes"] = part["payload_bytes"].astype(object).where(part["payload_bytes"].notna(), None)
        yield part


def read_archives(spark, path: str) -> DataFrame:
    """Logical records of the archives under ``path``: origin (record id),
    kind, page_id, refers_to, said (stated digest), said_bytes, payload,
    error, digest and payload_bytes (of the decoded payload)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    records = files.mapInPandas(_read, _SCHEMA)
    one = records.where("not segmented").select("origin", "kind", "page_id", "refers_to", "said", "said_bytes",
                                                F.lit(None).cast("string").alias("error"), "block")
    # a record's segments hold one page: grouped, ordered, checked, joined
    parts = (records.where("segmented").groupBy("origin")
             .agg(F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"),
                  *[F.max(c).alias(c) for c in ("page_id", "refers_to", "said", "said_bytes")],
                  F.min(F.when(F.col("number") == 1, F.col("kind"))).alias("kind")))
    block = F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), "")
    n = F.size("parts")
    whole = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.length(p["block"]))
    in_order = F.forall(F.sequence(F.lit(1), n), lambda i: F.element_at("parts", i)["number"] == i)
    error = (F.when(~in_order, "segment missing or repeated").when(F.col("total").isNull(), "last segment missing")
             .when(F.col("total") != whole, "total length differs"))
    joined = parts.select("origin", F.coalesce("kind", F.lit("continuation")).alias("kind"), "page_id", "refers_to",
                          "said", "said_bytes", error.alias("error"), F.unhex(block).alias("block"))
    return one.unionByName(joined).mapInPandas(
        _decode, "origin string, kind string, page_id string, refers_to string, said string, said_bytes string, "
                 "payload binary, error string, digest string, payload_bytes long")


def page_digests(read: DataFrame, id_type) -> DataFrame:
    """One row per page record: revisits take payload size and digest from
    the decoded response they refer to."""
    r = staged(read.drop("payload"), "warc-read")
    full = r.where("kind = 'response'").select(F.col("origin").alias("o"), F.col("page_id").alias("to_page"),
                                               F.col("digest").alias("d"), F.col("payload_bytes").alias("b"))
    got = r.where("kind in ('response', 'revisit')").join(full, F.col("refers_to") == F.col("o"), "left")
    return got.select(F.col("page_id").cast(id_type).alias("page_id"),
                      F.coalesce("payload_bytes", "b").alias("payload_bytes"),
                      F.coalesce("digest", "d").alias("payload_digest"), F.col("kind").alias("record_type"),
                      F.when(F.col("kind") == "revisit", F.col("to_page").cast(id_type)).alias("refers_to"),
                      "error")


def round_trip(pages: DataFrame, segment: int = SEGMENT, least_bytes: int = 0) -> DataFrame:
    """Archives written to the shared folder and read back, one row per page."""
    path = stage_path(pages.sparkSession, "warc")
    write_archives(pages, path, segment, least_bytes)
    return page_digests(read_archives(pages.sparkSession, path), pages.schema["page_id"].dataType)
