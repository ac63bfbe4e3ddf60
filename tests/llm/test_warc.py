import base64
import gzip
import hashlib
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stayline.llm import warc as W
from stayline.llm.staging import stage_path

SCHEMA = "page_id long, url string, html string"


def rows_of(n=60):
    rows = []
    for i in range(n):
        body = f"<p>é{i % 7}\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n</p>" * (1 + (i % 11) * 9)
        rows.append((i, f"http://x/{i}", body if i % 13 else body + str(i)))
    return rows + [(100, "http://x/", None), (101, None, ""), (102, "http://x/\r\ny", "z"), (None, "u", "no id"),
                   (103, "a", "twice " * 300), (103, "a", "twice " * 300), (104, "b", "q"), (104, "c", "q")]


def expected(rows, least):
    by = defaultdict(list)
    for i, (p, u, h) in enumerate(rows):
        by[h or ""].append((p if p is not None else -1, i))
    out = []
    for h, members in by.items():
        b = h.encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        top = max(p for p, _ in members)
        left = 1 if len(b) >= least else len(members)
        for p, _ in sorted(members, reverse=True):
            out.append((p, len(b), d, "response" if left > 0 else "revisit", None if left > 0 else top))
            left -= 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment,least", [(16_384, 0), (100, 0), (1000, 50)])
def test_round_trip(spark, segment, least):
    rows = rows_of()
    got = W.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3), segment, least).collect()
    assert all(r.error is None for r in got)
    got = sorted(((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in got), key=repr)
    assert got == expected(rows, least)


def test_payloads_come_back_and_broken_chains_are_told(spark):
    path = stage_path(spark, "warc-test")
    W.write_archives(spark.createDataFrame(rows_of(20), SCHEMA).coalesce(1), path, 300)
    want = {str(p): (h or "").encode() for p, _, h in rows_of(20)}
    for r in W.read_archives(spark, path).where("kind = 'response'").collect():
        assert r.error is None and r.said == f"sha1:{r.digest}"
        assert r.page_id is None or bytes(r.payload) == want[r.page_id]
    # drop one continuation, truncate another chain
    os.makedirs(local := path.removeprefix("file:") + "-broken")
    src = path.removeprefix("file:")
    data = b"".join(gzip.decompress(open(f"{src}/{f}", "rb").read()) for f in os.listdir(src) if f.endswith(".gz"))
    records = [W.record([(k, v) for k, v in f.items() if k != "content-length"], b) for f, b in W.parse(data)]
    chains = defaultdict(list)
    for i, (f, _) in enumerate(W.parse(data)):
        if "warc-segment-origin-id" in f:
            chains[f["warc-segment-origin-id"]].append(i)
    long = [c for c in chains.values() if len(c) >= 3]
    gone = {long[0][0], long[1][-1]}
    with gzip.open(f"{local}/x.gz", "wb") as f:
        f.write(b"".join(r + b"\r\n\r\n" for i, r in enumerate(records) if i not in gone))
    bad = W.read_archives(spark, local).where("error is not null").collect()
    assert sorted(r.error for r in bad) == ["last segment missing", "segment missing or repeated"]
    assert all(r.payload is None for r in bad)


def test_chunked_framing():
    assert W.dechunk(b"3\r\nabc\r\n2;x=y\r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    assert W.dechunk(W.chunked(b"x" * 1000, 7)) == b"x" * 1000 and W.dechunk(W.chunked(b"", 7)) == b""
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b""):
        with pytest.raises(ValueError):
            W.dechunk(broken)


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], SCHEMA).withColumn("extra", F.lit(1))).count() == 0
