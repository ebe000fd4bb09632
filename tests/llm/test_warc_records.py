"""Rebuilt records are those that a reader of the format accepts; urls come back exactly."""

import hashlib

from pyspark.sql import functions as F

from ratecraft.llm import warc
from ratecraft.llm.common import scratch_path


def _parsed(record: bytes):
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    fields = dict(line.split(b": ", 1) for line in lines[1:])
    length = int(fields[b"Content-Length"])
    assert lines[0] == b"WARC/1.1" and rest[length:] == b"\r\n\r\n"
    return fields, rest[:length]


def test_every_record_parses_with_its_own_length(spark):
    texts = ["x" * 300, "é\r\n\r\nContent-Length: 7\r\n" * 30, "", "short", None]
    urls = ["http://a/%0D%0A", "http://a/\r\n", "http://a/\r\nWARC-Type: revisit\r\n", None, "http://b"]
    rows = [(10 * i + j, u, t) for i, t in enumerate(texts) for j, u in enumerate(urls)]
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    got = warc.original_record(warc.read_archive(spark, path)).withColumn("again", warc.payload_of(F.col("record"))).collect()
    want = {k: (u, (t or "").encode()) for k, u, t in rows}
    assert len(got) == len(rows) and sum(r.type == "revisit" for r in got) == 8
    for r in got:
        fields, payload = _parsed(bytes(r.record))
        assert payload == bytes(r.again) == want[r.key][1] and r.target == want[r.key][0]
        assert fields[b"WARC-Type"] == b"response" and b"WARC-Refers-To" not in fields and b"WARC-Profile" not in fields
        assert fields[b"WARC-Payload-Digest"].decode() == "sha256:" + hashlib.sha256(payload).hexdigest()
        stored, _ = bytes(r.header.encode()).split(b"\r\n\r\n", 1)
        assert (b"Content-Length: 0" in stored) == (r.type == "revisit" or not payload)
