"""WARC: repeated and null ids against plain grouping, records of other writers."""

import gzip
import hashlib
from collections import Counter

from voxloom.llm import warc
from voxloom.llm.workspace import Workspace

LONG, OTHER, SHORT = "<p>" + "é" * 80 + "</p>", "x" * 100, "y" * 99


def expected(rows):
    """Of equal payloads of 100 bytes or more the least (page_id, url), nulls last, is the one response."""
    groups, out = {}, Counter()
    for i, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((i is None, i, url is None, url))
    for payload, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2], m[3] or ""))
        for k, m in enumerate(members):
            again = k > 0 and len(payload) >= 100
            out[(m[1], len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", members[0][1] if again else None)] += 1
    return out


def test_repeated_and_null_ids(spark):
    rows = [(1, "u", LONG), (1, "u", LONG), (2, "u", LONG), (None, "u", LONG), (1, "t", LONG), (1, None, LONG)]
    rows += [(7, "u", OTHER), (7, "u", OTHER), (7, "u", SHORT), (7, "u", SHORT), (8, "u", SHORT), (9, "u", None), (9, "u", ""), (9, None, None)]
    rows += [(None, None, "z" * 200)] * 3 + [(20, "only", "w" * 150)] + [(30, "hot", "h" * 300)] * 50 + [(31, "hot", "h" * 300)] * 20
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    out = warc.round_trip(table)
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out.collect())
    assert got == expected(rows)
    assert all(r["verified"] is (True if r["record_type"] == "response" else None) for r in out.collect())


def record(kind, fields, block):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, *fields, b"Content-Length: %d" % len(block)]
    return gzip.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_records_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    body = b"a\r\n\r\nb" * 900
    members = [
        record(b"warcinfo", [b"WARC-Record-ID: <urn:uuid:1>", b"Content-Type: application/warc-fields"], b"software: other\r\n\r\nformat: x\r\n"),
        record(b"request", [b"WARC-Record-ID: <urn:uuid:2>", b"Content-Type: application/http; msgtype=request"], b"GET / HTTP/1.1\r\nHost: h\r\n\r\n"),
        record(b"response", [b"WARC-Record-ID: <urn:uuid:3>", b"Content-Type: application/http; msgtype=response", b"WARC-Payload-Digest: sha1:ABCDEF"], http + body),
        record(b"resource", [b"WARC-Record-ID: <urn:uuid:4>", b"Content-Type: text/plain"], body),
        record(b"metadata", [b"WARC-Record-ID: <urn:uuid:5>"], b""),
        record(b"response", [b"Content-Type: application/http"], b""),
    ]
    (tmp_path / "other.warc.gz").write_bytes(b"".join(members))
    with Workspace(spark, "foreign") as ws:
        manifest = ws.table(spark.createDataFrame([(f"{tmp_path}/other.warc.gz", 6, 0)], warc.MANIFEST), "m")
        rows = warc.read_chunks(manifest, f"file://{tmp_path}", 1000).orderBy("record_id", "chunk_no").collect()
    whole = {}
    for r in rows:
        whole[r["record_id"]] = whole.get(r["record_id"], b"") + bytes(r["chunk"])
    assert whole == {None: b"", "urn:uuid:1": b"software: other\r\n\r\nformat: x\r\n", "urn:uuid:2": b"", "urn:uuid:3": body, "urn:uuid:4": body, "urn:uuid:5": b""}
    last = {r["record_id"]: r for r in rows if r["is_last"]}
    assert all(last[k]["running_digest"] == hashlib.sha256(v).hexdigest() and last[k]["running_bytes"] == len(v) for k, v in whole.items())
    assert [last[k]["record_type"] for k in ("urn:uuid:1", "urn:uuid:3", "urn:uuid:4")] == ["warcinfo", "response", "resource"]
    assert all(r["declared_digest"] is None and r["declared_bytes"] is None for r in rows)
    assert max(len(r["chunk"]) for r in rows) <= 1000 and sum(r["record_id"] == "urn:uuid:4" for r in rows) == 6
