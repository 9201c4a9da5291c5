import base64
import gzip
import hashlib
from pathlib import Path

import pyarrow.parquet as pq

from lodgeflow.llm import queries, warc

SF = "/root/testdata/sf0.001"


def brute(pages, min_bytes=0):
    payloads = [(i, (h or "").encode()) for i, h in pages]
    first = {}
    for i, p in payloads:
        if i is not None and len(p) >= min_bytes:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, p in payloads:
        revisit = p in first and first[p] != i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if revisit else "response", first[p] if revisit else None))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark, rows):
    t = pq.read_table(f"{SF}/pages.parquet").to_pydict()
    assert rows(queries.op10_warc(spark, SF)) == brute(list(zip(t["page_id"], t["html"])))


def test_edge_pages(spark, rows, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    pages = [(3, None), (2, ""), (5, "é\r\n\r\n"), (4, "é\r\n\r\n"), (4, "é\r\n\r\n"), (6, fake), (7, "x" * 300_000), (None, "é\r\n\r\n")]
    table = spark.createDataFrame([(i, "http://a/\r\nX: y", h, "x") for i, h in pages], "page_id bigint, url string, html string, sha string")
    warc.write(table, f"{tmp_path}/a", compression="gzip")
    read = warc.read(spark, f"{tmp_path}/a", payloads=True)
    assert read.where("kind = 'gap'").count() == 0
    got = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect()]
    name = lambda i: None if i is None else f"<urn:page:{i}>"
    want = [(name(i) or "<urn:page:>", n, d, k, name(r)) for i, n, d, k, r in brute(pages)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    payloads = {bytes(r.payload) for r in read.where("record_type = 'response'").collect()}
    assert payloads == {(h or "").encode() for _, h in pages}
    warc.write(table.limit(0), f"{tmp_path}/b")
    assert warc.read(spark, f"{tmp_path}/b").collect() == []


def test_min_bytes(spark, tmp_path):
    table = spark.createDataFrame([(1, None, "ab"), (2, None, "ab"), (3, None, "abc"), (4, None, "abc")], "page_id bigint, url string, html string")
    warc.write(table, f"{tmp_path}/a", min_bytes=3)
    kinds = {r.record_id: r.record_type for r in warc.read(spark, f"{tmp_path}/a").collect()}
    assert [kinds[f"<urn:page:{i}>"] for i in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]


def covered(data):
    """Parts of a plain archive: they follow each other and cover every byte."""
    parts, at = list(warc.salvaged(data)), 0
    for kind, offset, length, _ in parts:
        assert offset == at
        at += length
    assert at == len(data)
    return [p[3]["record_id"] if p[0] == "record" else "gap" for p in parts]


def test_salvage_of_plain_archives():
    records = [warc.record(i, "http://x/", b"payload %d" % i * 9, None) + b"\n" for i in range(5)]
    ids = [f"<urn:page:{i}>" for i in range(5)]
    data = b"".join(records)
    assert covered(data) == ids
    assert covered(b"") == []
    assert covered(b"junk" + data + b"tail") == ["gap", *ids, "gap"]
    broken = bytearray(data)
    broken[len(records[0]) + len(records[1]) - 10] ^= 1  # a payload byte of record 1
    assert covered(bytes(broken)) == [ids[0], "gap", *ids[2:]]
    cut = data[: len(data) - 20]
    assert covered(cut) == [*ids[:4], "gap"]
    lost = records[0] + records[1][:40] + records[2] + records[3]
    assert covered(lost) == [ids[0], "gap", ids[2], ids[3]]
    length = data.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert covered(length)[0] == "gap" and covered(length)[1:] == ids[1:]


def test_salvage_of_gzip_members():
    members = [gzip.compress(warc.record(i, None, b"p%d" % i * 500, None) + b"\n", mtime=0) for i in range(4)]
    ids = [f"<urn:page:{i}>" for i in range(4)]
    name = lambda data: [p[3].get("record_id", "gap") for p in warc.salvaged(data)]
    assert name(b"".join(members)) == ids
    bad = bytearray(b"".join(members))
    bad[len(members[0]) + 40] ^= 0xFF
    got = name(bytes(bad))
    assert got[0] == ids[0] and got[-2:] == ids[2:] and "gap" in got and ids[1] not in got
    assert name(members[0] + members[1][:30] + members[2]) == [ids[0], "gap", ids[2]]
    whole = gzip.compress(b"".join(warc.record(i, None, bytes(str(i), "ascii") * 40_000, None) + b"\n" for i in range(4)))
    assert name(whole) == ids
    assert name(whole[:-12])[:3] == ids[:3]


def test_damaged_file_on_disk(spark, tmp_path):
    table = spark.range(20).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id as string), 50) AS html").coalesce(1)
    warc.write(table, f"{tmp_path}/a")
    (file,) = [f for f in Path(tmp_path, "a").glob("part-*") if f.stat().st_size]
    data = bytearray(file.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 30] = b"\0" * 30
    file.write_bytes(bytes(data))
    for crc in Path(tmp_path, "a").glob(".*crc"):
        crc.unlink()
    got = warc.read(spark, f"{tmp_path}/a").groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in got} in ({"record": 19, "gap": 1}, {"record": 18, "gap": 1})


def test_flipped_byte_in_a_written_gzip_archive(spark, tmp_path):
    table = spark.range(50).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(cast(id as string), 256), 20) AS html").coalesce(1)
    warc.write(table, f"{tmp_path}/a", compression="gzip")
    data = b"".join(f.read_bytes() for f in sorted(Path(tmp_path, "a").glob("part-*")))
    ids = lambda data: [p[3]["record_id"] for p in warc.salvaged(data) if p[0] == "record"]
    whole = ids(data)
    assert len(whole) == 50
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 50
    for at in range(5, len(data), len(data) // 40):
        broken = bytearray(data)
        broken[at] ^= 0xFF
        got = ids(bytes(broken))
        assert len(got) >= 49 and set(got) <= set(whole)
        assert any(p[0] == "gap" for p in warc.salvaged(bytes(broken))) or got == whole


def test_members_of_large_records():
    page = bytes(17 << 20)
    data = warc.member(1, None, page, None) + b"\0" + warc.member(2, None, b"x", None) + b"\0"
    parts = list(warc.salvaged(data))
    assert [(p[0], p[3].get("payload_bytes")) for p in parts] == [("record", len(page)), ("record", 1)]
