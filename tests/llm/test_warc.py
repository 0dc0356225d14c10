"""Archives of odd pages: valid WARC files, and what is read back, against brute force."""

import gzip
import hashlib
from collections import Counter, defaultdict
from pathlib import Path
from uuid import uuid4

import pytest

from verbascope.llm import warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>" + "é wörd \r\n\r\n" * 30
ROWS = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, "http://a/9", LONG), (9, "http://a/9", LONG), (None, None, LONG),
    (1, "http://a/1", "short"), (2, "http://a/2", "short"), (4, None, None), (6, "", ""), (7, "x\r\nWARC-Type: fake\n", "a" * 99), (8, "u", "a" * 99),
    (10, "u", "b" * 100), (11, "u", "b" * 100), (12, "u", "WARC/1.1\r\nWARC-Warcinfo-ID: <urn:uuid:0>\r\nWARC-Type: response\r\n\r\n" * 3),
    (13, "u: v", "\r\n\r\n"), (14, "u", "\n" + "z" * 300_000 + "\r\n\r\n"), (None, "u", "n" * 200), (None, "w", "n" * 200), (-1, "u", "b" * 100),
]


def brute(rows, min_bytes=100):
    groups = defaultdict(list)
    for i, _, html, *_ in rows:
        groups[(html or "").encode()].append(i)
    found = Counter()
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for place, i in enumerate(ids):
            revisit = place > 0 and len(payload) >= min_bytes
            found[i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", ids[0] if revisit else None] += 1
    return found


def parsed(folder):
    """Records of the files by the lengths their headers name, without the library."""
    for file in sorted(Path(folder.removeprefix("file:")).glob("*.gz")):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            n = int(fields["Content-Length"])
            assert version == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n"
            yield fields, rest[:n].partition(b"\r\n\r\n")[2]
            data = rest[n + 4 :]


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(warc, "small_side", lambda df: (df, False))
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert Counter(map(tuple, warc.archive_round_trip(pages).collect())) == brute(ROWS)
    assert Counter(map(tuple, warc.archive_round_trip(pages, min_bytes=5).collect())) == brute(ROWS, 5)


def test_files_are_warc(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    crawled, kept = (f"file:{tmp_path}/{n}-{uuid4().hex}" for n in ("crawl", "archive"))
    warc.write_archives(pages, crawled)
    assert Counter(payload for _, payload in parsed(crawled)) == Counter((r[2] or "").encode() for r in ROWS)
    warc.deduplicate(spark, crawled, kept)
    records = list(parsed(kept))
    by_id = {f["WARC-Record-ID"]: payload for f, payload in records}
    assert len(by_id) == len(ROWS)
    for fields, payload in records:
        assert len(fields["WARC-Warcinfo-ID"]) > 32 and fields["WARC-Date"].endswith("Z")
        full = payload if fields["WARC-Type"] == "response" else by_id[fields["WARC-Refers-To"]]
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(full).hexdigest()
        assert fields["WARC-Type"] == "response" or not payload and fields["WARC-Profile"] == warc.PROFILE
    assert sum(f["WARC-Type"] == "revisit" for f, _ in records) == 7


def test_split_files_lose_no_record(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} " * (i % 50)) for i in range(2000)], SCHEMA).coalesce(1)
    folder = f"file:{tmp_path}/crawl-{uuid4().hex}"
    warc.write_archives(pages, folder)
    plain = f"file:{tmp_path}/plain-{folder.rpartition('-')[2]}"
    run = folder.rpartition("-")[2]
    lines = spark.read.option("lineSep", warc._start(run)).text(folder).where("value != ''")
    lines.selectExpr(f"concat('{warc._start(run)}', rtrim('\r\n', value)) value").write.option("lineSep", "\r\n\r\n").text(plain)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        records = warc.read_records(spark, plain)
        assert records.rdd.getNumPartitions() > 50
        assert sorted((r.page_id, bytes(r.payload).decode()) for r in records.select("page_id", "payload").collect()) == [(i, f"{i} " * (i % 50)) for i in range(2000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_changed_payload_is_an_error(spark, tmp_path):
    folder = f"file:{tmp_path}/crawl-{uuid4().hex}"
    warc.write_archives(spark.createDataFrame([(1, "u", "abc")], SCHEMA), folder)
    for file in tmp_path.glob("crawl-*/*.gz"):
        data = gzip.decompress(file.read_bytes()).replace(b"abc", b"abd")
        file.write_bytes(gzip.compress(data))
        (file.parent / f".{file.name}.crc").unlink()
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_resolved(spark, folder).collect()


def test_empty_table_and_other_columns(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
    more = spark.createDataFrame([(*r, "x", b"y", 1) for r in ROWS], SCHEMA + ", type string, payload binary, digest int")
    assert Counter(map(tuple, warc.archive_round_trip(more).collect())) == brute(ROWS)
