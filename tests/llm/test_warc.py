import gzip
import hashlib
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioforge.llm import warc
from folioforge.session import scratch_path

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")).withColumn("key", F.lit(1)).repartition(3)


def brute(rows):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        keep = max((x for x in groups[h or ""] if x is not None), default=None)
        revisit = len(raw) >= 1000 and i != keep
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


ROWS = [(i, f"http://x.example/{i}?q=é", "<p>é</p>" * (i % 5 * 60)) for i in range(60)]
ROWS += [(100, None, None), (101, "http://a\r\nX: y", ""), (102, "u", "x" * 999), (103, "u", "x" * 999), (104, "u", "WARC/1.1\r\n\r\n" * 200), (105, "u", "WARC/1.1\r\n\r\n" * 200), (106, "u", "long " * 500_000), (107, "u", "long " * 500_000), (105, "u", "WARC/1.1\r\n\r\n" * 200)]


def test_round_trip(spark):
    assert sorted(map(tuple, warc.round_trip(pages(spark, ROWS)).collect()), key=repr) == brute(ROWS)


def test_round_trip_pushes_record_types_and_skips_payloads(spark, monkeypatch):
    read, reads = warc.read_records, []

    def spy(session, path, **options):
        reads.append(options)
        return read(session, path, **options)

    monkeypatch.setattr(warc, "read_records", spy)
    plan = warc.round_trip(pages(spark, ROWS))._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, reads)) == sorted(map(str, [{}, {"payload": "false"}]))
    assert "Union" in plan and "Filter" not in plan


@pytest.mark.parametrize("slots", [1, 7])
def test_slots_that_clash_change_nothing(spark, monkeypatch, slots):
    monkeypatch.setattr(warc, "SLOTS", slots)
    test_round_trip(spark)
    records = warc.page_records(pages(spark, ROWS)).collect()
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in records)
    assert all(hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"].removeprefix("sha1:") for r in records if r["payload"] is not None)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "warc")
    warc.write_pages(pages(spark, ROWS), path)
    return path


def test_predicates_on_headers_are_pushed_down(spark, archive):
    df = warc.read_records(spark, archive).where("record_type = 'revisit' AND payload_bytes > 2000 AND target_uri LIKE 'http:%'")
    assert "Filter" not in df._jdf.queryExecution().optimizedPlan().toString() or "record_type" not in df._jdf.queryExecution().optimizedPlan().toString().split("Filter", 1)[1].split("\n")[0]
    want = [r for r in warc.read_records(spark, archive).collect() if r["record_type"] == "revisit" and r["payload_bytes"] > 2000 and (r["target_uri"] or "").startswith("http:")]
    assert sorted(df.collect()) == sorted(want) and want
    assert warc.read_records(spark, archive).where("refers_to IS NULL").count() == sum(r[3] == "response" for r in brute(ROWS))
    assert warc.read_records(spark, archive).where("NOT record_type = 'revisit'").count() == sum(r[3] == "response" for r in brute(ROWS))
    assert warc.read_records(spark, archive).where("record_type IN ('response', 'x') AND length(target_uri) < 3").count() == 5


def test_headers_only_reads_no_payload(spark, archive):
    rows = warc.read_records(spark, archive, payload="false").collect()
    assert len(rows) == len(ROWS) and all(r["payload"] is None for r in rows)


def _files(archive):
    root = archive.removeprefix("file://")
    return [os.path.join(root, n) for n in os.listdir(root)]


def test_only_committed_archives_are_there(archive):
    assert all(n.endswith(".warc.gz") and not os.path.basename(n).startswith("_") for n in _files(archive))


def test_foreign_archives(spark, archive, tmp_path):
    """Plain text, and one gzip member for each record or for all."""
    whole = b"".join(gzip.decompress(open(n, "rb").read()) for n in sorted(_files(archive)))
    (tmp_path / "a.warc").write_bytes(whole)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(whole))
    for name in ("a.warc", "b.warc.gz"):
        got = warc.read_records(spark, f"{tmp_path}/{name}")
        assert sorted(got.collect(), key=repr) == sorted(warc.read_records(spark, archive).collect(), key=repr)
        assert got.where("record_type = 'revisit'").count() == sum(r[3] == "revisit" for r in brute(ROWS))


def test_cut_archive_fails(spark, archive, tmp_path):
    name = max(_files(archive), key=os.path.getsize)
    (tmp_path / "cut.warc.gz").write_bytes(open(name, "rb").read()[:-50])
    with pytest.raises(Exception, match="cut off"):
        warc.read_records(spark, f"{tmp_path}/cut.warc.gz").collect()


def test_files_are_dealt_by_size(archive):
    reader = warc.WarcReader(archive, {"partitionbytes": "3000"})
    parts = reader.partitions()
    assert sorted(n for p in parts for n in p.names) == sorted(_files(archive))
