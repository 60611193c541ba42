"""WARC headers of any length, and records that can't be read."""

import io

from statloom.llm import warc


def test_long_urls_read_back(spark):
    url = "http://x/" + "".join(chr(97 + i * i * 7 % 26) for i in range(3_000_000))
    pages = spark.createDataFrame([(1, url, "<p>a</p>"), (2, "u", "b")], "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert set(got) == {1, 2} and got[1]["url"] == url and got[1]["html"] == "<p>a</p>" and got[1]["digest_ok"]


def test_unreadable_records_stay(spark, tmp_path):
    good = warc.page_record(1, "u", "a")
    (tmp_path / "x.warc.gz").write_bytes(warc.record("warcinfo", b"", {}) + good + warc.page_record(2, "u", "b" * 100_000)[:60] + good)
    got = warc._pages(warc.read_warc(spark, [f"file://{tmp_path}/x.warc.gz"])).collect()
    assert sum(r["digest_ok"] is False for r in got) == 1 and sum(r["html"] == "a" and r["digest_ok"] for r in got) >= 1


def test_other_plain_files_are_not_held_whole():
    raw = io.BytesIO(b"WARC/1.0\r\nContent-Length: 1\r\n\r\na\r\n\r\n" + b"x" * 5_000_000)
    assert [r["error"] for r in warc.records(raw)] == [None, "no header"] and raw.tell() < 1_000_000
