import base64
import gzip
import hashlib
import io

import pytest
from cases import no_rows, saved

from riskweave.llm import warc
from riskweave.llm.common import file_system, new_folder

PAGES = "page_id long, url string, html string, record_type string"


def _plain(pages):
    first = {}
    for i, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault(html or "", i)
    return {
        i: (
            len((html or "").encode()), base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode(),
            "response" if first[html or ""] == i else "revisit", None if first[html or ""] == i else first[html or ""],
        )
        for i, html in pages
    }


def test_round_trip_equals_plain_version(spark):
    odd = ["", None, "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>", "\r\n", "x" * 3_000_000, "a", "a", "a", None]
    pages = [(100 - i, html) for i, html in enumerate(odd)] + [(200 + i, f"page {i % 9}") for i in range(60)]
    table = saved(spark.createDataFrame([(i, None if i % 5 == 0 else f"http://x/{i}\r\nEvil: 1", h, "clash") for i, h in pages], PAGES))
    rows = warc.warc_round_trip(table).collect()
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows}
    assert len(rows) == len(pages) and got == _plain(pages)


def test_repeated_rows_null_ids_and_no_rows(spark):
    table = saved(spark.createDataFrame([(1, "u", "h", ""), (1, "u", "h", ""), (None, "u", "h", ""), (None, None, None, "")], PAGES))
    rows = warc.warc_round_trip(table).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in rows) == [
        (0, "response", 0), (0, "revisit", 1), (1, "response", 0), (1, "revisit", 1)
    ]
    assert warc.warc_round_trip(no_rows(spark, PAGES)).count() == 0


def test_members_stand_alone_and_the_index_finds_them(spark):
    table = saved(spark.createDataFrame([(i, f"http://x/{i}", f"page {i}" * i, "") for i in range(40)], PAGES))
    raw, clean = new_folder(spark, "raw"), new_folder(spark, "clean")
    warc.write_monolithic(warc.with_revisits(table), raw)
    made = warc.normalise(spark, raw, clean).collect()
    assert sum(m["records"] for m in made) == 40
    index = warc.read_index(spark, clean)
    for entry in index.collect():
        fs, path = file_system(entry["archive"])
        with fs.open_input_file(path) as f:
            member = f.read_at(entry["length"], entry["offset"])
        assert gzip.decompress(member).startswith(b"WARC/1.1\r\n") and entry["record_type"] == "response"
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read_pages(index, span=100).collect()}
    assert payloads == {i: (f"page {i}" * i).encode() for i in range(40)}
    # A normal archive goes through unchanged.
    again = new_folder(spark, "again")
    assert sum(m["records"] for m in warc.normalise(spark, clean, again).collect()) == 40


def test_a_torn_archive_is_an_error():
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort"
    with pytest.raises(ValueError):
        list(warc.warc_records(io.BytesIO(gzip.compress(record))))
