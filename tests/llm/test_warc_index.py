import base64
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from merchantlake.llm import warc_index as W
from merchantlake.llm.remote import locate

SCHEMA = "page_id bigint, url string, html string"
PAGES = [
    (4, "http://a/4", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"),
    (1, None, None), (3, "http://a/3", ""), (5, "http://a/5\r\nX: y", "é\r\n\r\nWARC/1.1\r\n" * 3), (6, "u", "x" * 300_000),
    (7, "u", "y"), (7, "u", "y"), (None, None, "z"), (None, "n", "<p>same</p>"), (8, "tail", " "),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA).withColumns({"record": F.lit("x"), "offset": F.lit(1), "file": F.lit(2)})


def expected():
    least = {}
    for page, _, html in PAGES:
        key = html or ""
        known = [p for p in (least.get(key), page) if p is not None]
        least[key] = min(known) if known else None
    out = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        first = least[html or ""]
        kind = "response" if page == first else "revisit"
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, kind, None if page == first else first))
    return sorted(out, key=repr)


def test_pages_come_back(pages, rows):
    assert rows(W.archived_pages(pages)) == expected()


def walk(data: bytes):
    """A reader that knows only the format."""
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        record = member.decompress(data[at:])
        length = len(data) - at - len(member.unused_data)
        end = record.index(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in record[:end].split(b"\r\n")[1:])
        assert record.startswith(b"WARC/1.1\r\n")
        assert record[end + 4 + int(fields[b"Content-Length"]) :] == b"\r\n\r\n"
        yield at, length, fields
        at += length


def test_files_are_archives_and_the_index_holds(pages):
    folder, index = W.write_archives(pages)
    system, inside = locate(folder)
    seen = {}
    for name in {x.file for x in index.collect()}:
        for offset, length, fields in walk(system.open_input_file(f"{inside}/{name}").read()):
            seen[name, offset] = (length, fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"].decode()[5:])
            assert b"X" not in fields
    assert seen == {(x.file, x.offset): (x.length, x.record_type, x.payload_digest) for x in index.collect()}
    assert len(seen) == len(PAGES)


def test_selected_records_are_read_with_their_payloads(pages):
    folder, index = W.write_archives(pages)
    got = W.read_records(folder, index.where("page_id in (5, 6, 9)"), with_payload=True).collect()
    payloads = {x.page_id: x.payload and bytes(x.payload).decode() for x in got}
    assert payloads == {5: "é\r\n\r\nWARC/1.1\r\n" * 3, 6: "x" * 300_000, 9: None}


def test_small_payloads_need_not_be_revisits(pages):
    planned = W.plan_records(pages, min_payload=2).where("record_type = 'revisit'").collect()
    assert sorted((x.page_id is None, x.page_id) for x in planned) == [(False, 4), (False, 9), (True, None)]


def test_near_ranges_are_read_together():
    import pandas as pd

    places = pd.DataFrame({"file": ["a"] * 4 + ["b"], "offset": [0, 100, 10**6, 10**6 + 50, 0], "length": [90, 50, 50, 50, 5]})
    assert [len(x) for x in W._ranges(places)] == [2, 2, 1]


def test_no_pages(spark):
    assert W.archived_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_paths_with_one_slash_or_three(tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    for path in (f"{tmp_path}/x", f"file:{tmp_path}/x", f"file://{tmp_path}/x"):
        system, inside = locate(path)
        assert system.open_input_file(inside).read() == b"abc"
