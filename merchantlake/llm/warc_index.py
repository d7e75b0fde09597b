"""WARC archives with an index that is written first, and reads of selected records by byte range.

Archives have one gzip member per record, so a record can be read by itself. Tasks write them one record after the other
and return where each record lies; that index (file, offset, length, url, digest, ...) is stored. A reader selects from it,
sorts what it selected by place, joins near ranges into one read, and checks each payload against its digest.

Defined results: null html is an empty payload. Of rows with equal payloads those with the smallest id are responses (all of
them, if rows repeat that id) and the others revisit it; a null id is greater than any. Payloads are of any length. Null urls are written as
``urn:page:<id>``, and control characters in urls as %20. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import new_path, partitions, store
from merchantlake.llm.remote import locate

# Line ends, end of a record, and the alphabet of base32.
CRLF = "\r\n"
END_OF_RECORD = CRLF * 2
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MIN_PAYLOAD = 0
DATE = "2024-01-01T00:00:00Z"
#: Ranges nearer than this are read together, up to so many bytes at once.
GAP, READ_AT_ONCE = 1 << 16, 1 << 23


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hex SHA-1: five hex digits are four base32 digits."""
    letters = []
    for group in range(8):
        number = F.conv(F.substring(digest, 1 + 5 * group, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _lines(*lines: Column) -> Column:
    return F.concat(*[x for line in lines for x in (line, F.lit(CRLF))])


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to."""
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html")
    )
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("bigint"), "sha1": F.sha1(F.encode("html", "UTF-8"))})
    first = rows.groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("first_id"))
    joined = rows.join(first, ["sha1", "payload_bytes"])
    revisits = (F.col("payload_bytes") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", base32_of_hex(F.col("sha1")).alias("payload_digest"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"), F.when(revisits, F.col("first_id")).alias("refers_to"),
    )


def record_text(planned: DataFrame) -> Column:
    """A whole record, without what ends it."""
    name = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))
    page, revisit = F.col("page_id"), F.col("record_type") == "revisit"
    target = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("null"))))
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _field("Content-Length", F.col("payload_bytes")), F.lit(""))
    refers = F.when(revisit, _lines(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), _field("WARC-Refers-To", name(F.col("refers_to")))
    )).otherwise("")
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    head = F.concat(
        _lines(F.lit("WARC/1.1"), _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", name(page)), F.lit(f"WARC-Date: {DATE}"),
               _field("WARC-Target-URI", target), _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        refers,
        _lines(F.lit("Content-Type: application/http; msgtype=response"), _field("Content-Length", block_bytes), F.lit("")),
    )
    return F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("html")))


def _write(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inside = locate(f"{folder}/{uuid4().hex}.warc.gz")
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        offset = 0
        # Not by the name's ending: members are compressed one by one here.
        with system.open_output_stream(inside, compression=None) as out:
            for batch in batches:
                lengths = []
                for record in batch["record"]:
                    member = gzip.compress((record + END_OF_RECORD).encode("utf-8", "surrogatepass"), mtime=0)
                    out.write(member)
                    lengths.append(len(member))
                ends = offset + np.cumsum(lengths)
                yield batch.drop(columns="record").assign(file=inside.rsplit("/", 1)[1], offset=ends - lengths, length=lengths)
                offset = int(ends[-1])

    return run


def write_archives(pages: DataFrame, **names: str) -> tuple[str, DataFrame]:
    """A folder of archives, and the stored index: file, offset, length, url, payload_digest, page_id, record_type, refers_to.

    A task that is run again writes another file. Only files that the stored index names are part of the result.
    """
    folder = new_path(pages.sparkSession, "archives")
    planned = plan_records(pages, **names)
    key = planned.schema["page_id"].dataType
    as_text = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    records = planned.withColumn("record", record_text(planned)).withColumns(as_text)
    places = records.select("page_id", "url", "payload_digest", "record_type", "refers_to", "record").mapInPandas(
        _write(folder),
        "page_id string, url string, payload_digest string, record_type string, refers_to string, file string, offset bigint, length bigint",
    )
    return folder, store(places.withColumns({c: F.col(c).cast(key) for c in as_text}), "archive-index")


def _parse(record: bytes) -> dict:
    """The fields of a record's head, and the payload of its block."""
    head, _, block = record.partition(END_OF_RECORD.encode())
    lines = head.decode("utf-8", "surrogatepass").split(CRLF)
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(END_OF_RECORD.encode())
    described = dict(line.split(": ", 1) for line in http.decode().split(CRLF)[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if lines[0] != "WARC/1.1":
        raise ValueError("not the beginning of a record")
    if fields["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"record_type": fields["WARC-Type"], "payload_digest": digest, "payload_bytes": int(described["Content-Length"]),
            "url": fields["WARC-Target-URI"], "refers_to": fields.get("WARC-Refers-To"), "record_id": fields["WARC-Record-ID"],
            "payload": payload if fields["WARC-Type"] == "response" else None}


def _ranges(places: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of rows, sorted by place, that are read at once."""
    file, offset, length = (places[c].tolist() for c in ("file", "offset", "length"))
    begin = 0
    for i in range(1, len(places) + 1):
        if i < len(places):
            near = file[i] == file[i - 1] and offset[i] - offset[i - 1] - length[i - 1] <= GAP
            if near and offset[i] + length[i] - offset[begin] <= READ_AT_ONCE:
                continue
        yield places.iloc[begin:i]
        begin = i


FIELDS = ("record_type", "payload_digest", "payload_bytes", "url", "refers_to", "record_id")


def _read(folder: str, with_payload: bool):
    columns = (*FIELDS, "payload") if with_payload else FIELDS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _ranges(batch):
                system, inside = locate(f"{folder}/{part['file'].iloc[0]}")
                start, stop = int(part["offset"].iloc[0]), int((part["offset"] + part["length"]).max())
                with system.open_input_file(inside) as source:
                    data = source.read_at(stop - start, start)
                parsed = [_parse(gzip.decompress(data[o - start : o - start + n])) for o, n in zip(part["offset"], part["length"])]
                out = pd.DataFrame(parsed, columns=list(columns))
                out.insert(0, "page_id", part["page_id"].array)
                yield out

    return run


def read_records(folder: str, selected: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that ``selected`` rows of the index name, read by range: page_id and what the record itself says."""
    spark = selected.sparkSession
    schema = "page_id string, record_type string, payload_digest string, payload_bytes bigint, url string, refers_to string, record_id string"
    places = selected.select("file", "offset", "length", F.col("page_id").cast("string").alias("page_id"))
    by_place = places.repartition(partitions(spark), "file").sortWithinPartitions("file", "offset")
    read = by_place.mapInPandas(_read(folder, with_payload), schema + (", payload binary" if with_payload else ""))
    return read.withColumn("page_id", F.col("page_id").cast(selected.schema["page_id"].dataType))


def archived_pages(pages: DataFrame, **names: str) -> DataFrame:
    """Write all pages, then read all records back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder, index = write_archives(pages, **names)
    read = read_records(folder, index)
    id_type = index.schema["page_id"].dataType
    refers = F.regexp_extract("refers_to", "^<urn:page:(.*)>$", 1)
    return read.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.when(F.col("refers_to").isNotNull(), refers.cast(id_type)).alias("refers_to")
    )
