from __future__ import annotations

import base64
import hashlib
import struct

import pytest
import zstandard

from clinlake.llm import warc
from clinlake.workspace import scratch_path

TEXT = "<html><body><p>The archive keeps page number {} about rivers, mills, bridges and the people near them.</p></body></html>"
PAGES = [
    *[(i, f"http://a.example/{i}", TEXT.format(i)) for i in range(300)],
    (300, "http://b.example/copy", TEXT.format(7)), (301, None, TEXT.format(7)), (None, "http://c.example/", TEXT.format(7)),
    (302, "http://d.example/\r\nX: y", ""), (303, "http://d.example/none", None), (None, None, None),
    (304, "http://e.example/same", "twice"), (304, "http://e.example/same", "twice"),
    (305, "http://f.example/long", "é \u0000 P*M\x18\x00\x00\x00\x00 " * 60_000), (None, None, "only"), (None, None, "only"),
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "1 as digest", "2 as mark", "3 as kept", "4 as payload")


def expected(rows, least=0):
    groups: dict = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for html, ids in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids = sorted(ids, key=lambda i: -1 if i is None else i, reverse=True)
        for n, i in enumerate(ids):
            again = n > 0 and len(data) >= least
            out.append((i, len(data), digest, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 6, 10_000])
def test_round_trip(spark, least):
    archive = warc.WarcArchive(spark, scratch_path(spark, "warc"))
    archive.write(pages(spark), min_revisit_bytes=least)
    found = archive.records()
    rows = [tuple(r) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(rows, key=str) == expected(PAGES, least)
    kept = {(r["page_id"], bytes(r["payload"])) for r in found.where("payload is not null").collect()}
    texts = {(i, (h or "").encode()) for i, _, h in PAGES}
    assert kept <= texts and {p for _, p in kept} == {p for _, p in texts}


def test_archives_are_what_the_format_asks_for(spark):
    path = scratch_path(spark, "warc")
    warc.WarcArchive(spark, path).write(pages(spark))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    seen = 0
    for file in files:
        data = bytes(file["content"])
        mark, size = struct.unpack_from("<II", data)
        assert mark == warc.DICTIONARY_FRAME
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        unpack = zstandard.ZstdDecompressor(dict_data=dictionary)
        left = data[8 + size :]
        while left:  # every record is a frame that can be read by itself
            if left[:4] == struct.pack("<I", warc.SKIPPED_FRAME):
                left = left[8:]
                continue
            one = unpack.decompressobj()
            block = one.decompress(left)
            left = one.unused_data
            assert block.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
            if b"WARC-Type: warcinfo" not in block:
                seen += 1
                assert block.count(b"WARC-Record-ID: ") == 1 and b"\r\nX: y" not in block
            assert (b"WARC-Type: revisit" in block) == (b"WARC-Refers-To: " in block)
    assert seen == len(PAGES)


def test_the_dictionary_makes_small_records_smaller(spark):
    rows = [(i, f"http://a.example/{i}", TEXT.format(i)) for i in range(300)]
    sizes = {}
    for size in (warc.DICTIONARY_BYTES, 0):
        records = [warc.page_record({"payload": h.encode(), "refers_uri": None, "url": u, "uri": warc.page_uri(i, i),
                                     "payload_digest": ""}, "d") for i, u, h in rows]
        dictionary = warc.build_dictionary(records, size) if size else None
        packer = zstandard.ZstdCompressor(dict_data=dictionary and zstandard.ZstdCompressionDict(dictionary))
        sizes[size] = sum(len(packer.compress(r)) for r in records)
    assert sizes[warc.DICTIONARY_BYTES] < sizes[0] / 2


def test_few_and_no_pages(spark):
    for rows in ([], PAGES[:1], PAGES[-2:]):
        got = [tuple(r) for r in warc.archive_and_list(pages(spark, rows)).collect()]
        assert sorted(got, key=str) == expected(rows)


def test_archives_of_others_can_be_read():
    one = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], b"abc\r\n\r\ndef")
    samples = [one + bytes(str(i), "ascii") * 30 for i in range(300)]
    held = warc.build_dictionary(samples, 1000)
    frame = zstandard.ZstdCompressor().compress(held)  # the dictionary itself may be compressed
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(held))
    data = warc.dictionary_frame(frame) + packer.compress(one) + packer.compress(one)
    assert [b for _, b in warc.read_records(data)] == [b"abc\r\n\r\ndef"] * 2
    assert [b for _, b in warc.read_records(zstandard.ZstdCompressor().compress(one))] == [b"abc\r\n\r\ndef"]
    assert list(warc.read_records(b"")) == []
    with pytest.raises(ValueError):
        list(warc.read_records(zstandard.ZstdCompressor().compress(one[:-9])))
