"""Archives of pages as Zstandard-compressed WARC files with a common dictionary.

A dictionary is built from a bounded sample of the records to be archived. Every
archive starts with it in a skippable frame and then has each record as a frame of
its own, so a record can be read by itself. Records with a payload that another
record already holds are revisits of that one.

An archive is a task's partition, written through Spark's text writer: any shared
file system will do, and an archive appears only when its task has been committed.
What that writer puts after every row is a skippable frame without content, which
readers of the format pass over.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions.joins import left_join_split
from clinlake.llm.common import map_stream, saved, smallest_by_hash
from clinlake.workspace import scratch_path

#: Fixed values of the format: the frame that holds the dictionary, an empty frame to be skipped, and Zstandard's own marks.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPED_FRAME = 0x184D2A50
FRAME_MARK, DICTIONARY_MARK = bytes.fromhex("28b52ffd"), bytes.fromhex("37a430ec")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEVEL = 3
DICTIONARY_BYTES = 112_640
#: The dictionary's sample: at most so many records of at most so many bytes each.
SAMPLE_RECORDS = 400
SAMPLE_RECORD_BYTES = 65_536

#: Bytes of frames or payloads that a task passes on at once.
LOT_BYTES = 1 << 22

_END = struct.pack("<II", SKIPPED_FRAME, 0).decode("ascii")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_uri(page_id, row: int | None) -> str:
    """A record's id: its page's, with a number where the page has several rows."""
    own = "" if page_id is None else page_id
    return f"<urn:page:{own}>" if row is None else f"<urn:page:{own}:row:{row}>"


def page_of(uri: str) -> int | None:
    own = uri.removeprefix("<urn:page:").removesuffix(">").split(":")[0]
    return int(own) if own else None


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record: version, named fields, block."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    """A page's record: a response with its payload, or a revisit with the response's HTTP head only."""
    payload, revisit = row["payload"], row["refers_uri"] is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", row["uri"]), ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _one_line(row["url"])))
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", row["refers_uri"]), ("WARC-Refers-To-Date", date)]
        if row["refers_url"] is not None:
            fields.append(("WARC-Refers-To-Target-URI", _one_line(row["refers_url"])))
    return record(fields, head if revisit else head + payload)


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A Zstandard dictionary, or None where the records are too few or too alike to give one."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return None


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def _in_lots(items: Iterator[tuple[int, tuple]]) -> Iterator[list[tuple]]:
    """Lists of rows of (bytes, row), of about LOT_BYTES together."""
    lot, held = [], 0
    for size, row in items:
        lot.append(row)
        held += size
        if held > LOT_BYTES:
            yield lot
            lot, held = [], 0
    yield lot


def read_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of one archive, whoever wrote it; field names in lower case."""
    dictionary = None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == DICTIONARY_FRAME:
        held = archive[8 : 8 + struct.unpack_from("<I", archive, 4)[0]]
        if held.startswith(FRAME_MARK):
            held = zstandard.ZstdDecompressor().decompress(held, max_output_size=1 << 27)
        dictionary = zstandard.ZstdCompressionDict(held)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(archive), read_across_frames=True)
    lines = io.BufferedReader(reader, 1 << 16)
    while version := lines.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        fields = {}
        while line := lines.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = lines.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError(f"{fields.get('warc-record-id')} is cut off")
        yield fields, block


class WarcArchive:
    """Compressed WARC files under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(
        self, pages: DataFrame, min_revisit_bytes: int = 0, level: int = LEVEL, dictionary_bytes: int = DICTIONARY_BYTES,
        date: datetime | None = None,
    ) -> None:
        """Archive a table (page_id, url, html), a record for every row.

        Of the rows with equal payloads of at least ``min_revisit_bytes`` the one with
        the largest page_id is a response, the others are its revisits; of several rows
        with that page_id one is the response. NULL page_ids are the smallest, a NULL
        html is an empty payload, a NULL url gives a record without target. Other
        columns are ignored, and an empty table gives an archive without records.
        """
        payload = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
        marked = pages.select(
            F.col("page_id").cast("long"), "url", payload.alias("payload"), F.monotonically_increasing_id().alias("mark")
        )
        # Marks of rows have to stay: they are read once for the groups and once for the records.
        rows = saved(self.spark, marked.select("*", F.sha1("payload").alias("digest")), "pages", compression="zstd")
        shared = (
            rows.where(F.octet_length("payload") >= min_revisit_bytes)
            .groupBy("digest")
            .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "mark", "url")).alias("kept"))
            .where("n > 1")
            .select("digest", "kept")
        )
        stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
        dictionary = build_dictionary(self._sample(rows, stamp), dictionary_bytes)
        frames = self._frames(left_join_split(rows, shared, "digest", counted=rows), dictionary, level, stamp)
        frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", _END).text(self.path)

    def _sample(self, rows: DataFrame, date: str) -> list[bytes]:
        """The records from which the dictionary is built: those with the smallest hashes among the shorter ones."""
        short = rows.where(F.octet_length("payload") <= SAMPLE_RECORD_BYTES)
        # The rows are chosen by their marks, so that tasks send the driver marks and only the chosen payloads.
        chosen = [r["mark"] for r in smallest_by_hash(short.select("mark"), "mark", SAMPLE_RECORDS).collect()]
        found = rows.where(F.col("mark").isin(chosen)).select("page_id", "url", "payload")
        known = {"uri": "", "refers_uri": None, "payload_digest": ""}
        return [
            page_record(r.asDict() | known | {"uri": page_uri(r["page_id"], None), "payload_digest": payload_digest(r["payload"])}, date)
            for r in found.collect()
        ]

    @staticmethod
    def _frames(rows: DataFrame, dictionary: bytes | None, level: int, date: str) -> DataFrame:
        """(frame) in file order: the dictionary, a record about the archive, and a frame for every page."""
        is_response = F.col("kept").isNull() | (F.col("mark") == F.col("kept.mark"))
        asked = rows.select(
            "page_id", "url", "payload", "mark", F.when(~is_response, F.col("kept")).alias("kept"),
        )

        def frames(parts):
            shared = None if dictionary is None else zstandard.ZstdCompressionDict(dictionary)
            packer, begun = zstandard.ZstdCompressor(level=level, dict_data=shared), False
            for part in parts:
                if part and not begun:
                    begun = True
                    if dictionary is not None:
                        yield dictionary_frame(dictionary)
                    about = [
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                        ("Content-Type", "application/warc-fields"),
                    ]
                    yield packer.compress(record(about, b"format: WARC File Format 1.1\r\n"))
                for r in part:
                    kept = r["kept"]
                    known = {
                        "uri": page_uri(r["page_id"], r["mark"]),
                        "refers_uri": None if kept is None else page_uri(kept["page_id"], kept["mark"]),
                        "refers_url": None if kept is None else kept["url"],
                        "payload_digest": payload_digest(r["payload"]),
                    }
                    yield packer.compress(page_record(r | known, date))

        def stream(parts):
            return _in_lots((len(f), (f,)) for f in frames(parts))

        return map_stream(asked, "frame binary", stream, "payload")

    def records(self) -> DataFrame:
        """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of all archives.

        ``payload`` is NULL for revisits, whose length is that of their HTTP head. The
        digest of every payload is compared with the record's.
        """
        archives = self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(self.path)

        def rows(parts):
            for part in parts:
                for archive in part:
                    for fields, block in read_records(archive["content"]):
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        head, _, body = block.partition(b"\r\n\r\n")
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        whole = fields["warc-type"] == "response"
                        if whole and payload_digest(body) != digest:
                            raise ValueError(f"payload of {fields['warc-record-id']} is not the one that was archived")
                        size = int(head.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
                        yield len(block), (
                            page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest,
                            fields["warc-type"], None if whole else page_of(fields["warc-refers-to"]), body if whole else None,
                        )

        def stream(parts):
            return _in_lots(rows(parts))

        return map_stream(
            archives.select("content"),
            "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
            "payload binary", stream, "content",
        )


def archive_and_list(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): the records of a table's archives, read back."""
    spark = pages.sparkSession
    archive = WarcArchive(spark, scratch_path(spark, "warc"))
    archive.write(pages)
    return archive.records().select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same result in DuckDB, over the same table.
ORACLE = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), written AS (
  SELECT *, row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS nth,
    max(page_id) OVER (PARTITION BY payload) AS kept
  FROM hashed
)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nth > 1 THEN kept END AS refers_to
FROM written
"""
