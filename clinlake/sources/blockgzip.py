"""Lines of block-gzip files, a file worked on by many tasks.

Such a file is a row of small gzip members that each name their own size. A task gets
a range of bytes, looks for the first member that begins in it, and goes from header to
header. What looks like a header is one only if the sizes lead on to further headers and
the member unpacks to its own checksum. A line belongs to the range in which it begins,
so a task passes over the line it starts in and reads on to the end of its last one.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.sources import listing

# Tasks get these functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 32 * 1024 * 1024
# Fixed values of the format: the start of a member, its own subfield, and the largest member.
MEMBER_MARK = bytes.fromhex("1f8b0804")
SIZE_FIELD = (b"BC", 2)
MEMBER_BYTES = 1 << 16
#: Headers that have to follow each other where a range's first member is looked for.
CHAIN = 3
_BATCH_BYTES = 4 * 1024 * 1024


class Members:
    """The gzip members of an open file, by their offsets."""

    def __init__(self, file, length: int, window: int = 1 << 20):
        self.file, self.length, self.window = file, length, window
        self.at, self.held = 0, b""

    def _bytes(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.held):
            self.file.seek(at)
            self.at, self.held = at, self.file.read(max(n, self.window))
        return self.held[at - self.at : at - self.at + n]

    def size(self, at: int) -> int | None:
        """Bytes of the member at an offset; None where no member with a size field begins."""
        head = self._bytes(at, 12)
        if len(head) < 12 or not head.startswith(MEMBER_MARK):
            return None
        fields = self._bytes(at + 12, struct.unpack_from("<H", head, 10)[0])
        i = 0
        while i + 4 <= len(fields):
            n = struct.unpack_from("<H", fields, i + 2)[0]
            if (fields[i : i + 2], n) == SIZE_FIELD and i + 6 <= len(fields):
                return struct.unpack_from("<H", fields, i + 4)[0] + 1
            i += 4 + n
        return None

    def unpacked(self, at: int, size: int) -> bytes | None:
        """Contents of a member; None if they are not what its checksum says."""
        member = self._bytes(at, size)
        try:
            data = zlib.decompress(member, wbits=31)
        except zlib.error:
            return None
        return data if len(member) == size else None

    def first_from(self, at: int, end: int) -> int | None:
        """Offset of the first member that begins in [at, end)."""
        while at < end:
            near = self._bytes(at, MEMBER_BYTES + len(MEMBER_MARK))
            found = near.find(MEMBER_MARK)
            if found < 0:
                at += max(1, len(near) - len(MEMBER_MARK) + 1)
                continue
            at += found
            if at < end and self._is_member(at):
                return at
            at += 1
        return None

    def _is_member(self, at: int) -> bool:
        first, n = at, 0
        while n < CHAIN and at < self.length:
            size = self.size(at)
            if size is None:
                return False
            at, n = at + size, n + 1
        return self.unpacked(first, self.size(first)) is not None


def range_lines(file, length: int, start: int, end: int) -> Iterator[bytes]:
    """Lines that begin in the members of a byte range, and for any range but the first not at its very start."""
    members = Members(file, length)
    at = members.first_from(start, end)
    if at is None:
        return
    skipping, left = start > 0, b""
    while at < length:
        size = members.size(at)
        data = None if size is None else members.unpacked(at, size)
        if data is None:
            raise ValueError(f"broken gzip block at byte {at}")
        beyond = at >= end
        at += size
        if skipping:
            if beyond:
                return  # no line begins here: an earlier range reads on to the end of this one
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, skipping = data[cut + 1 :], False
        *lines, left = (left + data).split(b"\n")
        if beyond and lines:
            yield lines[0]
            return
        yield from lines
    if left and not skipping:
        yield left


def _ranges(range_bytes: int):
    layout = pa.schema([("path", pa.string()), ("length", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                system, own = listing.opened(row["path"])
                with system.open_input_file(own) as file:
                    blocked = Members(file, row["length"], window=1 << 12).size(0) is not None
                step = range_bytes if blocked else max(1, row["length"])
                for start in range(0, row["length"], step):
                    out.append((row["path"], row["length"], start, start + step if blocked else -1))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, layout, strict=True)], schema=layout)

    return run


def _read() -> callable:
    layout = pa.schema([("file", pa.string()), ("value", pa.string())])

    def lines_of(row: dict) -> Iterator[bytes]:
        if row["end"] < 0:  # a gzip file without blocks
            yield from (line.encode("utf-8", "surrogateescape") for line in listing._lines(row["path"]))
            return
        system, own = listing.opened(row["path"])
        with system.open_input_file(own) as file:
            yield from (line.removesuffix(b"\r") for line in range_lines(file, row["length"], row["start"], row["end"]))

    def batch_of(path: str, lines: list[bytes]) -> pa.RecordBatch:
        text = pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())
        return pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), text], schema=layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for line in lines_of(row):
                    held.append(line)
                    size += len(line)
                    if size > _BATCH_BYTES:
                        yield batch_of(row["path"], held)
                        held, size = [], 0
                yield batch_of(row["path"], held)

    return run


def packed(data: bytes) -> bytes:
    """One gzip member with a size field."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    field = SIZE_FIELD[0] + struct.pack("<HH", SIZE_FIELD[1], len(body) + 25)
    head = MEMBER_MARK + bytes(4) + b"\x00\xff" + struct.pack("<H", len(field)) + field
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def write_block_gzip(lines: DataFrame, path: str, head: Sequence[str] = (), block_bytes: int = 60_000) -> None:
    """Write lines (``value``) as block-gzip files, a file per partition with rows, each beginning with ``head``.

    Spark's text writer puts an empty member, the format's own end mark, after every block.
    """
    top = "".join(f"{line}\n" for line in head).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = top
        for batch in batches:
            for line in batch.column("value").to_pylist():
                left += f"{line or ''}\n".encode("utf-8", "surrogatepass")
                while len(left) >= block_bytes:
                    yield pa.RecordBatch.from_pylist([{"block": packed(left[:block_bytes])}])
                    left = left[block_bytes:]
        if left != top:
            yield pa.RecordBatch.from_pylist([{"block": packed(left)}])

    blocks = lines.select("value").mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value"))
    end = packed(b"").decode("latin-1")
    blocks.write.option("lineSep", end).option("encoding", "ISO-8859-1").text(path)


def scan_block_gzip(spark: SparkSession, path: str | Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, value): the lines of gzip files. Files in blocks are dealt in byte ranges, others stay with one task each."""
    files = listing.list_files(spark, path).where("length > 0")
    ranges = files.mapInArrow(_ranges(range_bytes), "path string, length bigint, start bigint, end bigint")
    whole = files.agg(F.sum(F.ceil(F.col("length") / range_bytes)).alias("n")).first()["n"]
    # A given number of partitions, as adaptive execution would put the few bytes of the ranges into one task.
    parts = max(1, min(int(whole or 1), 16 * spark.sparkContext.defaultParallelism))
    return ranges.repartition(parts).mapInArrow(_read(), "file string, value string")
