"""Files listed, opened and unpacked inside tasks."""

from __future__ import annotations

import gzip
import io
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from clinlake.sources import blockgzip, delimited, listing, vcf
from tests.conftest import rows


def in_blocks(data: bytes, sizes, level: int = 6) -> bytes:
    """Block-gzip form of data: members with a size field, an empty one at the end."""
    out, at = [], 0
    for size in [*sizes, 0]:
        part, at = data[at : at + size], at + size
        packer = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        head = bytes.fromhex("1f8b08040000000000ff0600") + b"BC\x02\x00" + struct.pack("<H", len(body) + 25)
        out.append(head + body + struct.pack("<II", zlib.crc32(part), len(part)))
    assert at >= len(data)
    return b"".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_ranges_of_any_size_give_the_same_lines(seed):
    draw = random.Random(seed)
    # Bytes that look like members lie in lines that cannot be compressed.
    lines = [draw.randbytes(draw.choice([0, 3, 40, 3000])).replace(b"\n", b"") + blockgzip.MEMBER_MARK * (i % 3) for i in range(150)]
    data = b"\n".join(lines) + (b"\n" if seed % 2 else b"")
    sizes = []
    while sum(sizes) < len(data):
        sizes.append(draw.choice([1, 7, 500, 9_000, 60_000]))
    packed = in_blocks(data, sizes, level=0 if seed % 3 == 0 else 6)
    assert gzip.decompress(packed) == data
    wanted = data.split(b"\n")
    wanted = wanted[:-1] if not wanted[-1] else wanted
    for step in (1 << 30, 50_000, 4_097, 700, 90):
        found = []
        for start in range(0, len(packed), step):
            found += blockgzip.range_lines(io.BytesIO(packed), len(packed), start, start + step)
        assert found == wanted, step


def test_broken_blocks_are_an_error():
    packed = bytearray(in_blocks(b"a line\n" * 5_000, [10_000] * 4))
    packed[len(packed) // 2] ^= 0xFF
    with pytest.raises(ValueError, match="broken"):
        list(blockgzip.range_lines(io.BytesIO(bytes(packed)), len(packed), 0, len(packed)))


def test_block_gzip_variants_are_read_by_many_tasks(spark, tmp_path):
    body = "".join(f"chr{i % 22}\t{i}\trs{i}\tA\tT\t{i % 99}\tPASS\tGENE=G{i}\n" for i in range(4_000))
    text = ("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n" + body).encode()
    (tmp_path / "v.vcf.bgz").write_bytes(in_blocks(text, [6_000] * (len(text) // 6_000 + 1)))
    (tmp_path / "w.vcf.gz").write_bytes(gzip.compress(text))
    plain = tmp_path / "u.vcf"
    plain.write_bytes(text)
    wanted = rows(vcf.scan_vcf(spark, str(plain)).drop("ingestion_timestamp"))
    assert len(wanted) == 4_000
    for name in ("v.vcf.bgz", "w.vcf.gz"):
        for range_bytes in (blockgzip.RANGE_BYTES, 5_000):
            found = vcf.scan_vcf(spark, str(tmp_path / name), range_bytes=range_bytes).drop("ingestion_timestamp")
            assert rows(found) == wanted
    lines = blockgzip.scan_block_gzip(spark, str(tmp_path / "v.vcf.bgz"), 5_000)
    assert lines.select(F.spark_partition_id()).distinct().count() > 3


def test_written_blocks_are_read_back(spark, tmp_path):
    df = spark.range(0, 3_000, 1, 3).selectExpr("IF(id % 50 = 0, NULL, concat('é', repeat('x', id % 90), id)) AS value")
    path = str(tmp_path / "out.bgz")
    blockgzip.write_block_gzip(df, path, ["#head", "#two"], block_bytes=700)
    for file in (tmp_path / "out.bgz").glob("part-*"):
        assert gzip.decompress(file.read_bytes()).startswith(b"#head\n#two\n")
    found = blockgzip.scan_block_gzip(spark, path, 900).where("NOT startswith(value, '#')")
    assert rows(found.select("value")) == rows(df.selectExpr("coalesce(value, '')"))


def test_listing_goes_into_folders_and_passes_over_hidden_names(spark, tmp_path):
    for name in ("a.txt", "sub/b.txt", "sub/deep/c.csv", "_hidden/x.txt", ".h", "k=1/_kept=2/d.txt", "_SUCCESS", "sp ace+%25/e.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name[:1])
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "nothing").mkdir()
    root = f"file:{tmp_path}"
    found = {r["path"].removeprefix(root + "/"): r["length"] for r in listing.list_files(spark, str(tmp_path)).collect()}
    assert found == {"a.txt": 1, "sub/b.txt": 1, "sub/deep/c.csv": 1, "k=1/_kept=2/d.txt": 1, "sp ace+%25/e.txt": 1, "empty.txt": 0}
    assert listing.list_files(spark, f"{tmp_path}/s*", "*.txt").count() == 2
    one = listing.list_files(spark, [f"{tmp_path}/a.txt", f"file://{tmp_path}/sub/b.txt"])
    assert {r["path"] for r in one.collect()} == {f"{root}/a.txt", f"{root}/sub/b.txt"}
    paths = spark.read.text(str(tmp_path / "sp ace+%25")).select(listing.plain_path().alias("p")).distinct().collect()
    assert [r["p"] for r in paths] == [f"{root}/sp ace+%25/e.txt"]
    assert listing.list_files(spark, str(tmp_path / "sp ace+%25")).count() == 1
    with pytest.raises(Exception, match="no-such"):
        listing.list_files(spark, str(tmp_path / "no-such")).collect()


def test_twenty_headers_take_one_scan(spark, tmp_path):
    names = ["a", "b", "c", "d e", "f"]
    wanted = []
    for i in range(20):
        own = names[i % 5 :] + names[: i % 5 if i < 15 else 0]
        (tmp_path / f"{i}.csv").write_text(
            ",".join(own) + "\n" + "".join(",".join(f'"{n},{i}-{k}"' for n in own) + "\n" for k in range(3)) + ("\nshort\n" if i == 3 else "")
        )
        wanted += [tuple(f"{n},{i}-{k}" if n in own else None for n in names) for k in range(3)]
    wanted.append((None, None, None, "short", None))
    (tmp_path / "empty.csv").write_text("")
    found = delimited.scan_csv_by_header(spark, str(tmp_path))
    assert sorted(map(str, rows(found.select(*[f"`{n}`" for n in names])))) == sorted(map(str, wanted))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1


def test_heads_are_found_in_compressed_files(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"x,y\r\n1,2\n"))
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    assert rows(delimited.scan_csv_by_header(spark, str(tmp_path)).select("x", "y")) == [("1", "2"), ("4", "3")]
