"""Files of many folders, listed and opened inside tasks.

Paths are dealt over tasks; each lists its share and hands sub-folders on to other
tasks. Neither names nor contents pass through the driver. Files are opened through
Arrow's file systems; ``knows`` tells beforehand whether a path's scheme is one of theirs.
"""

from __future__ import annotations

import bz2
import fnmatch
import gzip
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.workspace import glob_paths, qualified

# Tasks get these functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LISTED = pa.schema([("path", pa.string()), ("length", pa.int64()), ("is_folder", pa.bool_())])
_LISTED_SQL = "path string, length bigint, is_folder boolean"
_GLOB = re.compile(r"[*?\[{]")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path's name in it; ``file:`` and plain paths are local."""
    scheme = re.match(r"([A-Za-z][\w+.-]*):", path)
    if scheme is None or scheme[1] == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    known = re.sub("^s3[an]:", "s3:", path)
    return fs.FileSystem.from_uri(quote(known, safe=":/@=&?#"))


def knows(path: str) -> bool:
    try:
        opened(path)
    except (pa.ArrowInvalid, OSError, NotImplementedError):
        return False
    return True


def roots(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Full paths; globs are resolved."""
    found = []
    for one in [path] if isinstance(path, str) else path:
        if _GLOB.search(one):
            found += glob_paths(spark, one)
        else:
            found.append(qualified(spark, one))
    return [re.sub("^file:/+", "file:/", p) for p in found]


def plain_path(file_path: Column | str = "_metadata.file_path") -> Column:
    """Spark's path of a file (escaped as in URLs, where only a plus sign stands for itself) as ``list_files`` has it."""
    column = F.col(file_path) if isinstance(file_path, str) else file_path
    return F.regexp_replace(F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _hidden(name: str) -> bool:
    """What Spark's own listings pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _inside(path: str, recursive: bool) -> Iterator[tuple[str, int, bool]]:
    system, own = opened(path)
    start = system.get_file_info(own)
    if start.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if start.type == fs.FileType.File:
        yield path, start.size, False
        return
    for info in system.get_file_info(fs.FileSelector(own, recursive=recursive)):
        below = info.path[len(own.rstrip("/")) :].strip("/")
        if any(_hidden(part) for part in below.split("/")):
            continue
        if info.type == fs.FileType.File:
            yield f"{path.rstrip('/')}/{below}", info.size, False
        elif not recursive:
            yield f"{path.rstrip('/')}/{below}", None, True


def _lister(recursive: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(_inside(row["path"], recursive)) if row["is_folder"] else [tuple(row.values())]
                columns = list(zip(*found, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTED, strict=True)], schema=_LISTED)

    return run


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt over as many tasks as the session shuffles into.

    The number is given, since adaptive execution would put rows as short as file names into one task.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(parts, *columns)


def list_files(spark: SparkSession, path: str | Sequence[str], name_filter: str | None = None) -> DataFrame:
    """(path, length) of every file under the paths, empty ones too; names that begin with a dot or underscore are left out."""
    start = spark.createDataFrame([(r, None, True) for r in roots(spark, path)], _LISTED_SQL)
    first = start.mapInArrow(_lister(False), _LISTED_SQL)
    # Folders at the first level go to other tasks, which list them to the bottom.
    listed = dealt(first, "path").mapInArrow(_lister(True), _LISTED_SQL).select("path", "length")
    if name_filter:
        pattern = fnmatch.translate(name_filter).removesuffix(r"\z").removesuffix(r"\Z") + "$"
        listed = listed.where(F.element_at(F.split("path", "/"), -1).rlike(f"^{pattern}"))
    return listed


def present(spark: SparkSession, folders: Sequence[str], name_filter: str | None = None) -> set[str]:
    """Those of the given folders that exist or, with a filter, hold a file of such a name.

    They are looked up in tasks, all at once; only where Arrow does not know a scheme, one after the other.
    """
    wanted = {full: given for given in folders for full in [roots(spark, given)[0] if not _GLOB.search(given) else given]}
    plain = {full: given for full, given in wanted.items() if not _GLOB.search(full) and knows(full)}
    found = {
        given for full, given in wanted.items()
        if full not in plain and glob_paths(spark, f"{full.rstrip('/')}/{name_filter}" if name_filter else full)
    }
    if not plain:
        return found
    pattern = None if name_filter is None else re.compile(fnmatch.translate(name_filter))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for path in batch.column("path").to_pylist():
                system, own = opened(path)
                if system.get_file_info(own).type == fs.FileType.NotFound:
                    continue
                if pattern is None or any(
                    pattern.match(info.base_name) for info in system.get_file_info(fs.FileSelector(own))
                ):
                    kept.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], names=["path"])

    asked = dealt(spark.createDataFrame([(p,) for p in plain], "path string"), "path") if len(plain) > 1 else (
        spark.createDataFrame([(p,) for p in plain], "path string").coalesce(1)
    )
    return found | {plain[r["path"]] for r in asked.mapInArrow(run, "path string").collect()}


def _lines(path: str) -> Iterator[str]:
    """Lines of a text file, read only as far as they are asked for; unpacked by the file's extension or first bytes."""
    system, own = opened(path)
    with system.open_input_file(own) as raw:
        mark = raw.read(2)
        raw.seek(0)
        if path.endswith((".gz", ".bgz")) or mark == b"\x1f\x8b":
            stream = gzip.GzipFile(fileobj=raw)
        elif path.endswith(".bz2"):
            stream = bz2.BZ2File(raw)
        elif path.endswith(".zst"):
            stream = pa.CompressedInputStream(raw, "zstd")
        else:
            stream = raw
        left = b""
        while block := stream.read(1 << 16):
            *lines, left = (left + block).split(b"\n")
            yield from (line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines)
        if left:
            yield left.removesuffix(b"\r").decode("utf-8", "replace")


def file_heads(
    spark: SparkSession, path: str | Sequence[str], pick: Callable[[Iterator[str]], str | None]
) -> DataFrame:
    """(file, value): what ``pick`` takes from the first lines of every file; files of which it takes nothing are left out."""
    layout = pa.schema([("file", pa.string()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("path").to_pylist()
            heads = [pick(_lines(name)) for name in names]
            kept = [(n, h) for n, h in zip(names, heads, strict=True) if h is not None]
            columns = list(zip(*kept, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], schema=layout)

    files = list_files(spark, path).where("length > 0")
    return dealt(files.select("path"), "path").mapInArrow(run, "file string, value string")
