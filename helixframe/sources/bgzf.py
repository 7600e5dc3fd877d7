"""Block-gzip text read in splits of a file, without an index.

A block is a gzip member of at most 64 KB that names its own length, so a split finds the first block at or after its
start and owns all blocks that start before its end. As with plain text, a split leaves the first line, whole or not, to
the one before it (the file's first split doesn't) and reads on to the end of its last line. Files whose members don't
name their lengths are read by their first split alone, some of the text at a time.

Tasks read through pyarrow's file systems; `readable` says whether it has one for a path.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SPLIT = 32 << 20
CHUNK = 1 << 20
#: Fixed by the format: the most bytes of a block, the start of its gzip header, the name of the field with its length.
MOST, MAGIC, LENGTH = 1 << 16, b"\x1f\x8b\x08\x04", b"BC"
BATCH_BYTES = 4 << 20


def _file(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def readable(path: str) -> bool:
    try:
        _file(path)
    except (pa.ArrowException, OSError):
        return False
    return True


def _length(data: bytes, at: int) -> int:
    """The length of the block that starts here; 0 if none does."""
    if data[at : at + 4] != MAGIC or len(data) < at + 12:
        return 0
    k, end = at + 12, at + 12 + int.from_bytes(data[at + 10 : at + 12], "little")
    while k + 4 <= min(end, len(data)):
        size = int.from_bytes(data[k + 2 : k + 4], "little")
        if data[k : k + 2] == LENGTH and size == 2 and k + 6 <= len(data):
            return int.from_bytes(data[k + 4 : k + 6], "little") + 1
        k += 4 + size
    return 0


def _first(f: pa.NativeFile, size: int, lo: int) -> int:
    """Where the first block at or after lo starts: its text checks out and another block, or the end, follows."""
    data = f.read_at(min(3 * MOST, size - lo), lo)
    at = data.find(MAGIC)
    while 0 <= at < MOST:
        end = at + _length(data, at)
        if end > at and (lo + end == size or _length(data, end)):
            try:
                zlib.decompress(data[at:end], 31)
            except zlib.error:
                pass
            else:
                return lo + at
        at = data.find(MAGIC, at + 1)
    if size - lo >= MOST:
        raise ValueError(f"no block within {MOST} bytes of {lo}")
    return size


def _blocks(f: pa.NativeFile, size: int, at: int) -> Iterator[tuple[int, bytes]]:
    """(start, text) of every block from this one on."""
    data, base = b"", at
    while at < size:
        if at + MOST > base + len(data) and base + len(data) < size:
            data, base = f.read_at(min(CHUNK, size - at), at), at
        n = _length(data, at - base)
        if not n or at - base + n > len(data):
            raise ValueError(f"no whole block at {at}")
        yield at, zlib.decompress(data[at - base : at - base + n], 31)
        at += n


def _members(f: pa.NativeFile, size: int) -> Iterator[tuple[int, bytes]]:
    """The text of members of any length, as one that starts at 0."""
    z, at = zlib.decompressobj(31), 0
    while at < size:
        data = f.read_at(min(CHUNK, size - at), at)
        at += len(data)
        while data:
            if z.eof:
                z = zlib.decompressobj(31)
            yield 0, z.decompress(data)
            data = z.unused_data
    if size and not z.eof:
        raise ValueError("the last member is not whole")


def split_lines(path: str, size: int, lo: int, hi: int) -> Iterator[list[bytes]]:
    """The lines that the split of a file from lo to hi owns, some at a time."""
    system, name = _file(path)
    with system.open_input_file(name) as f:
        blocked = _length(f.read_at(min(MOST, size), 0), 0) > 0
        if lo and not blocked:
            return
        at = _first(f, size, lo) if lo else 0
        if at >= hi:
            return
        lead, rest = lo > 0, []
        for start, text in _blocks(f, size, at) if blocked else _members(f, size):
            end = text.find(b"\n")
            if start >= hi:
                if lead:  # no line starts in this split
                    return
                rest.append(text[:end] if end >= 0 else text)
                if end >= 0:
                    yield [b"".join(rest)]
                    return
            elif end < 0:
                if not lead:
                    rest.append(text)
            else:
                if lead:
                    lead, text = False, text[end + 1 :]
                *lines, last = (b"".join(rest) + text).split(b"\n")
                rest = [last]
                if lines:
                    yield lines
        if any(rest):
            yield [b"".join(rest)]


def _read(files: list[tuple[str, int]], split: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    firsts = [0, *accumulate(_splits(size, split) for _, size in files)]

    def batch(path: str, lines: list[bytes]) -> pa.RecordBatch:
        texts = pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines], pa.string())
        return pa.RecordBatch.from_arrays([texts, pa.array([path] * len(lines), pa.string())], ["value", "file_path"])

    for ids in batches:
        for k in ids.column(0).to_pylist():
            at = bisect_right(firsts, k) - 1
            path, size = files[at]
            lo, held, n = (k - firsts[at]) * split, [], 0
            for lines in split_lines(path, size, lo, min(lo + split, size)):
                held += lines
                n += sum(map(len, lines))
                if n > BATCH_BYTES:
                    yield batch(path, held)
                    held, n = [], 0
            if held:
                yield batch(path, held)


def _splits(size: int, split: int) -> int:
    return -(-size // split)


def read_lines(spark: SparkSession, files: list[tuple[str, int]], split: int = SPLIT) -> DataFrame:
    """(value, file_path) of the lines of files, given with their sizes; one task a split."""
    files = [x for x in files if x[1]]
    n = sum(_splits(size, split) for _, size in files)
    return spark.range(0, n, 1, max(n, 1)).mapInArrow(partial(_read, files, split), "value string, file_path string")
