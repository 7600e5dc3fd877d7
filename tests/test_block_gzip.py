"""Block-gzip files in splits: every line once, whatever the splits, blocks and line ends."""

import gzip
import random
import struct
import zlib

import pytest

from helixframe.sources import bgzf, files


def block(text: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = z.compress(text) + z.flush()
    return struct.pack("<4sIBBH2sHH", b"\x1f\x8b\x08\x04", 0, 0, 255, 6, b"BC", 2, len(data) + 25) + data + struct.pack("<II", zlib.crc32(text), len(text))


def blocked(text: bytes, r: random.Random, most: int) -> bytes:
    out, at = [], 0
    while at < len(text):
        n = r.randrange(1, most)
        out.append(block(text[at : at + n]))
        at += n
    return b"".join(out) + block(b"")


def text_of(r: random.Random, n: int) -> bytes:
    lines = [bytes(r.choices(b"ACGT\t01|.\xc3", k=r.choice((0, 1, 5, 80, 3000)))).decode("utf-8", "replace").encode() for _ in range(n)]
    return b"\n".join(lines) + r.choice((b"", b"\n"))


@pytest.mark.parametrize("seed", range(12))
def test_every_line_once(tmp_path, seed):
    r = random.Random(seed)
    text = text_of(r, 300)
    if seed % 3 == 0:  # stored blocks that look like headers of blocks
        text = text.replace(b"ACG", b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00")
    data = blocked(text, r, r.choice((40, 700, 60_000)))
    path = tmp_path / "x.bgz"
    path.write_bytes(data)
    want = text.split(b"\n")
    want = want if want[-1] else want[:-1]
    for split in (1 << 20, 5000, 601, 97):
        got = []
        for lo in range(0, len(data), split):
            for lines in bgzf.split_lines(f"file:{path}", len(data), lo, min(lo + split, len(data))):
                got += lines
        assert got == want


def test_tables_of_blocks_members_and_nothing(spark, tmp_path):
    r = random.Random(3)
    text = "\n".join(f"chr1\t{i}\t{'x' * r.randrange(90)}" for i in range(5000))
    (tmp_path / "a.bgz").write_bytes(blocked(text.encode(), r, 3000))
    (tmp_path / "b.bgz").write_bytes(gzip.compress(text[:9000].encode()) + gzip.compress(text[9000:].encode()))
    (tmp_path / "c.bgz").write_bytes(b"")
    paths = files.expand(spark, f"file://{tmp_path}/*.bgz")
    lines = files.read_lines(spark, paths, split=4096)
    assert lines.rdd.getNumPartitions() > 10
    got = {}
    for x in lines.collect():
        got.setdefault(x.file_path.rsplit("/", 1)[1], []).append(x.value)
    assert got == {"a.bgz": text.split("\n"), "b.bgz": text.split("\n")}
    assert {x.file_path for x in lines.collect()} <= {x.path for x in spark.read.format("binaryFile").load(paths).select("path").collect()}


def test_broken_files_are_errors(tmp_path):
    data = blocked(b"a line\n" * 5000, random.Random(1), 2000)
    path = tmp_path / "x.bgz"
    path.write_bytes(data[:-40])
    with pytest.raises((ValueError, zlib.error)):
        list(bgzf.split_lines(f"file:{path}", len(data) - 40, 0, len(data) - 40))
