"""Input files: patterns, compression, headers of each file, block-gzip, and size estimates."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import header
from helixframe.sources import bgzf, vcf

HEADER_BYTES = 64 << 20


def expand(spark: SparkSession, pattern: str | None = None, list_file: str | None = None) -> list[str]:
    """The files of a pattern, or of all patterns in a file of one a line; none at all is an error."""
    if (pattern is None) == (list_file is None):
        raise ValueError("give either a pattern or a file of patterns")
    patterns = [pattern] if pattern else [r.value.strip() for r in spark.read.text(list_file).collect() if r.value.strip()]
    jvm, found = spark.sparkContext._jvm, []
    for p in patterns:
        path = jvm.org.apache.hadoop.fs.Path(p)
        hits = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        found += [x.getPath().toString() for x in hits or [] if x.isFile()]
    if not found:
        raise ValueError(f"no file matches {patterns}")
    return sorted(dict.fromkeys(found))


def compression(paths: list[str]) -> str:
    """gzip, or none; files of both kinds together are an error."""
    kinds = {"gzip" if p.endswith((".gz", ".bgz")) else "bzip2" if p.endswith(".bz2") else "none" for p in paths}
    if len(kinds) > 1:
        raise ValueError(f"all files must be of one compression, not of {sorted(kinds)}")
    return kinds.pop()


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of block-gzip files: member after member, some of the text at a time."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            data, rest, name = memoryview(content.as_buffer()), b"", path.as_py()
            while len(data):
                z = zlib.decompressobj(31)
                lines = (rest + z.decompress(data)).split(b"\n")
                data, rest = memoryview(z.unused_data), lines.pop()
                if lines:
                    yield pa.RecordBatch.from_pydict({"value": pa.array([x.rstrip(b"\r").decode("utf-8", "replace") for x in lines]), "file_path": pa.array([name] * len(lines))})
            if rest:
                yield pa.RecordBatch.from_pydict({"value": pa.array([rest.decode("utf-8", "replace")]), "file_path": pa.array([name])})


def _sizes(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    jvm, out = spark.sparkContext._jvm, []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((status.getPath().toString(), status.getLen()))
    return out


def read_lines(spark: SparkSession, paths: list[str], split: int = bgzf.SPLIT) -> DataFrame:
    """(value, file_path) of all lines. `.bgz` is read in splits of this many bytes where tasks can open its file system
    themselves; elsewhere a file a task, up to 2 GB (rename it `.gz` and Hadoop's codec has no such bound)."""
    compression(paths)
    blocks = [p for p in paths if p.endswith(".bgz")]
    rest = [p for p in paths if not p.endswith(".bgz")]
    parts = [vcf.read_lines(spark, rest)] if rest else []
    if blocks and all(map(bgzf.readable, blocks)):
        parts.append(bgzf.read_lines(spark, _sizes(spark, blocks), split))
    elif blocks:
        parts.append(spark.read.format("binaryFile").load(blocks).select("path", "content").mapInArrow(_members, "value string, file_path string"))
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def headers(lines: DataFrame) -> dict[str, header.Header]:
    """file_path -> its header. Header lines are few beside the data; a limit guards the driver."""
    rows = vcf.header_lines(lines)
    size = rows.agg(F.sum(F.length("value"))).first()[0] or 0
    if size > HEADER_BYTES:
        raise ValueError(f"header lines of {size} characters: give one representative header file instead")
    by: dict[str, list[str]] = {}
    for r in rows.collect():
        by.setdefault(r.file_path, []).append(r.value)
    return {p: header.parse(x) for p, x in by.items()}


def estimates(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file: bytes, samples and about how many variants: what follows the header, by the first record's length.

    One pass over the lines, combined before the shuffle; a compressed file counts double its size.
    """
    size = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file_path"), F.col("length").alias("bytes"))
    lines = read_lines(spark, paths).where(F.col("value") != "")
    head = F.col("value").startswith("#")
    width = F.when(F.col("value").startswith("#CHROM"), F.greatest(F.size(F.split("value", "\t")) - 9, F.lit(0)))
    own = lines.groupBy("file_path").agg(F.sum(F.when(head, F.octet_length("value") + 1)).alias("header"), F.max(width).alias("samples"), F.first(F.when(~head, F.octet_length("value") + 1), ignorenulls=True).alias("line"))
    full = F.col("bytes") * F.when(F.col("file_path").rlike(r"\.(gz|bgz|bz2)$"), 2).otherwise(1)
    return size.join(own, "file_path").select("file_path", "bytes", "samples", F.coalesce(F.floor((full - F.coalesce("header", F.lit(0))) / F.col("line")), F.lit(0)).alias("variants"))
