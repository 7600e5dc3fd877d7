"""Shards: a bounded table of genomic intervals, the interval lookup, range buckets and pruning predicates."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_SHARDS, MOST_REGIONS, MOST_BUCKETS = 100, 64, 3999
END_OF_REFERENCE = (1 << 63) - 1


@dataclass(frozen=True)
class Region:
    reference: str
    start: int = 0
    end: int = END_OF_REFERENCE


@dataclass(frozen=True)
class Shard:
    suffix: str
    regions: tuple[Region, ...]
    range_end: int
    residual: bool = False


def parse_region(text: str) -> Region:
    """ref, or ref:start-end with thousands separators; the reference may itself hold colons."""
    m = re.fullmatch(r"(.+):([0-9][0-9,]*)-([0-9][0-9,]*)", text.strip())
    if not m:
        return Region(text.strip())
    start, end = (int(x.replace(",", "")) for x in m.groups()[1:])
    if end <= start:
        raise ValueError(f"the end must be after the start: {text}")
    return Region(m[1], start, end)


def parse_shards(config: list[dict]) -> list[Shard]:
    """The documents of a sharding file, validated."""
    shards: list[Shard] = []
    if len(config) > MOST_SHARDS:
        raise ValueError(f"at most {MOST_SHARDS} shards")
    for item in config:
        x = item["output_table"]
        names = [str(r) for r in x["regions"]]
        if not 0 < len(names) <= MOST_REGIONS:
            raise ValueError(f"1 to {MOST_REGIONS} regions for a shard")
        if not re.fullmatch(r"[A-Za-z0-9_]*", x["table_name_suffix"]) or x["partition_range_end"] <= 0:
            raise ValueError(f"bad suffix or range end: {x}")
        residual = names == ["residual"]
        if "residual" in names and not residual:
            raise ValueError("a residual shard has no other regions")
        shards.append(Shard(x["table_name_suffix"], () if residual else tuple(map(parse_region, names)), int(x["partition_range_end"]), residual))
    if len({s.suffix for s in shards}) < len(shards) or sum(s.residual for s in shards) > 1:
        raise ValueError("suffixes must be unique, and at most one shard is residual")
    by: dict[str, list[Region]] = {}
    for r in (r for s in shards for r in s.regions):
        by.setdefault(r.reference, []).append(r)
    for regions in by.values():
        regions.sort(key=lambda r: r.start)
        if any(a.end > b.start for a, b in zip(regions, regions[1:], strict=False)):
            raise ValueError(f"regions overlap: {regions}")
    return shards


#: Fixed values of the published human sharding: the end of the range of each chromosome, and of the rest.
HUMAN = """
chr1 249,240,615
chr2 243,189,284
chr3 198,233,091
chr4 191,044,274
chr5 181,478,212
chr6 171,053,767
chr7 159,335,971
chr8 146,303,973
chr9 141,149,922
chr10 135,524,745
chr11 135,076,620
chr12 133,841,700
chr13 115,109,876
chr14 107,289,538
chr15 102,521,390
chr16 90,294,745
chr17 83,247,376
chr18 80,263,277
chr19 59,118,975
chr20 64,334,162
chr21 48,119,890
chr22 51,244,528
chrX 156,030,808
chrY 57,227,415
residual 249,240,615
"""


def human_shards() -> list[Shard]:
    """The default: a shard for each human chromosome, named with or without chr, and one for the rest."""
    out = []
    for line in HUMAN.strip().splitlines():
        name, end = line.split()
        regions = [name] if name == "residual" else [name, name.removeprefix("chr")]
        out.append({"output_table": {"table_name_suffix": name, "regions": regions, "partition_range_end": int(end.replace(",", ""))}})
    return parse_shards(out)


def load_shards(spark: SparkSession, path: str) -> list[Shard]:
    """A sharding file in YAML, read by Spark, so that it may be in any store; numbers may have thousands separators."""
    import yaml

    config = yaml.safe_load("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()))
    if not isinstance(config, list):
        raise ValueError("a sharding file is a list of output tables")
    for item in config:
        x = item.get("output_table") if isinstance(item, dict) else None
        if not isinstance(x, dict) or not {"table_name_suffix", "regions", "partition_range_end"} <= x.keys():
            raise ValueError(f"an output table needs a suffix, regions and a range end: {item}")
        x["partition_range_end"] = int(str(x["partition_range_end"]).replace(",", ""))
        x["table_name_suffix"] = str(x["table_name_suffix"])
    return parse_shards(config)


def bucket_width(range_end: int) -> int:
    """The width of one of MOST_BUCKETS range buckets up to range_end, with room to spare, in steps of ten."""
    if range_end >= END_OF_REFERENCE - 10**5:
        return END_OF_REFERENCE // MOST_BUCKETS
    room = -(-(range_end + 10**4) // 10**4) * 10**4
    return -(-room // (MOST_BUCKETS * 10)) * 10


def shard_table(spark: SparkSession, shards: list[Shard]) -> DataFrame:
    rows = [(i, s.suffix, r.reference, r.start, r.end, bucket_width(s.range_end)) for i, s in enumerate(shards) for r in s.regions]
    return spark.createDataFrame(rows, "shard int, suffix string, reference string, lo long, hi long, width long")


def route(variants: DataFrame, shards: list[Shard]) -> DataFrame:
    """Adds shard suffix and bucket. Point in interval against a table of at most MOST_SHARDS x MOST_REGIONS rows,
    which is why it may be broadcast. Rows of no shard go to the residual one, or go if there is none."""
    table = shard_table(variants.sparkSession, shards)
    at = (F.col("reference_name") == F.col("reference")) & (F.col("start_position") >= F.col("lo")) & (F.col("start_position") < F.col("hi"))
    rest = next((s for s in shards if s.residual), None)
    out = variants.join(F.broadcast(table), at, "left" if rest else "inner")
    suffix, width = F.col("suffix"), F.col("width")
    if rest:
        suffix, width = F.coalesce(suffix, F.lit(rest.suffix)), F.coalesce(width, F.lit(bucket_width(rest.range_end)))
    bucket = F.least(F.floor(F.col("start_position") / width), F.lit(MOST_BUCKETS)).cast("int")
    return out.withColumn("bucket", bucket).withColumn("suffix", suffix).drop("shard", "reference", "lo", "hi", "width").withColumnRenamed("suffix", "shard")


def region_filter(regions: list[Region]) -> Column:
    """Rows contained in one of the regions."""
    each = [(F.col("reference_name") == r.reference) & (F.col("start_position") >= r.start) & (F.col("end_position") <= r.end) for r in regions]
    return reduce(lambda a, b: a | b, each) if each else F.lit(True)


def bucket_filter(regions: list[Region], width: int) -> Column:
    """The same region on the bucket folders, so that only their files are listed and read."""
    each = [F.col("bucket").between(min(r.start // width, MOST_BUCKETS), min(max(r.end - 1, r.start) // width, MOST_BUCKETS)) for r in regions]
    return reduce(lambda a, b: a | b, each) if each else F.lit(True)


def write_table(variants: DataFrame, path: str, mode: str = "error") -> None:
    """Folders by shard and bucket, rows in files by position: one shuffle that spreads each bucket by its rows."""
    spread = variants.repartitionByRange("shard", "bucket", "start_position")
    spread.sortWithinPartitions("shard", "bucket", "start_position", "end_position").write.mode(mode).partitionBy("shard", "bucket").parquet(path)


def shards_of(region: Region, shards: list[Shard]) -> list[Shard]:
    """The shards that may hold rows that lie in a region: those that overlap it, and the residual one if they don't cover it."""
    own = [(r, s) for s in shards for r in s.regions if r.reference == region.reference and r.start < region.end and region.start < r.end]
    at = region.start
    for r, _ in sorted(own, key=lambda x: x[0].start):
        at = max(at, r.end) if r.start <= at else at
    rest = [s for s in shards if s.residual] if at < region.end else []
    return list(dict.fromkeys(s for _, s in own)) + rest


def read_regions(spark: SparkSession, path: str, regions: list[Region], shards: list[Shard], schema: T.StructType | None = None) -> DataFrame:
    """Rows of a table of `write_table` that lie in one of the regions. Only files of their shards and buckets are read.

    schema: the table's own, where appends made it wider than that of its first files.
    """
    table = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    each = []
    for r in regions:
        for s in shards_of(r, shards):
            each.append((F.col("shard") == s.suffix) & bucket_filter([r], bucket_width(s.range_end)))
    folders = reduce(lambda a, b: a | b, each) if each else F.lit(False)
    return (table.where(folders) if regions else table).where(region_filter(regions))
