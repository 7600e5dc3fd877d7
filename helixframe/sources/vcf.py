"""VCF text to rows: lines by Spark's text source (plain, gzip, bzip2), tokenised with column expressions only.

A line that can't be read becomes a row with `error` set, all else null. Gzip of many members is read whole, a file a task;
`bgzf` reads `.bgz` files in splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CALLS = "array<struct<name:string,genotype:array<int>,phaseset:string,info:map<string,string>>>"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(value, file_path) of every line."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"))


def header_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").startswith("#"))


def sample_names(lines: DataFrame) -> dict[str, list[str]]:
    """file_path -> the samples of its column line; one row for each file."""
    rows = lines.where(F.col("value").startswith("#CHROM")).select("file_path", F.split("value", "\t").alias("f")).collect()
    return {r.file_path: r.f[9:] for r in rows}


def _list(x: Column, sep: str) -> Column:
    return F.when(x.isNull() | x.isin(".", ""), F.array().cast("array<string>")).otherwise(F.split(x, sep))


def _pairs(info: Column) -> Column:
    """key=value;flag -> map; flags have a null value, a lone dot is no entry; of equal keys the first stays."""
    parts = F.filter(_list(info, ";"), lambda p: p != "")
    keys = F.transform(parts, lambda p: F.substring_index(p, "=", 1))
    firsts = F.filter(F.transform(parts, lambda p, i: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(F.instr(p, "=") > 0, F.expr("NULL")).alias("v"), i.alias("i"), p.alias("p"))), lambda s: F.array_position(keys, s["k"]) == s["i"] + 1)
    return F.map_from_entries(F.transform(firsts, lambda s: F.struct(s["k"], F.when(F.length(s["p"]) > F.length(s["k"]), F.substr(s["p"], F.length(s["k"]) + 2)))))


def _genotype(gt: Column) -> Column:
    return F.when(gt.isNull() | (gt == ""), F.array().cast("array<int>")).otherwise(F.transform(F.split(gt, r"[|/]"), lambda a: F.coalesce(a.try_cast("int"), F.lit(-1))))


def parse(lines: DataFrame, names: list[str] | dict[str, list[str]] | None = None, one_based: bool = False) -> DataFrame:
    """Data lines -> reference_name, start_position, end_position, reference_bases, alternate_bases, names, quality,
    filter, info (map), call (array), error.

    names: the samples of the files' column line, by position, or those of each file by its file_path (`sample_names`);
    without it calls are numbered. END in INFO sets the end
    and leaves the map. A quality of 0 or '.' is null. Genotype dots are -1; a phased call without PS has phaseset '*'.
    """
    # The columns of a line are the one element of an array: filters on them stay above, so neither they nor what a query makes
    # a line of are worked out again for each.
    x = lines.withColumn("f", F.explode(F.array(F.split("value", "\t"))))
    x = x.where(~F.col("f")[0].startswith("#") & ((F.size("f") > 1) | (F.trim(F.col("f")[0]) != "")))
    f = [F.try_element_at("f", F.lit(i + 1)) for i in range(9)]
    pos, info = f[1].try_cast("long"), _pairs(f[7])
    x = x.withColumn("pos", pos).withColumn("all_info", F.explode(F.array(info)))
    last = F.coalesce(F.try_element_at("all_info", F.lit("END")).try_cast("long"), F.col("pos") - 1 + F.length(f[3]))
    bad = F.when(F.size("f") < 8, "too few columns").when(F.col("pos").isNull() | (F.col("pos") < 1), "position").when(last < 0, "end").when((f[5] != ".") & f[5].try_cast("double").isNull(), "quality")
    keys, samples = F.split(f[8], ":"), F.slice("f", F.lit(10), F.greatest(F.size("f") - 9, F.lit(0)))
    each = lambda ns: F.array(*[F.lit(n) for n in ns]).cast("array<string>")
    if isinstance(names, dict):
        known = F.create_map(*[x for path, ns in names.items() for x in (F.lit(path), each(ns))]).cast("map<string,array<string>>")
        who = F.coalesce(F.try_element_at(known, F.col("file_path")), each([]))
    else:
        who = each(names or [])

    def call(s: Column, i: Column) -> Column:
        values = F.split(s, ":")
        both = F.filter(F.transform(keys, lambda k, j: F.struct(k.alias("k"), F.get(values, j).alias("v"))), lambda e: ~e["k"].isin("GT", "PS"))
        get = lambda key: F.get(values, (F.array_position(keys, key) - 1).cast("int"))
        gt = F.when(F.array_position(keys, "GT") > 0, get("GT"))
        ps = F.when(F.array_position(keys, "PS") > 0, F.nullif(get("PS"), F.lit(".")))
        phase = F.coalesce(ps, F.when(F.contains(gt, F.lit("|")), "*"))
        return F.struct(F.coalesce(F.get(who, i), (i + 1).cast("string")).alias("name"), _genotype(gt).alias("genotype"), phase.alias("phaseset"), F.map_from_entries(both).alias("info"))

    ok = bad.isNull()
    source = F.col("file_path") if "file_path" in lines.columns else F.lit(None).cast("string")
    columns = {
        "reference_name": f[0],
        "start_position": F.col("pos") if one_based else F.col("pos") - 1,
        "end_position": last,
        "reference_bases": f[3],
        "alternate_bases": _list(f[4], ","),
        "names": _list(f[2], ";"),
        "quality": F.nullif(f[5].try_cast("double"), F.lit(0.0)),
        "filter": F.when(f[6] != ".", F.split(f[6], ";")),
        "info": F.map_filter("all_info", lambda k, v: k != "END"),
        "call": F.transform(samples, call).cast(CALLS),
    }
    return x.select(*[F.when(ok, c).alias(k) for k, c in columns.items()], F.when(~ok, F.struct(source.alias("file"), F.col("value").alias("line"), bad.alias("reason"))).alias("error"))


def well_formed(rows: DataFrame, references: list[str] | None = None) -> DataFrame:
    out = rows.where("error IS NULL").drop("error")
    return out.where(F.col("reference_name").isin(references)) if references else out


def malformed(rows: DataFrame) -> DataFrame:
    return rows.where("error IS NOT NULL").select("error.*")


def estimate(lines: DataFrame) -> DataFrame:
    """Per file: bytes of text, data lines and samples, in one pass with partial aggregation."""
    data = ~F.col("value").startswith("#")
    columns = F.when(F.col("value").startswith("#CHROM"), F.greatest(F.size(F.split("value", "\t")) - 9, F.lit(0)))
    return lines.groupBy("file_path").agg(F.sum(F.octet_length("value") + 1).alias("bytes"), F.count_if(data).alias("variants"), F.max(columns).alias("samples"))
