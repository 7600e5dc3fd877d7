"""Samples: the table of sample ids, lookups both ways, and the samples of a set of variants."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.sample_id import sample_id, sample_ids

SCHEMA = "sample_id long, sample_name string, file_path string, ingestion_datetime timestamp"


def sample_table(lines: DataFrame, with_file_path: bool = False) -> DataFrame:
    """A row for each sample of each file's column line; the time is floored to the minute. lines: (value, file_path)."""
    own = lines.where(F.col("value").startswith("#CHROM")).select("file_path", F.explode(F.slice(F.split("value", "\t"), 10, 1 << 30)).alias("sample_name"))
    key = F.concat(F.regexp_replace("file_path", "[^A-Za-z0-9_]", "_"), F.lit("_"), F.col("sample_name")) if with_file_path else F.col("sample_name")
    return own.select(sample_ids(key).alias("sample_id"), "sample_name", "file_path", F.date_trunc("minute", F.current_timestamp()).alias("ingestion_datetime"))


def encoded(name: str, file_path: str) -> str:
    """A name that is unique over files: its id is that of the sample in the file."""
    return re.sub("[^A-Za-z0-9_]", "_", file_path) + "_" + name


def known_ids(names: list[str]) -> dict[str, int]:
    """Published ids of the names in headers."""
    return {n: sample_id(n) for n in dict.fromkeys(names)}


def id_of(known: dict[str, int]):
    """An expression over a call's name for `bind`; a name that isn't known is an error."""
    table = F.create_map(*[x for n, i in known.items() for x in (F.lit(n), F.lit(i).cast("long"))]) if known else F.create_map().cast("map<string,bigint>")

    def of(name: Column) -> Column:
        return F.coalesce(F.try_element_at(table, name), F.raise_error(F.concat(F.lit("unknown sample: "), name)).cast("long"))

    return of


def _looked_up(rows: DataFrame, table: DataFrame, column: str, value: str, what: str) -> DataFrame:
    """rows with `value` of the sample table by `column`; a sample that the table lacks is an error."""
    known = table.select(column, value).distinct()
    out = rows.join(known.withColumn("_known", F.lit(True)), column, "left")
    lost = F.when(F.col("_known").isNull(), F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))).cast("boolean")).otherwise(True)
    return out.where(lost).drop("_known")


def to_names(rows: DataFrame, table: DataFrame) -> DataFrame:
    return _looked_up(rows, table, "sample_id", "sample_name", "no sample of this id")


def to_ids(rows: DataFrame, table: DataFrame) -> DataFrame:
    return _looked_up(rows, table, "sample_name", "sample_id", "no sample of this name")


def combined_ids(variants: DataFrame, preserve_order: bool = False) -> list[int]:
    """The ids of all calls, sorted; or in the variants' own order, which must then be the same everywhere.

    A variant with a sample twice is an error. Samples are the columns of an export, so the driver must hold them.
    """
    ids = F.col("call.sample_id")
    wrong = F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.raise_error(F.lit("a variant has a sample twice")).cast("array<bigint>")).otherwise(ids.cast("array<bigint>"))
    if not preserve_order:
        return sorted(r.i for r in variants.select(F.explode(wrong).alias("i")).distinct().collect())
    found = variants.select(wrong.alias("ids")).distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError("the variants' samples are not the same in the same order; export without preserving the order")
    return list(found[0].ids)
