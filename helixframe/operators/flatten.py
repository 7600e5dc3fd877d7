"""One row for each call: the layout for sample lookups, and flattened views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_sample(variants: DataFrame) -> DataFrame:
    """call becomes one struct a row, sample_id stands before it; variants without calls have no row."""
    at = variants.columns.index("call")
    before, after = variants.columns[:at], variants.columns[at + 1 :]
    x = variants.withColumn("_call", F.explode("call"))
    return x.select(*before, F.col("_call.sample_id").alias("sample_id"), F.col("_call").alias("call"), *after)


def full(variants: DataFrame) -> DataFrame:
    """A row for each call and alternate; alternates by position, kept where a genotype is it, reference or missing."""
    calls = variants.withColumn("c", F.explode("call"))
    alts = calls.select("*", F.posexplode_outer("alternate_bases").alias("off", "alts"))
    g = F.explode_outer("c.genotype").alias("g")
    rows = alts.select("*", g).where(F.col("g").isin(0, -1) | (F.col("g") == F.col("off") + 1))
    return rows.select("reference_name", "start_position", "end_position", "reference_bases", F.col("alts.alt").alias("alt"), F.array_join("names", " ").alias("names"), "quality", F.array_join("filter", " ").alias("filter"), F.col("c.sample_id").alias("sample_id"), F.col("g").alias("genotype"))
