"""Merging variant records with the non-variant intervals (reference blocks) that cover them.

Work is dealt by (reference, window); a record that reaches over windows is cut at their borders, so a key holds at
most `window` positions and an equality join carries every overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators import merge

WINDOW = 2500
AT = ("reference_name", "_w")
#: Alternates that stand for "no variant here"; fixed values of the format.
NON_VARIANT = ("<*>", "<NON_REF>")


def _alts(df: DataFrame) -> Column:
    nested = isinstance(df.schema["alternate_bases"].dataType.elementType, T.StructType)
    return F.transform("alternate_bases", lambda a: a["alt"]) if nested else F.col("alternate_bases")


def is_non_variant(df: DataFrame) -> Column:
    alts = F.coalesce(_alts(df), F.array().cast("array<string>"))
    return (F.size(alts) == 0) | ((F.size(alts) == 1) & F.coalesce(F.get(alts, F.lit(0)).isin(*NON_VARIANT), F.lit(False)))


def into_windows(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row for each window that the record touches, its interval cut to the window."""
    first = F.floor(F.col("start_position") / window)
    last = F.greatest(first, F.floor((F.col("end_position") - 1) / window))
    x = df.withColumn("_w", F.explode(F.sequence(first, last)))
    return x.withColumn("start_position", F.greatest("start_position", F.col("_w") * window)).withColumn("end_position", F.least("end_position", (F.col("_w") + 1) * window))


def segments(blocks: DataFrame) -> DataFrame:
    """Blocks cut at every start and end of their window: least quality, sorted union of names and filters, all calls."""
    # A window's cuts are at most its positions; a block finds its own among them, so rows are those of the result.
    cuts = blocks.select(*AT, F.explode(F.array("start_position", "end_position")).alias("cut")).groupBy(*AT).agg(F.array_sort(F.collect_set("cut")).alias("cuts"))
    at = F.array_position("cuts", F.col("start_position")).cast("int")
    n = F.greatest(F.array_position("cuts", F.col("end_position")).cast("int") - at, F.lit(0))
    pieces = F.arrays_zip(F.slice("cuts", at, n).alias("lo"), F.slice("cuts", at + 1, n).alias("hi"))
    x = blocks.join(cuts, [*AT]).withColumn("_piece", F.explode(pieces)).withColumns({"lo": F.col("_piece.lo"), "hi": F.col("_piece.hi")})
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(F.col(c), F.array().cast("array<string>"))))))
    return x.groupBy(*AT, "lo", "hi").agg(F.min("quality").alias("quality"), union("names").alias("names"), union("filter").alias("filter"), F.array_sort(F.flatten(F.collect_list("call"))).alias("call"))


def uncovered(parts: DataFrame, spans: DataFrame) -> DataFrame:
    """What is left of the segments outside the spans (start, end): overlapping and touching spans are one."""
    by = Window.partitionBy(*AT).orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    x = spans.withColumn("new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)).withColumn("island", F.sum("new").over(by))
    x = x.groupBy(*AT, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    x = x.groupBy(*AT).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))  # at most a window's positions
    y = parts.join(x, [*AT], "left").withColumn("cuts", F.filter(F.coalesce("cuts", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda c: (c["start"] < F.col("hi")) & (c["end"] > F.col("lo"))))
    los = F.concat(F.array("lo"), F.transform("cuts", lambda c: c["end"]))
    his = F.concat(F.transform("cuts", lambda c: c["start"]), F.array("hi"))
    pieces = F.filter(F.transform(los, lambda a, i: F.struct(a.alias("lo"), F.get(his, i).alias("hi"))), lambda p: p["lo"] < p["hi"])
    return y.withColumn("p", F.explode(pieces)).withColumn("lo", F.col("p.lo")).withColumn("hi", F.col("p.hi")).drop("p", "cuts")


def merge_with_blocks(variants: DataFrame, window: int = WINDOW, info_to_calls: str | None = None, copy_quality: bool = False, copy_filter: bool = False) -> DataFrame:
    """Variants merged as `merge.move_to_calls` does, each with the calls of the leftmost block segment that overlaps it;
    then what of the blocks no such variant covers.

    Block rows have no REF, no alternates and null in other columns. Which segment gives its calls to a variant over
    several of them is fixed as the leftmost, so the result is the same on every run.
    """
    x = into_windows(variants, window)
    call = variants.schema["call"].dataType
    non = is_non_variant(variants)
    sites = merge.move_to_calls(x.where(~non), info_to_calls, copy_quality, copy_filter, extra_keys=("_w",))
    blocks = x.where(non)
    if sites.schema["call"].dataType != call:  # the fields that went into calls
        own, wide = [f.name for f in call.elementType.fields], sites.schema["call"].dataType
        extra = [f.name for f in wide.elementType.fields[len(own) :]]
        blocks = blocks.withColumn("call", F.transform("call", lambda c: F.struct(*[c[f].alias(f) for f in own], *[F.col(e).alias(e) for e in extra])))
    parts = segments(blocks)
    key = F.struct("start_position", "end_position", "reference_bases", _alts(sites))
    sites = sites.withColumn("_key", key)
    over = parts.select(*AT, "lo", "hi", F.col("call").alias("more"))
    hit = sites.select(*AT, "_key", "start_position", "end_position").join(over, [*AT]).where("start_position < hi AND lo < end_position")
    hit = hit.groupBy(*AT, "_key").agg(F.min_by("more", "lo").alias("more"))
    spans = hit.select(*AT, F.col("_key.start_position").alias("start"), F.col("_key.end_position").alias("end")).distinct()
    joined = sites.join(hit, [*AT, "_key"], "left").withColumn("call", F.array_sort(F.concat("call", F.coalesce("more", F.array().cast(sites.schema["call"].dataType))))).drop("_key", "more", "_w")
    rest = uncovered(parts, spans).select("reference_name", F.col("lo").alias("start_position"), F.col("hi").alias("end_position"), F.lit(None).cast("string").alias("reference_bases"), F.array().cast(joined.schema["alternate_bases"].dataType).alias("alternate_bases"), "names", "quality", "filter", "call")
    return joined.unionByName(rest, allowMissingColumns=True)


@dataclass(frozen=True)
class WithBlocks(merge.MoveToCalls):
    """Its rows have the schema of `MoveToCalls`."""

    window: int = WINDOW

    def merge(self, variants: DataFrame) -> DataFrame:
        return merge_with_blocks(variants, self.window, self.info_to_calls, self.copy_quality, self.copy_filter)
