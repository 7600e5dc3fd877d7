"""Merging records of one variant from many files: calls move together, other columns are combined."""

from __future__ import annotations

import re
from abc import ABC, abstractmethod
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ("reference_name", "start_position", "end_position", "reference_bases")
FIXED = {*KEY, "alternate_bases", "names", "quality", "filter", "call"}


def _union(column: str):
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(F.col(column), F.array().cast("array<string>"))))))


def _to_calls(t: T.StructType, info_to_calls: str | None, copy_quality: bool, copy_filter: bool, extra_keys: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """The info columns that move into calls, and all that calls get; a name that calls have already is an error."""
    moved = [c for c in t.names if c not in FIXED and c not in extra_keys and info_to_calls and re.match(info_to_calls, c)]
    extra = moved + ["quality"] * copy_quality + ["filter"] * copy_filter
    if clash := sorted(set(t["call"].dataType.elementType.names) & set(extra)):
        raise ValueError(f"calls have these columns already: {clash}")
    return moved, extra


def move_to_calls(variants: DataFrame, info_to_calls: str | None = None, copy_quality: bool = False, copy_filter: bool = False, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """One row for each (reference, start, end, REF, ALTs): best quality, sorted union of names and filters, all calls.

    Info columns whose name matches `info_to_calls` (from the start) move into each call; quality and filter may be
    copied there. Of other info columns the greatest tuple of all of them stays, so the result is deterministic.
    A group is one variant site, whose calls are the row the model asks for. extra_keys: more columns to group by.
    """
    moved, extra = _to_calls(variants.schema, info_to_calls, copy_quality, copy_filter, extra_keys)
    own = variants.schema["call"].dataType.elementType.names
    rest = [c for c in variants.columns if c not in FIXED and c not in extra_keys and c not in moved]
    df = variants
    if extra:
        df = df.withColumn("call", F.transform("call", lambda c: F.struct(*[c[f].alias(f) for f in own], *[F.col(e).alias(e) for e in extra])))
    alts = F.transform("alternate_bases", lambda a: a["alt"]) if isinstance(df.schema["alternate_bases"].dataType.elementType, T.StructType) else F.col("alternate_bases")
    kept = F.struct(F.to_json(F.struct(*[F.col(c) for c in ("alternate_bases", *rest)])).alias("order"), F.col("alternate_bases"), *[F.col(c) for c in rest])
    out = df.withColumn("_alts", alts).withColumn("_kept", kept).groupBy(*KEY, *extra_keys, "_alts").agg(
        F.max_by("_kept", F.col("_kept")["order"]).alias("_kept"), _union("names").alias("names"), F.max("quality").alias("quality"), _union("filter").alias("filter"), F.array_sort(F.flatten(F.collect_list("call"))).alias("call")
    )
    return out.select(*KEY, *extra_keys, F.col("_kept.alternate_bases").alias("alternate_bases"), "names", "quality", "filter", "call", *[F.col("_kept")[c].alias(c) for c in rest])


class MergeStrategy(ABC):
    """How an import turns rows of one variant into one. A strategy of one's own goes to `cli.run_import`."""

    @abstractmethod
    def merge(self, variants: DataFrame) -> DataFrame:
        """The merged rows."""

    @abstractmethod
    def schema(self, table: T.StructType) -> T.StructType:
        """The schema that merged rows of such a table have, without reading any."""


@dataclass(frozen=True)
class MoveToCalls(MergeStrategy):
    info_to_calls: str | None = None
    copy_quality: bool = False
    copy_filter: bool = False

    def merge(self, variants: DataFrame) -> DataFrame:
        return move_to_calls(variants, self.info_to_calls, self.copy_quality, self.copy_filter)

    def schema(self, table: T.StructType) -> T.StructType:
        moved, extra = _to_calls(table, self.info_to_calls, self.copy_quality, self.copy_filter)
        call = T.StructType([*table["call"].dataType.elementType.fields, *[table[e] for e in extra]])
        first = [*KEY, "alternate_bases", "names", "quality", "filter", "call"]
        rest = [c for c in table.names if c not in FIXED and c not in moved]
        return T.StructType([T.StructField(c, T.ArrayType(call)) if c == "call" else table[c] for c in first + rest])


def merge_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The union of two table schemas for an append; a change of type or repetition is an error."""
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in fields:
            a, b = fields[f.name].dataType, f.dataType
            if isinstance(a, T.ArrayType) != isinstance(b, T.ArrayType):
                raise ValueError(f"{f.name} changes between one value and many")
            x, y = (a.elementType, b.elementType) if isinstance(a, T.ArrayType) else (a, b)
            if isinstance(x, T.StructType) and isinstance(y, T.StructType):
                z: T.DataType = merge_schema(x, y)
            elif x == y:
                z = x
            else:
                raise ValueError(f"{f.name} changes from {x.simpleString()} to {y.simpleString()}")
            fields[f.name] = T.StructField(f.name, T.ArrayType(z) if isinstance(a, T.ArrayType) else z, True)
        else:
            fields[f.name] = f
    return T.StructType(list(fields.values()))
