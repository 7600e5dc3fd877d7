"""Annotation strings (fields joined by '|', the allele first) attached to the alternates they describe.

Column expressions only. A string that matches no alternate, or more than one in the minimal mode, is left out and
counted by `problems`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETED = "-"
ALLELE_NUMBER = "ALLELE_NUM"
MODES = ("default", "minimal", "allele_num")


def field_names(description: str) -> list[str]:
    """The names in a header description, after the first bar: the field before it is the allele."""
    parts = description.strip().strip('"').split("|")
    if len(parts) < 2:
        raise ValueError(f"no annotation fields in: {description}")
    return [p.strip() for p in parts[1:]]


def _common_prefix(ref: Column, alts: Column) -> Column:
    """The first base where REF and all alternates share it, else ''."""
    first = F.substring(ref, 1, 1)
    return F.when((F.length(ref) > 0) & F.forall(alts, lambda a: F.startswith(a, first) & (F.length(a) > 0)), first).otherwise("")


def _symbolic(alt: Column, allele: Column) -> Column:
    ident, mate = F.regexp_extract(alt, "^<(.*)>$", 1), F.regexp_extract(alt, r"^(.*[\[\]].*):.*[\[\]].*$", 1)
    return ((ident != "") & (ident == allele)) | ((mate != "") & (mate == allele))


def _trimmed(ref: Column, alt: Column) -> Column:
    """ALT without the bases it shares with the front of REF, then with its end."""
    most = F.least(F.length(ref), F.length(alt))
    count = lambda n, same: F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), same))).otherwise(0)
    front = count(most, lambda i: F.substr(alt, F.lit(1), i) == F.substr(ref, F.lit(1), i))
    back = count(most - front, lambda i: F.right(alt, i) == F.right(ref, i))
    return F.substr(alt, front + 1, F.greatest(F.length(alt) - front - back, F.lit(0)))


def matches(ref: Column, alts: Column, parts: Column, names: list[str], mode: str = "default") -> Column:
    """The positions (from 0) of the alternates that an annotation, split into parts, can mean."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    allele = F.get(parts, F.lit(0))
    where = lambda test: F.filter(F.transform(alts, lambda a, i: F.when(test(a), i)), lambda i: i.isNotNull())
    if mode == "allele_num":
        at = F.get(parts, F.lit(names.index(ALLELE_NUMBER) + 1)).try_cast("int") - 1 if ALLELE_NUMBER in names else F.lit(None).cast("int")
        return F.when((at >= 0) & (at < F.size(alts)), F.array(at)).otherwise(F.array().cast("array<int>"))
    if mode == "minimal":
        exact = where(lambda a: _symbolic(a, allele))
        loose = where(lambda a: (allele != "") & (a != "") & ((_trimmed(ref, a) == allele) | ((_trimmed(ref, a) == "") & (allele == DELETED))))
        return F.when(F.size(exact) > 0, F.slice(exact, 1, 1)).otherwise(loose)
    shared = F.length(_common_prefix(ref, alts))
    found = where(lambda a: (F.substr(a, shared + 1) == allele) | ((F.length(a) == shared) & (allele == DELETED)) | _symbolic(a, allele))
    return F.slice(found, 1, 1)


def _alts(variants: DataFrame) -> tuple[Column, list[str]]:
    """The texts of the alternates, and the fields of their structs where they are structs."""
    kind = variants.schema["alternate_bases"].dataType.elementType
    fields = kind.fieldNames() if isinstance(kind, T.StructType) else []
    return F.transform("alternate_bases", lambda a: a["alt"]) if fields else F.col("alternate_bases"), fields


def _parsed(column: str, alts: Column, names: list[str], mode: str) -> Column:
    def one(s: Column) -> Column:
        parts = F.split(s, r"\|", -1)
        return F.struct(s.alias("text"), parts.alias("parts"), matches(F.col("reference_bases"), alts, parts, names, mode).alias("at"), (F.size(parts) == len(names) + 1).alias("whole"))

    return F.transform(F.coalesce(F.split(column, ","), F.array().cast("array<string>")), one)


def attach(variants: DataFrame, column: str, names: list[str], mode: str = "default", types: dict[str, str] | None = None) -> DataFrame:
    """alternate_bases -> array of (alt, column: array of (allele, names...)); `column` is the INFO text. Alternates are
    strings, or structs with an alt, which keep their other fields.

    types: Spark types of fields that aren't text; a value that doesn't fit is null.
    """

    def fields(e: Column) -> Column:
        return F.struct(F.get(e["parts"], F.lit(0)).alias("allele"), *[F.nullif(F.get(e["parts"], F.lit(i + 1)), F.lit("")).try_cast((types or {}).get(n, "string")).alias(n) for i, n in enumerate(names)])

    texts, kept = _alts(variants)
    x = variants.withColumn("_parsed", _parsed(column, texts, names, mode))
    own = lambda i: F.filter("_parsed", lambda e: e["whole"] & (F.size(e["at"]) == 1) & (F.get(e["at"], F.lit(0)) == i))
    alts = F.transform("alternate_bases", lambda a, i: F.struct(*([a[f].alias(f) for f in kept] or [a.alias("alt")]), F.transform(own(i), fields).alias(column)))
    return x.withColumn("alternate_bases", alts).drop("_parsed", column)


def problems(variants: DataFrame, column: str, names: list[str], mode: str = "default") -> DataFrame:
    """One row: variants with annotations, annotations, those without an alternate, ambiguous, of a wrong field count."""
    x = variants.select(_parsed(column, _alts(variants)[0], names, mode).alias("p")).withColumn("n", F.size("p"))
    count = lambda test: F.coalesce(F.sum(F.size(F.filter("p", test)).cast("long")), F.lit(0))
    return x.agg(
        F.count_if(F.col("n") > 0).alias("variants"),
        F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0)).alias("annotations"),
        count(lambda e: F.size(e["at"]) == 0).alias("unmatched"),
        count(lambda e: F.size(e["at"]) > 1).alias("ambiguous"),
        count(lambda e: ~e["whole"]).alias("wrong_width"),
    )


def _allele(ref: Column, alts: Column, alt: Column) -> Column:
    """The allele that the default mode matches to this alternate."""
    shared, ident = F.length(_common_prefix(ref, alts)), F.regexp_extract(alt, "^<(.*)>$", 1)
    return F.when(ident != "", ident).when(F.length(alt) == shared, DELETED).otherwise(F.substr(alt, shared + 1))


def to_text(column: str, names: list[str], alleles: bool = True) -> Column:
    """The inverse of attach for export: all annotations of all alternates, nulls as empty fields; null if there is none.

    alleles: whether the annotations hold their allele; without it, it is made from the alternate.
    """
    alts = F.transform("alternate_bases", lambda a: a["alt"])

    def line(a: Column, e: Column) -> Column:
        allele = e["allele"] if alleles else _allele(F.col("reference_bases"), alts, a["alt"])
        return F.array_join(F.transform(F.array(allele, *[e[n].cast("string") for n in names]), lambda v: F.coalesce(v, F.lit(""))), "|")

    every = F.flatten(F.transform("alternate_bases", lambda a: F.transform(F.coalesce(a[column], F.array()), lambda e: line(a, e))))
    return F.nullif(F.array_join(every, ","), F.lit(""))
