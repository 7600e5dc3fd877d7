"""Raw rows (info maps of text) bound to the typed table that a header describes, and cleaned values.

Strict: a value that its header type can't hold, a per-alternate list of a wrong length, or a key that the header doesn't
define is an error. Lenient: null, the shorter of both lists, or no column (`header.infer_info` and `infer_format` find
definitions for such keys).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators.header import SPARK, Header

#: Fixed values of the table format: what stands for a missing number in a list, and for infinity.
NULL_NUMBER = -31
LARGEST = sys.float_info.max / 10


def column_name(key: str) -> str:
    out = re.sub(r"[^A-Za-z0-9_]", "_", key)
    return out if re.match(r"[A-Za-z]", out) else f"field_{out}"


def clean(x: Column, kind: T.DataType) -> Column:
    """Infinity as a large number, not-a-number as null."""
    if not isinstance(kind, T.DoubleType):
        return x
    return F.when(F.isnan(x), None).when(x == float("inf"), LARGEST).when(x == float("-inf"), -LARGEST).otherwise(x)


def clean_list(x: Column, kind: T.DataType, missing: float | None = None) -> Column:
    """No null inside: '.' for text, false for flags, the replacement for numbers. All null, or null: empty."""
    blank = "." if isinstance(kind, T.StringType) else False if isinstance(kind, T.BooleanType) else NULL_NUMBER if missing is None else missing
    x = F.transform(x, lambda v: clean(v, kind))
    filled = F.transform(x, lambda v: F.coalesce(v, F.lit(blank).cast(kind)))
    return F.when(x.isNull() | F.forall(x, lambda v: v.isNull()), F.array().cast(T.ArrayType(kind))).otherwise(filled)


def typed(text: Column, kind: T.DataType, what: str, lenient: bool) -> Column:
    """'.' and '' are null. The parser's numbers have six significant digits."""
    text = F.nullif(F.nullif(text, F.lit(".")), F.lit(""))
    if isinstance(kind, T.StringType):
        return text
    out = text.try_cast(kind)
    if isinstance(kind, T.DoubleType):
        out = F.coalesce(text.try_cast(kind), F.when(F.lower(text).isin("inf", "+inf"), float("inf")).when(F.lower(text) == "-inf", float("-inf")).when(F.lower(text) == "nan", float("nan")))
        out = F.when(F.isnan(out) | (F.abs(out) == float("inf")), out).otherwise(F.format_string("%.5e", out).try_cast(kind))
        out = F.when(text.isNotNull(), out)
    elif isinstance(kind, T.LongType):
        out = F.coalesce(out, F.floor(text.try_cast("double")).cast("long")) if lenient else out
    if lenient:
        return out
    return F.when(text.isNotNull() & out.isNull(), F.raise_error(F.concat(F.lit(f"{what} is not {kind.simpleString()}: "), text)).cast(kind)).otherwise(out)


def _value(x: dict[str, str], source: Column, lenient: bool, missing: float | None) -> Column:
    kind, key = SPARK[x["Type"]], F.lit(x["ID"])
    text = F.try_element_at(source, key)
    if isinstance(kind, T.BooleanType):
        return F.array_contains(F.map_keys(source), key)
    if x["Number"] in ("0", "1"):
        first = F.get(F.split(text, ","), F.lit(0)) if not isinstance(kind, T.StringType) else text
        return clean(typed(first if lenient else text, kind, x["ID"], lenient), kind)
    return clean_list(F.transform(F.split(text, ","), lambda v: typed(v, kind, x["ID"], lenient)), kind, missing)


def _defined(info: list[str], form: list[str]) -> Column:
    """True, or an error where a row has an INFO or FORMAT key that isn't in these."""
    known = lambda keys: F.array(*[F.lit(k) for k in keys]).cast("array<string>")
    strange = F.array_except(F.map_keys("info"), known([*info, "END"]))
    calls = F.array_except(F.flatten(F.transform("call", lambda c: F.map_keys(c["info"]))), known([*form, "GT", "PS"]))
    wrong = F.concat(F.coalesce(strange, F.array().cast("array<string>")), F.coalesce(calls, F.array().cast("array<string>")))
    return F.when(F.size(wrong) > 0, F.raise_error(F.concat(F.lit("no such field in the header: "), F.array_join(wrong, ", "))).cast("boolean")).otherwise(True)


def bind(rows: DataFrame, header: Header, lenient: bool = False, split_alternates: bool = True, missing: float | None = None, sample_id: Callable[[Column], Column] | None = None, call_name: bool = True, extra: list[str] | None = None) -> DataFrame:
    """The columns of `header.schema` with the same options.

    sample_id: an expression over a call's name, such as `samples.known_ids` of the headers' names; by default a hash that
    is not the published id. extra: further columns of rows to keep as they are.
    """
    info, form = header.sections["INFO"], header.sections["FORMAT"]
    per = [x for x in info.values() if split_alternates and x["Number"] == "A"]
    rest = [x for k, x in info.items() if k != "END" and not (split_alternates and x["Number"] == "A")]
    listed = {x["ID"]: F.split(F.try_element_at("info", F.lit(x["ID"])), ",") for x in per}

    def at(x: dict[str, str], i: Column) -> Column:
        values, kind = listed[x["ID"]], SPARK[x["Type"]]
        out = clean(typed(F.get(values, i), kind, x["ID"], lenient), kind)
        if lenient:
            return out
        return F.when(values.isNotNull() & (F.size(values) != F.size("alternate_bases")), F.raise_error(F.lit(f"{x['ID']} has not one value for each alternate")).cast(kind)).otherwise(out)

    def one_call(c: Column) -> Column:
        ident = F.pmod(F.xxhash64(c["name"]), F.lit((1 << 63) - 1)) if sample_id is None else sample_id(c["name"])
        fields = [_value(x, c["info"], lenient, missing).alias(column_name(k)) for k, x in form.items() if k not in ("GT", "PS")]
        return F.struct(ident.alias("sample_id"), *[c["name"].alias("name")] * call_name, F.transform(c["genotype"], lambda g: g.cast("long")).alias("genotype"), c["phaseset"].alias("phaseset"), *fields)

    if not lenient:  # a filter, since a column that nothing reads would go with its error
        # Of an array's one element, as else the filter would make both anew.
        once = rows.withColumn("_once", F.explode(F.array(F.struct("info", "call"))))
        rows = once.withColumn("info", F.col("_once.info")).withColumn("call", F.col("_once.call")).drop("_once").where(_defined(list(info), list(form)))
    alts = F.transform("alternate_bases", lambda a, i: F.struct(a.alias("alt"), *[at(x, i).alias(column_name(x["ID"])) for x in per]))
    return rows.select(
        "reference_name", "start_position", "end_position", "reference_bases", alts.alias("alternate_bases"), "names", "quality",
        clean_list(F.col("filter"), T.StringType()).alias("filter"), F.transform("call", one_call).alias("call"),
        *[_value(x, F.col("info"), lenient, missing).alias(column_name(x["ID"])) for x in rest], *(extra or []),
    )


def without_empty_calls(rows: DataFrame) -> DataFrame:
    """Calls go that have no genotype but missing alleles, and no other value; the phase set doesn't count."""
    kind = rows.schema["call"].dataType.elementType

    def filled(c: Column) -> Column:
        out = F.exists(c["genotype"], lambda g: g != -1)
        for f in kind.fields:
            if f.name not in ("sample_id", "name", "genotype", "phaseset"):
                x = c[f.name]
                out = out | (F.size(x) > 0 if isinstance(f.dataType, T.ArrayType) else x if isinstance(f.dataType, T.BooleanType) else x.isNotNull())
        return F.coalesce(out, F.lit(False))

    return rows.withColumn("call", F.filter("call", filled))


def hom_ref_calls(rows: DataFrame) -> DataFrame:
    """Calls of only reference alleles leave `call`; their sample stays in `hom_ref_call`."""
    ref = lambda c: (F.size(c["genotype"]) > 0) & F.forall(c["genotype"], lambda g: g == 0)
    names = [f for f in ("sample_id", "name") if f in rows.schema["call"].dataType.elementType.fieldNames()]
    out = rows.withColumn("hom_ref_call", F.transform(F.filter("call", ref), lambda c: F.struct(*[c[f].alias(f) for f in names])))
    return out.withColumn("call", F.filter("call", lambda c: ~ref(c)))


def split_wide_rows(rows: DataFrame, most_bytes: int = 90 << 20, least_calls: int = 100, sampled: int = 5) -> DataFrame:
    """Rows whose calls are too large, by the JSON size of a few spread calls, become several with a slice of calls each."""
    n = F.size("call")
    step = F.greatest(F.floor(n / sampled), F.lit(1)).cast("int")
    taken = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), step), lambda i: F.length(F.to_json(F.struct(F.get("call", i.cast("int")).alias("c")))) - 6)
    size = F.floor(F.aggregate(taken, F.lit(0).cast("long"), lambda a, b: a + b) / F.size(taken))
    fit = F.when((n >= least_calls) & (size * n > most_bytes), F.greatest(F.floor(F.lit(most_bytes) / size), F.lit(1))).otherwise(F.greatest(n, F.lit(1))).cast("int")
    x = rows.withColumn("_fit", fit)
    x = x.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / F.col("_fit")) - 1, F.lit(0)).cast("int"))))
    return x.withColumn("call", F.slice("call", F.col("_part") * F.col("_fit") + 1, F.col("_fit"))).drop("_fit", "_part")
