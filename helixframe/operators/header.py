"""Header lines: parsing, merging over files with conflict rules, inference of undefined fields, schema."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators import reserved

SECTIONS = ("INFO", "FILTER", "ALT", "FORMAT", "contig")
SPARK = {"Integer": T.LongType(), "Float": T.DoubleType(), "String": T.StringType(), "Character": T.StringType(), "Flag": T.BooleanType()}


@dataclass
class Header:
    sections: dict[str, dict[str, dict[str, str]]] = field(default_factory=lambda: {s: {} for s in SECTIONS})
    samples: list[str] = field(default_factory=list)


def parse_line(line: str) -> tuple[str, dict[str, str]] | None:
    m = re.match(r"##(\w+)=<(.*)>\s*$", line)
    if not m or m[1] not in SECTIONS:
        return None
    pairs = re.findall(r'(\w+)=("(?:[^"\\]|\\.)*"|[^,]*)', m[2])
    return m[1], {k: v[1:-1] if v[:1] == '"' else v for k, v in pairs}


def check(kind: str, x: dict[str, str]) -> None:
    """A definition that the specification doesn't allow is an error."""
    line = f"{kind} {x.get('ID', '')}"
    if not x.get("ID"):
        raise ValueError(f"incomplete header line: {line}")
    if kind in ("INFO", "FORMAT"):
        if not {"Number", "Type"} <= x.keys():
            raise ValueError(f"incomplete header line: {line}")
        if x["Type"] not in SPARK and x["Type"] != ".":
            raise ValueError(f"unknown type {x['Type']}: {line}")
        if not re.fullmatch(r"[0-9]+|[ARG.]", x["Number"]):
            raise ValueError(f"unknown number {x['Number']}: {line}")
        if kind == "FORMAT" and x["Type"] == "Flag":
            raise ValueError(f"FORMAT has no flags: {line}")


def parse(lines: list[str]) -> Header:
    out = Header()
    for line in lines:
        if line.startswith("#CHROM"):
            out.samples = line.rstrip("\n").split("\t")[9:]
        elif found := parse_line(line):
            kind, x = found
            check(kind, x)
            if kind == "INFO" and x["Number"] == "G":
                x["Number"] = "."
            out.sections[kind].setdefault(x["ID"], x)
    return out


def resolve(attribute: str, a: str, b: str, lenient: bool = False) -> str:
    """The value both sides agree on; lenient: String, or '.' for a number, where they don't."""
    if a == b:
        return a
    if attribute == "Type":
        if "." in (a, b):
            return b if a == "." else a
        if {a, b} == {"Integer", "Float"}:
            return "Float"
        if lenient:
            return "String"
    elif attribute == "Number":
        if a not in "01" and b not in "01" or lenient:
            return "."
    else:
        return a
    raise ValueError(f"{attribute} differs: {a}, {b}")


def merge(headers: list[Header], lenient: bool = False) -> Header:
    out = Header()
    for h in headers:
        for kind, items in h.sections.items():
            for key, x in items.items():
                old = out.sections[kind].get(key)
                out.sections[kind][key] = dict(x) if old is None else {k: resolve(k, old[k], x.get(k, old[k]), lenient) for k in old}
        out.samples += [s for s in h.samples if s not in out.samples]
    for kind in ("INFO", "FORMAT"):
        for x in out.sections[kind].values():
            x["Type"] = "String" if x["Type"] == "." else x["Type"]
    return out


def definitions(lines: DataFrame) -> DataFrame:
    """category, id, number, type and up to five files: what a conflict report needs, aggregated in Spark."""
    x = lines.where(F.col("value").rlike("^##(INFO|FORMAT)=<"))
    part = lambda p: F.regexp_extract("value", p, 1)
    x = x.select(part("^##(INFO|FORMAT)").alias("category"), part("ID=([^,>]+)").alias("id"), part("Number=([^,>]+)").alias("number"), part("Type=([^,>]+)").alias("type"), "file_path")
    return x.groupBy("category", "id", "number", "type").agg(F.slice(F.array_sort(F.collect_set("file_path")), 1, 5).alias("files"))


ORDER = ("Flag", "Integer", "Float", "String")


def _values(rows: DataFrame) -> dict[str, DataFrame]:
    """(id, value, alts) of every value of INFO and FORMAT."""
    n = F.size("alternate_bases").alias("alts")
    calls = rows.select(F.explode("call.info").alias("m"), n)
    return {"INFO": rows.select(F.explode("info").alias("id", "value"), n), "FORMAT": calls.select(F.explode("m").alias("id", "value"), "alts")}


def fits(value: Column, kind: str) -> Column:
    """The least type from `kind` on that holds all of a value's parts; dots hold no type. A flag is a null value."""
    parts = F.filter(F.split(value, ","), lambda v: ~v.isin(".", ""))
    whole = lambda v: v.try_cast("long").isNotNull() | (v.try_cast("double") == F.floor(v.try_cast("double")))
    number = F.forall(parts, lambda v: v.try_cast("double").isNotNull())
    if kind == "Flag":
        return F.when(value.isNull(), kind).otherwise("String")
    if kind == "Integer":
        return F.when(value.isNull() | F.forall(parts, whole), kind).when(number, "Float").otherwise("String")
    if kind == "Float":
        return F.when(value.isNull() | number, kind).otherwise("String")
    return F.lit(kind)


def _seen(x: DataFrame, kind: str, own: dict[str, dict[str, str]]) -> DataFrame:
    """A row for each id of `_values`: the number and type that its values show, and for those with a definition in `own` how far along
    ORDER a type must be to hold all values (`fit`) and whether their number is not the defined one (`lists`). One pass with
    partial aggregation."""
    parts = F.filter(F.split("value", ","), lambda v: v != ".")
    rank = F.when(F.forall(parts, lambda v: v.try_cast("long").isNotNull()), 1).when(F.forall(parts, lambda v: v.try_cast("double").isNotNull()), 2).otherwise(3)
    # A format value that a call leaves out says nothing, and there are no flags.
    rank = F.when(F.col("value").isNull(), 0 if kind == "INFO" else 1).otherwise(rank)
    fit, n = F.lit(None).cast("string"), F.size(F.split("value", ","))
    for t in ORDER:
        ids = [k for k, d in own.items() if d["Type"] == t]
        fit = F.when(F.col("id").isin(ids), fits(F.col("value"), t)).otherwise(fit) if ids else fit
    lists = F.when(F.col("id").isin([k for k, d in own.items() if d["Number"] == "1"]), n > 1).when(F.col("id").isin([k for k, d in own.items() if d["Number"] == "A"]), n != F.col("alts")).otherwise(False)
    order = F.array(*[F.lit(t) for t in ORDER])
    out = x.select("id", rank.alias("rank"), n.alias("n"), F.array_position(order, fit).alias("fit"), F.coalesce(lists & F.col("value").isNotNull(), F.lit(False)).alias("lists"))
    out = out.groupBy("id").agg(*[F.max(c).alias(c) for c in ("rank", "n", "fit", "lists")])
    number = F.when(F.col("rank") == 0, "0").when(F.col("n") > 1, ".").otherwise("1")
    return out.select("id", number.alias("number"), F.element_at(order, F.col("rank") + 1).alias("type"), "fit", "lists")


def infer_info(rows: DataFrame) -> DataFrame:
    """key -> number, type, from all values of the info maps."""
    return _seen(_values(rows)["INFO"], "INFO", {}).select("id", "number", "type")


def infer_format(rows: DataFrame) -> DataFrame:
    """The same for the fields of calls."""
    return _seen(_values(rows)["FORMAT"], "FORMAT", {}).select("id", "number", "type")


def completed(rows: DataFrame, header: Header) -> Header:
    """The header with what the rows show, in one pass for each section: undefined fields inferred, and definitions that values
    don't fit mended: a wider type; a number of 1 for which there are lists, or one value for each alternate for which there
    are others, becomes '.'."""
    out = Header({k: dict(v) for k, v in header.sections.items()}, header.samples)
    for kind, x in _values(rows).items():
        own = {k: d for k, d in header.sections[kind].items() if d["Type"] in ORDER}
        for r in _seen(x, kind, own).orderBy("id").collect():  # a row for each field
            if r.id in own:
                d, wider = own[r.id], ORDER[r.fit - 1]
                number = "." if r.lists else "1" if d["Type"] == "Flag" and wider != "Flag" else d["Number"]
                out.sections[kind][r.id] = d | {"Type": wider, "Number": number}
            elif r.id not in out.sections[kind] and r.id not in ("END", "GT", "PS"):
                out.sections[kind][r.id] = {"ID": r.id, "Number": r.number, "Type": r.type, "Description": ""}
    return out


def annotation_types(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """(id, number, type) of an annotation's fields, as `column_name_TYPE`: the least type that holds all values; text if none has one."""
    texts = rows.where(F.col("info")[column].isNotNull()).select(F.explode(F.split(F.col("info")[column], ",")).alias("text"))
    x = texts.select(F.split("text", r"\|", -1).alias("p")).select(F.posexplode(F.slice("p", 2, len(names))).alias("at", "value"))
    ids = F.element_at(F.array(*[F.lit(f"{column}_{n}_TYPE") for n in names]), F.col("at") + 1)
    value = F.nullif(F.col("value"), F.lit(""))
    rank = F.when(value.isNull(), 0).when(value.try_cast("long").isNotNull(), 1).when(value.try_cast("double").isNotNull(), 2).otherwise(3)
    found = x.select(ids.alias("id"), rank.alias("rank")).groupBy("id").agg(F.max("rank").alias("rank"))
    kind = F.element_at(F.array(*[F.lit(t) for t in ("String", "Integer", "Float", "String")]), F.col("rank") + 1)
    return found.select("id", F.lit("1").alias("number"), kind.alias("type"))


def annotation_columns(rows: DataFrame, column: str, names: list[str]) -> dict[str, str]:
    """The Spark types of an annotation's fields whose values are all numbers; a row a field comes to the driver."""
    found = {r.id: r.type for r in annotation_types(rows, column, names).collect()}
    spark = {"Integer": "long", "Float": "double"}
    return {n: spark[found[f"{column}_{n}_TYPE"]] for n in names if found.get(f"{column}_{n}_TYPE") in spark}


def find(schema: T.StructType, path: str) -> T.StructField | None:
    """The field at a dotted path through structs and lists of structs; null where there is none."""
    kind, out = schema, None
    for name in path.split("."):
        kind = getattr(kind, "elementType", kind)
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return None
        out = kind[name]
        kind = out.dataType
    return out


_TEXT = {T.LongType: "Integer", T.IntegerType: "Integer", T.StringType: "String", T.DoubleType: "Float", T.FloatType: "Float", T.BooleanType: "Flag"}


def from_schema(table: T.StructType, lenient: bool = False) -> Header:
    """INFO and FORMAT definitions of a table's columns. A reserved field must have its type and repetition, unless lenient;
    columns of types that VCF has no form for are left out. Structs in alternates are annotations."""
    out = Header()

    def add(kind: str, f: T.StructField, number: str | None = None) -> None:
        many = isinstance(f.dataType, T.ArrayType)
        text = _TEXT.get(type(f.dataType.elementType if many else f.dataType))
        if text is None:
            return
        known = None if lenient else reserved.FIELDS[kind].get(f.name)
        if known and text != known["Type"]:
            raise ValueError(f"{f.name} is reserved as {known['Type']}, not {text}")
        if known and number is None and many != (known["Number"] not in ("0", "1")):
            raise ValueError(f"{f.name} is reserved with Number={known['Number']}")
        own = {"ID": f.name, "Number": number or ("." if many else "0" if text == "Flag" else "1"), "Type": text, "Description": ""}
        x = dict(known or own)
        x["Description"] = (f.metadata.get("comment") or x["Description"]).replace("\n", " ")
        out.sections[kind][f.name] = x

    fixed = ("reference_name", "start_position", "end_position", "reference_bases", "names", "quality", "filter", "hom_ref_call", "sample_id")
    for f in table.fields:
        inner = getattr(f.dataType, "elementType", f.dataType)
        if f.name == "call":
            for g in inner.fields:
                if g.name not in ("sample_id", "name", "genotype", "phaseset"):
                    add("FORMAT", g)
        elif f.name == "alternate_bases":
            for g in inner.fields if isinstance(inner, T.StructType) else []:
                deep = getattr(g.dataType, "elementType", None)
                if isinstance(deep, T.StructType):
                    names = "|".join(["Allele", *[n for n in deep.fieldNames() if n != "allele"]])
                    out.sections["INFO"][g.name] = {"ID": g.name, "Number": ".", "Type": "String", "Description": f"{g.metadata.get('comment', '')} Format: {names}".strip()}
                elif g.name != "alt":
                    add("INFO", g, "A")
        elif f.name not in fixed:
            add("INFO", f)
    return out


def schema(header: Header, split_alternates: bool = True, call_name: bool = False) -> T.StructType:
    """The nested table schema: fixed columns, per-alternate fields, calls, then the other info fields."""

    def name(key: str) -> str:
        out = re.sub(r"[^A-Za-z0-9_]", "_", key)
        return out if re.match(r"[A-Za-z]", out) else f"field_{out}"

    def one(x: dict[str, str]) -> T.StructField:
        kind = SPARK[x["Type"]]
        return T.StructField(name(x["ID"]), kind if x["Number"] in ("0", "1") else T.ArrayType(kind), True)

    info, form = header.sections["INFO"], header.sections["FORMAT"]
    per = [T.StructField(name(k), SPARK[x["Type"]], True) for k, x in info.items() if split_alternates and x["Number"] == "A"]
    s, n, many = T.StringType(), T.LongType(), T.ArrayType(T.StringType())
    call = [T.StructField("sample_id", n), *[T.StructField("name", s)] * call_name, T.StructField("genotype", T.ArrayType(n)), T.StructField("phaseset", s)] + [one(x) for k, x in form.items() if k not in ("GT", "PS")]
    fixed = [("reference_name", s), ("start_position", n), ("end_position", n), ("reference_bases", s), ("alternate_bases", T.ArrayType(T.StructType([T.StructField("alt", s), *per]))), ("names", many), ("quality", T.DoubleType()), ("filter", many), ("call", T.ArrayType(T.StructType(call)))]
    rest = [one(x) for k, x in info.items() if k != "END" and not (split_alternates and x["Number"] == "A")]
    return T.StructType([T.StructField(k, t) for k, t in fixed] + rest)


def write(header: Header) -> list[str]:
    out = ["##fileformat=VCFv4.3"]
    for kind in SECTIONS:
        for x in header.sections[kind].values():
            out.append(f"##{kind}=<" + ",".join(f'{k}="{v}"' if k in ("Description", "Source", "Version") else f"{k}={v}" for k, v in x.items()) + ">")
    return out
