"""Table rows back to VCF text: densify, order, encode with column expressions, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators import annotate

#: Columns and fields of a call that have their own place in a line; all others are INFO and FORMAT.
FIXED = ("reference_name", "start_position", "end_position", "reference_bases", "alternate_bases", "names", "quality", "filter", "call")
CALL = ("sample_id", "name", "genotype", "phaseset")


def densify(variants: DataFrame, sample_ids: list[int]) -> DataFrame:
    """Each row's calls as one for each id in this order; an absent sample's genotype is missing."""
    kind = variants.schema["call"].dataType.elementType
    blank = F.struct(*[(F.array(F.lit(-1)).cast(f.dataType) if f.name == "genotype" else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind.fields if f.name != "sample_id"])
    known = F.map_from_entries(F.transform("call", lambda c: F.struct(c["sample_id"], F.struct(*[c[f.name].alias(f.name) for f in kind.fields if f.name != "sample_id"]))))
    ids = F.array(*[F.lit(i).cast("long") for i in sample_ids])
    rest = [f.name for f in kind.fields if f.name != "sample_id"]

    def one(i: Column) -> Column:
        x = F.coalesce(F.try_element_at(known, i), blank)
        return F.struct(i.alias("sample_id"), *[x[f].alias(f) for f in rest])

    return variants.withColumn("call", F.transform(ids, one))


def _or_dot(x: Column) -> Column:
    return F.when(x.isNull() | (x == ""), ".").otherwise(x)


def _listed(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: _or_dot(v.cast("string"))), ",")


def _value(x: Column, kind: T.DataType) -> Column:
    """The text of a value; null where there is none, as for an empty list."""
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(x) > 0, _listed(x))
    return F.when(x.isNotNull(), _or_dot(x.cast("string")))


def _values(xs: Column, kind: T.DataType) -> Column:
    return F.transform(xs, lambda x: _value(x, kind))


def _nested(kind: T.DataType) -> bool:
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return isinstance(inner, (T.StructType, T.MapType, T.ArrayType))


def encode_info(variants: DataFrame) -> list[Column]:
    """key=value of each other column, then of each field of the alternates; null where a row has none.

    A true flag is its key alone and a false one is left out. Where only some alternates have a value the others get a
    dot: without it a reader would give the values to the wrong alternates. Lists of structs are annotations.
    """
    out = []
    for f in variants.schema.fields:
        if f.name in FIXED:
            continue
        if _nested(f.dataType):
            raise ValueError(f"no VCF form for column {f.name}: {f.dataType.simpleString()}")
        if isinstance(f.dataType, T.BooleanType):
            out.append(F.when(F.col(f.name), f.name))
        else:
            out.append(F.concat(F.lit(f"{f.name}="), _value(F.col(f.name), f.dataType)))
    for f in variants.schema["alternate_bases"].dataType.elementType.fields:
        if f.name == "alt":
            continue
        inner = getattr(f.dataType, "elementType", None)
        if isinstance(inner, T.StructType):
            every = annotate.to_text(f.name, [n for n in inner.fieldNames() if n != "allele"], "allele" in inner.fieldNames())
        elif _nested(f.dataType):
            raise ValueError(f"no VCF form for field {f.name} of alternate_bases: {f.dataType.simpleString()}")
        else:
            values = _values(F.col("alternate_bases")[f.name], f.dataType)
            every = F.when(F.exists(values, lambda v: v.isNotNull()), _listed(values))
        out.append(F.concat(F.lit(f"{f.name}="), every))
    return out


def encode_line(variants: DataFrame, one_based: bool = False) -> Column:
    """The data line of a row of `variants`: the fixed columns, all of INFO, and the calls with all fields that any of them has."""
    start = F.col("start_position")
    pos = start if one_based else start + 1
    end = F.when(pos - 1 + F.length("reference_bases") != F.col("end_position"), F.concat(F.lit("END="), F.col("end_position").cast("string")))
    kinds = {f.name: f.dataType for f in variants.schema["call"].dataType.elementType.fields if f.name not in CALL}
    for name, kind in kinds.items():
        if _nested(kind):
            raise ValueError(f"no VCF form for field {name} of call: {kind.simpleString()}")

    def field(c: Column, key: str) -> Column:
        if key == "PS":
            return F.nullif(F.nullif(c["phaseset"], F.lit("*")), F.lit(""))
        return _value(c[key], kinds[key])

    def used(key: str) -> Column:
        return F.exists("call", lambda c: field(c, key).isNotNull())

    # Which of the sorted keys a row has depends on its calls. They are found once for a row: as the one element of an array.
    keys = sorted({"PS", *kinds})
    own = F.array(F.struct(*[used(k).alias(k) for k in keys]))

    def call(c: Column, has: Column) -> Column:
        alleles = F.transform(c["genotype"], lambda g: F.when(g == -1, ".").otherwise(g.cast("string")))
        phased = F.coalesce(c["phaseset"], F.lit("")) != ""
        gt = F.when(F.size(alleles) > 0, F.when(phased, F.array_join(alleles, "|")).otherwise(F.array_join(alleles, "/"))).otherwise(".")
        return F.concat_ws(":", gt, *[F.when(has[k], _or_dot(field(c, k))) for k in keys])

    alts = F.array_join(F.transform("alternate_bases", lambda a: a["alt"]), ",")
    info = F.concat_ws(";", end, *encode_info(variants))
    fixed = [F.col("reference_name"), pos.cast("string"), F.array_join("names", ";"), F.col("reference_bases"), alts, F.col("quality").cast("string"), F.array_join("filter", ";"), info]
    called = F.size("call") > 0
    form = F.when(called, F.get(F.transform(own, lambda has: F.concat_ws(":", F.lit("GT"), *[F.when(has[k], k) for k in keys])), F.lit(0)))
    texts = F.get(F.transform(own, lambda has: F.array_join(F.transform("call", lambda c: call(c, has)), "\t")), F.lit(0))
    # Without calls the line ends with FORMAT: concat_ws leaves out the null.
    return F.concat_ws("\t", *[_or_dot(x) for x in [*fixed, form]], F.when(called, texts))


def supported(variants: DataFrame) -> DataFrame:
    """Only columns, and fields of calls and alternates, that have a VCF form: whole numbers, floats, text, flags and lists of them;
    structs in alternates are annotations."""
    good = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType, T.StringType, T.BooleanType)

    def fine(t: T.DataType) -> bool:
        return isinstance(getattr(t, "elementType", t), good)

    def fields(t: T.DataType, nested: bool) -> list[str]:
        return [f.name for f in t.elementType.fields if fine(f.dataType) or (nested and isinstance(getattr(f.dataType, "elementType", None), T.StructType))]

    def narrowed(column: str, keep: list[str]) -> Column:
        return F.transform(column, lambda c: F.struct(*[c[k].alias(k) for k in keep])).alias(column)

    out = []
    for f in variants.schema.fields:
        if f.name in ("call", "alternate_bases") and isinstance(f.dataType.elementType, T.StructType):
            out.append(narrowed(f.name, fields(f.dataType, f.name == "alternate_bases")))
        elif fine(f.dataType):
            out.append(F.col(f"`{f.name}`"))
    return variants.select(*out)


def column_line(names: list[str]) -> str:
    return "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])


def write_shards(variants: DataFrame, path: str, header: list[str], names: list[str], most: int, one_based: bool = False) -> None:
    """Files of at most `most` records, each with the header and so a VCF file of its own; records in no order across files."""
    head = F.lit("\n".join([*header, column_line(names)]))
    x = variants.select(F.monotonically_increasing_id().alias("n"), encode_line(variants, one_based).alias("line"))
    x = x.select(F.shiftright("n", 33).alias("task"), F.floor(F.pmod("n", F.lit(1 << 33)) / most).alias("file"), "line")
    # A file is a group that is bounded by `most`.
    files = x.groupBy("task", "file").agg(F.collect_list("line").alias("lines"))
    text = F.concat_ws("\n", head, F.array_join("lines", "\n"))
    files.select(text.alias("value"), F.concat_ws("_", F.lit("count"), F.col("task"), F.col("file")).alias("shard")).write.partitionBy("shard").text(path)


def compose(spark, path: str, target: str) -> None:
    """The parts of `write_vcf` as one file: streams joined one after the other on the driver, so no part is held in memory."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    hadoop, conf = jvm.org.apache.hadoop, sc._jsc.hadoopConfiguration()
    root, out = hadoop.fs.Path(path), hadoop.fs.Path(target)
    fs = root.getFileSystem(conf)
    stream = out.getFileSystem(conf).create(out, True)
    try:
        for folder in ("header", "data"):
            parts = sorted(str(x.getPath()) for x in fs.listStatus(hadoop.fs.Path(root, folder)) if x.getPath().getName().startswith("part-"))
            for p in parts:
                source = fs.open(hadoop.fs.Path(p))
                try:
                    hadoop.io.IOUtils.copyBytes(source, stream, conf, False)
                finally:
                    source.close()
    finally:
        stream.close()


def write_vcf(variants: DataFrame, path: str, header: list[str], names: list[str], one_based: bool = False) -> None:
    """Ordered text parts whose names sort by position, the header as their first part; joining them in order is the file."""
    spark = variants.sparkSession
    spark.createDataFrame([("\n".join([*header, column_line(names)]),)], "value string").coalesce(1).write.text(f"{path}/header")
    ordered = variants.repartitionByRange("reference_name", "start_position").sortWithinPartitions("reference_name", "start_position", "end_position", "reference_bases")
    ordered.select(encode_line(ordered, one_based).alias("value")).write.text(f"{path}/data")
