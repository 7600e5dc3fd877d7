"""Variant tables on disk: staged writes, appends with a wider schema, schema files, shards that hold rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators import merge, shard


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def create(routed: DataFrame, path: str) -> None:
    """Writes beside the place and then renames, so a failed write leaves no table behind."""
    spark = routed.sparkSession
    if exists(spark, path):
        raise ValueError(f"the table is there already: {path}")
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        shard.write_table(routed, staged)
        fs, p = _fs(spark, staged)
        if not fs.rename(p, _fs(spark, path)[1]):
            raise RuntimeError(f"can't rename {staged}")
    except BaseException:
        remove(spark, staged)
        raise


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with all columns and nested fields of a schema that holds its own, absent ones null."""

    def cast(x, own: T.DataType, want: T.DataType):
        if isinstance(want, T.ArrayType) and isinstance(want.elementType, T.StructType):
            return F.transform(x, lambda e: cast(e, own.elementType, want.elementType))
        if isinstance(want, T.StructType):
            have = {f.name: f.dataType for f in own.fields}
            return F.struct(*[(cast(x[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
        return x

    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(cast(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def append(routed: DataFrame, path: str, update_schema: bool = False) -> T.StructType:
    """Adds rows to a table. A new column or field is an error unless update_schema; a change of type always is.

    Returns the table's schema from then on; rows of before read the new columns as null by it (`read`). The new files are
    written apart and moved in one folder after the other, so a failed write adds nothing.
    """
    spark = routed.sparkSession
    old = read(spark, path).schema
    wider = merge.merge_schema(old, routed.schema)
    if not update_schema and {f.simpleString() for f in wider.fields} != {f.simpleString() for f in old.fields}:
        raise ValueError("the rows have columns or fields that the table lacks")
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        shard.write_table(conform(routed, wider), staged)
        if update_schema:
            write_schema(spark, wider, path)
        fs, source = _fs(spark, staged)
        target = _fs(spark, path)[1].toUri().getPath()
        base, files = source.toUri().getPath(), fs.listFiles(source, True)
        while files.hasNext():
            at = files.next().getPath()
            if at.getName().startswith("part-"):
                to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target + at.toUri().getPath()[len(base) :])
                fs.mkdirs(to.getParent())
                if not fs.rename(at, to):
                    raise RuntimeError(f"can't move {at}")
    finally:
        remove(spark, staged)
    return wider


def write_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """The schema as JSON in a folder that table reads skip."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_schema")


def read(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, f"{path}/_schema"):
        return spark.read.parquet(path)
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/_schema").first().value))
    return spark.read.schema(schema).parquet(path)


def read_regions(spark: SparkSession, path: str, regions: list[shard.Region], shards: list[shard.Shard]) -> DataFrame:
    """Rows in one of the regions (all, if none is given), with the columns of `read`."""
    return shard.read_regions(spark, path, regions, shards, read(spark, path).schema)


def filled_shards(spark: SparkSession, path: str) -> list[str]:
    """The shards that hold rows: their folders, without reading any."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName().removeprefix("shard=") for x in fs.listStatus(p) if x.getPath().getName().startswith("shard="))


def spread(df: DataFrame, writers: int) -> DataFrame:
    """At most `writers` tasks and so files: rows dealt out evenly, without a key."""
    if writers < 1:
        raise ValueError("at least one writer")
    return df.repartition(writers)
