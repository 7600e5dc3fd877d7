"""A nested variant table made from the star-schema tables, and the same facts as flat SQL.

An order is a variant, its lineitems are its alternates (by return flag), calls (by supplier) and annotations (by part).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def variants(spark: SparkSession, sf_dir: str, where: Column | str | None = None) -> DataFrame:
    """where: a predicate on reference_name, start_position, end_position, reference_bases, names, quality, filter and NS; lineitems
    of other orders are dropped before anything is made of them."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    items, parts = read("lineitem"), read("part")
    start = 10 * (F.col("o_orderkey") % 200)
    orders = read("orders").select(
        F.concat(F.lit("chr"), (1 + F.col("o_custkey") % 22).cast("string")).alias("reference_name"),
        start.alias("start_position"),
        (start + 1).alias("end_position"),
        F.substring(F.lit("ACGTN"), F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(1)).alias("reference_bases"),
        F.array(F.concat(F.lit("rs"), F.col("o_orderkey").cast("string"))).alias("names"),
        F.col("o_totalprice").alias("quality"),
        F.array("o_orderstatus").alias("filter"),
        F.col("o_orderkey").alias("NS"),
    )
    # One shuffle by order key serves the groups below and the joins with orders.
    if where is None:
        items = items.repartition("l_orderkey")
    else:
        orders = orders.where(where)
        items = items.join(orders.select(F.col("NS").alias("l_orderkey")), "l_orderkey", "left_semi")
    x = items.join(parts.select("p_partkey", "p_brand", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"), "left")
    qty = F.col("l_quantity").cast("long")
    odd = F.col("l_linenumber") % 2 == 1
    per_alt = x.groupBy("l_orderkey", F.col("l_returnflag").alias("alt")).agg(
        F.sum(qty).alias("AC"),
        F.sum(qty * 2 + 50).alias("AN"),
        F.coalesce(F.sum(F.when(odd, qty)), F.lit(0)).alias("AC_male"),
        F.coalesce(F.sum(F.when(~odd, qty)), F.lit(0)).alias("AC_female"),
        F.array_sort(F.collect_set(F.struct(F.col("p_brand").alias("SYMBOL"), F.col("p_type").alias("Consequence"), F.element_at(F.array(F.lit("LOW"), F.lit("MODERATE"), F.lit("HIGH")), F.col("p_size") % 3 + 1).alias("IMPACT")))).alias("vep"),
    )
    alts = per_alt.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("alt", "AC", "AN", "AC_male", "AC_female", "vep"))).alias("alternate_bases"))
    per_call = items.groupBy("l_orderkey", "l_suppkey").agg((F.max("l_linenumber") % 3).alias("a"), (F.max("l_partkey") % 3).alias("b"))
    calls = per_call.groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_suppkey").alias("sample_id"), F.array(F.col("a").cast("int"), F.col("b").cast("int")).alias("genotype"), F.lit(None).cast("string").alias("phaseset")))).alias("call"))
    out = orders.join(alts, F.col("NS") == F.col("l_orderkey"), "left").join(calls, F.col("NS") == F.col("k"), "left")
    return out.select(
        "reference_name", "start_position", "end_position", "reference_bases",
        F.coalesce("alternate_bases", F.array().cast(out.schema["alternate_bases"].dataType)).alias("alternate_bases"),
        "names", "quality", "filter",
        F.coalesce("call", F.array().cast(out.schema["call"].dataType)).alias("call"),
        "NS",
    )


#: Flat twins: v (a row for each variant), a (alternates), e (annotations), c (calls).
CTE = r"""
WITH v AS (SELECT 'chr' || (1 + o_custkey % 22) AS reference_name, 10 * (o_orderkey % 200) AS start_position, 10 * (o_orderkey % 200) + 1 AS end_position,
  substring('ACGTN', CAST(substring(o_orderpriority, 1, 1) AS INT), 1) AS reference_bases, o_totalprice AS quality, o_orderstatus AS filter, o_orderkey AS k FROM orders),
x AS (SELECT * FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
a AS (SELECT l_orderkey AS k, l_returnflag AS alt, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS AC, CAST(sum(CAST(l_quantity AS BIGINT) * 2 + 50) AS BIGINT) AS AN,
  CAST(coalesce(sum(CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS AC_male,
  CAST(coalesce(sum(CASE WHEN l_linenumber % 2 <> 1 THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS AC_female FROM lineitem GROUP BY ALL),
e AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS alt, p_brand AS symbol, p_type AS consequence, CASE p_size % 3 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MODERATE' ELSE 'HIGH' END AS impact FROM x),
c AS (SELECT l_orderkey AS k, l_suppkey AS sample_id, max(l_linenumber) % 3 AS g1, max(l_partkey) % 3 AS g2 FROM lineitem GROUP BY ALL),
va AS (SELECT v.*, a.* EXCLUDE (k) FROM v JOIN a USING (k)),
ve AS (SELECT v.*, e.* EXCLUDE (k) FROM v JOIN e USING (k)),
vc AS (SELECT v.*, c.* EXCLUDE (k) FROM v JOIN c USING (k)),
al AS (SELECT k, string_agg(alt, ',' ORDER BY alt) AS alts FROM a GROUP BY k)
"""
