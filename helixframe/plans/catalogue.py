"""The registered queries of the variant engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import annotate, bind, export, flatten, header, intervals, merge, samples, shard, table
from helixframe.plans import storage
from helixframe.plans.variants import CTE, variants
from helixframe.sources import vcf

Query = Callable[[SparkSession, str], DataFrame]
_found: dict[str, tuple[Query, str | None]] = {}
SITE = ("reference_name", "start_position", "end_position", "reference_bases")
REGIONS = [shard.parse_region("chr1:0-1,000"), shard.parse_region("chr2")]
SHARDS = shard.parse_shards(
    [{"output_table": {"table_name_suffix": f"chr{i}", "regions": [f"chr{i}"], "partition_range_end": 2000}} for i in range(1, 11)]
    + [{"output_table": {"table_name_suffix": "chr11_low", "regions": ["chr11:0-1,000"], "partition_range_end": 2000}}, {"output_table": {"table_name_suffix": "rest", "regions": ["residual"], "partition_range_end": 2000}}]
)


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _found[f.__name__] = (f, None if sql is None else CTE + sql)
        return f

    return add


def alternates(v: DataFrame) -> DataFrame:
    return v.select(*SITE, "names", "quality", F.inline("alternate_bases"))


def annotations(v: DataFrame) -> DataFrame:
    x = v.select(*SITE, F.explode("alternate_bases").alias("a"))
    return x.select(*SITE, F.col("a.alt").alias("alt"), F.inline("a.vep"))


@query("SELECT min(start_position) AS min_start, max(end_position) AS max_end, count(DISTINCT k) AS n FROM ve WHERE reference_name = 'chr1' AND symbol = 'Brand#11'")
def q1_gene_range(spark, sf_dir):
    has = F.exists("alternate_bases", lambda a: F.exists(a["vep"], lambda e: e["SYMBOL"] == "Brand#11"))
    return variants(spark, sf_dir, "reference_name = 'chr1'").where(has).agg(F.min("start_position").alias("min_start"), F.max("end_position").alias("max_end"), F.count("*").alias("n"))


@query("SELECT filter AS variant_type, count(*) AS n FROM (SELECT DISTINCT start_position, reference_bases, alt, filter FROM va WHERE reference_name = 'chr1' AND start_position BETWEEN 100 AND 1500) GROUP BY 1")
def q2_variant_types(spark, sf_dir):
    v = variants(spark, sf_dir, "reference_name = 'chr1' AND start_position >= 100 AND start_position <= 1500")
    x = v.select("start_position", "reference_bases", F.explode("alternate_bases.alt").alias("alt"), F.col("filter")[0].alias("variant_type")).distinct()
    return x.groupBy("variant_type").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT start_position, reference_bases, alt FROM va WHERE reference_name = 'chr1' AND start_position BETWEEN 100 AND 1500")
def q3_distinct_variants(spark, sf_dir):
    v = variants(spark, sf_dir, "reference_name = 'chr1' AND start_position >= 100 AND start_position <= 1500")
    return v.select("start_position", "reference_bases", F.explode("alternate_bases.alt").alias("alt")).distinct()


@query("SELECT k, alt, AC, AC_male, AC_female FROM va WHERE reference_name = 'chr3' AND start_position >= 0 AND end_position <= 1000")
def q4_allele_counts(spark, sf_dir):
    v = variants(spark, sf_dir, shard.region_filter([shard.parse_region("chr3:0-1000")]))
    return v.select(F.col("NS").alias("k"), F.inline("alternate_bases")).select("k", "alt", "AC", "AC_male", "AC_female")


@query("SELECT k, alt, AC_female FROM va WHERE reference_name = 'chr3' AND AC > 10 AND AC_male = 0 ORDER BY AC_female DESC")
def q5_only_one_sex(spark, sf_dir):
    x = variants(spark, sf_dir, "reference_name = 'chr3'").select(F.col("NS").alias("k"), F.inline("alternate_bases"))
    return x.where("AC > 10 AND AC_male = 0").select("k", "alt", "AC_female").orderBy(F.desc("AC_female"))


@query("SELECT k, alt, AC FROM va WHERE (AC_male = AC) <> (AC_female = AC) AND reference_name IN ('chr1', 'chr2')")
def q6_private_alternates(spark, sf_dir):
    x = variants(spark, sf_dir, "reference_name IN ('chr1', 'chr2')").select(F.col("NS").alias("k"), F.inline("alternate_bases"))
    return x.where("(AC_male = AC) <> (AC_female = AC)").select("k", "alt", "AC")


VEP = "array<struct<SYMBOL:string,Consequence:string,IMPACT:string>>"
PATHS = {
    "reference_name": "string",
    "start_position": "bigint",
    "end_position": "bigint",
    "reference_bases": "string",
    "alternate_bases": f"array<struct<alt:string,AC:bigint,AN:bigint,AC_male:bigint,AC_female:bigint,vep:{VEP}>>",
    "alternate_bases.alt": "string",
    "alternate_bases.AC": "bigint",
    "alternate_bases.AN": "bigint",
    "alternate_bases.AC_male": "bigint",
    "alternate_bases.AC_female": "bigint",
    "alternate_bases.vep": VEP,
    "alternate_bases.vep.SYMBOL": "string",
    "alternate_bases.vep.Consequence": "string",
    "alternate_bases.vep.IMPACT": "string",
    "names": "array<string>",
    "quality": "double",
    "filter": "array<string>",
    "call": "array<struct<sample_id:bigint,genotype:array<int>,phaseset:string>>",
    "call.sample_id": "bigint",
    "call.genotype": "array<int>",
    "call.phaseset": "string",
    "NS": "bigint",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{p}', '{t}')" for p, t in PATHS.items()) + ") t(field_path, data_type)")
def q7_column_catalogue(spark, sf_dir):
    """Paths and types of the nested table."""

    def walk(name, t):
        yield name, t.simpleString()
        t = getattr(t, "elementType", t)
        for f in getattr(t, "fields", []):
            yield from walk(f"{name}.{f.name}", f.dataType)

    rows = [x for f in variants(spark, sf_dir).schema.fields for x in walk(f.name, f.dataType)]
    return spark.createDataFrame(rows, "field_path string, data_type string")


@query("""SELECT reference_name, count(*) AS n_variants, CAST(sum(n_alt) AS BIGINT) AS n_alt, round(sum(ac) / sum(an), 3) AS af, max(genes) AS genes FROM
  (SELECT v.reference_name, v.k, count(a.alt) AS n_alt, sum(a.AC) AS ac, sum(a.AN) AS an FROM v LEFT JOIN a USING (k) GROUP BY 1, 2) t
  JOIN (SELECT reference_name, string_agg(DISTINCT symbol, ', ' ORDER BY symbol) AS genes FROM ve GROUP BY 1) g USING (reference_name) GROUP BY 1""")
def q8_burden(spark, sf_dir):
    v = variants(spark, sf_dir)
    total = lambda f: F.aggregate(F.col(f"alternate_bases.{f}"), F.lit(0).cast("long"), lambda a, b: a + b)
    sums = v.groupBy("reference_name").agg(F.count("*").alias("n_variants"), F.sum(F.size("alternate_bases").cast("long")).alias("n_alt"), F.round(F.sum(total("AC")) / F.sum(total("AN")), 3).alias("af"))
    genes = annotations(v).select("reference_name", "SYMBOL").distinct().groupBy("reference_name").agg(F.array_join(F.array_sort(F.collect_list("SYMBOL")), ", ").alias("genes"))
    return sums.join(genes, "reference_name")


@query("SELECT k, alt, symbol, consequence FROM ve WHERE symbol = 'Brand#12' AND regexp_matches(consequence, 'SMALL|PROMO')")
def q9_consequence(spark, sf_dir):
    x = variants(spark, sf_dir).select(F.col("NS").alias("k"), F.explode("alternate_bases").alias("a")).select("k", "a.alt", F.inline("a.vep"))
    return x.where((F.col("SYMBOL") == "Brand#12") & F.col("Consequence").rlike("SMALL|PROMO")).select("k", "alt", F.col("SYMBOL").alias("symbol"), F.col("Consequence").alias("consequence"))


@query("SELECT k, alt, round(AC / AN, 6) AS af FROM va WHERE AC / AN > 0.3")
def q10_frequent(spark, sf_dir):
    x = variants(spark, sf_dir).select(F.col("NS").alias("k"), F.inline("alternate_bases"))
    return x.where(F.col("AC") / F.col("AN") > 0.3).select("k", "alt", F.round(F.col("AC") / F.col("AN"), 6).alias("af"))


@query("SELECT k, alt, abs(AC_male - AC_female) AS diff FROM va ORDER BY diff DESC, k, alt LIMIT 1000")
def q11_largest_difference(spark, sf_dir):
    x = variants(spark, sf_dir).select(F.col("NS").alias("k"), F.inline("alternate_bases"))
    return x.select("k", "alt", F.abs(F.col("AC_male") - F.col("AC_female")).alias("diff")).orderBy(F.desc("diff"), "k", "alt").limit(1000)


@query("SELECT symbol, count(*) AS n FROM (SELECT DISTINCT symbol, reference_name, start_position, alt FROM ve WHERE impact <> 'LOW') GROUP BY 1 ORDER BY n DESC, symbol LIMIT 1000")
def q12_genes_by_variants(spark, sf_dir):
    x = annotations(variants(spark, sf_dir)).where("IMPACT <> 'LOW'").select(F.col("SYMBOL").alias("symbol"), "reference_name", "start_position", "alt").distinct()
    return x.groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "symbol").limit(1000)


@query("SELECT start_position // 250 AS bucket, count(*) AS n FROM (SELECT DISTINCT reference_name, start_position, reference_bases, alt FROM va) GROUP BY 1")
def q13_buckets(spark, sf_dir):
    x = variants(spark, sf_dir).select("reference_name", "start_position", "reference_bases", F.explode("alternate_bases.alt").alias("alt")).distinct()
    return x.groupBy(F.expr("start_position DIV 250").alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT k, sample_id, CASE WHEN g = 0 THEN reference_bases ELSE coalesce(split_part(al.alts, ',', g), '') END AS bases FROM (SELECT *, unnest([g1, g2]) AS g FROM vc) LEFT JOIN al USING (k)")
def q14_flatten_calls(spark, sf_dir):
    x = variants(spark, sf_dir).select("NS", "reference_bases", "alternate_bases", F.explode("call").alias("c")).select("*", F.explode("c.genotype").alias("g"))
    alt = F.coalesce(F.get("alternate_bases.alt", F.col("g") - 1), F.lit(""))
    return x.select(F.col("NS").alias("k"), "c.sample_id", F.when(F.col("g") == 0, F.col("reference_bases")).otherwise(alt).alias("bases"))


@query("""SELECT reference_name, start_position, end_position, reference_bases, b.alt, 'rs' || k AS names, quality, filter, sample_id, CAST(g AS INT) AS genotype
  FROM (SELECT *, unnest([g1, g2]) AS g FROM vc) JOIN (SELECT k, alt, row_number() OVER (PARTITION BY k ORDER BY alt) AS off FROM a) b USING (k) WHERE g = 0 OR g = off""")
def q15_full_flatten(spark, sf_dir):
    return flatten.full(variants(spark, sf_dir))


@query("SELECT reference_name, start_position, reference_bases, alt, consequence FROM ve WHERE symbol = 'Brand#23' AND impact = 'HIGH'")
def q16_high_impact(spark, sf_dir):
    x = annotations(variants(spark, sf_dir)).where("SYMBOL = 'Brand#23' AND IMPACT = 'HIGH'")
    return x.select("reference_name", "start_position", "reference_bases", "alt", F.col("Consequence").alias("consequence"))


@query("SELECT k, alt, symbol FROM ve WHERE impact = 'HIGH' AND symbol IN (SELECT p_brand FROM part WHERE p_size = 7 AND p_retailprice > 950)")
def q17_pathway(spark, sf_dir):
    x = variants(spark, sf_dir).select(F.col("NS").alias("k"), F.explode("alternate_bases").alias("a")).select("k", "a.alt", F.inline("a.vep"))
    genes = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_size = 7 AND p_retailprice > 950").select(F.col("p_brand").alias("SYMBOL")).distinct()
    return x.where("IMPACT = 'HIGH'").join(genes, "SYMBOL", "left_semi").select("k", "alt", F.col("SYMBOL").alias("symbol"))


@query("SELECT sample_id, reference_name, count(*) AS n, CAST(sum(start_position) AS BIGINT) AS sum_start FROM vc WHERE sample_id IN (7, 42) GROUP BY 1, 2")
def q18_sample_lookup(spark, sf_dir):
    x = flatten.by_sample(variants(spark, sf_dir)).where("sample_id IN (7, 42)")
    return x.groupBy("sample_id", "reference_name").agg(F.count("*").alias("n"), F.sum("start_position").alias("sum_start"))


@query("""SELECT v.reference_name || chr(9) || (start_position + 1) || chr(9) || 'rs' || v.k || chr(9) || reference_bases || chr(9) || coalesce(al.alts, '.') AS line,
  coalesce(s1.g1 || '/' || s1.g2, './.') AS call1, coalesce(s2.g1 || '/' || s2.g2, './.') AS call2 FROM v LEFT JOIN al USING (k)
  LEFT JOIN c s1 ON s1.k = v.k AND s1.sample_id = 1 LEFT JOIN c s2 ON s2.k = v.k AND s2.sample_id = 2
  WHERE (reference_name = 'chr1' AND start_position >= 0 AND end_position <= 1000) OR reference_name = 'chr2'""")
def q19_export(spark, sf_dir):
    """Export lines of regions and two samples, read apart again."""
    x = export.densify(variants(spark, sf_dir, shard.region_filter(REGIONS)), [1, 2])
    x = x.select(F.split(export.encode_line(x), "\t").alias("f"))
    call = lambda i: F.when(F.col("f")[i] == ".", "./.").otherwise(F.col("f")[i])
    return x.select(F.array_join(F.slice("f", 1, 5), "\t").alias("line"), call(9).alias("call1"), call(10).alias("call2"))


@query("SELECT reference_name, count(*) AS n, CAST(sum(start_position) AS BIGINT) AS sum_start, CAST(sum(end_position) AS BIGINT) AS sum_end FROM v GROUP BY 1")
def q20_checksums(spark, sf_dir):
    return variants(spark, sf_dir).groupBy("reference_name").agg(F.count("*").alias("n"), F.sum("start_position").alias("sum_start"), F.sum("end_position").alias("sum_end"))


@query("""SELECT reference_name, start_position, reference_bases, coalesce(alts, '') AS alts, max(quality) AS quality, string_agg(DISTINCT filter, ';' ORDER BY filter) AS filters,
  string_agg('rs' || k, ';' ORDER BY 'rs' || k) AS names, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_calls FROM v LEFT JOIN al USING (k) LEFT JOIN (SELECT k, count(*) AS n FROM c GROUP BY k) USING (k) GROUP BY 1, 2, 3, 4""")
def a2_move_to_calls(spark, sf_dir):
    m = merge.move_to_calls(variants(spark, sf_dir))
    return m.select("reference_name", "start_position", "reference_bases", F.array_join("alternate_bases.alt", ",").alias("alts"), "quality", F.array_join("filter", ";").alias("filters"), F.array_join("names", ";").alias("names"), F.size("call").cast("long").alias("n_calls"))


@query("SELECT filter, CAST(sum(k) AS BIGINT) AS sum_ns, CAST(sum(CAST(round(quality * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS calls FROM vc GROUP BY 1")
def a3_copied_to_calls(spark, sf_dir):
    """Each call brings its own variant's quality, filter and moved field along."""
    m = merge.move_to_calls(variants(spark, sf_dir), "^NS$", copy_quality=True, copy_filter=True).select(F.explode("call").alias("c")).select("c.*")
    return m.groupBy(F.array_join("filter", ";").alias("filter")).agg(F.sum("NS").alias("sum_ns"), F.sum(F.round(F.col("quality") * 100).cast("long")).alias("cents"), F.count("*").alias("calls"))


@query("""SELECT CASE WHEN CAST(substring(reference_name, 4) AS INT) <= 10 THEN reference_name WHEN reference_name = 'chr11' AND start_position < 1000 THEN 'chr11_low' ELSE 'rest' END AS shard,
  start_position // 10 AS bucket, count(*) AS n FROM v GROUP BY 1, 2""")
def j3_shards(spark, sf_dir):
    return shard.route(variants(spark, sf_dir), SHARDS).groupBy("shard", F.col("bucket").cast("long").alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT reference_name, start_position, end_position, reference_bases, coalesce(alts, '') AS alts, 'rs' || v.k AS names, filter, CAST(coalesce(n, 0) AS BIGINT) AS n_calls, CAST(coalesce(g, 0) AS BIGINT) AS sum_genotype FROM v LEFT JOIN al USING (k) LEFT JOIN (SELECT k, count(*) AS n, sum(g1 + g2) AS g FROM c GROUP BY k) USING (k)")
def s8_parse_round_trip(spark, sf_dir):
    """Rows to VCF lines and back through the parser."""
    v = variants(spark, sf_dir)
    rows = vcf.well_formed(vcf.parse(v.select(export.encode_line(v).alias("value"))))
    total = F.aggregate(F.flatten("call.genotype"), F.lit(0).cast("long"), lambda a, b: a + b)
    n = F.size(F.filter("call", lambda c: F.size(c["genotype"]) > 0)).cast("long")
    return rows.select(*SITE, F.array_join("alternate_bases", ",").alias("alts"), F.array_join("names", ";").alias("names"), F.array_join("filter", ";").alias("filter"), n.alias("n_calls"), total.alias("sum_genotype"))


@query("""SELECT k, quality, coalesce(i.n, 0) AS n_alt, AC, AN, AC_male, AC_female, vep, coalesce(calls, '') AS calls FROM v
  LEFT JOIN (SELECT k, count(*) AS n, string_agg(AC, ',' ORDER BY alt) AS AC, string_agg(AN, ',' ORDER BY alt) AS AN, string_agg(AC_male, ',' ORDER BY alt) AS AC_male, string_agg(AC_female, ',' ORDER BY alt) AS AC_female FROM a GROUP BY k) i USING (k)
  LEFT JOIN (SELECT k, string_agg(CASE WHEN alts = reference_bases THEN '-' ELSE alt END || '|' || symbol || '|' || consequence || '|' || impact, ',' ORDER BY alt, symbol, consequence, impact) AS vep FROM ve JOIN al USING (k) GROUP BY k) t USING (k)
  LEFT JOIN (SELECT k, string_agg(g1 || '/' || g2 || ' ' || CASE sample_id % 2 WHEN 0 THEN 'p' || sample_id ELSE '.' END || ' ' || CASE sample_id % 3 WHEN 0 THEN '.' ELSE CAST(sample_id % 100 AS VARCHAR) END, ',' ORDER BY sample_id) AS calls FROM c GROUP BY k) u USING (k)""")
def k9_export_values(spark, sf_dir):
    """The INFO and FORMAT values of export lines, calls with phase sets and a further field, read apart again."""
    i = lambda c: c["sample_id"]
    more = F.transform("call", lambda c: c.withField("phaseset", F.when(i(c) % 2 == 0, F.concat(F.lit("p"), i(c).cast("string")))).withField("GQ", F.when(i(c) % 3 != 0, i(c) % 100)))
    v = variants(spark, sf_dir).withColumn("call", more)
    rows = vcf.well_formed(vcf.parse(v.select(export.encode_line(v).alias("value"))))
    dot = lambda x: F.coalesce(x, F.lit("."))
    calls = F.transform("call", lambda c: F.concat_ws(" ", F.array_join(c["genotype"], "/"), dot(c["phaseset"]), dot(F.try_element_at(c["info"], F.lit("GQ")))))
    info = {k: F.try_element_at("info", F.lit(k)) for k in ("AC", "AN", "AC_male", "AC_female", "vep")}
    n = F.size("alternate_bases").cast("long").alias("n_alt")
    return rows.select(F.col("info")["NS"].cast("long").alias("k"), "quality", n, *[x.alias(k) for k, x in info.items()], F.array_join(calls, ",").alias("calls"))


@query("SELECT sample_id, count(*) AS n FROM c GROUP BY 1")
def a8_sample_counts(spark, sf_dir):
    return variants(spark, sf_dir).select(F.explode("call.sample_id").alias("sample_id")).groupBy("sample_id").agg(F.count("*").alias("n"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("sample_id"), F.col("s_name").alias("sample_name"))


@query("SELECT s_name AS sample_name, count(*) AS n FROM vc LEFT JOIN supplier ON s_suppkey = sample_id GROUP BY 1")
def j1_sample_names(spark, sf_dir):
    x = flatten.by_sample(variants(spark, sf_dir)).groupBy("sample_id").agg(F.count("*").alias("n"))
    return samples.to_names(x, _people(spark, sf_dir)).select("sample_name", "n")


@query("SELECT sample_id, reference_name, count(*) AS n FROM vc WHERE sample_id IN (SELECT s_suppkey FROM supplier WHERE s_name LIKE '%7') GROUP BY 1, 2")
def j2_sample_ids(spark, sf_dir):
    """Variants of samples that are asked for by name."""
    asked = _people(spark, sf_dir).where("sample_name LIKE '%7'").select("sample_name")
    ids = samples.to_ids(asked, _people(spark, sf_dir))
    x = flatten.by_sample(variants(spark, sf_dir)).join(ids.select("sample_id"), "sample_id", "left_semi")
    return x.groupBy("sample_id", "reference_name").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT sample_id FROM c")
def a6_combined_sample_ids(spark, sf_dir):
    ids = samples.combined_ids(variants(spark, sf_dir))
    return spark.createDataFrame([(i,) for i in ids], "sample_id long")


@query("SELECT reference_name, CAST(sum(start_position * n) AS BIGINT) AS checksum FROM v JOIN (SELECT k, count(*) AS n FROM c GROUP BY k) USING (k) GROUP BY 1")
def a14_weighted_checksum(spark, sf_dir):
    x = variants(spark, sf_dir).where(F.size("call") > 0)
    return x.groupBy("reference_name").agg(F.sum(F.col("start_position") * F.size("call")).alias("checksum"))


@query("SELECT reference_name, start_position, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k FROM v WHERE (reference_name = 'chr1' AND end_position <= 1000) OR reference_name = 'chr2' OR (reference_name = 'chr21' AND start_position >= 500 AND end_position <= 900) GROUP BY 1, 2")
def k4_region_table(spark, sf_dir):
    """A sharded table written, then read by regions through its folders."""
    path = storage.folder(spark, "k4")
    shards = [shard.Shard(s.suffix, s.regions, 400_000, s.residual) for s in SHARDS]  # wider buckets
    table.create(shard.route(variants(spark, sf_dir).drop("alternate_bases", "call"), shards), path)
    x = shard.read_regions(spark, path, [*REGIONS, shard.parse_region("chr21:500-900")], shards)
    return x.groupBy("reference_name", "start_position").agg(F.count("*").alias("n"), F.sum("NS").alias("sum_k"))


@query("SELECT * FROM (VALUES ('INFO', 'AC', '.', 'Integer'), ('INFO', 'DB', '0', 'Flag'), ('INFO', 'NS', '1', 'Float'), ('INFO', 'QT', '.', 'Float'), ('INFO', 'TX', '1', 'String'), ('FORMAT', 'GQ', '1', 'Integer'), ('FORMAT', 'GT', '1', 'String'), ('FORMAT', 'ZZ', '.', 'String')) t(category, id, number, type)")
def h5_completed_header(spark, sf_dir):
    """Fields that lines use without a definition, and definitions that their values don't fit."""
    k = F.col("o_orderkey")
    info = F.concat(F.lit("NS="), (k / 2).cast("string"), F.when(k % 2 == 0, ";DB").otherwise(""), F.lit(";QT=1.5,2;AC=3;TX="), F.col("o_orderpriority"))
    line = F.concat_ws("\t", F.lit("chr1"), (k + 1).cast("string"), F.lit("."), F.lit("A"), F.lit("C,T"), F.lit("."), F.lit("PASS"), info, F.lit("GT:GQ:ZZ"), F.concat(F.lit("0/1:7:x,"), F.col("o_orderstatus")))
    rows = vcf.well_formed(vcf.parse(spark.read.parquet(f"{sf_dir}/orders.parquet").select(line.alias("value"))))
    head = header.parse(['##INFO=<ID=NS,Number=1,Type=Integer,Description="n">', '##INFO=<ID=AC,Number=A,Type=Integer,Description="c">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="q">'])
    done = header.completed(rows, head)
    return spark.createDataFrame([(s, i, x["Number"], x["Type"]) for s in ("INFO", "FORMAT") for i, x in done.sections[s].items()], "category string, id string, number string, type string")


@query("SELECT CASE WHEN g1 = 0 AND g2 = 0 THEN 'reference' ELSE 'variant' END AS kind, count(*) AS n FROM c GROUP BY 1")
def p14_reference_calls(spark, sf_dir):
    x = bind.hom_ref_calls(variants(spark, sf_dir)).select(F.size("call").alias("v"), F.size("hom_ref_call").alias("r"))
    return x.agg(F.sum("v").alias("v"), F.sum("r").alias("r")).selectExpr("stack(2, 'variant', v, 'reference', r) AS (kind, n)")


DECILES = [i / 10 for i in range(11)]


@query("SELECT " + ", ".join(f"CAST(quantile_disc({c}, {p}) AS BIGINT) AS {c.lower()}{i}" for c in ("AC", "AN") for i, p in enumerate(DECILES)) + " FROM va")
def a12_deciles(spark, sf_dir):
    """All deciles of both counts, exactly."""
    x = alternates(variants(spark, sf_dir))
    return x.agg(*[F.expr(f"CAST(percentile_disc({p}) WITHIN GROUP (ORDER BY {c}) AS BIGINT)").alias(f"{c.lower()}{i}") for c in ("AC", "AN") for i, p in enumerate(DECILES)])


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are done are non-variant intervals, the others are variants; the customer is the sample."""
    o, k = spark.read.parquet(f"{sf_dir}/orders.parquet"), F.col("o_orderkey")
    done, start = F.col("o_orderstatus") == "F", 37 * (k % 199)
    call = F.struct(F.col("o_custkey").cast("long").alias("sample_id"), F.array(F.lit(0), F.when(done, 0).otherwise(1)).alias("genotype"), F.lit(None).cast("string").alias("phaseset"))
    return o.select(
        F.concat(F.lit("chr"), (1 + F.col("o_custkey") % 22).cast("string")).alias("reference_name"), start.cast("long").alias("start_position"),
        (start + F.when(done, 5 + k % 40).otherwise(1 + k % 3)).cast("long").alias("end_position"), F.lit("A").alias("reference_bases"), F.when(done, F.array(F.lit("<*>"))).otherwise(F.array(F.lit("T"))).alias("alternate_bases"),
        F.array(F.concat(F.lit("rs"), k.cast("string"))).alias("names"), F.col("o_totalprice").alias("quality"), F.array("o_orderstatus").alias("filter"), F.array(call).alias("call"),
    )


#: Positions one by one: what blocks cover, less what variants with a covered position span.
BLOCKS = """
, r AS (SELECT 'chr' || (1 + o_custkey % 22) AS ref, 37 * (o_orderkey % 199) AS s, o_orderstatus = 'F' AS done, 37 * (o_orderkey % 199) + CASE WHEN o_orderstatus = 'F' THEN 5 + o_orderkey % 40 ELSE 1 + o_orderkey % 3 END AS e FROM orders),
w AS (SELECT ref, done, w, greatest(s, w * 500) AS s, least(e, (w + 1) * 500) AS e FROM (SELECT *, unnest(range(s // 500, (e - 1) // 500 + 1)) AS w FROM r)),
cover AS (SELECT ref, p, count(*) AS n FROM (SELECT ref, unnest(range(s, e)) AS p FROM w WHERE done) GROUP BY ALL),
site AS (SELECT ref, w, s, e, count(*) AS n FROM w WHERE NOT done GROUP BY ALL),
hit AS (SELECT site.ref, s, e, any_value(site.n) AS own, min(p) AS p, arg_min(cover.n, p) AS more FROM site LEFT JOIN cover ON cover.ref = site.ref AND p >= s AND p < e GROUP BY ALL),
taken AS (SELECT DISTINCT ref, unnest(range(s, e)) AS p FROM hit WHERE p IS NOT NULL)
"""


@query(BLOCKS + """SELECT ref AS reference_name, kind, count(*) AS n, CAST(sum(calls) AS BIGINT) AS calls FROM (SELECT ref, 'variant' AS kind, own + coalesce(more, 0) AS calls FROM hit
  UNION ALL SELECT ref, 'covered position', n FROM cover WHERE NOT EXISTS (FROM taken t WHERE t.ref = cover.ref AND t.p = cover.p)) GROUP BY ALL""")
def a5_reference_blocks(spark, sf_dir):
    m = intervals.merge_with_blocks(_blocks(spark, sf_dir), 500)
    non, length = intervals.is_non_variant(m), F.col("end_position") - F.col("start_position")
    return m.groupBy("reference_name", F.when(non, "covered position").otherwise("variant").alias("kind")).agg(F.sum(F.when(non, length).otherwise(1)).alias("n"), F.sum(F.when(non, length).otherwise(1) * F.size("call")).alias("calls"))


ANNOTATION = ["SYMBOL", "Consequence", "ALLELE_NUM"]


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as variants with one annotation text each."""
    i, even = F.col("p_size") % 5 + 1, F.col("p_partkey") % 2 == 0
    allele = F.element_at(F.array(*[F.lit(a) for a in ("-", "ATT", "DEL", "TG", "AT")]), i)
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("k"), F.lit("CAT").alias("reference_bases"), F.when(even, F.array(F.lit("C"), F.lit("CATT"))).otherwise(F.array(F.lit("C"), F.lit("<DEL>"))).alias("alternate_bases"),
        F.concat_ws("|", allele, "p_brand", "p_type", (F.col("p_size") % 4).cast("string")).alias("csq"),
    )


def _by_alternate(x: DataFrame) -> DataFrame:
    return x.select("k", F.inline("alternate_bases")).select("k", "alt", F.inline("csq")).select("k", "alt", "allele", F.col("SYMBOL").alias("symbol"), F.col("Consequence").alias("consequence"))


PARTS = ", p AS (SELECT p_partkey AS k, p_brand AS symbol, p_type AS consequence, p_size, ['-', 'ATT', 'DEL', 'TG', 'AT'][p_size % 5 + 1] AS allele, p_partkey % 2 = 0 AS even FROM part) "


@query(PARTS + "SELECT k, CASE allele WHEN '-' THEN 'C' WHEN 'ATT' THEN 'CATT' ELSE '<DEL>' END AS alt, allele, symbol, consequence FROM p WHERE (even AND allele IN ('-', 'ATT')) OR (NOT even AND allele = 'DEL')")
def v3_annotations(spark, sf_dir):
    """A shared first base is left off the alternates only where all of them have it."""
    return _by_alternate(annotate.attach(_annotated(spark, sf_dir), "csq", ANNOTATION))


@query(PARTS + "SELECT k, CASE WHEN allele = 'DEL' THEN '<DEL>' ELSE 'C' END AS alt, allele, symbol, consequence FROM p WHERE allele = '-' OR (NOT even AND allele = 'DEL')")
def v4_annotations_minimal(spark, sf_dir):
    return _by_alternate(annotate.attach(_annotated(spark, sf_dir), "csq", ANNOTATION, "minimal"))


@query(PARTS + "SELECT k, CASE WHEN p_size % 4 = 1 THEN 'C' WHEN even THEN 'CATT' ELSE '<DEL>' END AS alt, allele, symbol, consequence FROM p WHERE p_size % 4 IN (1, 2)")
def v5_annotations_by_number(spark, sf_dir):
    return _by_alternate(annotate.attach(_annotated(spark, sf_dir), "csq", ANNOTATION, "allele_num"))


@query(PARTS + "SELECT count(*) AS variants, count(*) AS annotations, CAST(count_if(NOT ((even AND allele IN ('-', 'ATT')) OR (NOT even AND allele = 'DEL'))) AS BIGINT) AS unmatched, CAST(0 AS BIGINT) AS ambiguous, CAST(0 AS BIGINT) AS wrong_width FROM p")
def v8_annotation_counters(spark, sf_dir):
    return annotate.problems(_annotated(spark, sf_dir), "csq", ANNOTATION)


@query(PARTS + """SELECT count(*) AS variants, count(*) AS annotations, CAST(count_if(NOT (allele = '-' OR (NOT even AND p_size % 7 <> 0 AND allele = 'DEL'))) AS BIGINT) AS unmatched,
  CAST(count_if(p_size % 7 = 0 AND allele = '-') AS BIGINT) AS ambiguous, CAST(count_if(p_size % 3 = 0) AS BIGINT) AS wrong_width FROM p""")
def v8_annotation_counters_minimal(spark, sf_dir):
    """The minimal mode: some variants have two alternates that only delete bases, some annotations a field too many."""
    x = _annotated(spark, sf_dir)
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"), "p_size")
    x = x.join(parts, "k").withColumn("csq", F.when(F.col("p_size") % 3 == 0, F.concat("csq", F.lit("|x"))).otherwise(F.col("csq")))
    x = x.withColumn("alternate_bases", F.when(F.col("p_size") % 7 == 0, F.array(F.lit("C"), F.lit("CA"))).otherwise(F.col("alternate_bases")))
    return annotate.problems(x, "csq", ANNOTATION, "minimal")


@query(PARTS + "SELECT k, allele || '|' || symbol || '|' || consequence || '|' || p_size % 4 AS csq FROM p WHERE (even AND allele IN ('-', 'ATT')) OR (NOT even AND allele = 'DEL')")
def v7_annotation_text(spark, sf_dir):
    x = annotate.attach(_annotated(spark, sf_dir), "csq", ANNOTATION)
    return x.select("k", annotate.to_text("csq", ANNOTATION).alias("csq")).where("csq IS NOT NULL")


BOUND = header.parse(
    ['##INFO=<ID=NS,Number=1,Type=Integer,Description="n">', '##INFO=<ID=QT,Number=.,Type=Float,Description="q">', '##INFO=<ID=AC,Number=A,Type=Integer,Description="c">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="d">', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="g">']
)


@query("SELECT o_orderkey AS ns, o_orderkey % 2 = 0 AS db, CAST(o_custkey AS BIGINT) AS ac1, CAST(o_custkey + 1 AS BIGINT) AS ac2, CAST(2 AS BIGINT) AS n_qt, -31.0::DOUBLE AS missing, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE CAST(o_orderkey % 99 AS BIGINT) END AS gq FROM orders")
def p6_typed_binding(spark, sf_dir):
    """Lines with typed INFO and FORMAT fields through the parser and the binding."""
    k = F.col("o_orderkey")
    info = F.concat(F.lit("NS="), k.cast("string"), F.when(k % 2 == 0, ";DB").otherwise(""), F.lit(";QT=1.5,.;AC="), F.concat_ws(",", F.col("o_custkey").cast("string"), (F.col("o_custkey") + 1).cast("string")))
    gq = F.when(k % 3 == 0, ".").otherwise((k % 99).cast("string"))
    line = F.concat_ws("\t", F.lit("chr1"), (k + 1).cast("string"), F.lit("."), F.lit("A"), F.lit("C,T"), F.lit("."), F.lit("PASS"), info, F.lit("GT:GQ"), F.concat(F.lit("0/1:"), gq))
    rows = vcf.well_formed(vcf.parse(spark.read.parquet(f"{sf_dir}/orders.parquet").select(line.alias("value"))))
    x = bind.bind(rows, BOUND)
    return x.select(F.col("NS").alias("ns"), F.col("DB").alias("db"), F.col("alternate_bases")[0]["AC"].alias("ac1"), F.col("alternate_bases")[1]["AC"].alias("ac2"), F.size("QT").cast("long").alias("n_qt"), F.col("QT")[1].alias("missing"), F.coalesce(F.col("call")[0]["GQ"], F.lit(-1)).alias("gq"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables -> variants -> shards -> merged calls -> calls by shard."""
    m = merge.move_to_calls(variants(spark, sf_dir))
    return shard.route(m, SHARDS).groupBy("shard").agg(F.count("*").alias("variants"), F.sum(F.size("call")).alias("calls"))


def queries() -> dict[str, Query]:
    return {k: f for k, (f, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in _found.items() if s}
