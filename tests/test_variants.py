import duckdb
import pyspark.sql.types as T
import pytest

from helixframe.functions.sample_id import sample_id, stable_id
from helixframe.operators import header, merge, shard
from helixframe.plans import catalogue
from helixframe.sources import vcf

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = catalogue.queries()[name](spark, SF).toPandas(), duck.sql(catalogue.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).values.tolist()))
    assert rows(got) == rows(want)


def test_sample_ids():
    # Published golden values.
    assert [sample_id(f"NA0000{i}") for i in (1, 2, 3, 4)] == [1461155635506253861, 8469201776453291698, 2841064610214975654, 7282355041988662653]
    assert stable_id(["str1", "str2"]) != stable_id(["str1", "str2", "str3"])
    with pytest.raises(ValueError):
        sample_id("")


def test_bucket_width():
    assert shard.bucket_width(249_240_615) == 62_340


def test_regions():
    assert shard.parse_region("chr1:1,000-2,000") == shard.Region("chr1", 1000, 2000)
    assert shard.parse_region("HLA-A*01:01:01:01").reference == "HLA-A*01:01:01:01"
    with pytest.raises(ValueError):
        shard.parse_region("chr1:20-10")


def test_overlapping_shards_are_rejected():
    item = lambda s, r: {"output_table": {"table_name_suffix": s, "regions": [r], "partition_range_end": 10}}
    with pytest.raises(ValueError):
        shard.parse_shards([item("a", "chr1:0-10"), item("b", "chr1:5-20")])


def test_parse_lines(spark):
    lines = [
        ("#CHROM\tPOS",),
        ("20\t14370\trs6;rs7\tG\tA,T\t29\tPASS\tNS=3;DB;AF=0.5,0.1\tGT:GQ\t0|0:48\t1/.:.",),
        ("20\t2\t.\tN\t<DEL>\t0\tq10;s50\tEND=99\tGT\t./.",),
        ("20\t\t.\tN\tA\t.\t.\t.",),
    ]
    rows = vcf.parse(spark.createDataFrame(lines, "value string"), ["A", "B"])
    good = vcf.well_formed(rows).orderBy("start_position").collect()
    assert [(r.start_position, r.end_position, r.quality) for r in good] == [(1, 99, None), (14369, 14370, 29.0)]
    assert good[1].info == {"NS": "3", "DB": None, "AF": "0.5,0.1"} and good[1].names == ["rs6", "rs7"]
    assert [(c.name, c.genotype, c.phaseset) for c in good[1].call] == [("A", [0, 0], "*"), ("B", [1, -1], None)]
    assert good[0].call[0].genotype == [-1, -1] and good[0].info == {}
    assert vcf.malformed(rows).count() == 1


def test_header_merge_and_schema():
    a = header.parse(['##INFO=<ID=DP,Number=1,Type=Integer,Description="d, e">', '##INFO=<ID=AF,Number=A,Type=Float,Description="f">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"])
    b = header.parse(['##INFO=<ID=DP,Number=1,Type=Float,Description="d">'])
    m = header.merge([a, b])
    assert m.sections["INFO"]["DP"]["Type"] == "Float" and m.samples == ["S1"]
    s = header.schema(m)
    assert s["DP"].dataType.simpleString() == "double"
    assert s["alternate_bases"].dataType.simpleString() == "array<struct<alt:string,AF:double>>"
    with pytest.raises(ValueError):
        header.merge([a, header.parse(['##INFO=<ID=DP,Number=1,Type=String,Description="d">'])])
    with pytest.raises(ValueError):
        merge.merge_schema(s, T.StructType([T.StructField("DP", T.LongType())]))
