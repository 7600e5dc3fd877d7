import pytest

from helixframe.operators import bind, header
from helixframe.sources import vcf

HEADER = header.parse(['##INFO=<ID=NS,Number=1,Type=Integer,Description="n">', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="g">'])


def _rows(spark, info, form="GT:GQ", call="0/1:7"):
    line = "\t".join(["1", "10", ".", "A", "C", "9", "PASS", info, form, call])
    return vcf.well_formed(vcf.parse(spark.createDataFrame([(line,)], "value string")))


def test_undefined_keys_are_errors_when_strict(spark):
    assert bind.bind(_rows(spark, "NS=1;END=12"), HEADER).first().NS == 1
    for x, key in ((_rows(spark, "NS=1;XX=2"), "XX"), (_rows(spark, "NS=1", "GT:GQ:YY", "0/1:7:3"), "YY")):
        with pytest.raises(Exception, match=f"no such field in the header: {key}"):
            bind.bind(x, HEADER).select("NS").collect()
        assert bind.bind(x, HEADER, lenient=True).first().NS == 1


def test_format_is_inferred(spark):
    x = _rows(spark, ".", "GT:GQ:AD:FT:PL:MM", "0/1:7:1,2:ok:1.5").union(_rows(spark, ".", "GT:GQ:AD:FT:PL:MM", "0/1:.:3:2:4:."))
    got = {r.id: (r.number, r.type) for r in header.infer_format(x).collect()}
    assert got == {"GQ": ("1", "Integer"), "AD": (".", "Integer"), "FT": ("1", "String"), "PL": ("1", "Float"), "MM": ("1", "Integer")}


def test_names_by_file(spark):
    head, data = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t", "1\t10\t.\tA\tC\t9\tPASS\t.\tGT\t"
    lines = spark.createDataFrame([(head + "A\tB", "f1"), (data + "0/1\t1/1", "f1"), (head + "C", "f2"), (data + "0/0", "f2"), (data + "0/0", "f3")], "value string, file_path string")
    rows = vcf.parse(lines, vcf.sample_names(lines)).collect()
    assert sorted([c.name for c in r.call] for r in rows) == [["1"], ["A", "B"], ["C"]]
