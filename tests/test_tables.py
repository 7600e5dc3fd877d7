import pytest

from helixframe.operators import annotate, bind, header, intervals, report
from helixframe.sources import vcf

ROW = "reference_name string, start_position long, end_position long, reference_bases string, alternate_bases array<string>, names array<string>, quality double, filter array<string>, call array<struct<sample_id:long,genotype:array<int>,phaseset:string>>"


def _row(start, end, alts, sample, quality=None, names=()):
    return ("1", start, end, "A", alts, list(names), quality, [], [(sample, [0], None)])


def _merged(spark, rows, window=2500):
    out = intervals.merge_with_blocks(spark.createDataFrame(rows, ROW), window).collect()
    return sorted((r.start_position, r.end_position, [c.sample_id for c in r.call], r.quality) for r in out)


def test_blocks_are_cut_and_combined(spark):
    rows = [_row(0, 10, [], 1, 5.0), _row(5, 15, ["<*>"], 2, 3.0)]
    assert _merged(spark, rows) == [(0, 5, [1], 5.0), (5, 10, [1, 2], 3.0), (10, 15, [2], 3.0)]


def test_variants_take_calls_of_a_block_and_cut_it(spark):
    rows = [_row(0, 10, ["<NON_REF>"], 1), _row(4, 5, ["T"], 2), _row(5, 6, ["G"], 3), _row(30, 31, ["G"], 4)]
    assert _merged(spark, rows) == [(0, 4, [1], None), (4, 5, [1, 2], None), (5, 6, [1, 3], None), (6, 10, [1], None), (30, 31, [4], None)]


def test_windows_cut_blocks(spark):
    assert _merged(spark, [_row(90, 210, [], 1)], 100) == [(90, 100, [1], None), (100, 200, [1], None), (200, 210, [1], None)]
    assert _merged(spark, []) == []


@pytest.mark.parametrize(
    ("ref", "alts", "allele", "mode", "want"),
    [
        ("A", ["T"], "T", "default", 0), ("AT", ["ATT", "A"], "TT", "default", 0), ("AT", ["ATT", "A"], "-", "default", 1), ("A", ["<ID>"], "ID", "default", 0),
        ("A", [".[13:123["], ".[13", "default", 0), ("A", ["T"], "G", "default", None), ("AT", ["TT", "A"], "T", "minimal", 0), ("AT", ["TT", "A"], "-", "minimal", 1),
        ("C", ["CT", "T"], "T", "minimal", None), ("C", [], "T", "minimal", None), ("A", ["T", "G"], "x", "allele_num", 1),
    ],
)
def test_annotation_matching(spark, ref, alts, allele, mode, want):
    x = spark.createDataFrame([(ref, alts, f"{allele}|gene|2")], "reference_bases string, alternate_bases array<string>, csq string")
    out = annotate.attach(x, "csq", ["SYMBOL", "ALLELE_NUM"], mode).first().alternate_bases
    assert [i for i, a in enumerate(out) if a.csq] == ([] if want is None else [want])


def test_annotation_names_and_counters(spark):
    assert annotate.field_names("Allele|Consequence|IMPACT") == ["Consequence", "IMPACT"]
    with pytest.raises(ValueError):
        annotate.field_names("none")
    x = spark.createDataFrame([("C", ["CT", "T"], "T|a|1,T|b"), ("C", ["CT"], None)], "reference_bases string, alternate_bases array<string>, csq string")
    assert tuple(annotate.problems(x, "csq", ["SYMBOL", "ALLELE_NUM"], "minimal").first()) == (1, 2, 0, 2, 1)


LINES = [
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="d">', '##INFO=<ID=AF,Number=A,Type=Float,Description="a">', '##INFO=<ID=XS,Number=.,Type=Float,Description="x">',
    '##INFO=<ID=1k,Number=0,Type=Flag,Description="k">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="q">',
]


def _bound(spark, info, lenient=False, alts="C,T", call="0/1:7"):
    line = "\t".join(["1", "10", ".", "A", alts, "9", "PASS", info, "GT:GQ", call])
    return bind.bind(vcf.well_formed(vcf.parse(spark.createDataFrame([(line,)], "value string"))), header.parse(LINES), lenient)


def test_binding_types_and_cleans(spark):
    r = _bound(spark, "DP=3;AF=0.12345678,inf;XS=.,2,nan;1k").first()
    assert [a.AF for a in r.alternate_bases] == [0.123457, bind.LARGEST] and r.DP == 3 and r.field_1k is True
    assert r.XS == [-31.0, 2.0, -31.0] and r.call[0].GQ == 7 and r.call[0].genotype == [0, 1]
    r = _bound(spark, ".", call="./.:.").first()
    assert r.DP is None and r.XS == [] and r.field_1k is False and r.call[0].GQ is None
    assert bind.without_empty_calls(_bound(spark, ".", call="./.:.")).first().call == []
    out = bind.hom_ref_calls(_bound(spark, ".", call="0/0:4")).first()
    assert out.call == [] and out.hom_ref_call[0].name == "1"


def test_binding_strict_and_lenient(spark):
    for info in ("DP=x", "AF=1"):
        with pytest.raises(Exception, match="DP is not|AF has not"):
            _bound(spark, info).collect()
    assert _bound(spark, "DP=x", lenient=True).first().DP is None
    assert [a.AF for a in _bound(spark, "AF=1", lenient=True).first().alternate_bases] == [1.0, None]


def test_wide_rows_are_split(spark):
    x = spark.createDataFrame([(1, [("a" * 10,)] * 7), (2, [])], "k int, call array<struct<name:string>>")
    out = bind.split_wide_rows(x, most_bytes=60, least_calls=3).collect()
    parts = [len(r.call) for r in out if r.k == 1]
    assert sum(parts) == 7 and len(parts) > 1 and [len(r.call) for r in out if r.k == 2] == [0]
    assert bind.split_wide_rows(x).count() == 2


def test_report(spark):
    rows = [(f'##INFO=<ID=NS,Number=1,Type={t},Description="">', f) for t, f in (("Float", "f1"), ("Integer", "f2"), ("Integer", "f3"))] + [('##INFO=<ID=DP,Number=1,Type=Integer,Description="">', "f1")]
    d = header.definitions(spark.createDataFrame(rows, "value string, file_path string"))
    got = report.lines(d, header.parse([rows[0][0]]))
    assert got[2:] == ["NS\tINFO\tnum=1 type=Float\tf1\tnum=1 type=Float", " \t \tnum=1 type=Integer\tf2\t ", " \t \t \tf3\t "]
    bad = vcf.malformed(vcf.parse(spark.createDataFrame([("1\tx", "f")], "value string, file_path string")))
    assert report.malformed_lines(bad).first().value == "f\t1 x\ttoo few columns"
