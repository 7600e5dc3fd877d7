from helixframe.operators import annotate, bind, export, header
from helixframe.sources import vcf

SCHEMA = """reference_name string, start_position long, end_position long, reference_bases string, alternate_bases array<struct<alt:string,AC:long,CSQ:array<struct<allele:string,SYMBOL:string,IMPACT:string>>>>,
names array<string>, quality double, filter array<string>, call array<struct<sample_id:long,name:string,genotype:array<long>,phaseset:string,GQ:long,AD:array<long>>>, NS long, DB boolean, AA string, QT array<double>"""


def _lines(spark, *rows):
    x = spark.createDataFrame(rows, SCHEMA)
    return [r.value.split("\t") for r in x.select(export.encode_line(x).alias("value")).collect()]


def test_every_info_and_format_value_is_written(spark):
    alts = [("C", 3, [("C", "G1", None), ("C", "G2", "HIGH")]), ("T", None, [])]
    calls = [(1, "a", [0, 1], "*", 48, [1, 2]), (2, "b", [1, -1], "p7", None, []), (3, "c", [], None, None, None)]
    f = _lines(spark, ("1", 9, 20, "A", alts, ["rs1"], 29.0, ["PASS"], calls, 0, True, "x", [1.5, None]))[0]
    assert f[:7] == ["1", "10", "rs1", "A", "C,T", "29.0", "PASS"]
    assert f[7].split(";") == ["END=20", "NS=0", "DB", "AA=x", "QT=1.5,.", "AC=3,.", "CSQ=C|G1|,C|G2|HIGH"]
    assert f[8:] == ["GT:AD:GQ:PS", "0|1:1,2:48:.", "1|.:.:.:p7", ".:.:.:."]


def test_what_a_row_lacks_is_left_out(spark):
    none, bare = _lines(
        spark,
        ("1", 9, 10, "A", [], [], None, None, [], None, False, None, []),
        ("1", 9, 10, "A", [("C", None, None)], [], 0.0, [], [(1, "a", [-1], None, None, None)], None, None, None, None),
    )
    assert none == ["1", "10", ".", "A", ".", ".", ".", ".", "."]
    assert bare == ["1", "10", ".", "A", "C", "0.0", ".", ".", "GT", "."]


def test_lines_bind_to_the_rows_they_came_from(spark):
    lines = [
        '##INFO=<ID=NS,Number=1,Type=Integer,Description="n">', '##INFO=<ID=AC,Number=A,Type=Integer,Description="c">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="d">', '##INFO=<ID=QT,Number=.,Type=Float,Description="q">',
        '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="g">', '##FORMAT=<ID=AD,Number=.,Type=Integer,Description="a">',
    ]
    read = lambda x: bind.bind(vcf.well_formed(vcf.parse(x, ["a", "b"])), header.parse(lines))
    text = [("1\t10\trs1\tA\tC,T\t29.0\tPASS\tNS=3;DB;QT=1.5,2.0;AC=4,.\tGT:GQ:AD:PS\t0|1:7:1,2:p7\t1/.:.:.:.",), ("1\t11\t.\tA\tC\t.\t.\t.\tGT\t0/0\t0/1",)]
    first = spark.createDataFrame((x := read(spark.createDataFrame(text, "value string"))).collect(), x.schema)
    again = read(spark.createDataFrame(first.select(export.encode_line(first).alias("value")).collect(), "value string"))
    assert first.orderBy("start_position").collect() == again.orderBy("start_position").collect()
    assert [a.AC for a in again.orderBy("start_position").first().alternate_bases] == [4, None]


def test_annotations_without_an_allele_find_their_alternate_again(spark):
    x = spark.createDataFrame([("AT", [("ATT", [("g1",)]), ("A", [("g2",)]), ("AG", [("g3",)])]), ("A", [("<DEL>", [("g4",)]), ("T", [])])], "reference_bases string, alternate_bases array<struct<alt:string,csq:array<struct<SYMBOL:string>>>>")
    text = x.select("reference_bases", "alternate_bases.alt", annotate.to_text("csq", ["SYMBOL"], False).alias("csq")).withColumnRenamed("alt", "alternate_bases")
    out = annotate.attach(text, "csq", ["SYMBOL"]).collect()
    assert [[[e.SYMBOL for e in a.csq] for a in r.alternate_bases] for r in out] == [[["g1"], ["g2"], ["g3"]], [["g4"], []]]
