"""Files to tables and back: headers and samples by file, inference, shards, appends, export, the command line."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from helixframe import cli
from helixframe.functions.sample_id import sample_id, stable_id
from helixframe.operators import bind, export, header, reserved, samples, shard, table
from helixframe.sources import files, vcf

HEAD = ['##fileformat=VCFv4.2', '##INFO=<ID=NS,Number=1,Type=Integer,Description="n">', '##INFO=<ID=AF,Number=A,Type=Float,Description="f">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="d">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="q">']
COLUMNS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"
ONE = [*HEAD, f"{COLUMNS}\tann\tben", "chr1\t11\trs1\tA\tC,G\t30\tPASS\tNS=2;AF=0.5,0.25;DB\tGT:GQ\t0|1:40\t1/2:7", "chr1\t1000\t.\tAT\tA\t.\tq10\tNS=1\tGT\t0/0\t./."]
TWO = [*HEAD, f"{COLUMNS}\tcia", "chr1\t11\trs2\tA\tC,G\t50\tPASS\tNS=2;AF=0.5,0.25;DB\tGT:GQ\t1/1:9", "chr2\t5\t.\tG\tT\t9\tPASS\tNS=1;AF=1\tGT:GQ\t0/1:."]
SHARDS = "- output_table:\n    table_name_suffix: one\n    regions: [chr1]\n    partition_range_end: 2,000,000\n- output_table:\n    table_name_suffix: rest\n    regions: [residual]\n    partition_range_end: 1000\n"


@pytest.fixture
def place(tmp_path):
    for name, lines in (("a.vcf", ONE), ("b.vcf", TWO)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    (tmp_path / "shards.yaml").write_text(SHARDS)
    return f"file://{tmp_path}"


def run(spark, *args):
    cli.main([str(x) for x in args], spark)


def test_import_and_export_keep_every_field(spark, place, tmp_path):
    run(spark, "import", "--input_pattern", f"{place}/*.vcf", "--output_table", f"{place}/t", "--sharding_config_path", f"{place}/shards.yaml", "--variant_merge_strategy", "MOVE_TO_CALLS", "--sample_lookup_optimized_output_table", f"{place}/s")
    rows = table.read(spark, f"{place}/t")
    first = rows.where("reference_name = 'chr1' AND start_position = 10").first()
    assert sorted(c.sample_id for c in first.call) == sorted(map(sample_id, ("ann", "ben", "cia"))) and first.names == ["rs1", "rs2"] and first.quality == 50
    assert [(a.alt, a.AF) for a in first.alternate_bases] == [("C", 0.5), ("G", 0.25)] and first.DB
    assert table.filled_shards(spark, f"{place}/t") == ["one", "rest"]
    assert spark.read.parquet(f"{place}/s").count() == 3 + 2 + 1
    run(spark, "export", "--input_table", f"{place}/t", "--output_file", f"{place}/out.vcf", "--sharding_config_path", f"{place}/shards.yaml", "--sample_names", "cia", "ann", "ben", "--bq_uses_1_based_coordinate", "false")
    lines = (tmp_path / "out.vcf").read_text().splitlines()
    assert [x for x in lines if not x.startswith("##")] == [
        f"{COLUMNS}\tcia\tann\tben",
        "chr1\t11\trs1;rs2\tA\tC,G\t50.0\tPASS\tNS=2;DB;AF=0.5,0.25\tGT:GQ\t1/1:9\t0|1:40\t1/2:7",
        "chr1\t1000\t.\tAT\tA\t.\tq10\tNS=1\tGT\t.\t0/0\t./.",
        "chr2\t5\t.\tG\tT\t9.0\tPASS\tNS=1;AF=1.0\tGT\t0/1\t.\t.",
    ]
    assert '##INFO=<ID=AF,Number=A,Type=Float,Description="' in "\n".join(lines)
    run(spark, "export", "--input_table", f"{place}/t", "--output_file", f"{place}/region.vcf", "--sharding_config_path", f"{place}/shards.yaml", "--genomic_regions", "chr1:0-500", "--bq_uses_1_based_coordinate", "false")
    assert [x.split("\t")[1] for x in (tmp_path / "region.vcf").read_text().splitlines() if not x.startswith("#")] == ["11"]


def test_regions_read_only_their_folders(spark, place):
    shards = shard.load_shards(spark, f"{place}/shards.yaml")
    rows = spark.range(2000).selectExpr("'chr' || (id % 4) AS reference_name", "id * 900 AS start_position", "id * 900 + 1 AS end_position")
    table.create(shard.route(rows, shards), f"{place}/t")
    region = shard.parse_region("chr1:90,000-200,000")
    got = shard.read_regions(spark, f"{place}/t", [region], shards)
    want = rows.where(shard.region_filter([region]))
    assert sorted(r.start_position for r in got.collect()) == sorted(r.start_position for r in want.collect()) != []
    assert 0 < len(got.inputFiles()) and got.select("shard").distinct().collect()[0].shard == "one"
    scanned = got.select("bucket").distinct().count()
    assert scanned <= 200 and "PartitionFilters: [" in got._jdf.queryExecution().toString() and "bucket" in got._jdf.queryExecution().toString()
    other = shard.read_regions(spark, f"{place}/t", [shard.parse_region("chr3")], shards)
    assert {r.shard for r in other.select("shard").distinct().collect()} == {"rest"} and other.count() == 500


def test_appends(spark, place):
    shards = shard.load_shards(spark, f"{place}/shards.yaml")
    rows = spark.createDataFrame([("chr1", 5, 6, [("C", 1)])], "reference_name string, start_position long, end_position long, alternate_bases array<struct<alt:string,AC:long>>")
    table.create(shard.route(rows, shards), f"{place}/t")
    with pytest.raises(ValueError, match="there already"):
        table.create(shard.route(rows, shards), f"{place}/t")
    wide = spark.createDataFrame([("chr1", 7, 8, [("G", 2, 0.5)], "x")], "reference_name string, start_position long, end_position long, alternate_bases array<struct<alt:string,AC:long,AF:double>>, note string")
    with pytest.raises(ValueError, match="lacks"):
        table.append(shard.route(wide, shards), f"{place}/t")
    table.append(shard.route(wide, shards), f"{place}/t", update_schema=True)
    got = {r.start_position: (r.note, r.alternate_bases[0].AF, r.alternate_bases[0].AC) for r in table.read(spark, f"{place}/t").collect()}
    assert got == {5: (None, None, 1), 7: ("x", 0.5, 2)}
    bad = shard.route(rows, shards).withColumn("end_position", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        table.append(bad, f"{place}/t")
    assert table.read(spark, f"{place}/t").count() == 2


def test_the_default_shards_are_the_human_chromosomes():
    every = shard.human_shards()
    assert len(every) == 25 and every[-1].residual and [r.reference for r in every[22].regions] == ["chrX", "X"]


def test_files(spark, place, tmp_path):
    with pytest.raises(ValueError, match="no file"):
        files.expand(spark, f"{place}/none*")
    (tmp_path / "list").write_text(f"{place}/a.vcf\n{place}/b.vcf\n")
    assert len(files.expand(spark, list_file=f"{place}/list")) == 2
    with pytest.raises(ValueError, match="one compression"):
        files.compression(["x.vcf", "y.vcf.gz"])
    text = "\n".join(TWO).encode() + b"\n"
    (tmp_path / "c.bgz").write_bytes(gzip.compress(text[:300]) + gzip.compress(text[300:]) + gzip.compress(b""))
    assert [r.value for r in files.read_lines(spark, [f"{place}/c.bgz"]).collect()] == TWO
    by = files.headers(files.read_lines(spark, files.expand(spark, f"{place}/*.vcf")))
    assert sorted(h.samples for h in by.values()) == [["ann", "ben"], ["cia"]]
    got = {r.file_path.rsplit("/", 1)[1]: r for r in files.estimates(spark, files.expand(spark, f"{place}/*.vcf")).collect()}
    assert got["a.vcf"].samples == 2 and got["a.vcf"].variants == 1 and got["b.vcf"].bytes == len(text)


def test_inference_and_corrections(spark):
    lines = ["chr1\t1\t.\tA\tC,G\t.\t.\tNS=1.5;XX=3,4;YY;AF=0.1;CSQ=C|1|a|,G|2.5||\tGT:GQ:ZZ\t0/1:1,2:x", "chr1\t2\t.\tA\tC\t.\t.\tNS=2;XX=1;DB=5\tGT\t0/1"]
    rows = vcf.well_formed(vcf.parse(spark.createDataFrame([(x,) for x in lines], "value string")))
    head = header.parse(HEAD)
    done = header.completed(rows, head)
    kinds = lambda s: {k: (x["Number"], x["Type"]) for k, x in done.sections[s].items()}
    assert kinds("INFO") == {"NS": ("1", "Float"), "AF": (".", "Float"), "DB": ("1", "String"), "XX": (".", "Integer"), "YY": ("0", "Flag"), "CSQ": (".", "String")}
    assert kinds("FORMAT") == {"GT": ("1", "String"), "GQ": (".", "Integer"), "ZZ": ("1", "String")}
    found = {r.id: r.type for r in header.annotation_types(rows, "CSQ", ["n", "s", "e"]).collect()}
    assert found == {"CSQ_n_TYPE": "Float", "CSQ_s_TYPE": "String", "CSQ_e_TYPE": "String"}


@pytest.mark.parametrize("line", ['##INFO=<Number=1,Type=Integer>', '##INFO=<ID=X,Number=1,Type=Number>', '##INFO=<ID=X,Number=Z,Type=String>', '##FORMAT=<ID=X,Number=0,Type=Flag>'])
def test_wrong_definitions_are_errors(line):
    with pytest.raises(ValueError):
        header.parse([line])


def test_header_of_a_schema(spark):
    assert len(reserved.FIELDS["INFO"]) == 21 and len(reserved.FIELDS["FORMAT"]) == 15
    head = header.parse(HEAD)
    got = header.from_schema(header.schema(head)).sections
    assert {k: (x["Number"], x["Type"]) for k, x in got["INFO"].items()} == {"AF": ("A", "Float"), "NS": ("1", "Integer"), "DB": ("0", "Flag")}
    assert got["INFO"]["NS"]["Description"] == "Number of samples with data" and got["FORMAT"]["GQ"]["Number"] == "1"
    wrong = header.schema(header.parse(['##INFO=<ID=NS,Number=1,Type=String,Description="">']))
    with pytest.raises(ValueError, match="NS"):
        header.from_schema(wrong)
    assert header.from_schema(wrong, lenient=True).sections["INFO"]["NS"]["Type"] == "String"
    assert header.find(wrong, "call.genotype").dataType.simpleString() == "array<bigint>" and header.find(wrong, "call.none") is None


def test_bound_rows_have_the_schema_of_the_header(spark):
    rows = vcf.well_formed(vcf.parse(spark.createDataFrame([(x,) for x in ONE], "value string"), ["ann", "ben"]))
    head = header.parse(HEAD)
    ids = samples.id_of(samples.known_ids(["ann", "ben"]))
    for name in (True, False):
        got = bind.bind(rows, head, sample_id=ids, call_name=name)
        assert got.schema.simpleString() == header.schema(head, call_name=name).simpleString()
    assert got.first().call[0].sample_id == sample_id("ann")
    with pytest.raises(Exception, match="unknown sample"):
        bind.bind(rows, head, sample_id=samples.id_of({"ann": 1})).collect()


def test_sample_lookups(spark, place):
    people = samples.sample_table(files.read_lines(spark, files.expand(spark, f"{place}/*.vcf")))
    assert {r.sample_name: r.sample_id for r in people.collect()} == {n: sample_id(n) for n in ("ann", "ben", "cia")}
    asked = spark.createDataFrame([("ben",)], "sample_name string")
    assert samples.to_ids(asked, people).first().sample_id == sample_id("ben")
    with pytest.raises(Exception, match="no sample of this name: dan"):
        samples.to_ids(spark.createDataFrame([("dan",)], "sample_name string"), people).collect()
    with pytest.raises(Exception, match="no sample of this id: 3"):
        samples.to_names(spark.createDataFrame([(3,)], "sample_id long"), people).collect()
    calls = lambda *x: spark.createDataFrame([([(i,) for i in y],) for y in x], "call array<struct<sample_id:long>>")
    assert samples.combined_ids(calls([5, 2], [7])) == [2, 5, 7]
    assert samples.combined_ids(calls([5, 2], [5, 2]), preserve_order=True) == [5, 2]
    with pytest.raises(ValueError, match="same order"):
        samples.combined_ids(calls([5, 2], [2, 5]), preserve_order=True)
    with pytest.raises(Exception, match="twice"):
        samples.combined_ids(calls([5, 5]))


def test_published_hash_of_three_strings():
    assert stable_id(["str1", "str2", "str3"]) == 7972645828447426528  # a published vector
    assert sample_id("Sample1") == 6365297890523177914  # a published id


def test_supported_columns_and_files_of_bounded_size(spark, tmp_path):
    rows = spark.sql("SELECT 'chr1' AS reference_name, id AS start_position, id + 1 AS end_position, 'A' AS reference_bases, array(named_struct('alt', 'C')) AS alternate_bases, array('x') AS names, 1.0D AS quality, array('PASS') AS filter, array(named_struct('sample_id', 1L, 'genotype', array(0, 1), 'phaseset', string(null), 'day', current_date())) AS call, current_date() AS day, map('a', 1) AS m FROM range(25)")
    kept = export.supported(rows)
    assert "day" not in kept.columns and "m" not in kept.columns and "day" not in kept.schema["call"].dataType.elementType.fieldNames()
    export.write_shards(kept.coalesce(2), f"file://{tmp_path}/s", ["##fileformat=VCFv4.3"], ["one"], 10)
    texts = [p.read_text().splitlines() for p in tmp_path.glob("s/shard=*/part-*")]
    assert all(t[0] == "##fileformat=VCFv4.3" and t[1].endswith("\tone") and len(t) <= 12 for t in texts) and sum(len(t) - 2 for t in texts) == 25


def test_preprocess(spark, place, tmp_path):
    run(spark, "preprocess", "--input_pattern", f"{place}/*.vcf", "--report_path", f"{place}/r", "--resolved_headers_path", f"{place}/h", "--report_all_conflicts")
    text = "\n".join(p.read_text() for p in tmp_path.glob("r/report/part-*"))
    assert "No Header Conflicts Found." in text and "No Malformed Records Found." in text
    assert "\tann\tben\tcia" in "\n".join(p.read_text() for p in tmp_path.glob("h/part-*"))


@pytest.mark.parametrize("args", [["--infer_headers", "--representative_header_file", "x"], ["--copy_quality_to_calls"], ["--update_schema_on_append"], ["--use_allele_num", "--minimal_vep_alt_matching"]])
def test_options_that_exclude_each_other(args):
    with pytest.raises(ValueError):
        cli.validate(cli.parser().parse_args(["import", "--input_pattern", "x", "--output_table", "y", *args]))


def test_schema_json(spark, tmp_path):
    schema = header.schema(header.parse(HEAD))
    table.write_schema(spark, schema, f"file://{tmp_path}/t")
    assert json.loads(spark.read.text(f"file://{tmp_path}/t/_schema").first().value) == json.loads(schema.json())


def test_annotation_types_are_inferred_on_import(spark, place, tmp_path):
    csq = '##INFO=<ID=CSQ,Number=.,Type=String,Description="Allele|gene|score|count">'
    lines = [*HEAD, csq, f"{COLUMNS}\tann", "chr1\t11\t.\tA\tC,G\t.\tPASS\tNS=2;CSQ=C|x1|1.5|2,G|x2||7\tGT\t0/1", "chr1\t20\t.\tA\tT\t.\tPASS\tCSQ=T|3|2|\tGT\t0/1"]
    (tmp_path / "ann.vcf").write_text("\n".join(lines) + "\n")
    for flags, kinds in (([], ["string"] * 3), (["--infer_annotation_types"], ["string", "double", "bigint"])):
        out = f"{place}/typed{len(flags)}"
        run(spark, "import", "--input_pattern", f"{place}/ann.vcf", "--output_table", out, "--sharding_config_path", f"{place}/shards.yaml", "--annotation_fields", "CSQ", *flags)
        rows = table.read(spark, out)
        fields = rows.schema["alternate_bases"].dataType.elementType["CSQ"].dataType.elementType
        assert [fields[n].dataType.simpleString() for n in ("gene", "score", "count")] == kinds
    got = [r.asDict(True)["alternate_bases"] for r in rows.orderBy("start_position").collect()]
    assert [[(e["gene"], e["score"], e["count"]) for e in a["CSQ"]] for alts in got for a in alts] == [[("x1", 1.5, 2)], [("x2", None, 7)], [("3", 2.0, None)]]
