"""Command line: import VCF files to a sharded table, export a table to VCF, report on files before an import.

python -m helixframe.cli import --input_pattern 'in/*.vcf' --output_table out --sharding_config shards.yaml
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import annotate, bind, export, flatten, header, merge, report, samples, shard, table
from helixframe.sources import files, vcf


def flag(parser: argparse.ArgumentParser, name: str, **more) -> None:
    parser.add_argument(f"--{name}", type=lambda x: x.lower() in ("true", "1", "yes"), nargs="?", const=True, default=False, **more)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="helixframe")
    every = out.add_subparsers(dest="command", required=True)
    imp, exp, pre = (every.add_parser(x) for x in ("import", "export", "preprocess"))
    for p in (imp, pre):
        source = p.add_mutually_exclusive_group(required=True)
        source.add_argument("--input_pattern")
        source.add_argument("--input_file", help="a file of patterns, one a line")
        p.add_argument("--representative_header_file")
        for name in ("allow_incompatible_records", "infer_headers"):
            flag(p, name)
    for name in ("allow_malformed_records", "use_1_based_coordinate", "omit_empty_sample_calls", "include_call_name", "move_hom_ref_calls", "append", "update_schema_on_append", "copy_quality_to_calls", "copy_filter_to_calls", "use_allele_num", "minimal_vep_alt_matching", "infer_annotation_types"):
        flag(imp, name)
    imp.add_argument("--output_table", required=True)
    imp.add_argument("--sample_lookup_optimized_output_table")
    imp.add_argument("--sharding_config_path", help="YAML; the default has the human chromosomes")
    imp.add_argument("--sample_name_encoding", choices=("WITHOUT_FILE_PATH", "WITH_FILE_PATH"), default="WITHOUT_FILE_PATH")
    imp.add_argument("--no_split_alternate_allele_info_fields", dest="split", action="store_false")
    imp.add_argument("--null_numeric_value_replacement", type=float)
    imp.add_argument("--annotation_fields", nargs="*", default=[])
    imp.add_argument("--reference_names", nargs="*")
    imp.add_argument("--variant_merge_strategy", choices=("NONE", "MOVE_TO_CALLS"), default="NONE")
    imp.add_argument("--info_keys_to_move_to_calls_regex")
    pre.add_argument("--report_path", required=True)
    pre.add_argument("--resolved_headers_path")
    flag(pre, "report_all_conflicts")
    exp.add_argument("--input_table", required=True)
    exp.add_argument("--output_file", required=True)
    exp.add_argument("--representative_header_file")
    exp.add_argument("--genomic_regions", nargs="*", default=[])
    exp.add_argument("--sample_names", nargs="*", default=[])
    exp.add_argument("--sharding_config_path")
    exp.add_argument("--custom_sample_info_table")
    exp.add_argument("--bq_uses_1_based_coordinate", type=lambda x: x.lower() in ("true", "1", "yes"), default=True)
    for name in ("allow_incompatible_schema", "preserve_sample_order"):
        flag(exp, name)
    return out


def validate(a: argparse.Namespace) -> None:
    if a.command in ("import", "preprocess") and a.infer_headers and a.representative_header_file:
        raise ValueError("infer headers, or give a representative header; not both")
    if a.command == "import":
        if a.variant_merge_strategy == "NONE" and (a.info_keys_to_move_to_calls_regex or a.copy_quality_to_calls or a.copy_filter_to_calls):
            raise ValueError("what moves to calls needs a merge strategy")
        if a.update_schema_on_append and not a.append:
            raise ValueError("a schema is updated on append only")
        if a.include_call_name and a.sample_name_encoding == "WITH_FILE_PATH":
            raise ValueError("call names are not unique with file paths; the sample table has both")
        if a.use_allele_num and a.minimal_vep_alt_matching:
            raise ValueError("one way to match annotations, not both")


def _merged(spark: SparkSession, lines: DataFrame, a: argparse.Namespace) -> tuple[header.Header, dict[str, list[str]]]:
    by = files.headers(lines)
    names = {p: h.samples for p, h in by.items()}
    if a.representative_header_file:
        return header.parse([r.value for r in vcf.header_lines(vcf.read_lines(spark, a.representative_header_file)).collect()]), names
    return header.merge(list(by.values()), a.allow_incompatible_records), names


def run_import(spark: SparkSession, a: argparse.Namespace, strategy: merge.MergeStrategy | None = None) -> None:
    """strategy: a merge strategy of one's own, in place of the named one."""
    if strategy is None and a.variant_merge_strategy == "MOVE_TO_CALLS":
        strategy = merge.MoveToCalls(a.info_keys_to_move_to_calls_regex, a.copy_quality_to_calls, a.copy_filter_to_calls)
    shards = shard.load_shards(spark, a.sharding_config_path) if a.sharding_config_path else shard.human_shards()
    if table.exists(spark, a.output_table) != a.append:
        raise ValueError("the table must be there to append, and must not be there else")
    lines = files.read_lines(spark, files.expand(spark, a.input_pattern, a.input_file))
    head, names = _merged(spark, lines, a)
    with_path = a.sample_name_encoding == "WITH_FILE_PATH"
    if with_path:  # equal names of two files are two samples
        names = {p: [samples.encoded(n, p) for n in ns] for p, ns in names.items()}
    rows = vcf.parse(lines, names, a.use_1_based_coordinate)
    if not a.allow_malformed_records and (bad := vcf.malformed(rows).first()):
        raise ValueError(f"malformed record in {bad.file}: {bad.reason}: {bad.line}")
    rows = vcf.well_formed(rows, a.reference_names)
    if a.infer_headers:
        head = header.completed(rows, head)
    people = samples.sample_table(lines, with_path)
    known = samples.known_ids([n for ns in names.values() for n in ns])
    annotations = {k: annotate.field_names(head.sections["INFO"][k]["Description"]) for k in a.annotation_fields}
    kept = header.Header({s: {k: v for k, v in x.items() if s != "INFO" or k not in annotations} for s, x in head.sections.items()}, head.samples)
    raw = rows.select("*", *[F.col("info")[k].alias(f"_{k}") for k in annotations]).withColumn("info", F.map_filter("info", lambda k, v: ~k.isin(list(annotations)))) if annotations else rows
    out = bind.bind(raw, kept, a.allow_incompatible_records, a.split, a.null_numeric_value_replacement, samples.id_of(known), a.include_call_name, extra=[f"_{k}" for k in annotations])
    mode = "allele_num" if a.use_allele_num else "minimal" if a.minimal_vep_alt_matching else "default"
    for k, fields in annotations.items():
        types = header.annotation_columns(rows, k, fields) if a.infer_annotation_types else None
        out = annotate.attach(out.withColumnRenamed(f"_{k}", k), k, fields, mode, types)
    if a.move_hom_ref_calls:
        out = bind.hom_ref_calls(out)
    if a.omit_empty_sample_calls:
        out = bind.without_empty_calls(out)
    if strategy:
        out = strategy.merge(out)
    out = shard.route(bind.split_wide_rows(out), shards)
    if a.append:
        table.append(out, a.output_table, a.update_schema_on_append)
    else:
        table.create(out, a.output_table)
    people.write.mode("append").parquet(f"{a.output_table}__sample_info")
    if a.sample_lookup_optimized_output_table:
        flatten.by_sample(out).repartitionByRange("sample_id").sortWithinPartitions("sample_id", "reference_name", "start_position").write.mode("append").parquet(a.sample_lookup_optimized_output_table)


def run_export(spark: SparkSession, a: argparse.Namespace) -> None:
    shards = shard.load_shards(spark, a.sharding_config_path) if a.sharding_config_path else shard.human_shards()
    regions = [shard.parse_region(r) for r in a.genomic_regions]
    rows = table.read_regions(spark, a.input_table, regions, shards)
    rows = export.supported(rows.drop("shard", "bucket"))
    people = spark.read.parquet(a.custom_sample_info_table or f"{a.input_table}__sample_info").select("sample_id", "sample_name").distinct()
    if a.sample_names:
        asked = spark.createDataFrame([(k, n) for k, n in enumerate(a.sample_names)], "k int, sample_name string")
        ids = [r.sample_id for r in samples.to_ids(asked, people).orderBy("k").collect()]
    else:
        ids = samples.combined_ids(rows, a.preserve_sample_order)
    wanted = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], "k int, sample_id long")
    names = [r.sample_name for r in samples.to_names(wanted, people).orderBy("k").collect()]
    if a.representative_header_file:
        head = [r.value for r in vcf.header_lines(vcf.read_lines(spark, a.representative_header_file)).where("NOT startswith(value, '#CHROM')").collect()]
    else:
        head = header.write(header.from_schema(rows.schema, a.allow_incompatible_schema))
    parts = f"{a.output_file}.parts"
    try:
        export.write_vcf(export.densify(rows, ids), parts, head, names, a.bq_uses_1_based_coordinate)
        export.compose(spark, parts, a.output_file)
    finally:
        table.remove(spark, parts)


def run_preprocess(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = files.read_lines(spark, files.expand(spark, a.input_pattern, a.input_file))
    head, names = _merged(spark, lines, argparse.Namespace(**vars(a) | {"allow_incompatible_records": True}))
    rows = vcf.parse(lines, names)
    good, inferred = vcf.well_formed(rows), None
    if a.infer_headers:
        done = header.completed(good, head)
        new = [(k, s, x["Number"], x["Type"]) for s in ("INFO", "FORMAT") for k, x in done.sections[s].items() if head.sections[s].get(k) != x]
        inferred, head = spark.createDataFrame(new, "id string, category string, number string, type string"), done
    bad = vcf.malformed(rows) if a.report_all_conflicts else None
    text = report.lines(header.definitions(lines), head, inferred, bad)
    out = spark.createDataFrame([(x,) for x in text], "value string").coalesce(1)
    out.write.text(f"{a.report_path}/report")
    if bad is not None:
        report.malformed_lines(bad).write.text(f"{a.report_path}/malformed")
    if a.resolved_headers_path:
        spark.createDataFrame([(x,) for x in [*header.write(head), export.column_line(head.samples)]], "value string").coalesce(1).write.text(a.resolved_headers_path)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    validate(a)
    spark = spark or SparkSession.builder.appName(f"helixframe {a.command}").getOrCreate()
    {"import": run_import, "export": run_export, "preprocess": run_preprocess}[a.command](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
