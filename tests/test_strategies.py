"""Merge strategies: the schema that they say beforehand, and one of a user's own; regions of a table that grew wider."""

import pytest

from helixframe import cli
from helixframe.operators import intervals, merge, shard, table

CALL = "array<struct<sample_id:bigint,genotype:array<int>>>"
ROWS = "reference_name string, start_position long, end_position long, reference_bases string, alternate_bases array<string>, names array<string>, quality double, filter array<string>, call " + CALL + ", DP long, NS long"


def plain(kind):
    return kind.simpleString()


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("chr1", 5, 6, "A", ["C"], ["x"], q, ["PASS"], [(i, [0, 1])], 10 + i, 7) for i, q in ((1, 3.0), (2, None))] + [("chr1", 0, 100, "A", [], [], 1.0, [], [(3, [0, 0])], 4, None)],
        ROWS,
    )


@pytest.mark.parametrize("strategy", [merge.MoveToCalls(), merge.MoveToCalls("D", True, True), intervals.WithBlocks("D", True, False)])
def test_schema_is_known_before_rows(rows, strategy):
    assert plain(strategy.schema(rows.schema)) == plain(strategy.merge(rows).schema)


def test_columns_that_calls_have(rows):
    twice = rows.withColumnRenamed("DP", "genotype")
    for f in (lambda s: s.schema(twice.schema), lambda s: s.merge(twice)):
        with pytest.raises(ValueError, match="genotype"):
            f(merge.MoveToCalls("geno"))


def test_own_strategy(spark, tmp_path):
    class OneForEachPlace(merge.MergeStrategy):
        def merge(self, variants):
            return variants.dropDuplicates(["reference_name", "start_position"])

        def schema(self, table):
            return table

    lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts"] + [f"chr1\t{p}\t.\t{r}\tC\t.\t.\t.\tGT\t0/1" for p, r in ((1, "A"), (1, "AT"), (9, "G"))]
    (tmp_path / "a.vcf").write_text("\n".join(lines) + "\n")
    a = cli.parser().parse_args(["import", "--input_pattern", f"file://{tmp_path}/a.vcf", "--output_table", f"file://{tmp_path}/t"])
    cli.run_import(spark, a, OneForEachPlace())
    assert sorted(r.start_position for r in table.read(spark, f"file://{tmp_path}/t").collect()) == [0, 8]


def test_regions_of_a_table_that_grew(spark, tmp_path):
    path, shards = f"file://{tmp_path}/t", shard.human_shards()
    base = spark.range(4).selectExpr("'chr1' AS reference_name", "id * 10 AS start_position", "id * 10 + 1 AS end_position")
    table.create(shard.route(base, shards), path)
    table.append(shard.route(base.selectExpr("reference_name", "start_position + 5 AS start_position", "end_position + 5 AS end_position", "'new' AS more"), shards), path, update_schema=True)
    got = table.read_regions(spark, path, [shard.parse_region("chr1:0-20")], shards)
    assert sorted((r.start_position, r.more) for r in got.collect()) == [(0, None), (5, "new"), (10, None), (15, "new")]
