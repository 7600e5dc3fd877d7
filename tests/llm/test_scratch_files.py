"""Tables of a run have no checksum files: each would cost a process that runs chmod."""

from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from helixframe.llm.common import Workspace


def test_tables_have_no_checksum_files(spark):
    work = Workspace(spark, "scratch")
    back = work.write(spark.range(0, 1000, 1, 7).withColumn("x", F.concat(F.lit("t"), "id")), "rows")
    folder = Path(urlparse(work.path).path) / "rows"
    assert len(list(folder.glob("part-*"))) == 7 and (folder / "_SUCCESS").exists()
    assert not list(folder.rglob("*.crc"))
    assert sorted((r.id, r.x) for r in back.collect()) == [(i, f"t{i}") for i in range(1000)]
    work.drop("rows")
    assert not folder.exists()


def test_other_writes_of_the_session_keep_their_checksums(spark, tmp_path):
    Workspace(spark, "scratch").write(spark.range(3), "rows")
    spark.range(10).write.parquet(f"file://{tmp_path}/out")
    assert list((tmp_path / "out").glob(".*.crc"))
