"""Exact dedup by a persistent digest index, bucketed and sorted by hash. DataFrame operations only.

The index is a bucketed, sorted table of (digest, keep_id, least, group_size) at a path, its layout beside the files, so
that a later session opens it by the path alone. New data is reduced to one row for each digest and anti-joined with the
index by sort-merge: the index side is neither shuffled nor dealt anew. What is new is appended; of digests that are held,
a row with the count and the least id of the later copies is appended, so `table` has them all.

Null texts count as empty. Runs of white space (space, tab to carriage return) become one space. Of equal texts, the
row with the smallest doc_id stays; ids that are null come last, and of rows that repeat that id all carry kept = true
in `assign` while `keep_first` retains exactly one row. Extra columns play no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import Workspace, _remove, shared_root

WHITE = "[\\x20\\x09-\\x0D]+"
#: The rows of a table come to the index in so many batches: from the second on, what is held is found by the anti-join.
BATCHES = 2


def text_digest(column: str = "text"):
    return F.sha2(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), WHITE, " "), 256)


class DigestIndex:
    """A persistent index at a path; `add` appends what is new by a sort-merge anti-join on buckets."""

    SCHEMA = "digest STRING, keep_id BIGINT, least STRUCT<none: BOOLEAN, id: BIGINT, row: BIGINT>, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """Opens the index at the path, or makes an empty one there; `buckets` holds for a new one only."""
        self.spark = spark
        self.name = f"digest_index_{uuid.uuid4().hex}"
        self.path = path or f"{shared_root(spark)}/{self.name}"
        layout = f"{self.path}/_layout"
        if self._is_there(layout):
            self.buckets = int(spark.read.text(layout).first().value)
        else:
            self.buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
            spark.range(1).select(F.lit(str(self.buckets)).alias("value")).write.text(layout)
        spark.sql(f"CREATE TABLE {self.name} ({self.SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def _is_there(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def close(self) -> None:
        """Forgets the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def table(self) -> DataFrame:
        """One row for each digest: the id that first came with it, the least of all, and the copies of all batches."""
        return self.rows().groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.min("least").alias("least"), F.sum("group_size").alias("group_size"))

    def groups(self, digests: DataFrame) -> DataFrame:
        """digests (digest, doc_id and, to tell rows of one id apart, row) -> one row for each; counts are combined before the shuffle."""
        row: Column = F.col("row") if "row" in digests.columns else F.lit(0).cast("long")
        least = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), row.alias("row"))
        return digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.min(least).alias("least"), F.count("*").alias("group_size"))

    def unseen(self, digests: DataFrame) -> DataFrame:
        """Rows whose digest the index doesn't hold: the sort-merge anti-join, bucket by bucket."""
        return digests.hint("merge").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, digests: DataFrame) -> None:
        """Appends unseen digests, and for those that are held a row with the copies of this batch and no first id."""
        batch = f"{self.path}/_batch"
        # Written, so that the joins don't move below the aggregation, where they would shuffle every copy.
        self.groups(digests).write.mode("overwrite").parquet(batch)
        new = self.spark.read.schema(self.SCHEMA).parquet(batch)
        again = new.hint("merge").join(self.rows().select("digest").hint("merge"), "digest", "left_semi")
        out = self.unseen(new).union(again.withColumn("keep_id", F.lit(None).cast("long")))
        out = out.select("digest", "keep_id", "least", "group_size").repartition(self.buckets, "digest").sortWithinPartitions("digest")
        out.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        _remove(self.spark, batch)


def _indexed(work: Workspace, digests: DataFrame) -> DataFrame:
    """digests (digest, doc_id, row) through an index, in BATCHES batches -> its rows, one for each digest."""
    index = DigestIndex(work.spark, f"{work.path}/index")
    for k in range(BATCHES):
        index.add(digests.where(F.pmod("row", F.lit(BATCHES)) == k).select("digest", "doc_id", "row"))
    # Written without buckets: in a join both sides are then shuffled, and AQE can split a digest with a third of all rows.
    held = work.write(index.table(), "held")
    index.close()
    work.drop("index")
    return held


def assign(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    work = Workspace(docs.sparkSession, "exact")
    digests = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
    digests = work.write(digests.withColumn("row", F.monotonically_increasing_id()), "digests")
    held = _indexed(work, digests).select("digest", F.col("least.id").alias("keep_id"), "group_size")
    out = digests.join(held.hint("merge"), "digest")
    return out.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), F.col("digest").alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs, one of each normalised text: that with the smallest id (null ids last), exactly one row."""
    work = Workspace(docs.sparkSession, "first")
    numbered = work.write(docs.withColumn("__row", F.monotonically_increasing_id()).withColumn("__digest", text_digest()), "docs")
    held = _indexed(work, numbered.select(F.col("__digest").alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), F.col("__row").alias("row")))
    return numbered.join(held.select(F.col("least.row").alias("__row")), "__row", "left_semi").drop("__row", "__digest")


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS h FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256 FROM d JOIN g USING (h)
"""
