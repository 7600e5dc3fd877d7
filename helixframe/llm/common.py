"""Shared plumbing of the text operators: shared storage, shipping code, Arrow passes."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS_PER_BATCH = 1000
BYTES_PER_BATCH = 8 << 20
#: For writes to a path of file:, where Hadoop's usual file system runs chmod as a process for a task's folder, its file and the
#: file's checksum; this one makes no checksum files, and so runs two. Until it runs chmod, such a process has all pages of its JVM.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def prepare(spark: SparkSession) -> None:
    """Make Arrow batches small in rows and bytes, and ship this package to the executors once.

    The batch sizes are settings of the session and stay set, since plans that read them run after an operator returns.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    sc = spark.sparkContext
    if getattr(sc, "_helixframe_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="helixframe-")) / "helixframe_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(str(target))
    sc._helixframe_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a folder of our own only where that is unset in local mode."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", f"helixframe-{os.getpid()}")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone at exit
        pass


class Workspace:
    """Tables of one run in the shared folder. They cut lineage, survive lost executors, and go when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark, self.path = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, self.path)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.options(**PLAIN_FILES).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _remove(self.spark, f"{self.path}/{name}")

    @contextmanager
    def broadcast(self, value: bytes):
        """A broadcast for the tables written inside; it is gone from the driver and the executors after that."""
        out = self.spark.sparkContext.broadcast(value)
        try:
            yield out
        finally:
            out.destroy()


def arrow_map(df: DataFrame, fn: Callable[..., Iterable[pa.RecordBatch]], schema: str | StructType, *args) -> DataFrame:
    """mapInArrow of a module-level fn(batches, *args); module state then lives as long as the Python worker."""
    return df.mapInArrow(partial(fn, *args), schema)


def by_place(df: DataFrame) -> DataFrame:
    """The columns named by their places: rows whole through Python, whatever names (dots, clashes) they have."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]



def chunks_by_bytes(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes; a longer row comes alone, whole."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def flat(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row offsets into them; null is empty."""
    col = batch.column(column)
    if pa.types.is_large_string(col.type):
        width = np.int64
    else:
        col, width = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    if len(col) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def ids_only(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, so that extra columns with clashing names play no part."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def connected_components(work: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """Components of a graph of long ids by alternating large and small stars; edges (a, b) -> (node, label).

    Each round is written to the shared folder. The label is the smallest id of the component. Nodes without
    edges are not returned. Rounds grow with the logarithm of the longest path, not with the number of nodes.
    """
    cur, k = work.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}0"), 0
    while True:
        # Done when all are stars: a node above has one edge, and none below.
        ends = cur.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("low")).union(cur.select("b", F.lit(0), F.lit(1)))
        if not ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up > 1 OR (up = 1 AND low = 1)").head(1):
            break
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        k += 1
        cur = work.write(small, f"{name}{k}")
        work.drop(f"{name}{k - 1}")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("label")).union(cur.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


class Bits:
    """A set of hashes as bits: members always test true, others rarely. Its size is bounded; it is broadcast."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    @staticmethod
    def slots(df: DataFrame, column: str, n: int) -> np.ndarray:
        """n: bits, a power of two; the driver gets at most n / 64 pairs of numbers, as Arrow columns of one job."""
        rows = df.selectExpr(f"shiftright({column} & {n - 1}L, 6) AS w", f"shiftleft(1L, cast({column} & 63L AS int)) AS b")
        words = np.zeros(n // 64, np.uint64)
        found = rows.groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()
        words[found["w"].to_numpy()] = found["b"].to_numpy().view(np.uint64)
        return words

    def has(self, x: np.ndarray) -> np.ndarray:
        at = x & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == np.uint64(1)


def bits_for(n: int) -> int:
    return 1 << min(28, max(20, (16 * max(n, 1)).bit_length()))


def digest_slots(df: DataFrame, column: str) -> np.ndarray:
    """Bits of the first 8 bytes of binary digests."""
    first = df.select(F.conv(F.substring(F.hex(column), 1, 16), 16, -10).cast("long").alias("h"))
    return Bits.slots(first, "h", bits_for(df.count()))


def digest_heads(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), np.uint64).byteswap()
