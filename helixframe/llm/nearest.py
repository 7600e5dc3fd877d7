"""Approximate nearest neighbours by learned partitions.

1. Equal vectors are one class: a class keeps its smallest ids, one more than the neighbours asked for, which is all
   that any answer can show; a class as common as a third of the rows is one row from then on.
2. On a bounded sample of classes (`sample` of Cut, those with the smallest hash) the exact neighbour graph is cut into balanced
   parts: balanced seeds, then moves of vertices to the part of most neighbours, as far as room allows.
3. A small softmax network learns the part of a vector. It puts every class into its most probable part, and routes a
   query to its most probable parts. How many is measured on sample queries against brute force: the fewest whose
   recall reaches TARGET.
4. Where the sample can't tell as many parts apart as the rows ask for (above about a million classes), each part is cut
   again in the same way, on a sample of its own that one task fits; its probes are measured with sample queries that
   come to that part. So parts grow with the rows to `most` x `most_inner` of Cut.
5. A part is searched in blocks of rows against blocks of the queries routed to it, exactly and in double precision;
   the best of all blocks are merged for each query.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part, nor do
rows without an id. Rows that repeat an id are candidates of their own. Ties go to the smaller id. Extra columns play
no part.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import Workspace, arrow_map

LEARN = 16
TARGET = 0.97
HIDDEN = 96
EPOCHS = 30
VECTORS_A_BLOCK = 16_384
QUERIES_A_BLOCK = 4_096


@dataclass(frozen=True)
class Cut:
    """How classes are cut into parts: rows a part, sampled rows a part, most parts and sampled rows of both levels."""

    rows: int = 4096
    sampled: int = 64
    most: int = 128
    sample: int = 8192
    most_inner: int = 64
    sample_inner: int = 4096


def graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows by inner product, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 512):
        s = x[i : i + 512] @ x.T
        s[np.arange(len(s)), i + np.arange(len(s))] = -np.inf
        out[i : i + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A part for each vertex: seeds by capacity-limited assignment, then moves that cut fewer edges."""
    n = len(x)
    room = -(-n // parts)
    centre = x[rng.choice(n, parts, replace=False)]
    for _ in range(6):
        s = x @ centre.T
        part, used = np.full(n, -1), np.zeros(parts, np.int64)
        for i in np.argsort(-s.max(axis=1), kind="stable"):
            for p in np.argsort(-s[i], kind="stable"):
                if used[p] < room:
                    part[i], used[p] = p, used[p] + 1
                    break
        centre = np.stack([x[part == p].mean(axis=0) if used[p] else centre[p] for p in range(parts)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    most = int(room * 1.1) + 1
    for _ in range(5):
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), part[near.ravel()]), 1)
        want = votes.argmax(axis=1)
        gain = votes[np.arange(n), want] - votes[np.arange(n), part]
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if used[want[i]] < most:
                used[part[i]] -= 1
                used[want[i]] += 1
                part[i] = want[i]
    return part


@dataclass
class Router:
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    d: np.ndarray
    parts: int
    probes: int = 1

    def order(self, x: np.ndarray) -> np.ndarray:
        """The parts of each row, most probable first."""
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        z = np.maximum(x @ self.a + self.b, 0) @ self.c + self.d
        return np.argsort(-z, axis=1, kind="stable")


def fit(x: np.ndarray, neighbours: int, rows: int, most: int, cut: Cut, asked: np.ndarray | None = None, seed: int = 0) -> Router:
    """x: sampled vectors; rows: how many there are in all; asked: sample queries (None: some of x, then not learnt from)."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1] if len(x) else 1
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    parts = int(min(most, max(1, rows // cut.rows), max(1, len(x) // cut.sampled)))
    if parts == 1:
        return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1, 1)
    test = rng.permutation(len(x))[: max(50, len(x) // 32)] if asked is None else np.zeros(0, np.int64)
    asked = x[test] if asked is None else asked
    part = balanced_parts(unit, graph(unit, LEARN), parts, rng)
    a, c = rng.normal(0, (2 / dim) ** 0.5, (dim, HIDDEN)), rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts))
    r = Router(a, np.zeros(HIDDEN), c, np.zeros(parts), parts)
    learn = np.setdiff1d(np.arange(len(x)), test)
    moments = {k: (np.zeros_like(getattr(r, k)), np.zeros_like(getattr(r, k))) for k in "abcd"}
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for i in range(0, len(learn), 256):
            at = learn[i : i + 256]
            h = np.maximum(unit[at] @ r.a + r.b, 0)
            z = h @ r.c + r.d
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), part[at]] -= 1
            p /= len(at)
            back = (p @ r.c.T) * (h > 0)
            step += 1
            for k, g in (("a", unit[at].T @ back), ("b", back.sum(axis=0)), ("c", h.T @ p), ("d", p.sum(axis=0))):
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                getattr(r, k)[...] -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    # Probes: the part that each sampled vector lies in, and where in a query's order the parts of its true neighbours are.
    home = r.order(x)[:, 0]
    rank = np.empty((len(asked), parts), np.int64)
    np.put_along_axis(rank, r.order(asked), np.arange(parts)[None, :], axis=1)
    at = {v.tobytes(): i for i, v in enumerate(x)}
    s = asked @ x.T
    for i, v in enumerate(asked):
        if (own := at.get(v.tobytes())) is not None:
            s[i, own] = -np.inf
    k = min(neighbours, len(x) - 1)
    need = np.take_along_axis(rank, home[np.argpartition(-s, k - 1, axis=1)[:, :k]], axis=1)
    for probes in range(1, parts + 1):
        if (need < probes).mean() >= TARGET:
            break
    r.probes = probes
    return r


def _route(shared, probes: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their parts, one row each; probes 0: as many as the router was fitted for."""
    r: Router = pickle.loads(shared.value)
    n = probes or r.probes
    for batch in batches:
        x = np.array(batch.column("v").to_pylist(), float)
        order = r.order(x)[:, :n] if len(x) else np.zeros((0, n), np.int64)
        at = pa.array(np.repeat(np.arange(len(x)), order.shape[1]))
        yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(order.ravel(), pa.int64())], [*batch.schema.names, "part"])


def _fit_inner(shared, sizes: dict[int, int], k: int, cut: Cut, key, rows: pd.DataFrame) -> pd.DataFrame:
    """The router within one part."""
    rows = rows.sort_values(["h", "least"], kind="stable")
    outer, picked = pickle.loads(shared.value)
    come = picked[(outer.order(picked)[:, : outer.probes] == key[0]).any(axis=1)]
    x = np.array(rows["v"].tolist(), float)
    r = fit(x, k, sizes[key[0]], cut.most_inner, cut, come if len(come) >= 50 else None)
    return pd.DataFrame({"part": [key[0]], "router": [pickle.dumps(r)]})


def _route_inner(shared, probes: int, most: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a part each, to rows with a part of that part each; those of part p are numbered from p * most."""
    routers: dict[int, bytes] = pickle.loads(shared.value)
    ready: dict[int, Router] = {}
    for batch in batches:
        x, part = np.array(batch.column("v").to_pylist(), float), batch.column("part").to_numpy()
        rows, to = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p in np.unique(part).tolist():
            if p not in ready:
                ready[p] = pickle.loads(routers[p])
            own = np.flatnonzero(part == p)
            order = ready[p].order(x[own])[:, : probes or ready[p].probes]
            rows.append(np.repeat(own, order.shape[1]))
            to.append(order.ravel() + p * most)
        at = pa.array(np.concatenate(rows))
        keep = [i for i, c in enumerate(batch.schema.names) if c != "part"]
        yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in keep], pa.array(np.concatenate(to), pa.int64())], [*[batch.schema.names[i] for i in keep], "part"])


def _cut_again(work: Workspace, placed: DataFrame, asked: DataFrame, router: Router, picked: np.ndarray, k: int, cut: Cut) -> tuple[DataFrame, DataFrame]:
    """Classes and queries by parts of parts. The driver holds a router for each of at most cut.most parts:
    about (dimensions + cut.most_inner) x HIDDEN numbers."""
    sizes = {r.part: r["count"] for r in placed.groupBy("part").count().collect()}  # at most cut.most rows
    first = Window.partitionBy("part").orderBy("h", "least")
    sampled = placed.select("least", "v", "part", F.xxhash64("v").alias("h")).withColumn("r", F.row_number().over(first)).where(F.col("r") <= cut.sample_inner)
    with work.broadcast(pickle.dumps((router, picked))) as shared:
        inner = work.write(sampled.groupBy("part").applyInPandas(partial(_fit_inner, shared, sizes, k, cut), "part long, router binary"), "inner")
    # A part that no class is in holds no neighbours.
    asked = asked.where(F.col("part").isin(list(sizes)))
    with work.broadcast(pickle.dumps({r.part: bytes(r.router) for r in inner.collect()})) as shared:
        placed = work.write(arrow_map(placed, _route_inner, "least long, ids array<long>, v array<double>, part long", shared, 1, cut.most_inner), "placed_inner")
        asked = work.write(arrow_map(asked, _route_inner, "q long, v array<double>, part long", shared, 0, cut.most_inner), "asked_inner")
    work.drop("placed", "asked", "inner")
    return placed, asked


def _search(k: int, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The best k + 1 classes of one block for each query."""
    if not len(queries) or not len(rows):
        return pd.DataFrame({"q": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"), "ids": pd.Series(dtype="object")})
    rows = rows.sort_values("least", kind="stable")
    x = np.array(rows["v"].tolist(), np.float64)
    ids, out = rows["ids"].to_numpy(), []
    slack = 4 * x.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(x, axis=1).max()
    for i in range(0, len(queries), 256):
        part = queries.iloc[i : i + 256]
        y = np.array(part["v"].tolist(), np.float64)
        s = y @ x.T
        n = min(k + 1, s.shape[1])
        # Everything that may be at or above the n-th score, so that ties are cut by id. A matrix product adds in an order of
        # its own, which differs by block, so what is kept is scored once more from left to right.
        edge = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n] - slack * np.linalg.norm(y, axis=1)
        for q, own, row, e in zip(part["q"], y, s, edge, strict=True):
            at = np.flatnonzero(~(row < e))
            score = np.cumsum(x[at] * own, axis=1)[:, -1]
            best = np.argsort(-score, kind="stable")[:n]
            out.append(pd.DataFrame({"q": q, "score": score[best], "ids": ids[at[best]]}))
    return pd.concat(out, ignore_index=True)


def search(vectors: DataFrame, every: int = 20, k: int = 20, cut: Cut = Cut()) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows found for each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    work = Workspace(spark, "nearest")
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(good, F.lit(False)))
    rows = work.write(rows.withColumn("q", F.monotonically_increasing_id()).withColumn("h", F.sha2(F.to_json("v"), 256)), "rows")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == size.n)
    # Only the first ids of each class pass the shuffle: the rank limit is applied before it.
    first = Window.partitionBy("h").orderBy("id", "q")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    classes = few.groupBy("h").agg(F.min("id").alias("least"), F.array_sort(F.collect_list("id")).alias("ids"), F.min_by("v", "r").alias("v"))
    classes = work.write(classes, "classes")
    n = classes.count()
    picked = np.array([r.v for r in classes.select("v", "h").orderBy("h").limit(cut.sample).collect()], float).reshape(-1, size.n)
    router = fit(picked, k, n, cut.most, cut)
    with work.broadcast(pickle.dumps(router)) as shared:
        placed = work.write(arrow_map(classes.select("least", "ids", "v"), _route, "least long, ids array<long>, v array<double>, part long", shared, 1), "placed")
        asked = arrow_map(rows.where(F.col("id") % every == 0).select("q", "v"), _route, "q long, v array<double>, part long", shared, 0)
        asked = work.write(asked, "asked")
    if n > 2 * cut.rows * router.parts and router.parts > 1:
        placed, asked = _cut_again(work, placed, asked, router, picked, k, cut)
    # A row for each part, so at most cut.most x cut.most_inner: small enough to broadcast.
    blocks = work.write(placed.groupBy("part").agg(F.ceil(F.count("*") / VECTORS_A_BLOCK).cast("int").alias("vbs")), "blocks")
    loads = work.write(asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES_A_BLOCK).cast("int").alias("qbs")), "loads")
    counts = F.broadcast(blocks.join(loads, "part"))

    def deal(df: DataFrame, own: str, other: str, key: str) -> DataFrame:
        """A row goes to one block of its side, and beside every block of the other side; parts that lack a side go."""
        df = df.join(counts, "part").withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("qbs", "vbs")

    left = deal(asked, "qb", "vb", "q").groupBy("part", "qb", "vb")
    right = deal(placed, "vb", "qb", "least").groupBy("part", "qb", "vb")
    found = left.cogroup(right).applyInPandas(partial(_pairs, k), "q long, score double, ids array<long>")
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    # The query's own row: one occurrence of its id, in its own class, which holds the same vector.
    own = rows.select("q", F.col("id").alias("query_id"), "h").where(F.col("query_id") % every == 0).join(classes.select("h", "ids"), "h").select("q", (F.array_position("ids", F.col("query_id")) - 1).alias("own"), F.col("ids")[0].alias("head"))
    flat = found.select("q", "score", F.col("ids")[0].alias("head"), F.posexplode("ids").alias("at", "vec_id")).join(own, ["q", "head"], "left").where("own IS NULL OR own <> at")
    last = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = flat.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.join(rows.select("q", F.col("id").alias("query_id")), "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _pairs(k: int, key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    return _search(k, queries, rows)


#: The twin of `search` where there is one part, so that all true neighbours are found.
SQL = r"""
WITH d AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT * FROM d WHERE vec_id IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM g q JOIN g c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM p QUALIFY rank <= 20
"""
