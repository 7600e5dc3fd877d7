"""MinHash near-duplicates by a signature-coordinate inverted join.

1. One Arrow pass makes each text's set of word shingles (64-bit hashes of words lower-cased in A-Z, whole text), a
   digest of that set and a MinHash signature of K coordinates.
2. Equal sets are one class; only one representative of each class goes on.
3. Each representative is posted under its (coordinate, value) pairs. Two texts that agree in at least T coordinates
   share one of the first K - T + 1 pairs of any order that all texts use, so only that prefix is posted. The order
   is by how common a pair is, counted in a sketch of fixed size: what many texts share is skipped.
4. Of a short posting list (SHORT at most) all pairs are tried. A longer one is joined by its differences from a hub, one
   member of the list: the hub's own links are exact, and two texts not both linked to it can only be linked if they share
   some of the shingles in which they differ from it. Those are posted, rarest first, as many as the wanted overlap asks
   for, and a pair is made only where the rest can still reach that overlap. Components are joined before that, and once
   more before differences that many texts share; a difference whose texts are all in one component is done, and one that
   more than TOGETHER texts of several components share is a list again, with a hub of its own. So a list of near copies
   is hardly ever expanded into all its pairs, and no link between two components is lost.
5. Collisions are counted on byte-wide signatures (never fewer than the true count); pairs at or above T are
   confirmed on the full shingle sets.

T leaves a chance of about 1e-5 or less to miss a pair of exactly the wanted similarity; see `match_threshold`.

Nulls and empty texts have an empty set, are linked with nothing and stay. A text of fewer words than a shingle is one
shingle. A row whose id is null gets the component's smallest id that isn't null (null if there is none) and is not
marked as kept; rows that repeat an id count as copies. Extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Bits, Workspace, arrow_map, chunks_by_bytes, connected_components, digest_heads, digest_slots, flat
from helixframe.llm.textcore import U, mix, shingle_hashes

COORDINATES = 128
MOST_SLOTS = 1 << 22
BLOCK = 1 << 13
SHORT = 4
#: A key with more texts than this by the sketch is common: its rows are not dealt out by the key alone.
COMMON = 1_000
#: Differences with up to FEW texts are tried first; one with more than TOGETHER becomes a list with a hub of its own, so many
#: levels deep at most.
FEW = 64
TOGETHER = 4_096
DEPTH = 4
CHUNK = 1 << 20
_FACTORS = np.random.default_rng(4).integers(0, 1 << 32, 2048, dtype=np.uint32) | np.uint32(1)
_TAGS = np.random.default_rng(5).integers(0, 1 << 64, 2048, dtype=U)


def match_threshold(similarity: float, coordinates: int = COORDINATES, miss: float = 1e-5) -> int:
    """The largest T with P(fewer than T of the coordinates agree | similarity) <= miss."""
    total, t = 0.0, 0
    for k in range(coordinates + 1):
        total += math.comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k)
        if total > miss:
            break
        t = k + 1
    return max(t, 1)


def signature(x: np.ndarray, coordinates: int) -> np.ndarray:
    """Minima of the set's hashes, 32 bits of each, under one odd factor a coordinate."""
    x, a, out = (x >> U(32)).astype(np.uint32), _FACTORS[:coordinates], np.full(coordinates, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, np.multiply.outer(a, x[i : i + 1024]).min(axis=1), out=out)
    return out


def pair_keys(sig: np.ndarray) -> np.ndarray:
    """A key for each (coordinate, value) of the rows of sig."""
    return mix(sig.astype(U) ^ _TAGS[: sig.shape[-1]])


def slots_for(rows: int) -> int:
    """Counters of a sketch: some for each row, so that small inputs have small sketches; bounded for large ones."""
    return 1 << min(MOST_SLOTS.bit_length() - 1, max(BLOCK.bit_length() - 1, (16 * max(rows, 1)).bit_length()))


def level(counts: np.ndarray) -> np.ndarray:
    """Counts in a byte each, eight steps for each doubling: the order of unlike counts stays."""
    return np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)


def rarity(sketch: bytes, keys: np.ndarray) -> np.ndarray:
    """Keys in the order of their counts, then of their hashes."""
    counts = np.frombuffer(sketch, np.uint8)
    return (counts[sketch_slot(keys, len(counts))].astype(U) << U(56)) | (keys >> U(8))


def sketch_slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return (keys >> U(40)).astype(np.int64) & (slots - 1)


def _profiles(width: int, coordinates: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = flat(batch)
        ids = batch.column("doc_id").to_pylist()
        for lo, hi in chunks_by_bytes(offsets, CHUNK):
            part = raw[offsets[lo] : offsets[hi]]
            sets = shingle_hashes(part, offsets[lo : hi + 1] - offsets[lo], width)
            sigs = [signature(x, coordinates) for x in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids[lo:hi], pa.int64()),
                    "n": pa.array([len(x) for x in sets], pa.int64()),
                    "digest": pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                    "sig": pa.array([s.tobytes() if len(x) else b"" for s, x in zip(sigs, sets, strict=True)], pa.binary()),
                    "short": pa.array([mix(s.astype(U)).astype(np.uint8).tobytes() for s in sigs], pa.binary()),
                }
            )


def _coordinate_keys(batch: pa.RecordBatch) -> np.ndarray:
    return pair_keys(np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)).ravel()


def _difference_keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("delta").to_pylist()), U)


def _counted(keys_of, slots: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each slot of the sketch is used in this task, by blocks: the places used (16 bits) and their counts."""
    total, waiting, held = np.zeros(slots, np.uint32), [], 0

    def add() -> None:
        if waiting:
            total[:] += np.bincount(np.concatenate(waiting), minlength=slots).astype(np.uint32)
            waiting.clear()

    for batch in batches:
        waiting.append(sketch_slot(keys_of(batch), slots))
        held += len(waiting[-1])
        if held > MOST_SLOTS // 4:
            add()
            held = 0
    add()
    for k in range(0, slots, 32 * BLOCK):
        out: dict[str, list] = {"block": [], "at": [], "counts": []}
        for i in range(k // BLOCK, min(k + 32 * BLOCK, slots) // BLOCK):
            part = total[i * BLOCK : (i + 1) * BLOCK]
            at = np.flatnonzero(part)
            if len(at):
                out["block"].append(i)
                out["at"].append(at.astype(np.uint16).tobytes())
                out["counts"].append(part[at].tobytes())
        yield pa.RecordBatch.from_pydict({"block": pa.array(out["block"], pa.int64())} | {c: pa.array(out[c], pa.binary()) for c in ("at", "counts")})


def _add_up(part: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, np.uint32)
    for at, x in zip(part["at"], part["counts"], strict=True):
        total[np.frombuffer(at, np.uint16)] += np.frombuffer(x, np.uint32)
    return pd.DataFrame({"block": part["block"].iloc[:1], "counts": [level(total).tobytes()]})


def _sketch(df: DataFrame, keys_of, slots: int) -> bytes:
    counts = arrow_map(df, _counted, "block long, at binary, counts binary", keys_of, slots).groupBy("block").applyInPandas(_add_up, "block long, counts binary")
    sketch = np.zeros((slots // BLOCK, BLOCK), np.uint8)
    found = counts.toArrow()  # one row for each block
    for block, x in zip(found["block"].to_pylist(), found["counts"].to_pylist(), strict=True):
        sketch[block] = np.frombuffer(x, np.uint8)
    return sketch.tobytes()


def _post(sketch, prefix: int, common: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edge = U(int(level(np.array(float(common)))))
    for batch in batches:
        keys = pair_keys(np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES))
        rare = rarity(sketch.value, keys)
        order = np.argpartition(rare, prefix - 1, axis=1)[:, :prefix]
        rid = np.repeat(batch.column("rid").to_numpy(zero_copy_only=False), prefix)
        n = np.repeat(batch.column("n").to_numpy(zero_copy_only=False), prefix)
        keys, often = np.take_along_axis(keys, order, axis=1).ravel(), np.take_along_axis(rare, order, axis=1).ravel() >> U(56) > edge
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "rid": pa.array(rid, pa.int64()), "n": pa.array(n, pa.int64()), "common": pa.array(often)})


def _colliding(least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("sa", "sb"))
        keep = (x == y).sum(axis=1) >= least
        yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(pa.array(keep)) for c in ("a", "b")})


def _confirm(num: int, den: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("ha").to_pylist(), batch.column("hb").to_pylist(), strict=True):
            x, y = np.frombuffer(x, U), np.frombuffer(y, U)
            z = np.concatenate((x, y))
            z.sort(kind="stable")
            both = int((z[1:] == z[:-1]).sum())
            keep.append(den * both >= num * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")})


def _sets(width: int, keep, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full sets of the flagged texts, equal ones once in a task."""
    bits, seen = Bits(np.frombuffer(keep.value, U)), set()
    for batch in batches:
        raw, offsets = flat(batch)
        for lo, hi in chunks_by_bytes(offsets, CHUNK):
            sets = [x.tobytes() for x in shingle_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], width)]
            digests = [xxhash.xxh3_128_digest(x) for x in sets]
            at = [i for i in np.flatnonzero(bits.has(digest_heads(digests))).tolist() if sets[i]]
            at = [i for i in at if digests[i] not in seen and not seen.add(digests[i])]
            if len(seen) > 1_000_000:  # memory stays bounded; more rows, the same result
                seen.clear()
            yield pa.RecordBatch.from_pydict({"digest": pa.array([digests[i] for i in at], pa.binary()), "sh": pa.array([sets[i] for i in at], pa.binary())})


def _differences(num: int, den: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingles that only it or only its hub has, as keys of that hub; `linked`: to the hub itself."""
    for batch in batches:
        delta, linked = [], []
        hubs = mix(batch.column("hub").to_numpy(zero_copy_only=False).astype(U))
        for x, y, h in zip(batch.column("sh").to_pylist(), batch.column("hs").to_pylist(), hubs, strict=True):
            z = np.concatenate((np.frombuffer(x, U), np.frombuffer(y, U)))
            z.sort(kind="stable")
            same = np.zeros(len(z) + 1, bool)
            same[1:-1] = z[1:] == z[:-1]
            only = z[~(same[1:] | same[:-1])]
            linked.append(len(only) * (den + num) <= len(z) * (den - num))
            delta.append(mix(only ^ h).tobytes())
        kept = {c: batch.column(c) for c in ("rid", "hub", "n", "hn")}
        yield pa.RecordBatch.from_pydict(kept | {"linked": pa.array(linked, pa.bool_()), "delta": pa.array(delta, pa.binary())})


def _post_differences(sketch, num: int, den: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rarest differences of a text, as many as a partner must share one of.

    Of a pair, the text with fewer differences (`small`) posts less. d: differences; x: those between both texts, at
    most far = n * (den - num) / num; shared ones are (d + d' - x) / 2, where d' >= d for the small and d' >= d - x
    for the other. A text linked to the hub needs a partner that isn't, so d' > c * (n' + hub's n) for c =
    (den - num) / (den + num). At least one is shared if not both are linked to the hub.
    """
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("rid", "n", "hn", "linked", "delta")]
        out: dict[str, list[np.ndarray]] = {c: [] for c in ("key", "rid", "n", "d", "at", "linked", "small")}
        for rid, n, hn, linked, delta in zip(*columns, strict=True):
            keys = np.frombuffer(delta, U)
            d, far = len(keys), n * (den - num) // num
            least = max(1, (d * (den + num) + (den - num) * (hn - n)) // (2 * (den + num)) + 1) if linked else 1
            small = d - max(least, -(-(2 * d - far) // 2)) + 1
            take = max(small, d - max(least, d - far) + 1, 0)
            keys = keys[np.lexsort((keys, rarity(sketch.value, keys)))[:take]]
            k = len(keys)
            out["key"].append(keys.view(np.int64))
            out["at"].append(np.arange(k))
            out["small"].append(np.arange(k) < small)
            for c, v in (("rid", rid), ("n", n), ("d", d), ("linked", linked)):
                out[c].append(np.full(k, v))
        yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate(v) if v else []).cast(pa.bool_() if c in ("linked", "small") else pa.int64()) for c, v in out.items()})


def _named(labels: DataFrame | None, rows: DataFrame) -> DataFrame:
    """rows with the label of their rid, which is the rid where it has no links yet."""
    if labels is None:
        return rows.withColumn("label", F.col("rid"))
    return rows.drop("label").join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("label", F.coalesce("label", "rid"))


def _joined(work: Workspace, labels: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
    """Labels after more links; what is known already goes in as stars."""
    known = links.select("a", "b")
    if labels is not None:
        known = known.union(labels.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b")))
    return connected_components(work, known, name)


def _deltas(work: Workspace, name: str, part: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Each text of a list beside the list's hub, a member picked by hash: their differences, and whether they are linked."""
    hubs = part.groupBy("key").agg(F.min(F.struct(F.xxhash64("rid").alias("h"), F.col("rid").alias("hub"), F.col("n").alias("hn"))).alias("s")).select("key", "s.hub", "s.hn")
    near = part.join(hubs, "key").where("rid <> hub").select("rid", "hub", "n", "hn").distinct()
    near = near.join(sets, "rid").join(sets.select(F.col("rid").alias("hub"), F.col("sh").alias("hs")), "hub")
    return work.write(arrow_map(near, _differences, "rid long, hub long, n long, hn long, linked boolean, delta binary", num, den), name)


def _shared_differences(work: Workspace, name: str, deltas: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (key, m, label, ...) of the differences that texts of several components share; m texts share this one."""
    slots = slots_for(deltas.count() * 8)
    with work.broadcast(_sketch(deltas.select("delta"), _difference_keys, slots)) as sketch:
        posted = arrow_map(deltas, _post_differences, "key long, rid long, n long, d long, at long, linked boolean, small boolean", sketch, num, den)
        posted = work.write(posted, "differences")
    return work.write(_mixed(posted, labels), name)


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of keys whose texts are not all in one component, with the number of texts."""
    rows = _named(labels, rows.drop("m"))
    keys = rows.groupBy("key").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key", "m")
    return rows.join(keys, "key")


def _pairs_by_differences(shared: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that may be linked besides the hubs' links."""
    x, y = (shared.select("key", *[F.col(c).alias(f"{c}{k}") for c in ("rid", "label", "n", "d", "at", "linked", "small")]) for k in ("a", "b"))
    order = "(da < db OR (da = db AND rida < ridb)) AND labela <> labelb AND NOT (linkeda AND linkedb)"
    alike = f"{den} * least(na, nb) >= {num} * greatest(na, nb) AND (db - da) * {den + num} <= {den - num} * (na + nb)"
    reach = f"2 * least(da - ata, db - atb) * {den + num} >= (da + db) * {den + num} - {den - num} * (na + nb)"
    pairs = x.where("smalla").hint("merge").join(y, "key").where(f"{order} AND {alike} AND {reach}")
    return pairs.select(F.least("rida", "ridb").alias("a"), F.greatest("rida", "ridb").alias("b")).distinct()


def _sets_of(work: Workspace, rids: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(rid, sh): full sets of these representatives, made anew from the texts; only those are shuffled."""
    flagged = work.write(classes.join(rids, "rid", "left_semi").select("digest", "rid"), "flagged")
    with work.broadcast(digest_slots(flagged, "digest").tobytes()) as keep:
        sets = arrow_map(docs, _sets, "digest binary, sh binary", width, keep)
        return work.write(sets.join(flagged, "digest").dropDuplicates(["digest"]).select("rid", "sh"), "sets")


def _beside(pairs: DataFrame, right: DataFrame, column: str, names: tuple[str, str]) -> DataFrame:
    for at, other in zip(("a", "b"), names, strict=True):
        pairs = pairs.join(right.select(F.col("rid").alias(at), F.col(column).alias(other)), at)
    return pairs


def _near(work: Workspace, name: str, pairs: DataFrame, rows: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of representatives that agree in enough coordinates."""
    return work.write(arrow_map(_beside(pairs, rows, "short", ("sa", "sb")), _colliding, "a long, b long", least), name)


def _confirmed(work: Workspace, name: str, near: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    return work.write(arrow_map(_beside(near, sets, "sh", ("ha", "hb")), _confirm, "a long, b long", num, den), name)


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100, width: int = 5, coordinates: int = COORDINATES) -> tuple[DataFrame, Workspace]:
    """Each row's (rid, doc_id, n_shingles, component, component_id): links hold where den * |both| >= num * |either|.

    rid numbers the rows. component is null for rows without a shingle.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near")
    t = match_threshold(num / den, coordinates)
    prefix = coordinates - t + 1
    profiles = arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _profiles, "doc_id long, n long, digest binary, sig binary, short binary", width, coordinates)
    rows = work.write(profiles.withColumn("rid", F.monotonically_increasing_id()), "rows")
    # One row for each distinct set: its smallest row number stands for it.
    classes = work.write(rows.where("n > 0").groupBy("digest").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("least")), "classes")
    total = rows.count()
    slots = slots_for(total)
    with work.broadcast(_sketch(rows.where("n > 0").select("sig"), _coordinate_keys, slots)) as sketch:
        # Slots hold some texts' pairs by chance; what is common stands out from those.
        common = COMMON + 4 * coordinates * total // slots
        posted = arrow_map(rows.select("rid", "n", "sig").join(classes.select("rid"), "rid", "left_semi"), _post, "key long, rid long, n long, common boolean", sketch, prefix, common)
        posted = work.write(posted, "posted")

    def with_size(x: DataFrame) -> DataFrame:
        return x.drop("common").join(x.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "key")

    # Rare keys are dealt out once, for count and join; common ones are counted before the shuffle, and their join can be split.
    rare = posted.where("NOT common").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")
    shared = work.write(with_size(rare).union(with_size(posted.where("common"))), "shared")
    work.drop("posted")
    x, y = (shared.where(F.col("m") <= SHORT).select("key", F.col("rid").alias(k), F.col("n").alias(f"n{k}")) for k in ("a", "b"))
    alike = f"{den} * least(na, nb) >= {num} * greatest(na, nb)"  # sets of other sizes can't be similar enough
    near = _near(work, "near", x.join(y, "key").where(f"a < b AND {alike}").select("a", "b").distinct(), rows, t)
    part, step, labels = shared.where(F.col("m") > SHORT).select("key", "rid", "n"), 0, None
    wanted = part.select("rid").union(near.select("a")).union(near.select("b")).distinct()
    sets = _sets_of(work, wanted, classes, docs.select("text"), width)
    links = _confirmed(work, "links", near, sets, num, den)
    while step <= DEPTH and part.head(1):
        deltas = _deltas(work, f"deltas{step}", part, sets, num, den)
        links = links.union(deltas.where("linked").select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b")))
        labels = _joined(work, labels, links, f"cc{step}_")
        shared = _shared_differences(work, f"common{step}", deltas, labels, num, den)
        last = step == DEPTH
        # Few texts first: what they link is done when many texts are compared.
        pairs = _pairs_by_differences(shared.where(F.col("m") <= FEW), num, den)
        links = _confirmed(work, f"few{step}", _near(work, f"nearfew{step}", pairs, rows, t), sets, num, den)
        many = shared.where(F.col("m") > FEW)
        part = many.where("false" if last else F.col("m") > TOGETHER).select("key", "rid", "n")
        if many.head(1):
            labels = _joined(work, labels, links, f"ccfew{step}_")
            mixed = work.write(_mixed(many.where("true" if last else F.col("m") <= TOGETHER), labels), f"mixed{step}")
            pairs = _pairs_by_differences(mixed, num, den)
            links = _confirmed(work, f"many{step}", _near(work, f"nearmany{step}", pairs, rows, t), sets, num, den)
        work.drop("differences", f"deltas{step}", f"nearfew{step}", f"nearmany{step}")
        step += 1
    if links.head(1):
        labels = _joined(work, labels, links, "cc_")
    if labels is None:
        labels = spark.createDataFrame([], "node long, label long")
    named = classes.join(labels.withColumnRenamed("node", "rid"), "rid", "left").select("digest", "least", F.coalesce("label", "rid").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = work.write(named.join(least, "component").select("digest", "component", "component_id"), "named")
    work.drop("classes", "sets", "near", "shared", "links", *[f"{x}{k}" for k in range(step) for x in ("common", "few", "many", "mixed")])
    out = rows.select("rid", "doc_id", "n", "digest").join(named, "digest", "left")
    return out.select("rid", "doc_id", F.col("n").alias("n_shingles"), "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), work


def components(docs: DataFrame, num: int = 85, den: int = 100, width: int = 5) -> DataFrame:
    out, _ = near_duplicates(docs, num, den, width)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, num: int = 80, den: int = 100, width: int = 5) -> DataFrame:
    """The rows of docs, one of each component: that with the smallest id (ids that are null last).

    Each row is named by a number written with it, so rows that repeat or lack an id are safe.
    """
    work = Workspace(docs.sparkSession, "keep")
    numbered = work.write(docs.withColumn("__row", F.monotonically_increasing_id()), "docs")
    out, found = near_duplicates(numbered.select(F.col("__row").alias("doc_id"), "text"), num, den, width)
    ids = numbered.select("__row", F.col("doc_id").cast("long").alias("id"))
    ranked = out.where("component is not null").join(ids, F.col("doc_id") == F.col("__row")).groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__row")).alias("first"), F.count("*").alias("m"))
    ranked = work.write(ranked.select("component", F.col("first.__row").alias("first"), "m"), "ranked")
    gone = work.write(out.join(ranked.where("m > 1"), "component").where("doc_id <> first").select(F.col("doc_id").alias("__row")), "gone")
    found.drop("")  # all that the search has written
    return numbered.join(gone, "__row", "left_anti").drop("__row")


#: The twin of `components` at 85 of 100. It joins all texts of a shingle: for small tables only.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n, b.n AS m, count(*) AS common FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT x, y FROM p WHERE 100 * common >= 85 * (n + m - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""
