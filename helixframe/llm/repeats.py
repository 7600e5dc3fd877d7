"""Removal of repeated passages by a depth-limited most-significant-digit radix sort of suffixes.

Suffixes are ordered only through `length` bytes. Those that fall in one group after the last digit start with the same
`length` bytes, so the groups of two and more are exactly the repeated windows; a suffix alone in its group after any
digit is done and leaves. The digits, from the most significant on:

* The first is the window's anchor: of its grams of GRAM bytes, the one with the smallest hash (the leftmost of equal
  ones), with its place in the window. Equal windows have equal anchors. Neighbouring windows share theirs, so this digit
  needs about one row for each 170 suffixes, and every anchor seen once ends all its windows at once.
* The others are four equal parts of the window, each by a 64-bit rolling hash chained with the group so far.

An anchor's windows go on together, as one context: the bytes that they span. Contexts are compared by anchor; equal
ones are one row already before the shuffle, with their occurrences counted apart. An anchor with more than MOST
distinct contexts isn't sorted in one task: its windows become rows, and counting them by hash (combined before the
shuffle) does the same.

Texts are bytes of UTF-8, null is empty; matches never cross rows. A whole text that occurs twice is repeated as it is,
and one copy stands for all as a witness for other texts. Overlapping occurrences count. Rows that repeat or lack an id
are rows like any other; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Bits, Workspace, arrow_map, bits_for, chunks_by_bytes, digest_heads, digest_slots, flat
from helixframe.llm.textcore import U, mix, prefix_hash, span_hash

GRAM = 64
PARTS = 4
CHUNK = 1 << 19
MOST = 20_000
AT_ONCE = 1_500
WINDOWS_AT_ONCE = 1 << 20
_PLACE = U((1 << 32) - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min of x[i : i + width] for each i, by running minima of blocks from both ends."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, U(2**64 - 1), U)
    full[: len(x)] = x
    block = full.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor hash, anchor's place, first window, last window) as arrays, in the order of raw; windows that cross rows are left out."""
    width = length - GRAM + 1
    if len(raw) < length:
        z = np.zeros(0, np.int64)
        return z, z.astype(U), z, z, z
    p = prefix_hash(raw)
    at = np.arange(len(raw) - GRAM + 1)
    gram = mix(span_hash(p, at, at + GRAM))
    best = sliding_min((gram & ~_PLACE) | at.astype(U), width)
    place = (best & _PLACE).astype(np.int64)
    start = np.arange(len(best))
    end_of_row = np.repeat(offsets[1:], np.diff(offsets))[: len(best)]
    ok = start + length <= end_of_row
    new = ok.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
    last = ok.copy()
    last[:-1] &= (place[1:] != place[:-1]) | ~ok[1:]
    (lo,), (hi,) = np.nonzero(new), np.nonzero(last)
    return np.searchsorted(offsets, lo, side="right") - 1, gram[place[lo]], place[lo], lo, hi


def _digests(raw: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    view = memoryview(np.ascontiguousarray(raw))
    o = offsets.tolist()
    return [hashlib.sha256(view[a:b]).digest() for a, b in zip(o, o[1:], strict=False)]


def segments(part: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, place in the row): a row of more than two chunks comes in pieces that have each window once."""
    if len(off) != 2 or len(part) <= 2 * CHUNK:
        yield part, off, 0
        return
    for k in range(0, len(part) - length + 1, CHUNK):
        piece = part[k : k + CHUNK + length - 1]
        yield piece, np.array([0, len(piece)], np.int64), k


def twice_at_most(row: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) in order, with two of those that a row has more often: that a gram is repeated shows from two."""
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    third = np.zeros(len(row), bool)
    third[2:] = (row[2:] == row[:-2]) & (gram[2:] == gram[:-2])
    return row[~third], gram[~third]


def _profile(length: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = flat(batch)
        for lo, hi in chunks_by_bytes(offsets, CHUNK):
            part, off = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            found = [twice_at_most(*anchors(p, o, length)[:2]) for p, o, _ in segments(part, off, length)]
            row, gram = twice_at_most(np.concatenate([r for r, _ in found]), np.concatenate([g for _, g in found]))
            grams = np.split(gram.view(np.int64), np.searchsorted(row, np.arange(1, hi - lo)))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "digest": pa.array(_digests(part, off), pa.binary()),
                    "n_bytes": pa.array(np.diff(off)),
                    "grams": pa.array(grams, pa.list_(pa.int64())),
                }
            )


def _contexts(length: int, keep, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An occurrence for each anchor in `keep`; the bytes of a context only the first time in a task, each text once.

    Contexts that follow each other and are equal, as in a run of one character, are one row with their number in `times`.
    """
    bits = Bits(np.frombuffer(keep.value, np.uint64))
    docs, seen = set(), set()
    kinds = {"gram": pa.int64(), "cd": pa.binary(), "rel": pa.int64(), "ctx": pa.binary(), "doc": pa.binary(), "start": pa.int64(), "windows": pa.int64(), "times": pa.int64()}

    def of(part: np.ndarray, off: np.ndarray, base: int, digests: list[bytes], fresh: np.ndarray) -> pa.RecordBatch | None:
        row, gram, place, first, last = anchors(part, off, length)
        hit = bits.has(gram) & fresh[row]
        if not hit.any():
            return None
        out: dict[str, list] = {k: [] for k in kinds}
        view, before, end = memoryview(np.ascontiguousarray(part)), b"", -1
        columns = (row[hit].tolist(), gram[hit].view(np.int64).tolist(), place[hit].tolist(), first[hit].tolist(), last[hit].tolist())
        for r, g, a, s, e in zip(*columns, strict=True):
            ctx = view[s : e + length]
            cd = xxhash.xxh3_128_digest(ctx, a - s)
            if cd == before and s == end and g == out["gram"][-1] and digests[r] == out["doc"][-1]:
                out["times"][-1] += 1
            else:
                for k, v in zip(kinds, (g, cd, a - s, None if cd in seen else bytes(ctx), digests[r], s - int(off[r]) + base, e - s + 1, 1), strict=True):
                    out[k].append(v)
                seen.add(cd)
            before, end = cd, e + 1
        return pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in out.items()})

    for batch in batches:
        raw, offsets = flat(batch)
        for lo, hi in chunks_by_bytes(offsets, CHUNK):
            part, off = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            digests = _digests(part, off)
            fresh = []
            for d in digests:
                fresh.append(d not in docs)
                docs.add(d)
            if len(docs) > 1_000_000:  # memory stays bounded; more rows, the same result
                docs.clear()
            if len(seen) > 1_000_000:
                seen.clear()
            for p, o, base in segments(part, off, length):
                out = of(p, o, base, digests, np.array(fresh))
                if out is not None:
                    yield out


def _starts(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and for each window its context, its number there and its place in the bytes."""
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    size = np.array([len(c) for c in contexts])
    n = size - length + 1
    which = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return raw, which, number, (np.cumsum(size) - size)[which] + number


def _runs(which: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows: context, first, last. The input is in order."""
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (number[1:] != number[:-1] + 1)
    (lo,) = np.nonzero(new)
    hi = np.append(lo[1:], len(which)) - 1
    return which[lo], number[lo], number[hi] if len(lo) else number[:0]


def radix_repeats(contexts: list[bytes], rel: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (context, first window, last window) of windows that are in two or more contexts of their group.

    group: a number for each context, that of its anchor; in order. Large groups go by anchor place, a part at a time.
    """
    raw, which, number, at = _starts(contexts, length)
    p = prefix_hash(raw)
    place = rel[which] - number
    digit = length // PARTS
    found = []
    blocks = max(1, len(which) // WINDOWS_AT_ONCE)
    for b in range(blocks):
        sel = np.flatnonzero(place % blocks == b) if blocks > 1 else np.arange(len(which))
        key = mix(group[which[sel]].astype(U) * U(0x9E3779B97F4A7C15) + place[sel].astype(U) + U(1))
        for d in range(PARTS):
            s = at[sel] + d * digit
            key = mix(key + span_hash(p, s, s + (digit if d < PARTS - 1 else length - d * digit)))
            if d < PARTS - 1:
                slots = 1 << max(10, int(len(key)).bit_length() + 2)
                low = (key & U(slots - 1)).astype(np.int64)
                stay = np.bincount(low, minlength=slots)[low] > 1
                sel, key = sel[stay], key[stay]
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = np.zeros(len(k), bool)
        if len(k):
            same[1:] = k[1:] == k[:-1]
            same[:-1] |= k[1:] == k[:-1]
        found.append(sel[order[same]])
    hit = np.sort(np.concatenate(found))
    return _runs(which[hit], number[hit])


def _sort_groups(length: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor and context; whole anchors are taken together, about AT_ONCE contexts at a time."""
    ctx: list[bytes] = []
    cds: list[bytes] = []
    grams: list[int] = []
    rel: list[int] = []

    def done(n: int) -> pa.RecordBatch:
        g = np.array(grams[:n])
        group = np.cumsum(np.append(False, g[1:] != g[:-1]))
        size = np.bincount(group)
        many = np.flatnonzero(size[group] > 1)
        c, lo, hi = radix_repeats([ctx[i] for i in many], np.array(rel)[many], group[many], length) if len(many) else (np.zeros(0, int),) * 3
        at = many[c]
        out = pa.RecordBatch.from_pydict({"gram": pa.array(g[at], pa.int64()), "cd": pa.array([cds[i] for i in at], pa.binary()), "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})
        for x in (ctx, cds, grams, rel):
            del x[:n]
        return out

    for batch in batches:
        for g, d, r, c in zip(*(batch.column(k).to_pylist() for k in ("gram", "cd", "rel", "ctx")), strict=True):
            if grams and g == grams[-1] and d == cds[-1]:
                continue
            if len(grams) >= AT_ONCE and g != grams[-1]:
                yield done(len(grams))
            grams.append(g)
            cds.append(d)
            rel.append(r)
            ctx.append(c)
    if grams:
        yield done(len(grams))


def _window_rows(length: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        contexts = batch.column("ctx").to_pylist()
        for i in range(0, len(contexts), 64):
            part = contexts[i : i + 64]
            raw, which, number, at = _starts(part, length)
            p = prefix_hash(raw)
            place = batch.column("rel").to_numpy(zero_copy_only=False)[i : i + 64][which] - number
            half = length // 2
            h1, h2 = mix(span_hash(p, at, at + half) + place.astype(U)), mix(span_hash(p, at + half, at + length))
            cds = batch.column("cd").slice(i, 64).take(pa.array(which))
            gram = batch.column("gram").slice(i, 64).take(pa.array(which))
            yield pa.RecordBatch.from_pydict({"gram": gram, "cd": cds, "number": pa.array(number), "h1": pa.array(h1.view(np.int64)), "h2": pa.array(h2.view(np.int64))})


def _flagged(keep, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = Bits(np.frombuffer(keep.value, np.uint64))
    for batch in batches:
        raw, offsets = flat(batch)
        digests = _digests(raw, offsets)
        if digests:
            hit = np.flatnonzero(bits.has(digest_heads(digests)))
            yield pa.RecordBatch.from_pydict({"doc": pa.array([digests[i] for i in hit], pa.binary()), "text": batch.column("text").take(pa.array(hit))})


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for d, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "spans")), strict=True):
            raw = text.encode()
            runs = covered([(s["a"], s["b"]) for s in spans])
            at, keep = 0, hashlib.sha256()
            for a, b in runs:
                keep.update(raw[at:a])
                at = b
            keep.update(raw[at:])
            rows.append((d, sum(b - a for a, b in runs), len(runs), keep.hexdigest()))
        d, n, k, h = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_pydict({"digest": pa.array(d, pa.binary()), "removed": pa.array(n, pa.int64()), "spans": pa.array(k, pa.int64()), "kept": pa.array(h, pa.string())})


def repeated_spans(docs: DataFrame, length: int = 400, most: int = MOST) -> tuple[DataFrame, DataFrame, Workspace]:
    """(rows, spans): rows (doc_id, digest, n_bytes, copies); spans (doc, a, b), byte ranges covered in texts without a copy."""
    if length < 2 * GRAM:
        raise ValueError(f"windows must have at least {2 * GRAM} bytes")
    spark = docs.sparkSession
    work = Workspace(spark, "repeats")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = work.write(arrow_map(docs, _profile, "doc_id long, digest binary, n_bytes long, grams array<long>", length), "rows")
    copies = work.write(rows.groupBy("digest").agg(F.count("*").alias("copies")), "copies")
    distinct = rows.select("digest", "grams").where("size(grams) > 0").dropDuplicates(["digest"])
    again = work.write(distinct.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "again")
    with work.broadcast(Bits.slots(again, "gram", bits_for(again.count())).tobytes()) as keep:
        found = work.write(arrow_map(docs.select("text"), _contexts, "gram long, cd binary, rel long, ctx binary, doc binary, start long, windows long, times long", length, keep), "found")
    counted = found.groupBy("gram", "cd").agg(F.sum("times").alias("n"), F.max("windows").alias("windows"))
    often = counted.where("n > 1").select("gram", "cd", F.lit(0).cast("long").alias("lo"), (F.col("windows") - 1).alias("hi"))
    contexts = found.where("ctx is not null").select("gram", "cd", "rel", "ctx")
    large = work.write(found.where("ctx is not null").groupBy("gram").agg(F.count("*").alias("m")).where(F.col("m") > most).select("gram"), "large")
    any_large = bool(large.head(1))
    usual = contexts.join(large, "gram", "left_anti") if any_large else contexts
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = arrow_map(usual.repartition(n, "gram").sortWithinPartitions("gram", "cd"), _sort_groups, "gram long, cd binary, lo long, hi long", length)
    if any_large:
        windows = arrow_map(contexts.join(large, "gram").dropDuplicates(["gram", "cd"]), _window_rows, "gram long, cd binary, number long, h1 long, h2 long", length)
        windows = work.write(windows, "windows")
        twice = windows.groupBy("gram", "h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        runs = runs.union(windows.join(twice, ["gram", "h1", "h2"]).select("gram", "cd", F.col("number").alias("lo"), F.col("number").alias("hi")))
    runs = work.write(runs.union(often), "runs")
    alone = copies.where("copies = 1").select(F.col("digest").alias("doc"))
    at = found.select("gram", "cd", "doc", "start", ((F.col("times") - 1) * F.col("windows")).alias("more")).join(runs, ["gram", "cd"])
    # Equal contexts in a row are repeated as they are, so all that they span is covered.
    spans = at.select("doc", (F.col("start") + F.col("lo")).alias("a"), (F.col("start") + F.col("hi") + F.col("more") + length).alias("b")).join(alone, "doc", "left_semi")
    return rows.select("doc_id", "digest", "n_bytes").join(copies.hint("merge"), "digest"), work.write(spans, "spans"), work


def remove_repeats(docs: DataFrame, length: int = 400, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows, spans, work = repeated_spans(docs, length, most)
    by_doc = work.write(spans.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "by_doc")  # bounded by the text
    with work.broadcast(digest_slots(by_doc, "doc").tobytes()) as keep:
        texts = arrow_map(docs.select("text"), _flagged, "doc binary, text string", keep)
        cut = work.write(arrow_map(texts.join(by_doc.hint("merge"), "doc"), _cut, "digest binary, removed long, spans long, kept string"), "cut").dropDuplicates(["digest"])
    work.drop("again", "found", "large", "windows", "runs", "spans", "by_doc")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    out = rows.join(cut.hint("merge"), "digest", "left")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("spans", F.lit(0))).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )


#: The twin of `remove_repeats` at 400 bytes: every window of every text, by its hash.
SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 800)) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d)),
k AS (SELECT g FROM w GROUP BY g HAVING count(*) > 1),
b AS (SELECT doc_id, i, i - lag(i, 1, -401) OVER (PARTITION BY doc_id ORDER BY i) > 400 AS fresh FROM w SEMI JOIN k USING (g)),
n AS (SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS z FROM n GROUP BY ALL),
t AS (SELECT doc_id, h, a, z, lag(z, 1, 0) OVER o AS before, lead(a) OVER o IS NULL AS final FROM r JOIN d USING (doc_id) WINDOW o AS (PARTITION BY doc_id ORDER BY a)),
c AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || CASE WHEN final THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS kept FROM t GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id)
"""
