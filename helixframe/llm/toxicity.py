"""A convolutional text classifier in numpy: hashed word embeddings, several filter widths, max pooling.

A word is a run of letters (A-Z lower-cased; every byte from 0x80 on counts as a letter). Its embedding is the sum of
rows of one hashed table: two for the word (so that a collision has to happen twice to matter) and one for each of its
prefixes of 4, 5 and 6 bytes. Rows seen in fewer than LEAST_SEEN training texts stay zero, so rare words can't be
learned by heart. Filters of 1, 2 and 3 words go over the whole text; the maximum of each feeds a logistic output.

Counts, filters and thresholds come from every labelled text that isn't held out, however many there are. These are dealt
by hash into shards of about SHARD_ROWS texts and SHARD_BYTES bytes, each one row of a table. Document frequencies and word
counts of languages are summed over the shards. An epoch starts every shard from the same model; a shard goes through its
texts in small batches, and what it changed is averaged: a row of the table over the shards that touched it, all else over
all shards. Changes are summed as whole numbers of 1 / UNIT, so the model depends on the rows alone and not on their
partitions. The driver holds one model and sums of its size, which the number of texts doesn't change; a task holds a shard.

Thresholds are calibrated for each language on the fifth of each shard that no epoch reads (the document frequencies do), from
counts of their logits in steps of 1 / LEVEL, the language being guessed from the text by the word counts; the score is the probability moved so that
the language's threshold lies at DECIDE. A language with too few positive texts held back takes the threshold of all, and so
do texts where documents have no lang.

Scores cover all rows and whole texts. Null and empty texts have no words and get the score of an empty text. Without labels
of both kinds every score is the share of label 1, or 0. Rows that repeat an id are rows of their own: an id with both labels
is learned with both, and each row of an id with each of its labels. Labels other than 0 and 1 or without an id are left
out. Extra columns play no part.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Bits, Workspace, arrow_map, bits_for, by_place, chunks_by_bytes, flat, prepare
from helixframe.llm.textcore import LOWER, LOWER_VALUE, U, mix, prefix_hash, span_hash

SHARD_ROWS = 2048
SHARD_BYTES = 8 << 20
ROWS = 1 << 18
SIZE = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6)
LEAST_SEEN = 3
EPOCHS = 6
BATCH = 64
DECIDE = 0.7
LEVEL = 256
FARTHEST = 32
UNIT = float(1 << 36)
LANGUAGE_ROWS = 1 << 14
LANGUAGES = 16
CHUNK = 1 << 20
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
WORD_TAGS = (U(0x51ED270B9F3C5A77), U(0xD6E8FEB86659FD93))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word (columns: two of the word, one of each prefix) and the number of words before each text."""
    n = len(raw)
    if not n:
        return np.zeros((0, 2 + len(PREFIXES)), np.int32), np.zeros(len(offsets), np.int64)
    inside = LETTER[raw]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    before[edge] = after[edge - 1] = True
    start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    p = prefix_hash(raw, LOWER_VALUE)
    whole = span_hash(p, start, end)
    cols = [mix(whole ^ t) for t in WORD_TAGS]
    cols += [mix(span_hash(p, start, np.minimum(end, start + k)) + U(k)) for k in PREFIXES]
    return np.stack([(c & U(ROWS - 1)).astype(np.int32) for c in cols], axis=1), np.searchsorted(start, offsets)


@dataclass
class Model:
    table: np.ndarray  # ROWS x SIZE
    filters: list[np.ndarray]  # for each width: width x SIZE x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float | np.ndarray
    language: np.ndarray  # LANGUAGE_ROWS x languages: log probabilities of words
    prior: np.ndarray
    shift: np.ndarray  # for each language, what is added to the logit
    constant: float | None = None

    def pooled(self, feats: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maxima of all filters over each text, and where they are (-1: nowhere above zero)."""
        n, texts = len(feats), len(first) - 1
        x = np.zeros((n + max(WIDTHS), SIZE), np.float32)
        for k in range(feats.shape[1]):
            x[:n] += self.table[feats[:, k]]
        last = np.repeat(first[1:], np.diff(first))
        best = np.zeros((texts, FILTERS * len(WIDTHS)), np.float32)
        where = np.full(best.shape, -1, np.int64)
        full = np.flatnonzero(np.diff(first) > 0)
        for w, width in enumerate(WIDTHS):
            if not len(full):
                break
            y = np.zeros((n, FILTERS), np.float32)
            for k in range(width):
                y += x[k : n + k] @ self.filters[w][k]
            y += self.bias[w * FILTERS : (w + 1) * FILTERS]
            y[np.arange(n) + width > last] = 0
            top = np.maximum.reduceat(y, first[full], axis=0)
            best[full, w * FILTERS : (w + 1) * FILTERS] = np.maximum(top, 0)
            if self.training:
                for i, t in enumerate(full):
                    a = y[first[t] : first[t + 1]].argmax(axis=0) + first[t]
                    where[t, w * FILTERS : (w + 1) * FILTERS] = np.where(top[i] > 0, a, -1)
        return best, where

    training: bool = False

    def logits(self, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
        return (self.pooled(feats, first)[0] @ self.out + self.out_bias).astype(np.float64)

    def languages(self, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
        score = np.concatenate((np.zeros((1, len(self.prior))), np.cumsum(self.language[feats[:, 0] & (LANGUAGE_ROWS - 1)], axis=0, dtype=np.float64)))
        return (score[first[1:]] - score[first[:-1]] + self.prior).argmax(axis=1)

    def scores(self, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        z = self.logits(feats, first) + self.shift[self.languages(feats, first)]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def parts(dense: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Views of all parameters outside the table: filters, their bias, output weights, output bias."""
    filters, at = [], 0
    for w in WIDTHS:
        filters.append(dense[at : at + w * SIZE * FILTERS].reshape(w, SIZE, FILTERS))
        at += filters[-1].size
    n = FILTERS * len(WIDTHS)
    return filters, dense[at : at + n], dense[at + n : at + 2 * n], dense[at + 2 * n :]


DENSE = sum(WIDTHS) * SIZE * FILTERS + 2 * FILTERS * len(WIDTHS) + 1


@dataclass
class State:
    """What an epoch starts from: parameters, and the sums of squared gradients that set each one's step."""

    table: np.ndarray
    table_squares: np.ndarray
    known: np.ndarray
    dense: np.ndarray
    dense_squares: np.ndarray
    language: np.ndarray
    prior: np.ndarray
    positive: float

    def model(self) -> Model:
        filters, bias, out, out_bias = parts(self.dense)
        return Model(self.table, filters, bias, out, out_bias, self.language, self.prior, np.zeros(len(self.prior)))


def draw(rng: np.random.Generator) -> tuple[list[np.ndarray], np.ndarray]:
    """Random filters and output weights."""
    return [rng.normal(0, 0.1, (w, SIZE, FILTERS)) for w in WIDTHS], rng.normal(0.3, 0.05, FILTERS * len(WIDTHS))


def constant(share: float) -> Model:
    empty = Model(np.zeros((1, SIZE)), [], np.zeros(1), np.zeros(1), 0, np.zeros((1, 1)), np.zeros(1), np.zeros(1))
    empty.constant = share
    return empty


@dataclass
class Shard:
    number: int
    raw: np.ndarray
    offsets: np.ndarray
    label: np.ndarray
    lang: list[str]
    back: np.ndarray  # rows for the thresholds
    train: np.ndarray  # rows for the epochs
    rng: np.random.Generator

    def features(self, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(lo, hi, features, first) of rows[lo:hi], some bytes at a time so that memory is bounded."""
        o = self.offsets
        size = np.concatenate(([0], np.cumsum(o[rows + 1] - o[rows]))).astype(np.int64)
        for lo, hi in chunks_by_bytes(size, CHUNK // 4):
            raw = np.concatenate([self.raw[o[t] : o[t + 1]] for t in rows[lo:hi]])
            yield lo, hi, *words(raw, size[lo : hi + 1] - size[lo])


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for i in range(len(batch)):
            raw, offsets = flat(pa.RecordBatch.from_arrays([batch.column("texts").slice(i, 1).flatten()], ["text"]))
            number = batch.column("shard")[i].as_py()
            label = np.array(batch.column("y")[i].as_py(), np.int64)
            rng = np.random.default_rng([0, number])
            draw(rng)  # shard 0 goes on where the start's numbers end
            order = rng.permutation(len(label))
            cut = len(label) // 5
            yield Shard(number, raw, offsets, label, batch.column("langs")[i].as_py(), np.sort(order[:cut]), order[cut:], rng)


def _labelled(keep, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts whose id has a label, and a few more, so that the others aren't shuffled."""
    bits = Bits(np.frombuffer(keep.value, np.uint64))
    for batch in batches:
        yield batch.filter(pa.array(bits.has(batch.column("h").to_numpy().view(np.uint64))))


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard and id, an id's labels before its texts; each shard becomes one row, so that a task has it whole."""
    at, of, mine, texts, label, lang = None, None, [], [], [], []

    def packed() -> pa.RecordBatch:
        kinds = {"shard": pa.int64(), "texts": pa.list_(pa.string()), "y": pa.list_(pa.int32()), "langs": pa.list_(pa.string())}
        return pa.RecordBatch.from_pydict({k: pa.array([v], kinds[k]) for k, v in zip(kinds, (at, texts, label, lang), strict=True)})

    for batch in batches:
        for s, i, t, y, k in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "text", "y", "lang")), strict=True):
            if s != at:
                if texts:
                    yield packed()
                at, texts, label, lang = s, [], [], []
            if i != of:
                of, mine = i, []
            if y is not None:
                mine.append(y)
                continue
            texts += [t] * len(mine)
            label += mine
            lang += [k] * len(mine)
    if texts:
        yield packed()


def _counts(names: list[str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each row of the table, by label; after those, words of each language."""
    for shard in _shards(batches):
        seen = np.zeros((2, ROWS), np.int64)
        spoken = np.zeros((len(names), LANGUAGE_ROWS), np.int64)
        code = np.array([names.index(k) if k in names else 0 for k in shard.lang])
        for lo, hi, feats, first in shard.features(np.arange(len(shard.label))):
            for t in range(lo, hi):
                mine = feats[first[t - lo] : first[t - lo + 1]]
                seen[shard.label[t], np.unique(mine)] += 1
                spoken[code[t]] += np.bincount(mine[:, 0] & (LANGUAGE_ROWS - 1), minlength=LANGUAGE_ROWS)
        n = np.concatenate((seen.ravel(), spoken.ravel()))
        (at,) = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(n[at], pa.int64())})


def start(names: list[str], by_name: np.ndarray, by_label: np.ndarray, counts: np.ndarray) -> State:
    seen, m = counts[: 2 * ROWS].reshape(2, ROWS).astype(np.float32), by_label
    # A start for the first coordinate: shrunken log odds of the label where the row is seen.
    odds = np.log((seen[1] + 0.5) / (m[1] + 1)) - np.log((seen[0] + 0.5 * m[0] / m[1]) / (m[0] + m[0] / m[1]))
    weight = seen.sum(axis=0) / (seen.sum(axis=0) + 10)
    known = seen.sum(axis=0) >= LEAST_SEEN
    table = np.zeros((ROWS, SIZE), np.float32)
    table[:, 0] = np.where(known, np.clip(odds * weight, -3, 3), 0)
    dense = np.zeros(DENSE, np.float32)
    filters, bias, out, out_bias = parts(dense)
    drawn, out[:] = draw(np.random.default_rng(0))
    for f, values in zip(filters, drawn, strict=True):
        f[:] = values
        f[:, 0, : FILTERS // 2] += 0.5 / len(f)
    bias[:], out_bias[:] = -0.2, -2.0
    spoken = counts[2 * ROWS :].reshape(len(names), LANGUAGE_ROWS).T + 0.1
    language = np.log(spoken / spoken.sum(axis=0)).astype(np.float32)
    return State(table, np.full(ROWS, 1e-6, np.float32), known, dense, np.full(DENSE, 1e-6), language, np.log(by_name + 1.0), float(m[0] / m[1]))


def _one_batch(shard: Shard, rows: np.ndarray, model: Model, state: State, rate: float) -> np.ndarray:
    """One step on a small batch, in place; the rows of the table it touched."""
    found = [(*model.pooled(feats, first), feats) for _, _, feats, first in shard.features(rows)]
    best, hit = np.concatenate([b for b, _, _ in found]), np.concatenate([w >= 0 for _, w, _ in found])
    p = 1 / (1 + np.exp(-np.clip(best @ model.out + model.out_bias, -30, 30)))
    y = shard.label[rows]
    d = (p - y) * np.where(y == 1, min(state.positive, 10.0), 1.0) / len(rows)
    grad = np.zeros(DENSE)
    g_filters, g_bias, g_out, g_out_bias = parts(grad)
    g_best = d[:, None] * model.out
    g_out[:], g_out_bias[:], g_bias[:] = best.T @ d, d.sum(), np.where(hit, g_best, 0).sum(axis=0)
    touched, change = [np.zeros(0, np.int64)], [np.zeros((0, SIZE))]
    for w, width in enumerate(WIDTHS):
        cols = slice(w * FILTERS, (w + 1) * FILTERS)
        t, f = np.nonzero(hit[:, cols])
        g = g_best[:, cols][t, f]
        for k in range(width):
            feat = np.concatenate([feats[where[:, cols][where[:, cols] >= 0] + k] for _, where, feats in found])
            np.add.at(g_filters[w], (k, slice(None), f), state.table[feat].sum(axis=1) * g[:, None])
            touched.append(feat.ravel())
            change.append(np.repeat(g[:, None] * model.filters[w][k][:, f].T, feat.shape[1], axis=0))
        g_filters[w] += 1e-4 * model.filters[w]
    r, back_to = np.unique(np.concatenate(touched), return_inverse=True)
    g = np.zeros((len(r), SIZE), np.float32)
    np.add.at(g, back_to, np.concatenate(change))
    r, g = r[state.known[r]], g[state.known[r]]
    state.table_squares[r] += (g**2).mean(axis=1)
    state.table[r] -= rate * g / np.sqrt(state.table_squares[r])[:, None] * 0.5
    state.dense_squares += grad**2
    state.dense -= (rate * grad / np.sqrt(state.dense_squares)).astype(np.float32)
    return r


def _epoch(shared, epoch: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a shard changes: (row, values, square) of the table; after its rows, the other parameters, so many to a row."""
    for shard in _shards(batches):
        state, before = pickle.loads(shared.value), pickle.loads(shared.value)
        model = state.model()
        model.training = True
        order = shard.train
        for _ in range(epoch + 1):
            shard.rng.shuffle(order)
        touched = np.zeros(ROWS, bool)
        for b in range(0, len(order), BATCH):
            touched[_one_batch(shard, order[b : b + BATCH], model, state, 0.1 / (1 + epoch))] = True
        (at,) = np.nonzero(touched)
        values = np.column_stack((state.table[at].astype(np.float64) - before.table[at], state.table_squares[at].astype(np.float64) - before.table_squares[at]))
        rest = np.concatenate((state.dense.astype(np.float64) - before.dense, state.dense_squares - before.dense_squares))
        rest = np.append(rest, np.zeros(-len(rest) % (SIZE + 1))).reshape(-1, SIZE + 1)
        at, values = np.concatenate((at, ROWS + np.arange(len(rest)))), np.rint(np.concatenate((values, rest)) * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64())} | {f"v{k}": pa.array(values[:, k]) for k in range(SIZE + 1)})


def average(state: State, at: np.ndarray, n: np.ndarray, sums: np.ndarray) -> None:
    """Moves the state by the mean change of the shards that touched each row."""
    mean = sums / UNIT / n[:, None]
    order = np.argsort(at)
    at, mean = at[order], mean[order]
    rows = at < ROWS
    state.table[at[rows]] += mean[rows, :SIZE].astype(np.float32)
    state.table_squares[at[rows]] += mean[rows, SIZE].astype(np.float32)
    rest = mean[~rows].ravel()
    state.dense += rest[:DENSE].astype(np.float32)
    state.dense_squares += rest[DENSE : 2 * DENSE]


def _held_back(shared, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Guessed language, logit in steps of 1 / LEVEL and label of the rows held back."""
    model = None
    for shard in _shards(batches):
        model = model or pickle.loads(shared.value).model()
        for lo, hi, feats, first in shard.features(shard.back):
            level = np.rint(np.clip(model.logits(feats, first), -FARTHEST, FARTHEST) * LEVEL)
            y = shard.label[shard.back[lo:hi]]
            yield pa.RecordBatch.from_pydict({"guess": pa.array(model.languages(feats, first), pa.int64()), "level": pa.array(level.astype(np.int64)), "y": pa.array(y)})


def _threshold(level: np.ndarray, no: np.ndarray, yes: np.ndarray) -> float:
    """The middle of the gap with the most right answers, positives and negatives weighted as they come."""
    z, at = np.unique(level, return_inverse=True)
    no, yes = np.bincount(at, no), np.bincount(at, yes)
    right = np.concatenate(([0], np.cumsum(no))) + yes.sum() - np.concatenate(([0], np.cumsum(yes)))
    z = z / LEVEL
    cut = np.concatenate(([z[0] - 2], (z[1:] + z[:-1]) / 2, [z[-1] + 2]))
    wide = np.concatenate(([0], z[1:] - z[:-1], [0]))
    best = np.flatnonzero(right == right.max())
    return float(cut[best[wide[best].argmax()]])


def calibrate(model: Model, guess: np.ndarray, level: np.ndarray, no: np.ndarray, yes: np.ndarray) -> None:
    goal = np.log(DECIDE / (1 - DECIDE))
    common = _threshold(level, no, yes) if no.sum() and yes.sum() else 0.0
    for k in range(len(model.shift)):
        mine = guess == k
        enough = yes[mine].sum() >= 10 and no[mine].sum() >= 10
        model.shift[k] = goal - (_threshold(level[mine], no[mine], yes[mine]) if enough else common)


_models: dict[int, Model] = {}


def _score(shared, name: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if name not in _models:
        _models.clear()
        _models[name] = pickle.loads(shared.value)
    model = _models[name]
    for batch in batches:
        raw, offsets = flat(batch)
        out = [np.zeros(0)]
        for lo, hi in chunks_by_bytes(offsets, CHUNK):
            feats, first = words(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            out.append(model.scores(feats, first))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(np.concatenate(out))})


def held_out(column: str = "doc_id"):
    """Rows that no fit may learn labels from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD_BYTES) -> Model:
    """Fit on every labelled row that isn't held out."""
    work = Workspace(docs.sparkSession, "toxicity")
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    lang = F.coalesce("lang", F.lit("")) if "lang" in docs.columns else F.lit("")
    rows = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"))
    sizes = rows.select("doc_id", "lang", F.octet_length("text").cast("long").alias("bytes")).join(known.hint("merge"), "doc_id")
    by_lang = work.write(sizes.groupBy("lang").agg(F.count_if(F.col("y") == 0).alias("no"), F.count_if(F.col("y") == 1).alias("yes"), F.sum("bytes").alias("bytes")), "langs")
    no, yes, size = by_lang.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("no", "yes", "bytes")]).first()
    if not no or not yes:
        work.drop("langs")
        return constant(yes / (no + yes) if yes else 0.0)
    top = by_lang.orderBy((F.col("no") + F.col("yes")).desc(), "lang").limit(LANGUAGES).collect()
    names = [r.lang for r in top]
    by_name = np.array([r.no + r.yes for r in top], np.float64)
    by_name[0] += no + yes - by_name.sum()
    n = int(max(1, -(-(no + yes) // shard_rows), -(-size // shard_bytes)))
    h = F.xxhash64("doc_id").alias("h")
    ids = known.select("doc_id", "y", h)
    with work.broadcast(Bits.slots(ids, "h", bits_for(ids.count())).tobytes()) as keep:
        kind = "doc_id long, text string, lang string, h long"
        both = arrow_map(rows.select("doc_id", "text", "lang", h), _labelled, kind, keep).unionByName(ids, allowMissingColumns=True)
        dealt = both.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(n).cast("long"))).repartition(n, "shard")
        dealt = dealt.sortWithinPartitions("shard", "h", "doc_id", F.col("y").asc_nulls_last(), "text", "lang")
        shards = work.write(arrow_map(dealt.select("shard", "doc_id", "text", "y", "lang"), _pack, "shard long, texts array<string>, y array<int>, langs array<string>"), "shards")

    counts = np.zeros(2 * ROWS + len(names) * LANGUAGE_ROWS)
    found = arrow_map(shards, _counts, "at long, n long", names).groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts[found["at"].to_numpy()] = found["n"].to_numpy()
    state = start(names, by_name, np.array([no, yes]), counts)
    values = [f"v{k}" for k in range(SIZE + 1)]
    for epoch in range(EPOCHS):
        with work.broadcast(pickle.dumps(state)) as shared:
            changes = arrow_map(shards, _epoch, ", ".join(f"{c} long" for c in ("at", *values)), shared, epoch)
            found = changes.groupBy("at").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in values]).toArrow()
        average(state, found["at"].to_numpy(), found["n"].to_numpy(), np.column_stack([found[c].to_numpy() for c in values]))
    with work.broadcast(pickle.dumps(state)) as shared:
        back = arrow_map(shards, _held_back, "guess long, level long, y long", shared)
        found = back.groupBy("guess", "level").agg(F.count_if(F.col("y") == 0).alias("no"), F.count_if(F.col("y") == 1).alias("yes")).toArrow()
    work.drop("langs", "shards")
    model = state.model()
    calibrate(model, *(found[c].to_numpy() for c in ("guess", "level", "no", "yes")))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    prepare(docs.sparkSession)
    packed = pickle.dumps(model)
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    out = arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _score, "doc_id long, score double", shared, hash(packed))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= DECIDE).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier doesn't reject, with their columns; each text is scored in place."""
    model = train(docs, labels)
    packed = pickle.dumps(model)
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    plain = by_place(docs)
    return arrow_map(plain, _clean, plain.schema, shared, hash(packed), docs.columns.index("text")).toDF(*docs.columns)


def _clean(shared, name: int, k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column(k)], ["doc_id", "text"])
        (scored,) = _score(shared, name, [column])
        yield batch.filter(pa.array(scored.column("score").to_numpy() < DECIDE))
