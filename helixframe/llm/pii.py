"""Personal data: base patterns, then bootstrapped contextual extraction.

Base spans (email, ip, card, phone; leftmost, not overlapping within a kind) are seed entities. The patterns are the lexical
contexts of a span: the two words before, and the word before with the word after (or the text's end). Candidates come from the
slots that the seeds' patterns open, in a second pass: all that lies between a pattern's two words, of any shape and of several
tokens, and after two words the run of tokens with a digit or an at sign; besides, each other token of LEAST_DIGITS digits or
more, or with an at sign. A pattern opens slots with SUPPORT distinct seeds of one kind, where seeds fill at least one
of OPEN of its places. Spark scores the graph of patterns and instances in ROUNDS rounds: a pattern's score for a kind is the
smoothed share of that kind among its instances, an instance's score 1 - product(1 - score) over its supported patterns. A
candidate is added as a kind where its own pattern is confident and its score high. One without a digit or an at sign counts
against its pattern, lends it nothing, and is added where the pattern on both sides of it is confident all the same. Base
spans always stay; what is added never touches one.

Null texts count as empty. Offsets are code points, the end exclusive. Each pattern reads a text in linear time, so very
long texts and runs are safe. Rows that repeat or lack an id are rows of their own; extra columns play no part.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Workspace, arrow_map, by_place, texts_of

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
LEAST_DIGITS = 6
SUPPORT = 4
CONFIDENT = 0.9
#: A slot's words and characters at most; a pattern with more places for each seed than this opens none.
MOST_WORDS = 12
MOST_CHARS = 256
OPEN = 10
#: Kinds of candidates: shaped like an identifier; only counted against a pattern; of any shape, between a pattern's words.
SHAPED, COUNTED, BETWEEN = -1, -2, -3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
SPACES = re.compile(r"\s")
WORD = re.compile(r"\w+")
SHAPE = re.compile(r"[0-9@]")
BEFORE_TOKEN = re.compile(r"[^\w\n+(\[{@]*")
TOKEN = re.compile(r"\S+[^\S\n]*")
BRACKETS = {"(": ")", "[": "]", "{": "}"}
CLOSING = {b: a for a, b in BRACKETS.items()}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern, but from each at sign outwards: linear, since a local part holds no at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
            out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def identifiers(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Other tokens between white space with LEAST_DIGITS digits, or an at sign inside, that touch no base span."""
    out, done, taken, k = [], 0, sorted((a, b) for a, _, b in spans), 0
    for m in re.finditer(r"[0-9@]+", text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        e = SPACES.search(text, m.end())
        done = e.start() if e else len(text)
        token = text[start:done]
        core = token.strip(".,;:!?()[]{}<>\"'")
        if not core or not (sum(map(len, DIGITS.findall(core))) >= LEAST_DIGITS or "@" in core[1:-1]):
            continue
        start += token.index(core)
        end = start + len(core)
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        out.append((start, end))
    return out


def fold(word: str) -> str:
    return word.lower() if word.isalpha() else DIGITS.sub("0", word.lower())


def contexts(text: str, start: int, end: int) -> list[str]:
    """Contexts of a span: two words before; a word before and one after, or the end. At most 80 characters a side."""
    before = [fold(w) for w in WORD.findall(text[max(0, start - 80) : start])][-2:]
    after = [fold(w) for w in WORD.findall(text[end : end + 80])][:1] or ["$"]
    out = []
    if len(before) == 2:
        out.append(f"L {' '.join(before)}")
    if before:
        out.append(f"B {before[-1]} _ {after[0]}")
    return out


def hashed(patterns: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in patterns]


class Openers:
    """Patterns by their words."""

    def __init__(self, patterns: list[str]):
        self.pairs: set[tuple[str, str]] = set()
        self.sides: dict[str, set[str]] = {}
        for p in patterns:
            kind, *words = p.split(" ")
            if kind == "L":
                self.pairs.add((words[0], words[1]))
            else:
                self.sides.setdefault(words[0], set()).add(words[2])

    def slots(self, words: list[str]) -> Iterator[tuple[str, int, int]]:
        """(pattern, its first word's place, the place of the word after it; -1 where the pattern has none)."""
        n, last, pairs, sides = len(words), "", self.pairs, self.sides
        for j, w in enumerate(words):
            if (last, w) in pairs:
                yield f"L {last} {w}", j + 1, -1
            last = w
            rights = sides.get(w)
            if rights:
                near = words[j + 2 : j + 2 + MOST_WORDS]
                for r in rights.intersection(near):
                    yield f"B {w} _ {r}", j + 1, j + 2 + near.index(r)
                if "$" in rights and 0 < n - j - 1 <= MOST_WORDS:
                    yield f"B {w} _ $", j + 1, n


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without white space and punctuation around it, nor a bracket whose other half is not inside, nor a pair around all."""
    out = lambda c: c.isspace() or c in ".,;:!?<>\"'"
    while start < end:
        inside = text[start:end]
        if out(inside[0]) or (inside[0] in BRACKETS and BRACKETS[inside[0]] not in inside):
            start += 1
        elif out(inside[-1]) or (inside[-1] in CLOSING and CLOSING[inside[-1]] not in inside):
            end -= 1
        elif inside[0] in BRACKETS and inside.index(BRACKETS[inside[0]]) == len(inside) - 1:
            start, end = start + 1, end - 1
        else:
            break
    return start, end


def run_of_tokens(text: str, at: int) -> tuple[int, int]:
    """From the next token: the following ones of the line with a digit or an at sign, up to one that ends a clause; else that token."""
    start = BEFORE_TOKEN.match(text, at).end()
    end = start
    for _ in range(MOST_WORDS):
        m = TOKEN.match(text, end)
        if not m or (end > start and not SHAPE.search(m[0])):
            break
        end = m.end()
        if not SHAPE.search(m[0]) or m[0].rstrip()[-1] in ".,;:!?" or end - start > MOST_CHARS:
            break
    return start, end


def candidates(text: str, openers: Openers) -> list[tuple[int, int, int, list[str]]]:
    """(start, end, kind of candidate, patterns) of the slots in a text, but for those that touch base spans."""
    folded = [fold(w) for w in WORD.findall(text)]
    slots = list(openers.slots(folded))
    if not slots:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    taken, found = sorted((a, b) for a, _, b in base_spans(text)), {}
    reach = list(accumulate((b for _, b in taken), max))
    starts = [a for a, _ in taken]
    for p, first, after in slots:
        at = words[first - 1][1]
        end = min(len(text) if after == len(words) else words[after][0], at + 2 * MOST_CHARS) if after >= 0 else -1
        start, end = trimmed(text, *((at, end) if after >= 0 else run_of_tokens(text, at)))
        k = bisect_left(starts, end) - 1
        if start >= end or end - start > MOST_CHARS or (k >= 0 and reach[k] > start):
            continue
        shaped = SHAPE.search(text, start, end)
        kind, own = (SHAPED, contexts(text, start, end)) if shaped else (BETWEEN if after >= 0 else COUNTED, [p])
        found.setdefault((start, end, kind), set()).update(own)
    return [(a, b, k, sorted(own)) for (a, b, k), own in found.items()]


CANDIDATES = "array<struct<s:long,e:long,k:int,i:long,p:array<long>,w:array<string>>>"


def _cand(text: str, a: int, b: int, k: int, own: list[str]) -> dict:
    return {"s": a, "e": b, "k": k, "i": xxhash.xxh3_64_intdigest(text[a:b].lower()) - (1 << 63), "p": hashed(own), "w": own if k >= 0 else []}


def _cands(rows: list) -> pa.Array:
    return pa.array(rows, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("k", pa.int32()), ("i", pa.int64()), ("p", pa.list_(pa.int64())), ("w", pa.list_(pa.string()))])))


def _find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]))
    for batch in batches:
        spans, cands = [], []
        for text in texts_of(batch):
            found = base_spans(text)
            spans.append([{"s": a, "k": k, "e": b} for a, k, b in found])
            every = [(a, b, k) for a, k, b in found] + [(a, b, SHAPED) for a, b in identifiers(text, found)]
            cands.append([_cand(text, a, b, k, contexts(text, a, b)) for a, b, k in every])
        yield pa.RecordBatch.from_pydict({"rid": batch.column("rid"), "doc_id": batch.column("doc_id"), "base": pa.array(spans, span), "cand": _cands(cands)})


def _count(patterns: list[str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    openers, places = Openers(patterns), Counter()
    for batch in batches:
        for text in texts_of(batch):
            places.update(p for p, _, _ in openers.slots([fold(w) for w in WORD.findall(text)]))
    yield pa.RecordBatch.from_pydict({"p": pa.array(list(places), pa.string()), "places": pa.array(list(places.values()), pa.int64())})


def _slots(patterns: list[str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    openers = Openers(patterns)
    for batch in batches:
        cands = [[_cand(t, *x) for x in candidates(t, openers)] for t in texts_of(batch)]
        out = pa.RecordBatch.from_pydict({"rid": batch.column("rid"), "cand": _cands(cands)})
        yield out.filter(pc.greater(pc.list_value_length(out.column("cand")), 0))


def opened(work: Workspace, docs: DataFrame, seen: DataFrame) -> DataFrame | None:
    """(rid, cand): what the slots of the seeds' patterns hold; seen is of the first pass, docs has rid and text."""
    seeds = seen.where("k >= 0").select("i", "k", F.explode("w").alias("p")).groupBy("p", "k").agg(F.countDistinct("i").alias("d"), F.count("*").alias("n"))
    support = work.write(seeds.groupBy("p").agg(F.max("d").alias("d"), F.sum("n").alias("n")).where(F.col("d") >= SUPPORT), "support")
    patterns = support.select("p").toArrow()["p"].to_pylist()
    if not patterns:
        return None
    places = arrow_map(docs.select("text"), _count, "p string, places long", patterns).groupBy("p").agg(F.sum("places").alias("places"))
    patterns = support.join(places, "p").where(F.col("places") <= OPEN * F.col("n")).select("p").toArrow()["p"].to_pylist()
    if not patterns:
        return None
    return work.write(arrow_map(docs.select("rid", "text"), _slots, f"rid long, cand {CANDIDATES}", patterns), "slots")


def _joined(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def bootstrap(work: Workspace, seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """seen (rid, s, e, k, i, p): what base patterns, slots and token shapes gave; k is below 0 for no kind -> (rid, s, k, e) to add."""
    flat = seen.select("rid", "s", "e", "k", "i", F.explode("p").alias("p"))
    edges = work.write(flat.groupBy("p", "i", "k").agg(F.count("*").alias("n")), "edges")
    strength = edges.where("k >= 0").select("i", "k", F.lit(1.0).alias("v")).distinct()
    total = edges.groupBy("p").agg(F.countDistinct("i").alias("m"))
    for r in range(rounds):
        hits = edges.select("p", "i").distinct().join(strength, "i").groupBy("p", "k").agg(F.sum("v").alias("v"), F.count("*").alias("c"))
        rated = work.write(hits.where(F.col("c") >= SUPPORT).join(total, "p").select("p", "k", (F.col("v") / (F.col("m") + 0.25)).alias("score")), f"rated{r}")
        via = edges.where(F.col("k") == SHAPED).select("p", "i").distinct().join(rated, "p")
        fresh = via.groupBy("i", "k").agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))).alias("v"))
        strength = work.write(edges.where("k >= 0").select("i", "k", F.lit(1.0).alias("v")).union(fresh).groupBy("i", "k").agg(F.max("v").alias("v")), f"strength{r}")
    sure = rated.where(F.col("score") >= CONFIDENT).select("p", F.col("k").alias("kind"))
    strong = strength.where(F.col("v") >= CONFIDENT).select("i", F.col("k").alias("kind"))
    # One kind for each span: the first in the list that is sure.
    new = flat.where(F.col("k") == SHAPED).join(sure, "p").join(strong, ["i", "kind"]).select("rid", "s", "e", "kind")
    new = new.union(flat.where(F.col("k") == BETWEEN).join(sure, "p").select("rid", "s", "e", "kind"))
    return new.groupBy("rid", "s", "e").agg(F.min("kind").alias("k")).select("rid", "s", "k", "e")


def extract(docs: DataFrame, work: Workspace, rounds: int = ROUNDS) -> DataFrame:
    """docs (rid, doc_id, text), read more than once with equal rids -> (rid, doc_id, base, spans): arrays of (s, k, e); spans
    has the base and what the method adds."""
    found = arrow_map(docs.select("rid", F.col("doc_id").cast("long"), "text"), _find, f"rid long, doc_id long, base array<struct<s:long,k:int,e:long>>, cand {CANDIDATES}")
    found = work.write(found, "found")
    seen = found.where("size(cand) > 0").select("rid", F.explode("cand").alias("c")).select("rid", "c.*")
    more = opened(work, docs, seen)
    if more is not None:
        seen = seen.union(more.select("rid", F.explode("cand").alias("c")).select("rid", "c.*"))
    added = work.write(bootstrap(work, seen, rounds), "added").groupBy("rid").agg(F.collect_list(F.struct("s", "k", "e")).alias("more"))  # bounded by the text
    wider = lambda x, y: (y["s"] <= x["s"]) & (y["e"] >= x["e"]) & (y["e"] - y["s"] > x["e"] - x["s"])
    added = added.select("rid", F.filter("more", lambda x: ~F.exists("more", lambda y: wider(x, y))).alias("more"))
    out = found.select("rid", "doc_id", "base").join(added, "rid", "left")
    return out.select("rid", "doc_id", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("spans"))


def report(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    work = Workspace(docs.sparkSession, "pii")
    numbered = work.write(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text"), "docs")
    out = extract(numbered, work, rounds)

    def n(k: int):
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return out.select("doc_id", *[n(k) for k in range(4)], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def mask_text(text: str, spans: list) -> str:
    """Spans replaced by their kind in angle brackets; overlapping ones by that of the first."""
    out, at = [], 0
    for s in spans:
        if s["s"] >= at:
            out += [text[at : s["s"]], f"<{KINDS[s['k']].upper()}>"]
        at = max(at, s["e"])
    return "".join(out) + text[at:]


def _mask(text: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t if t is None or not s else mask_text(t, s) for t, s in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist(), strict=True)]
        k = batch.schema.get_field_index(text)
        batch = batch.set_column(k, pa.field(text, pa.string()), pa.array(texts, pa.string()))
        yield batch.drop_columns(["spans"])


def redact(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """docs with every span masked; n_chars, where there is one, counts the new text.

    Columns go by their places, so that any name may be among them; null texts stay null.
    """
    work = Workspace(docs.sparkSession, "redact")
    names, plain = docs.columns, by_place(docs)
    text = plain.columns[names.index("text")]
    numbered = work.write(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")
    out = extract(numbered.select(F.col("row").alias("rid"), F.col("row").alias("doc_id"), F.col(text).alias("text")), work, rounds)
    spans = work.write(out.where("size(spans) > 0").select(F.col("rid").alias("row"), "spans"), "spans")
    hit = arrow_map(numbered.join(spans, "row").drop("row"), _mask, plain.schema, text)
    if "n_chars" in names:
        n = plain.columns[names.index("n_chars")]
        hit = hit.withColumn(n, F.length(text).cast(plain.schema[n].dataType))
    return numbered.join(spans, "row", "left_anti").select(*plain.columns).union(hit.select(*plain.columns)).toDF(*names)
