"""Byte-pair encoding by a segment tree over adjacent pair ranks, and its inverse.

For one pre-token, leaf i of the tree holds the rank of the pair that starts at symbol i, with i itself as tie-break, so
the root is the leftmost pair of the lowest rank. A merge changes at most three leaves: its own, the neighbour before it,
and the symbol that went; each is updated along one path to the root. Merging ends when the root holds no rank.

Pre-tokens of up to 65 bytes are encoded many at a time: the same tree as a numpy matrix with one row for each
pre-token. Longer ones use the same tree in plain lists, which costs n log n for n bytes.

Null texts count as empty: no ids. Special strings of the tokenizer that occur in a text become their ids, as the
library does by default. Extra columns play no part; rows that repeat an id are encoded each on its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import arrow_map, prepare, texts_of

NONE = np.int32(2**31 - 1)
WIDEST = 65
#: Unicode White_Space as the tokenizer's own regex engine has it, without U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0  -     　"
BYTE_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORD_CACHE = 700_000
LONGEST_CACHED = 128


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next free from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Bpe:
    """Merge rules of a tokenizers file of type BPE over bytes; `suffix` marks the last symbol of a word, if any."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        vocab, chars = model["vocab"], byte_characters()
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.first = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + self.suffix] for c in chars], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = [vocab[a] for a, _ in pairs]
        self.right = [vocab[b] for _, b in pairs]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.rank = {}
        for r, p in enumerate(zip(self.left, self.right, strict=True)):
            self.rank.setdefault(p, r)
        byte = {c: b for b, c in enumerate(chars)}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for t, i in vocab.items():
            end = bool(self.suffix) and t.endswith(self.suffix)
            self.token[i] = bytes(byte[c] for c in (t[: -len(self.suffix)] if end else t) if c in byte)
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self._table()

    def _table(self) -> None:
        self.mask = (1 << 18) - 1
        keys, ranks = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int32)
        k = np.array([(a << 20) | b for a, b in self.rank], np.int64)
        self.probes = 0
        for key, slot, r in zip(k.tolist(), self._slot(k).tolist(), self.rank.values(), strict=True):
            far = 0
            while keys[slot] != -1:
                slot, far = (slot + 1) & self.mask, far + 1
            keys[slot], ranks[slot] = key, r
            self.probes = max(self.probes, far)
        self.keys, self.ranks = keys, ranks

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where there is no rule."""
        k = (a.astype(np.int64) << 20) | b
        slot = self._slot(k)
        found = self.keys[slot]
        out = np.where(found == k, self.ranks[slot], NONE)
        (left,) = np.nonzero((found != k) & (found != -1))
        for _ in range(self.probes):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
            found = self.keys[slot[left]]
            hit = found == k[left]
            out[left[hit]] = self.ranks[slot[left[hit]]]
            left = left[~hit & (found != -1)]
        return out

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each pre-token, which must not be empty."""
        out: list = [None] * len(words)
        size = np.array([len(w) for w in words])
        lo = 0
        for width in (1, 5, 9, 17, 33, WIDEST):
            (at,) = np.nonzero((size > lo) & (size <= width))
            for i in range(0, len(at), 16384):
                part = at[i : i + 16384]
                for j, ids in zip(part.tolist(), self._together([words[j] for j in part], size[part], width), strict=True):
                    out[j] = ids
            lo = width
        for j in np.flatnonzero(size > WIDEST).tolist():
            out[j] = self._alone(words[j])
        return out

    def _together(self, words: list[bytes], size: np.ndarray, width: int) -> list[np.ndarray]:
        n, leaves = len(words), max(width - 1, 1)
        inside = np.arange(width) < size[:, None]
        sym = np.zeros((n, width), np.int32)
        sym[inside] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        rows = np.arange(n)
        sym[rows, size - 1] = self.last[np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)]
        if width > 1:
            tree = np.full((n, 2 * leaves), NONE, np.int32)
            both = inside[:, 1:]
            r = self.ranks_of(sym[:, :-1][both], sym[:, 1:][both])
            place = np.broadcast_to(np.arange(leaves, dtype=np.int32), (n, leaves))[both]
            tree[:, leaves:][both] = np.where(r == NONE, NONE, r * leaves + place)
            k = leaves
            while k > 1:
                tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
                k //= 2
            after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))  # place width stands for the end
            before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
            (live,) = np.nonzero(tree[:, 1] != NONE)
            while len(live):
                root = tree[live, 1]
                rank, i = root // leaves, root % leaves
                j = after[live, i]
                k = after[live, j]
                k = np.where(k >= size[live], width, k)
                new = self.made[rank]
                sym[live, i] = new
                inside[live, j] = False
                after[live, i] = k
                before[live, k] = i
                p = before[live, i]
                ends, starts = k < width, p >= 0
                here = np.full(len(live), NONE, np.int32)
                x = self.ranks_of(new[ends], sym[live[ends], k[ends]])
                here[ends] = np.where(x == NONE, NONE, x * leaves + i[ends])
                tree[live, leaves + i] = here
                gone = j < leaves
                tree[live[gone], leaves + j[gone]] = NONE
                s = live[starts]
                x = self.ranks_of(sym[s, p[starts]], new[starts])
                tree[s, leaves + p[starts]] = np.where(x == NONE, NONE, x * leaves + p[starts])
                for who, leaf in ((live[gone], j[gone]), (s, p[starts]), (live, i)):
                    node = (leaf + leaves) >> 1
                    while len(who) and node[0] >= 1:
                        tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
                        node = node >> 1
                live = live[tree[live, 1] != NONE]
        return np.split(sym[inside], np.cumsum(inside.sum(axis=1))[:-1])

    def _alone(self, word: bytes) -> np.ndarray:
        n = len(word)
        sym = [*self.first[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last[word[-1]])]
        leaves = 1 << (n - 1).bit_length()
        none, rank, made = (1 << 62), self.rank, self.made
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            r = rank.get((sym[i], sym[i + 1]))
            if r is not None:
                tree[leaves + i] = r * leaves + i
        for k in range(leaves - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before, alive = list(range(1, n + 1)), list(range(-1, n)), bytearray(b"\1") * n

        def put(i: int, v: int) -> None:
            k = leaves + i
            tree[k] = v
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                v = a if a < b else b
                if tree[k] == v:
                    break
                tree[k] = v
                k >>= 1

        while tree[1] != none:
            r, i = divmod(tree[1], leaves)
            j = after[i]
            k = after[j]
            sym[i], alive[j], after[i], before[k] = int(made[r]), 0, k, i
            put(j, none)
            r = rank.get((sym[i], sym[k])) if k < n else None
            put(i, none if r is None else r * leaves + i)
            p = before[i]
            if p >= 0:
                r = rank.get((sym[p], sym[i]))
                put(p, none if r is None else r * leaves + p)
        return np.array(sym, np.int32)[np.frombuffer(alive, np.uint8) == 1]


_engines: dict[str, Bpe] = {}


def engine(content: str) -> Bpe:
    """One engine for each tokenizer file and Python worker."""
    key = hashlib.md5(content.encode()).hexdigest()
    if key not in _engines:
        _engines[key] = Bpe(content)
    return _engines[key]


class Encoder:
    """Whole texts to id bytes (little-endian, unsigned, 32 bits), with a bounded cache of pre-tokens."""

    def __init__(self, bpe: Bpe, pattern: str = BYTE_LEVEL):
        self.bpe, self.find = bpe, regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(bpe.special, key=len, reverse=True))) + ")") if bpe.special else None
        self.cache: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[list[str] | bytes]:
        """Lists of pre-tokens, with the id bytes of special strings between them."""
        if self.cut is None or not any(s in text for s in self.bpe.special):
            return [self.find(text)]
        parts = self.cut.split(text)
        return [self.find(x) if not k % 2 else self.bpe.special[x].to_bytes(4, "little") for k, x in enumerate(parts)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        split = [self.pretokens(x) for x in texts]
        words = set()
        for parts in split:
            for x in parts:
                if isinstance(x, list):
                    words.update(x)
        cache = self.cache
        missing = [w for w in words if w not in cache]
        if len(cache) + len(missing) > WORD_CACHE:
            cache.clear()
            missing = list(words)
        ids = self.bpe.encode_words([w.encode() for w in missing])
        known = {w: x.astype("<u4").tobytes() for w, x in zip(missing, ids, strict=True)}
        cache.update(known)
        out = [b"".join([x if isinstance(x, bytes) else b"".join(map(cache.__getitem__, x)) for x in parts]) for parts in split]
        for w in known:
            if len(w) > LONGEST_CACHED:
                del cache[w]
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bpe.token.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(content: str) -> Encoder:
    key = hashlib.md5(content.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(engine(content))
    return _encoders[key]


def _encode(content, digests: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = encoder(content.value)
    for batch in batches:
        ids = enc.encode_batch(texts_of(batch))
        first = {"doc_id": batch.column("doc_id")}
        if digests:
            yield pa.RecordBatch.from_pydict(
                first
                | {
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                }
            )
        else:
            yield pa.RecordBatch.from_pydict(first | {"ids": pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))})


def _decode(content, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = encoder(content.value)
    for batch in batches:
        texts = [enc.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})


_broadcasts: dict[tuple[str, str], object] = {}


def _shared(df: DataFrame, path: str):
    """The tokenizer file as a broadcast: a file of fixed size, so executors need no copy of it on disk. One for each application."""
    prepare(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        content = f.read()
    sc = df.sparkSession.sparkContext
    key = (sc.applicationId, hashlib.md5(content.encode()).hexdigest())
    if key not in _broadcasts:
        _broadcasts[key] = sc.broadcast(content)
    return _broadcasts[key]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _encode, "doc_id long, ids array<int>", _shared(docs, tokenizer), False)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that aren't UTF-8 become U+FFFD, and null ids give an empty text."""
    return arrow_map(encoded.select(F.col("doc_id").cast("long"), "ids"), _decode, "doc_id long, text string", _shared(encoded, tokenizer))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _shared(docs, tokenizer), True)
