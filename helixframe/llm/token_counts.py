"""Token counts of whole texts by a whole-token shortcut.

Offline, every vocabulary string that can end a word is encoded alone; those that give exactly their own id are proven
whole tokens. A pre-token among them counts as one without any merging; only the others are merged (by the segment tree
of bpe.py), and their counts are cached for the life of the Python worker.

Normalisation and the classes of letters and numbers follow the Unicode version that a library was built with. Texts of
characters whose properties are the same in all of them (STABLE) are normalised and cut here; a text with any other
goes through the tokenizer file's own normalizer and pre-tokenizer, whose words are then counted in the same way.

Null texts count as empty. Special strings inside texts count as one token each, the library's default. Extra columns
play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.bpe import LONGEST_CACHED, SPACE, WORD_CACHE, Bpe, _shared, byte_characters, engine
from helixframe.llm.common import arrow_map, texts_of

WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"

#: Latin letters without combining marks, general punctuation, Cyrillic, kana, unified ideographs, Hangul syllables: composed
#: already, and of settled case and class.
STABLE = "\\x00-\u02ff\u0400-\u045f\u2010-\u2027\u2030-\u205e\u20ac\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"


def whole_tokens(bpe: Bpe) -> dict[str, int]:
    """Pre-tokens that are proven to encode alone as one token, with their count of 1."""
    strings = {}
    for i, b in enumerate(bpe.token):
        try:
            if b and i not in bpe.special.values():
                strings.setdefault(b.decode(), b)
        except UnicodeDecodeError:
            continue
    ids = bpe.encode_words(list(strings.values()))
    return {s: 1 for s, x in zip(strings, ids, strict=True) if len(x) == 1}


def lowered(text: str) -> str:
    """Lower case character by character: unlike str.lower, a final sigma is no special case."""
    return text.replace("Σ", "σ").lower()


class Counter:
    def __init__(self, bpe: Bpe, content: str):
        from tokenizers import Tokenizer

        self.bpe, self.find = bpe, regex.compile(WORDS).findall
        self.unstable, self.library = re.compile(f"[^{STABLE}]").search, Tokenizer.from_str(content)
        self.byte = str.maketrans({c: chr(b) for b, c in enumerate(byte_characters())})
        self.whole = whole_tokens(bpe)
        self.rest: dict[str, int] = dict(self.whole)
        self.cut = re.compile("|".join(map(re.escape, sorted(bpe.special, key=len, reverse=True))))

    def words(self, text: str) -> list[str]:
        if text.isascii() or not self.unstable(text):
            return self.find(lowered(text))
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [w.translate(self.byte).encode("latin-1").decode() for w, _ in cut]

    def counts(self, texts: list[str]) -> list[int]:
        split, extra = [], []
        for x in texts:
            parts = [x]
            if any(s in x for s in self.bpe.special):
                parts = self.cut.split(x)
            extra.append(len(parts) - 1)
            words: list[str] = []
            for p in parts:
                words += self.words(p)
            split.append(words)
        known = self.rest
        words = set().union(*split) if split else set()
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > WORD_CACHE:
            known.clear()
            known.update(self.whole)
            missing = [w for w in words if w not in known]
        known.update(zip(missing, map(len, self.bpe.encode_words([w.encode() for w in missing])), strict=True))
        out = [n + sum(map(known.__getitem__, x)) for n, x in zip(extra, split, strict=True)]
        for w in missing:
            if len(w) > LONGEST_CACHED:
                del known[w]
        return out


_counters: dict[str, Counter] = {}


def counter(content: str) -> Counter:
    key = hashlib.md5(content.encode()).hexdigest()
    if key not in _counters:
        _counters[key] = Counter(engine(content), content)
    return _counters[key]


def _count(content, limit: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = counter(content.value)
    for batch in batches:
        texts = texts_of(batch)
        n = c.counts(texts)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(x) if x.isascii() else len(x.encode()) for x in texts], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array([x > limit for x in n], pa.bool_()),
            }
        )


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", _shared(docs, tokenizer), limit)
