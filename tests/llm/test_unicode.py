"""Random Unicode against the tokenizers library itself."""

import random

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from helixframe.llm import bpe, packing, token_counts

RANGES = [(0x20, 0x7F), (0x80, 0x2FF), (0x300, 0x36F), (0x370, 0x5FF), (0x600, 0x17FF), (0x1E00, 0x2FFF), (0x3000, 0x4DBF), (0x4E00, 0xD7FF), (0xF900, 0xFFFD), (0x10000, 0x1FAFF), (0x20000, 0x323AF)]


def strings(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        some = r.sample(RANGES, r.randint(1, 3))
        out.append("".join(chr(r.randint(*r.choice(some))) if r.random() < 0.85 else r.choice(" 'Aa\n") for _ in range(r.randint(1, 12))))
    return out


def content(name: str) -> str:
    with open(P.path(name), encoding="utf-8") as f:
        return f.read()


def test_counts_of_random_unicode_equal_the_library():
    texts = strings(100_000, 1)
    own = token_counts.counter(content("word_bpe_49k.json"))
    want = Tokenizer.from_file(P.path("word_bpe_49k.json")).encode_batch(texts, add_special_tokens=False)
    got = [n for k in range(0, len(texts), 1000) for n in own.counts(texts[k : k + 1000])]
    assert [(t, g, len(w.ids)) for t, g, w in zip(texts, got, want, strict=True) if g != len(w.ids)] == []


def test_ids_of_random_unicode_equal_the_library():
    texts = strings(100_000, 2)
    text = content("byte_bpe_50k.json")
    enc, (fast, ids_of, special) = bpe.encoder(text), packing.encoding(text)
    want = [x.ids for x in Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode_batch(texts, add_special_tokens=False)]
    got = [x for k in range(0, len(texts), 1000) for x in enc.encode_batch(texts[k : k + 1000])]
    assert [t for t, g, w in zip(texts, got, want, strict=True) if np.frombuffer(g, "<u4").tolist() != w] == []
    assert [t for t, w in zip(texts, want, strict=True) if ids_of[fast.encode_to_numpy(t, allowed_special=special, disallowed_special=())].tolist() != w] == []
