import collections
import hashlib
import random
import time

import numpy as np

from helixframe.llm import repeats


def brute(texts, length=400):
    raw = {i: t.encode() for i, t in texts}
    seen = collections.Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        runs = repeats.covered([(k, k + length) for k in range(len(b) - length + 1) if seen[b[k : k + length]] > 1])
        kept, at = b"", 0
        for s, e in runs:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out[i] = (len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
    return out


def test_pieces_of_long_texts_and_periods_equal_brute_force(spark, monkeypatch):
    """Texts of many chunks, runs of one character and of short periods, and planted passages of over 50 words."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(90) for _ in range(4)]
    texts = [(i, " ".join((prose(60), passages[i % 4], prose(40)))) for i in range(12)]
    texts += [(20, "a" * 3000), (21, "b" * 401), (22, "ab" * 900 + prose(50)), (23, "abc" * 300), (24, "abc" * 140), (25, prose(1200)), (26, "")]
    assert all(len(p.encode()) >= 400 for p in passages)
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.remove_repeats(docs).collect()}
    assert got == brute(texts)
    raw = np.frombuffer(("abc" * 1500).encode(), np.uint8)
    parts = list(repeats.segments(raw, np.array([0, len(raw)]), 400))
    assert len(parts) > 2 and sum(len(p) - 399 for p, _, _ in parts) == 4500 - 399


def test_ten_megabytes_of_one_character(spark):
    began = time.time()
    (row,) = repeats.remove_repeats(spark.createDataFrame([(1, "a" * 10_000_000)], "doc_id long, text string")).collect()
    assert (row.n_bytes, row.n_removed, row.n_spans) == (10_000_000, 10_000_000, 1)
    assert time.time() - began < 90


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
