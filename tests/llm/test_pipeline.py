"""The stages of the pipeline one by one against brute force, with null and repeated ids."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from helixframe.llm import pii, toxicity

SF = "/root/testdata/sf0.01"


def _shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_stages_equal_brute_force(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(f"word{i}" for i in range(120))
    extra = [(None, "no id"), (None, "no  id"), (7001, long), (7001, long + " end"), (7002, "mail bob@example.com now"), (7002, "call +1 202 555 0123 now"), (7003, None)]
    rows = [r.asDict() | {"doc_id": i, "text": t, "n_chars": len(t or "")} for (i, t), r in zip(extra, base.take(len(extra)), strict=True)]
    docs = base.union(spark.createDataFrame(rows, base.schema)).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = lambda d: Counter(r.text or "" for r in d.collect())

    clean = corpus_pipeline.drop_toxic(spark, docs, SF).cache()  # on all documents: fewer hold too few labels to find any
    every = list(enumerate(r.text for r in docs.collect()))
    model = toxicity.train(docs, labels)
    toxic = {r.doc_id for r in toxicity.score(spark.createDataFrame(every, "doc_id long, text string"), model).where("predicted = 1").collect()}
    assert toxic
    assert texts(clean) == Counter(t or "" for i, t in every if i not in toxic)

    clean = clean.where("doc_id IS NULL OR doc_id < 60 OR doc_id BETWEEN 7001 AND 7003").cache()
    first = corpus_pipeline.drop_exact_copies(spark, clean, SF).cache()
    same = lambda t: re.sub(r"[ \t-\r]+", " ", t)
    assert Counter(same(t) for t in texts(first).elements()) == Counter({same(t): 1 for t in texts(clean)})

    near = corpus_pipeline.drop_near_copies(spark, first, SF).cache()
    every = [_shingles(t) for t in texts(first).elements()]
    up = list(range(len(every)))
    for i, a in enumerate(every):
        for j in range(i):
            if a and every[j] and 100 * len(a & every[j]) >= 80 * len(a | every[j]):
                up = [up[i] if u == up[j] else u for u in up]
    assert near.count() == len(set(up)) and texts(near) <= texts(first)

    masked = corpus_pipeline.mask_personal_data(spark, near, SF).cache()
    want = Counter(pii.mask_text(t, [{"s": a, "k": k, "e": b} for a, k, b in pii.base_spans(t)]) for t in texts(near).elements())
    assert texts(masked) == want and masked.columns == docs.columns

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.pack(spark, masked, SF).collect()
    ids = Counter()
    for t in texts(masked).elements():
        ids.update([*tok.encode(t, add_special_tokens=False).ids, 0])
    assert Counter(x for r in packed for x in r.ids) == ids
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in packed)
