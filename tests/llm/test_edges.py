"""Empty tables, extra columns with names that operators use inside, repeated rows and ids, nulls, very long texts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helixframe.llm import bpe, chat, exact_dedup, near_dedup, nearest, packing, pii, repeats, token_counts, toxicity

SF = "/root/testdata/sf0.001"
BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
#: Names that operators use for columns of their own, and one with a dot.
CLASH = "a b q h v r x id ids row rid key keys node label part own head most spans digest keep_id group_size score rank start end length bucket offset count n tokens piece text_sha256 component_id kept x.y".split()
ON_TEXTS = {
    "pii": pii.report,
    "exact": exact_dedup.assign,
    "bpe": lambda d: bpe.round_trip(d, BYTES),
    "near": lambda d: near_dedup.components(d, num=85),
    "packing": lambda d: packing.pack(d, BYTES, 1024, with_ids=False).drop("sequence_id"),
    "repeats": lambda d: repeats.remove_repeats(d, 400),
    "counts": lambda d: token_counts.token_counts(d, WORDS, 2048),
}
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    names = sorted(df.columns)
    return Counter(tuple(map(str, r)) for r in df.select(*names).collect())


def crowded(df):
    return df.select("*", *[F.lit(f"<{c}>").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def docs(spark):
    mail = "write to bob@example.com or +1 202 555 0123 please " * 12
    odd = [(1, mail), (1, mail), (1, "another text of the same id"), (None, None), (None, mail), (2, ""), (3, " \t "), (4, "tie tie tie tie tie tie")]
    return spark.createDataFrame(odd, "doc_id long, text string").cache()


@pytest.mark.parametrize("name", ON_TEXTS)
def test_empty_and_crowded_tables(spark, docs, name):
    op = ON_TEXTS[name]
    plain = op(docs)
    assert rows(op(crowded(docs))) == rows(plain)
    none = op(docs.limit(0))
    assert none.columns == plain.columns and none.count() == 0


@pytest.mark.parametrize("name", ["pii", "exact", "bpe", "near", "repeats", "counts"])
def test_each_row_has_its_result(docs, name):
    got = ON_TEXTS[name](docs)
    assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r.doc_id for r in docs.collect())


def test_chat_edges(spark):
    turns = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (None, 0, "assistant", "y"), (2, 0, "assistant", ""), (3, 0, "assistant", "<|z" * 400_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    run = lambda d: chat.read_back(chat.format_conversations(d))
    got = {r.conv_id: r for r in run(df).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 3, None: 1, 2: 1, 3: 1}
    assert got[3].loss_sha256 == hashlib.sha256(("<|z" * 400_000).encode()).hexdigest()
    assert rows(run(crowded(df))) == rows(run(df))
    assert run(df.limit(0)).count() == 0


def test_nearest_edges(spark):
    vectors = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (3, [0.5, 0.5]), (None, [1.0, 1.0]), (5, None), (7, [1.0, None]), (9, [float("inf"), 0.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = nearest.search(df)
    assert rows(nearest.search(crowded(df))) == rows(got)
    # Both rows of id 0 ask; each finds the other one, then ids 1 and 3.
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == sorted([(0, 1, 0, 1.0), (0, 2, 1, 1.0), (0, 3, 3, 0.5)] * 2)


def test_toxicity_edges(spark, docs):
    big, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(big, labels)
    twice = toxicity.train(crowded(big.select("doc_id", "text")), labels.union(labels.limit(0)))
    odd = docs.union(spark.createDataFrame([(9, "word " * 600_000)], "doc_id long, text string"))
    got = toxicity.score(odd, model)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in odd.collect())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.collect())
    assert rows(toxicity.score(crowded(odd), twice)) == rows(got)
    assert toxicity.score(odd.limit(0), model).count() == 0
    # An id with both labels and rows of labels without an id or a label neither stop nor decide it.
    bad = labels.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1)], labels.select("doc_id", "toxic").schema))
    assert toxicity.score(odd, toxicity.train(big, bad)).count() == odd.count()


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_empty_and_crowded_tables(spark, docs, name):
    stage = STAGES[name]
    none = stage(spark, docs.limit(0), SF)
    assert none.count() == 0
    wide = crowded(docs)
    got = stage(spark, wide, SF)
    if name != "packing":
        assert got.columns == wide.columns
        assert rows(got.select("doc_id", "text")) == rows(stage(spark, docs, SF))


def test_very_long_texts_whole(spark):
    r = random.Random(5)
    words = [f"w{r.randrange(5000)}" for _ in range(300_000)]
    long = " ".join(words) + " end bob@example.com"
    run = "x" * 700_000
    df = spark.createDataFrame([(1, long), (2, run), (3, long)], "doc_id long, text string")
    want = {1: long, 2: run, 3: long}
    byte, word = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    ids = {i: byte.encode(t, add_special_tokens=False).ids for i, t in want.items()}
    for x in bpe.round_trip(df, BYTES).collect():
        assert x.ids_sha256 == hashlib.sha256(np.array(ids[x.doc_id], "<u4").tobytes()).hexdigest()
    assert {i: n for i, n in packing.pack(df, BYTES, 1024, with_ids=False).groupBy("doc_id").agg(F.sum("length")).collect()} == {i: len(x) + 1 for i, x in ids.items()}
    assert {x.doc_id: x.n_tokens for x in token_counts.token_counts(df, WORDS, 2048).collect()} == {i: len(word.encode(t, add_special_tokens=False).ids) for i, t in want.items()}
    assert {x.doc_id: (x.keep_id, x.group_size) for x in exact_dedup.assign(df).collect()} == {1: (1, 2), 2: (2, 1), 3: (1, 2)}
    every = re.findall(r"[^\x20\x09-\x0D]+", long)
    n = len({tuple(every[k : k + 5]) for k in range(len(every) - 4)})
    assert {x.doc_id: (x.component_id, x.n_shingles) for x in near_dedup.components(df, num=85).collect()} == {1: (1, n), 2: (2, 1), 3: (1, n)}
    assert {x.doc_id: x.n_email for x in pii.report(df).collect()} == {1: 1, 2: 0, 3: 1}
