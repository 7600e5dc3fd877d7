"""Text operators against brute force, round trips and held-out accuracy, with nulls, empty and repeated rows."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from helixframe.llm import bpe, chat, exact_dedup, near_dedup, nearest, packing, pii, repeats, token_counts, toxicity

SF = "/root/testdata/sf0.001"
EDGE = [None, "", " ", "a", "a b c d e", "A  B\tC d e", "x" * 5000, "Σ É <|endoftext|> ok", "a b c d e"]


@pytest.fixture(scope="module")
def docs(spark):
    """Real rows, edge cases, a null id and an extra column whose name an operator uses inside."""
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    edge = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(EDGE)] + [(None, "no id at all")], "doc_id long, text string")
    return base.union(edge).selectExpr("doc_id", "text", "1 AS rid", "'x' AS digest")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_pii(spark, docs):
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    for i, t in texts(docs):
        assert hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(t)).encode()).hexdigest() == got[i].base_sha256
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert pii.report(empty(spark)).count() == 0


def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_pii_bootstrap_finds_unseen(spark):
    rows = [(i, f"Please call me at desk +1 202 555 01{i:02d} today") for i in range(30)] + [(100, "Please call me at desk 4155550199 today")]
    r = {x.doc_id: x.spans for x in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert r[100] == "phone:23:33"


def test_exact(spark, docs):
    got = exact_dedup.assign(docs).toPandas()
    duck = duckdb.connect()
    pdf = docs.select("doc_id", "text").toPandas()
    duck.sql("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM pdf")
    want = duck.sql(exact_dedup.SQL).df()
    key = lambda d: sorted(map(str, d[["doc_id", "group_size", "text_sha256"]].fillna(-1).astype({"doc_id": int}).values.tolist()))
    assert len(pdf) == len(got) and key(got) == key(want)
    assert exact_dedup.keep_first(docs).count() == got.text_sha256.nunique()
    assert exact_dedup.assign(empty(spark)).count() == 0


def test_exact_index_appends(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, path=f"file://{tmp_path}/index")
    a = spark.createDataFrame([("x", 1), ("y", 2)], "digest string, doc_id long")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "digest string, doc_id long")
    index.add(a)
    assert [r.digest for r in index.unseen(b).collect()] == ["z"]
    index.add(b)
    assert sorted((r.digest, r.keep_id) for r in index.table().collect()) == [("x", 1), ("y", 2), ("z", 4)]
    index.close()


def test_bpe_and_packing(spark, docs):
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in bpe.round_trip(docs, path).collect()}
    pieces = collections.defaultdict(list)
    for r in packing.pack(docs, path).collect():
        pieces[r.doc_id].append(r)
    for i, t in texts(docs):
        ids = tok.encode(t, add_special_tokens=False).ids
        assert hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() == got[i].ids_sha256
        assert hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest() == got[i].decoded_sha256
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == [*ids, 0]
        assert all(r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0 for r in own)
    every = [r.sequence_id for p in pieces.values() for r in p]
    assert len(set(every)) == len(every)
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert back == dict(texts(docs))


def test_token_counts(docs):
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in token_counts.token_counts(docs, path).collect()}
    assert all(got[i].n_tokens == len(tok.encode(t, add_special_tokens=False).ids) and got[i].n_bytes == len(t.encode()) for i, t in texts(docs))


def test_near(spark, docs):
    got = {r.doc_id: r for r in near_dedup.components(docs).collect()}
    sets = {}
    for i, t in texts(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    order = sorted((i for i in sets if i is not None))
    for i in order:
        for j in order:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    assert all(got[i].component_id == top(i) and got[i].n_shingles == len(sets[i]) and got[i].kept == (top(i) == i) for i in order)
    assert near_dedup.components(empty(spark)).count() == 0


@pytest.mark.parametrize("most", [repeats.MOST, 2])
def test_repeats(spark, docs, most):
    extra = spark.createDataFrame([(20_001, "a" * 1000), (20_002, "x" * 399), (20_003, "x" * 399), (20_004, "b" * 450 + "a" * 420 + "c" * 300)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    got = {r.doc_id: r for r in repeats.remove_repeats(both, 400, most).collect()}
    raw = {i: t.encode() for i, t in texts(both)}
    seen = collections.Counter(hash(b[k : k + 400]) for b in raw.values() for k in range(len(b) - 399))
    for i, b in raw.items():
        runs = repeats.covered([(k, k + 400) for k in range(len(b) - 399) if seen[hash(b[k : k + 400])] > 1])
        kept, at = b"", 0
        for s, e in runs:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())


def test_chat(spark):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (-8, 0, "us\ner%<", "<|im_end|>\n<|sep|>\\<\\|x"), (-8, 1, "us\ner%<", "<\\\\|b<<|"), (-8, 2, None, None), (-8, 3, "assistant", "é😀<|sep|>"), (-8, 4, "assistant", "b[\\INST]\\"), (None, None, "assistant", "<")]
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in (-7, -8, None):
        mine = [r for r in rows if r[0] == c]
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in mine)
        loss = "".join(t or "" for _, _, r, t in mine if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(mine), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got.predicted == 1) & (got.toxic == 0)).sum() <= 0.02 * (got.toxic == 0).sum()
    assert ((got.predicted == 1) & (got.toxic == 1)).sum() >= 0.7 * (got.toxic == 1).sum()
    none = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs.limit(3), none).collect()} == {0.0}


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:150] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [None] * 8), (None, [1.0] * 8)]
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas().sort_values(["query_id", "rank"])
    assert set(got.query_id) == set(range(0, 300, 20))
    for q, part in got.groupby("query_id"):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        want = np.lexsort((np.arange(300), -np.round(s, 10)))[:20]
        assert part.vec_id.tolist() == want.tolist() and part["rank"].tolist() == list(range(1, 21))
    assert nearest.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize(("num", "seed", "together"), [(85, 1, 4096), (80, 2, 4096), (85, 3, 2)])
def test_large_group_around_the_threshold_equals_brute_force(spark, monkeypatch, num, seed, together):
    """All lists go to the hub step, and with few texts together to hubs of their differences."""
    monkeypatch.setattr(near_dedup, "SHORT", 1)
    monkeypatch.setattr(near_dedup, "TOGETHER", together)
    monkeypatch.setattr(near_dedup, "FEW", min(together, 8))
    r = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(160):
        words = list(base if r.random() < 0.7 or not texts else texts[r.randrange(len(texts))].split())
        for _ in range(r.choice((0, 1, 1, 2, 3, 4))):
            at = r.randrange(len(words))
            words[at : at + r.choice((0, 1, 1))] = [f"w{r.randrange(400)}"]
        texts.append(" ".join(words[r.choice((0, 0, 3)) :]))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    got = near_dedup.components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), num=num).collect()
    assert {x.doc_id: x.component_id for x in got} == {i: root(i) for i in range(len(texts))}
    assert len({root(i) for i in range(len(texts))}) > 5
