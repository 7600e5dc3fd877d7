"""The classifier learns from all labelled rows: past any fixed number of them, over many shards, whatever their partitions."""

import random

import numpy as np
from pyspark.sql import functions as F

from helixframe.llm import toxicity


def made(spark, n):
    """Texts of random words; one in eight is toxic by a word of its own, another word from the 6,001st labelled row on."""
    ids = spark.range(n).where(~toxicity.held_out("id")).orderBy(F.xxhash64("id")).toPandas()["id"].tolist()
    rng, usual = random.Random(3), [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "lu") for b in ("ra", "ne", "to") for c in ("s", "m", "lin")]
    rows = []
    for k, i in enumerate(ids):
        text, y = rng.choices(usual, k=12), int(rng.random() < 0.125)
        if y:
            text[rng.randrange(12)] = "zorgle" if k >= 6000 else "quabbit"
        rows.append((i, " ".join(text), y))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_labels_past_6000_are_learned(spark):
    docs, labels = made(spark, 10_500)
    assert labels.count() > 6500
    odd = spark.createDataFrame([(1, "baras konem zorgle mitos lunelin"), (2, "baras konem quabbit mitos lunelin"), (3, "baras konem korem mitos lunelin")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in toxicity.score(odd, toxicity.train(docs, labels)).collect()}
    assert got == {1: 1, 2: 1, 3: 0}


def test_many_shards_do_not_depend_on_partitions(spark):
    docs, labels = made(spark, 1500)
    one, other = (toxicity.train(d, l, shard_rows=100) for d, l in ((docs, labels), (docs.repartition(7), labels.repartition(3))))
    assert np.array_equal(one.table, other.table) and np.array_equal(one.shift, other.shift)
    got = toxicity.score(docs, one).join(labels, "doc_id").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.99


def test_shards_hold_every_labelled_row_once(spark, monkeypatch):
    docs, labels = made(spark, 300)
    seen = {}
    start = toxicity.start

    def watched(names, by_name, by_label, counts):
        seen.update(rows=by_label.sum(), spoken=counts[2 * toxicity.ROWS :].sum())
        return start(names, by_name, by_label, counts)

    monkeypatch.setattr(toxicity, "start", watched)
    toxicity.train(docs, labels, shard_rows=10)
    assert seen == {"rows": labels.count(), "spoken": 12 * labels.count()}
