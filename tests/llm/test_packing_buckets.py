import collections

import public_tokenizers as P

from helixframe.llm import packing


def test_buckets_hold_every_piece(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, None), (None, "x " * 700)], "doc_id long, text string")
    packed = packing.pack(docs, P.path("byte_bpe_50k.json")).cache()
    packing.write_buckets(packed, f"file://{tmp_path}/out")
    key = lambda d: sorted((r.length, r.sequence_id, r.ids_crc32, tuple(r.ids)) for r in d.collect())
    assert key(spark.read.parquet(f"file://{tmp_path}/out")) == key(packed)


def test_numbers_are_dense_in_each_bucket_and_rows_come_by_bucket(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('word ', int(id % 77)) AS text").repartition(7)
    packed = packing.pack(docs, P.path("byte_bpe_50k.json"), 16, with_ids=False)
    numbers = collections.defaultdict(list)
    for r in packed.collect():
        assert r.length == 1 << (r.sequence_id >> packing.BUCKET)
        numbers[r.length].append(r.sequence_id & ((1 << packing.BUCKET) - 1))
    assert set(numbers) == {1, 2, 4, 8, 16} and all(sorted(x) == list(range(len(x))) for x in numbers.values())
    for part in packed.rdd.glom().collect():
        assert [r.length for r in part] == sorted(r.length for r in part)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), P.path("byte_bpe_50k.json")).count() == 0
