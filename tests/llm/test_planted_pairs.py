"""Near copies right at the limit are linked, and those right below it aren't, in numbers that a chance of misses would show in."""

import pytest
from pyspark.sql import functions as F

from helixframe.llm import near_dedup

WORDS, WIDTH = 104, 5  # 100 shingles a text


def pairs(spark, n, shared):
    """n pairs of texts with 100 shingles each, the first `shared` of them equal; no word is in two pairs."""
    i = F.col("id")
    own = F.when(i % 2 == 1, "x").otherwise("")

    def word(k):
        changed = F.when(k < shared + WIDTH - 1, "").otherwise(own)
        return F.substring(F.md5(F.concat_ws("-", F.floor(i / 2), k, changed)), 1, 12)

    return spark.range(2 * n).select(i.alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word), " ").alias("text"))


@pytest.mark.parametrize("num, shared, linked", [(85, 92, True), (85, 91, False), (80, 89, True), (80, 88, False)])
def test_pairs_at_the_limit(spark, num, shared, linked):
    assert linked == (100 * shared >= num * (200 - shared))
    n = 2000
    got = near_dedup.components(pairs(spark, n, shared), num=num)
    assert got.where("n_shingles = 100").count() == 2 * n
    assert got.where("kept").count() == (n if linked else 2 * n)
