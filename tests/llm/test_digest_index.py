import contextlib
import io
import re

from helixframe.llm import exact_dedup


def test_copies_of_later_batches_are_counted(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, path=f"file://{tmp_path}/index")
    for rows in ([("x", 5), ("y", 2), ("n", None)], [("x", 1), ("x", 3), ("z", 4)], [("x", 7), ("n", 9), ("z", 8)]):
        index.add(spark.createDataFrame(rows, "digest string, doc_id long"))
    # The id of the first batch stays; the least of all is known too.
    assert sorted((r.digest, r.keep_id, r.least.id, r.group_size) for r in index.table().collect()) == [("n", None, 9, 2), ("x", 5, 1, 4), ("y", 2, 2, 1), ("z", 4, 4, 2)]
    index.close()


def test_another_session_opens_the_index_by_its_path(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    first = exact_dedup.DigestIndex(spark, path, buckets=3)
    first.add(spark.createDataFrame([("x", 1), ("y", 2)], "digest string, doc_id long"))
    first.close()
    second = exact_dedup.DigestIndex(spark.newSession(), path, buckets=7)
    assert second.buckets == 3
    again = second.spark.createDataFrame([("x", 5), ("y", 6)], "digest string, doc_id long")
    assert second.unseen(again).count() == 0
    second.add(second.spark.createDataFrame([("x", 8), ("z", 9)], "digest string, doc_id long"))
    assert sorted((r.digest, r.keep_id, r.group_size) for r in second.table().collect()) == [("x", 1, 2), ("y", 2, 1), ("z", 9, 1)]
    second.close()
    third = exact_dedup.DigestIndex(spark, path)
    assert sorted(r.digest for r in third.table().collect()) == ["x", "y", "z"]
    third.close()


def test_the_anti_join_does_not_shuffle_the_index(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index")
    index.add(spark.createDataFrame([("x", 1)], "digest string, doc_id long"))
    new = spark.createDataFrame([("x", 3), ("y", 4)], "digest string, doc_id long")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        index.unseen(new).explain()
    plan = text.getvalue()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1
    index.close()
