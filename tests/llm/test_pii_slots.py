"""Identifiers that no base pattern and no token shape knows, found by what stands around them."""

import pytest

from helixframe.llm import pii

SEEDS = [(i, f"Please call me at desk +1 202 555 01{i:02d} today") for i in range(60)]


def _added(spark, *texts):
    rows = SEEDS + [(100 + i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [[t[int(a) : int(b)] for _, a, b in (x.split(":") for x in got[100 + i].split(",") if x)] for i, t in enumerate(texts)]


def test_spaced_and_bracketed_identifiers_are_found(spark):
    unseen = ["415 555 0199", "(415) 555-0199", "john [at] example.com", "4111 1111 1111 1112", "12 34"]
    assert _added(spark, *[f"Please call me at desk {x} today" for x in unseen]) == [[x] for x in unseen]


def test_a_slot_ends_with_its_run_where_no_right_word_follows(spark):
    assert _added(spark, "Please call me at desk 415 555 0199, thanks", "Please call me at desk: (415) 555 0199") == [["415 555 0199"], ["(415) 555 0199"]]


def test_slots_with_other_words_lower_the_score(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    assert _added(spark, *[f"Please call me at desk {w} today" for w in words]) == [[] for _ in words]


def test_redact_masks_slots(spark):
    rows = [*SEEDS, (100, "Please call me at desk (415) 555-0199 today"), (None, "Please call me at desk 415 555 0199 today"), (100, None)]
    got = [r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert got.count("Please call me at desk <PHONE> today") == 62 and got.count(None) == 1


@pytest.mark.parametrize(("text", "want"), [(" (415) 555, ", "(415) 555"), ("[x y]", "x y"), ("<a [at] b.org>.", "a [at] b.org"), ("x)", "x"), ("(x", "x"), (" .,", "")])
def test_trimmed(text, want):
    a, b = pii.trimmed(text, 0, len(text))
    assert text[a:b] == want
