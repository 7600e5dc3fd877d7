import numpy as np

from helixframe.llm import nearest


def test_several_parts_with_fewer_probes_find_the_neighbours(spark, monkeypatch):
    fitted, fit = [], nearest.fit
    monkeypatch.setattr(nearest, "fit", lambda *a, **b: fitted.append(fit(*a, **b)) or fitted[-1])
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(24, 16))
    x = (centres[rng.integers(0, 24, 2400)] + 0.3 * rng.normal(size=(2400, 16))).astype(np.float32)
    got = nearest.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), cut=nearest.Cut(rows=256)).toPandas()
    assert fitted[0].parts > 2 and fitted[0].probes < fitted[0].parts
    assert set(got.query_id) == set(range(0, 2400, 20))
    found = 0
    for q, part in got.groupby("query_id"):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        found += len(set(part.vec_id) & set(np.argsort(-s)[:20].tolist()))
    assert found >= 0.9 * 20 * got.query_id.nunique()


def test_parts_of_parts_find_the_neighbours(spark, monkeypatch):
    seen, cut = [], nearest._cut_again
    monkeypatch.setattr(nearest, "_cut_again", lambda *a: seen.append(cut(*a)) or seen[-1])
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 6000)] + 0.3 * rng.normal(size=(6000, 16))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = nearest.search(rows, cut=nearest.Cut(rows=64, most=8, sample=2048, sample_inner=1024)).toPandas()
    placed, asked = seen[0]
    parts = placed.select("part").distinct().count()
    assert placed.count() == 6000 and parts > 8
    assert asked.count() < 300 * parts / 2  # far fewer probes than parts
    assert set(got.query_id) == set(range(0, 6000, 20))
    found = 0
    for q, part in got.groupby("query_id"):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        found += len(set(part.vec_id) & set(np.argsort(-s)[:20].tolist()))
    assert found >= 0.9 * 20 * got.query_id.nunique()
