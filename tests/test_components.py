import numpy as np
import pytest

from martloom.operators.components import correlation_table, fit_components, fit_usable, numeric_columns
from martloom.plans.multivariate import grouped_scores


def direct(matrix):
    """Plain numpy: mean fill, z scores over N, eigenvectors of the covariance over N - 1."""
    x = np.array(matrix, dtype=float)
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    sd = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1)
    values, vectors = np.linalg.eigh(z.T @ z / (len(z) - 1))
    order = np.argsort(-values)
    vectors = vectors[:, order]
    for k in range(vectors.shape[1]):
        lead = np.argmax(np.abs(vectors[:, k]) >= np.abs(vectors[:, k]).max() - 1e-9)
        vectors[:, k] *= np.sign(vectors[lead, k])
    return z, values[order], vectors


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    a = rng.normal(1000, 3, 250)
    x = np.column_stack([a, 2 * a + rng.normal(0, 4, 250), rng.exponential(2, 250), rng.integers(0, 9, 250)])
    x[rng.random(x.shape) < 0.08] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(7)


FEATURES = ["a", "b", "c", "d"]


def test_fit_matches_direct_computation(data):
    x, df = data
    z, values, vectors = direct(x)
    fit = fit_components(df, FEATURES)
    assert fit.values == pytest.approx(list(values)) and fit.ratios == pytest.approx(list(values / values.sum()))
    assert np.array(fit.vectors) == pytest.approx(vectors, abs=1e-9)
    assert sum(fit.values) == pytest.approx(4 * 250 / 249)
    eigen = fit.eigen().collect()
    assert [r["pc"] for r in eigen] == [1, 2, 3, 4] and eigen[3]["cumulative"] == pytest.approx(1)
    scores = {r["id"]: [r[f"pc{k}"] for k in range(1, 5)] for r in fit.scores(df, ["id"]).collect()}
    want = z @ vectors
    for i in range(250):
        assert scores[i] == pytest.approx(list(want[i]), abs=1e-8)
    loadings = {(r["feature"], r["pc"]): r["loading"] for r in fit.loadings().collect()}
    assert loadings[("b", 2)] == pytest.approx(vectors[1, 1] * np.sqrt(values[1]))
    circle = {r["feature"]: (r["x"], r["y"]) for r in fit.circle(1, 3).collect()}
    assert circle["c"] == pytest.approx((loadings[("c", 1)], loadings[("c", 3)]))
    corr = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation_table(fit).collect()}
    assert corr[("a", "b")] == pytest.approx((z.T @ z / 250)[0, 1]) and len(corr) == 10
    assert fit.scree().first()["percent"] == pytest.approx(100 * fit.ratios[0])


def test_extremes_and_quality(data):
    x, df = data
    z, _, vectors = direct(x)
    s = z @ vectors
    fit = fit_components(df, FEATURES)
    dist = np.sqrt(s[:, 0] ** 2 + s[:, 1] ** 2)
    got = fit.extremes(df, "id").collect()
    assert [r["id"] for r in got] == list(np.argsort(-dist)[:10])
    share = (s[:, :2] ** 2) / (z**2).sum(axis=1)[:, None]
    quality = {r["id"]: (r["cos2_x"], r["cos2_y"], r["quality"]) for r in fit.quality(df, "id").collect()}
    for i in range(250):
        assert quality[i] == pytest.approx((share[i, 0], share[i, 1], share[i].sum()), abs=6e-4)
    worst = fit.worst(df, "id").collect()
    assert len(worst) == 20 and worst[0]["quality"] == min(q[2] for q in quality.values())
    few = df.filter("id < 30")
    small = fit_components(few, FEATURES)
    assert small.extremes(few, "id").count() == 10 and small.extremes(few, "id", k=15).count() == 15
    assert small.distances(few, "id").count() == 30


def test_planes_and_component_limit(spark, data):
    _, df = data
    assert len(fit_components(df, FEATURES, components=2).values) == 2
    rng = np.random.default_rng(2)
    noise = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(300, 6))], ", ".join(f"x{i} double" for i in range(6)))
    assert [tuple(r) for r in fit_components(noise).planes().collect()] == [(1, 2), (1, 3)]
    assert [tuple(r) for r in fit_components(df, ["a", "b"]).planes().collect()] == [(1, 2)]


def test_constant_column_and_bad_input(spark, data):
    _, df = data
    fit = fit_components(df.selectExpr("id", "a", "7.0 AS c7"), ["a", "c7"])
    assert fit.values[1] == pytest.approx(0) and fit.scales[1] == 1.0
    with pytest.raises(ValueError, match="nope"):
        fit_components(df, ["a", "nope"])
    with pytest.raises(ValueError):
        fit_components(df.limit(1), ["a", "b"])
    with pytest.raises(ValueError):
        fit_components(df, ["a"], missing="guess")


def test_drop_keeps_complete_distinct_rows(spark):
    rows = [(1.0, 2.0), (1.0, 2.0), (3.0, 1.0), (None, 5.0), (4.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    fit = fit_components(df, ["a", "b"], missing="drop")
    _, values, _ = direct([(1, 2), (3, 1), (4, 9)])
    assert fit.rows == 3 and fit.values == pytest.approx(list(values))
    kept, same = fit_usable(df, ["a", "b"])
    assert same.values == fit.values and sorted(map(tuple, kept.collect())) == [(1, 2), (3, 1), (4, 9)]
    assert same.scores(kept, ["a"]).count() == same.distances(kept, "a").count() == 3


def test_numeric_columns_and_groups(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, s string, v double")
    assert numeric_columns(df) == ["id", "v"] and numeric_columns(df, ["id"]) == ["v"]
    scores = spark.createDataFrame([(1, 0.5), (2, 0.1)], "ZIPCODE long, pc1 double")
    mapping = spark.createDataFrame([(1, "BRONX")], "ZIPCODE long, BOROUGH string")
    got = {r["ZIPCODE"]: r["BOROUGH"] for r in grouped_scores(scores, mapping, "ZIPCODE", "BOROUGH").collect()}
    assert got == {1: "BRONX", 2: "Unknown"}


def test_many_columns_in_tiles(spark, monkeypatch):
    """Three hundred columns with missing values: as a direct computation, in one scan besides the count."""
    import numpy as np

    from martloom.operators import components

    d, rows = 300, 400
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(6, d))
    x = rng.normal(size=(rows, 6)) @ mix + rng.normal(size=(rows, d)) * 0.3 + rng.normal(size=d) * 1e4
    x[rng.random((rows, d)) < 0.02] = np.nan
    x[:, 7] = 3.0
    data = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(data, ", ".join(f"c{i} DOUBLE" for i in range(d))).repartition(5)
    fit = components.fit_components(df, components=5)
    filled = np.where(np.isnan(x), np.nanmean(x, 0), x)
    spread = filled.std(0)
    z = (filled - filled.mean(0)) / np.where(spread > 0, spread, 1.0)
    values = np.sort(np.linalg.eigvalsh(z.T @ z / rows))[::-1]
    assert fit.rows == rows
    assert np.allclose(fit.means, filled.mean(0)) and np.allclose(fit.correlation, z.T @ z / rows, atol=1e-9)
    assert np.allclose(fit.values, values[:5] * rows / (rows - 1))
    few = df.select(*[f"c{i}" for i in range(6)])
    wide = components.fit_components(few)
    monkeypatch.setattr(components, "MANY_COLUMNS", 2)
    monkeypatch.setattr(components, "TILE", 4)
    tiled = components.fit_components(few)
    assert np.allclose(wide.correlation, tiled.correlation) and np.allclose(wide.vectors, tiled.vectors) and np.allclose(wide.means, tiled.means)
