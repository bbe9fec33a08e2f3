import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import minute, rows
from tickflow.operators import evaluate, ml
from tickflow.plans.rowindex import row_index
from tickflow.plans.features import training_rows
from tickflow.schemas import FEATURES, TARGET


@pytest.mark.parametrize("n", [6, 11, 100, 583])
def test_folds_are_disjoint_and_ordered(n):
    bounds = ml.fold_bounds(n)
    assert bounds[-1][2] == n and len(bounds) == 5
    assert all(a[2] == b[1] for a, b in zip(bounds, bounds[1:]))
    assert {e - s for _, s, e in bounds} == {n // 6} and bounds[0][1] > 0


def test_too_few_rows_for_folds(spark):
    with pytest.raises(ValueError):
        ml.fold_bounds(5)
    with pytest.raises(ValueError):
        training_rows(spark.createDataFrame([tuple([0.0] * 8)] * 9, ", ".join(f"{c} double" for c in [*FEATURES, TARGET])))


def test_time_folds_match_the_bounds(spark):
    df = spark.range(50).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, (id * 7) % 50, 0)").alias("t"))
    got = {r["row_index"]: r["fold"] for r in ml.time_folds(df, ["t"]).collect()}
    want = {i: 0 for i in range(50)}
    for k, s, e in ml.fold_bounds(50):
        want.update({i: k for i in range(s, e)})
    assert got == want


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(ml.standardize(df, ["a", "b"]), "a") == [(-1.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(0.0, 5.0), (4.0, 6.0)], "a double, b double")
    assert ml.standardize(df, ["a"], by_stats_of=other).first()["a"] == -0.5


@pytest.fixture(scope="module")
def learnable(spark):
    rng = random.Random(0)
    data = []
    for i in range(400):
        x = [rng.random() for _ in FEATURES]
        data.append((minute(i), *x, 2 * x[0] + (1 if x[1] > 0.5 else 0)))
    df = spark.createDataFrame(data, "window_start timestamp_ntz, " + ", ".join(f"{c} double" for c in [*FEATURES, TARGET]))
    return row_index(df, ["window_start"])


def test_trees_beat_the_mean_and_repeat_under_a_seed(spark, learnable):
    train, tail = ml.split_tail(learnable)
    assert (train.count(), tail.count()) == (360, 40)
    mae = lambda df: df.agg(F.avg(F.abs(F.col("predicted_vol") - F.col(TARGET)))).first()[0]
    one = ml.train_gbt(train, tail, maxIter=30, stepSize=0.2)
    mean = train.agg(F.avg(TARGET)).first()[0]
    scored = ml.score(one, tail, "v1")
    assert mae(scored) < 0.4 * mae(tail.withColumn("predicted_vol", F.lit(mean)))
    again = ml.score(ml.train_gbt(train, tail, maxIter=30, stepSize=0.2), tail, "v1")
    assert rows(scored.select("row_index", "predicted_vol"), "row_index") == rows(again.select("row_index", "predicted_vol"), "row_index")
    weights = dict(ml.importances(one))
    assert max(weights, key=weights.get) in FEATURES[:2] and abs(sum(weights.values()) - 1) < 1e-9


def test_cross_validation_summary(spark):
    folds = spark.createDataFrame([(1, 0.1, 0.2), (2, 0.3, 0.4)], "fold int, mae double, rmse double")
    r = ml.cv_summary(folds).first()
    assert (r["mae_cv_mean"], r["mae_cv_std"]) == (pytest.approx(0.2), pytest.approx(0.1))


def test_promotions(spark):
    maes = [0.002, 0.0014, 0.0016, 0.00145, 0.0013, 0.0013, 0.0012]
    df = spark.createDataFrame([(i + 1, m) for i, m in enumerate(maes)], "version bigint, mae double")
    out = evaluate.promotions(df, block=2)
    assert [r[0] for r in rows(out.where("promoted").select("version"), "version")] == [2, 5, 7]
    assert rows(evaluate.serving_version(out)) == [(7, "production")]
    assert rows(evaluate.serving_version(evaluate.promotions(df.where("version = 1")))) == [(1, "latest")]


def test_clusters_and_regimes(spark):
    rng = random.Random(2)
    data = [(minute(i), float(i % 3) * 10 + rng.random(), rng.random(), rng.random(), "s", 1.0) for i in range(90)]
    df = spark.createDataFrame(data, "window_start timestamp_ntz, rolling_vol double, price_range_ratio double, vol_ratio double, symbol string, close double")
    names = ["rolling_vol", "price_range_ratio", "vol_ratio"]
    sweep = ml.kmeans_sweep(df, names[:1], ks=[2, 3])
    got = {r["k"]: r for r in sweep.collect()}
    assert got[3]["silhouette"] > got[2]["silhouette"] and sorted(got[3]["cluster_sizes"]) == [30, 30, 30]
    assert ml.choose_k(sweep, 90) == 3 and ml.choose_k(sweep, 3) == 3 and ml.choose_k(sweep.where("k = 2"), 2) == 2
    assigned = ml.assign_clusters(df, names[:1], 3)
    labels = ml.regime_labels(assigned, names[:1], 3)
    by_rank = [r["label"] for r in labels.orderBy("rank").collect()]
    assert by_rank == ["Stabil", "Volatilitas Sedang", "Volatilitas Tinggi"]
    line = ml.regime_timeline(assigned, labels, df)
    assert line.count() == 90 and {r["label"] for r in line.where("hour(window_start) * 60 + minute(window_start) IN (2, 5)").collect()} == {"Volatilitas Tinggi"}


def test_pca(spark):
    rng = random.Random(4)
    data = [(x := rng.random(), x * 2 + rng.random() * 0.01, rng.random()) for _ in range(60)]
    projected, loadings = ml.pca2(spark.createDataFrame(data, "a double, b double, c double"), ["a", "b", "c"])
    assert projected.count() == 60
    r = {x["feature"]: x for x in loadings.collect()}
    assert r["a"]["pc1_share"] > 0.6 and abs(abs(r["a"]["pc1"]) - abs(r["b"]["pc1"])) < 0.01 and abs(r["c"]["pc1"]) < 0.3


def plain_kmeans(x, points, rounds):
    for _ in range(rounds):
        nearest = ((x[:, None] - points[None]) ** 2).sum(axis=2).argmin(axis=1)
        points = np.array([x[nearest == c].mean(axis=0) if (nearest == c).any() else points[c] for c in range(len(points))])
    gaps = ((x[:, None] - points[None]) ** 2).sum(axis=2)
    return points, gaps.min(axis=1).sum(), np.bincount(gaps.argmin(axis=1), minlength=len(points))


def test_runs_that_share_scans_equal_runs_alone(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 1, (70, 2)) for c in ((0, 0), (9, 0), (0, 9))])
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(5)
    found = ml.shared_kmeans(rows, ["a", "b"], [2, 3, 4], seeds=[1, 2], starts=2, settled=1e-12)
    assert set(found) == {(k, s) for k in (2, 3, 4) for s in (1, 2)}
    for (k, seed), run in found.items():
        _, inertia, sizes = plain_kmeans(x, run.points, 1)      # settled: a round alone changes nothing
        assert run.inertia == pytest.approx(inertia, rel=1e-9) and list(run.sizes) == list(sizes) and sizes.sum() == len(x)
    assert sorted(found[3, 1].sizes) == [70, 70, 70]


def test_sweep_scans_by_rounds_and_not_by_runs(spark, monkeypatch):
    scans, assigned = [], ml._assigned
    monkeypatch.setattr(ml, "_assigned", lambda rows, columns, runs: scans.append(len(runs)) or assigned(rows, columns, runs))
    rows = spark.createDataFrame([(float(i % 17), float(i % 5)) for i in range(200)], "a double, b double")
    ml.shared_kmeans(rows, ["a", "b"], range(2, 10))
    assert scans[0] == 80 and len(scans) <= ml.ROUNDS + 1


def test_first_centres_of_few_different_rows(spark):
    rows = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "a double")
    run = ml.shared_kmeans(rows, ["a"], [3])[3, 42]
    assert run.inertia == 0 and run.sizes.sum() == 10


def test_best_round_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        losses = [rng.random() for _ in range(rng.randint(1, 60))]
        patience, best, waited, stopped = rng.randint(1, 12), 0, 0, False
        for i, v in enumerate(losses):
            if v < losses[best]:
                best, waited = i, 0
            elif i:
                waited += 1
            if waited == patience:
                stopped = True
                break
        assert ml.best_round(losses, patience) == (best + 1, stopped)


def test_patient_boosting_keeps_the_best_round(spark):
    rng = random.Random(5)
    data = [(x := rng.random(), (x > 0.5) * 1.0 + rng.gauss(0, 0.6)) for _ in range(400)]
    frame = spark.createDataFrame(data, "a double, y double").repartition(1).cache()
    train, valid = frame.where("a * 1000 % 3 >= 1"), frame.where("a * 1000 % 3 < 1")
    model, losses = ml.train_patient(train, valid, ["a"], "y", patience=3, first=4, maxIter=30, stepSize=0.5)
    chosen = model.stages[-1].getNumTrees
    assert chosen == ml.best_round(losses, 3)[0]
    error = F.col("predicted_vol") - F.col("y")
    assert model.transform(valid).agg(F.avg(error * error)).first()[0] == pytest.approx(losses[chosen - 1], rel=1e-9)
