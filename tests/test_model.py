"""Scaling, folds and the elastic net."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.functions import fixed_values as V
from indicata.operators import model, moments


def coordinate_descent(x, y, alpha, ratio=0.5, rounds=5000):
    """Minimise 1/(2n) |y - xw - b|^2 + alpha ratio |w|_1 + alpha (1 - ratio) / 2 |w|^2."""
    xm, ym = x.mean(0), y.mean()
    gram, cross = (x - xm).T @ (x - xm) / len(y), (x - xm).T @ (y - ym) / len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        before = w.copy()
        for j in range(len(w)):
            pull = cross[j] - gram[j] @ w + gram[j, j] * w[j]
            w[j] = np.sign(pull) * max(abs(pull) - alpha * ratio, 0.0) / (gram[j, j] + alpha * (1 - ratio))
        if np.abs(w - before).max() < 1e-12:
            break
    return w, ym - xm @ w


def feature_table(spark, years=range(2010, 2021), per_year=1, seed=0):
    rand = random.Random(seed)
    rows = []
    for year in years:
        for _ in range(per_year):
            base = year - 2000
            a, b, c, d, e = (base * s + 9 * rand.random() for s in (3.0, 0.5, 1.2, 0.1, 2.0))
            rows.append((year, a, b, c, 2 * a - b + 3 * d + rand.random(), d, e))
    columns = ", ".join(f"{c} {'int' if c == 'YEAR' else 'double'}" for c in V.FEATURE_COLUMNS)
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("alpha", [1e-4, 1e-2, 1e-1, 0.5])
def test_coefficients_equal_coordinate_descent(spark, alpha):
    table = model.MinMax.fit(feature_table(spark, per_year=3), V.FEATURE_COLUMNS).transform(
        feature_table(spark, per_year=3)
    )
    features = [c for c in V.FEATURE_COLUMNS if c not in ("YEAR", V.LABEL_COLUMN)]
    fit = model.fit_elastic_net(table, features, alphas=[alpha])
    rows = np.array([tuple(r) for r in table.select(*features, V.LABEL_COLUMN).collect()])
    w, b = coordinate_descent(rows[:, :-1], rows[:, -1], alpha)
    assert np.allclose(fit.coefficients, w, atol=1e-5)
    assert abs(fit.intercept - b) < 1e-5


def test_cross_validation_equals_coordinate_descent(spark):
    table = feature_table(spark)
    fitted = model.fit_gdp_model(table)
    rows = np.array([tuple(r) for r in table.orderBy("YEAR").collect()], dtype=float)
    scaled = (rows - rows.min(0)) / (rows.max(0) - rows.min(0))
    label = V.FEATURE_COLUMNS.index(V.LABEL_COLUMN)
    columns = [i for i, c in enumerate(V.FEATURE_COLUMNS) if c not in ("YEAR", V.LABEL_COLUMN)]
    train, test = scaled[scaled[:, 0] < 0.8], scaled[scaled[:, 0] >= 0.8]
    assert (len(train), len(test)) == (8, 3)
    errors = {}
    for alpha in V.ALPHAS:
        per_fold = []
        for fold in np.array_split(np.arange(len(train)), 5):
            kept = np.delete(train, fold, axis=0)
            w, b = coordinate_descent(kept[:, columns], kept[:, label], alpha)
            per_fold.append(np.mean((train[fold][:, label] - train[fold][:, columns] @ w - b) ** 2))
        errors[alpha] = np.mean(per_fold)
    best = min(errors, key=errors.get)
    assert fitted.fit.alpha == best
    for alpha, error in errors.items():
        assert fitted.fit.fold_mse[alpha] == pytest.approx(error, rel=1e-3, abs=1e-8)
    w, b = coordinate_descent(train[:, columns], train[:, label], best)
    predicted = test[:, columns] @ w + b
    mse = np.mean((test[:, label] - predicted) ** 2)
    metrics = fitted.metrics.first()
    assert metrics["MSE"] == pytest.approx(mse, rel=1e-3)
    assert metrics["RMSE"] == pytest.approx(mse**0.5, rel=1e-3)
    total = np.mean((test[:, label] - test[:, label].mean()) ** 2)
    assert metrics["R2"] == pytest.approx(1 - mse / total, rel=1e-3)
    assert fitted.predictions.count() == 3


def test_train_only_bounds(spark):
    table = feature_table(spark)
    fitted = model.fit_gdp_model(table, fit_on="train")
    assert fitted.predictions.agg(F.max(V.LABEL_COLUMN)).first()[0] > 1


def test_minmax_of_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (3, 5.0), (2, 5.0)], "a int, b double")
    rows = {tuple(r) for r in model.MinMax.fit(df, ["a", "b"]).transform(df).collect()}
    assert rows == {(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)}
    with pytest.raises(ValueError):
        model.MinMax.fit(df.limit(0), ["a"])


def test_folds_are_contiguous_and_keep_a_year_together(spark):
    df = spark.createDataFrame([(y,) for y in range(2010, 2018) for _ in range(3)], "YEAR int")
    folds = df.withColumn("f", model.contiguous_folds(df, 5, "YEAR")).distinct().orderBy("YEAR").collect()
    assert [r["f"] for r in folds] == [0, 0, 1, 1, 2, 2, 3, 4]
    with pytest.raises(ValueError):
        model.contiguous_folds(df, 9, "YEAR")


def test_correlations_equal_numpy(spark):
    table = feature_table(spark, per_year=4)
    names = list(V.FEATURE_COLUMNS[1:4])
    rows = np.array([tuple(r) for r in table.select(*names).collect()])
    expected = np.corrcoef(rows.T)
    found = {(r["feature"], r["other"]): r["correlation"] for r in model.correlations(table, names).collect()}
    assert len(found) == 9
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert found[a, b] == pytest.approx(expected[i, j], abs=1e-9)


def test_folds_of_many_times_equal_an_array_split(spark):
    times = np.array([t * 3 + 1 for t in range(12_000)])
    df = spark.range(24_000).select(((F.col("id") % 12_000) * 3 + 1).alias("t"), F.lit(None).cast("int").alias("time"))
    found = df.repartition(7).withColumn("f", model.contiguous_folds(df, 5, "t")).distinct()
    by_time = {r["t"]: r["f"] for r in found.collect()}
    for k, part in enumerate(np.array_split(times, 5)):
        assert {by_time[t] for t in part.tolist()} == {k}


def test_correlations_of_columns_with_nulls_use_the_rows_of_each_pair(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, None, 5.0), (3.0, 1.0, None), (4.0, 7.0, 2.0), (5.0, 3.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r[0], r[1]): r[2] for r in model.correlations(df, ["a", "b", "c"]).collect()}
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
            assert found[x, y] == pytest.approx(np.corrcoef(both.T)[0, 1])


def test_correlation_with_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    found = {(r[0], r[1]): r[2] for r in model.correlations(df, ["a", "b"]).collect()}
    assert found["a", "b"] is None and found["a", "a"] == pytest.approx(1.0)


def test_moments_merge_and_keep_digits_far_from_zero(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 3)) + [1e9, -1e8, 0]
    df = spark.createDataFrame([(i % 3, *map(float, r)) for i, r in enumerate(rows)], "g int, a double, b double, c double")
    parts = moments.gather(df.repartition(6), ["a", "b", "c"], F.col("g"))
    whole = sum(parts.values(), moments.none(["a", "b", "c"]))
    assert sorted(parts) == [0, 1, 2] and whole.count == 400
    assert np.allclose(whole.covariance(), np.cov(rows.T, bias=True), atol=1e-6)
    assert np.allclose(whole.mean, rows.mean(0), rtol=1e-12)


def test_errors_from_moments_are_those_of_the_rows(spark):
    rng = np.random.default_rng(2)
    rows = rng.random((60, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double, y double")
    (found,) = moments.gather(df, ["a", "b", "c", "y"]).values()
    weights = np.array([0.3, -1.0, 2.0])
    error = np.mean((rows[:, 3] - rows[:, :3] @ weights - 0.7) ** 2)
    assert moments.squared_error(found, "y", weights, 0.7) == pytest.approx(error, rel=1e-12)


def test_nulls_among_rows_to_fit_on_are_named(spark):
    table = feature_table(spark).withColumn(V.FEATURE_COLUMNS[2], F.lit(None).cast("double"))
    features = [c for c in V.FEATURE_COLUMNS if c not in ("YEAR", V.LABEL_COLUMN)]
    with pytest.raises(ValueError, match=V.FEATURE_COLUMNS[2]):
        model.fit_elastic_net(table, features)


def test_number_of_passes_does_not_grow_with_penalties(spark):
    def jobs_of(alphas):
        spark.sparkContext.setJobGroup(f"fit-{len(alphas)}", "")
        model.fit_gdp_model(table, alphas=alphas).metrics.collect()
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{len(alphas)}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(found)

    table = feature_table(spark, per_year=3)
    few, many = jobs_of([0.1]), jobs_of([0.001 * 1.3**i for i in range(40)])
    assert few == many <= 20
