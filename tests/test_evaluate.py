import numpy as np
import pandas as pd
import pytest

from sensorgrid.operators import calibrate, evaluate


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(1)
    obs = rng.normal(50, 10, 500)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "obs": obs, "pred": obs * 0.8 + rng.normal(0, 5, 500)})
    return pdf, spark.createDataFrame(pdf)


def test_metrics(scored):
    pdf, df = scored
    got = evaluate.regression_metrics(df, "obs", "pred").first()
    error = pdf.obs - pdf.pred
    assert got["n"] == 500 and got["n_missing"] == 0
    assert got["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert got["mae"] == pytest.approx(error.abs().mean())
    assert got["r2"] == pytest.approx(1 - (error**2).sum() / ((pdf.obs - pdf.obs.mean()) ** 2).sum())
    assert got["r2_corr"] == pytest.approx(np.corrcoef(pdf.obs, pdf.pred)[0, 1] ** 2)


def test_rows_without_prediction_are_counted_apart(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, 4.0)], "obs double, pred double")
    got = evaluate.regression_metrics(df, "obs", "pred").first()
    assert (got["n"], got["n_missing"], got["rmse"], got["r2"]) == (2, 1, 1.0, 0.75)


def test_mean_over_folds_is_unweighted(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1.0), (1, 2.0, 3.0), (2, 0.0, 3.0), (2, 2.0, 5.0), (2, 4.0, 7.0)],
        "g int, obs double, pred double",
    )
    per_group = evaluate.metrics_by_group(df, "g", "obs", "pred")
    assert evaluate.mean_metrics(per_group).first()["rmse"] == pytest.approx(2.0)


@pytest.mark.parametrize("size, top", [(4, None), (50, 7), (3000, 400), (3000, None)])
def test_correlations(spark, size, top):
    rng = np.random.default_rng(size)
    if size == 4:
        pdf = pd.DataFrame({"pred": [1.0, 1, 2, 3], "obs": [1.0, 2, 2, 4]})
    else:
        pred = rng.integers(0, top, size).astype(float) if top else rng.lognormal(0, 3, size)
        pdf = pd.DataFrame({"pred": pred, "obs": np.round(pred + rng.normal(0, 5, size))})
    got = evaluate.sensor_correlation(spark.createDataFrame(pdf)).first()
    assert got["pearson"] == pytest.approx(pdf.pred.corr(pdf.obs))
    assert got["spearman"] == pytest.approx(pdf.pred.rank().corr(pdf.obs.rank()))


def test_average_ranks(spark):
    values = [float(v) for v in np.random.default_rng(2).integers(-700, 900, 2500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["v"]: r["rank"] for r in evaluate.average_ranks(df, "v").collect()}
    expected = pd.Series(values).rank()
    assert all(got[v] == r for v, r in zip(values, expected, strict=True))


def test_histogram_counts(scored):
    pdf, df = scored
    got = evaluate.distribution_table(df, "obs").toPandas()
    low, high = pdf[["obs", "pred"]].min().min(), pdf[["obs", "pred"]].max().max()
    for series in ("obs", "pred"):
        counts, _ = np.histogram(pdf[series], bins=30, range=(low, high))
        part = got[got.series == series].set_index("bin")["n"]
        assert [part.get(i, 0) for i in range(30)] == counts.tolist()


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, None)], "obs double, pred double")
    got = evaluate.distribution_table(df, "obs").collect()
    assert {(r["series"], r["bin"], r["n"]) for r in got} == {("obs", 0, 2), ("pred", 0, 1)}


def test_residuals(scored):
    pdf, df = scored
    got = evaluate.residuals(df, "obs", keep=["g"]).toPandas()
    assert np.allclose(got.resid, pdf.obs - pdf.pred)


def test_calibration(spark):
    predictions = spark.createDataFrame(
        [(1, 1, 2.0), (1, 1, 4.0), (2, 1, 0.0), (3, 1, 1.0)], "x bigint, y bigint, value double"
    )
    volume = spark.createDataFrame(
        [(1, 1, 144.0), (2, 1, 10.0), (4, 1, 5.0)], "x bigint, y bigint, kfz_per_24h double"
    )
    factors = calibrate.calibration_factors(volume, predictions)
    assert sorted(map(tuple, factors.collect())) == [(1, 1, 144.0, 72.0, 2.0), (2, 1, 10.0, 0.0, 5.0)]
    scaled = calibrate.apply_factors(predictions, factors, divisor=2, how="left")
    assert sorted(r["pred"] for r in scaled.collect() if r["pred"] is not None) == [0.0, 2.0, 4.0]
    assert scaled.count() == 4


def test_factors_at_sensors(spark):
    sections = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (3, 3), (4, 4)], "lat_int bigint, lon_int bigint")
    reprojection = spark.createDataFrame(
        [(1, 1, 10, 10), (2, 2, 20, 20), (4, 4, 40, 40)], "lat_int bigint, lon_int bigint, x bigint, y bigint"
    )
    sensors = spark.createDataFrame(
        [(10, 10, 0, 0), (20, 20, 1, 1)], "det_x bigint, det_y bigint, stadt_x bigint, stadt_y bigint"
    )
    factors = spark.createDataFrame([(0, 0, 2.5)], "x bigint, y bigint, scaling double")
    got = calibrate.factors_at_sensors(sections, reprojection, sensors, factors).collect()
    assert {tuple(r) for r in got} == {(10, 10, 2.5), (20, 20, None), (None, None, None)}
    known = calibrate.factors_at_sensors(sections, reprojection, sensors, factors, unmatched="drop")
    assert {tuple(r) for r in known.collect()} == {(10, 10, 2.5), (20, 20, None)}
