from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripweave.operators import ml as M


@pytest.fixture(scope="module")
def trips(spark):
    """Trips whose rider type shows in the hour at pickup, in the duration at drop-off, and in the fare."""
    i = F.col("id")
    casual = (i % 10) < 3
    hour = F.when(casual, 14 + i % 5).otherwise(F.when(i % 2 == 0, 8 + i % 2).otherwise(17 + i % 3))
    return spark.range(4000).select(
        F.concat(F.lit("T"), i).alias("trip_id"),
        F.element_at(F.array(*[F.lit(d) for d in "ABCA"]), (i % 4 + 1).cast("int")).alias("district"),
        hour.cast("int").alias("hour"), (1 + i % 7).cast("int").alias("weekday"),
        (i % 7).isin(0, 6).alias("weekend"), (i % 3 == 0).cast("int").alias("electric"),
        (F.when(casual, 20.0).otherwise(8.0) + i % 11).alias("duration_min"),
        ((i * 7 % 50) / 10.0).alias("distance_km"),
        F.when(casual, F.lit(2.0)).otherwise(F.lit(0.0)).alias("fare_eur"),
        casual.cast("double").alias("label")).cache()


def test_models_learn_and_the_leak_shows(trips):
    baseline = 1 - trips.agg(F.avg("label")).first()[0]
    forest = M.fit_pickup(trips, kind="rf", trees=10, depth=5)
    predictions = forest.transform(trips)
    auc, accuracy = M.evaluate(predictions)
    assert accuracy > baseline and auc > 0.9
    top = M.importances(forest, predictions, k=2)
    assert top[0][0] == "hour" and top[0][1] >= top[1][1]
    assert M.area_under_roc(M.fit_dropoff(trips).transform(trips)) > 0.9
    assert M.area_under_roc(M.fit_pickup(trips, extra=["fare_eur"]).transform(trips)) == pytest.approx(1.0)


def test_unseen_district_is_scored(spark, trips):
    model = M.fit_pickup(trips)
    stranger = trips.limit(1).withColumn("district", F.lit("Z"))
    assert model.transform(stranger).select("prediction").first()[0] in (0.0, 1.0)


def test_weights_and_threshold_move_recall(trips):
    plain = M.by_label(M.fit_pickup(trips).transform(trips), "recallByLabel")
    weighted = M.by_label(M.fit_weighted(trips).transform(trips), "recallByLabel")
    lowered = M.by_label(M.fit_pickup(trips, threshold=0.2).transform(trips), "recallByLabel")
    assert weighted >= plain and lowered >= plain
    shares = {r["label"]: r["weight"] for r in M.with_class_weights(trips).select("label", "weight").distinct().collect()}
    assert shares == pytest.approx({1.0: 0.7, 0.0: 0.3})


def test_threshold_report_reads_one_model_as_refits_would(trips):
    report = {r["threshold"]: r for r in M.threshold_report(M.fit_pickup(trips).transform(trips), [0.2, 0.5]).collect()}
    for threshold, row in report.items():
        refit = M.fit_pickup(trips, threshold=threshold).transform(trips)
        assert row["recall"] == pytest.approx(M.by_label(refit, "recallByLabel"))
        assert row["precision"] == pytest.approx(M.by_label(refit, "precisionByLabel"))


def test_counts_and_evaluators_agree(spark):
    table = spark.createDataFrame([(1.0, 1.0)] * 3 + [(1.0, 0.0)] * 2 + [(0.0, 1.0)] + [(0.0, 0.0)] * 4,
                                  "label double, prediction double")
    assert rows(M.confusion(table)) == [(0.0, 4, 1), (1.0, 2, 3)]
    assert tuple(M.precision_recall(table).first()) == (0.75, 0.6)
    assert M.by_label(table, "precisionByLabel") == 0.75 and M.by_label(table, "recallByLabel") == pytest.approx(0.6)
    nobody = table.withColumn("prediction", F.lit(0.0))
    assert M.precision_recall(nobody).first()["precision"] is None


def test_exact_auc_with_ties(spark):
    table = spark.createDataFrame([(1.0, 3.0), (1.0, 2.0), (0.0, 2.0), (0.0, 1.0)], "label double, score double")
    assert M.area_under_roc(table, "score") == pytest.approx(0.875)


def test_saved_model_scores_the_same(spark, trips, tmp_path):
    model, path = M.fit_dropoff(trips), str(tmp_path / "model")
    M.save(model, path)
    again = M.load_or_train(spark, path, lambda: pytest.fail("must not train"))
    assert M.evaluate(again.transform(trips)) == M.evaluate(model.transform(trips))


def test_fallback_trains_on_a_sample(spark, trips, tmp_path):
    path = str(tmp_path / "missing")
    model = M.load_or_train(spark, path, lambda: trips, sample=0.2, keep=True)
    assert M.area_under_roc(model.transform(trips)) > 0.8
    M.load_or_train(spark, path, lambda: pytest.fail("must load"))


def test_bare_logistic(trips):
    assert M.area_under_roc(M.fit_numeric(trips, ["hour", "electric", "duration_min"]).transform(trips)) > 0.9


def test_linear_regression_recovers_a_line(trips):
    exact = trips.withColumn("duration_min", 3 + 2 * F.col("distance_km") + F.col("electric") + 12 * F.col("label"))
    model = M.fit_duration(exact)
    assert model.stages[-1].coefficients.toArray() == pytest.approx([2, 1, 12], abs=1e-6)
    rmse, r2 = M.regression_scores(model.transform(exact))
    assert rmse < 1e-6 and r2 == pytest.approx(1)


def test_counted_rows_give_what_single_rows_give(spark, trips):
    trips = trips.crossJoin(spark.range(3).withColumnRenamed("id", "copy")).where("duration_min > 9 OR copy = 0").cache()
    few = M.counted(trips, [*M.AT_DROPOFF, "fare_eur"]).cache()
    assert few.count() == 4000 and few.agg(F.sum(M.ROWS)).first()[0] == trips.count() > 8000
    for fit in (M.fit_dropoff, M.fit_weighted, lambda t: M.fit_dropoff(t, kind="rf", trees=3)):
        single, grouped = fit(trips), fit(few)
        a, b = single.transform(trips), grouped.transform(few)
        assert M.evaluate(b) == pytest.approx(M.evaluate(a), abs=1e-3)
        assert M.evaluate(grouped.transform(trips)) == pytest.approx(M.evaluate(b), abs=1e-12)
        judged = grouped.transform(trips)
        assert rows(M.confusion(judged)) == rows(M.confusion(b))
        assert rows(M.precision_recall(judged)) == rows(M.precision_recall(b))
        assert rows(M.threshold_report(judged, [0.2, 0.5])) == rows(M.threshold_report(b, [0.2, 0.5]))
        assert M.by_label(judged, "recallByLabel") == pytest.approx(M.by_label(b, "recallByLabel"), abs=1e-12)


def test_scale_and_index_count_rows(trips):
    few = M.counted(trips, ["district_vec", "hour", "duration_min"])
    assert M._index_of(few).labels == M.district_index().fit(trips).labels
    vectors = M.assembled(["hour", "duration_min"]).transform(few)
    spread = M.standardised().fit(M.assembled(["hour", "duration_min"]).transform(trips)).std.toArray()
    assert (1 / M._scale_of(vectors).getScalingVec().toArray()).tolist() == pytest.approx(spread.tolist())


def test_snapped_rows_go_down_the_trees_as_their_own_values(spark):
    table = spark.range(5000).select((F.col("id") * 37 % 997 / 7.0).alias("x"), (F.col("id") % 20).cast("double").alias("y"))
    snapped = M._snapped(table.withColumn("x0", F.col("x")), ["x", "y"])
    assert snapped.select("x").distinct().count() == M.FOREST_BINS and snapped.select("y").distinct().count() == 20
    values = sorted(r["x"] for r in snapped.select("x").distinct().collect())
    halves = [(a + b) / 2.0 for a, b in zip(values, values[1:], strict=False)]
    assert all((r["x0"] <= h) == (r["x"] <= h) for r in snapped.collect() for h in halves)


def test_shares_sum_to_the_rows_and_stay_few(spark):
    table = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 7)], f"k string, {M.ROWS} bigint")
    whole, few = M._shares(table), M._shares(table, draws=50)
    assert whole.count() == 1008 and whole.where("share <> 1").count() == 0
    assert few.count() <= 50 + 3
    assert {r["k"]: r["s"] for r in few.groupBy("k").agg(F.sum("share").alias("s")).collect()} == pytest.approx(
        {"a": 1, "b": 1000, "c": 7})


def test_fits_read_different_rows_only(spark, trips, monkeypatch):
    """However often the rows repeat, logistic regression gets each different row once."""
    seen = []
    fit = M.LogisticRegression.fit
    monkeypatch.setattr(M.LogisticRegression, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    for times in (1, 5):
        M.fit_pickup(trips.crossJoin(spark.range(times).withColumnRenamed("id", "copy")))
    assert seen[0] == seen[1] < 4000
