"""Queries that train, apply and judge models on the trips."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.operators import ml as M
from tripweave.operators.relational import count_by
from tripweave.plans.flow import FIVE_ENDED, run_folder, trips as trip_stream, waves
from tripweave.plans.registry import key_hash_ctes, on_tables, query
from tripweave.session import scratch_path, source_tag
from tripweave.sources import contracts as C, files, tables as T
from tripweave.streaming import progress, sinks, sources as stream_sources, transforms as S

LABELLED = ("labelled AS (SELECT clean.*, district, CASE WHEN rider_type = 'occasionnel' THEN 1.0::DOUBLE ELSE 0 END"
            " AS label FROM clean JOIN stations ON origin = station_id)")
RULE = LABELLED + (", ruled AS (SELECT label, duration_min, CASE WHEN duration_min > 31 THEN 1.0::DOUBLE ELSE 0 END"
                   " AS prediction FROM labelled)")


def labelled(spark, sf_dir):
    return M.model_input(T.clean_trips(spark, sf_dir), T.stations(spark, sf_dir))


def split(spark, sf_dir):
    """(train, test) as counted rows, made once in an application: every model is fitted and judged on these."""
    path = scratch_path(spark, source_tag(sf_dir), "model_rows")
    if not files.is_complete(spark, path):
        rows = labelled(spark, sf_dir).withColumn("in_test", scalars.in_test_side(F.col("trip_id")))
        M.counted(rows, [*M.AT_DROPOFF, "fare_eur", "in_test"]).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    return rows.where("NOT in_test"), rows.where("in_test")


def fitted(spark, sf_dir, name, fit):
    """The model of that name, trained at the first use in an application and loaded afterwards."""
    path = scratch_path(spark, source_tag(sf_dir), "models", name)
    return M.load_or_train(spark, path, lambda: split(spark, sf_dir)[0], fit, keep=True)


MODELS = {
    "lr_pickup": lambda train: M.fit_pickup(train),
    "rf_pickup": lambda train: M.fit_pickup(train, kind="rf"),
    "lr_dropoff": lambda train: M.fit_dropoff(train),
    "rf_dropoff": lambda train: M.fit_dropoff(train, kind="rf"),
}


def judged(spark, sf_dir, name):
    test = split(spark, sf_dir)[1]
    return fitted(spark, sf_dir, name, MODELS[name]).transform(
        M.counted(test, M.AT_PICKUP) if name.endswith("pickup") else test)


def by_rule(spark, sf_dir):
    """Predictions of a stated rule (long trips are casual), so that SQL can judge the judges."""
    return labelled(spark, sf_dir).select("label", "duration_min", (F.col("duration_min") > 31).cast("double").alias(
        "prediction"))


@query("ml_label_counts", "L1 I10", on_tables("SELECT rider_type, label, count(*) AS n FROM labelled GROUP BY 1, 2",
                                              LABELLED))
def ml_label_counts(spark, sf_dir):
    return count_by(labelled(spark, sf_dir), "rider_type", "label")


@query("ml_district_index", "L2", on_tables(
    "SELECT district, CAST(row_number() OVER (ORDER BY count(*) DESC, district) - 1 AS DOUBLE) AS idx FROM labelled"
    " GROUP BY 1", LABELLED))
def ml_district_index(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("district")
    return M.district_index().fit(rows).transform(rows).select("district", F.col("district_idx").alias("idx")).distinct()


@query("ml_one_hot", "L3", on_tables(
    "SELECT district, CAST(row_number() OVER (ORDER BY count(*) DESC, district) - 1 AS INT) AS hot,"
    " CAST(count(*) OVER () AS INT) AS size FROM labelled GROUP BY 1", LABELLED))
def ml_one_hot(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("district")
    indexed = M.district_index().fit(rows).transform(rows).distinct()
    encoded = M.district_one_hot().fit(indexed).transform(indexed).withColumn("v", vector_to_array("district_vec"))
    return encoded.select("district", (F.array_position("v", 1.0) - 1).cast("int").alias("hot"),
                          F.size("v").alias("size"))


@query("ml_assembled", "L4", on_tables(
    "SELECT trip_id, hour::DOUBLE AS x0, weekend::INT::DOUBLE AS x1, electric::DOUBLE AS x2, duration_min AS x3"
    " FROM labelled", LABELLED))
def ml_assembled(spark, sf_dir):
    rows = M.assembled(["hour", "weekend", "electric", "duration_min"]).transform(labelled(spark, sf_dir))
    vector = rows.select("trip_id", vector_to_array("assembled").alias("v"))
    return vector.select("trip_id", *[F.col("v")[i].alias(f"x{i}") for i in range(4)])


@query("ml_standardised", "L5", on_tables(
    "SELECT hour, duration_min, round(hour / (SELECT stddev_samp(hour) FROM labelled), 6) AS scaled_hour,"
    " round(duration_min / (SELECT stddev_samp(duration_min) FROM labelled), 6) AS scaled_duration, count(*) AS n"
    " FROM labelled GROUP BY 1, 2", LABELLED))
def ml_standardised(spark, sf_dir):
    rows = M.assembled(["hour", "duration_min"]).transform(
        labelled(spark, sf_dir).select("hour", "duration_min"))
    scaled = M.standardised().fit(rows).transform(rows).withColumn("v", vector_to_array("features"))
    return count_by(scaled.select("hour", "duration_min", F.round(F.col("v")[0], 6).alias("scaled_hour"),
                                  F.round(F.col("v")[1], 6).alias("scaled_duration")),
                    "hour", "duration_min", "scaled_hour", "scaled_duration")


@query("ml_exact_auc", "L10", on_tables(
    "SELECT round(sum(pos * (neg_below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)), 8) AS auc,"
    " round(any_value(accuracy), 8) AS accuracy FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY duration_min"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM (SELECT duration_min,"
    " count(*) FILTER (label = 1)::DOUBLE AS pos, count(*) FILTER (label = 0)::DOUBLE AS neg FROM ruled GROUP BY 1)),"
    " (SELECT avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM ruled)", RULE))
def ml_exact_auc(spark, sf_dir):
    auc, accuracy = M.evaluate(by_rule(spark, sf_dir), score="duration_min")
    return files.local_table(spark, [(round(auc, 8), round(accuracy, 8))], "auc double, accuracy double")


@query("ml_confusion_of_rule", "L11 E4", on_tables(
    "SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1"
    " FROM ruled GROUP BY 1", RULE))
def ml_confusion_of_rule(spark, sf_dir):
    return M.confusion(by_rule(spark, sf_dir))


@query("ml_precision_recall", "L11 L12", on_tables(
    "SELECT round(sum(label * prediction) / sum(prediction), 8) AS precision,"
    " round(sum(label * prediction) / sum(label), 8) AS recall, true AS evaluators_agree FROM ruled", RULE))
def ml_precision_recall(spark, sf_dir):
    ruled = by_rule(spark, sf_dir)
    precision, recall = M.by_label(ruled, "precisionByLabel"), M.by_label(ruled, "recallByLabel")
    agree = (F.abs(F.col("precision") - precision) < 1e-12) & (F.abs(F.col("recall") - recall) < 1e-12)
    return M.precision_recall(ruled).select(F.round("precision", 8).alias("precision"),
                                            F.round("recall", 8).alias("recall"), agree.alias("evaluators_agree"))


@query("ml_class_weights", "L15 E13", on_tables(
    "SELECT rider_type, round(1 - count(*)::DOUBLE / (SELECT count(*) FROM labelled), 8) AS weight, count(*) AS n"
    " FROM labelled GROUP BY 1", LABELLED))
def ml_class_weights(spark, sf_dir):
    weighted = M.with_class_weights(labelled(spark, sf_dir).select("rider_type", "label"))
    return count_by(weighted.withColumn("weight", F.round("weight", 8)), "rider_type", "weight")


def _covariances() -> str:
    names = {"a": "distance_km", "b": "electric", "c": "label", "y": "duration_min"}
    pairs = ["aa", "ab", "ac", "bb", "bc", "cc", "ay", "by", "cy"]
    parts = [f"covar_pop({names[p[0]]}::DOUBLE, {names[p[1]]}::DOUBLE) AS s{p}" for p in pairs]
    return ", ".join(parts + [f"avg({column}) AS m{key}" for key, column in names.items()])


def _determinant(rows: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = rows
    return f"({a}*({e}*{i}-{f}*{h}) - {b}*({d}*{i}-{f}*{g}) + {c}*({d}*{h}-{e}*{g}))"


def _regression_sql() -> str:
    """Ordinary least squares with three regressors by Cramer's rule on the covariances."""
    matrix = [["saa", "sab", "sac"], ["sab", "sbb", "sbc"], ["sac", "sbc", "scc"]]
    right = ["say", "sby", "scy"]

    def replaced(column: int) -> list[list[str]]:
        return [[right[r] if c == column else matrix[r][c] for c in range(3)] for r in range(3)]

    slopes = ", ".join(f"{_determinant(replaced(i))} / {_determinant(matrix)} AS b{i}" for i in range(3))
    return (f"{LABELLED}, moments AS (SELECT {_covariances()} FROM labelled), slopes AS (SELECT *, {slopes} FROM moments),"
            " line AS (SELECT b0, b1, b2, my - b0 * ma - b1 * mb - b2 * mc AS b3, my FROM slopes)")


@query("ml_duration_regression", "L17", on_tables(
    "SELECT round(any_value(b0), 6) AS per_km, round(any_value(b1), 6) AS if_electric, round(any_value(b2), 6) AS"
    " if_casual, round(any_value(b3), 6) AS intercept,"
    " round(sqrt(avg(pow(duration_min - (b0 * distance_km + b1 * electric + b2 * label + b3), 2))), 6) AS rmse,"
    " round(1 - sum(pow(duration_min - (b0 * distance_km + b1 * electric + b2 * label + b3), 2))"
    " / sum(pow(duration_min - my, 2)), 6) AS r2 FROM labelled, line", _regression_sql()))
def ml_duration_regression(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("distance_km", "electric", "label", "duration_min")
    model = M.fit_duration(rows)
    line = model.stages[-1]
    values = [*line.coefficients.toArray().tolist(), line.intercept, *M.regression_scores(model.transform(rows))]
    return files.local_table(spark, [tuple(round(v, 6) for v in values)],
                             "per_km double, if_electric double, if_casual double, intercept double, rmse double, r2 double")


@query("ml_model_scores", "L7 L8 L9 L10")
def ml_model_scores(spark, sf_dir):
    scores = [(name, *M.evaluate(judged(spark, sf_dir, name))) for name in MODELS]
    return files.local_table(spark, scores, "model string, auc double, accuracy double")


@query("ml_bare_logistic", "L6")
def ml_bare_logistic(spark, sf_dir):
    train, test = split(spark, sf_dir)
    columns = ["hour", "electric", "duration_min"]
    auc, accuracy = M.evaluate(M.fit_numeric(train, columns).transform(test))
    return files.local_table(spark, [(auc, accuracy)], "auc double, accuracy double")


@query("ml_confusion", "L11 L7")
def ml_confusion(spark, sf_dir):
    return M.confusion(judged(spark, sf_dir, "lr_dropoff"))


@query("ml_importances", "L8")
def ml_importances(spark, sf_dir):
    predictions = judged(spark, sf_dir, "rf_dropoff")
    model = fitted(spark, sf_dir, "rf_dropoff", MODELS["rf_dropoff"])
    return files.local_table(spark, M.importances(model, predictions), "feature string, importance double")


@query("ml_reloaded", "L13", on_tables("SELECT count(*) AS predictions, 0::BIGINT AS changed FROM labelled", LABELLED))
def ml_reloaded(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    model = fitted(spark, sf_dir, "lr_dropoff", MODELS["lr_dropoff"])
    path = scratch_path(spark, source_tag(sf_dir), "models", "copy")
    M.save(model, path)
    again = M.load_or_train(spark, path, lambda: rows)
    # both models score each row side by side: no join is needed to compare them
    once = model.transform(rows).select(*rows.columns, F.col("prediction").alias("before"))
    twice = again.transform(once)
    return twice.agg(F.count("*").alias("predictions"),
                     F.count_if(F.col("before") != F.col("prediction")).alias("changed"))


@query("ml_leak_probe", "L14")
def ml_leak_probe(spark, sf_dir):
    train, test = split(spark, sf_dir)
    honest = M.area_under_roc(judged(spark, sf_dir, "lr_pickup"))
    leaking = M.area_under_roc(M.fit_pickup(train, extra=["fare_eur"]).transform(
        M.counted(test, [*M.AT_PICKUP, "fare_eur"])))
    return files.local_table(spark, [("pickup", honest), ("pickup with fare", leaking)], "features string, auc double")


@query("ml_weighted", "L15 L12")
def ml_weighted(spark, sf_dir):
    train, test = split(spark, sf_dir)
    sides = {"plain": judged(spark, sf_dir, "lr_pickup"),
             "weighted": M.fit_weighted(train).transform(M.counted(test, M.AT_PICKUP))}
    rows = [(name, M.by_label(p, "recallByLabel"), M.by_label(p, "precisionByLabel"), M.area_under_roc(p))
            for name, p in sides.items()]
    return files.local_table(spark, rows, "model string, recall double, precision double, auc double")


THRESHOLDS = [0.3, 0.367, 0.5]


@query("ml_threshold", "L16", on_tables(
    "SELECT threshold, sum(hit)::DOUBLE / sum(label) AS recall, sum(hit)::DOUBLE / nullif(sum(said), 0) AS precision FROM"
    " (SELECT threshold, label, CASE WHEN duration_min / 124 > threshold THEN 1 ELSE 0 END AS said,"
    " CASE WHEN duration_min / 124 > threshold AND label = 1 THEN 1 ELSE 0 END AS hit FROM labelled,"
    f" (SELECT unnest({THRESHOLDS}::DOUBLE[]) AS threshold)) GROUP BY 1", LABELLED))
def ml_threshold(spark, sf_dir):
    # a stated probability, so that SQL can read it at the same thresholds; ml_threshold_of_model has a fitted one
    chance = F.col("duration_min") / 124
    stated = labelled(spark, sf_dir).select("label", array_to_vector(F.array(1 - chance, chance)).alias("probability"))
    return M.threshold_report(stated, THRESHOLDS)


@query("ml_threshold_of_model", "L16")
def ml_threshold_of_model(spark, sf_dir):
    return M.threshold_report(judged(spark, sf_dir, "lr_dropoff"), THRESHOLDS)


@query("ml_logistic_closed_form", "L6", on_tables(
    "SELECT round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 3) AS slope, round(ln(p0 / (1 - p0)), 3) AS intercept FROM"
    " (SELECT avg(label) FILTER (duration_min > 31) AS p1, avg(label) FILTER (duration_min <= 31) AS p0 FROM labelled)",
    LABELLED))
def ml_logistic_closed_form(spark, sf_dir):
    """On one binary feature the fitted line is known: the log odds of both groups."""
    rows = labelled(spark, sf_dir).select("label", (F.col("duration_min") > 31).cast("double").alias("long"))
    line = M.fit_numeric(rows, ["long"]).stages[-1]
    return files.local_table(spark, [(round(float(line.coefficients[0]), 3), round(float(line.intercept), 3))],
                             "slope double, intercept double")


@query("ml_model_checks", "L7 L8 L9 L11 L14 L15", on_tables(
    "SELECT count(*) AS tested, count(*) AS in_confusion, true AS leak_shows, true AS weights_raise_recall,"
    " true AS importances_sum_to_one, true AS scores_in_range FROM sides WHERE in_test",
    key_hash_ctes("clean", "trip_id", "hashed") + ", sides AS (SELECT *, (key_hash % 5 + 5) % 5 = 0 AS in_test FROM hashed)"))
def ml_model_checks(spark, sf_dir):
    """What must hold of the fitted models whatever they learn."""
    train, test = split(spark, sf_dir)
    table = M.confusion(judged(spark, sf_dir, "lr_dropoff")).collect()
    honest = M.area_under_roc(judged(spark, sf_dir, "lr_pickup"))
    leaking = M.area_under_roc(M.fit_pickup(train, extra=["fare_eur"]).transform(
        M.counted(test, [*M.AT_PICKUP, "fare_eur"])))
    plain = M.by_label(judged(spark, sf_dir, "lr_pickup"), "recallByLabel")
    weighted = M.by_label(M.fit_weighted(train).transform(M.counted(test, M.AT_PICKUP)), "recallByLabel")
    forest = fitted(spark, sf_dir, "rf_dropoff", MODELS["rf_dropoff"]).stages[-1]
    scores = [M.evaluate(judged(spark, sf_dir, name)) for name in MODELS]
    return files.local_table(spark, [(
        test.agg(F.sum(M.ROWS)).first()[0], sum(r["predicted_0"] + r["predicted_1"] for r in table),
        leaking > honest, weighted >= plain,
        abs(float(forest.featureImportances.toArray().sum()) - 1) < 1e-9,
        all(0 <= x <= 1 for pair in scores for x in pair))],
        "tested bigint, in_confusion bigint, leak_shows boolean, weights_raise_recall boolean,"
        " importances_sum_to_one boolean, scores_in_range boolean")


@query("stream_scored", "J17 L18", on_tables(
    f"SELECT {FIVE_ENDED} AS window_start, count(*) AS trips,"
    " round(avg(CASE WHEN rider_type = 'occasionnel' THEN 1.0::DOUBLE ELSE 0 END), 6) AS actual_share,"
    " true AS share_in_range FROM clean JOIN stations ON origin = station_id GROUP BY 1"))
def stream_scored(spark, sf_dir):
    # no model of this name is saved, so the pipeline is trained now, on a fifth of the history
    path = scratch_path(spark, source_tag(sf_dir), "models", "fallback")
    model = M.load_or_train(spark, path, lambda: labelled(spark, sf_dir), sample=0.2)
    enriched = S.enrich(trip_stream(spark, sf_dir), T.stations(spark, sf_dir))
    shares = S.predicted_share(model.transform(enriched), digits=6)
    folder = run_folder(spark)
    progress.finish(sinks.to_versions(shares, f"{folder}/out", f"{folder}/checkpoint"))
    found = S.window_bounds(sinks.read_versions(spark, f"{folder}/out", "window"))
    return found.select("window_start", "trips", "actual_share",
                        F.col("predicted_share").between(0, 1).alias("share_in_range"))


@query("stream_predictions_resumed", "L13 B6 J15", on_tables(
    "SELECT count(*) AS row_count, count(DISTINCT trip_id) AS trips, true AS all_scored, true AS batches_follow"
    " FROM clean JOIN stations ON origin = station_id"))
def stream_predictions_resumed(spark, sf_dir):
    """A saved model scores trips as they come; its query is stopped twice and goes on from its checkpoint."""
    model = fitted(spark, sf_dir, "lr_dropoff", MODELS["lr_dropoff"])
    folder, ids = run_folder(spark), []
    external = T.clean_trips(spark, sf_dir).select(T.TRIP_COLUMNS).withColumnsRenamed(
        C.rename_map(C.TRIP_FIELDS, to_external=True))
    with progress.reports(spark) as seen:
        for _ in waves(external, spark, folder, "hour(debut) < 8", "hour(debut) BETWEEN 8 AND 15", "hour(debut) > 15"):
            stream = S.enrich(stream_sources.trip_stream(spark, f"{folder}/landing"), T.stations(spark, sf_dir))
            scored = model.transform(stream).select("trip_id", "ended_at", "rider_type", "prediction")
            reports = seen.of(progress.finish(sinks.to_parquet(scored, f"{folder}/out", f"{folder}/checkpoint")))
            ids.append((reports[0].batch, reports[-1].batch))
    follow = all(later[0] == earlier[1] + 1 for earlier, later in zip(ids, ids[1:], strict=False))
    return spark.read.parquet(f"{folder}/out").agg(
        F.count("*").alias("row_count"), F.count_distinct("trip_id").alias("trips"),
        (F.count_if(F.col("prediction").isin(0.0, 1.0)) == F.count("*")).alias("all_scored"),
        F.lit(follow).alias("batches_follow"))
