from __future__ import annotations

import json
import uuid

import pytest
from conftest import rows
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import functions as F

from tripweave.streaming import progress, sinks, sources, transforms as S

# The external names, and trips whose windows and late rows are known.
SCHEMA = "trajet_id STRING, station_depart STRING, fin TIMESTAMP, duree_min DOUBLE, type_usager STRING, electrique INT"
TEN = [
    ("T001", "S001", "08:01", 12.0, "abonne", 0), ("T002", "S002", "08:03", 8.5, "occasionnel", 1),
    ("T003", "S001", "08:04", 15.0, "abonne", 1), ("T004", "S003", "08:06", 6.0, "abonne", 0),
    ("T005", "S002", "08:09", 22.0, "occasionnel", 0), ("T006", "S001", "08:11", 9.0, "abonne", 1),
    ("T007", "S003", "08:13", 11.5, "abonne", 0), ("T008", "S001", "08:16", 7.0, "occasionnel", 1),
    ("T009", "S002", "08:18", 18.0, "abonne", 0), ("T010", "S001", "08:22", 13.0, "occasionnel", 1),
]
THIRD = [("T011", "S003", "08:24", 5.0, "abonne", 0), ("T012", "S003", "08:26", 5.0, "abonne", 0),
         ("T013", "S001", "08:27", 5.0, "abonne", 0)]
LATE = [("R001", "S002", "08:11", 5.0, "abonne", 0), ("R002", "S003", "08:08", 5.0, "abonne", 0)]


def land(folder, name, items):
    """The rows as a file that a reader sees whole: written aside, then moved into the folder."""
    rows_ = [(trip, dock, f"2026-03-02 {at}:00", *rest) for trip, dock, at, *rest in items]
    columns = [field.split()[0] for field in SCHEMA.split(", ")]
    aside = folder.parent / f"{name}.json"
    aside.write_text("".join(json.dumps(dict(zip(columns, row))) + "\n" for row in rows_))
    aside.replace(folder / aside.name)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder, "file1", TEN[:5])
    land(folder, "file2", TEN[5:])
    return folder


@pytest.fixture
def trips(spark, landing):
    return sources.json_stream(spark, str(landing), SCHEMA, max_files=1)


def table_name():
    return f"t_{uuid.uuid4().hex[:8]}"


def in_memory(df, mode):
    name = table_name()
    progress.finish(sinks.to_memory(df, name, mode))
    return df.sparkSession.table(name)


def test_running_counts_and_electric(trips):
    assert progress.is_stream(trips)
    counts = dict(rows(in_memory(S.running_counts(trips, "type_usager"), "complete")))
    assert counts == {"abonne": 6, "occasionnel": 4}
    electric = in_memory(trips.where("electrique = 1").select("trajet_id"), "append")
    assert [r[0] for r in rows(electric)] == ["T002", "T003", "T006", "T008", "T010"]


def test_tumbling_windows(trips):
    windows = S.window_labels(in_memory(S.windowed(trips, "fin", "5 minutes"), "complete"))
    assert [r[::2] for r in rows(windows)] == [("08:00", 3), ("08:05", 2), ("08:10", 2), ("08:15", 2), ("08:20", 1)]


def test_sliding_windows_count_rows_twice(trips):
    windows = in_memory(S.windowed(trips, "fin", "10 minutes", slide="5 minutes"), "complete")
    assert windows.agg(F.sum("n")).first()[0] == 20


def test_new_file_without_restart(trips, landing, spark):
    name = table_name()
    query = sinks.to_memory(S.running_counts(trips, "station_depart"), name, "complete",
                            trigger={"processingTime": "0 seconds"})
    progress.drain(query)
    assert spark.table(name).agg(F.sum("n")).first()[0] == 10
    land(landing, "file3", THIRD)
    progress.drain(query)
    assert dict(rows(spark.table(name))) == {"S001": 6, "S002": 3, "S003": 4}
    assert name in progress.active_names(spark)
    progress.stop_all(spark)
    assert progress.active_names(spark) == []


@pytest.mark.parametrize("delay, mark, dropped, at_0805", [("10 minutes", "08:12", 1, 2), ("15 minutes", "08:07", 0, 3)])
def test_late_rows(spark, trips, landing, tmp_path, delay, mark, dropped, at_0805):
    out = str(tmp_path / "out")
    counts = S.windowed(trips, "fin", "5 minutes", watermark=delay)
    with progress.reports(spark) as seen:
        query = sinks.to_versions(counts, out, str(tmp_path / "checkpoint"), trigger={"processingTime": "0 seconds"})
        progress.drain(query)
        land(landing, "late", LATE)
        progress.drain(query)
        query.stop()
        reports = seen.of(query)
    windows = {r[0]: r[2] for r in rows(S.window_labels(sinks.read_versions(spark, out, "window")))}
    assert progress.current_watermark(query) == f"2026-03-02T{mark}:00.000Z"
    assert sum(r.dropped for r in reports) == dropped
    assert (windows["08:05"], windows["08:10"]) == (at_0805, 3)


def test_guard_rails(spark, trips, landing):
    with pytest.raises(IllegalArgumentException):
        spark.readStream.json(str(landing))
    with pytest.raises(AnalysisException):
        trips.count()
    with pytest.raises(AnalysisException):
        sinks.to_memory(trips, table_name(), "complete")
    with pytest.raises(AnalysisException):
        sinks.to_memory(S.running_counts(trips, "station_depart"), table_name(), "append")


def test_output_modes(spark, trips, tmp_path):
    counts = S.windowed(trips, "fin", "5 minutes", watermark="10 minutes")
    assert in_memory(counts, "complete").count() == 5
    progress.finish(sinks.to_parquet(counts, str(tmp_path / "append"), str(tmp_path / "c")))
    closed = S.window_labels(spark.read.parquet(str(tmp_path / "append")))
    assert [r[0] for r in rows(closed)] == ["08:00", "08:05"]  # ends up to 08:12, the final watermark


def test_resume_reads_each_file_once(spark, landing, tmp_path):
    seen = []
    with progress.reports(spark) as listener:
        for name, items in ((None, []), ("file3", THIRD), ("file4", LATE)):
            if name:
                land(landing, name, items)
            stream = sources.json_stream(spark, str(landing), SCHEMA, max_files=None)
            reports = listener.of(progress.finish(
                sinks.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))))
            seen.append((reports[0].batch, reports[-1].batch))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == written.select("trajet_id").distinct().count() == 15
    assert all(after[0] == before[1] + 1 for before, after in zip(seen, seen[1:]))


def test_reports_of_more_batches_than_a_query_keeps(spark, tmp_path):
    for k in range(105):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k:03d}.json").write_text(f'{{"n": {k}}}\n')
    stream = sources.json_stream(spark, str(tmp_path / "in"), "n INT", max_files=1)
    with progress.reports(spark) as seen:
        query = progress.finish(sinks.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
        reports = seen.of(query)
    assert [r.batch for r in reports] == list(range(105)) and sum(r.rows for r in reports) == 105
    assert len(query.recentProgress) < 105


def test_csv_batches_replace_themselves(spark, trips, tmp_path):
    out = tmp_path / "out"
    for run in range(2):  # a second run from an empty checkpoint repeats the batches
        progress.finish(sinks.to_csv_batches(S.running_counts(trips, "station_depart"), str(out),
                                             str(tmp_path / f"checkpoint{run}")))
    assert sorted(p.name for p in out.iterdir()) == ["batch_id=0", "batch_id=1"]
    written = spark.read.csv(str(out), header=True, inferSchema=True)
    assert written.where("batch_id = 0").agg(F.sum("n")).first()[0] == 5


def test_rate_and_console(spark):
    query = sinks.to_console(sources.rate_stream(spark, 5), "rate_console", trigger={"processingTime": "1 second"})
    try:
        assert progress.wait_for_batches(query, 1, timeout=30) >= 1
    finally:
        query.stop()


def test_several_queries_at_once(spark, trips):
    queries = [sinks.to_memory(S.running_counts(trips, key), table_name(), "complete",
                               trigger={"processingTime": "1 second"}) for key in ("station_depart", "type_usager")]
    for query in queries:
        progress.drain(query)
    assert len(progress.active_names(spark)) == 2
    progress.stop_all(spark)


def test_landing_hides_unfinished_files(spark, tmp_path):
    folder = tmp_path / "land"
    sources.land_json(spark.range(10).repartition(3), str(folder), "wave0")
    sources.land_json(spark.range(5), str(folder), "wave1")
    assert spark.read.json(str(folder)).count() == 15
    assert all(p.name.startswith(("wave", ".wave")) for p in folder.iterdir())


def test_table_stream_reads_a_folder_or_a_file(spark, tmp_path):
    table = spark.range(20).withColumn("ts", F.lit("2026-03-02 08:00:00").cast("timestamp_ntz"))
    table.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    table.write.parquet(str(tmp_path / "other"))
    single = next((tmp_path / "other").glob("part-*"))
    for path in (str(tmp_path / "events.parquet"), str(single)):
        stream = sources.table_stream(spark, path)
        assert dict(stream.dtypes)["ts"] == "timestamp"
        assert in_memory(stream, "append").select("id").distinct().count() > 0
    assert in_memory(sources.table_stream(spark, str(tmp_path / "events.parquet")), "append").count() == 20


def test_enrich_with_a_large_station_table(spark, monkeypatch):
    trips = spark.createDataFrame([("T1", "S1", "2026-03-01 08:00:00"), ("T2", "S9", "2026-03-02 08:00:00")],
                                  "trip_id string, origin string, at string").withColumn(
        "started_at", F.to_timestamp("at"))
    stations = spark.createDataFrame([("S1", "Gare")], "station_id string, district string")
    expected = [("T1", "Gare", 8, 1, True)]
    columns = ["trip_id", "district", "hour", "weekday", "weekend"]
    assert rows(S.enrich(trips, stations).select(columns)) == expected
    monkeypatch.setattr(S, "fits_broadcast", lambda dim: False)
    assert rows(S.enrich(trips, stations).select(columns)) == expected


def test_delays_are_drawn_by_key(spark):
    trips = spark.range(5000).select(
        F.concat(F.lit("T"), "id").alias("trip_id"), F.lit(10.0).alias("duration_min"),
        F.to_timestamp(F.lit("2026-03-02 08:10:00")).alias("ended_at"),
        F.to_timestamp(F.lit("2026-03-02 08:00:00")).alias("started_at"))
    late = sources.delay_some(trips, "trip_id", share=0.3)
    again = sources.delay_some(trips.repartition(5), "trip_id", share=0.3)
    assert rows(late.select("trip_id", "late_by")) == rows(again.select("trip_id", "late_by"))
    found = late.agg(F.avg((F.col("late_by") > 0).cast("int")), F.min(F.when(F.col("late_by") > 0, F.col("late_by"))),
                     F.max("late_by"), F.max(F.abs(F.unix_seconds("ended_at") - F.unix_seconds("started_at") - 600))).first()
    assert 0.25 < found[0] < 0.35 and found[1] >= 120 and found[2] <= 900 and found[3] == 0


def test_rebase_keeps_the_duration(spark):
    trip = spark.createDataFrame([("T1", 7.5)], "trip_id string, duration_min double")
    moved = sources.rebase(trip, F.to_timestamp(F.lit("2026-03-02 08:00:00"))).first()
    assert (moved["ended_at"] - moved["started_at"]).total_seconds() == 450


def test_versions_are_compacted_and_unfinished_folders_are_not_read(spark, tmp_path):
    landing_, out = str(tmp_path / "numbers"), tmp_path / "out"
    spark.range(90).select((F.col("id") % 7).alias("k")).repartition(9).write.json(landing_)
    stream = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).json(landing_)
    progress.finish(sinks.to_versions(stream.groupBy("k").agg(F.count("*").alias("n")), str(out),
                                      str(tmp_path / "checkpoint"), keys=("k",), compact_every=2))
    want = [(k, len(range(k, 90, 7))) for k in range(7)]
    assert sorted(tuple(r) for r in sinks.read_versions(spark, str(out), "k").collect()) == want
    # of nine batches the last compacted folder holds eight; the one before it and what followed it are kept
    assert sorted(p.name for p in out.iterdir()) == ["batch_id=6", "batch_id=7", "batch_id=8", "upto=5", "upto=7"]
    spark.createDataFrame([(0, 999)], "k long, n long").write.parquet(str(out / "batch_id=9"))
    (out / "batch_id=9" / "_SUCCESS").unlink()
    assert sorted(tuple(r) for r in sinks.read_versions(spark, str(out), "k").collect()) == want
    assert sinks.read_versions(spark, str(out)).columns == ["k", "n"]
    with pytest.raises(ValueError, match="no finished batch"):
        sinks.read_versions(spark, str(tmp_path / "nothing"), "k")
