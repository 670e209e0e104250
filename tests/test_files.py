from __future__ import annotations

from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tripweave.session import scratch_path, shared_dir, split_size
from tripweave.sources import contracts as C
from tripweave.sources import files, sinks, tables as T

THREE = "id,duree_min\n1,12.5\n2,N/A\n3,7.0\n"


@pytest.fixture
def three(tmp_path):
    path = tmp_path / "three.csv"
    path.write_text(THREE)
    return str(path)


def read(spark, path, mode):
    return files.read_csv(spark, path, schema="id INT, duree_min DOUBLE", header=True, mode=mode)


def test_permissive_keeps_the_row_with_null(spark, three):
    assert rows(read(spark, three, "PERMISSIVE")) == [(1, 12.5), (2, None), (3, 7.0)]


def test_dropmalformed_drops_it(spark, three):
    assert rows(read(spark, three, "DROPMALFORMED")) == [(1, 12.5), (3, 7.0)]


def test_failfast_raises(spark, three):
    with pytest.raises(Exception, match="MALFORMED"):
        read(spark, three, "FAILFAST").collect()


def test_schema_modes(spark, three):
    assert files.read_csv(spark, three).columns == ["_c0", "_c1"]
    assert files.read_csv(spark, three).count() == 4
    assert files.read_csv(spark, three, header=True).dtypes == [("id", "string"), ("duree_min", "string")]
    assert files.read_csv(spark, three, header=True, infer=True).dtypes[0] == ("id", "int")


def test_empty_cell_is_null(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text('a,b\nx,\ny,""\n')
    assert rows(files.read_csv(spark, str(path), header=True)) == [("x", None), ("y", None)]


def test_declared_and_ddl_reads_agree(spark, sf_dir):
    path = T.staged(spark, sf_dir, "trips_csv")
    declared, typed = files.read_trips_csv(spark, path), files.read_trips_ddl(spark, path)
    assert declared.dtypes == typed.dtypes
    assert declared.exceptAll(typed).isEmpty()


def test_bad_timestamp_becomes_null(spark, tmp_path):
    header = ",".join(outer for outer, _, _ in C.TRIP_FIELDS)
    path = tmp_path / "trips.csv"
    path.write_text(f"{header}\nT1,V1,S001,S002,never,2026-01-01 08:00:00,5.0,1.0,abonne,0,0.0\n")
    row = files.read_trips_csv(spark, str(path)).first()
    assert row["started_at"] is None and row["ended_at"].hour == 8


def test_clean_round_trip_uses_contract_names(spark, sf_dir, tmp_path):
    path, clean = str(tmp_path / "clean"), T.clean_trips(spark, sf_dir)
    sinks.write_clean(clean, path)
    assert {"trajet_id", "heure", "jour_semaine", "week_end"} <= set(spark.read.parquet(path).columns)
    assert files.read_clean_parquet(spark, path).exceptAll(clean).isEmpty()


def test_file_ceiling_only_reduces(spark, tmp_path):
    for partitions, expected in ((9, 4), (2, 2)):
        path = tmp_path / f"p{partitions}"
        sinks.write_bounded(spark.range(90).repartition(partitions), str(path), max_files=4)
        assert len(list(path.glob("*.parquet"))) == expected


def test_file_ceiling_moves_no_rows_between_tasks(spark, tmp_path):
    """Writing tasks read a columnar copy and no shuffle; every row arrives and the copy goes."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(0, 20_000, 1, 9).select("id", F.format_string("T%08d", "id").alias("name")).write.parquet(source)
    stages = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ceiling", "ceiling")
    try:
        sinks.write_bounded(spark.read.parquet(source).where("id != 7"), target, max_files=3)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    copied, listed, *_, last = sorted(stages.getJobIdsForGroup("ceiling"))
    assert all(len(stages.getJobInfo(job).stageIds) == 1 for job in (copied, last))
    written = spark.read.parquet(target)
    assert len(written.inputFiles()) == 3
    assert written.exceptAll(spark.read.parquet(source).where("id != 7")).isEmpty() and written.count() == 19_999
    assert not list(Path(scratch_path(spark, "bounded").removeprefix("file:")).iterdir())


def test_month_filter_prunes_folders(spark, sf_dir):
    stored = spark.read.parquet(T.staged(spark, sf_dir, "months"))
    plan = plan_of(stored.where(F.col("month") == "1997-03").select("trip_id"))
    assert "PartitionFilters: [isnotnull(month" in plan and "ReadSchema: struct<trip_id:string>" in plan


def test_single_text(spark, tmp_path):
    sinks.write_single_text(spark.range(11), str(tmp_path / "big"), rows_per_file=10)
    assert sum(len(p.read_text().split()) for p in (tmp_path / "big").glob("part-*")) == 11
    target = tmp_path / "small"
    for _ in range(2):  # the target is replaced
        sinks.write_single_text(spark.createDataFrame([("S001", "Gare", 3)], "id string, name string, n int"),
                                str(target))
    assert [p.read_text() for p in target.glob("part-*")] == ["S001;Gare;3\n"]


def test_single_text_refuses_large_tables(spark, tmp_path):
    sinks.write_single_text(spark.range(10), str(tmp_path / "fits"), max_rows=10)
    with pytest.raises(ValueError, match="write_ordered_lines"):
        sinks.write_single_text(spark.range(11), str(tmp_path / "large"), max_rows=10)
    assert not (tmp_path / "large").exists()


def test_load_or_rebuild(spark, tmp_path):
    path = str(tmp_path / "out")
    assert files.load_or_rebuild(spark, path, lambda: spark.range(3)).count() == 3
    spark.range(5).write.parquet(path)
    assert files.load_or_rebuild(spark, path, lambda: spark.range(3)).count() == 5
    (tmp_path / "out" / "_SUCCESS").unlink()
    assert files.load_or_rebuild(spark, path, lambda: spark.range(3)).count() == 3


def test_storage_report(spark, sf_dir):
    report = {r["label"]: r for r in sinks.storage_report(
        spark, csv=T.staged(spark, sf_dir, "trips_csv"), parquet=T.staged(spark, sf_dir, "clean")).collect()}
    assert report["csv"]["megabytes"] > report["parquet"]["megabytes"] > 0


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a", "b").startswith(configured)


def test_range_smoke(spark):
    assert spark.range(1_000_000).agg(F.sum("id")).first()[0] == 499_999_500_000
    assert spark.range(1, 101).agg(F.sum(F.col("id") * F.col("id"))).first()[0] == 338_350


def test_staged_log_is_compressed_and_in_order_without_a_shuffle(spark, sf_dir):
    stages = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("staged-log", "staged log")
    try:
        path = T.staged(spark, sf_dir + "/.", "log")  # a name of its own, so it is written here
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    jobs = stages.getJobIdsForGroup("staged-log")
    assert jobs and all(len(stages.getJobInfo(job).stageIds) == 1 for job in jobs)
    found = files.read_lines(spark, path).select(F.input_file_name().alias("file"), "value").collect()
    assert found and all(r["file"].endswith(".txt.gz") for r in found)
    by_file = {}
    for r in found:
        by_file.setdefault(r["file"], []).append(r["value"][:19])
    whole = [[ts for ts in times if len(ts) == 19] for times in by_file.values()]
    assert all(times == sorted(times) for times in whole)
    assert len(found) == T.log_lines(spark, sf_dir).count()


def test_ordered_lines_keep_one_order_over_all_files(spark, tmp_path):
    lines = spark.range(100).select((99 - F.col("id")).alias("at"), F.format_string("%03d", 99 - F.col("id")).alias("value"))
    sinks.write_ordered_lines(lines.repartition(5), str(tmp_path / "log"), by="at")
    written = [line for p in sorted((tmp_path / "log").glob("part-*")) for line in p.read_text().split()]
    assert written == [f"{i:03d}" for i in range(100)]


def test_staged_json_is_compressed_and_needs_no_cleaned_copy(spark, sf_dir):
    folder = sf_dir + "/./."
    path = T.staged(spark, folder, "clean_json")
    assert not files.path_exists(spark, path.replace("clean_json", "clean"))
    stored = spark.read.schema(C.ddl(C.TRIP_FIELDS)).option("timestampFormat", C.TIMESTAMP_FORMAT).json(path)
    assert all(f.endswith(".json.gz") for f in stored.inputFiles())
    assert stored.count() == T.clean_trips(spark, sf_dir).count()


def test_split_size_only_lowers(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with split_size(spark, 1 << 20):
        assert spark.conf.get(name) == str(1 << 20)
        with split_size(spark, 1 << 30):
            assert spark.conf.get(name) == str(1 << 20)
    assert spark.conf.get(name) == before
