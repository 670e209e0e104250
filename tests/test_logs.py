from __future__ import annotations

import re
from functools import partial

from conftest import plan_of, rows
from pyspark.sql import functions as F

from tripweave.functions import logs as L, scalars
from tripweave.operators import logs as O, rdd as P
from tripweave.sources import contracts as C

# Lines of the log contract.
VALID = [
    "2026-01-01T06:03:49 S027 RETRAIT velo=V0696 badge=A-37535",
    "2026-01-01T06:10:59 S030 RETRAIT velo=V0169 badge=A-71688 batterie=47",
    "2026-01-01T06:08:49 S050 DEPOT velo=V0696 duree=5.0",
    '2026-01-01T08:42:28 S012 ERREUR code=E27 message="lecteur de badge muet"',
    "2026-01-01T09:00:00 S012 RETRAIT velo=V1 velo=V2 badge=A-1 batterie=x",
    "2026-01-01T09:00:01 S012 RETRAIT velo=V3 badge=A-1 é1=oui",
]
INVALID = {
    "2026-01-01T06:03:49 S027 RETRAIT": "fewer than four parts",
    "2026-01-01T06:03 S027 RETRAIT velo=V1 badge=A-1": "timestamp",
    "2026-01-01T06:03:49 X027 RETRAIT velo=V1 badge=A-1": "station",
    "2026-01-01T06:03:49 S0271 RETRAIT velo=V1 badge=A-1": "station",
    "2026-01-01T06:03:49 S027 VOL velo=V1 badge=A-1": "kind",
    "2026-01-01T06:03:49 S027 RETRAIT velo=V1 badg": "missing field",
    "2026-01-01T06:03:49 S027 DEPOT xvelo=V1 duree=5": "missing field",
    '2026-01-01T08:42:28 S012 ERREUR code=E27 note="message=cache"': "missing field",
    '2026-01-01T08:42:28 S012 ERREUR code=E27 message="lecteur de': "unbalanced quotes",
    "": "fewer than four parts",
}


def lines(spark):
    return spark.createDataFrame([(line,) for line in [*VALID, *INVALID]], "value string")


def test_each_way_to_be_invalid(spark):
    rejected = {r["value"]: r["reason"] for r in L.rejected_lines(L.parse_lines(lines(spark))).collect()}
    assert rejected == INVALID


def test_fields(spark):
    events = {r["ts"]: r for r in L.valid_events(L.parse_lines(lines(spark))).collect()}
    assert len(events) == len(VALID)
    assert events["2026-01-01T08:42:28"]["fields"] == {"code": "E27", "message": "lecteur de badge muet"}
    assert events["2026-01-01T09:00:00"]["fields"] == {"velo": "V2", "badge": "A-1", "batterie": "x"}
    assert events["2026-01-01T09:00:01"]["fields"]["é1"] == "oui"


def test_pair_collection_parser_agrees(spark):
    native = {(r["ts"], r["station"], r["kind"]): r["fields"]
              for r in L.valid_events(L.parse_lines(lines(spark))).collect()}
    rules = P.LogRules(C.LOG_STATION)
    own = {line: rules.examine(line) for line in [*VALID, *INVALID]}
    assert {e[:3]: e[3] for _, e in own.values() if e} == native
    reasons = {r["value"]: r["reason"] for r in L.parse_lines(lines(spark)).collect()}
    assert {line: reason for line, (reason, _) in own.items()} == reasons


def test_reject_counts(spark):
    counted = O.reject_report(L.parse_lines(lines(spark))).first()
    assert tuple(counted) == (len(VALID) + len(INVALID), len(VALID), len(INVALID))


def test_loose_rule(spark):
    loose = L.loose_parts(lines(spark))
    assert rows(loose.where("NOT kept").select("value")) == [("",)]
    spaced = spark.createDataFrame([("  a \t b c  ",), ("a b",)], "value string")
    assert [r["kept"] for r in L.loose_parts(spaced).collect()] == [True, False]
    assert [r["parts"] for r in L.loose_parts(spaced).collect()][0] == "  a \t b c  ".split()


def test_int_field_tolerates_text(spark):
    events = L.valid_events(L.parse_lines(lines(spark)))
    battery = O.pickup_battery(events).first()
    assert (battery["pickups"], battery["mean_battery"]) == (1, 47.0)


def test_accumulator_counts_again_without_cache(spark):
    text = spark.sparkContext.parallelize([*VALID, *INVALID], 2)
    rejected = spark.sparkContext.accumulator(0)
    events = P.parse_events(text, rejected=rejected)
    assert (events.count(), events.count()) == (len(VALID),) * 2
    assert rejected.value == 2 * len(INVALID)
    once = spark.sparkContext.accumulator(0)
    kept = P.parse_events(text, rejected=once).cache()
    kept.count(), kept.count()
    assert once.value == len(INVALID)
    kept.unpersist()


def moves(spark, *items):
    return spark.createDataFrame(
        [(f"2026-01-{ts}", "S001", kind, {"velo": velo}) for velo, kind, ts in items],
        "ts string, station string, kind string, fields map<string,string>")


def test_sequence_checks(spark):
    events = moves(
        spark, ("V1", C.PICKUP, "01T08:00:00"), ("V1", C.DEPOSIT, "01T08:10:00"), ("V1", C.DEPOSIT, "02T09:00:00"),
        ("V2", C.DEPOSIT, "01T07:00:00"), ("V2", C.PICKUP, "03T08:00:00"), ("V2", C.DEPOSIT, "03T08:00:00"),
        ("V2", C.DEPOSIT, "04T08:30:00"), ("V3", C.DEPOSIT, "01T07:00:00"), ("V3", C.DEPOSIT, "01T07:00:00"),
        ("V4", C.PICKUP, "01T07:00:00"))
    assert rows(O.deposits_without_pickup(events)) == [("V1", 2, 0), ("V2", 3, 2), ("V3", 2, 2)]
    assert rows(O.deposits_out_of_turn(events)) == [("V1", 2, 1), ("V2", 3, 2), ("V3", 2, 2), ("V4", 0, 0)]


def test_sequence_checks_shuffle_the_events_once_or_not_at_all(spark):
    events = moves(spark, *[(f"V{i % 7}", C.PICKUP if i % 3 else C.DEPOSIT, f"{1 + i % 5:02d}T08:{i % 60:02d}:00")
                            for i in range(300)])
    spread = O.deposits_without_pickup(events)
    assert "Window" not in plan_of(spread)
    plan = plan_of(O.deposits_out_of_turn(events)).split("== Physical Plan ==")[1]
    assert plan.count("Scan") == 1 and "Join" not in plan


def test_first_pickup_of_vehicles_with_most_deposits(spark, monkeypatch):
    events = moves(spark, *[("V1", C.DEPOSIT, f"01T08:00:{i % 60:02d}") for i in range(200)],
                   ("V1", C.PICKUP, "01T08:00:30"), ("V2", C.DEPOSIT, "01T07:00:00"), ("V2", C.DEPOSIT, "01T09:00:00"),
                   ("V2", C.PICKUP, "01T08:00:00"))
    expected = [("V1", 200, sum(i % 60 <= 30 for i in range(200))), ("V2", 2, 1)]
    assert rows(O.deposits_without_pickup(events)) == expected
    monkeypatch.setattr(O, "lookup_join", partial(O.lookup_join, small=False))
    assert rows(O.deposits_without_pickup(events)) == expected


PHRASES = ["le vélo part de la gare", "le vélo arrive à la gare", "la borne de la gare est en panne"]


def test_word_count(spark):
    table = spark.createDataFrame([(p,) for p in PHRASES], "text string")
    counted = dict(rows(scalars.words(table, "text").groupBy("word").count()))
    assert (sum(counted.values()), len(counted), counted["gare"], counted["la"]) == (20, 12, 3, 4)
    pairs = P.count_by_key(spark.sparkContext.parallelize(PHRASES).flatMap(str.split))
    assert dict(pairs.collect()) == counted
    assert P.top_counts(pairs, 2) == [("la", 4), ("gare", 3)]
    assert P.sorted_counts(pairs).take(2) == [("la", 4), ("gare", 3)]


def test_numbers_and_slices(spark):
    numbers = P.local_collection(spark, range(1, 11), 3)
    squares = numbers.map(lambda x: x * x)
    assert squares.reduce(lambda a, b: a + b) == 385
    assert squares.filter(lambda x: x % 2 == 0).sum() == 220
    assert P.partition_contents(numbers) == [[1, 2, 3], [4, 5, 6], [7, 8, 9, 10]]
    assert P.partition_sizes(numbers).collect() == [(0, 3), (1, 3), (2, 4)]
    assert P.mean(numbers) == 5.5 and P.mean(numbers.filter(lambda x: x > 99)) is None
    assert dict(P.mean_by_key(numbers.map(lambda x: (x % 2, x))).collect()) == {0: 6.0, 1: 5.0}


def test_names_by_broadcast_and_join(spark):
    counts = spark.sparkContext.parallelize([("a", 2), ("b", 1), ("z", 9)])
    names = spark.sparkContext.parallelize([("a", "A"), ("b", "B")])
    expected = [("a", "A", 2), ("b", "B", 1)]
    assert sorted(P.broadcast_names(counts, names).collect()) == expected
    assert sorted(P.broadcast_names(counts, names, max_rows=1).collect()) == expected
    assert sorted(P.joined_names(counts, names).collect()) == expected


def test_save_lines_refuses_to_overwrite(spark, tmp_path):
    lines_out = spark.sparkContext.parallelize(["x;1"], 1)
    P.save_lines(lines_out, str(tmp_path / "out"))
    assert (tmp_path / "out" / "part-00000").read_text() == "x;1\n"
    try:
        P.save_lines(lines_out, str(tmp_path / "out"))
        raise AssertionError("overwrote")
    except Exception as error:  # the JVM names the reason
        assert "already exists" in str(error)


def test_rendered_lines_parse_back(spark):
    trips = spark.createDataFrame(
        [("V1", "S001", "S002", "2026-01-01 08:00:00", "2026-01-01 08:05:00", 5.0)],
        "vehicle_id string, origin string, destination string, s string, e string, duration_min double").selectExpr(
        "*", "CAST(s AS TIMESTAMP_NTZ) AS started_at", "CAST(e AS TIMESTAMP_NTZ) AS ended_at")
    error = F.struct(F.lit("E12").alias("code"), F.lit("verrou bloqué").alias("message"))
    rendered = L.trip_lines(trips, badge=F.lit("A-1"), battery=F.lit(None).cast("int"), error=error,
                            cut_pickup=F.lit(None).cast("int"), cut_deposit=F.lit(21))
    assert [r["value"] for r in rendered.orderBy("at", F.desc("value")).collect()] == [
        "2026-01-01T08:00:00 S001 RETRAIT velo=V1 badge=A-1",
        '2026-01-01T08:00:00 S001 ERREUR code=E12 message="verrou bloqué"',
        "2026-01-01T08:05:00 S",
    ]
