"""Queries on the trip network: docks as nodes, busy origin-destination pairs as edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.operators import graph as G
from tripweave.operators.skew import lookup_join
from tripweave.plans.registry import on_tables, query
from tripweave.sources import files, tables as T

BUSY = 2.0  # an edge is regular from twice the mean number of trips per edge
TURNS = 20
CONVERGED = 200  # turns of a reference run
THRESHOLDS = [1.8, 2.0, 2.2]  # times the mean number of trips per edge
START, GOAL = "S000", "S007"
LANDMARKS = ["S001", "S005"]

EDGES = ("edges AS MATERIALIZED (SELECT origin AS src, destination AS dst, count(*) AS trips,"
         " round(avg(distance_km), 2) AS distance_km FROM clean WHERE origin <> destination GROUP BY 1, 2)")
LINKS = EDGES + (f", links AS MATERIALIZED (SELECT * FROM edges WHERE trips >= {BUSY}::DOUBLE *"
                 " (SELECT avg(trips) FROM edges))")


def nodes(spark, sf_dir):
    return G.build_nodes(T.stations(spark, sf_dir))


def edges(spark, sf_dir):
    return G.build_edges(T.clean_trips(spark, sf_dir))


def links(spark, sf_dir, busy=BUSY):
    every = G.cut_lineage(edges(spark, sf_dir))
    return G.regular_edges(every, busy * G.mean_trips(every))


def pagerank_sql(turns: int, spread: bool, name: str) -> str:
    """The ranks after each turn as a chain of subqueries, `name`_0 to `name`_<turns>."""
    steps = [f"{name}_0 AS MATERIALIZED (SELECT station_id AS id, 1.0::DOUBLE / (SELECT count(*) FROM stations) AS rank"
             " FROM stations)"]
    for turn in range(1, turns + 1):
        before = f"{name}_{turn - 1}"
        lost = (f"(SELECT coalesce(sum(rank), 0) FROM {before} WHERE id NOT IN (SELECT src FROM out_degree))"
                if spread else "0.0::DOUBLE")
        steps.append(
            f"{name}_{turn} AS MATERIALIZED (SELECT s.station_id AS id, (0.15::DOUBLE + 0.85::DOUBLE * {lost})"
            f" / (SELECT count(*) FROM stations) + 0.85::DOUBLE * coalesce(r.received, 0) AS rank FROM stations s"
            f" LEFT JOIN (SELECT dst, sum(rank / degree) AS received FROM links JOIN {before} ON src = id"
            f" JOIN out_degree USING (src) GROUP BY dst) r ON r.dst = s.station_id)")
    return ", ".join(steps)


OUT_DEGREE = LINKS + ", out_degree AS MATERIALIZED (SELECT src, count(*) AS degree FROM links GROUP BY src)"
RANKS = OUT_DEGREE + ", " + pagerank_sql(TURNS, False, "r")
RANKS_SPREAD = OUT_DEGREE + ", " + pagerank_sql(TURNS, True, "p")


def hops_sql(start: str) -> str:
    """Hops to every node in reach, the smallest node before it, and the paths these spell."""
    return (f"{LINKS}, RECURSIVE hop(id, n) USING KEY (id) AS (SELECT '{start}', 0 UNION SELECT dst, min(h.n) + 1"
            " FROM hop h JOIN links ON src = h.id LEFT JOIN recurring.hop r ON r.id = dst WHERE r.id IS NULL GROUP BY dst),"
            " via AS (SELECT dst AS id, min(src) AS via FROM links JOIN hop a ON a.id = src JOIN hop b ON b.id = dst"
            f" WHERE b.n = a.n + 1 GROUP BY dst), {_way_sql('hop')}")


def _way_sql(nodes: str) -> str:
    """way(id, path): the nodes before, followed back to the start."""
    return (f"RECURSIVE back(id, spot, path) AS (SELECT id, id, [id] FROM {nodes} UNION ALL"
            " SELECT back.id, via, list_prepend(via, path) FROM back JOIN via ON via.id = spot),"
            " way AS (SELECT id, path FROM back WHERE spot NOT IN (SELECT id FROM via))")


def cheapest_sql(start: str) -> str:
    """Relaxation until no cost falls, and the paths of the least costs."""
    return (f"{LINKS}, RECURSIVE best(id, cost) USING KEY (id) AS (SELECT '{start}', 0.0::DOUBLE UNION"
            " SELECT dst, min(b.cost + distance_km) FROM best b JOIN links ON src = b.id LEFT JOIN recurring.best r"
            " ON r.id = dst GROUP BY dst, r.cost HAVING r.cost IS NULL OR min(b.cost + distance_km) < r.cost),"
            " via AS (SELECT dst AS id, min(src) AS via FROM links JOIN best a ON a.id = src JOIN best b ON b.id = dst"
            f" WHERE b.cost = a.cost + distance_km AND dst <> '{start}' GROUP BY dst), {_way_sql('best')}")


WEAK = (LINKS + ", RECURSIVE reach(a, b) AS (SELECT station_id, station_id FROM stations UNION"
        " SELECT a, next FROM reach JOIN (SELECT src AS here, dst AS next FROM links UNION SELECT dst, src FROM links)"
        " ON b = here)")
STRONG = (LINKS + ", RECURSIVE reach(a, b) AS (SELECT station_id, station_id FROM stations UNION"
          " SELECT a, dst FROM reach JOIN links ON b = src)")


@query("graph_edges", "M1", on_tables("SELECT * FROM edges", EDGES))
def graph_edges(spark, sf_dir):
    return edges(spark, sf_dir)


@query("graph_regular_edges", "M2", on_tables("SELECT * FROM links", LINKS))
def graph_regular_edges(spark, sf_dir):
    return links(spark, sf_dir)


@query("graph_regular_edges_raw", "M2 C7", on_tables(
    "SELECT src, dst, trips FROM raw_edges WHERE trips >= 2.0::DOUBLE * (SELECT avg(trips) FROM raw_edges)",
    "raw_edges AS (SELECT origin AS src, destination AS dst, count(*) AS trips FROM raw WHERE origin <> destination"
    " GROUP BY 1, 2)"))
def graph_regular_edges_raw(spark, sf_dir):
    every = G.cut_lineage(G.build_edges(T.raw_trips(spark, sf_dir)).select("src", "dst", "trips"))
    return G.regular_edges(every, BUSY * G.mean_trips(every))


@query("graph_degrees", "M3 D8 C10", on_tables(
    "SELECT station_id AS id, name, district, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree"
    " FROM stations LEFT JOIN (SELECT dst AS station_id, count(*) AS n FROM links GROUP BY 1) i USING (station_id)"
    " LEFT JOIN (SELECT src AS station_id, count(*) AS n FROM links GROUP BY 1) o USING (station_id)", LINKS))
def graph_degrees(spark, sf_dir):
    return G.degrees(nodes(spark, sf_dir).select("id", "name", "district"), links(spark, sf_dir))


@query("graph_top_degree", "E10 G5 M3", on_tables(
    "SELECT max(n) AS top_degree, count(*) FILTER (n = top) AS reach_it FROM (SELECT n, max(n) OVER () AS top FROM"
    " (SELECT station_id, count(dst) AS n FROM stations LEFT JOIN links ON dst = station_id GROUP BY 1))", LINKS))
def graph_top_degree(spark, sf_dir):
    per_degree = G.degrees(nodes(spark, sf_dir).select("id"), links(spark, sf_dir)).groupBy("in_degree").agg(
        F.count("*").alias("n"))
    return per_degree.agg(F.max("in_degree").alias("top_degree"), F.max_by("n", "in_degree").alias("reach_it"))


@query("graph_neighbours", "M4 D4", on_tables(
    f"SELECT dst AS id, name FROM links JOIN stations ON dst = station_id WHERE src = '{START}'", LINKS))
def graph_neighbours(spark, sf_dir):
    return G.neighbours(nodes(spark, sf_dir), links(spark, sf_dir), START)


@query("graph_two_hops", "M5 D5 H2", on_tables(
    f"SELECT DISTINCT b.dst FROM links a JOIN links b ON a.dst = b.src WHERE a.src = '{START}'", LINKS))
def graph_two_hops(spark, sf_dir):
    return G.two_hops(links(spark, sf_dir), START)


@query("graph_two_hop_counts", "D5 C11", on_tables(
    "SELECT a.src AS start, count(*) AS walks FROM links a JOIN links b ON a.dst = b.src GROUP BY 1", LINKS))
def graph_two_hop_counts(spark, sf_dir):
    every = G.cut_lineage(links(spark, sf_dir).select("src", "dst"))
    # what the second edges add is their number per middle node, so no walk is ever spelled out
    onward = every.alias("a2").groupBy(F.col("a2.src").alias("middle")).agg(F.count("*").alias("n"))
    walks = lookup_join(every.alias("a1").select(F.col("a1.src").alias("start"), F.col("a1.dst").alias("middle")),
                        onward, "middle")
    return walks.groupBy("start").agg(F.sum("n").alias("walks"))


@query("pagerank", "M6 M8 I11", on_tables(
    f"SELECT id, name, district, round(rank, 4) AS rank FROM r_{TURNS} JOIN stations ON id = station_id", RANKS))
def pagerank(spark, sf_dir):
    dock = nodes(spark, sf_dir)
    return G.rank_report(G.pagerank(dock, links(spark, sf_dir), TURNS), dock)


@query("pagerank_spread", "M6", on_tables(f"SELECT id, round(rank, 8) AS rank FROM p_{TURNS}", RANKS_SPREAD))
def pagerank_spread(spark, sf_dir):
    ranks = G.pagerank(nodes(spark, sf_dir), links(spark, sf_dir), TURNS, dangling="spread")
    return ranks.select("id", F.round("rank", 8).alias("rank"))


@query("pagerank_sum_n", "M7", on_tables(
    f"SELECT id, round(rank * (SELECT count(*) FROM stations), 6) AS rank FROM r_{TURNS}", RANKS))
def pagerank_sum_n(spark, sf_dir):
    ranks = G.pagerank(nodes(spark, sf_dir), links(spark, sf_dir), TURNS, normalise="n")
    return ranks.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_gap", "M9", on_tables(
    f"SELECT round(max(abs(a.rank - b.rank)), 8) AS gap FROM r_{TURNS} a JOIN r_{CONVERGED} b USING (id)",
    OUT_DEGREE + ", " + pagerank_sql(CONVERGED, False, "r")))
def pagerank_gap(spark, sf_dir):
    dock, every = nodes(spark, sf_dir), links(spark, sf_dir)
    gap = G.max_rank_gap(G.pagerank(dock, every, TURNS), G.pagerank(dock, every, CONVERGED))
    return gap.select(F.round("gap", 8).alias("gap"))


@query("bfs_path", "M10 D12 H1 I12", on_tables(
    f"SELECT path, CAST(len(path) - 1 AS INT) AS hops FROM way WHERE id = '{GOAL}'", hops_sql(START)))
def bfs_path(spark, sf_dir):
    return G.shortest_path(links(spark, sf_dir), START, GOAL)


@query("bfs_all_paths", "M10 M11 D6", on_tables(
    "SELECT id, path, n AS hops FROM way JOIN hop USING (id)", hops_sql(START)))
def bfs_all_paths(spark, sf_dir):
    paths = G.bfs_paths(links(spark, sf_dir), START)
    return paths.withColumn("hops", F.size("path") - 1)


@query("landmark_distances", "M12", on_tables(
    "SELECT id, landmark, hops FROM back",
    LINKS + f", RECURSIVE back(id, landmark, hops) USING KEY (id, landmark) AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', '{n}', 0)" for n in LANDMARKS)
    + ") UNION SELECT src, b.landmark, min(b.hops) + 1 FROM back b JOIN links ON dst = b.id LEFT JOIN recurring.back r"
    " ON r.id = src AND r.landmark = b.landmark WHERE r.id IS NULL GROUP BY ALL)"))
def landmark_distances(spark, sf_dir):
    return G.landmark_distances(links(spark, sf_dir), LANDMARKS)


@query("weak_components", "M13", on_tables("SELECT a AS id, min(b) AS component FROM reach GROUP BY 1", WEAK))
def weak_components(spark, sf_dir):
    return G.weak_components(nodes(spark, sf_dir), links(spark, sf_dir))


@query("strong_components", "M14", on_tables(
    "SELECT f.a AS id, min(f.b) AS component FROM reach f JOIN reach g ON f.a = g.b AND f.b = g.a GROUP BY 1", STRONG))
def strong_components(spark, sf_dir):
    return G.strong_components(nodes(spark, sf_dir), links(spark, sf_dir))


@query("components_by_threshold", "M13 M14 M2", on_tables(
    "SELECT busy, (SELECT count(*) FROM edges WHERE trips >= busy * (SELECT avg(trips) FROM edges)) AS links, weak, strong"
    " FROM (SELECT busy, count(DISTINCT component) AS weak FROM (SELECT busy, a, min(b) AS component FROM near"
    " GROUP BY 1, 2) GROUP BY 1) JOIN (SELECT busy, count(DISTINCT component) AS strong FROM (SELECT f.busy, f.a,"
    " min(f.b) AS component FROM far f JOIN far g ON f.busy = g.busy AND f.a = g.b AND f.b = g.a GROUP BY 1, 2)"
    " GROUP BY 1) USING (busy)",
    EDGES + f", steps AS (SELECT unnest({THRESHOLDS}::DOUBLE[]) AS busy), kept AS MATERIALIZED (SELECT busy, src, dst"
    " FROM edges, steps WHERE trips >= busy * (SELECT avg(trips) FROM edges)),"
    " RECURSIVE near(busy, a, b) AS (SELECT busy, station_id, station_id FROM stations, steps UNION SELECT r.busy, a, next"
    " FROM near r JOIN (SELECT busy, src AS here, dst AS next FROM kept UNION ALL SELECT busy, dst, src FROM kept) k"
    " ON k.busy = r.busy AND here = b),"
    " RECURSIVE far(busy, a, b) AS (SELECT busy, station_id, station_id FROM stations, steps UNION SELECT r.busy, a, dst"
    " FROM far r JOIN kept k ON k.busy = r.busy AND src = b)"))
def components_by_threshold(spark, sf_dir):
    dock, every = nodes(spark, sf_dir), G.cut_lineage(edges(spark, sf_dir))
    mean, rows = G.mean_trips(every), []
    for busy in THRESHOLDS:
        kept = G.regular_edges(every, busy * mean)
        weak, strong = (components(dock, kept).agg(F.count_distinct("component")).first()[0]
                        for components in (G.weak_components, G.strong_components))
        rows.append((busy, kept.count(), weak, strong))
    return files.local_table(spark, rows, "busy double, links bigint, weak bigint, strong bigint")


@query("cheapest_path", "M15", on_tables(
    f"SELECT path, round(cost, 2) AS km FROM way JOIN best USING (id) WHERE id = '{GOAL}'", cheapest_sql(START)))
def cheapest_path(spark, sf_dir):
    ways = G.cheapest_paths(links(spark, sf_dir), START, "distance_km", goal=GOAL)
    return ways.where(F.col("id") == GOAL).select("path", F.round("cost", 2).alias("km"))


@query("cheapest_costs", "M15", on_tables(
    "SELECT id, round(cost, 4) AS km FROM best", cheapest_sql(START)))
def cheapest_costs(spark, sf_dir):
    ways = G.cheapest_ways(links(spark, sf_dir), START, "distance_km")
    return ways.select("id", F.round("cost", 4).alias("km"))


@query("reciprocal_pairs", "M16", on_tables(
    "SELECT f.src AS a, f.dst AS b FROM links f JOIN links g ON f.src = g.dst AND f.dst = g.src"
    " WHERE f.src < f.dst", LINKS))
def reciprocal_pairs(spark, sf_dir):
    return G.reciprocal_pairs(links(spark, sf_dir))


@query("one_way_edges", "M16", on_tables(
    "SELECT f.src, f.dst FROM links f LEFT JOIN links g ON f.src = g.dst AND f.dst = g.src WHERE g.src IS NULL", LINKS))
def one_way_edges(spark, sf_dir):
    return G.one_way(links(spark, sf_dir))


@query("map_nodes", "M17", on_tables(
    f"SELECT id, longitude, latitude, district, CAST(dense_rank() OVER (ORDER BY district) - 1 AS INT) AS color,"
    f" round(round(rank, 8) * 30000, 4) AS size, CASE WHEN row_number() OVER (ORDER BY round(rank, 8) DESC, id) <= 10"
    f" THEN name END AS label FROM r_{TURNS} JOIN stations ON id = station_id", RANKS))
def map_nodes(spark, sf_dir):
    dock = nodes(spark, sf_dir)
    ranks = G.pagerank(dock, links(spark, sf_dir), TURNS).select("id", F.round("rank", 8).alias("rank"))
    return G.map_nodes(dock, ranks).withColumn("size", F.round("size", 4))


@query("map_edges", "M17", on_tables(
    "SELECT src, dst, f.longitude AS from_longitude, f.latitude AS from_latitude, t.longitude AS to_longitude,"
    " t.latitude AS to_latitude FROM links JOIN stations f ON src = f.station_id JOIN stations t ON dst = t.station_id",
    LINKS))
def map_edges(spark, sf_dir):
    return G.map_edges(nodes(spark, sf_dir), links(spark, sf_dir))
