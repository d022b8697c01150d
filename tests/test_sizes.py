"""Queries over values and sizes that the small tables lack."""

import math
import random

from pyspark.sql import functions as F

from skyquarry.operators import groups, joins, maps, moving, sift
from skyquarry.plans import domain_queries, more_queries, queries
from skyquarry.streaming import streams


def customers(spark, path, keys):
    rows = [(k, "n", 10.0, 3) for k in keys]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_acctbal double, c_nationkey int").write.parquet(f"{path}/customer.parquet")
    return str(path)


def test_flux_over_zero_is_a_flare(spark):
    pairs = [(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (1.0, -0.0), (-1.0, -0.0), (6.0, 1.0), (4.0, 1.0), (None, 0.0), (1.0, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double")
    got = {r["i"]: r["x"] for r in df.select("i", sift.flares(F.col("a"), F.col("b")).alias("x")).collect()}
    assert got == dict(enumerate([True, True, False, False, True, True, False, False, False]))


def test_stream_alerts_after_a_flux_of_zero(spark, tmp_path):
    events = [(1, 0.0), (2, 3.0), (3, 0.0), (4, 0.0), (5, -2.0), (6, None), (7, 9.0)]
    rows = [(i, 7, "view", float(i), v) for i, v in events]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, "event_id long, source_id long, band string, t_unix double, flux_mjy double").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    out = streams.drained(streams.flare_alerts(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r["event_id"] for r in out.collect()) == [2, 4]


def test_names_and_planes_keep_right_ascensions_of_360_and_more(spark, tmp_path):
    # 8642 lies at 359.98 + 0.04
    sf = customers(spark, tmp_path, [8642, 1])
    assert {r["det_id"]: r["name"] for r in queries.iau_names(spark, sf).collect()}[8642] == "SO-S J240004-1949.2"
    assert {r["det_id"]: r["name"] for r in queries.transient_names(spark, sf).collect()}[8642] == "SO-T J240004-1949.2"
    found = {r["det_id"]: r["ra"] for r in domain_queries.tangent_positions(spark, sf).collect()}
    assert math.isclose(found[8642], 360.02) and math.isclose(found[1], 79.2)


def test_long_sets_are_connected_whatever_their_names(spark):
    # names rise from both ends of a chain, so that the greater half's name is far from where the halves meet
    half = 80
    names = [2 * k for k in range(half)] + [2 * k + 1 for k in reversed(range(half))]
    pairs = [(a, b) for a, b in zip(names, names[1:])] + [(-5, -5)]
    got = {r["node"]: r["root"] for r in groups.connected(spark.createDataFrame(pairs, "i long, j long")).collect()}
    assert got == dict.fromkeys(names, 0) | {-5: -5}


def test_exploded_rows_are_not_broadcast(spark):
    a = spark.createDataFrame([(i, i * 7.3 % 360, i * 3.1 % 80 - 60) for i in range(50)], "i long, ra_deg double, dec_deg double")
    b = a.selectExpr("i as j", "ra_deg as cat_ra", "dec_deg as cat_dec")
    pairs = joins.zone_join(a, b, 4.0)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    # cells as wide as the radius asks for: a row goes to some tens of them and not to hundreds
    assert pairs.where("i = j").count() == 50


def test_nearest_in_growing_circles(spark):
    rng = random.Random(8)
    places = [(rng.uniform(0, 360), rng.uniform(-60, 60)) for _ in range(60)] + [(10.0 + rng.random() / 50, 5.0 + rng.random() / 50) for _ in range(200)]
    rows = [(i, *rng.choice(places), float(rng.randrange(5))) for i in range(400)]
    a = spark.createDataFrame(rows, "id long, ra_deg double, dec_deg double, flux double")
    b = a.selectExpr("id as j", "ra_deg as cat_ra", "dec_deg as cat_dec", "flux as cat_flux")
    where = "id <> j and cat_flux >= flux"
    want = joins.closest(joins.zone_join(a, b, 30.0).where(where), "id", "j").select("id", "sep", "j").collect()
    got = joins.nearest_where(a, b, 30.0, ["id"], "j", F.expr(where)).collect()
    assert len(want) > 300 and sorted(got) == sorted(want)


def test_sets_by_cells_are_those_of_all_pairs(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 0, 0, 1, None]), rng.choice([rng.uniform(0, 361), 12.0]), rng.uniform(-60, 60)) for i in range(500)] + [(900, 1, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "det_id long, map_ord int, ra_deg double, dec_deg double")
    got = groups.matched_sets(df, 3.0)
    want = groups.connected(groups.pairwise(df, 3.0))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() >= 100


def spread_is_broadcast(df):
    """Whether rows that a generator spreads out go into a broadcast, which the planner takes for as small as before."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = range(i + 1, next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines)))
            if any("Generate" in lines[k] for k in below):
                return True
    return False


def test_fit_counts_fits_each_place_once(spark, small):
    assert not spread_is_broadcast(domain_queries.fit_counts(spark, small))


def test_fitted_sources_fits_each_place_once(spark, small):
    out = more_queries.fitted_sources(spark, small)
    assert not spread_is_broadcast(out) and "source_id" in out.columns and "map_id" not in out.columns


def test_annulus_noise_of_a_place(spark, small):
    assert not spread_is_broadcast(queries.annulus_snr(spark, small))
    pixels = spark.createDataFrame([(0, y, x, float((y * 7 + x * 3) % 11)) for y in range(9) for x in range(9)], "map_id int, gy int, gx int, flux double")
    sources = spark.createDataFrame([(0, i, 4, 4, 10.0 * i, 8.0, i % 2) for i in range(1, 5)], "map_id int, source_id long, gy int, gx int, peak double, snr double, k int")
    got = {r["source_id"]: r for r in maps.annulus_snr(sources, pixels, 3, 1.0 + F.col("k")).collect()}
    for i in range(1, 5):
        ring = [(y * 7 + x * 3) % 11 for y in range(1, 8) for x in range(1, 8) if math.hypot(y - 4, x - 4) >= 1 + i % 2]
        mean = sum(ring) / len(ring)
        assert got[i]["n_pixels"] == len(ring) and math.isclose(got[i]["new_snr"], 10.0 * i / math.sqrt(sum((v - mean) ** 2 for v in ring) / len(ring)))


def test_centres_of_mass_of_a_place(spark, small):
    assert not spread_is_broadcast(domain_queries.centre_of_mass(spark, small))


def test_splines_meet_blocks_of_coefficients(spark, small):
    assert not spread_is_broadcast(domain_queries.spline_photometry(spark, small))


def test_times_around_a_pixel(spark, small):
    assert not spread_is_broadcast(queries.time_safe(spark, small))


def test_thumbnails_of_a_place(spark, small):
    assert not spread_is_broadcast(more_queries.thumbnails(spark, small))


def test_tangent_stamps_at_one_position_are_shared(spark, small):
    out = domain_queries.tangent_stamps(spark, small)
    assert not spread_is_broadcast(out)
    # summed within a row, not by an aggregate of a source's pixels
    aggregates = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate" in line]
    assert not any("source_id" in line for line in aggregates)


def test_stacks_of_a_pixel(spark, small):
    out = more_queries.stacked_stamps(spark, small)
    assert not spread_is_broadcast(out)
    assert out._jdf.queryExecution().executedPlan().toString().count("source_id#") > 0


def test_peaks_at_one_place_are_one(spark, monkeypatch):
    from skyquarry.sources import tables

    rng, sizes, saved = random.Random(4), [], tables.saved
    rows = [(0, i, float(rng.randrange(12)), float(rng.randrange(12)), float(rng.randrange(9)), rng.choice([0.0, 1.0, 2.5])) for i in range(2000)] + [(0, 5000 + i, None, 1.0, 1.0, 1.0) for i in range(2)]
    kept = []
    for p in sorted(rows, key=lambda p: (-p[4], p[1])):
        if p[2] is None or not any(q[2] is not None and (q[2] - p[2]) ** 2 + (q[3] - p[3]) ** 2 <= p[5] ** 2 for q in kept):
            kept.append(p)

    def counted(df, name):
        out = saved(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(tables, "saved", counted)
    df = spark.createDataFrame(rows, "map_id int, peak_id long, x double, y double, v double, rad double")
    got = maps.greedy_suppressed(df, F.col("rad")).collect()
    assert sorted((r["peak_id"], r["v"]) for r in got) == sorted((p[1], p[4]) for p in kept)
    assert max(n for name, n in sizes if name == "peaks") <= 12 * 12 * 3 + 2


def test_asks_for_one_object_and_time_are_refined_once(spark, monkeypatch):
    sizes, saved = [], moving.saved

    def counted(df, name):
        out = saved(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(moving, "saved", counted)
    asks = spark.createDataFrame([(i, i % 2, 10.5 + i % 3) for i in range(300)], "ask_id long, designation long, jd double")
    pieces = spark.createDataFrame([(d, 10.0 + k, 11.0 + k, 5.0 * k, 5.0 * k + 5, 0.0, 0.0) for d in range(2) for k in range(9)], "designation long, jd0 double, jd1 double, ra0 double, ra1 double, dec0 double, dec1 double")
    times = spark.createDataFrame([(0, x, 10.0 + x / 5) for x in range(60)], "gy int, gx int, pixel_jd double")
    out = moving.refined(asks, pieces, times, (F.col("dec_deg").cast("int"), F.floor("ra_deg").cast("int"))).collect()
    assert sorted(r["ask_id"] for r in out) == list(range(300)) and all(r["designation"] == r["ask_id"] % 2 for r in out)
    assert len({(r["designation"], r["ask_id"] % 3, r["jd"]) for r in out}) == 6
    assert max(n for name, n in sizes if name == "moving") == 6


def shuffled_pairs(df):
    """Whether anything is exchanged behind a join by cells."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(lines) if "Join [_z" in line)
    return any("Exchange" in line for line in lines[:joined])


def test_pairs_of_a_cone_are_not_shuffled(spark, small):
    out = queries.cone_all(spark, small)
    assert not shuffled_pairs(out) and not spread_is_broadcast(out)


def test_nearest_of_crowded_positions(spark):
    rng = random.Random(2)
    a = spark.createDataFrame([(i, 10.0 + i % 3, 20.0 + i % 2) for i in range(60)] + [(99, None, 1.0)], "i long, ra_deg double, dec_deg double")
    b = spark.createDataFrame([(j, 10.0 + rng.randrange(4) / 2, 20.5) for j in range(80)] + [(5, 200.0, 0.0)], "j long, cat_ra double, cat_dec double")
    want = joins.closest(joins.zone_join(a, b, 3.0), "i", "j").select("i", "j", "sep")
    got = joins.nearest_of(a, b, 3.0, "i", "j")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 60
    # rows of one position meet others as one
    assert "i#" not in str(next(line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate" in line))


def test_crossmatch_lists_are_shuffled_by_position(spark, small):
    plan = more_queries.crossmatch_records(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and not any("Exchange hashpartitioning(det_id" in line for line in plan.splitlines())
