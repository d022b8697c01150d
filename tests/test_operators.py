"""Operators against brute force and against what they must keep."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.functions import names, sky
from skyquarry.operators import groups, joins, kernels, maps, state


def sep(a, b):
    r = np.radians
    h = np.sin((r(b[1]) - r(a[1])) / 2) ** 2 + np.cos(r(a[1])) * np.cos(r(b[1])) * np.sin((r(b[0]) - r(a[0])) / 2) ** 2
    return np.degrees(2 * np.arcsin(min(1, np.sqrt(h))))


@pytest.mark.parametrize("radius", [0.05, 0.7, 3.0])
def test_zone_join_at_poles_and_seam(spark, radius):
    rng = np.random.default_rng(5)
    dec = np.concatenate([rng.uniform(-90, 90, 150), rng.uniform(84, 90, 60), rng.uniform(-90, -84, 60), [90, -90, 85, -85, 0]])
    ra = np.concatenate([rng.uniform(0, 360, 200), rng.uniform(-2, 2, 70) % 360, [0, 0, 359.999, 0.001, 360 - 1e-9]])
    a = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(ra, dec))]
    b = [(i, float((x + rng.normal() * radius) % 360), float(np.clip(y + rng.normal() * radius / 2, -90, 90))) for i, x, y in a]
    left = spark.createDataFrame([*a, (-1, None, 0.0), (-2, float("nan"), 0.0)], "id long, ra_deg double, dec_deg double")
    right = spark.createDataFrame([*b, (-1, 1.0, None)], "cid long, cat_ra double, cat_dec double")
    got = {(r["id"], r["cid"]) for r in joins.zone_join(left, right, radius).collect()}
    assert got == {(i, j) for i, *p in a for j, *s in b if sep(p, s) <= radius}
    pairs = joins.zone_join(left, right, radius)
    assert pairs.count() == len(got)


def test_asof_and_interval_joins(spark):
    rng = np.random.default_rng(1)
    a = [(i, int(i % 3), float(t)) for i, t in enumerate(rng.uniform(0, 2e7, 200))]
    b = [(int(i % 3), float(t), i) for i, t in enumerate(rng.uniform(0, 2e7, 40))]
    da = spark.createDataFrame(a, "id long, k long, t double")
    db = spark.createDataFrame(b, "k long, u double, v long")
    got = {r["id"]: r["v"] for r in joins.asof_backward(da, db, "t", "u", ["k"]).collect()}
    assert got == {i: max(((u, v) for kk, u, v in b if kk == k and u < t), default=(0, None))[1] for i, k, t in a}
    spans = spark.createDataFrame([(i, t, t + 1e5) for i, _, t in a], "id long, s double, e double")
    found = {(r["id"], r["v"]) for r in joins.interval_join(spans, db.select("u", "v"), "s", "e", "u", 3e4).collect()}
    assert found == {(i, v) for i, _, t in a for _, u, v in b if t <= u <= t + 1e5}


def test_names(spark):
    df = spark.createDataFrame([(10.684708, 41.26875), (359.99999, -0.5), (83.633083, -22.0145)], "ra double, dec double")
    got = [tuple(r) for r in df.select(*[names.iau_name(F.col("ra"), F.col("dec"), k, "XX") for k in ("S", "SV", "CL", "short")]).collect()]
    assert got[0] == ("XX-S J004244+4116.1", "XX-SV J004244.3+411607", "XX-CL J0042+4116", "0042+41")
    assert got[1][0] == "XX-S J235959-0030.0" and got[2][0] == "XX-S J053431-2200.8"
    raw = spark.createDataFrame([("3552 Don Quixote (1983 SA)",), ("7335 (1989 JA)",), ("Ceres",)], "n string")
    assert [r[0] for r in raw.select(names.asteroid_name(F.col("n"))).collect()] == ["(3552) Don Quixote", "(7335) 1989 JA", "Ceres"]
    path = spark.createDataFrame([("/d/depth1_1760000000_pa5_f090_rho.fits",)], "p string").select(*[c.alias(n) for n, c in names.file_parts(F.col("p")).items()]).first()
    assert (path["unix"], path["arr"], path["freq"], path["layer"]) == ("1760000000", "pa5", "f090", "rho")
    with pytest.raises(Exception, match="unknown band"):
        spark.createDataFrame([("f999",)], "b string").select(names.band_value(F.col("b"), names.BAND_GHZ)).collect()


def test_noise_radius_is_the_first_pixel_under_the_noise(spark):
    rows = [(p, n, w) for p in (0.5, 1.0, 5.0, 100.0) for n in (0.4, 1.0) for w in (1.0, 4.4, 9.0)]
    df = spark.createDataFrame(rows, "p double, n double, w double")
    got = [r[0] for r in df.select(sky.noise_radius(F.col("p"), F.col("n"), F.col("w"))).collect()]
    for (p, n, w), g in zip(rows, got):
        k = 0
        while p * math.exp(-0.5 * (k / (w / sky.FWHM_PER_SIGMA)) ** 2) > n:
            k += 1
        assert g == max(k, 1)


def test_gaussian_fit_recovers_a_source():
    rng = np.random.default_rng(8)
    y, x = np.mgrid[:31, :31].astype(float)
    truth = np.array([10.0, 15.3, 14.6, 2.0, 1.5, 0.6, 0.2])
    image = kernels.gaussian(truth, x, y) + 0.01 * rng.normal(size=x.shape)
    got = kernels.fit_gaussian(image, 0.01)
    assert not got["failed"] and abs(got["amplitude"] - 10) < 0.1 and abs(got["x0"] - 15.3) < 0.02 and abs(got["y0"] - 14.6) < 0.02
    assert abs(got["fwhm_x"] * got["fwhm_y"] - 2.3548**2 * 3.0) < 0.3 and got["r2"] > 0.99
    frozen = kernels.fit_gaussian(image, 0.01, centre=(15.0, 15.0), allow=0)
    assert (frozen["x0"], frozen["y0"]) == (15.0, 15.0)
    image[3, 3] = np.nan
    assert kernels.fit_gaussian(image)["reason"] == "flux_thumb_has_nan"


def test_regions_match_flood_fill(spark):
    rng = np.random.default_rng(3)
    image = (rng.random((90, 150)) < 0.35) * rng.uniform(6, 9, (90, 150))
    image[40, :] = 7.0
    df = spark.createDataFrame([(1, int(y), int(x), float(image[y, x])) for y in range(90) for x in range(150)], "map_id int, gy int, gx int, snr double")
    lab, want = {}, []
    for start in zip(*np.nonzero(image > 5)):
        if start in lab:
            continue
        todo, seen = [start], {start}
        while todo:
            y, x = todo.pop()
            for p in ((y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
                if p not in seen and 0 <= p[0] < 90 and 0 <= p[1] < 150 and image[p] > 5:
                    seen.add(p)
                    todo.append(p)
        lab |= dict.fromkeys(seen, start)
        want.append((len(seen), round(max(image[p] for p in seen), 6)))
    got = [(r["n_pixels"], round(r["peak"], 6)) for r in kernels.regions(df, "snr", 5.0, 1).collect()]
    assert sorted(got) == sorted(want)


def test_spline_is_exact_on_cubics(spark):
    f = lambda t: 10 + 2 * t - 0.5 * t**2 + 0.1 * t**3
    rows = [("a", 100 + k / 12, f(k / 12) % 360, f(k / 12) / 2) for k in range(-12, 13)] + [("b", 100.0, 1.0, 1.0)]
    eph = spark.createDataFrame(rows, "designation string, julian_day double, ra_deg double, dec_deg double")
    asks = spark.createDataFrame([(1, "a", 100.03), (2, "b", 100.0), (3, "c", 100.0)], "ask_id int, designation string, target_jd double")
    got = {r["ask_id"]: r for r in kernels.interpolated(asks, eph, 0.5).collect()}
    assert abs(got[1]["ra_deg"] - f(0.03)) < 1e-9 and abs(got[1]["dec_deg"] - f(0.03) / 2) < 1e-9
    assert got[2]["ra_deg"] is None and 3 not in got


def test_pointing_polynomial_recovers_offsets(spark):
    rng = np.random.default_rng(42)
    rows = [(0, i, float(r), float(d), 20.0 + i, float(0.01 + 0.002 * r - 0.001 * d), float(-0.02 + 0.003 * d)) for i, (r, d) in enumerate(zip(rng.uniform(18, 22, 40), rng.uniform(-3, 1, 40)))]
    df = spark.createDataFrame(rows, "map_id int, source_id int, ra_deg double, dec_deg double, snr double, offset_ra double, offset_dec double")
    (got,) = kernels.polynomial_pointing(df, 1, sigma=6.0).collect()
    assert np.allclose(got["ra_coef"], [0.01, -0.001, 0.002], atol=1e-6) and np.allclose(got["dec_coef"], [-0.02, 0.003, 0], atol=1e-6)


def test_matched_filter_peaks_at_the_source_and_bands_merge(spark):
    rng = np.random.default_rng(6)
    y, x = np.mgrid[:64, :64].astype(float)
    image = kernels.gaussian(np.array([1.0, 30, 33, 1.9, 1.9, 0, 0]), x, y) + 0.2 * rng.normal(size=x.shape)
    rho, kappa = kernels.matched_filter(image, np.full(image.shape, 25.0), 4.4)
    assert np.unravel_index(rho.argmax(), rho.shape) == (33, 30)
    twice, _ = kernels.matched_filter(2 * image, np.full(image.shape, 25.0), 4.4)
    assert np.allclose(twice, 2 * rho)
    for n, block, overlap in ((64, 20, 6), (10, 20, 4), (100, 32, 16), (33, 16, 4)):
        total = np.zeros(n)
        for s, e, w in kernels.ramps(n, block, overlap):
            total[s:e] += w
        assert np.allclose(total, 1)
    df = spark.createDataFrame([(1, int(a), int(b), float(image[a, b]), 25.0) for a in range(64) for b in range(64)], "map_id int, gy int, gx int, flux double, kappa double")
    got = kernels.filtered(df, 64, 64, 4.4, block=40, overlap=16).orderBy(F.desc("rho")).first()
    assert (got["gy"], got["gx"]) == (33, 30)


def test_footprint_fills_holes(spark):
    image = np.zeros((12, 12), bool)
    image[2:10, 2:10] = True
    image[4:6, 4:6] = False
    image[7, 7] = False
    rows = spark.createDataFrame([(1, int(y), int(x)) for y, x in np.argwhere(image)], "map_id long, gy int, gx int")
    got = {(r["gy"], r["gx"]) for r in maps.outside(rows, 12, 12).collect()}
    assert got == {(y, x) for y in range(12) for x in range(12) if not (2 <= y < 10 and 2 <= x < 10)}


def test_groups_fold_and_components(spark):
    rows = [(0, 0, 10.0, 0.0), (1, 1, 10.0, 0.0), (2, 2, 10.0, 0.0), (3, 0, 50.0, 5.0), (4, 1, 80.0, 5.0), (5, 2, 50.01, 5.0)]
    pairs = groups.pairwise(spark.createDataFrame(rows, "det_id long, map_ord int, ra_deg double, dec_deg double"), 0.1)
    want = {0: 0, 1: 0, 2: 0, 3: 3, 5: 3}
    assert {r["node"]: r["root"] for r in groups.connected(pairs).collect()} == want
    assert {r["node"]: r["group"] for r in groups.folded(pairs).collect()} == want


def test_state_machine(spark):
    status = spark.createDataFrame([(1, "completed", 0.0, 1.0), (2, "processing", 9_000.0, None), (3, "processing", 1_000.0, None)], "map_id int, status string, processing_start double, processing_end double")
    m = spark.createDataFrame([(i,) for i in range(1, 5)], "map_id int")
    assert sorted(r[0] for r in state.unclaimed(m, status, 10_000.0).collect()) == [3, 4]
    done = {r["map_id"]: r["status"] for r in state.ended(status, m.where("map_id = 2"), 1e4).collect()}
    assert done == {1: "completed", 2: "completed", 3: "processing"}
    with pytest.raises(Exception, match="never started"):
        state.ended(status, m.where("map_id = 4"), 1e4).collect()


def test_coadd_of_overlapping_maps(spark):
    rows = [(m, "f090", "pa5", y, x, 2.0, 4.0, 100.0 + m, 1) for m, (y0, x0) in enumerate([(0, 0), (5, 5)]) for y in range(y0, y0 + 10) for x in range(x0, x0 + 10)]
    df = spark.createDataFrame(rows, "map_id int, freq string, arr string, gy int, gx int, rho double, kappa double, t_unix double, mask int")
    got = maps.coadd(df).collect()
    assert len(got) == 175 and {r["hits"] for r in got} == {1, 2} and all(r["rho"] / r["kappa"] == 0.5 for r in got)
    assert {r["t_mean"] for r in got if r["hits"] == 2} == {100.5}


def test_coadd_window_edges(spark):
    df = spark.createDataFrame([("a", "b", float(t) * 86400) for t in (0, 1, 6.9, 7, 13, 14)], "freq string, arr string, obs_start double")
    assert [r["bin"] for r in maps.coadd_windows(df, 7).orderBy("obs_start").collect()] == [0, 0, 0, 1, 1, 1]
    assert {r["bin"] for r in maps.coadd_windows(df, 0).collect()} == {0}


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.37, 0.5, 0.999, 1.0])
def test_percentiles_are_exact_whatever_the_sketch(spark, fraction):
    rng = np.random.default_rng(5)
    groups = {"even": rng.random(500), "ties": rng.integers(0, 3, 400).astype(float), "far": np.append(rng.random(99), 1e18), "one": np.array([-2.5]), "odd": np.array([np.nan, 1.0, 2.0, np.nan])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("even", None), ("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {g: float(np.nanpercentile(v, fraction * 100)) for g, v in groups.items()}
    got = {r["g"]: r["level"] for r in maps.percentile_cuts(df, "g", fraction, accuracy=10).collect()}
    assert got == pytest.approx(want)
    whole = df.where("v is not null and not isnan(v)")
    for low, high in ((-9.0, -8.0), (1e19, 1e20), (0.4, 0.6)):
        ends = df.select("g").distinct().withColumn("ends", F.array(F.lit(low), F.lit(high)))
        assert {r["g"]: r["level"] for r in maps.ranked_between(whole, "g", fraction, ends).collect()} == pytest.approx(want)


def test_cleaning_keeps_maps_without_weights_and_all_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, "a"), (1, 10.0, 6.0, "b"), (2, float("nan"), 7.0, "c"), (3, None, 8.0, "d")], "map_id long, kappa double, rho double, level string")
    for mode in ("median", "percentile", "max"):
        out = maps.clean_map(df, 0.5, mode)
        assert out.columns == df.columns
        assert {r["level"]: r["rho"] for r in out.collect()} == {"a": 0.0, "b": 6.0, "c": 7.0, "d": 8.0}
    assert maps.clean_map(df.limit(0)).count() == 0
