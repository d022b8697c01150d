import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.functions import sky
from skyquarry.operators import maps, spline2d, stamps


def collocated(n):
    """What the cubic B-spline gives at pixels, mirrored at both ends."""
    a = np.zeros((n, n))
    for i in range(n):
        for k, w in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
            j = abs(i + k)
            a[i, n - 1 - abs(n - 1 - j)] += w
    return a


def frame(spark, image, m=0):
    return spark.createDataFrame([(m, y, x, float(image[y, x])) for y in range(image.shape[0]) for x in range(image.shape[1])], "map_id long, gy int, gx int, v double")


@pytest.mark.parametrize("n", [2, 3, 7, 40, 90])
def test_prefilter_solves_the_dense_system(n):
    v = np.random.default_rng(n).normal(size=(n, 3))
    assert np.allclose(collocated(n) @ spline2d.prefiltered(v, 0), v, atol=1e-10)
    assert np.allclose(spline2d.prefiltered(v.T, 1), spline2d.prefiltered(v, 0).T)


def test_tiles_with_halos_give_the_whole_and_pixels_their_values(spark):
    image = np.random.default_rng(1).normal(size=(70, 90))
    got = np.full(image.shape, np.nan)
    coefs = spline2d.coefficients(frame(spark, image), "v", 70, 90, block=32)
    for r in coefs.collect():
        got[r["gy"], r["gx"]] = r["c"]
    assert np.allclose(got, spline2d.prefiltered(spline2d.prefiltered(image, 0), 1), atol=1e-11)
    at = [(0, i, float(y), float(x)) for i, (y, x) in enumerate([(0, 0), (69, 89), (12, 30), (31.5, 44.25), (0.25, 88.5), (-0.1, 3), (5, 89.01)])]
    found = {r["i"]: r["value"] for r in spline2d.at_positions(spark.createDataFrame(at, "map_id long, i int, y double, x double"), coefs, 70, 90, ["i"]).collect()}
    assert set(found) == {0, 1, 2, 3, 4}
    assert [found[i] for i in range(3)] == pytest.approx([image[0, 0], image[69, 89], image[12, 30]])

    def value(y, x):
        b = lambda t: np.where(abs(t) < 1, 2 / 3 - t * t + abs(t) ** 3 / 2, np.where(abs(t) < 2, (2 - abs(t)) ** 3 / 6, 0))
        yy, xx = np.arange(-3, 73), np.arange(-3, 93)
        c = got[np.ix_(69 - abs(69 - abs(yy)), 89 - abs(89 - abs(xx)))]
        return float(b(yy - y) @ c @ b(xx - x))

    assert [found[3], found[4]] == pytest.approx([value(31.5, 44.25), value(0.25, 88.5)])


def test_bicubic_images_come_back_inside(spark):
    y, x = np.mgrid[:80, :80] / 20.0
    f = lambda y, x: 1 + x - y + x * y**2 - 0.3 * x**3 + 0.1 * y**3 * x
    coefs = spline2d.coefficients(frame(spark, f(y, x)), "v", 80, 80)
    at = spark.createDataFrame([(0, 1, 40.3, 39.7), (0, 2, 35.5, 44.9)], "map_id long, i int, y double, x double")
    found = {r["i"]: r["value"] for r in spline2d.at_positions(at, coefs, 80, 80, ["i"]).collect()}
    assert found[1] == pytest.approx(f(40.3 / 20, 39.7 / 20), abs=1e-9) and found[2] == pytest.approx(f(35.5 / 20, 44.9 / 20), abs=1e-9)


def test_tangent_planes_go_both_ways(spark):
    rng = np.random.default_rng(2)
    centres = [(0.0, 89.999), (359.99, -89.9), (0.001, 0.0), (180.0, 45.0), (359.9999, -60.0)]
    rows = [(float(a), float(d), float(x), float(y)) for a, d in centres for x, y in rng.uniform(-2, 2, (20, 2))] + [(a, d, 0.0, 0.0) for a, d in centres]
    df = spark.createDataFrame(rows, "ra0 double, dec0 double, xi double, eta double")
    ra, dec = sky.from_tangent(F.col("xi"), F.col("eta"), F.col("ra0"), F.col("dec0"))
    df = df.withColumns({"ra": ra, "dec": dec})
    xi, eta = sky.tangent(F.col("ra"), F.col("dec"), F.col("ra0"), F.col("dec0"))
    for r in df.withColumns({"xi2": xi, "eta2": eta}).collect():
        assert abs(r["xi2"] - r["xi"]) < 1e-9 and abs(r["eta2"] - r["eta"]) < 1e-9 and 0 <= r["ra"] < 360
    far = spark.createDataFrame([(180.0, 0.0, 0.0, 0.0)], "ra double, dec double, ra0 double, dec0 double").select(*sky.tangent(F.col("ra"), F.col("dec"), F.col("ra0"), F.col("dec0"))).first()
    assert far[0] is None and far[1] is None


def test_tangent_stamps_follow_the_sky(spark):
    grid = {"crval_ra": 30.0, "crpix_x": 101.0, "cdelt_ra": -0.1, "crpix_y": 1.0, "cdelt_dec": 0.1}
    ny, nx = 120, 200
    image = np.fromfunction(lambda y, x: np.sin(y / 9) + np.cos(x / 11), (ny, nx))
    coefs = spline2d.coefficients(frame(spark, image), "v", ny, nx)
    s = spark.createDataFrame([(0, 7, 29.0, 6.0)], "map_id long, source_id long, ra_deg double, dec_deg double")
    got = stamps.tangent_stamps(s, coefs, 2, 0.25, ny, nx, grid).collect()
    assert len(got) == 25
    for r in got:
        x, y, d0 = np.radians(r["dx"] * 0.25), np.radians(r["dy"] * 0.25), np.radians(6.0)
        ra = 29.0 + np.degrees(np.arctan2(x, np.cos(d0) - y * np.sin(d0)))
        dec = np.degrees(np.arctan2(np.sin(d0) + y * np.cos(d0), np.hypot(x, np.cos(d0) - y * np.sin(d0))))
        assert r["v"] == pytest.approx(np.sin(dec / 0.1 / 9) + np.cos(((ra - 30.0) / -0.1 + 100) / 11), abs=1e-5)


def test_flat_field_divides_by_the_blocks_noise(spark):
    rng = np.random.default_rng(4)
    noise = np.where(np.arange(40) < 20, 1.0, 3.0)[None, :] * rng.normal(size=(40, 40))
    rows = [(1, y, x, float(noise[y, x]), float(noise[y, x])) for y in range(40) for x in range(40)]
    out = maps.flat_fielded(spark.createDataFrame(rows, "map_id long, gy int, gx int, flux double, snr double"), 10).collect()
    assert len(out) == 1600
    left, right = (np.std([r["snr"] for r in out if a <= r["gx"] < z]) for a, z in ((0, 15), (25, 40)))
    assert abs(left / right - 1) < 0.15
