import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.operators import filters


def frame(spark, images, ivar=1.0):
    rows = [(m, y, x, float(v[y, x]), float(ivar)) for m, v in images.items() for y in range(v.shape[0]) for x in range(v.shape[1]) if np.isfinite(v[y, x])]
    return spark.createDataFrame(rows, "map_id long, gy int, gx int, flux double, kappa double")


def spot(ny, nx, y, x, sigma, a=1.0):
    yy, xx = np.mgrid[:ny, :nx]
    return a * np.exp(-((yy - y) ** 2 + (xx - x) ** 2) / (2 * sigma * sigma))


def arrays(df, shape, *names):
    out = [np.full(shape, np.nan) for _ in names]
    for r in df.collect():
        for a, n in zip(out, names, strict=True):
            a[r["gy"], r["gx"]] = r[n]
    return out


def test_closing_fills_small_holes_alone(spark):
    hit = np.zeros((30, 40), bool)
    hit[4:26, 4:36] = True
    hit[10, 10] = hit[12, 20] = False
    hit[8:20, 25:33] = False
    rows = spark.createDataFrame([(1, int(y), int(x)) for y, x in np.argwhere(hit)], "map_id long, gy int, gx int")
    got = {(r["gy"], r["gx"]) for r in filters.closed(rows, 30, 40, 2).collect()}
    assert (10, 10) in got and (12, 20) in got and (14, 29) not in got and {(y, x) for y, x in np.argwhere(hit).tolist()} <= got
    assert not any(y < 3 or y > 26 or x < 3 or x > 36 for y, x in got)


def test_factors_follow_the_distance(spark):
    image = np.ones((20, 30))
    image[5, 5] = np.nan
    image[12, 22] = 50.0
    ready = filters.apodised(frame(spark, {1: image}), 20, 30, edge=4, hole=3, bright=10, bright_radius=2)
    e, h = arrays(ready, (20, 30), "edge", "hole")
    ramp = lambda d, w: 0.5 - 0.5 * np.cos(np.pi * min(1, d / w))
    assert e[10, 0] == pytest.approx(ramp(1, 4)) and e[10, 12] == 1 and e[5, 7] == pytest.approx(ramp(2, 4)) and np.isnan(e[5, 5])
    assert h[12, 22] == h[12, 20] == 0 and h[12, 19] == pytest.approx(ramp(1, 3)) and h[12, 15] == 1
    seeds = spark.createDataFrame([(1, 3, 3)], "map_id long, gy int, gx int")
    (h,) = arrays(filters.apodised(frame(spark, {1: image}), 20, 30, masked=seeds), (20, 30), "hole")
    assert h[3, 3] == 0 and h[3, 4] == 1


def test_white_noise_has_a_flat_spectrum_of_one(spark):
    rng = np.random.default_rng(1)
    image = rng.normal(size=(96, 128)) / 2
    image[20:24, 30:40] = np.nan
    ready = filters.apodised(frame(spark, {1: image, 2: 3 * image}, 4.0), 96, 128, edge=6)
    got = filters.noise_spectrum(ready, 96, 128, 1.0, block=32, lres=(2000, 2000)).collect()
    one, nine = ({(r["by"], r["bx"]): (r["power"], r["n"]) for r in got if r["map_id"] == m} for m in (1, 2))
    assert sum(n for _, n in one.values()) == 96 * 128
    assert all(abs(p - 1) < 5 / np.sqrt(n) for p, n in one.values())
    assert all(nine[k][0] == pytest.approx(9 * one[k][0]) for k in one)


def test_tiles_merge_to_the_whole(spark):
    """Halos are wider than the beam, so tiles with both axes cut give what one tile gives."""
    rng = np.random.default_rng(2)
    ny, nx = 120, 160
    image = 5 * spot(ny, nx, 40, 70, 2.2) + 4 * spot(ny, nx, 90, 20, 2.2) + 0.2 * rng.normal(size=(ny, nx))
    image[60:63, 100:104] = np.nan
    pixels = frame(spark, {1: image}, 25.0)
    how = {"step_arcmin": 0.5, "fwhm_arcmin": 2.2 * filters.SIGMA_TO_FWHM * 0.5, "measured": False, "knee": 300.0, "edge": 6, "closing": 3}
    whole = arrays(filters.filter_maps(pixels, ny, nx, block=400, overlap=0, **how), (ny, nx), "rho", "kappa")
    parts = arrays(filters.filter_maps(pixels, ny, nx, block=64, overlap=32, **how), (ny, nx), "rho", "kappa")
    assert (np.isnan(whole[0]) == np.isnan(parts[0])).all() and np.isfinite(whole[0]).all()
    assert np.abs(parts[1] - whole[1]).max() < 0.02 * whole[1].max()
    assert np.abs(parts[0] - whole[0])[8:-8, 8:-8].max() < 0.03 * whole[0].max()
    snr = parts[0] / np.sqrt(np.maximum(parts[1], 1e-30))
    assert np.unravel_index(np.argmax(snr), snr.shape) == (40, 70)


def test_measured_noise_brings_out_sources(spark):
    """Correlated noise is weighed down: a source stands out more than with one level of noise, and its flux comes back."""
    rng = np.random.default_rng(3)
    ny, nx = 96, 96
    ky, kx = np.meshgrid(np.fft.fftfreq(ny), np.fft.fftfreq(nx), indexing="ij")
    red = np.fft.ifft2(np.fft.fft2(rng.normal(size=(ny, nx))) / np.maximum(np.hypot(ky, kx), 0.01) ** 1.2).real
    image = red / red.std() + 0.2 * rng.normal(size=(ny, nx)) + 4 * spot(ny, nx, 50, 40, 2.0)
    pixels = frame(spark, {1: image, 2: np.full((ny, nx), np.nan) * 0 + image})
    how = {"step_arcmin": 0.5, "fwhm_arcmin": 2.0 * filters.SIGMA_TO_FWHM * 0.5, "block": 48, "overlap": 16, "edge": 4, "window": False}
    seen = {}
    for measured in (True, False):
        got = filters.filter_maps(pixels, ny, nx, measured=measured, knee=1e-6, lres=(500, 500), **how).where("map_id = 1")
        rho, kappa = arrays(got, (ny, nx), "rho", "kappa")
        snr = rho / np.sqrt(kappa)
        inner = snr[10:-10, 10:-10]
        seen[measured] = snr[50, 40] / np.median(np.abs(inner))
        if measured:
            # a filter for a beam of unit integral in Fourier space: the flux is that of the profile
            assert 0.5 < rho[50, 40] / kappa[50, 40] / (4 * 2 * np.pi * 2.0**2) < 1.5
    assert seen[True] > 1.5 * seen[False]


def test_rows_follow_the_declination_and_profiles_their_transform():
    ly, lx = filters.multipoles(64, 64, 1.0, 60.0)
    assert np.allclose(lx, 2 * ly)
    r = np.linspace(0, 12, 600)
    gauss = filters.beam_of(ly, ly, (1.0, 1.0), 2.0, None, False)
    table = filters.beam_of(ly, ly, (1.0, 1.0), None, (r, np.exp(-0.5 * (r / (2.0 / filters.SIGMA_TO_FWHM)) ** 2)), False)
    assert np.abs(gauss - table).max() < 2e-3
    assert (filters.beam_of(ly, ly, (1.0 * filters.ARCMIN,) * 2, 2.0, None, True) <= gauss + 1e-12).all()
    with pytest.raises(ValueError, match="beam"):
        filters.filter_maps(None, 4, 4, 1.0)


def test_no_tile_holds_a_row_of_a_wide_map(spark):
    wide = spark.range(4000).select(F.lit(1).cast("long").alias("map_id"), F.lit(0).alias("gy"), F.col("id").cast("int").alias("gx"))
    sizes = filters.tiled(wide, 1, 4000, 512, 64).groupBy("ty", "tx").count().collect()
    assert len(sizes) == 9 and max(r["count"] for r in sizes) <= 512 + 64
