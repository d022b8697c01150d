"""Files, simulated maps, the pipeline and streams, end to end."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.functions.sky import FWHM_PER_SIGMA
from skyquarry.operators import maps
from skyquarry.plans import pipeline, simulate
from skyquarry.plans.views import view
from skyquarry.sources import fits, tables
from skyquarry.streaming import streams


def test_fits_round_trip(spark, tmp_path):
    data = np.arange(12.0).reshape(3, 4)
    keys = {"CRVAL1": 10.0, "CRPIX1": 1.0, "CDELT1": -0.5, "CRVAL2": 0.0, "CRPIX2": 1.0, "CDELT2": 0.5, "BUNIT": "Jy"}
    (tmp_path / "a.fits").write_bytes(fits.encoded(data, keys))
    (tmp_path / "b.fits").write_bytes(fits.encoded(data * 2, keys))
    got = fits.read_pixels(spark, str(tmp_path)).where(F.col("path").contains("a.fits")).collect()
    assert {(r["gy"], r["gx"]): r["value"] for r in got} == {(y, x): data[y, x] for y in range(3) for x in range(4)}
    assert fits.read_pixels(spark, str(tmp_path / "a.fits"), (1, 3, 0, 2)).count() == 4
    head = fits.read_headers(spark, str(tmp_path)).first()
    assert (head["ny"], head["nx"], head["unit"], head["res_deg"], head["cdelt_ra"]) == (3, 4, "Jy", 0.5, -0.5)
    both = fits.read_map(spark, {"rho": str(tmp_path / "a.fits"), "kappa": str(tmp_path / "b.fits")})
    assert both.where("kappa = 2 * rho").count() == 12
    (tmp_path / "c.fits").write_bytes(fits.encoded(np.ones((2, 4)), keys))
    with pytest.raises(Exception, match="another shape"):
        fits.read_map(spark, {"rho": str(tmp_path / "a.fits"), "kappa": str(tmp_path / "c.fits")}).collect()
    fits.write_maps(both.withColumn("map_id", F.lit("m")), ["rho"], 3, 4, str(tmp_path / "out"))
    assert (tmp_path / "out" / "m_rho.fits").read_bytes() == fits.encoded(data)


def test_catalogs(spark, tmp_path):
    (tmp_path / "c.csv").write_text("flux,ra,dec\n0.5,10.0,-1.0\n0.03,11.0,2.0\n")
    got = tables.catalog(spark, str(tmp_path / "c.csv"), "csv", 0.03).collect()
    assert [(r["source_id"], r["flux_mjy"]) for r in got] == [("src_10.0000_-1.0000", 500.0)]
    (tmp_path / "c.json").write_text('{"name": "x", "ra": 1.0, "dec": 2.0, "flux": 40, "err_flux": 1}\n')
    assert tables.catalog(spark, str(tmp_path / "c.json"), "json", 0.04).count() == 1
    with pytest.raises(ValueError, match="unknown catalog"):
        tables.catalog(spark, "x", "pickle")
    df = spark.createDataFrame([("1", "a"), ("2.5", "b"), (None, "3")], "n string, s string")
    assert [t for _, t in tables.numeric_where_all(df).dtypes] == ["double", "string"]
    lines = spark.createDataFrame([(1, i, v) for i, v in enumerate(["head", "$$SOE", " a, 1 ", "b,2", "$$EOE", "tail"])], "f int, n int, value string")
    assert [r["fields"] for r in tables.ephemeris_lines(lines, F.col("n"), "f").orderBy("n").collect()] == [["a", "1"], ["b", "2"]]


def test_simulated_sky_is_found_and_sifted(spark, tmp_path):
    """Four sources over a noisy sky: all found, two in the catalog matched, the others new in both bands and grouped."""
    geometry = {"crval_ra": 10.0, "crpix_x": 121.0, "cdelt_ra": -0.5 / 60, "crpix_y": 61.0, "cdelt_dec": 0.5 / 60}
    pix = simulate.grid(spark, 1.0, 0.5, (10.0, 0.0)).select("gy", "gx")
    assert pix.count() == 240 * 120
    sky_ = None
    for k, band in enumerate(("f090", "f150")):
        one = simulate.noise_map(pix, 0.01, seed=10 * k, start=1e9).withColumns({"map_id": F.lit(band), "freq": F.lit(band), "arr": F.lit("a")})
        sky_ = one if sky_ is None else sky_.unionByName(one)
    spots = [(30, 40), (60, 120), (90, 200), (30, 180)]
    rows = [(b, y, x, 10.0, 4.4 / FWHM_PER_SIGMA) for b in ("f090", "f150") for y, x in spots]
    model = maps.rendered(spark.createDataFrame(rows, "map_id string, gy int, gx int, amplitude double, sigma double"), 10)
    sky_ = simulate.injected(sky_, model, 0.01).withColumns({"kappa": F.lit(1e4), "mask": F.lit(1)})
    sky_.withColumn("rho", F.col("flux") * F.col("kappa")).select("map_id", "freq", "arr", "gy", "gx", "rho", "kappa", "t_unix", "mask").write.parquet(str(tmp_path / "pixels"))
    at = [((10.0 + (x - 120) * -0.5 / 60) % 360, (y - 60) * 0.5 / 60) for y, x in spots]
    spark.createDataFrame([(i, *at[i], 10_000.0) for i in (0, 1)], "source_id long, ra_deg double, dec_deg double, flux_mjy double").write.parquet(str(tmp_path / "catalog"))
    config = {"pixels": str(tmp_path / "pixels"), "catalog": str(tmp_path / "catalog"), "output": str(tmp_path / "out"), "geometry": geometry, "preprocessors": [{"kind": "kappa_clean"}], "postprocessors": [{"kind": "mask"}], "search": {"snr": 6.0, "at_least": 4, "radius_pix": 8.0}, "sifter": {"kind": "default", "at_1jy_arcmin": 0.15}}
    (tmp_path / "c.json").write_text(json.dumps(config))
    settings = pipeline.Settings.read(str(tmp_path / "c.json"))
    out = pipeline.run(spark, settings)
    got = out["sifted"].collect()
    assert sorted((r["map_id"], r["class"]) for r in got) == sorted((f"{b}_a", c) for b in ("f090", "f150") for c in ("source", "source", "transient", "transient"))
    assert all(8_000 < r["flux_mjy"] < 12_000 for r in got)
    assert out["pairs"].count() == 2
    (tmp_path / "bad.json").write_text(json.dumps(config | {"scipy": 1}))
    with pytest.raises(ValueError, match="unknown settings"):
        pipeline.Settings.read(str(tmp_path / "bad.json"))


def test_simulated_sources(spark):
    s = simulate.sources(spark, 2000, (350.0, 20.0, -10.0, 30.0), (0.01, 1.0), 0.75)
    got = s.agg(F.min("dec_deg"), F.max("dec_deg"), F.sum(F.col("in_catalog").cast("int")), F.count_if((F.col("ra_deg") > 20) & (F.col("ra_deg") < 350)), F.min("flux_jy"), F.max("flux_jy")).first()
    assert -10 <= got[0] < -9 and 29 < got[1] <= 30 and got[2] == 1500 and got[3] == 0 and got[4] >= 0.01 and got[5] <= 1
    f = simulate.flux_at(simulate.flares(s, (0.0, 10.0), (1.0, 2.0)), F.lit(5.0))
    assert 0 < f.count() <= 2000 and f.where("flux_now > flux_jy").count() == 0
    with pytest.raises(ValueError):
        simulate.grid(spark, 0.0, 1.0)
    with pytest.raises(ValueError):
        simulate.sources(spark, 1, (0.0, 1.0, 0.0, 1.0), (0.0, 1.0), 1.5)
    stats = simulate.noise_map(simulate.grid(spark, 1.0, 1.0), 0.01).agg(F.avg("flux"), F.stddev("flux")).first()
    assert abs(stats[0]) < 1e-3 and abs(stats[1] - 0.01) < 1e-3


def curves(spark, small, tmp_path, parts=3):
    at = str(tmp_path / "curves")
    df = view(spark, small, "light_curves")
    times = [r[0] for r in df.selectExpr(f"percentile(t_unix, array({', '.join(str(i / parts) for i in range(1, parts))}))").collect()][0]
    for i, (lo, hi) in enumerate(zip([-1e12, *times], [*times, 1e12])):
        df.where((F.col("t_unix") > lo) & (F.col("t_unix") <= hi)).coalesce(1).write.mode("append").parquet(at)
        for n in os.listdir(at):
            if n.endswith(".parquet"):
                os.utime(f"{at}/{n}") if n not in seen_files else None
                seen_files.add(n)
    return at, df


seen_files: set = set()


def test_streamed_alerts_equal_batch_alerts(spark, small, tmp_path):
    from skyquarry.plans import queries

    at, df = curves(spark, small, tmp_path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)
    got = streams.drained(streams.flare_alerts(stream), str(tmp_path / "alerts"), str(tmp_path / "cp"))
    want = {r["event_id"] for r in queries.flare_alert(spark, small).where("alert").collect()}
    assert {r["event_id"] for r in got.collect()} == want


def test_streamed_coadd_equals_batch(spark, small, tmp_path):
    df = view(spark, small, "pixels_raw")
    at = str(tmp_path / "pixels")
    df.repartition(3).write.parquet(at)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)
    q = streams.upsert_each(streams.growing_coadd(stream), str(tmp_path / "table"), ["freq", "arr", "gy", "gx"], str(tmp_path / "cp"))
    q.awaitTermination()
    last = max(int(n.partition("=")[2]) for n in os.listdir(tmp_path / "table"))
    got = streams.upserted(spark, str(tmp_path / "table"))
    want = maps.coadd(df)
    assert last == 2 and got.count() == want.count()
    both = got.select("freq", "arr", "gy", "gx", F.round("rho", 4).alias("rho"), "kappa")
    assert both.exceptAll(want.select("freq", "arr", "gy", "gx", F.round("rho", 4).alias("rho"), "kappa")).where("false").count() == 0
    assert abs(got.agg(F.sum("rho")).first()[0] - df.agg(F.sum("rho")).first()[0]) < 1e-6


def test_windows_close_and_repeats_go(spark, small, tmp_path):
    df = view(spark, small, "pixels_raw").select("freq", "arr", "gy", "gx", "rho", "kappa", "t_unix")
    df.orderBy("t_unix").coalesce(1).write.parquet(str(tmp_path / "p"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "p"))
    got = streams.drained(streams.windowed_coadd(stream, "30 days"), str(tmp_path / "w"), str(tmp_path / "cw"))
    assert got.count() > 0 and got.select("window").distinct().count() > 10
    one = streams.drained(streams.without_repeats(stream.withColumn("k", F.lit(1)), "k", "10000 days"), str(tmp_path / "d"), str(tmp_path / "cd"))
    assert one.count() == 1


def test_an_upsert_rewrites_only_the_parts_it_touches(spark, tmp_path):
    df = spark.createDataFrame([(i, 1, "a") for i in range(200)], "k long, v long, w string")
    at = str(tmp_path / "in")
    df.coalesce(1).write.parquet(at)
    spark.createDataFrame([(7, 2, "a"), (7, 3, "b"), (900, 5, "c")], df.schema).coalesce(1).write.mode("append").parquet(at)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)
    streams.upsert_each(stream, str(tmp_path / "t"), ["k"], str(tmp_path / "c")).awaitTermination()
    got = {r["k"]: (r["v"], r["w"]) for r in streams.upserted(spark, str(tmp_path / "t")).collect()}
    assert got == {i: (1, "a") for i in range(200)} | {7: (3, "b"), 900: (5, "c")}
    assert len([n for n in os.listdir(tmp_path / "t" / "upsert_version=1") if n.startswith("upsert_part=")]) <= 2


def test_an_upserted_table_keeps_two_versions_of_a_part(spark, tmp_path):
    at, want = str(tmp_path / "in"), {}
    for n in range(6):
        # the last files touch few keys, so that old versions of the other parts stay
        rows = [(k, n, "x") for k in (range(40) if n < 3 else range(n))]
        want |= {k: n for k, _, _ in rows}
        spark.createDataFrame(rows, "k long, v long, w string").coalesce(1).write.mode("append").parquet(at)
    stream = spark.readStream.schema("k long, v long, w string").option("maxFilesPerTrigger", 1).parquet(at)
    streams.upsert_each(stream, str(tmp_path / "t"), ["k"], str(tmp_path / "c"), parts=8).awaitTermination()
    assert {r["k"]: r["v"] for r in streams.upserted(spark, str(tmp_path / "t")).collect()} == want
    held = [(v, p) for v in os.listdir(tmp_path / "t") for p in os.listdir(tmp_path / "t" / v) if p.startswith("upsert_part=")]
    assert all(sum(p == part for _, p in held) <= 2 for _, part in held)
    # a batch that runs again reads what was there before it
    assert streams._live(spark, str(tmp_path / "t"), 5) != streams._live(spark, str(tmp_path / "t"))
    assert {r["k"]: r["v"] for r in streams._parts(spark, str(tmp_path / "t"), streams._live(spark, str(tmp_path / "t"), 5)).collect()} == want | {k: 4 for k in range(4)} | ({4: 2})


def test_measured_noise_filters_like_the_known_one():
    import numpy as np

    from skyquarry.operators import kernels

    rng = np.random.default_rng(5)
    y, x = np.mgrid[:96, :96]
    image = 8 * np.exp(-((y - 40) ** 2 + (x - 50) ** 2) / (2 * 1.7**2)) + rng.normal(0, 1, (96, 96))
    ivar = np.ones_like(image)
    image[10, 10], ivar[10, 10] = np.nan, 0
    for kw in ({"measured": (8, 8)}, {"measured": (8, 8), "apod": 6}, {}):
        rho, kappa = kernels.matched_filter(image, ivar, 4.0, **kw)
        snr = rho / np.sqrt(np.maximum(kappa, 1e-9))
        assert np.unravel_index(snr[8:-8, 8:-8].argmax(), (80, 80)) == (32, 42)
        assert abs((rho / np.maximum(kappa, 1e-9))[40, 50] / (8 * 2 * np.pi * 1.7**2) - 1) < 0.15  # rho over kappa is the whole flux
    weight = kernels.noise_weight(rng.normal(0, 2, (64, 64)), np.full((64, 64), 0.25), (8, 8))
    assert abs(weight.mean() - 1) < 0.05 and weight.std() < 0.2


def test_polynomial_pointing_of_order_two_keeps_its_digits(spark):
    import numpy as np

    from skyquarry.operators import kernels

    rng = np.random.default_rng(2)
    ra, dec = 350 + rng.random(400) * 8, -41 + rng.random(400) * 3
    offset = 0.01 + 2e-3 * (ra - 354) - 1e-3 * (dec + 40) + 4e-4 * (ra - 354) ** 2
    rows = [(1, i, float(a), float(d), 20.0, float(o), float(o) / 2) for i, (a, d, o) in enumerate(zip(ra, dec, offset))]
    df = spark.createDataFrame(rows, "map_id long, source_id long, ra_deg double, dec_deg double, snr double, offset_ra double, offset_dec double")
    found = kernels.polynomial_pointing(df, 2).first()
    terms = [(i, j) for i in range(3) for j in range(3 - i)]
    fitted = sum(c * ra**i * dec**j for c, (i, j) in zip(found["ra_coef"], terms))
    assert found["n_sources"] > 380 and np.abs(fitted - offset).max() < 1e-8
