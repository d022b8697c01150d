"""One run through all stages of the pipeline, and what a second run finds left to do."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquarry.functions.sky import FWHM_PER_SIGMA
from skyquarry.operators import state
from skyquarry.plans import pipeline
from skyquarry.sources import fits

GRID = {"crval_ra": 10.0, "crpix_x": 101.0, "cdelt_ra": -0.5 / 60, "crpix_y": 51.0, "cdelt_dec": 0.5 / 60}
NY, NX = 100, 200


def sky_at(y, x):
    return (10.0 + (x - 100) * -0.5 / 60) % 360, (y - 50) * 0.5 / 60


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Two bands of three maps each: 14 catalog sources, displaced by (1.2, -0.8) pixels, and two new ones."""
    at = tmp_path_factory.mktemp("runner")
    rng = np.random.default_rng(8)
    known = [(15 + 35 * (k // 7) + int(rng.integers(-4, 5)), 18 + 27 * (k % 7), 1.0 + 0.1 * k) for k in range(14)]
    new = [(82, 60, 3.0), (32, 150, 2.5)]
    yy, xx = np.mgrid[:NY, :NX]
    sigma = 4.4 / FWHM_PER_SIGMA
    truth = sum(f * np.exp(-((yy - y - 1.2) ** 2 + (xx - x + 0.8) ** 2) / (2 * sigma**2)) for y, x, f in [*known, *new])
    rows = []
    for m in range(6):
        image = truth + rng.normal(0, 0.02 * np.sqrt(3), truth.shape)
        rows.append(spark.createDataFrame([(m, "f090" if m < 3 else "f150", "a", int(y), int(x), float(image[y, x]) * 1e4 / 12, 1e4 / 12, 1e9 + m, 1) for y in range(NY) for x in range(NX)], "map_id long, freq string, arr string, gy int, gx int, rho double, kappa double, t_unix double, mask int"))
    for r in rows:
        r.write.mode("append").parquet(f"{at}/pixels")
    spark.createDataFrame([(k, *sky_at(y, x), f * 1e3) for k, (y, x, f) in enumerate(known)], "source_id long, ra_deg double, dec_deg double, flux_mjy double").write.parquet(f"{at}/catalog")
    spark.createDataFrame([(m, "f090" if m < 3 else "f150", "a", 1e9 + m, 1e9 + m + 60) for m in range(6)], "map_id long, freq string, arr string, obs_start double, obs_end double").write.parquet(f"{at}/maps")
    s = pipeline.Settings(
        pixels=f"{at}/pixels", catalog=f"{at}/catalog", output=f"{at}/out", geometry=GRID,
        preprocessors=[{"kind": "kappa_clean"}], postprocessors=[{"kind": "mask"}],
        claim={"maps": f"{at}/maps", "events": f"{at}/events", "days": None},
        pointing={"order": 0, "snr": 5.0, "half": 6, "fwhm_pix": 4.4, "models": f"{at}/models"},
        forced={"half": 6, "fwhm_pix": 4.4, "allow": 2.0}, subtract={"kind": "fitted", "half": 10},
        errors={"fwhm": 2.2 / 60, "ra_jitter": 0.001, "dec_jitter": 0.001}, retest={"half": 15, "inner": 6.0},
        search={"snr": 8.0, "at_least": 4, "radius_pix": 6.0, "contrast": 0.05}, sifter={"kind": "default", "at_1jy_arcmin": 0.5},
        map_output={"layers": ["flux", "snr"], "ny": NY, "nx": NX},
    )
    return at, s, known, new, pipeline.run(spark, s, now=1e9 + 1000)


def test_every_stage_gives_its_results(spark, ran):
    at, s, known, new, out = ran
    models = {r["map_id"]: r for r in out["pointing"].collect()}
    assert set(models) == {"f090_a", "f150_a"}
    for r in models.values():
        # within a tenth of an arcminute
        assert r["ra_coef"][0] * 60 == pytest.approx(-0.8 * -0.5, abs=0.1) and r["dec_coef"][0] * 60 == pytest.approx(1.2 * 0.5, abs=0.1)
    forced = out["forced"].collect()
    assert len(forced) == 28 and not any(r["failed"] for r in forced)
    for r in forced:
        assert r["flux_mjy"] == pytest.approx(known[r["source_id"]][2] * 1e3, rel=0.2)
        assert np.hypot(r["offset_ra"] * 60 - 0.4, r["offset_dec"] * 60 - 0.6) < 0.9
    # what was fitted is gone from the map: only the new ones are found, at their pointed places
    sifted = out["sifted"].collect()
    assert sorted((r["map_id"], r["class"]) for r in sifted) == sorted((m, "transient") for m in models for _ in new)
    for r in sifted:
        near = min(np.hypot((r["ra_deg"] - a + 180) % 360 - 180, r["dec_deg"] - d) for a, d in (sky_at(y, x) for y, x, _ in new))
        assert near * 60 < 0.25 and r["err_ra_deg"] >= 0.001 and r["new_snr"] > 5
    assert out["pairs"].count() == 2
    assert sorted(n for n in os.listdir(f"{at}/out/maps")) == [f"{m}_{c}.fits" for m in sorted(models) for c in ("flux", "snr")]
    assert fits.read_pixels(spark, f"{at}/out/maps/f090_a_flux.fits").count() == NY * NX


def test_maps_are_claimed_and_ended_and_models_used_again(spark, ran):
    at, s, known, new, _ = ran
    events = spark.read.parquet(f"{at}/events")
    assert {(r["map_id"], r["status"]) for r in state.current(events).collect()} == {(str(m), "completed") for m in range(6)}
    again = pipeline.claimed(spark, s.claim, 1e9 + 2000)
    assert again.count() == 0
    assert pipeline.claimed(spark, s.claim | {"rerun": True, "most": 2}, 1e9 + 2000).count() == 2
    # claimed and not ended: nobody else gets them until the lease is over
    busy = state.unclaimed(spark.read.parquet(f"{at}/maps").withColumn("map_id", F.col("map_id").cast("string")), state.current(spark.read.parquet(f"{at}/events")), 1e9 + 2100)
    assert busy.count() == 0
    late = state.unclaimed(spark.read.parquet(f"{at}/maps").withColumn("map_id", F.col("map_id").cast("string")), state.current(spark.read.parquet(f"{at}/events")), 1e9 + 2000 + 7201)
    assert late.count() == 2
    # a map with a kept model is not fitted again
    flat = spark.createDataFrame([("f090_a", y, x, 0.0) for y in range(20) for x in range(20)], "map_id string, gy int, gx int, flux double")
    models = pipeline.pointing_models(spark, spark.read.parquet(s.catalog).select("source_id", F.col("ra_deg").alias("cat_ra"), F.col("dec_deg").alias("cat_dec"), F.col("flux_mjy").alias("cat_flux")), flat, s)
    assert models.where("map_id = 'f090_a'").count() == 1


def test_an_end_without_a_start_raises(spark):
    maps = spark.createDataFrame([("x",)], "map_id string")
    with pytest.raises(Exception, match="never started: x"):
        state.ends(spark.createDataFrame([], state.EVENTS), maps, 5.0).collect()
    begun = state.starts(maps, 4.0)
    done = state.ends(begun, maps, 4.0)
    assert state.current(begun.unionByName(done)).first()["status"] == "completed"
