"""The map pipeline from a JSON document.

    python -m skyquarry.plans.pipeline -c config.json

Its stages, in this order: claim of the maps to process, coadd, cleaning, pointing (fits of bright catalog sources, a model
for each map, which is kept and used again), forced photometry at the pointed positions, subtraction of what was fitted (or
of the catalog), blind search with deblending, pointed positions and their errors, sifting, re-test of new sources against
the noise around them, results, maps as FITS, groups across maps, and the end of the claim. A stage left out is the identity.
"""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquarry.functions import names, sky
from skyquarry.operators import groups, kernels, maps, sift, stamps, state
from skyquarry.sources import fits
from skyquarry.sources.tables import saved


@dataclass
class Settings:
    """What a run needs; an unknown key is refused."""

    pixels: str
    catalog: str
    output: str
    keys: list[str] = field(default_factory=lambda: ["freq", "arr"])
    geometry: dict = field(default_factory=lambda: {"crval_ra": 0.0, "crpix_x": 1.0, "cdelt_ra": -0.5 / 60, "crpix_y": 1.0, "cdelt_dec": 0.5 / 60})
    preprocessors: list[dict] = field(default_factory=list)
    postprocessors: list[dict] = field(default_factory=list)
    #: Paths of a table of maps and of the events of their processing, and what next_maps takes (days, most, rerun).
    claim: dict | None = None
    #: Of the pointing: order, snr, half, fwhm_pix, and the path of kept models. Of the photometry: half, fwhm_pix, allow.
    pointing: dict | None = None
    forced: dict | None = None
    #: fwhm_pix for the catalog's own fluxes, or {"kind": "fitted"}.
    subtract: dict | None = None
    #: fwhm, ra_jitter and dec_jitter in degrees; half, inner, snr and ratio of the re-test.
    errors: dict | None = None
    retest: dict | None = None
    #: Layers, ny and nx of the maps that are written.
    map_output: dict | None = None
    search: dict = field(default_factory=lambda: {"snr": 5.0, "at_least": 2, "radius_pix": 4.0})
    sifter: dict = field(default_factory=lambda: {"kind": "default", "at_1jy_arcmin": 30.0})
    crossmatch_arcmin: float = 1.5
    output_format: str = "parquet"

    @classmethod
    def read(cls, path: str) -> Settings:
        with open(path) as f:
            given = json.load(f)
        unknown = given.keys() - {x.name for x in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**given)


#: Steps by tag: before flux and snr are made, and after.
PREPROCESSORS = {
    "kappa_clean": lambda df, fraction=1e-3: maps.kappa_clean(df, fraction),
    "clean_map": lambda df, fraction=0.05, cut_on="median": maps.clean_map(df, fraction, cut_on),
    "edge_mask": lambda df, pixels=2, least=1e-12: maps.near_any(df, df.where(F.col("kappa") < least), pixels).where("not hit").drop("hit"),
}
POSTPROCESSORS = {
    "mask": lambda df: maps.masked(df, F.col("mask"), "flux", "snr"),
    "tile_flat_field": lambda df, size=60: maps.tile_normalised(df, maps.tile_of(size)).withColumn("snr", F.col("normalised")).drop("normalised", "factor", "tile"),
}


def staged(df: DataFrame, steps: list[dict], known: dict) -> DataFrame:
    for step in steps:
        args = dict(step)
        kind = args.pop("kind")
        if kind not in known:
            raise ValueError(f"unknown step {kind}")
        df = known[kind](df, **args)
    return df


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def claimed(spark: SparkSession, claim: dict, now: float) -> DataFrame:
    """The maps to process, whose start is written down before anything else is done with them."""
    known = table_or_none(spark, claim["events"], state.EVENTS)
    asked = spark.read.parquet(claim["maps"]).withColumn("map_id", F.col("map_id").cast("string"))
    chosen = state.next_maps(asked, state.current(known), now, **{k: claim[k] for k in ("days", "most", "rerun") if k in claim})
    chosen = saved(chosen.select("map_id"), "claimed")
    state.starts(chosen, now).write.mode("append").parquet(claim["events"])
    return chosen


def degrees_between(a, b):
    return F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0


def measured(catalog: DataFrame, pixels: DataFrame, s: Settings, how: dict, models: DataFrame | None = None) -> DataFrame:
    """Gaussian fits of the catalog's sources in each map, at the places where its pointing model puts them.

    map_id, source_id, the catalog's position and flux, what kernels.fitted gives, and y, x, ra_deg, dec_deg, flux_mjy,
    err_flux_mjy, snr and the offsets from the catalog. Sources without a pixel in a map are left out.
    """
    half = int(how.get("half", 6))
    every = catalog.join(F.broadcast(pixels.select("map_id").distinct()))  # the coadded maps: one for each of the keys' values
    at = every.withColumns({"ra_deg": F.col("cat_ra"), "dec_deg": F.col("cat_dec")})
    if models is not None:
        at = stamps.pointed(at, models).withColumns({"ra_deg": 2 * F.col("ra_deg") - F.col("ra_pointed"), "dec_deg": 2 * F.col("dec_deg") - F.col("dec_pointed")}).drop("ra_pointed", "dec_pointed")
    gy, gx = sky.pixel(F.col("ra_deg"), F.col("dec_deg"), **s.geometry)
    at = at.select("map_id", "source_id", "cat_ra", "cat_dec", "cat_flux", gy.alias("gy"), gx.alias("gx"))
    images = stamps.as_arrays(stamps.thumbnails(at, pixels, half), half).withColumn("fit_id", F.concat_ws("/", "map_id", "source_id"))
    size = 2 * half + 1
    fits_ = kernels.fitted(images, "fit_id", "image", size, size, float(how.get("fwhm_pix", 4.0)), how.get("allow"))
    found = at.withColumn("fit_id", F.concat_ws("/", "map_id", "source_id")).join(fits_, "fit_id").drop("fit_id")
    found = found.withColumns({"y": F.col("gy") - half + F.col("y0"), "x": F.col("gx") - half + F.col("x0")})
    ra, dec = sky.position(F.col("y"), F.col("x"), **s.geometry)
    found = found.withColumns({"ra_deg": ra, "dec_deg": dec, "flux_mjy": F.col("amplitude") * 1e3, "err_flux_mjy": F.col("err_amplitude") * 1e3, "snr": F.try_divide("amplitude", "err_amplitude")})
    return found.withColumns({"offset_ra": degrees_between(F.col("ra_deg"), F.col("cat_ra")), "offset_dec": F.col("dec_deg") - F.col("cat_dec")})


MODELS = "map_id string, n_sources long, ra_coef array<double>, dec_coef array<double>"


def pointing_models(spark: SparkSession, catalog: DataFrame, pixels: DataFrame, s: Settings) -> DataFrame:
    """A pointing model for each map: the kept one, or one that is fitted to the catalog's sources and then kept."""
    how = s.pointing
    kept = table_or_none(spark, how["models"], MODELS) if how.get("models") else spark.createDataFrame([], MODELS)
    new = pixels.join(kept.select("map_id").distinct(), "map_id", "left_anti")
    good = measured(catalog, new, s, how).where("not failed and amplitude > 0").select("map_id", "source_id", F.col("cat_ra").alias("ra_deg"), F.col("cat_dec").alias("dec_deg"), "snr", "offset_ra", "offset_dec")
    found = saved(kernels.polynomial_pointing(good, int(how.get("order", 0)), float(how.get("snr", 5.0))).selectExpr("map_id", "n_sources", "ra_coef", "dec_coef"), "pointing")
    kept = saved(kept, "kept")
    if how.get("models"):
        found.write.mode("append").parquet(how["models"])
    return kept.unionByName(found)


def detections(pixels: DataFrame, s: Settings, models: DataFrame | None = None) -> DataFrame:
    """Regions over the threshold (deblended, with a contrast), the weaker of two near ones dropped, with pointed positions, errors and names."""
    found = kernels.regions(pixels, "snr", s.search["snr"], s.search["at_least"], contrast=s.search.get("contrast"))
    peaks = found.withColumn("v", F.col("peak")).withColumn("peak_id", F.col("label"))
    kept = maps.greedy_suppressed(peaks, F.lit(float(s.search["radius_pix"]))).select("map_id", "peak_id")
    found = found.join(kept.withColumnRenamed("peak_id", "label"), ["map_id", "label"], "left_semi")
    ra, dec = sky.position(F.col("y"), F.col("x"), **s.geometry)
    at = found.withColumns({"ra_deg": ra, "dec_deg": dec, "gy": F.rint("y").cast("int"), "gx": F.rint("x").cast("int"), "snr": F.col("peak")})
    if models is not None:
        at = stamps.pointed(at, models).withColumns({"ra_deg": F.pmod("ra_pointed", F.lit(360.0)), "dec_deg": F.col("dec_pointed")}).drop("ra_pointed", "dec_pointed")
    at = at.join(pixels.select("map_id", "gy", "gx", "flux", "t_mean"), ["map_id", "gy", "gx"], "left")
    res = abs(s.geometry["cdelt_dec"])
    err_ra = F.col("sigma_major") * res / F.cos(F.radians("dec_deg")) / F.col("snr")
    at = at.withColumns({"det_id": F.sha2(F.concat_ws("/", "map_id", "label"), 256), "flux_mjy": F.col("flux") * 1e3, "err_ra_deg": err_ra, "err_dec_deg": F.col("sigma_major") * res / F.col("snr")})
    if s.errors:
        told = at.withColumns({"err_flux_mjy": F.try_divide("flux_mjy", "snr"), "err_ra": F.col("err_ra_deg"), "err_dec": F.col("err_dec_deg")})
        told = sift.with_errors(told, float(s.errors["fwhm"]), float(s.errors["ra_jitter"]), float(s.errors["dec_jitter"]))
        at = told.withColumns({"err_ra_deg": F.col("err_ra"), "err_dec_deg": F.col("err_dec")}).drop("err_ra", "err_dec", "err_flux_mjy")
    return at.withColumn("name", names.iau_name(F.col("ra_deg"), F.col("dec_deg")))


def run(spark: SparkSession, s: Settings, now: float | None = None) -> dict[str, DataFrame]:
    """Writes the results of every stage that is asked for; returns them as read back: sifted, pairs, and forced and pointing where made."""
    now = time.time() if now is None else now
    out: dict[str, DataFrame] = {}

    def kept(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).format(s.output_format).mode("append" if s.claim else "errorifexists").save(f"{s.output}/{name}")
        out[name] = spark.read.format(s.output_format).schema(df.schema).load(f"{s.output}/{name}")
        return out[name]

    raw = spark.read.parquet(s.pixels)
    chosen = claimed(spark, s.claim, now) if s.claim else None
    if chosen is not None:
        raw = raw.join(chosen.withColumn("_id", F.col("map_id")).select("_id"), F.col("map_id").cast("string") == F.col("_id"), "left_semi")
    raw = staged(raw, s.preprocessors, PREPROCESSORS)
    whole = maps.coadd(raw, tuple(s.keys)).withColumn("map_id", F.concat_ws("_", *s.keys))
    pixels = staged(maps.with_flux_snr(whole), s.postprocessors, POSTPROCESSORS)
    catalog = spark.read.parquet(s.catalog).select("source_id", F.col("ra_deg").alias("cat_ra"), F.col("dec_deg").alias("cat_dec"), F.col("flux_mjy").alias("cat_flux"))
    if s.pointing or s.forced:
        pixels = saved(pixels, "pixels")  # read by every stage
    models = pointing_models(spark, catalog, pixels, s) if s.pointing else None
    if models is not None:
        kept(models, "pointing")
    fitted = kept(measured(catalog, pixels, s, s.forced, models), "forced", "map_id") if s.forced else None
    searched = pixels
    if s.subtract and s.subtract.get("kind") == "fitted":
        if fitted is None:
            raise ValueError("a subtraction of fitted sources needs forced photometry")
        good = fitted.where("not failed and amplitude > 0").join(pixels.select("map_id").distinct(), "map_id", "left_semi")
        searched = maps.subtracted(pixels, maps.rendered_at(good, int(s.subtract.get("half", 12))))
    elif s.subtract:
        gy, gx = sky.pixel(F.col("cat_ra"), F.col("cat_dec"), **s.geometry)
        placed = catalog.select(gy.alias("gy"), gx.alias("gx"), (F.col("cat_flux") / 1e3).alias("amplitude"), F.lit(float(s.subtract["fwhm_pix"]) / sky.FWHM_PER_SIGMA).alias("sigma"))
        every = placed.join(F.broadcast(pixels.select("map_id").distinct()))  # the coadded maps: one for each of the keys' values
        searched = maps.subtracted(pixels, maps.rendered(every, int(s.subtract.get("half", 3 * s.subtract["fwhm_pix"]))))
    found = saved(detections(searched, s, models), "detections")
    kept(found, "detections", "map_id")
    if s.sifter["kind"] == "simple":
        sifted = sift.simple(found, catalog, s.sifter["radius_arcmin"] / 60.0)
    else:
        cut = (F.col("flux_mjy") <= 0) | sift.range_cut(s.sifter.get("cuts", {}))
        sifted = sift.default(found, catalog, cut, at_1jy_arcmin=s.sifter["at_1jy_arcmin"])
    if s.retest:
        how = s.retest
        again = sift.retested(sifted.withColumn("peak", F.col("flux")), searched, int(how["half"]), F.lit(float(how["inner"])), float(how.get("snr", 5.0)), float(how.get("ratio", 10.0)))
        sifted = again.withColumn("peak", F.col("snr"))
    sifted = saved(sifted, "sifted")
    kept(sifted, "sifted", "map_id")
    if s.map_output:
        fits.write_maps(pixels, list(s.map_output["layers"]), int(s.map_output["ny"]), int(s.map_output["nx"]), f"{s.output}/maps")
    order = sifted.select("map_id").distinct().withColumn("map_ord", F.xxhash64("map_id"))
    new = sifted.where(F.col("class") == "transient").join(order, "map_id").withColumn("det_id", F.xxhash64("det_id"))
    kept(groups.pairwise(new, s.crossmatch_arcmin / 60.0), "pairs")
    if chosen is not None:
        state.ends(table_or_none(spark, s.claim["events"], state.EVENTS), chosen, now).write.mode("append").parquet(s.claim["events"])
    return {k: v for k, v in out.items() if k != "detections"}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Coadd, search and sift maps.")
    parser.add_argument("-c", "--config", required=True)
    settings = Settings.read(parser.parse_args(args).config)
    spark = SparkSession.builder.appName("sky maps").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    run(spark, settings)


if __name__ == "__main__":
    main()
