"""Simulated maps and sources: every value is a hash of its row and a seed, so that a run can be repeated at any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquarry.functions.sky import flare_flux, hash_uniform, sphere_uniform


def grid(spark: SparkSession, half_width_ra: float, half_width_dec: float, centre=(0.0, 0.0), res_arcmin: float = 0.5) -> DataFrame:
    """Pixels (gy, gx, ra_deg, dec_deg) of a box given by its half-widths in degrees."""
    if half_width_ra <= 0 or half_width_dec <= 0 or abs(centre[1]) + half_width_dec > 90:
        raise ValueError("a map needs positive half-widths within the sphere")
    res = res_arcmin / 60.0
    nx, ny = round(2 * half_width_ra / res), round(2 * half_width_dec / res)
    gx, gy = F.col("id") % nx, F.floor(F.col("id") / nx)
    rows = spark.range(nx * ny).select(gy.cast("int").alias("gy"), gx.cast("int").alias("gx"))
    return rows.withColumns({"ra_deg": F.pmod(F.lit(centre[0] + half_width_ra) - (F.col("gx") + 0.5) * res, F.lit(360.0)), "dec_deg": F.lit(centre[1] - half_width_dec) + (F.col("gy") + 0.5) * res})


def normal(seed: int, *cols) -> Column:
    """A unit Gaussian from two hashed uniforms."""
    u, v = hash_uniform(seed, *cols), hash_uniform(seed + 1, *cols)
    return F.sqrt(-2.0 * F.log(1.0 - u)) * F.cos(2.0 * math.pi * v)


def noise_map(pixels: DataFrame, noise_jy: float, seed: int = 0, start: float = 0.0, length: float = 600.0) -> DataFrame:
    """flux, snr, hits and time of an empty sky: time runs along x, and by a small step along y."""
    flux = normal(seed, F.col("gy"), F.col("gx")) * noise_jy
    snr = flux / noise_jy if noise_jy > 0 else F.lit(1.0)
    ends = pixels.agg((F.max("gx") + 1).alias("_nx"), (F.max("gy") + 1).alias("_ny"))
    t = F.lit(start) + (F.col("gx") + F.col("gy") / F.col("_ny")) / F.col("_nx") * length
    return pixels.join(F.broadcast(ends)).withColumns({"flux": flux, "snr": snr, "hits": F.lit(1), "t_unix": t}).drop("_nx", "_ny")  # ends is one row


def sources(spark: SparkSession, n: int, box: tuple[float, float, float, float], flux_jy: tuple[float, float], catalog_fraction: float = 1.0, seed: int = 0) -> DataFrame:
    """Fixed sources uniform on the sphere within box (ra_min, ra_max, dec_min, dec_max); the first int(n * fraction) are in the catalog."""
    if not 0 <= catalog_fraction <= 1:
        raise ValueError("a fraction lies between 0 and 1")
    i = F.col("id")
    ra, dec = sphere_uniform(hash_uniform(seed, i), hash_uniform(seed + 1, i), *box)
    return spark.range(n).select(i.alias("source_id"), ra.alias("ra_deg"), dec.alias("dec_deg"), (F.lit(flux_jy[0]) + hash_uniform(seed + 2, i) * (flux_jy[1] - flux_jy[0])).alias("flux_jy"), (i < int(n * catalog_fraction)).alias("in_catalog"))


def flares(fixed: DataFrame, peak: tuple[float, float], width_s: tuple[float, float], seed: int = 100) -> DataFrame:
    """Gaussian flares at the sources' places: peak time and width uniform in their ranges, flux_jy the amplitude."""
    u = lambda k, r: F.lit(r[0]) + hash_uniform(seed + k, F.col("source_id")) * (r[1] - r[0])
    return fixed.withColumns({"t_peak": u(0, peak), "width_s": u(1, width_s)})


def flux_at(flaring: DataFrame, t: Column) -> DataFrame:
    """Flares within three widths of their peak, with their flux at t."""
    near = flaring.where(F.abs(F.col("t_peak") - t) <= 3 * F.col("width_s"))
    return near.withColumn("flux_now", flare_flux(F.col("flux_jy"), t, F.col("t_peak"), F.col("width_s")))


def injected(pixels: DataFrame, model: DataFrame, noise_jy: float) -> DataFrame:
    """pixels with a rendered model (map_id, gy, gx, model) added to flux, and snr to match."""
    out = pixels.join(model, ["map_id", "gy", "gx"], "left").withColumn("flux", F.col("flux") + F.coalesce("model", F.lit(0.0))).drop("model")
    return out.withColumn("snr", F.col("flux") / noise_jy) if noise_jy > 0 else out
