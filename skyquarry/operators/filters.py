"""Matched filtering of maps on two-dimensional tiles, with masks, apodising and a noise spectrum measured on the maps.

A map is cut into tiles with halos along both axes, whose ramps add to one, so that a task holds a tile and never a whole
row. Frequencies are multipoles: along rows they follow the declination of the tile. The noise spectrum is the mean of
the tiles' periodograms over blocks of multipoles; each tile's blocks are rows, which Spark averages by key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquarry.operators.distance import with_distance
from skyquarry.operators.kernels import SIGMA_TO_FWHM, ramps
from skyquarry.sources.tables import saved

ARCMIN = np.pi / 180.0 / 60.0


def grid_of(maps: DataFrame, ny: int, nx: int) -> DataFrame:
    """(map_id, gy, gx) of every pixel of the distinct map_id of maps."""
    rows = maps.select("map_id").distinct().withColumn("gy", F.explode(F.sequence(F.lit(0), F.lit(ny - 1))))
    return rows.withColumn("gx", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))))


def closed(hits: DataFrame, ny: int, nx: int, radius: float) -> DataFrame:
    """(map_id, gy, gx) of the hit pixels with holes up to twice the radius filled: grown by the radius, then shrunk by it."""
    grown = saved(with_distance(grid_of(hits, ny, nx), hits, radius), "grown")
    inside, beyond = grown.where("distance is not null").drop("distance"), grown.where("distance is null").drop("distance")
    return with_distance(inside, beyond, radius).where("distance is null").drop("distance")


def cosine_ramp(distance: Column, width: float) -> Column:
    """0 at distance 0, 1 from the width on (and where there is no distance, as nothing is near)."""
    if width <= 0:
        return F.lit(1.0)
    return F.coalesce(0.5 - 0.5 * F.cos(F.lit(np.pi) * F.least(distance / width, F.lit(1.0))), F.lit(1.0))


def apodised(pixels: DataFrame, ny: int, nx: int, closing: float = 0, edge: float = 0, hole: float = 0, bright: float | None = None, bright_radius: float = 0, masked: DataFrame | None = None, image: str = "flux", ivar: str = "kappa") -> DataFrame:
    """(map_id, gy, gx, v, w, edge, hole) of pixels: image and weight, and the factors by distance from the edge and from masked pixels.

    A pixel is hit if it is finite with a weight over 0; small holes are closed over `closing` pixels and count as inside, with
    weight 0. The edge factor rises over `edge` pixels from the footprint's or the image's border. Masked are the rows of
    `masked`, and everything within bright_radius of a pixel whose absolute value is over `bright`; the hole factor is 0
    there and rises over `hole` pixels. Pixels that are not finite count as 0.
    """
    v, w = F.col(image).cast("double"), F.col(ivar).cast("double")
    finite = ~F.isnan(v) & ~F.isnan(w) & (F.abs(v) < float("inf")) & (w < float("inf")) & (w > 0)
    rows = pixels.select("map_id", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx"), F.when(finite, v).otherwise(0.0).alias("v"), F.when(finite, w).otherwise(0.0).alias("w"))
    # each step is read more than once by the next
    rows = saved(rows, "rows")
    hits = rows.where("w > 0").select("map_id", "gy", "gx")
    inside = saved(closed(hits, ny, nx, closing), "inside") if closing > 0 else hits
    out = inside.join(rows, ["map_id", "gy", "gx"], "left").fillna(0.0, ["v", "w"])
    if edge > 0:
        beyond = grid_of(hits, ny, nx).join(inside, ["map_id", "gy", "gx"], "left_anti")
        border = F.least(F.col("gy") + 1, ny - F.col("gy"), F.col("gx") + 1, nx - F.col("gx")).cast("double")
        out = with_distance(out, beyond, edge).withColumn("edge", cosine_ramp(F.least("distance", border), edge)).drop("distance")
    else:
        out = out.withColumn("edge", F.lit(1.0))
    marks = [] if masked is None else [masked.select("map_id", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx"))]
    if bright is not None:
        out = saved(out, "inside")
        near = with_distance(out.select("map_id", "gy", "gx"), out.where(F.abs("v") > bright), bright_radius)
        marks.append(near.where("distance is not null").select("map_id", "gy", "gx"))
    if not marks:
        return out.withColumn("hole", F.lit(1.0))
    every = marks[0] if len(marks) == 1 else marks[0].union(marks[1]).distinct()
    # without a ramp, masked pixels alone lose their weight
    return with_distance(out, every, max(hole, 0)).withColumn("hole", F.when(F.col("distance") == 0, 0.0).otherwise(cosine_ramp(F.col("distance"), hole))).drop("distance")


def tiled(pixels: DataFrame, ny: int, nx: int, block: int, overlap: int) -> DataFrame:
    """pixels in every tile that holds them: ty, tx number the tile's ranges of ramps(ny) and ramps(nx)."""
    for name, column, n in (("ty", "gy", ny), ("tx", "gx", nx)):
        spans = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("s"), F.lit(e).alias("e")) for i, (s, e, _) in enumerate(ramps(n, block, overlap))])
        at = F.col(column)
        here = F.filter(spans, lambda b: (at >= b["s"]) & (at < b["e"]))  # noqa: B023
        pixels = pixels.withColumn(name, F.explode(F.transform(here, lambda b: b["i"])))
    return pixels


def multipoles(ny: int, nx: int, step_arcmin: float, dec_deg: float) -> tuple[np.ndarray, np.ndarray]:
    """Multipoles along columns and rows of a patch of square pixels in right ascension and declination."""
    step = step_arcmin * ARCMIN
    return 2 * np.pi * np.fft.fftfreq(ny, step), 2 * np.pi * np.fft.fftfreq(nx, step * max(1e-3, np.cos(np.radians(dec_deg))))


def blocks_of(ly: np.ndarray, lx: np.ndarray, lres: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of multipoles; a multipole on a border belongs to the upper block, whatever its last digit."""
    return tuple(np.floor(np.abs(v) / r + 1e-9).astype(np.int64) for v, r in ((ly, lres[0]), (lx, lres[1])))


def _patch(part: pd.DataFrame, shape: tuple[int, int], corner: tuple[int, int], *names: str) -> list[np.ndarray]:
    y, x = part["gy"].to_numpy() - corner[0], part["gx"].to_numpy() - corner[1]
    out = []
    for name in names:
        a = np.zeros(shape)
        a[y, x] = part[name].to_numpy()
        out.append(a)
    return out


def noise_spectrum(ready: DataFrame, ny: int, nx: int, step_arcmin: float, block: int = 512, overlap: int = 0, lres: tuple[float, float] = (70, 100), dec0: float = 0.0, ddec: float = 0.0) -> DataFrame:
    """(map_id, by, bx, power, n): the mean power of whitened, apodised pixels over blocks of multipoles, from all tiles of a map.

    ready: what apodised gives. A tile's periodogram is divided by its pixels and by the mean square of its apodising, so
    that white noise of variance 1 / ivar has a power of 1 whatever the mask. The row gy lies at declination dec0 + gy * ddec.
    """
    rows, columns = ramps(ny, block, overlap), ramps(nx, block, overlap)
    kind = ready.schema["map_id"].dataType.simpleString()

    def periodogram(part: pd.DataFrame) -> pd.DataFrame:
        (y0, y1, _), (x0, x1, _) = rows[int(part["ty"].iloc[0])], columns[int(part["tx"].iloc[0])]
        v, w, a = _patch(part.assign(a=part["edge"] * part["hole"]), (y1 - y0, x1 - x0), (y0, x0), "v", "w", "a")
        seen = float((a**2 * (w > 0)).sum())
        if not seen:
            return pd.DataFrame({"map_id": [], "by": [], "bx": [], "power": [], "n": []})
        power = np.abs(np.fft.fft2(v * np.sqrt(w) * a)) ** 2 / seen
        by, bx = blocks_of(*multipoles(*power.shape, step_arcmin, dec0 + ddec * (y0 + y1 - 1) / 2), lres)
        wide = int(bx.max()) + 1
        key = (by[:, None] * wide + bx[None, :]).ravel()
        n = np.bincount(key)
        at = np.flatnonzero(n)
        return pd.DataFrame({"map_id": part["map_id"].iloc[0], "by": at // wide, "bx": at % wide, "power": np.bincount(key, power.ravel())[at], "n": n[at]})

    each = tiled(ready, ny, nx, block, overlap).groupBy("map_id", "ty", "tx").applyInPandas(periodogram, f"map_id {kind}, by long, bx long, power double, n long")
    return each.groupBy("map_id", "by", "bx").agg((F.sum("power") / F.sum("n")).alias("power"), F.sum("n").alias("n"))


def beam_of(ly: np.ndarray, lx: np.ndarray, step: tuple[float, float], fwhm_arcmin: float | None, profile: tuple[np.ndarray, np.ndarray] | None, window: bool) -> np.ndarray:
    """The beam by multipole: a Gaussian's, or that of a profile (radius in arcminutes, response) by its Hankel transform; window: times the pixel's own.

    A profile needs samples close enough to follow the Bessel function up to the largest multipole.
    """
    l = np.hypot(ly[:, None], lx[None, :])
    if profile is None:
        out = np.exp(-0.5 * (l * fwhm_arcmin * ARCMIN / SIGMA_TO_FWHM) ** 2)
    else:
        r, b = np.asarray(profile[0], float) * ARCMIN, np.asarray(profile[1], float)
        knots = np.linspace(0, l.max(), 1024)
        angle = (np.arange(256) + 0.5) * np.pi / 256
        # J0(x) is the mean of cos(x sin(angle)), and its end is the integral of b r J0
        bessel = np.zeros((len(knots), len(r)))
        for s in np.sin(angle):
            bessel += np.cos(knots[:, None] * r[None, :] * s) / len(angle)
        whole = np.trapezoid(bessel * b * r, r, axis=1)
        out = np.interp(l, knots, whole / whole[0])
    if window:
        out = out * np.sinc(ly * step[0] / (2 * np.pi))[:, None] * np.sinc(lx * step[1] / (2 * np.pi))[None, :]
    return out


def filter_maps(pixels: DataFrame, ny: int, nx: int, step_arcmin: float, fwhm_arcmin: float | None = None, block: int = 512, overlap: int = 64, image: str = "flux", ivar: str = "kappa", measured: bool = True, lres: tuple[float, float] = (70, 100), knee: float = 1000.0, alpha: float = -3.5, highpass: bool = False, closing: float = 0, edge: float = 0, hole: float = 0, bright: float | None = None, bright_radius: float = 0, masked: DataFrame | None = None, dec0: float = 0.0, ddec: float = 0.0, profile: tuple[np.ndarray, np.ndarray] | None = None, window: bool = True) -> DataFrame:
    """(map_id, gy, gx, rho, kappa): signal over the beam weighted by the noise, and its inverse variance, of the footprint's pixels.

    The noise is that of noise_spectrum, or, not measured, of one level with a rise to low multipoles as
    1 + (l / knee)^alpha, as highpass adds to the measured one. The tiles' results are merged with their ramps. Distances
    (closing, edge, hole, bright_radius) are in pixels; dec0 and ddec give a row's declination.
    """
    if fwhm_arcmin is None and profile is None:
        raise ValueError("a filter needs a beam: its width or its profile")
    ready = saved(apodised(pixels, ny, nx, closing, edge, hole, bright, bright_radius, masked, image, ivar), "apodised")
    rows, columns = ramps(ny, block, overlap), ramps(nx, block, overlap)
    cut = tiled(ready, ny, nx, block, overlap)
    kind = pixels.schema["map_id"].dataType.simpleString()
    if measured:
        spectrum = noise_spectrum(ready, ny, nx, step_arcmin, block, 0, lres, dec0, ddec)
        one = spectrum.groupBy("map_id").agg(F.collect_list(F.struct("by", "bx", "power")).alias("noise"))  # a map's blocks of multipoles
    else:
        one = ready.select("map_id").distinct().withColumn("noise", F.lit(None).cast("array<struct<by:bigint,bx:bigint,power:double>>"))
    told = cut.select("map_id", "ty", "tx").distinct().join(one, "map_id")
    told = told.select(*[F.col(c).alias(c) for c in told.columns])  # columns of its own, for the cogroup

    def weights(noise, ly: np.ndarray, lx: np.ndarray) -> np.ndarray:
        l = np.maximum(np.hypot(ly[:, None], lx[None, :]), 0.5)
        rise = 1 / (1 + (l / knee) ** alpha)
        if noise is None:
            return rise
        by, bx = (np.array([r[k] for r in noise], np.int64) for k in ("by", "bx"))
        power = np.array([r["power"] for r in noise])
        table = np.full((max(by.max(), 0) + 1, max(bx.max(), 0) + 1), np.inf)
        table[by, bx] = np.maximum(power, 1e-300)
        my, mx = blocks_of(ly, lx, lres)
        out = 1 / table[np.minimum(my, table.shape[0] - 1)[:, None], np.minimum(mx, table.shape[1] - 1)[None, :]]
        return out * rise if highpass else out

    def run(key: tuple, part: pd.DataFrame, noise: pd.DataFrame) -> pd.DataFrame:
        (y0, y1, wy), (x0, x1, wx) = rows[int(key[1])], columns[int(key[2])]
        v, w, a, e = _patch(part.assign(a=part["edge"] * part["hole"]), (y1 - y0, x1 - x0), (y0, x0), "v", "w", "a", "edge")
        dec = dec0 + ddec * (y0 + y1 - 1) / 2
        ly, lx = multipoles(*v.shape, step_arcmin, dec)
        step = step_arcmin * ARCMIN
        beam = beam_of(ly, lx, (step, step * max(1e-3, np.cos(np.radians(dec)))), fwhm_arcmin, profile, window)
        inverse = weights(noise["noise"].iloc[0], ly, lx)
        root = np.sqrt(w * e)
        rho = root * np.fft.ifft2(np.fft.fft2(root * v * a) * beam * inverse).real
        kappa = root**2 * float((beam**2 * inverse).mean())
        y, x = part["gy"].to_numpy() - y0, part["gx"].to_numpy() - x0
        ramp = wy[y] * wx[x]
        return pd.DataFrame({"map_id": key[0], "gy": y + y0, "gx": x + x0, "rho": rho[y, x] * ramp, "kappa": kappa[y, x] * ramp})

    by = ["map_id", "ty", "tx"]
    done = cut.groupBy(*by).cogroup(told.groupBy(*by)).applyInPandas(run, f"map_id {kind}, gy int, gx int, rho double, kappa double")
    return done.groupBy("map_id", "gy", "gx").agg(F.sum("rho").alias("rho"), F.sum("kappa").alias("kappa"))
