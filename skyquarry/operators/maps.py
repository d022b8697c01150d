"""Operators on map pixels: cleaning, masks, coadds, tiles and noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquarry.functions import sky

#: Quantile of the normal distribution at 3/4: median absolute value of a unit Gaussian.
NORMAL_Q75 = 0.6744897501960817
#: Radius in pixels up to which a seed's disc, of at most 29 pixels, is written out; beyond, the distance transform's cost is lower.
DISC = 3


def with_flux_snr(pixels: DataFrame) -> DataFrame:
    return pixels.withColumns({"flux": sky.flux(F.col("rho"), F.col("kappa")), "snr": sky.snr(F.col("rho"), F.col("kappa")), "dflux": sky.flux_error(F.col("kappa"))})


def with_intensity(pixels: DataFrame, filtered: bool = False) -> DataFrame:
    """flux, snr and hits of pixels with an intensity and its inverse variance: snr is T * sqrt(ivar), and a filtered map holds rho and kappa. A pixel is hit if its weight is over 0 or its flux is not 0."""
    t, w = F.col("intensity"), F.col("ivar")
    flux = F.when(w == 0, 0.0).otherwise(F.try_divide(t, w)) if filtered else t
    snr = F.when(w <= 0, 0.0).otherwise(F.try_divide(t, F.sqrt(w)) if filtered else t * F.sqrt(w))
    return pixels.withColumns({"flux": flux, "snr": snr}).withColumn("hits", F.coalesce((w > 0) | (F.abs("flux") > 0), F.lit(False)).cast("int"))


def outside(valid_pixels: DataFrame, ny: int, nx: int, by: str = "map_id") -> DataFrame:
    """(map_id, gy, gx) of the grid's pixels outside the footprint: those that are not valid and reach the border over such; holes are inside."""
    from skyquarry.operators.kernels import labelled

    grid = valid_pixels.select(by).distinct().withColumn("gy", F.explode(F.sequence(F.lit(0), F.lit(ny - 1)))).withColumn("gx", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))))
    bad = grid.join(valid_pixels.select(by, "gy", "gx").distinct(), [by, "gy", "gx"], "left_anti")
    marked = labelled(bad.withColumnRenamed(by, "map_id"), diagonal=False)
    edge = (F.col("gy") == 0) | (F.col("gx") == 0) | (F.col("gy") == ny - 1) | (F.col("gx") == nx - 1)
    return marked.join(marked.where(edge).select("map_id", "label").distinct(), ["map_id", "label"], "left_semi").select("map_id", "gy", "gx")


def edge_mask(pixels: DataFrame, valid_pixels: DataFrame, ny: int, nx: int, distance: int) -> DataFrame:
    """pixels with edge: 1 where every pixel outside the filled footprint is farther than `distance`, else 0."""
    return near_any(pixels, outside(valid_pixels, ny, nx), distance).withColumn("edge", F.when(F.col("hit"), 0).otherwise(1)).drop("hit")


def mask_product(pixels: DataFrame, values: list[str], masks: list[str]) -> DataFrame:
    """values times all masks; a null mask keeps the pixel."""
    m = F.lit(1)
    for name in masks:
        m = m * F.coalesce(F.col(name), F.lit(1))
    return pixels.withColumns({v: F.col(v) * m for v in values})


def centre_of_mass(sources: DataFrame, pixels: DataFrame, half: int, radius: float, tolerance: float = 1e-4, snr_at_least: float = 3.0) -> DataFrame:
    """sources (map_id, source_id, gy, gx) with (y, x), the centre of mass of snr^2 over the region of strong pixels at their pixel.

    Strong is an snr over the least one, with kappa at least tolerance of the map's maximum, within radius pixels; a
    region is 4-connected. Without a region at its pixel a source keeps its own. A place's box is one small array.
    """
    import numpy as np
    import pandas as pd

    from skyquarry.operators.stamps import one_a_place, thumbnails

    top = pixels.groupBy("map_id").agg(F.max("kappa").alias("_top"))
    floor = F.greatest(F.col("kappa"), F.when(F.col("_top") == 0, 1.0).otherwise(F.col("_top")) * tolerance)
    strong = pixels.join(top, "map_id").withColumn("sn2", F.col("rho") * F.col("rho") / floor)
    ones = one_a_place(sources)
    near = thumbnails(ones, strong, half, "sn2").where((F.col("v") > snr_at_least**2) & (F.sqrt(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")) < radius))
    boxes = near.groupBy("map_id", "source_id").agg(F.collect_list(F.struct("dy", "dx", "v")).alias("box"))
    size = 2 * half + 1

    def kernel(it):
        for pdf in it:
            out = []
            for box in pdf["box"]:
                image = np.zeros((size + 2, size + 2))
                for p in box:
                    image[p["dy"] + half + 1, p["dx"] + half + 1] = p["v"]
                region = np.zeros_like(image, bool)
                region[half + 1, half + 1] = image[half + 1, half + 1] > 0
                while True:
                    grown = region.copy()
                    grown[1:] |= region[:-1]
                    grown[:-1] |= region[1:]
                    grown[:, 1:] |= region[:, :-1]
                    grown[:, :-1] |= region[:, 1:]
                    grown &= image > 0
                    if (grown == region).all():
                        break
                    region = grown
                y, x = np.nonzero(region)
                w = image[y, x]
                out.append((float((w * (y - half - 1)).sum() / w.sum()), float((w * (x - half - 1)).sum() / w.sum())) if len(w) else (0.0, 0.0))
            yield pd.DataFrame({"map_id": pdf["map_id"], "source_id": pdf["source_id"], "oy": [o[0] for o in out], "ox": [o[1] for o in out]})

    kinds = {f.name: f.dataType.simpleString() for f in sources.schema.fields}
    moved = boxes.mapInPandas(kernel, f"map_id {kinds['map_id']}, source_id {kinds['source_id']}, oy double, ox double")
    moved = ones.hint("merge").join(moved, ["map_id", "source_id"]).drop("source_id")
    out = sources.hint("merge").join(moved, ["map_id", "gy", "gx"], "left")
    return out.withColumns({"y": F.col("gy") + F.coalesce("oy", F.lit(0.0)), "x": F.col("gx") + F.coalesce("ox", F.lit(0.0))}).drop("oy", "ox")


def valid(weight: Column, mask: Column | None = None) -> Column:
    ok = weight.isNotNull() & ~F.isnan(weight) & (weight > 0) & (weight < F.lit(float("inf")))
    return ok & (F.coalesce(mask, F.lit(1)) > 0) if mask is not None else ok


def masked(pixels: DataFrame, mask: Column, *names: str) -> DataFrame:
    """names times the mask; a null mask keeps the pixel."""
    return pixels.withColumns({n: F.col(n) * F.coalesce(mask, F.lit(1)) for n in names})


def kappa_clean(pixels: DataFrame, fraction: float = 1e-3, by: str = "map_id") -> DataFrame:
    """kappa raised to a fraction of its map's maximum, and 0 where rho is 0."""
    top = pixels.where(~F.isnan("kappa")).groupBy(by).agg(F.max("kappa").alias("_top"))
    floor = F.greatest(F.col("kappa"), F.col("_top") * fraction)
    return pixels.join(top, by).withColumn("kappa", F.when(F.col("rho") == 0, 0.0).otherwise(floor)).drop("_top")


def percentile_cuts(values: DataFrame, by: str, fraction: float, margin: float = 1e-3, accuracy: int = 10_000) -> DataFrame:
    """The exact percentile of `v` of each group, interpolated between ranks, as (by, level). Null and NaN values do not count.

    A sketch gives two values around the rank; counts below and between them tell in which stretch it is, and only that
    stretch's distinct values are ranked. No group has to fit one buffer, and a bad sketch costs time, never the result.
    """
    rows = values.where("v is not null and not isnan(v)").select(by, F.col("v").cast("double").alias("v"))
    ends = F.percentile_approx("v", [max(0.0, fraction - margin), min(1.0, fraction + margin)], accuracy)
    return ranked_between(rows, by, fraction, rows.groupBy(by).agg(ends.alias("ends")))


def ranked_between(rows: DataFrame, by: str, fraction: float, ends: DataFrame) -> DataFrame:
    """percentile_cuts by the two values `ends` of each group, wherever they are."""
    part = F.when(F.col("v") < F.col("ends")[0], 0).when(F.col("v") <= F.col("ends")[1], 1).otherwise(2)
    placed = rows.join(ends, by).withColumn("part", part)
    total = placed.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col("part") == 0).alias("n0"), F.count_if(F.col("part") <= 1).alias("n1"))
    total = total.withColumn("rank", F.lit(fraction) * (F.col("n") - 1)).withColumns({"low": F.floor("rank"), "high": F.ceil("rank")})
    within = lambda k: F.when(F.col(k) < F.col("n0"), 0).when(F.col(k) < F.col("n1"), 1).otherwise(2)
    total = total.withColumns({"first": within("low"), "last": within("high")}).withColumn("before", F.when(F.col("first") == 0, 0).when(F.col("first") == 1, F.col("n0")).otherwise(F.col("n1")))
    stretch = placed.join(total, by).where("part between first and last").groupBy(by, "v", "rank", "low", "high", "before").agg(F.count("*").alias("c"))
    upto = F.col("before") + F.sum("c").over(Window.partitionBy(by).orderBy("v"))
    at = stretch.withColumn("upto", upto).groupBy(by, "rank", "low", "high").agg(F.min(F.when(F.col("upto") > F.col("low"), F.col("v"))).alias("a"), F.min(F.when(F.col("upto") > F.col("high"), F.col("v"))).alias("b"))
    level = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.col("high") - F.col("rank")) * F.col("a") + (F.col("rank") - F.col("low")) * F.col("b"))
    return at.select(by, level.alias("level"))


def clean_levels(pixels: DataFrame, fraction: float = 0.05, cut_on: str = "median", weight: str = "kappa", by: str = "map_id") -> DataFrame:
    """(by, level): a fraction of each map's median or maximum weight, or that percentile. Other names mean the maximum."""
    weights = pixels.select(by, F.col(weight).alias("v"))
    if cut_on in ("median", "percentile"):
        times = fraction if cut_on == "median" else 1.0
        return percentile_cuts(weights, by, 0.5 if cut_on == "median" else fraction).withColumn("level", F.col("level") * times)
    return weights.where(~F.isnan("v")).groupBy(by).agg((F.max("v") * fraction).alias("level"))


def clean_map(pixels: DataFrame, fraction: float = 0.05, cut_on: str = "median", weight: str = "kappa", by: str = "map_id") -> DataFrame:
    """rho is 0 where the weight is under its map's level. Maps without a weight stay as they are."""
    cut = clean_levels(pixels, fraction, cut_on, weight, by).select(F.col(by).alias("_of"), F.col("level").alias("_cut"))
    kept = pixels.join(cut, F.col(by) == F.col("_of"), "left")
    return kept.withColumn("rho", F.when(F.col(weight) < F.col("_cut"), 0.0).otherwise(F.col("rho"))).select(*[F.col(f"`{c}`") for c in pixels.columns])


def coadd(pixels: DataFrame, keys=("freq", "arr")) -> DataFrame:
    """Pixel sums of rho, kappa and hits over the union footprint, with first, mean and last time; the mean is weighted by hits."""
    hit = F.when(F.col("kappa") > 0, 1).otherwise(0)
    return pixels.groupBy(*keys, "gy", "gx").agg(
        F.sum("rho").alias("rho"), F.sum("kappa").alias("kappa"), F.sum(hit).alias("hits"), F.max(F.when(F.col("mask") > 0, 1).otherwise(0)).alias("mask"),
        F.min(F.when(hit > 0, F.col("t_unix"))).alias("t_first"), F.avg(F.when(hit > 0, F.col("t_unix"))).alias("t_mean"), F.max(F.when(hit > 0, F.col("t_unix"))).alias("t_last"), F.count_distinct("map_id").alias("n_maps"),
    )


def coadd_groupings(pixels: DataFrame) -> DataFrame:
    """Coadds by band and array and by band over all arrays ("coadd"), from one pass of partial sums."""
    fine = pixels.groupBy("freq", "arr", "gy", "gx").agg(F.sum("rho").alias("rho"), F.sum("kappa").alias("kappa"), F.count("*").alias("hits"))
    return fine.groupingSets([("freq", "arr", "gy", "gx"), ("freq", "gy", "gx")], "freq", "arr", "gy", "gx").agg(F.sum("rho").alias("rho"), F.sum("kappa").alias("kappa"), F.sum("hits").alias("hits")).withColumn("arr", F.coalesce("arr", F.lit("coadd")))


def tile_of(size: int) -> Column:
    return F.floor(F.col("gy") / size) * 100_000 + F.floor(F.col("gx") / size)


def tile_normalised(pixels: DataFrame, tile: Column, value: str = "snr") -> DataFrame:
    """value times the tile's factor, so that its median absolute value is a unit Gaussian's; 0 where that is undefined."""
    tiled = pixels.withColumn("tile", tile)
    rms = tiled.groupBy("map_id", "tile").agg(F.median(F.col(value) * F.col(value)).alias("_m"))
    factor = F.when(F.col("_m") > 0, F.try_divide(F.lit(NORMAL_Q75), F.sqrt("_m"))).otherwise(0.0)
    return tiled.join(rms, ["map_id", "tile"]).withColumn("factor", factor).withColumn("normalised", F.col(value) * F.col("factor")).drop("_m")


def tile_rms(pixels: DataFrame, tile: Column, value: str = "snr") -> DataFrame:
    """Root median square per tile, and the median and mean of the tiles' that are not 0, per map."""
    w = Window.partitionBy("map_id")
    per = pixels.withColumn("tile", tile).groupBy("map_id", "tile").agg(F.sqrt(F.median(F.col(value) * F.col(value))).alias("rms"))
    some = F.when(F.col("rms") != 0, F.col("rms"))
    return per.withColumns({"median_rms": F.median(some).over(w), "mean_rms": F.avg(some).over(w)})


def clip_marks(rows: DataFrame, values: dict[str, str], by: list[str], sigma: float = 3.0, rounds: int = 5) -> DataFrame:
    """rows with a boolean column for each of values (mark: value): whether the value survives `rounds` clips within `by`.

    A clip keeps what lies within sigma population deviations of the median of what the one before kept. All rounds of
    all values are windows over one partitioning, so that rows are read, shuffled and sorted once. Null values are not kept.
    """
    rows = rows.withColumns({m: F.col(v).isNotNull() for m, v in values.items()})
    for _ in range(rounds):
        inside = {m: F.when(F.col(m), F.col(v)) for m, v in values.items()}
        levels = {f"_c_{m}": F.median(x) for m, x in inside.items()} | {f"_s_{m}": F.stddev_pop(x) for m, x in inside.items()}
        if by:
            rows = rows.withColumns({name: x.over(Window.partitionBy(*by)) for name, x in levels.items()})
        else:  # without keys a round is one row of two numbers a value
            found = rows.agg(*[x.alias(name) for name, x in levels.items()]).first()
            rows = rows.withColumns({name: F.lit(found[name]).cast("double") for name in levels})
        kept = {m: F.col(m) & F.coalesce(F.abs(F.col(v) - F.col(f"_c_{m}")) <= sigma * F.col(f"_s_{m}"), F.lit(False)) for m, v in values.items()}
        rows = rows.withColumns(kept).drop(*levels)
    return rows


def sigma_clip(rows: DataFrame, value: str, by: list[str], sigma: float = 3.0, rounds: int = 5) -> DataFrame:
    """rows that survive `rounds` clips around the median by the population deviation, within `by`."""
    return clip_marks(rows, {"_in": value}, by, sigma, rounds).where("_in").drop("_in")


def block_rms(pixels: DataFrame, size: int, value: str = "flux", sigma: float = 3.0, rounds: int = 3) -> DataFrame:
    """Clipped deviation per block, relative to the median of the map's blocks."""
    blocks = pixels.where(F.col(value) != 0).withColumns({"by": F.floor(F.col("gy") / size), "bx": F.floor(F.col("gx") / size)})
    kept = sigma_clip(blocks, value, ["map_id", "by", "bx"], sigma, rounds)
    per = kept.groupBy("map_id", "by", "bx").agg(F.stddev_pop(value).alias("rms"), F.count("*").alias("n"))
    return per.withColumn("relative", F.try_divide(F.col("rms"), F.median("rms").over(Window.partitionBy("map_id"))))


def flat_fielded(pixels: DataFrame, size: int, value: str = "flux", sigma: float = 3.0, rounds: int = 3) -> DataFrame:
    """pixels with relative_rms, the map's coarse noise brought back to every pixel, and their snr divided by it.

    block_rms is the coarse map. Between the middles of its blocks the relative noise is linear along both axes; blocks
    without a value do not count, and a pixel of which none of the four has one keeps its snr.
    """
    coarse = block_rms(pixels, size, value, sigma, rounds).select("map_id", F.col("by").alias("_by"), F.col("bx").alias("_bx"), F.col("relative").alias("_r")).where("_r > 0")
    ends = lambda c: (F.col(c) + 0.5) / size - 0.5
    near = pixels.select("map_id", "gy", "gx").distinct()
    for axis, c in (("_by", "gy"), ("_bx", "gx")):
        low = F.floor(ends(c))
        pair = F.array(F.struct(low.alias("i"), (1.0 - (ends(c) - low)).alias("w")), F.struct((low + 1).alias("i"), (ends(c) - low).alias("w")))
        near = near.withColumn(f"{axis}w", F.explode(pair)).withColumn(axis, F.col(f"{axis}w.i")).withColumn(f"{axis}w", F.col(f"{axis}w.w"))
    w = F.col("_byw") * F.col("_bxw")
    found = near.where(w > 0).join(coarse, ["map_id", "_by", "_bx"]).groupBy("map_id", "gy", "gx").agg((F.sum(w * F.col("_r")) / F.sum(w)).alias("relative_rms"))
    return pixels.join(found, ["map_id", "gy", "gx"], "left").withColumn("snr", F.col("snr") / F.coalesce("relative_rms", F.lit(1.0)))


def annulus_snr(sources: DataFrame, pixels: DataFrame, half: int, inner: Column, snr_cut: float = 5.0, ratio_cut: float = 10.0, value: str = "flux") -> DataFrame:
    """sources (map_id, source_id, gy, gx, peak, snr) with the noise of the box around them outside `inner` pixels, and the new snr.

    Noise is measured once for every place and inner radius. Sources are never broadcast.
    """
    size = 2 * half + 1
    cell = lambda c: F.floor(F.col(c) / size)
    sources = sources.withColumn("_in", inner)
    place = ["map_id", "gy", "gx", "_in"]
    spread = sources.select(*place).distinct().withColumn("_dy", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).withColumn("_dx", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    spread = spread.select("map_id", F.col("gy").alias("sy"), F.col("gx").alias("sx"), "_in", (cell("gy") + F.col("_dy")).alias("_cy"), (cell("gx") + F.col("_dx")).alias("_cx"))
    near = spread.hint("merge").join(pixels.select("map_id", "gy", "gx", value).withColumns({"_cy": cell("gy"), "_cx": cell("gx")}), ["map_id", "_cy", "_cx"])
    dy, dx = F.col("gy") - F.col("sy"), F.col("gx") - F.col("sx")
    ring = near.where((F.abs(dy) <= half) & (F.abs(dx) <= half) & (F.sqrt(dy * dy + dx * dx) >= F.col("_in")) & ~F.isnan(value))
    noise = ring.groupBy("map_id", F.col("sy").alias("gy"), F.col("sx").alias("gx"), "_in").agg(F.stddev_pop(value).alias("rms"), F.count("*").alias("n_pixels"))
    out = sources.hint("merge").join(noise, place, "left").drop("_in").withColumn("new_snr", F.when(F.col("rms") > 0, F.try_divide(F.col("peak"), F.col("rms"))))
    return out.withColumn("kept", F.coalesce((F.col("new_snr") > snr_cut) & (F.try_divide(F.col("snr"), F.col("new_snr")) < ratio_cut), F.lit(False)))


def near_any(pixels: DataFrame, seeds: DataFrame, radius: int, box: bool = False) -> DataFrame:
    """pixels with `hit`: whether a seed pixel of the map lies within radius (or in the box of that half-width)."""
    from skyquarry.operators.distance import nearest_seed

    if box:  # along one axis, then along the other
        steps = F.sequence(F.lit(-radius), F.lit(radius))
        grown = seeds.select("map_id", "gx", F.explode(F.transform(steps, lambda d: (F.col("gy") + d).cast("int"))).alias("gy")).distinct()
        grown = grown.select("map_id", "gy", F.explode(F.transform(steps, lambda d: (F.col("gx") + d).cast("int"))).alias("gx")).distinct()
    elif radius <= DISC:
        disc = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in range(-radius, radius + 1) for x in range(-radius, radius + 1) if y * y + x * x <= radius * radius])
        grown = seeds.select("map_id", "gy", "gx").distinct().withColumn("_d", F.explode(disc))
        grown = grown.select("map_id", (F.col("gy") + F.col("_d.y")).cast("int").alias("gy"), (F.col("gx") + F.col("_d.x")).cast("int").alias("gx")).distinct()
    else:
        grown = nearest_seed(pixels, seeds, radius).drop("distance")
    return pixels.join(grown.withColumn("hit", F.lit(True)), ["map_id", "gy", "gx"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def rendered(sources: DataFrame, half: int) -> DataFrame:
    """Model image: the sum per pixel of each source's Gaussian (gy, gx, amplitude, sigma) over its window."""
    span = F.sequence(F.lit(-half), F.lit(half))
    pix = sources.withColumn("_dy", F.explode(span)).withColumn("_dx", F.explode(span))
    y, x = (F.col("gy") + F.col("_dy")).cast("int"), (F.col("gx") + F.col("_dx")).cast("int")
    value = sky.gaussian_2d(F.col("_dx"), F.col("_dy"), F.col("amplitude"), 0.0, 0.0, F.col("sigma"), F.col("sigma"), 0.0, 0.0)
    return pix.select("map_id", y.alias("gy"), x.alias("gx"), value.alias("v")).groupBy("map_id", "gy", "gx").agg(F.sum("v").alias("model"))


def rendered_at(sources: DataFrame, half: int) -> DataFrame:
    """Model image of sources between pixels: the sum of each one's elliptic Gaussian (y, x, amplitude, sigma_x, sigma_y, theta) over its window."""
    span = F.sequence(F.lit(-half), F.lit(half))
    near = sources.withColumns({"_y": F.rint("y").cast("int"), "_x": F.rint("x").cast("int")}).withColumn("_dy", F.explode(span)).withColumn("_dx", F.explode(span))
    gy, gx = F.col("_y") + F.col("_dy"), F.col("_x") + F.col("_dx")
    value = sky.gaussian_2d(gx - F.col("x"), gy - F.col("y"), F.col("amplitude"), 0.0, 0.0, F.col("sigma_x"), F.col("sigma_y"), F.col("theta"), 0.0)
    return near.select("map_id", gy.alias("gy"), gx.alias("gx"), value.alias("v")).groupBy("map_id", "gy", "gx").agg(F.sum("v").alias("model"))


def subtracted(pixels: DataFrame, model: DataFrame) -> DataFrame:
    """flux less the model, and snr 0 where the model is not."""
    joined = pixels.join(model, ["map_id", "gy", "gx"], "left").withColumn("model", F.coalesce("model", F.lit(0.0)))
    return joined.withColumns({"flux": F.col("flux") - F.col("model"), "snr": F.when(F.abs("model") > 1e-8, 0.0).otherwise(F.col("snr"))})


def coadd_windows(maps: DataFrame, days: float, time: str = "obs_start", by=("freq", "arr")) -> DataFrame:
    """Tumbling windows from each group's first map; a map on the last edge belongs to the last window. 0 days: one window."""
    w = Window.partitionBy(*by)
    first, last = F.min(time).over(w), F.max(time).over(w)
    if days <= 0:
        return maps.withColumn("bin", F.lit(0).cast("long"))
    width = float(days) * 86400.0
    bins = F.greatest(F.lit(1).cast("long"), F.ceil((last - first) / width))
    return maps.withColumn("bin", F.least(F.floor((F.col(time) - first) / width), bins - 1))


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """Fixed-width bins over the range of value; the last one is closed."""
    ends = rows.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.when(width == 0, 0).otherwise(F.least(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(bins - 1)))
    return rows.join(F.broadcast(ends)).where(F.col(value).isNotNull()).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))  # ends is one row


def greedy_suppressed(peaks: DataFrame, radius: Column) -> DataFrame:
    """Peaks kept per map: strongest first, one is dropped if a kept one lies within its own radius. Needs map_id, peak_id, x, y, v.

    Peaks meet by cells as wide as the largest radius. In every round, a table in the shared folder, those with a kept
    stronger neighbour go, and those whose stronger neighbours have all gone stay; there are as many rounds as the longest chain.

    Of peaks at one place with one radius only the strongest takes part: if it is kept the others go by it, and what
    drops it drops them. So as many peaks at few places are as few.
    """
    from skyquarry.sources.tables import saved

    order = F.struct(F.col("v").isNull().alias("none"), (-F.col("v")).alias("k"), "peak_id", "x", "y", F.col("r").alias("r"), F.col("row").alias("row"))
    rows = peaks.select("map_id", "peak_id", "x", "y", "v", radius.cast("double").alias("r"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("o", order)
    # peaks without a finite place or a radius stand for themselves
    placed = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & ~F.isnan("r") & F.col("map_id").isNotNull()
    lone = F.when(F.coalesce(placed, F.lit(False)), -1).otherwise(F.col("row"))
    rows = rows.groupBy("map_id", F.col("x").alias("_x"), F.col("y").alias("_y"), F.abs("r").alias("_r"), lone.alias("_lone")).agg(F.min("o").alias("o"))
    rows = saved(rows.select("map_id", "o.peak_id", "o.x", "o.y", (-F.col("o.k")).alias("v"), "o.r", "o.row", "o"), "peaks")
    wide = rows.agg(F.max(F.abs("r"))).first()[0] or 0.0
    width = float(wide) if wide > 0 else 1.0
    cell = [F.floor(F.col(c) / width).alias(f"c{c}") for c in ("x", "y")]
    strong = rows.select("map_id", F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("o").alias("so"), F.col("row").alias("by"), *cell)
    weak = rows.select("map_id", "x", "y", "o", "r", "row", *cell)
    for c in ("cx", "cy"):
        weak = weak.withColumn(c, F.explode(F.array(*[F.col(c) + d for d in (-1, 0, 1)])))
    dx, dy = F.col("sx") - F.col("x"), F.col("sy") - F.col("y")
    near = strong.join(weak, ["map_id", "cx", "cy"]).where((F.col("so") < F.col("o")) & (dx * dx + dy * dy <= F.col("r") * F.col("r")))
    edges = saved(near.select("by", "row"), "edges")
    kept = saved(rows.select("row").join(edges, "row", "left_anti"), "kept")
    every = kept
    while True:
        gone = edges.join(kept.withColumnRenamed("row", "by"), "by", "left_semi").select("row").distinct()
        left = edges.join(gone, "row", "left_anti").join(gone.withColumnRenamed("row", "by"), "by", "left_anti")
        state = saved(edges.join(gone, "row", "left_anti").select("row").distinct().join(left.select("row").distinct().withColumn("waits", F.lit(True)), "row", "left"), "open")
        edges = saved(left, "edges")
        kept = state.where("waits is null").select("row")
        every = every.union(kept)
        if not state.limit(1).count():
            return rows.join(every, "row", "left_semi").select("map_id", "peak_id", "x", "y", "v")
