"""Cut-outs around sources, their stacks, and pointing applied to positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_a_place(sources: DataFrame, place=("map_id", "gy", "gx")) -> DataFrame:
    """(*place, source_id): the least source of every place; what is at one place is worked out once, and goes to all of its sources by a join."""
    return sources.groupBy(*place).agg(F.min("source_id").alias("source_id"))


def thumbnails(sources: DataFrame, pixels: DataFrame, half: int, value: str = "flux") -> DataFrame:
    """sources (map_id, source_id, gy, gx) with the box of half-width `half` as rows (dy, dx, v); pixels that a map lacks are absent.

    Places of sources go to the nine cells of a box's size around them, so that the join is an equi-join whatever the map's
    size, and each source takes its place's box. Sources are many more in cells and boxes than planned with, and never broadcast.
    """
    size = 2 * half + 1
    cell = lambda c: F.floor(F.col(c) / size)
    nine = F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("x")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    places = sources.select("map_id", F.col("gy").alias("sy"), F.col("gx").alias("sx")).distinct()
    left = places.select("map_id", "sy", "sx", (cell("sy")).alias("_y"), cell("sx").alias("_x")).withColumn("_n", F.explode(nine))
    left = left.select("map_id", "sy", "sx", (F.col("_y") + F.col("_n.y")).alias("_cy"), (F.col("_x") + F.col("_n.x")).alias("_cx"))
    near = left.hint("merge").join(pixels.select("map_id", "gy", "gx", F.col(value).alias("v")).withColumns({"_cy": cell("gy"), "_cx": cell("gx")}), ["map_id", "_cy", "_cx"])
    near = near.withColumns({"dy": F.col("gy") - F.col("sy"), "dx": F.col("gx") - F.col("sx")})
    boxes = near.where((F.abs("dy") <= half) & (F.abs("dx") <= half)).select("map_id", "sy", "sx", "dy", "dx", "v")
    every = sources.select("map_id", "source_id", F.col("gy").alias("sy"), F.col("gx").alias("sx"))
    return every.hint("merge").join(boxes, ["map_id", "sy", "sx"]).select("map_id", "source_id", "dy", "dx", "v")


def tangent_stamps(sources: DataFrame, coefs: DataFrame, half: int, step_deg: float, ny: int, nx: int, geometry: dict) -> DataFrame:
    """sources (map_id, source_id, ra_deg, dec_deg) with a stamp (dy, dx, v) on the plane that touches the sky at each.

    The pixels lie step_deg apart, eastward by dx and northward by dy; their values are the map's spline (coefs of
    spline2d.coefficients) at where they are seen. Pixels outside the map are absent. Sources at one position share a stamp.
    """
    from skyquarry.functions import sky
    from skyquarry.operators.spline2d import at_positions

    steps = F.sequence(F.lit(-half), F.lit(half))
    place = ["map_id", "ra_deg", "dec_deg"]
    spread = sources.select(*place).distinct().withColumn("dy", F.explode(steps)).withColumn("dx", F.explode(steps))
    ra, dec = sky.from_tangent(F.col("dx") * step_deg, F.col("dy") * step_deg, F.col("ra_deg"), F.col("dec_deg"))
    y, x = sky.pixel_at(ra, dec, **geometry)
    found = at_positions(spread.select(*place, "dy", "dx", y.alias("y"), x.alias("x")), coefs, ny, nx, ["ra_deg", "dec_deg", "dy", "dx"], name="v")
    return sources.select(*place, "source_id").hint("merge").join(found, place).select("map_id", "source_id", "dy", "dx", "v")


def as_arrays(thumbs: DataFrame, half: int) -> DataFrame:
    """Thumbnails as arrays by row, NaN where a pixel is missing; an array has (2 half + 1)^2 values."""
    size = 2 * half + 1
    at = (F.col("dy") + half) * size + F.col("dx") + half
    cells = thumbs.groupBy("map_id", "source_id").agg(F.map_from_entries(F.collect_list(F.struct(at.cast("int").alias("k"), F.col("v").cast("double").alias("v")))).alias("m"))
    every = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.coalesce(F.element_at("m", k), F.lit(float("nan"))))
    return cells.select("map_id", "source_id", every.alias("image"))


def stacked(thumbs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Mean of a source's thumbnails over maps, weighted by weights (map_id, source_id, dy, dx, w) if given."""
    if weights is None:
        thumbs = thumbs.withColumn("w", F.lit(1.0))
    else:
        thumbs = thumbs.join(weights, ["map_id", "source_id", "dy", "dx"])
    return thumbs.groupBy("source_id", "dy", "dx").agg(F.try_divide(F.sum(F.col("v") * F.col("w")), F.sum("w")).alias("v"), F.count_distinct("map_id").alias("n_maps"))


def pointed(positions: DataFrame, models: DataFrame, by: str = "map_id") -> DataFrame:
    """Positions less their map's offset: ra_coef and dec_coef of one value are constant, of more a polynomial by ascending powers.

    Terms are ordered as the fit orders them: (i, j) with i + j at most the order. Maps without a model keep their positions.
    """
    both = positions.join(models.select(by, "ra_coef", "dec_coef"), by, "left")
    n = F.size("ra_coef")
    order = F.rint((F.sqrt(8.0 * n + 1.0) - 3.0) / 2.0).cast("int")
    powers = F.flatten(F.transform(F.sequence(F.lit(0), order), lambda i: F.transform(F.sequence(F.lit(0), order - i), lambda j: F.pow(F.col("ra_deg"), i.cast("double")) * F.pow(F.col("dec_deg"), j.cast("double")))))
    value = lambda c: F.aggregate(F.zip_with(F.col(c), powers, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
    shift = lambda c: F.coalesce(F.when(n > 0, value(c)), F.lit(0.0))
    return both.withColumns({"ra_pointed": F.col("ra_deg") - shift("ra_coef"), "dec_pointed": F.col("dec_deg") - shift("dec_coef")}).drop("ra_coef", "dec_coef")


def scan_profile(profile: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The rows around the middle of each profile over which its value rises or falls without a turn."""
    w = Window.partitionBy(key).orderBy(order)
    step = F.lead(value).over(w) - F.col(value)
    rows = profile.withColumns({"_i": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(key)), "_s": F.signum(F.coalesce(step, F.lag(value, -1).over(w) - F.col(value), F.col(value) - F.lag(value).over(w)))})
    middle = F.max(F.when(F.col("_i") == F.floor(F.col("_n") / 2) + 1, F.col("_s"))).over(Window.partitionBy(key))
    turn = F.when(F.col("_s") != middle, F.col("_i"))
    low = F.max(F.when(F.col("_i") <= F.floor(F.col("_n") / 2) + 1, turn)).over(Window.partitionBy(key))
    high = F.min(F.when(F.col("_i") > F.floor(F.col("_n") / 2) + 1, turn)).over(Window.partitionBy(key))
    return rows.where((F.col("_i") > F.coalesce(low, F.lit(0))) & (F.col("_i") <= F.coalesce(high, F.col("_n")))).drop("_i", "_n", "_s")


def rolled(pixels: DataFrame, shifts: DataFrame, nx: int) -> DataFrame:
    """Rows of a map rolled by whole pixels: gx + dx(gy), around nx."""
    return pixels.join(shifts, ["gy"]).withColumn("gx", F.pmod(F.col("gx") + F.col("dx"), F.lit(nx))).drop("dx")


def reprojected(mask: DataFrame, pixels: DataFrame, position: tuple[Column, Column], to_mask: tuple[Column, Column], invert: bool = False) -> DataFrame:
    """pixels with the value of a coarse mask (my, mx, m) at their position; outside it 0, or 1 if inverted.

    to_mask gives the mask's pixel from columns _ra and _dec.
    """
    located = pixels.withColumns({"_ra": position[0], "_dec": position[1]})
    located = located.withColumns({"my": to_mask[0], "mx": to_mask[1]})
    m = F.coalesce("m", F.lit(0.0))
    return located.join(mask, ["my", "mx"], "left").withColumn("m", 1.0 - m if invert else m).drop("_ra", "_dec", "my", "mx")
