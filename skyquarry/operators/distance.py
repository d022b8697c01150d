"""Exact Euclidean distances of pixels to the nearest seed, in two passes whose cost does not depend on the radius."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a map that a group of the second pass holds.
ROWS = 64


def envelope(g2: np.ndarray) -> np.ndarray:
    """For each row of squared distances along columns (inf where none), the squared distances along both axes.

    The lower envelope of the parabolas (x - v)^2 + g2[v], of all rows at once; a parabola enters once and leaves at
    most once, so that the cost is that of the pixels.
    """
    n, width = g2.shape
    place = np.zeros((n, width), np.int64)  # the vertices of the parabolas on the envelope
    start = np.full((n, width + 1), np.inf)  # from where on each is the lowest
    top = np.full(n, -1)
    for x in range(width):
        rows = np.flatnonzero(np.isfinite(g2[:, x]))
        at = np.full(len(rows), -np.inf)
        todo = np.flatnonzero(top[rows] >= 0)
        while len(todo):
            r = rows[todo]
            v = place[r, top[r]]
            at[todo] = ((g2[r, x] + x * x) - (g2[r, v] + v * v)) / (2.0 * (x - v))
            out = at[todo] <= start[r, top[r]]
            top[r[out]] -= 1
            todo = todo[out]
            gone = top[rows[todo]] < 0
            at[todo[gone]] = -np.inf
            todo = todo[~gone]
        top[rows] += 1
        place[rows, top[rows]] = x
        start[rows, top[rows]] = at
    out = np.full((n, width), np.inf)
    x = np.arange(width)
    for i in np.flatnonzero(top >= 0):
        v = place[i, np.searchsorted(start[i, : top[i] + 1], x, "right") - 1]
        out[i] = (x - v) ** 2 + g2[i, v]
    return out


def nearest_seed(pixels: DataFrame, seeds: DataFrame, radius: float | None = None) -> DataFrame:
    """(map_id, gy, gx, distance) of the distinct pixels with a seed of their map within radius (any, if None).

    Along columns the nearest seeds are the last one before and the next one after, by windows; along rows the lowest
    parabola is found in groups of some rows of a map.
    """
    seeds = seeds.select("map_id", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx")).distinct()
    wanted = pixels.select("map_id", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx")).distinct()
    # a column with a seed counts in every row that is asked for
    rows, columns = wanted.select("map_id", "gy").distinct(), seeds.select("map_id", "gx").distinct()
    grid = rows.join(columns, "map_id").select("map_id", "gx", "gy", F.lit(None).cast("int").alias("seed"))
    every = grid.unionByName(seeds.select("map_id", "gx", "gy", F.col("gy").alias("seed")))
    line = Window.partitionBy("map_id", "gx").orderBy("gy")
    before = F.last("seed", True).over(line.rangeBetween(Window.unboundedPreceding, 0))
    behind = F.first("seed", True).over(line.rangeBetween(0, Window.unboundedFollowing))
    along = F.least(F.col("gy") - before, behind - F.col("gy"))
    near = every.withColumn("g", along).where("seed is null and g is not null")
    if radius is not None:
        near = near.where(F.col("g") <= radius)
    both = near.select("map_id", "gy", "gx", F.col("g").cast("double").alias("g")).unionByName(wanted.withColumn("g", F.lit(None).cast("double")))
    kind = pixels.schema["map_id"].dataType.simpleString()

    def across(part: pd.DataFrame) -> pd.DataFrame:
        y, x, g = (part[c].to_numpy() for c in ("gy", "gx", "g"))
        low, left = y.min(), x.min()
        asks = np.isnan(g)
        g2 = np.full((y.max() - low + 1, x.max() - left + 1), np.inf)
        g2[y[~asks] - low, x[~asks] - left] = g[~asks] ** 2
        d = np.sqrt(envelope(g2)[y[asks] - low, x[asks] - left])
        out = pd.DataFrame({"map_id": part["map_id"].iloc[0], "gy": y[asks], "gx": x[asks], "distance": d})
        return out[out["distance"] <= (np.finfo(float).max if radius is None else radius)]

    return both.groupBy("map_id", F.floor(F.col("gy") / ROWS)).applyInPandas(across, f"map_id {kind}, gy int, gx int, distance double")


def with_distance(pixels: DataFrame, seeds: DataFrame, radius: float | None = None, name: str = "distance") -> DataFrame:
    """pixels with their distance to the nearest seed of their map; null where there is none within radius."""
    return pixels.join(nearest_seed(pixels, seeds, radius).withColumnRenamed("distance", name), ["map_id", "gy", "gx"], "left")
