"""Cubic spline interpolation of maps at positions between pixels: prefiltered coefficients, and sums of 4 x 4 of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The pole of the cubic B-spline's inverse; over HALO pixels its trace falls under 1e-13.
POLE, HALO = np.sqrt(3.0) - 2.0, 24


def prefiltered(v: np.ndarray, axis: int) -> np.ndarray:
    """The coefficients of the cubic B-spline through v along an axis, mirrored at both ends: one pass up and one down."""
    v = np.moveaxis(v, axis, 0).astype(float)
    n = len(v)
    if n == 1:
        return np.moveaxis(v, 0, axis)
    out = np.empty_like(v)
    # the sum over the mirrored signal, whose period is 2 n - 2
    k = np.arange(min(2 * n - 2, 64))
    place = k % (2 * n - 2)
    place = np.where(place < n, place, 2 * n - 2 - place)
    out[0] = np.tensordot(POLE**k, v[place], 1) / (1 - POLE ** (2 * n - 2) if 2 * n - 2 <= 64 else 1)
    for i in range(1, n):
        out[i] = v[i] + POLE * out[i - 1]
    out[-1] = POLE / (POLE * POLE - 1) * (out[-1] + POLE * out[-2])
    for i in range(n - 2, -1, -1):
        out[i] = POLE * (out[i + 1] - out[i])
    return np.moveaxis(6 * out, 0, axis)


def coefficients(pixels: DataFrame, value: str, ny: int, nx: int, block: int = 256) -> DataFrame:
    """(map_id, gy, gx, c): spline coefficients of every pixel of the image; pixels without a row or a finite value count as 0.

    Tiles with halos are filtered along both axes, so that a task holds a tile. At the image's borders it is mirrored.
    """
    spans = lambda n: F.array(*[F.struct(F.lit(i).alias("i"), F.lit(max(0, s - HALO)).alias("s"), F.lit(min(n, s + block + HALO)).alias("e")) for i, s in enumerate(range(0, n, block))])
    v = F.col(value).cast("double")
    cut = pixels.select("map_id", F.col("gy").cast("int").alias("gy"), F.col("gx").cast("int").alias("gx"), F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v).otherwise(0.0).alias("v"))
    for name, at, n in (("ty", F.col("gy"), ny), ("tx", F.col("gx"), nx)):
        here = F.filter(spans(n), lambda b: (at >= b["s"]) & (at < b["e"]))  # noqa: B023
        cut = cut.withColumn(name, F.explode(F.transform(here, lambda b: b["i"])))
    kind = pixels.schema["map_id"].dataType.simpleString()

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        y, x = int(key[1]) * block, int(key[2]) * block
        y0, y1, x0, x1 = max(0, y - HALO), min(ny, y + block + HALO), max(0, x - HALO), min(nx, x + block + HALO)
        v = np.zeros((y1 - y0, x1 - x0))
        v[part["gy"].to_numpy() - y0, part["gx"].to_numpy() - x0] = part["v"].to_numpy()
        c = prefiltered(prefiltered(v, 0), 1)[y - y0 : y - y0 + block, x - x0 : x - x0 + block]
        yy, xx = np.mgrid[: c.shape[0], : c.shape[1]]
        return pd.DataFrame({"map_id": key[0], "gy": (yy + y).ravel(), "gx": (xx + x).ravel(), "c": c.ravel()})

    return cut.groupBy("map_id", "ty", "tx").applyInPandas(run, f"map_id {kind}, gy int, gx int, c double")


def weights_of(at: Column, n: int) -> Column:
    """The four neighbours of a place along an axis of n pixels, mirrored at its ends, as an array of (i, w)."""
    low = F.floor(at)
    t = at - low
    u = 1.0 - t
    w = [u * u * u / 6.0, (4.0 - 6.0 * t * t + 3.0 * t * t * t) / 6.0, (4.0 - 6.0 * u * u + 3.0 * u * u * u) / 6.0, t * t * t / 6.0]
    place = lambda i: F.when(F.lit(n) == 1, F.lit(0)).otherwise(F.lit(n - 1) - F.abs(F.lit(n - 1) - F.abs(i)))
    return F.array(*[F.struct(place(low + k - 1).cast("int").alias("i"), w[k].alias("w")) for k in range(4)])


def at_positions(positions: DataFrame, coefs: DataFrame, ny: int, nx: int, key: list[str], y: str = "y", x: str = "x", name: str = "value") -> DataFrame:
    """(map_id, *key, name): the spline at real pixel coordinates of each position; positions outside the image are left out.

    The 4 x 4 coefficients around every pixel that has a position are put into one row, which its positions are joined to
    and summed over. key and map_id tell positions apart. Positions are never broadcast.
    """
    # by way of a generator, so that long expressions of a position are evaluated once and not in every weight
    placed = positions.select("map_id", *key, F.explode(F.array(F.struct(F.col(y).alias("y"), F.col(x).alias("x")))).alias("_at")).select("map_id", *key, F.col("_at.y").alias("_py"), F.col("_at.x").alias("_px"))
    placed = placed.where((F.col("_py") >= 0) & (F.col("_py") <= ny - 1) & (F.col("_px") >= 0) & (F.col("_px") <= nx - 1))
    inside = placed.withColumns({"_ly": F.floor("_py").cast("int"), "_lx": F.floor("_px").cast("int")})
    around = inside.select("map_id", "_ly", "_lx").distinct()
    around = around.select("*", F.posexplode(weights_of(F.col("_ly").cast("double"), ny)).alias("_ky", "_y"))
    around = around.select("*", F.posexplode(weights_of(F.col("_lx").cast("double"), nx)).alias("_kx", "_x"))
    around = around.select("map_id", "_ly", "_lx", F.col("_y.i").alias("gy"), F.col("_x.i").alias("gx"), (F.col("_ky") * 4 + F.col("_kx")).alias("_k"))
    blocks = around.hint("merge").join(coefs, ["map_id", "gy", "gx"]).groupBy("map_id", "_ly", "_lx").agg(*[F.sum(F.when(F.col("_k") == k, F.col("c")).otherwise(0.0)).alias(f"_c{k}") for k in range(16)])
    met = inside.hint("merge").join(blocks, ["map_id", "_ly", "_lx"])
    # weights are worked out once, as positions are
    weights = F.struct(weights_of(F.col("_py"), ny).alias("y"), weights_of(F.col("_px"), nx).alias("x"))
    met = met.select("map_id", *key, *[f"_c{k}" for k in range(16)], F.explode(F.array(weights)).alias("_w"))
    line = lambda i: sum((F.col("_w.x")[j]["w"] * F.col(f"_c{4 * i + j}") for j in range(1, 4)), F.col("_w.x")[0]["w"] * F.col(f"_c{4 * i}"))
    return met.select("map_id", *key, sum((F.col("_w.y")[i]["w"] * line(i) for i in range(1, 4)), F.col("_w.y")[0]["w"] * line(0)).alias(name))
