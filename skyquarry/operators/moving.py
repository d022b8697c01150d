"""Moving objects: their positions in time, and where a map saw them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquarry.functions.sky import separation
from skyquarry.sources.tables import saved


def segments(ephemerides: DataFrame) -> DataFrame:
    """(designation, jd0, jd1, ra0, ra1, dec0, dec1): straight pieces between the rows of each object; RA does not wrap within one."""
    w = Window.partitionBy("designation").orderBy("julian_day")
    e = ephemerides.groupBy("designation", "julian_day").agg(F.avg("ra_deg").alias("ra0"), F.avg("dec_deg").alias("dec0"))
    e = e.withColumns({"jd1": F.lead("julian_day").over(w), "ra1": F.lead("ra0").over(w), "dec1": F.lead("dec0").over(w)}).where("jd1 is not null")
    near = F.pmod(F.col("ra1") - F.col("ra0") + 180.0, F.lit(360.0)) - 180.0
    return e.select("designation", F.col("julian_day").alias("jd0"), "jd1", "ra0", (F.col("ra0") + near).alias("ra1"), "dec0", "dec1")


def at_times(asks: DataFrame, pieces: DataFrame, time: str = "jd") -> DataFrame:
    """asks (designation, time) with ra_deg and dec_deg; times that no piece covers are left out.

    A piece goes to every day that it touches, and an ask to its own day.
    """
    spread = pieces.withColumn("_day", F.explode(F.sequence(F.floor("jd0").cast("long"), F.floor("jd1").cast("long"))))
    found = asks.withColumn("_day", F.floor(F.col(time)).cast("long")).join(spread, ["designation", "_day"]).where((F.col(time) >= F.col("jd0")) & (F.col(time) < F.col("jd1")))
    part = (F.col(time) - F.col("jd0")) / (F.col("jd1") - F.col("jd0"))
    out = found.withColumns({"ra_deg": F.pmod(F.col("ra0") + part * (F.col("ra1") - F.col("ra0")), F.lit(360.0)), "dec_deg": F.col("dec0") + part * (F.col("dec1") - F.col("dec0"))})
    return out.drop("_day", "jd0", "jd1", "ra0", "ra1", "dec0", "dec1")


def refined(objects: DataFrame, pieces: DataFrame, pixel_jd: DataFrame, locate: tuple[Column, Column], tolerance_deg: float = 0.01, rounds: int = 10) -> DataFrame:
    """Objects (ask_id, designation, jd) moved to where their map saw them: position at a time, the pixel's time there, the position then.

    It ends for an object when its move is under the tolerance, and at the latest after `rounds`. Objects whose pixel has
    no time keep their last position, not converged. Asks for one object and time are one.
    """
    asked, pieces = objects, saved(pieces, "pieces")
    objects = saved(asked.select("designation", "jd").distinct().withColumn("ask_id", F.monotonically_increasing_id()), "asks")
    pixel_jd = saved(pixel_jd, "times")
    now = at_times(objects, pieces).withColumn("converged", F.lit(False))
    for _ in range(rounds):
        seen = now.withColumns({"gy": locate[0], "gx": locate[1]}).join(pixel_jd, ["gy", "gx"], "left")
        ask = seen.where("not converged and pixel_jd is not null").select("ask_id", "designation", F.col("pixel_jd").alias("jd"), F.col("ra_deg").alias("_ra"), F.col("dec_deg").alias("_dec"))
        new = at_times(ask, pieces).withColumn("converged", separation(F.col("_ra"), F.col("_dec"), F.col("ra_deg"), F.col("dec_deg")) < tolerance_deg).drop("_ra", "_dec")
        now = saved(now.join(new.select("ask_id"), "ask_id", "left_anti").unionByName(new.select(now.columns)), "moving")
        if new.where("not converged").limit(1).count() == 0:
            break
    first = objects.select("ask_id", F.col("designation").alias("_d"), F.col("jd").alias("_jd")).join(now, "ask_id").drop("ask_id")
    both = asked.select("ask_id", F.col("designation").alias("_d"), F.col("jd").alias("_jd")).hint("merge").join(first, ["_d", "_jd"])
    return both.select("ask_id", *[c for c in now.columns if c != "ask_id"])


def tracks(maps: DataFrame, pieces: DataFrame, pixel_jd: DataFrame, locate: tuple[Column, Column], step_days: float = 10.0 / 1440.0) -> DataFrame:
    """(map_id, designation, samples, runs, jd, ra_deg, dec_deg): the objects that cross each map, and where it saw them.

    maps: map_id, jd0, jd1. Positions are sampled every step from jd0 on, before jd1. A sample counts where the map has a
    pixel (map_id, gy, gx, pixel_jd); samples in a row are a run. The mean position's pixel tells when the map saw the
    object, and the position at that time is given. Objects whose pixel has no time within the observation, or which have
    no position then, are left out. Right ascensions are averaged around the first sample's.
    """
    step = F.lit(step_days)
    samples = maps.select("map_id", "jd0", "jd1", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil((F.col("jd1") - F.col("jd0")) / step).cast("int") - 1, F.lit(0)))).alias("k"))
    samples = samples.withColumn("jd", F.col("jd0") + F.col("k") * step).where("jd < jd1").drop("jd0", "jd1")
    # a piece goes to every step's bucket that it touches, and a sample to its own
    bucket = lambda c: F.floor(F.col(c) / step).cast("long")
    spread = pieces.withColumnsRenamed({"jd0": "p0", "jd1": "p1"}).withColumn("_b", F.explode(F.sequence(bucket("p0"), bucket("p1"))))
    near = samples.withColumn("_b", bucket("jd")).join(spread, "_b").where("jd >= p0 and jd < p1")
    part = (F.col("jd") - F.col("p0")) / (F.col("p1") - F.col("p0"))
    at = near.select("map_id", "designation", "k", "jd", F.pmod(F.col("ra0") + part * (F.col("ra1") - F.col("ra0")), F.lit(360.0)).alias("ra_deg"), (F.col("dec0") + part * (F.col("dec1") - F.col("dec0"))).alias("dec_deg"))
    inside = at.withColumns({"gy": locate[0], "gx": locate[1]}).join(pixel_jd.select("map_id", "gy", "gx").distinct(), ["map_id", "gy", "gx"], "left_semi")
    w = Window.partitionBy("map_id", "designation").orderBy("k")
    from_first = F.pmod(F.col("ra_deg") - F.first("ra_deg").over(w) + 180.0, F.lit(360.0)) - 180.0
    runs = inside.withColumns({"_first": F.first("ra_deg").over(w), "_off": from_first, "_new": F.coalesce(F.col("k") - F.lag("k").over(w) != 1, F.lit(True)).cast("int")})
    mean = runs.groupBy("map_id", "designation").agg(F.count("*").alias("samples"), F.sum("_new").alias("runs"), F.pmod(F.first("_first") + F.avg("_off"), F.lit(360.0)).alias("ra_deg"), F.avg("dec_deg").alias("dec_deg"))
    seen = mean.withColumns({"gy": locate[0], "gx": locate[1]}).drop("ra_deg", "dec_deg").join(pixel_jd, ["map_id", "gy", "gx"]).join(maps, "map_id")
    ask = seen.where("pixel_jd >= jd0 and pixel_jd <= jd1").select("map_id", "designation", "samples", "runs", F.col("pixel_jd").alias("jd"))
    return at_times(ask, pieces).select("map_id", "designation", "samples", "runs", "jd", "ra_deg", "dec_deg")
