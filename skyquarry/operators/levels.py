"""Deblending of connected regions by levels: a tree of components over thresholds, whose branches become sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquarry.operators.kernels import deblended, labelled
from skyquarry.sources.tables import saved


def components(regions: DataFrame, value: str, levels: int) -> DataFrame:
    """(map_id, region, gy, gx, level, comp): the component over every level that a pixel is above, from 1 upwards.

    regions: map_id, region, gy, gx, value, low and high, the region's least and greatest value. Levels lie between them in
    equal ratios, or in equal steps where the least is not positive. All levels of all regions are labelled at once.
    """
    v, low, high = F.col(value), F.col("low"), F.col("high")
    ratio = F.when(low > 0, F.try_divide(F.ln(v / low), F.ln(high / low))).otherwise(F.try_divide(v - low, high - low))
    # a pixel is above level k where ratio * (levels + 1) > k
    depth = F.least(F.lit(levels), F.ceil(ratio * (levels + 1)) - 1).cast("int")
    above = regions.withColumn("depth", depth).where("depth >= 1").withColumn("level", F.explode(F.sequence(F.lit(1), F.col("depth"))))
    above = saved(above.select(F.struct("map_id", "region", "level").alias("key"), "gy", "gx"), "levels")
    found = labelled(above.withColumnRenamed("key", "map_id"))
    return found.select("map_id.map_id", "map_id.region", "gy", "gx", "map_id.level", F.col("label").alias("comp"))


def level_deblended(rows: DataFrame, value: str, levels: int = 32, contrast: float = 1e-3, at_least: int = 2) -> DataFrame:
    """(map_id, gy, gx, label) of given pixels: each belongs to a source, which is named by its peak.

    A component over a level counts as a branch with at least `contrast` of its region's sum and `at_least` pixels. Where
    two or more branches stand on one component it splits. Branches of a split that do not split again are the sources;
    a region without a split is one. The other pixels of a region follow the steepest way up. If that ends at a peak
    which is in no source, it joins a source in the highest component that holds both, of several the nearest by peak.
    """
    named = rows.join(labelled(rows), ["map_id", "gy", "gx"]).withColumnRenamed("label", "region")
    v, top = F.col(value), F.struct(F.col(value).alias("v"), (-F.col("gy")).alias("y"), (-F.col("gx")).alias("x"))
    of = ["map_id", "region"]
    whole = named.groupBy(*of).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.sum(v).alias("flux"), F.max(top).alias("top"))
    regions = saved(named.select(*of, "gy", "gx", v.alias("v")).join(whole, of), "regions")
    chain = saved(components(regions, "v", levels), "components")
    node = [*of, "level", "comp"]

    inside = chain.join(regions.select(*of, "gy", "gx", "v", "flux"), [*of, "gy", "gx"])
    branches = inside.groupBy(*node).agg(F.count("*").alias("n"), F.sum("v").alias("sum"), F.first("flux").alias("flux"), F.max(F.struct("v", (-F.col("gy")).alias("y"), (-F.col("gx")).alias("x"))).alias("top"), F.min(F.struct("gy", "gx")).alias("at"))
    branches = branches.where((F.col("n") >= at_least) & (F.col("sum") >= contrast * F.col("flux"))).select(*node, "top", F.col("at.gy").alias("gy"), F.col("at.gx").alias("gx"))
    below = chain.select(*of, "gy", "gx", (F.col("level") + 1).alias("level"), F.col("comp").alias("parent"))
    # what stands on no component over a level stands on the region
    branches = saved(branches.join(below, [*of, "gy", "gx", "level"], "left").withColumn("parent", F.coalesce("parent", F.lit("region"))), "branches")
    split = branches.groupBy(*of, "level", "parent").agg(F.count("*").alias("k")).where("k >= 2").drop("k")
    standing = branches.join(split, [*of, "level", "parent"], "left_semi")
    # a component with a split at or above it is no source
    inner = standing.select(*of, "gy", "gx", F.col("level").alias("over")).join(chain, [*of, "gy", "gx"]).where("level < over").select(*node).distinct()
    sources = saved(standing.join(inner, node, "left_anti").select(*node, "gy", "gx", (-F.col("top.y")).cast("int").alias("py"), (-F.col("top.x")).cast("int").alias("px")), "sources")

    split_up = regions.join(sources.select(*of).distinct(), of, "left_semi")
    ways = deblended(split_up.select("map_id", "gy", "gx", "v"), "v")
    ways = saved(ways.join(split_up.select(*of, "gy", "gx"), ["map_id", "gy", "gx"]), "ways")
    peaks = ways.select(*of, F.split("label", "_")[0].cast("int").alias("gy"), F.split("label", "_")[1].cast("int").alias("gx")).distinct()
    # the components that hold a peak, and those that hold a source; the region is the component over level 0
    root = lambda df: df.withColumns({"level": F.lit(0), "comp": F.lit("region")})
    over_peak = peaks.join(chain, [*of, "gy", "gx"]).unionByName(root(peaks))
    mine = sources.select(*of, "gy", "gx", F.col("level").alias("own"), "py", "px")
    over_source = mine.join(chain, [*of, "gy", "gx"]).where("level <= own").unionByName(root(mine)).select(*node, "py", "px")
    met = over_peak.join(over_source, node)
    far = (F.col("py") - F.col("gy")) * (F.col("py") - F.col("gy")) + (F.col("px") - F.col("gx")) * (F.col("px") - F.col("gx"))
    best = Window.partitionBy(*of, "gy", "gx").orderBy(F.desc("level"), far, "py", "px")
    joined = met.withColumn("k", F.row_number().over(best)).where("k = 1").select(*of, F.concat_ws("_", "gy", "gx").alias("way"), F.concat_ws("_", "py", "px").alias("label"))
    parts = ways.withColumnRenamed("label", "way").join(joined, [*of, "way"]).select("map_id", "gy", "gx", "label")
    single = regions.join(sources.select(*of).distinct(), of, "left_anti").select("map_id", "gy", "gx", F.concat_ws("_", -F.col("top.y"), -F.col("top.x")).alias("label"))
    return parts.unionByName(single)
