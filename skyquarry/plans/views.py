"""The benchmark's tables in the shapes of the sky-map domain, for Spark and, as the same SQL, for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name: (table, columns in Spark SQL, columns in DuckDB where they differ)
_UNIX = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {0}) / 1e6"
_UNIX_DUCK = "epoch_us({0}) / 1e6"
_BAND = "case when l_orderkey % 3 = 0 then 'f090' when l_orderkey % 3 = 1 then 'f150' else 'f220' end"

VIEWS: dict[str, tuple[str, list[str]]] = {
    "catalog_sources": ("part", ["p_partkey as source_id", "p_partkey * 7919 % 36000 / 1e2 as ra_deg", "p_partkey * 104729 % 8000 / 1e2 - 6e1 as dec_deg", "p_retailprice as flux_mjy", "p_size % 2 = 0 as monitored", "p_brand as catalog_name"]),
    "detections": ("customer", ["c_custkey as det_id", "c_custkey % 4 as map_ord", "c_custkey * 7919 % 36000 / 1e2 + c_custkey % 7 / 1e2 as ra_deg", "c_custkey * 104729 % 8000 / 1e2 - 6e1 as dec_deg", "c_acctbal as flux_mjy", "4 + c_nationkey as snr"]),
    "maps": ("orders", ["o_orderkey as map_id", "case when o_orderstatus = 'F' then 'f090' when o_orderstatus = 'O' then 'f150' else 'f220' end as freq", "'pa' || substr(o_orderpriority, 1, 1) as arr", "{unix:o_orderdate} as obs_start", "{unix:o_orderdate} + 43200e0 as obs_end", "o_custkey as ra_tile", "case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'P' then 'processing' end as status"]),
    "pixels_raw": ("lineitem", ["l_orderkey % 24 as map_id", f"{_BAND} as freq", "'pa' || cast(4 + l_orderkey % 2 as string) as arr", "cast(l_partkey % 60 as int) as gy", "cast(l_suppkey % 60 as int) as gx", "l_extendedprice / 1e3 - 38e0 as rho", "l_quantity as kappa", "{unix:l_shipdate} as t_unix", "case when l_returnflag = 'R' then 0 else 1 end as mask"]),
    "light_curves": ("events", ["event_id", "user_id as source_id", "event_type as band", "{unix:ts} as t_unix", "value as flux_mjy"]),
    "peaks": ("part", ["p_partkey % 4 as map_id", "p_partkey as peak_id", "p_partkey * 37 % 400 / 1e1 as x", "p_partkey * 91 % 400 / 1e1 as y", "p_retailprice + p_size as v", "3 + p_size % 20 as sigma"]),
    "ephemerides": ("events", ["user_id % 20 as designation", "{unix:ts} / 86400e0 + 2440587.5e0 as julian_day", "event_id % 3600 / 1e1 as ra_deg", "event_id % 1200 / 1e1 - 6e1 as dec_deg"]),
}


def _expand(text: str, unix: str) -> str:
    head, mark, rest = text.partition("{unix:")
    if not mark:
        return text
    column, _, rest = rest.partition("}")
    return head + unix.format(column) + _expand(rest, unix)


def viewed(table: DataFrame, name: str) -> DataFrame:
    """A view over its table, which may be a stream."""
    return table.selectExpr(*[_expand(c, _UNIX) for c in VIEWS[name][1]])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return viewed(spark.read.parquet(f"{sf_dir}/{VIEWS[name][0]}.parquet"), name)


def duck(*names: str) -> str:
    """A WITH clause that defines the views for DuckDB."""
    parts = [f"{n} as (select {', '.join(_expand(c, _UNIX_DUCK).replace('as string', 'as varchar') for c in VIEWS[n][1])} from {VIEWS[n][0]})" for n in names]
    return "with " + ", ".join(parts) + " "
