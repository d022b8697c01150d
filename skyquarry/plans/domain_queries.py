"""Registered queries of catalog records, map batches, intensity maps, footprints and re-tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyquarry.functions import names, sky
from skyquarry.operators import catalogs, distance, filters, joins, kernels, maps, sift, spline2d, stamps, state
from skyquarry.plans.queries import _COADD, _GX, _GY, _PIX, CUT, SEP, GRID, SIFT, _block_sql, _catalog, _located, _pixels, _whole, query, r
from skyquarry.plans.views import duck, view


@query("select map_id, gy, gx, round(sum(rho) * sqrt(sum(kappa)) + 3e-8, 5) as snr, round(sum(rho) + 3e-8, 5) as flux, round(sum(rho) / sum(kappa) + 3e-8, 5) as filtered_flux, round(sum(rho) / sqrt(sum(kappa)) + 3e-8, 5) as filtered_snr, case when sum(kappa) > 0 or abs(sum(rho)) > 0 then 1 else 0 end as hits from pixels_raw group by map_id, gy, gx", "pixels_raw")
def intensity_snr(spark, sf):
    """Flux, snr and hits of intensity maps, unfiltered and matched-filtered."""
    p = view(spark, sf, "pixels_raw").groupBy("map_id", "gy", "gx").agg(F.sum("rho").alias("intensity"), F.sum("kappa").alias("ivar"))
    plain = maps.with_intensity(p).withColumnsRenamed({"flux": "plain_flux", "snr": "plain_snr"}).drop("hits")
    out = maps.with_intensity(plain, filtered=True)
    return out.select("map_id", "gy", "gx", F.round(F.col("plain_snr") + 3e-8, 5).alias("snr"), F.round(F.col("plain_flux") + 3e-8, 5).alias("flux"), F.round(F.col("flux") + 3e-8, 5).alias("filtered_flux"), F.round(F.col("snr") + 3e-8, 5).alias("filtered_snr"), "hits")


@query("select m.map_id, k.offset_ra from (select * from maps where obs_end >= 902016000e0 - 90 * 86400e0 and not coalesce(status = 'completed' or status = 'processing' and 902016000e0 - (obs_start + 60) < 7200, false) order by obs_start, map_id limit 100) m left join (select map_id, map_id / 1e3 as offset_ra from maps where map_id % 3 = 0) k using (map_id)", "maps")
def next_maps(spark, sf):
    """The next maps of the last 90 days that are not processed, with the pointing models that are kept."""
    m = view(spark, sf, "maps")
    status = m.where("status is not null").select("map_id", "status", (F.col("obs_start") + 60).alias("processing_start"))
    kept = m.where("map_id % 3 = 0").select("map_id", (F.col("map_id") / 1000.0).alias("offset_ra"))
    return state.next_maps(m, status, 902016000.0, 90.0, 100, models=kept).select("map_id", "offset_ra")


@query("select source_id, flux_mjy from (select *, source_id % 7 = 0 as fit_failed, case when source_id % 11 <> 0 then dec_deg end as cut_dec from catalog_sources) where not fit_failed and flux_mjy between 905e0 and 15e2 and cut_dec between -3e1 and 2e1", "catalog_sources")
def model_cuts(spark, sf):
    m = view(spark, sf, "catalog_sources").withColumns({"fit_failed": F.col("source_id") % 7 == 0, "cut_dec": F.when(F.col("source_id") % 11 != 0, F.col("dec_deg"))})
    return catalogs.model_cuts(m, {"flux_mjy": (905.0, 1500.0), "cut_dec": (-30.0, 20.0)}).select("source_id", "flux_mjy")


@query(f"select a.det_id, b.source_id from detections a join catalog_sources b on {SEP.format(a='a', b='b')} < 3e-1 where b.flux_mjy / 1e2 < 1e1 and b.source_id % 5 not in (1, 2)", "detections", "catalog_sources")
def star_candidates(spark, sf):
    """Stars near a detection that are bright enough and have a parallax."""
    stars = _catalog(spark, sf).withColumns({"mag": F.col("cat_flux") / 100.0, "parallax": F.when(F.col("source_id") % 5 == 1, F.lit(float("nan"))).when(F.col("source_id") % 5 != 2, 1.0)})
    pairs = joins.zone_join(view(spark, sf, "detections"), stars, 0.3)
    return catalogs.star_candidates(pairs, 10.0, 0.3).select("det_id", "source_id")


@query(f"select det_id, source_id, rank from (select a.det_id, b.source_id, row_number() over (partition by a.det_id order by {SEP.format(a='a', b='b')}, b.source_id) as rank from detections a join catalog_sources b on {SEP.format(a='a', b='b')} <= 15e-1) where rank <= 3", "detections", "catalog_sources")
def nearest_three(spark, sf):
    pairs = joins.zone_join(view(spark, sf, "detections"), _catalog(spark, sf), 1.5)
    return catalogs.nearest_rows(pairs, "det_id", "source_id", 3).select("det_id", "source_id", F.col("rank").cast("long").alias("rank"))


@query(f"select d.det_id, b.source_id, round(b.sep, 7) as sep from detections d left join (select a.det_id, b.source_id, {SEP.format(a='a', b='b')} as sep from detections a join catalog_sources b on {SEP.format(a='a', b='b')} <= 5e-1 / 6e1 qualify row_number() over (partition by a.det_id order by {SEP.format(a='a', b='b')}, b.source_id) = 1) b using (det_id)", "detections", "catalog_sources")
def quasar_match(spark, sf):
    """Every detection with the closest catalog object within half an arcminute."""
    return catalogs.matched_or_null(view(spark, sf, "detections"), _catalog(spark, sf), 0.5 / 60, "det_id", "source_id").select("det_id", "source_id", F.round("sep", 7).alias("sep"))


@query("select a.ask, c.flux_mjy, c.catalog_name from (select det_id * 3 as ask from detections) a left join catalog_sources c on c.source_id = a.ask", "detections", "catalog_sources")
def source_lookup(spark, sf):
    asks = view(spark, sf, "detections").select((F.col("det_id") * 3).alias("ask"))
    found = view(spark, sf, "catalog_sources").select(F.col("source_id").alias("ask"), "flux_mjy", "catalog_name")
    return catalogs.by_id(asks, found, "ask")


@query("select source_id, ra_valid, dec_valid from (select source_id, coalesce(lo >= 0 and hi <= 360, false) as ra_valid, coalesce(dec_deg - 40 >= -90 and dec_deg + 75 <= 90, false) as dec_valid from (select *, case when source_id % 9 <> 0 then ra_deg - 20 end as lo, ra_deg + 10 as hi from catalog_sources))", "catalog_sources")
def limits_valid(spark, sf):
    ra, dec = F.col("ra_deg"), F.col("dec_deg")
    low = F.when(F.col("source_id") % 9 != 0, ra - 20)
    return view(spark, sf, "catalog_sources").select("source_id", sky.limits_valid(low, ra + 10, 0.0, 360.0).alias("ra_valid"), sky.limits_valid(dec - 40, dec + 75, -90.0, 90.0).alias("dec_valid"))


@query("select source_id, system, round(case when system = '0-360' then ((ra % 36e1) + 36e1) % 36e1 else (((ra + 18e1) % 36e1) + 36e1) % 36e1 - 18e1 end, 6) as ra from (select source_id, ra, case when min(ra) over (partition by catalog_name) < 0 then '-180-180' else '0-360' end as system from (select source_id, catalog_name, case when catalog_name < 'Brand#3' then ra_deg - 18e1 else ra_deg + 9e1 end as ra from catalog_sources))", "catalog_sources")
def ra_of_set(spark, sf):
    s = view(spark, sf, "catalog_sources").withColumn("ra", F.when(F.col("catalog_name") < "Brand#3", F.col("ra_deg") - 180.0).otherwise(F.col("ra_deg") + 90.0))
    ra, system = sky.ra_of_set(F.col("ra"), [F.col("catalog_name")])
    return s.select("source_id", system.alias("system"), F.round(ra, 6).alias("ra"))


@query("select map_id, case when map_id % 4 = 3 then null else round(obs_start + case when map_id % 4 = 0 then 25e-2 else 0 end, 3) end as unix from maps", "maps")
def event_times(spark, sf):
    """Event times written in three ways, and some in none."""
    ts = F.timestamp_seconds("obs_start")
    day = F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("map_id") % 4 == 0, F.concat(day, F.lit(".250"))).when(F.col("map_id") % 4 == 1, F.translate(day, " ", "T")).when(F.col("map_id") % 4 == 2, day).otherwise("no time")
    return view(spark, sf, "maps").select("map_id", F.round(sky.event_unix(text), 3).alias("unix"))


@query("select source_id, round(left_edge, 6) as left_edge, round(((left_edge % 36e1) + 36e1) % 36e1, 6) as back from (select source_id, case when ra_deg > (ra_deg + 3e1) % 36e1 then ra_deg - 36e1 else ra_deg end as left_edge from catalog_sources)", "catalog_sources")
def box_wrap(spark, sf):
    left = sky.box_wrapped(F.col("ra_deg"), F.pmod(F.col("ra_deg") + 30.0, F.lit(360.0)))
    return view(spark, sf, "catalog_sources").select("source_id", r(left).alias("left_edge"), r(sky.box_unwrapped(left)).alias("back"))


@query("select source_id, round(cume_dist() over (partition by catalog_name order by flux_mjy), 9) as ecdf from catalog_sources", "catalog_sources")
def ecdf(spark, sf):
    return catalogs.ecdf(view(spark, sf, "catalog_sources"), "flux_mjy", "catalog_name").select("source_id", r("ecdf", 9).alias("ecdf"))


@query("select source_id, catalog_name from (select *, row_number() over (partition by catalog_name order by source_id) as i, count(*) over (partition by catalog_name) as n from catalog_sources) where i <= floor(n * 25e-2)", "catalog_sources")
def prefix_fraction(spark, sf):
    return catalogs.prefix_fraction(view(spark, sf, "catalog_sources"), 0.25, "catalog_name", "source_id").select("source_id", "catalog_name")


@query("select source_id from catalog_sources order by md5('17-' || source_id), source_id limit 40", "catalog_sources")
def random_rows(spark, sf):
    """A repeatable random sample of 40 sources."""
    return catalogs.random_rows(view(spark, sf, "catalog_sources"), 40, 17, "source_id").select("source_id")


@query("select a.map_id as a, b.map_id as b, c.map_id as c from (select distinct map_id from pixels_raw) a, (select distinct map_id from pixels_raw) b, (select distinct map_id from pixels_raw) c where a.map_id < b.map_id and b.map_id < c.map_id", "pixels_raw")
def map_triples(spark, sf):
    """All sets of three of the maps: each pair's later ids are dealt to tasks apart, so that only the list of ids, which is few, is one row."""
    ids = view(spark, sf, "pixels_raw").select("map_id").distinct().groupBy().agg(F.array_sort(F.collect_list("map_id")).alias("ids"))
    one = ids.select("ids", F.posexplode("ids").alias("i", "a")).repartition("a")
    two = one.select("ids", "a", F.posexplode("ids").alias("j", "b"), "i").where("j > i").repartition("a", "b")
    return two.select("a", "b", F.posexplode("ids").alias("k", "c"), "j").where("k > j").select("a", "b", "c")


@query("select freq, count(distinct arr) as arrays, count(distinct ra_tile) as tiles, string_agg(distinct arr, ',' order by arr) as names from maps group by freq", "maps")
def distinct_sets(spark, sf):
    return view(spark, sf, "maps").groupBy("freq").agg(F.count_distinct("arr").alias("arrays"), F.count_distinct("ra_tile").alias("tiles"), F.array_join(F.array_sort(F.collect_set("arr")), ",").alias("names"))


@query(f", {_PIX}, stamps as (select map_id, source_id, count(*) as n from (select source_id, source_id % 24 as map_id, source_id * 7 % 60 + dy as gy, source_id * 11 % 60 + dx as gx from catalog_sources, unnest(range(-3, 4)) a(dy), unnest(range(-3, 4)) b(dx)) join p using (map_id, gy, gx) group by all) select map_id, case when n = 49 then 'fitted' else 'flux_thumb_has_nan' end as reason, count(*) as n from stamps group by all", "catalog_sources", "pixels_raw")
def fit_counts(spark, sf):
    """Gaussian fits of the sources' stamps by map: those made, and those that failed by reason."""
    from skyquarry.plans.more_queries import fitted_sources

    fits = fitted_sources(spark, sf)
    return fits.groupBy((F.col("source_id") % 24).alias("map_id"), F.coalesce("reason", F.lit("fitted")).alias("reason")).agg(F.count("*").alias("n"))


@query("select det_id as source_id, round(flux_mjy, 4) as flux, round(flux_mjy / snr + 3e-8, 5) as err_flux from detections", "detections")
def measured_records(spark, sf):
    d = view(spark, sf, "detections").select("det_id", F.col("flux_mjy").alias("peak"), F.col("snr").alias("significance"))
    return catalogs.measured(d, {"det_id": "source_id"}).select("source_id", F.round("flux", 4).alias("flux"), F.round(F.col("err_flux") + 3e-8, 5).alias("err_flux"))


@query("select name, round(((ra % 36e1) + 36e1) % 36e1, 6) as ra_deg, case when off <> 0 then off / 1e1 end as err, sha256('source-' || name) as match_id, 1e0 as probability from (select catalog_name || ':' || source_id as name, ra_deg - 9e1 as ra, source_id % 3 as off from catalog_sources)", "catalog_sources")
def registered_sources(spark, sf):
    c = view(spark, sf, "catalog_sources").select(F.concat_ws(":", "catalog_name", "source_id").alias("name"), (F.col("ra_deg") - 90.0).alias("ra_deg"), "dec_deg", F.col("flux_mjy").alias("flux"), (F.col("source_id") % 3).alias("offset"), (F.col("source_id") % 3 / 10.0).alias("err_offset"))
    m = F.col("crossmatches")[0]
    return catalogs.registered(c).select("name", r("ra_deg").alias("ra_deg"), "err", m["match_id"].alias("match_id"), m["probability"].alias("probability"))


@query(f", {_PIX} select s.map_id, cast(s.source_id as varchar) as name, round(s.flux, 4) as flux, round(n.e, 5) as err_flux, 1 as forced from (select source_id, source_id % 24 as map_id, flux_mjy / 1e3 as flux from catalog_sources) s join (select map_id, stddev_pop(flux) as e from p group by map_id) n using (map_id)", "pixels_raw", "catalog_sources")
def forced_table(spark, sf):
    """Fitted positions as a catalog whose errors are the deviation of their map."""
    s = view(spark, sf, "catalog_sources").select(F.col("source_id").alias("id"), (F.col("source_id") % 24).alias("map_id"), (F.col("flux_mjy") / 1000.0).alias("flux"))
    return catalogs.forced_table(s, _pixels(spark, sf)).select("map_id", "name", F.round("flux", 4).alias("flux"), F.round("err_flux", 5).alias("err_flux"), "forced")


@query("select '(' || b.n || ') Body' as designation, min(o.source_id) as orbit_id, arg_min(o.dec_deg, o.source_id) as semimajor_axis from (select distinct det_id % 97 as n from detections where det_id % 3 = 0 and flux_mjy > 1e3) b join catalog_sources o on o.source_id % 97 = b.n where o.source_id % 13 <> 0 group by b.n", "detections", "catalog_sources")
def orbital_table(spark, sf):
    """Orbits of the bright minor planets that have one."""
    i = F.col("det_id")
    name = F.when(i % 3 == 0, F.concat((i % 97).cast("string"), F.lit(" Body (1983 SA)"))).when(i % 3 == 1, F.lit("C/2020 X1")).otherwise("(2004 AB)")
    fluxes = view(spark, sf, "detections").select(name.alias("name"), F.col("flux_mjy").alias("flux"))
    s = F.col("source_id")
    orbits = view(spark, sf, "catalog_sources").select(F.concat(F.lit("("), (s % 97).cast("string"), F.lit(") Body")).alias("designation"), s.alias("orbit_id"), F.when(s % 13 != 0, F.col("dec_deg")).alias("semimajor_axis"))
    return catalogs.orbital_table(fluxes, orbits, 1000.0).select("designation", "orbit_id", "semimajor_axis")


@query("select m.map_id, p.pix_map, p.gy, p.gx from (select map_id, obs_start + 4e-1 as t from maps) m join lateral (select q.map_id as pix_map, q.gy, q.gx from pixels_raw q where q.t_unix >= m.t - 1 and q.t_unix <= m.t + 1 order by abs(q.t_unix - m.t), q.map_id, q.gy, q.gx limit 1) p on true", "maps", "pixels_raw")
def position_of_time(spark, sf):
    """The pixel whose time is nearest to a time, within a second."""
    asks = view(spark, sf, "maps").select("map_id", (F.col("obs_start") + 0.4).alias("t")).withColumns({"t0": F.col("t") - 1.0, "t1": F.col("t") + 1.0})
    pix = view(spark, sf, "pixels_raw").groupBy("t_unix").agg(F.min(F.struct(F.col("map_id").alias("pix_map"), "gy", "gx")).alias("at"))
    found = joins.interval_join(asks, pix, "t0", "t1", "t_unix", 64.0)
    best = found.groupBy("map_id").agg(F.min(F.struct(F.abs(F.col("t_unix") - F.col("t")).alias("d"), "at")).alias("b"))
    return best.select("map_id", "b.at.pix_map", "b.at.gy", "b.at.gx")


@query(f", {_COADD}, located as (select *, {_GY} as gy, {_GX} as gx from catalog_sources), own as (select l.source_id, l.gy, l.gx, c.t_mean from located l left join coadd c using (gy, gx)) select o.source_id, round(coalesce(any_value(o.t_mean), avg(c.t_mean)), 3) as t from own o left join coadd c on o.t_mean is null and abs(c.gy - o.gy) <= 2 and abs(c.gx - o.gx) <= 2 group by o.source_id", "pixels_raw", "catalog_sources")
def time_nearest_first(spark, sf):
    """The time of a source's own pixel; only without one the mean of those around it."""
    times = _whole(spark, sf).select("gy", "gx", "t_mean")
    own = _located(spark, sf).select("source_id", "gy", "gx").join(times, ["gy", "gx"], "left")
    steps = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in range(-2, 3) for x in range(-2, 3)])
    near = own.where("t_mean is null").withColumn("d", F.explode(steps)).select("source_id", (F.col("gy") + F.col("d.y")).alias("gy"), (F.col("gx") + F.col("d.x")).alias("gx"))
    mean = near.join(times, ["gy", "gx"]).groupBy("source_id").agg(F.avg("t_mean").alias("t_near"))
    return own.join(mean, "source_id", "left").select("source_id", F.round(F.coalesce("t_mean", "t_near"), 3).alias("t"))


@query("select map_id, gy, gx, round(sum(rho) * case when gy < 5 then 0 else 1 end * case when gx % 7 = 0 then 0 else 1 end * min(mask) + 3e-8, 5) as rho from pixels_raw group by map_id, gy, gx", "pixels_raw")
def masked_map(spark, sf):
    """A map times its edge, galaxy and planet masks."""
    p = view(spark, sf, "pixels_raw").groupBy("map_id", "gy", "gx").agg(F.sum("rho").alias("rho"), F.min("mask").alias("planet"))
    p = p.withColumns({"edge": F.when(F.col("gy") < 5, 0), "galaxy": F.when(F.col("gx") % 7 == 0, 0)})
    return maps.mask_product(p, ["rho"], ["edge", "galaxy", "planet"]).select("map_id", "gy", "gx", F.round(F.col("rho") + 3e-8, 5).alias("rho"))


_FOOTPRINT = "ok as (select distinct band, gy, gx from (select freq as band, gy, gx, sum(kappa) as k from pixels_raw group by all) where k > 0), grid as (select band, gy, gx from (select distinct band from ok), (select unnest(range(60)) as gy), (select unnest(range(60)) as gx)), bad as (select * from grid anti join ok using (band, gy, gx)), out_ as (select band, gy, gx from bad where gy in (0, 59) or gx in (0, 59) union select b.band, b.gy, b.gx from out_ o join bad b on b.band = o.band and abs(b.gy - o.gy) + abs(b.gx - o.gx) = 1)"


@query("with recursive " + duck("pixels_raw").strip().removeprefix("with ") + f", {_FOOTPRINT} select ok.band, ok.gy, ok.gx, case when count(o.gy) > 0 then 0 else 1 end as edge from ok left join out_ o on o.band = ok.band and pow(o.gy - ok.gy, 2) + pow(o.gx - ok.gx, 2) <= 4 group by ok.band, ok.gy, ok.gx")
def edge_distance(spark, sf):
    """Pixels farther than two from the edge of each band's footprint, whose holes are filled."""
    p = view(spark, sf, "pixels_raw").groupBy(F.col("freq").alias("map_id"), "gy", "gx").agg(F.sum("kappa").alias("kappa"))
    p = p.where(maps.valid(F.col("kappa")))
    return maps.edge_mask(p, p, 60, 60, 2).select(F.col("map_id").alias("band"), "gy", "gx", "edge")


@query("with recursive " + duck("pixels_raw", "catalog_sources").strip().removeprefix("with ") + ", p as (select map_id, gy, gx, sum(rho) as rho, sum(kappa) as kappa from pixels_raw group by all), q as (select p.map_id, gy, gx, rho * rho / greatest(kappa, top * 1e-4) as v from p join (select map_id, max(kappa) as top from p group by map_id) using (map_id)), s as (select source_id, source_id % 24 as map_id, source_id * 7 % 60 as sy, source_id * 11 % 60 as sx from catalog_sources), near as (select s.source_id, s.map_id, sy, sx, gy, gx, v from s join q on q.map_id = s.map_id and abs(gy - sy) <= 4 and abs(gx - sx) <= 4 where v > 4e0 and sqrt(pow(gy - sy, 2) + pow(gx - sx, 2)) < 4e0), reg as (select source_id, gy, gx, v from near where gy = sy and gx = sx union select n.source_id, n.gy, n.gx, n.v from reg r join near n on n.source_id = r.source_id and abs(n.gy - r.gy) + abs(n.gx - r.gx) = 1) select s.source_id, round(coalesce(sum(v * gy) / sum(v), any_value(sy)), 6) as y, round(coalesce(sum(v * gx) / sum(v), any_value(sx)), 6) as x from s left join reg using (source_id) group by s.source_id")
def centre_of_mass(spark, sf):
    """Sources moved to the centre of mass of the strong region that they lie in."""
    p = view(spark, sf, "pixels_raw").groupBy("map_id", "gy", "gx").agg(F.sum("rho").alias("rho"), F.sum("kappa").alias("kappa"))
    s = view(spark, sf, "catalog_sources").select("source_id", (F.col("source_id") % 24).alias("map_id"), (F.col("source_id") * 7 % 60).cast("int").alias("gy"), (F.col("source_id") * 11 % 60).cast("int").alias("gx"))
    return maps.centre_of_mass(s, p, 4, 4.0, snr_at_least=2.0).select("source_id", r("y").alias("y"), r("x").alias("x"))


@query(f", {SIFT}, {_PIX}, d as (select a.*, det_id % 24 as map_id, det_id * 7 % 60 as gy, det_id * 11 % 60 as gx, case when b.source_id is not null and not {CUT} then case when a.flux_mjy / b.cat_flux > 5 then 'transient' else 'source' end when {CUT} then 'noise' else 'transient' end as first from detections a left join best b using (det_id)), e as (select det_id, any_value(d.flux_mjy) / 1e2 / stddev_pop(p.flux) as new_snr from d join p using (map_id) where first = 'transient' and abs(p.gy - d.gy) <= 5 and abs(p.gx - d.gx) <= 5 and sqrt(pow(p.gy - d.gy, 2) + pow(p.gx - d.gx, 2)) >= 2 group by det_id having stddev_pop(p.flux) > 0) select det_id, first, case when first = 'transient' and not coalesce(new_snr > 5 and d.snr / new_snr < 10, false) then 'noise' else first end as class from d left join e using (det_id)", "detections", "catalog_sources", "pixels_raw")
def sift_retested(spark, sf):
    """The default classes, after transients were held against the noise around them."""
    found = sift.default(view(spark, sf, "detections"), _catalog(spark, sf), (F.col("snr") < 5) | (F.col("flux_mjy") <= 0))
    i = F.col("det_id")
    found = found.withColumns({"map_id": i % 24, "gy": (i * 7 % 60).cast("int"), "gx": (i * 11 % 60).cast("int"), "peak": F.col("flux_mjy") / 100.0, "first": F.col("class")})
    return sift.retested(found, _pixels(spark, sf), 5, F.lit(2.0)).select("det_id", "first", "class")


@query("select det_id, round(sqrt(coalesce(pow(own, 2), pow(22e-1 / sqrt(flux_mjy / err), 2)) + 1e-2), 6) as err_ra, round(sqrt(pow(22e-1 / sqrt(flux_mjy / err), 2) + 4e-2), 6) as err_dec from (select det_id, flux_mjy, flux_mjy / snr as err, case when det_id % 2 = 0 then snr / 1e1 end as own from detections where flux_mjy > 0)", "detections")
def sift_errors(spark, sf):
    d = view(spark, sf, "detections").where("flux_mjy > 0").select("det_id", F.col("flux_mjy").cast("double").alias("flux_mjy"), (F.col("flux_mjy") / F.col("snr")).cast("double").alias("err_flux_mjy"), F.when(F.col("det_id") % 2 == 0, F.col("snr") / 10.0).alias("err_ra"), F.lit(None).cast("double").alias("err_dec"))
    return sift.with_errors(d, 2.2, 0.1, 0.2).select("det_id", r("err_ra").alias("err_ra"), r("err_dec").alias("err_dec"))


@query("select map_id, '17' || lpad(cast(map_id % 1000 as varchar), 3, '0') as folder, freq, 'pa5' as arr, '/d/17' || lpad(cast(map_id % 1000 as varchar), 3, '0') || '/depth1_' || cast(1700000000 + map_id as varchar) || '_pa5_' || freq || '_ivar.fits' as ivar_path from maps", "maps")
def map_files(spark, sf):
    """Map files by folder, band and array, with the path of the weights beside them."""
    from skyquarry.sources.tables import map_files as files

    m = view(spark, sf, "maps")
    path = F.concat(F.lit("/d/17"), F.lpad((F.col("map_id") % 1000).cast("string"), 3, "0"), F.lit("/depth1_"), (F.lit(1700000000) + F.col("map_id")).cast("string"), F.lit("_pa5_"), F.col("freq"), F.lit("_map.fits"))
    return files(m.select("map_id", path.alias("path"))).select("map_id", "folder", "freq", "arr", "ivar_path")


@query(f", {_PIX} select map_id, gy, gx, round(((gx - 359) * -5e-1 % 36e1 + 36e1) % 36e1, 6) as ra, round((gy - 99) * 5e-1, 6) as dec from (select distinct map_id, gy, gx from p)", "pixels_raw")
def wide_field(spark, sf):
    """Positions of pixels in the whole-sky geometry."""
    g = sky.wide_field(30.0)
    at = sky.position(F.col("gy"), F.col("gx"), **{k: v for k, v in g.items() if k not in ("ny", "nx")})
    p = view(spark, sf, "pixels_raw").select("map_id", "gy", "gx").distinct()
    return p.select("map_id", "gy", "gx", r(at[0]).alias("ra"), r(at[1]).alias("dec"))


@query("with recursive " + duck("pixels_raw").strip().removeprefix("with ") + ", o as (select freq as map_id, gy, gx, sum(rho) / sum(kappa) as v from pixels_raw group by all having sum(rho) / sum(kappa) > 5e-1), up as (select a.map_id, a.gy, a.gx, b.gy as uy, b.gx as ux from o a join o b on a.map_id = b.map_id and abs(a.gy - b.gy) <= 1 and abs(a.gx - b.gx) <= 1 qualify row_number() over (partition by a.map_id, a.gy, a.gx order by b.v desc, b.gy, b.gx) = 1), way as (select map_id, gy, gx, gy as cy, gx as cx from up union select w.map_id, w.gy, w.gx, u.uy, u.ux from way w join up u on u.map_id = w.map_id and u.gy = w.cy and u.gx = w.cx), root as (select w.map_id, w.gy, w.gx, w.cy, w.cx from way w join up u on u.map_id = w.map_id and u.gy = w.cy and u.gx = w.cx and u.uy = w.cy and u.ux = w.cx) select r.map_id as band, r.cy || '_' || r.cx as label, count(*) as n_pixels, round(max(o.v), 6) as peak, round(sum(o.v * o.gx) / sum(o.v), 6) as x, round(sum(o.v * o.gy) / sum(o.v), 6) as y from root r join o using (map_id, gy, gx) group by r.map_id, r.cy, r.cx having count(*) >= 2")
def segment_deblended(spark, sf):
    """Sources of each band's coadd, blended regions cut between their peaks."""
    p = view(spark, sf, "pixels_raw").groupBy(F.col("freq").alias("map_id"), "gy", "gx").agg((F.sum("rho") / F.sum("kappa")).alias("v"))
    return kernels.regions(p, "v", 0.5, deblend=True).select(F.col("map_id").alias("band"), "label", "n_pixels", r("peak").alias("peak"), r("x").alias("x"), r("y").alias("y"))


@query(f", {_PIX}, weak as (select map_id, gy as sy, gx as sx from p where kappa < 2e1) select map_id, gy, gx, round(sqrt(min((sy - gy) ** 2 + (sx - gx) ** 2)), 6) as distance from p left join weak using (map_id) group by map_id, gy, gx", "pixels_raw")
def weak_distance(spark, sf):
    """Every pixel's distance to the nearest pixel of little weight in its map."""
    p = _pixels(spark, sf).select("map_id", "gy", "gx", "kappa")
    return distance.with_distance(p, p.where("kappa < 20")).select("map_id", "gy", "gx", r("distance").alias("distance"))


@query()
def segment_levels(spark, sf):
    """Sources of each band's coadd, blended regions cut into the branches of their tree of levels."""
    p = view(spark, sf, "pixels_raw").groupBy(F.col("freq").alias("map_id"), "gy", "gx").agg((F.sum("rho") / F.sum("kappa")).alias("v"))
    return kernels.regions(p, "v", 0.5, contrast=0.02).select(F.col("map_id").alias("band"), "label", "n_pixels", r("peak").alias("peak"), r("x").alias("x"), r("y").alias("y"))


@query()
def filter_tiles(spark, sf):
    """Matched-filtered maps on tiles cut along both axes, with the noise that the maps show."""
    return filters.filter_maps(_pixels(spark, sf), 60, 60, 30.0, 60.0, block=32, overlap=12, lres=(60, 60), edge=2, closing=1, bright=150.0, bright_radius=1, hole=1)


_TILE = "(select map_id, gy, gx, gy // 20 as ty, gx // 20 as tx, flux * sqrt(kappa) as v from p where kappa > 0)"
_AXIS = "(select unnest(range(0, 20)) as f)"


@query(f", {_PIX}, t as {_TILE}, along as (select map_id, ty, tx, gy, f as fx, sum(v * cos(2e0 * pi() * f * (gx - 20 * tx) / 2e1)) as re, -sum(v * sin(2e0 * pi() * f * (gx - 20 * tx) / 2e1)) as im from t, {_AXIS} group by all), both_ as (select map_id, ty, tx, fx, f as fy, sum(re * cos(2e0 * pi() * f * (gy - 20 * ty) / 2e1) + im * sin(2e0 * pi() * f * (gy - 20 * ty) / 2e1)) as re, sum(im * cos(2e0 * pi() * f * (gy - 20 * ty) / 2e1) - re * sin(2e0 * pi() * f * (gy - 20 * ty) / 2e1)) as im from along, {_AXIS} group by all), seen as (select map_id, ty, tx, count(*) as n from t group by all) select map_id, cast(least(fy, 20 - fy) // 3 as bigint) as \"by\", cast(least(fx, 20 - fx) // 2 as bigint) as bx, round(avg((re * re + im * im) / n) + 3e-8, 5) as power, count(*) as n from both_ join seen using (map_id, ty, tx) group by 1, 2, 3", "pixels_raw")
def noise_blocks(spark, sf):
    """The maps' noise spectrum over blocks of multipoles, from tiles of 20 by 20 pixels of half a degree."""
    ready = filters.apodised(_pixels(spark, sf), 60, 60)
    # a frequency of a tile is 36 multipoles
    found = filters.noise_spectrum(ready, 60, 60, 30.0, block=20, lres=(3 * 36.0, 2 * 36.0))
    return found.withColumn("power", F.round(F.col("power") + 3e-8, 5))


_KERN = "kern as (select i, 59 - abs(59 - abs(i + k)) as j, sum(sqrt(3e0) * pow(sqrt(3e0) - 2e0, abs(k))) as h from (select unnest(range(0, 60)) as i), (select unnest(range(-30, 31)) as k) group by all), coef as (select b.i as gy, gx, sum(v * b.h) as c from (select gy, a.i as gx, sum(v * a.h) as v from m join kern a on a.j = m.gx group by all) t join kern b on b.j = t.gy group by all)"
_WEIGHT = "case k when -1 then pow(1e0 - {t}, 3) / 6e0 when 0 then (4e0 - 6e0 * pow({t}, 2) + 3e0 * pow({t}, 3)) / 6e0 when 1 then (4e0 - 6e0 * pow(1e0 - {t}, 2) + 3e0 * pow(1e0 - {t}, 3)) / 6e0 else pow({t}, 3) / 6e0 end"


def _four(name: str, c: str) -> str:
    return f"{name} as (select source_id, cast(59 - abs(59 - abs(floor({c}) + k)) as int) as g, {_WEIGHT.format(t=f'({c} - floor({c}))')} as w from at_, (select unnest([-1, 0, 1, 2]) as k))"


@query(f", {_COADD}, m as (select gy, gx, rho / kappa as v from coadd where kappa > 0), {_KERN}, at_ as (select * from (select source_id, dec_deg / 2e0 + 30e0 as y, (case when ((ra_deg - 18e1) % 36e1 + 36e1) % 36e1 > 18e1 then ((ra_deg - 18e1) % 36e1 + 36e1) % 36e1 - 36e1 else ((ra_deg - 18e1) % 36e1 + 36e1) % 36e1 end) / -6e0 + 30e0 as x from catalog_sources) where y between 0 and 59 and x between 0 and 59), {_four('fy', 'y')}, {_four('fx', 'x')} select source_id, round(sum(fy.w * fx.w * coalesce(c, 0e0)) + 3e-8, 5) as flux from fy join fx using (source_id) left join coef on coef.gy = fy.g and coef.gx = fx.g group by source_id", "pixels_raw", "catalog_sources")
def spline_photometry(spark, sf):
    """The coadd's flux at each source's own position, between pixels, by cubic splines."""
    m = maps.with_flux_snr(_whole(spark, sf).where("kappa > 0")).select(F.lit(0).alias("map_id"), "gy", "gx", "flux")
    y, x = sky.pixel_at(F.col("ra_deg"), F.col("dec_deg"), **GRID)
    at = view(spark, sf, "catalog_sources").select(F.lit(0).alias("map_id"), "source_id", y.alias("y"), x.alias("x"))
    out = spline2d.at_positions(at, spline2d.coefficients(m, "flux", 60, 60), 60, 60, ["source_id"])
    return out.select("source_id", F.round(F.col("value") + 3e-8, 5).alias("flux"))


@query("select det_id, round(degrees(cos(d) * sin(a) / c), 6) as xi, round(degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / c), 6) as eta, round(ra_deg, 6) as ra, round(dec_deg, 6) as dec from (select *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a) as c from (select *, radians(dec_deg) as d, radians(dec_deg + (det_id % 7 - 3) / 1e1) as d0, radians((det_id % 5 - 2) / -1e1) as a from detections))", "detections")
def tangent_positions(spark, sf):
    """Detections on a plane that touches the sky near each, and back on the sky."""
    d = view(spark, sf, "detections")
    ra0, dec0 = F.col("ra_deg") + (F.col("det_id") % 5 - 2) / 10.0, F.col("dec_deg") + (F.col("det_id") % 7 - 3) / 10.0
    xi, eta = sky.tangent(F.col("ra_deg"), F.col("dec_deg"), ra0, dec0)
    ra, dec = sky.from_tangent(xi, eta, ra0, dec0)
    near = F.round(ra + 360.0 * F.rint((F.col("ra_deg") - ra) / 360.0), 6)  # in the detection's own turn
    return d.select("det_id", r(xi).alias("xi"), r(eta).alias("eta"), near.alias("ra"), r(dec).alias("dec"))


@query()
def tangent_stamps(spark, sf):
    """Stamps of the coadd around each source on the plane that touches the sky there."""
    m = maps.with_flux_snr(_whole(spark, sf).where("kappa > 0")).select(F.lit(0).alias("map_id"), "gy", "gx", "flux")
    s = view(spark, sf, "catalog_sources").select(F.lit(0).alias("map_id"), "source_id", "ra_deg", "dec_deg")
    return stamps.tangent_stamps(s, spline2d.coefficients(m, "flux", 60, 60), 2, 2.0, 60, 60, GRID)


@query(f", {_PIX}{_block_sql(3)}, e as (select map_id, by_, bx, stddev_pop(v) as rms from c3 group by all), rel as (select map_id, by_, bx, rms / m as r from (select *, median(rms) over (partition by map_id) as m from e) where m <> 0 and rms > 0), near_ as (select map_id, gy, gx, snr, floor((gy + 5e-1) / 1e1 - 5e-1) + a as by_, floor((gx + 5e-1) / 1e1 - 5e-1) + b as bx, abs(1 - a - ((gy + 5e-1) / 1e1 - 5e-1 - floor((gy + 5e-1) / 1e1 - 5e-1))) * abs(1 - b - ((gx + 5e-1) / 1e1 - 5e-1 - floor((gx + 5e-1) / 1e1 - 5e-1))) as w from p, (select unnest([0, 1]) as a), (select unnest([0, 1]) as b)), mean_ as (select map_id, gy, gx, sum(w * r) / sum(w) as rms from near_ join rel using (map_id, by_, bx) where w > 0 group by all) select map_id, gy, gx, round(rms, 6) as relative_rms, round(snr / coalesce(rms, 1e0) + 3e-8, 5) as snr from p left join mean_ using (map_id, gy, gx)", "pixels_raw")
def flat_field(spark, sf):
    """The snr of every pixel over its map's own relative noise, brought back from blocks of 10 pixels."""
    out = maps.flat_fielded(_pixels(spark, sf), 10)
    return out.select("map_id", "gy", "gx", r("relative_rms").alias("relative_rms"), F.round(F.col("snr") + 3e-8, 5).alias("snr"))
