"""Positions on the sphere, pixels of a plate-carrée map, and fluxes, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

#: Factors to the unit after "to_".
UNIT_FACTORS = {"deg_to_arcmin": 60.0, "deg_to_arcsec": 3600.0, "deg_to_rad": math.pi / 180, "mjy_to_jy": 1e-3, "jy_to_mjy": 1e3, "k_to_uk": 1e6, "day_to_s": 86400.0}
#: 2 sqrt(2 ln 2)
FWHM_PER_SIGMA = 2.0 * math.sqrt(2.0 * math.log(2.0))


def convert(x: Column, name: str) -> Column:
    return x * F.lit(UNIT_FACTORS[name])


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in degrees (haversine); all in degrees, right ascension of any wrap."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2.0), F.lit(2.0))
    h = half(dec1, dec2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half(ra1, ra2)
    return F.lit(2.0) * F.degrees(F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def ra_positive(ra: Column) -> Column:
    return F.when(ra < 0, ra + 360.0).otherwise(ra)


def ra_signed(ra: Column) -> Column:
    return F.when(ra > 180, ra - 360.0).otherwise(ra)


def ra_of_set(ra: Column, by: list[Column]) -> tuple[Column, Column]:
    """(right ascension, system): [-180, 180) for a set with any negative value, else [0, 360). by are the set's keys."""
    negative = F.min(ra).over(Window.partitionBy(*by)) < 0
    signed = F.pmod(ra + 180.0, F.lit(360.0)) - 180.0
    return F.when(negative, signed).otherwise(F.pmod(ra, F.lit(360.0))), F.when(negative, "-180-180").otherwise("0-360")


def limits_valid(low: Column, high: Column, least: float, most: float) -> Column:
    """Whether both limits are given and within [least, most]; 0 and 360 for right ascension, -90 and 90 for declination."""
    return F.coalesce((low >= least) & (high <= most), F.lit(False))


def box_wrapped(ra_min: Column, ra_max: Column) -> Column:
    """The left edge of a box, negative where the box crosses RA 0."""
    return F.when(ra_min > ra_max, ra_min - 360.0).otherwise(ra_min)


def box_unwrapped(left: Column) -> Column:
    """The left edge in [0, 360) again."""
    return F.pmod(left, F.lit(360.0))


def event_unix(text: Column) -> Column:
    """Seconds since 1970 of `2024-01-02 03:04:05[.678]` or ISO text, read as UTC; null if it is neither."""
    return unix_of(text.try_cast("timestamp_ntz"))


#: The observatory: longitude and latitude in degrees, height in metres. Fixed values.
OBSERVER = {"latitude": -22.96098, "longitude": -67.7876, "height": 5180.0}


def wide_field(res_arcmin: float, variant: str = "fejer1") -> dict[str, float]:
    """The plate-carrée geometry of the whole sky from declination -60 to 20: ny, nx and what pixel and position need."""
    extra = {"fejer1": 0, "cc": 1}[variant.lower()]
    res = res_arcmin / 60.0
    ny, nx = round(80.0 / res) + extra, round(360.0 / res)
    if abs(res * (ny - extra) - 80.0) > 1e-6 or abs(res * nx - 360.0) > 1e-6:
        raise ValueError("the resolution does not divide the sky evenly")
    return {"ny": ny, "nx": nx, "crval_ra": 0.0, "crpix_x": float(nx // 2), "cdelt_ra": -360.0 / nx, "crpix_y": (ny + 20.0 / res) / 2, "cdelt_dec": 80.0 / (ny - extra)}


def in_box(ra: Column, dec: Column, ra_min, ra_max, dec_min, dec_max) -> Column:
    """Strictly inside a box; ra_min > ra_max means that the box crosses RA 0."""
    at, width = F.pmod(ra - F.lit(ra_min), F.lit(360.0)), F.pmod(F.lit(ra_max) - F.lit(ra_min), F.lit(360.0))
    return (at > 0) & (at < width) & (dec > dec_min) & (dec < dec_max)


def pixel(ra: Column, dec: Column, crval_ra: float, crpix_x: float, cdelt_ra: float, crpix_y: float, cdelt_dec: float, nearest: bool = True) -> tuple[Column, Column]:
    """(gy, gx) of a position, rounded half to even or truncated towards zero."""
    x = (ra_signed(F.pmod(ra - F.lit(crval_ra), F.lit(360.0)))) / F.lit(cdelt_ra) + F.lit(crpix_x - 1)
    y = dec / F.lit(cdelt_dec) + F.lit(crpix_y - 1)
    cut = (lambda v: F.rint(v).cast("int")) if nearest else (lambda v: v.cast("int"))
    return cut(y), cut(x)


def pixel_at(ra: Column, dec: Column, crval_ra: float, crpix_x: float, cdelt_ra: float, crpix_y: float, cdelt_dec: float) -> tuple[Column, Column]:
    """(y, x) of a position in pixels, not rounded."""
    x = ra_signed(F.pmod(ra - F.lit(crval_ra), F.lit(360.0))) / F.lit(cdelt_ra) + F.lit(crpix_x - 1)
    return dec / F.lit(cdelt_dec) + F.lit(crpix_y - 1), x


def tangent(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """(xi, eta) in degrees of a position on the plane that touches the sky at (ra0, dec0); null from 90 degrees on."""
    d, d0, a = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    on = lambda v: F.when(c > 0, F.degrees(v / c))
    return on(F.cos(d) * F.sin(a)), on(F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a))


def from_tangent(xi: Column, eta: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """(ra, dec) in degrees of a place on the plane that touches the sky at (ra0, dec0)."""
    x, y, d0 = F.radians(xi), F.radians(eta), F.radians(dec0)
    across = F.cos(d0) - y * F.sin(d0)
    ra = F.pmod(ra0 + F.degrees(F.atan2(x, across)), F.lit(360.0))
    return ra, F.degrees(F.atan2(F.sin(d0) + y * F.cos(d0), F.sqrt(x * x + across * across)))


def position(gy: Column, gx: Column, crval_ra: float, crpix_x: float, cdelt_ra: float, crpix_y: float, cdelt_dec: float) -> tuple[Column, Column]:
    """(ra, dec) of a pixel's centre, right ascension in [0, 360)."""
    ra = F.pmod((gx - F.lit(crpix_x - 1)) * F.lit(cdelt_ra) + F.lit(crval_ra), F.lit(360.0))
    return ra, (gy - F.lit(crpix_y - 1)) * F.lit(cdelt_dec)


def flux(rho: Column, kappa: Column) -> Column:
    """rho / kappa, 0 where kappa is 0."""
    return F.when(kappa == 0, 0.0).otherwise(F.try_divide(rho, kappa))


def snr(rho: Column, kappa: Column) -> Column:
    return F.when(kappa <= 0, 0.0).otherwise(F.try_divide(rho, F.sqrt(kappa)))


def flux_error(kappa: Column) -> Column:
    return F.when(kappa <= 0, 0.0).otherwise(F.try_divide(F.lit(1.0), F.sqrt(kappa)))


def rho_kappa(flux_: Column, snr_: Column) -> tuple[Column, Column]:
    """Back from flux and snr: snr^2 / flux and snr^2 / flux^2."""
    return F.try_divide(snr_ * snr_, flux_), F.try_divide(snr_ * snr_, flux_ * flux_)


def match_radius_deg(flux_mjy: Column, at_1jy_arcmin: float = 10.0, least: float = 1.5, most: float = 120.0) -> Column:
    """Matching radius that grows with flux, between bounds."""
    return F.least(F.greatest(flux_mjy / 1000.0 * at_1jy_arcmin, F.lit(least)), F.lit(most)) / 60.0


def noise_radius(peak: Column, noise: Column, fwhm_pix: Column, least=1) -> Column:
    """First whole pixel at which a Gaussian of this peak has fallen to the noise, `least` at least."""
    sigma = fwhm_pix / FWHM_PER_SIGMA
    out = F.when(peak > noise, F.ceil(sigma * F.sqrt(2.0 * F.log(F.try_divide(peak, noise))))).otherwise(0)
    return F.greatest(out.cast("double"), F.lit(float(least)))


def cut_radius(fwhm_arcmin: Column, res_arcmin: Column, filtered: bool = False, most_arcmin: float = 60.0) -> Column:
    """Radius in pixels cut around a source: twice the beam, wider after a matched filter."""
    return F.least(F.rint(2.0 * (math.sqrt(2.0) if filtered else 1.0) * fwhm_arcmin / res_arcmin), F.lit(most_arcmin) / res_arcmin)


def flare_flux(peak: Column, t: Column, t0: Column, width: Column, width_is_fwhm: bool = True) -> Column:
    sigma = width / FWHM_PER_SIGMA if width_is_fwhm else width
    return peak * F.exp(-0.5 * F.pow((t - t0) / sigma, F.lit(2.0)))


def gaussian_2d(x: Column, y: Column, amplitude, x0, y0, sx, sy, theta, offset) -> Column:
    """A rotated two-dimensional Gaussian over an offset."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    amplitude, x0, y0, sx, sy, theta, offset = map(lit, (amplitude, x0, y0, sx, sy, theta, offset))
    u = (x - x0) * F.cos(theta) + (y - y0) * F.sin(theta)
    v = -(x - x0) * F.sin(theta) + (y - y0) * F.cos(theta)
    return offset + amplitude * F.exp(-0.5 * (F.pow(u / sx, F.lit(2.0)) + F.pow(v / sy, F.lit(2.0))))


def beam_area_pixels(fwhm_x: Column, fwhm_y: Column, res: Column) -> Column:
    return F.lit(math.pi / (4 * math.log(2))) * fwhm_x * fwhm_y / (res * res)


def beam_fwhm_arcmin(solid_angle_nsr: Column) -> Column:
    """Beam width of a Gaussian beam with this solid angle in nanosteradian."""
    return F.degrees(F.sqrt(solid_angle_nsr * F.lit(1e-9 * 4 * math.log(2) / math.pi))) * 60.0


def ellipse_errors(major: Column, minor: Column, theta: Column) -> tuple[Column, Column]:
    """Errors along RA and Dec of a rotated error ellipse."""
    two = F.lit(2.0)
    a, b, c, s = F.pow(major, two), F.pow(minor, two), F.pow(F.cos(theta), two), F.pow(F.sin(theta), two)
    return F.sqrt(a * c + b * s), F.sqrt(a * s + b * c)


def position_error(fwhm: Column, flux_: Column, err: Column, jitter: Column) -> Column:
    """Beam over root of the significance, with pointing jitter in quadrature."""
    return F.sqrt(F.pow(F.try_divide(fwhm, F.sqrt(F.try_divide(flux_, err))), F.lit(2.0)) + F.pow(jitter, F.lit(2.0)))


def high_pass(ell: Column, knee: Column, alpha: Column) -> Column:
    return 1.0 / (1.0 + F.pow(F.greatest(ell, F.lit(0.5)) / knee, alpha))


def julian_day(unix: Column) -> Column:
    return unix / 86400.0 + 2440587.5


def unix_of(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session's zone is."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts) / F.lit(1e6)


def sphere_uniform(u: Column, v: Column, ra_min: float, ra_max: float, dec_min: float, dec_max: float) -> tuple[Column, Column]:
    """Positions uniform over a box of the sphere, from two uniform columns."""
    lo, hi = math.sin(math.radians(dec_min)), math.sin(math.radians(dec_max))
    width = (ra_max - ra_min) % 360.0 or 360.0
    return F.pmod(F.lit(ra_min) + u * width, F.lit(360.0)), F.degrees(F.asin(F.lit(lo) + v * (hi - lo)))


def hash_uniform(seed: int, *cols) -> Column:
    """A number in [0, 1) that depends on seed and cols alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))
