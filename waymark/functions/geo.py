"""Distances on a sphere and on the WGS-84 ellipsoid, rectangles and grid cells, all of degrees."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: Metres of a degree of latitude used for boxes, and the service's degrees per kilometre.
DEGREE_M, DEGREES_PER_KM, LNG_SHRINK = 111_320.0, 0.009, 1.1


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle metres; null if a coordinate is null."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lng2 - lng1) / 2), 2
    )
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


HAVERSINE_SQL = (
    "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
    " + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))))"
)


def sql_distance(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return HAVERSINE_SQL.format(lat1=lat1, lng1=lng1, lat2=lat2, lng2=lng2)


def near_box(lat: Column, lng: Column, at: tuple[float, float], metres: float) -> Column:
    """A rectangle that holds the circle; plain comparisons, so it reaches the file scan."""
    up = metres / DEGREE_M * 1.01
    aside = up / max(0.01, math.cos(math.radians(at[0])))
    return lat.between(at[0] - up, at[0] + up) & lng.between(at[1] - aside, at[1] + aside)


def within(lat: Column, lng: Column, box: tuple[float, float, float, float]) -> Column:
    """Inside (min_lat, max_lat, min_lng, max_lng), borders included."""
    return lat.between(box[0], box[1]) & lng.between(box[2], box[3])


def cell(coordinate: Column, size: float) -> Column:
    return F.floor(coordinate / size).cast("long")


def rect_around(lat: Column, lng: Column, radius_km: Column) -> Column:
    """struct(min_lat, min_lng, max_lat, max_lng)."""
    up = radius_km * DEGREES_PER_KM
    aside = up / LNG_SHRINK
    return F.struct((lat - up).alias("min_lat"), (lng - aside).alias("min_lng"), (lat + up).alias("max_lat"), (lng + aside).alias("max_lng"))


def rect_text(rect: Column) -> Column:
    return F.format_string("%.4f,%.4f,%.4f,%.4f", rect["min_lat"], rect["min_lng"], rect["max_lat"], rect["max_lng"])


#: Fixed values of the WGS-84 ellipsoid; steps of the iteration and when it stands still (radians).
WGS84_A, WGS84_F = 6_378_137.0, 1 / 298.257223563
STEPS, STILL = 200, 1e-12
#: The smallest radius of curvature of the ellipsoid, at the equator along the meridian.
LEAST_RADIUS = WGS84_A * (1 - WGS84_F) ** 2


def geodesic(lat1: np.ndarray, lng1: np.ndarray, lat2: np.ndarray, lng2: np.ndarray) -> np.ndarray:
    """Metres along the shortest line on the ellipsoid, by Vincenty's iteration on the longitude of the auxiliary sphere.

    Pairs that stand still are left alone while the others go on. NaN where a coordinate is missing or no latitude, and
    for the nearly antipodal points at which the iteration does not come to rest within `STEPS` steps.
    """
    f, b = WGS84_F, WGS84_A * (1 - WGS84_F)
    values = [np.asarray(x, float) for x in (lat1, lng1, lat2, lng2)]
    shape = np.broadcast_shapes(*(x.shape for x in values))
    lat1, lng1, lat2, lng2 = (np.broadcast_to(x, shape).ravel() for x in values)
    out = np.full(len(lat1), np.nan)
    with np.errstate(invalid="ignore"):
        live = np.flatnonzero((np.abs(lat1) <= 90) & (np.abs(lat2) <= 90) & np.isfinite(lng1) & np.isfinite(lng2))
    apart = np.radians((lng2[live] - lng1[live] + 180) % 360 - 180)
    sines, cosines = [], []
    for lat in (lat1[live], lat2[live]):
        reduced = np.arctan((1 - f) * np.tan(np.radians(lat)))
        sines.append(np.sin(reduced))
        cosines.append(np.cos(reduced))
    (s1, s2), (c1, c2), turn = sines, cosines, apart.copy()
    for _ in range(STEPS):
        if not len(live):
            break
        sin_arc = np.hypot(c2 * np.sin(turn), c1 * s2 - s1 * c2 * np.cos(turn))
        cos_arc = s1 * s2 + c1 * c2 * np.cos(turn)
        arc = np.arctan2(sin_arc, cos_arc)
        same = sin_arc == 0
        sin_azimuth = np.divide(c1 * c2 * np.sin(turn), sin_arc, out=np.zeros_like(arc), where=~same)
        flat = 1 - sin_azimuth**2
        middle = cos_arc - np.divide(2 * s1 * s2, flat, out=np.zeros_like(arc), where=flat > 0)
        middle = np.where(flat > 0, middle, 0.0)
        c = f / 16 * flat * (4 + f * (4 - 3 * flat))
        new = apart + (1 - c) * f * sin_azimuth * (arc + c * sin_arc * (middle + c * cos_arc * (2 * middle**2 - 1)))
        done = (np.abs(new - turn) < STILL) | same
        u = flat * (WGS84_A**2 - b**2) / b**2
        big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        change = big_b * sin_arc * (
            middle + big_b / 4 * (cos_arc * (2 * middle**2 - 1) - big_b / 6 * middle * (4 * sin_arc**2 - 3) * (4 * middle**2 - 3))
        )
        metres = np.where(same & (cos_arc > 0), 0.0, b * big_a * (arc - change))
        good = done & ~(same & (cos_arc < 0)) & (np.abs(new) <= np.pi)
        out[live[good]] = metres[good]
        live, apart, turn, s1, s2, c1, c2 = (x[~done] for x in (live, apart, new, s1, s2, c1, c2))
    return out.reshape(shape)


def geodesic_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres on the WGS-84 ellipsoid, in Arrow batches; null where `geodesic` has none."""

    @F.pandas_udf("double")
    def metres(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(geodesic(a, b, c, d))

    return F.nanvl(metres(*(x.cast("double") for x in (lat1, lng1, lat2, lng2))), F.lit(None).cast("double"))


def geodesic_box(lat: Column, lng: Column, at: tuple[float, float], metres: float) -> Column:
    """A rectangle that holds every point within some metres on the ellipsoid; plain comparisons, so it reaches the scan.

    No line on the ellipsoid spans more degrees than on a sphere of its smallest radius of curvature. A circle that holds
    a pole or crosses the date line has no bound on longitude.
    """
    reach = metres / LEAST_RADIUS * 1.0001
    up = math.degrees(reach)
    inside = lat.between(at[0] - up, at[0] + up)
    if abs(at[0]) + up >= 90:
        return inside
    aside = math.degrees(math.asin(min(1.0, math.sin(min(reach, math.pi / 2)) / math.cos(math.radians(at[0])))))
    if at[1] - aside < -180 or at[1] + aside > 180:
        return inside
    return inside & lng.between(at[1] - aside, at[1] + aside)


def geodesic_sql(points: str) -> str:
    """Oracle text: common table expressions that end in geo(id, metres), from `points` with id, lat1, lng1, lat2, lng2."""
    f, a = WGS84_F, WGS84_A
    b = a * (1 - f)

    def step(inner: str) -> str:
        sphere = f"""SELECT *, sqrt(pow(c2 * sin(turn), 2) + pow(c1 * s2 - s1 * c2 * cos(turn), 2)) AS sa, s1 * s2 + c1 * c2 * cos(turn) AS ca FROM ({inner}) q0"""
        line = f"SELECT *, atan2(sa, ca) AS arc, c1 * c2 * sin(turn) / sa AS az FROM ({sphere}) q1"
        flat = f"SELECT *, 1 - az * az AS flat, CASE WHEN 1 - az * az > 0 THEN ca - 2 * s1 * s2 / (1 - az * az) ELSE 0 END AS mid FROM ({line}) q2"
        return f"SELECT *, {f!r} / 16 * flat * (4 + {f!r} * (4 - 3 * flat)) AS c FROM ({flat}) q3"

    new = f"apart + (1 - c) * {f!r} * az * (arc + c * sa * (mid + c * ca * (2 * mid * mid - 1)))"
    u = f"SELECT *, flat * {(a * a - b * b) / (b * b)!r} AS u FROM ({step('SELECT * FROM still')}) q4"
    ab = f"SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS ba, u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS bb FROM ({u}) q5"
    change = "bb * sa * (mid + bb / 4 * (ca * (2 * mid * mid - 1) - bb / 6 * mid * (4 * sa * sa - 3) * (4 * mid * mid - 3)))"
    return f"""start AS (SELECT id, radians(lng2 - lng1) AS apart, sin(atan({1 - f!r} * tan(radians(lat1)))) AS s1, cos(atan({1 - f!r} * tan(radians(lat1)))) AS c1,
  sin(atan({1 - f!r} * tan(radians(lat2)))) AS s2, cos(atan({1 - f!r} * tan(radians(lat2)))) AS c2 FROM {points}),
turns AS (SELECT *, apart AS turn, 9.0::DOUBLE AS was, 0 AS k FROM start UNION ALL SELECT id, apart, s1, c1, s2, c2, {new} AS turn, turn AS was, k + 1 AS k
  FROM ({step(f'SELECT * FROM turns WHERE abs(turn - was) >= {STILL} AND k < {STEPS}')}) q),
still AS (SELECT * FROM turns QUALIFY row_number() OVER (PARTITION BY id ORDER BY k DESC) = 1),
geo AS (SELECT id, {b!r} * ba * (arc - {change}) AS metres FROM ({ab}) q6)"""
