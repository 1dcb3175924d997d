"""Map projections as column arithmetic.

Conic projections follow Snyder (USGS Professional Paper 1395); the inverse
latitudes use the closed series of Karney, "On auxiliary latitudes" (2022), so
that every coordinate is one flat expression without iteration. Constants of a
system are computed once when the plan is built. Datum shifts between the
registered systems are taken as zero.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

US_SURVEY_FOOT = 0.304800609601219

# Coefficients of the third flattening n, n^2, n^3, n^4 in the
# sine series of 2, 4, 6 and 8 times the auxiliary latitude.
FROM_CONFORMAL = (
    (2, -2 / 3, -2, 116 / 45),
    (0, 7 / 3, -8 / 5, -227 / 45),
    (0, 0, 56 / 15, -136 / 35),
    (0, 0, 0, 4279 / 630),
)
FROM_AUTHALIC = (
    (4 / 3, 4 / 45, -16 / 35, -2582 / 14175),
    (0, 46 / 45, 152 / 945, -11966 / 14175),
    (0, 0, 3044 / 2835, 3802 / 14175),
    (0, 0, 0, 6059 / 4725),
)


@dataclass(frozen=True)
class Geographic:
    """Longitude and latitude in degrees."""

    def to_degrees(self, x: Column, y: Column) -> tuple[Column, Column]:
        return x, y

    def from_degrees(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        return lon, lat


@dataclass(frozen=True)
class Conic:
    """Shared constants of a conic projection with two standard parallels.

    ``axis`` is the semi-major axis in the unit of the coordinates; angles are
    in degrees.
    """

    axis: float
    eccentricity2: float
    parallel1: float
    parallel2: float
    origin_lat: float
    origin_lon: float
    false_easting: float = 0.0
    false_northing: float = 0.0

    @property
    def e(self) -> float:
        return math.sqrt(self.eccentricity2)

    @property
    def third_flattening(self) -> float:
        b = math.sqrt(1 - self.eccentricity2)
        return (1 - b) / (1 + b)

    def _m(self, degrees: float) -> float:
        phi = math.radians(degrees)
        return math.cos(phi) / math.sqrt(1 - self.eccentricity2 * math.sin(phi) ** 2)

    def _unroll(self, aux: Column, series: tuple) -> Column:
        """Auxiliary latitude to geographic latitude, both in radians."""
        n = self.third_flattening
        latitude = aux
        for multiple, row in enumerate(series, start=1):
            factor = sum(c * n ** (power + 1) for power, c in enumerate(row))
            latitude = latitude + F.lit(factor) * F.sin(aux * F.lit(2.0 * multiple))
        return latitude

    def _plane(self, radius: Column, cone: float, rho0: float, lon: Column):
        theta = F.radians(lon - F.lit(self.origin_lon)) * F.lit(cone)
        return (
            F.lit(self.false_easting) + radius * F.sin(theta),
            F.lit(self.false_northing + rho0) - radius * F.cos(theta),
        )

    def _polar(self, x: Column, y: Column, cone: float, rho0: float):
        """Distance from the cone's apex and longitude of a plane position."""
        east = x - F.lit(self.false_easting)
        south = F.lit(self.false_northing + rho0) - y
        sign = math.copysign(1.0, cone)
        theta = F.atan2(east * F.lit(sign), south * F.lit(sign))
        radius = F.sqrt(east * east + south * south) * F.lit(sign)
        return radius, F.lit(self.origin_lon) + F.degrees(theta / F.lit(cone))


@dataclass(frozen=True)
class LambertConformal(Conic):
    def _t(self, degrees: float) -> float:
        phi, e = math.radians(degrees), self.e
        skew = ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
        return math.tan(math.pi / 4 - phi / 2) / skew

    def _constants(self) -> tuple[float, float, float]:
        m1, m2 = self._m(self.parallel1), self._m(self.parallel2)
        t1, t2 = self._t(self.parallel1), self._t(self.parallel2)
        cone = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        scale = self.axis * m1 / (cone * t1**cone)
        return cone, scale, scale * self._t(self.origin_lat) ** cone

    def from_degrees(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        cone, scale, rho0 = self._constants()
        phi = F.radians(lat)
        e_sin = F.sin(phi) * F.lit(self.e)
        skew = F.pow((F.lit(1.0) - e_sin) / (F.lit(1.0) + e_sin), F.lit(self.e / 2))
        t = F.tan(F.lit(math.pi / 4) - phi / F.lit(2.0)) / skew
        return self._plane(F.lit(scale) * F.pow(t, F.lit(cone)), cone, rho0, lon)

    def to_degrees(self, x: Column, y: Column) -> tuple[Column, Column]:
        cone, scale, rho0 = self._constants()
        radius, lon = self._polar(x, y, cone, rho0)
        t = F.pow(radius / F.lit(scale), F.lit(1 / cone))
        conformal = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
        return lon, F.degrees(self._unroll(conformal, FROM_CONFORMAL))


@dataclass(frozen=True)
class AlbersEqualArea(Conic):
    def _q(self, degrees: float) -> float:
        s, e, e2 = math.sin(math.radians(degrees)), self.e, self.eccentricity2
        return (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)

    def _constants(self) -> tuple[float, float, float]:
        m1, m2 = self._m(self.parallel1), self._m(self.parallel2)
        q1, q2 = self._q(self.parallel1), self._q(self.parallel2)
        cone = (m1**2 - m2**2) / (q2 - q1)
        c = m1**2 + cone * q1
        return cone, c, self.axis * math.sqrt(c - cone * self._q(self.origin_lat)) / cone

    def from_degrees(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        cone, c, rho0 = self._constants()
        e, e2 = self.e, self.eccentricity2
        s = F.sin(F.radians(lat))
        log_part = F.log((F.lit(1.0) + s * F.lit(e)) / (F.lit(1.0) - s * F.lit(e)))
        q = (s / (F.lit(1.0) - s * s * F.lit(e2)) + log_part * F.lit(0.5 / e)) * F.lit(1 - e2)
        radius = F.sqrt(F.lit(c) - q * F.lit(cone)) * F.lit(self.axis / cone)
        return self._plane(radius, cone, rho0, lon)

    def to_degrees(self, x: Column, y: Column) -> tuple[Column, Column]:
        cone, c, rho0 = self._constants()
        radius, lon = self._polar(x, y, cone, rho0)
        q = (F.lit(c) - F.pow(radius * F.lit(cone / self.axis), F.lit(2.0))) / F.lit(cone)
        authalic = F.asin(q / F.lit(self._q(90.0)))
        return lon, F.degrees(self._unroll(authalic, FROM_AUTHALIC))


def _flattening_to_e2(inverse_flattening: float) -> float:
    f = 1 / inverse_flattening
    return f * (2 - f)


GRS80_AXIS = 6378137.0
GRS80_E2 = _flattening_to_e2(298.257222101)

# Parameters of the registered reference systems by code.
SYSTEMS = {
    4326: Geographic(),
    2926: LambertConformal(
        axis=GRS80_AXIS / US_SURVEY_FOOT,
        eccentricity2=GRS80_E2,
        parallel1=48.7333333333333,
        parallel2=47.5,
        origin_lat=47.0,
        origin_lon=-120.833333333333,
        false_easting=1640416.667,
    ),
    102003: AlbersEqualArea(
        axis=GRS80_AXIS,
        eccentricity2=GRS80_E2,
        parallel1=29.5,
        parallel2=45.5,
        origin_lat=37.5,
        origin_lon=-96.0,
    ),
}


def system(epsg: int):
    if epsg not in SYSTEMS:
        raise ValueError(f"unknown reference system {epsg}; known: {sorted(SYSTEMS)}")
    return SYSTEMS[epsg]


def convert(x: Column, y: Column, from_epsg: int, to_epsg: int) -> tuple[Column, Column]:
    """Coordinates of one registered system in another."""
    source, target = system(from_epsg), system(to_epsg)
    if from_epsg == to_epsg:
        return x, y
    return target.from_degrees(*source.to_degrees(x, y))
