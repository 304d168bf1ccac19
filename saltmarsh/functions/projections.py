"""Map projections: Column to Column, in closed form, so a projected table is one narrow pass inside code generation.

A Lambert conformal conic projection with two standard parallels on an ellipsoid. The constants of a projection are
computed once on the driver. The inverse goes from the isometric to the geodetic latitude by the series in the third
flattening, whose first left-out term is below 1e-19, in place of iterations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a US survey foot in metres.
SURVEY_FOOT = 1200 / 3937


@dataclass(frozen=True)
class Conic:
    """Angles in degrees, false easting and northing in the projection's unit, which is so many metres."""

    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float
    false_easting: float
    false_northing: float
    unit: float = 1.0
    semi_major: float = 6378137.0  # GRS 80
    flattening: float = 1 / 298.257222101

    @property
    def eccentricity(self) -> float:
        return math.sqrt(self.flattening * (2 - self.flattening))

    def _isometric(self, degrees: float) -> float:
        """exp of minus the isometric latitude."""
        phi, e = math.radians(degrees), self.eccentricity
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    def _constants(self) -> tuple[float, float, float]:
        """The cone's constant, the radius in units of the projection at exp(0), and that of the origin."""
        e = self.eccentricity
        scale = lambda degrees: math.cos(math.radians(degrees)) / math.sqrt(1 - (e * math.sin(math.radians(degrees))) ** 2)
        t1, t2, t0 = self._isometric(self.lat_1), self._isometric(self.lat_2), self._isometric(self.lat_0)
        if self.lat_1 == self.lat_2:
            n = math.sin(math.radians(self.lat_1))
        else:
            n = math.log(scale(self.lat_1) / scale(self.lat_2)) / math.log(t1 / t2)
        whole = self.semi_major / self.unit * scale(self.lat_1) / (n * t1**n)
        return n, whole, whole * t0**n

    def _series(self) -> list[float]:
        """Coefficients of sin(2k chi), k from 1, of the geodetic less the conformal latitude chi."""
        n = self.flattening / (2 - self.flattening)
        # The published series in the third flattening, by rising powers from n**k on
        rows = (
            (2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
            (7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
            (56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
            (4279 / 630, -332 / 35, -399572 / 14175),
            (4174 / 315, -144838 / 6237),
            (601676 / 22275,),
        )
        return [sum(c * n ** (k + i) for i, c in enumerate(row)) for k, row in enumerate(rows, 1)]

    def forward(self, longitude: Column, latitude: Column) -> Column:
        """struct(x, y) of degrees; null where a coordinate is null or the latitude is no latitude."""
        n, whole, origin = self._constants()
        e, phi = self.eccentricity, F.radians(latitude)
        sine = F.sin(phi) * e
        t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - sine) / (1 + sine), F.lit(e / 2))
        radius, theta = F.pow(t, F.lit(n)) * whole, F.radians(longitude - self.lon_0) * n
        x, y = radius * F.sin(theta) + self.false_easting, origin - radius * F.cos(theta) + self.false_northing
        given = longitude.isNotNull() & latitude.between(-90, 90)
        return F.when(given, F.struct(x.alias("x"), y.alias("y")))

    def inverse(self, x: Column, y: Column) -> Column:
        """struct(longitude, latitude) in degrees; null where a coordinate is null."""
        n, whole, origin = self._constants()
        east, south = x - self.false_easting, origin - (y - self.false_northing)
        sign = 1.0 if n > 0 else -1.0
        t = F.pow(F.sqrt(east * east + south * south) / abs(whole), F.lit(1 / n))
        chi = math.pi / 2 - 2 * F.atan(t)
        phi = chi
        for k, c in enumerate(self._series(), 1):
            phi = phi + F.sin(chi * (2 * k)) * c
        longitude = F.degrees(F.atan2(east * sign, south * sign) / n) + self.lon_0
        return F.when(x.isNotNull() & y.isNotNull(), F.struct(longitude.alias("longitude"), F.degrees(phi).alias("latitude")))


# The public definitions of two state-plane zones on NAD83 in survey feet.
CRS = {
    "EPSG:2229": Conic(35 + 28 / 60, 34 + 2 / 60, 33.5, -118.0, 6561666.667, 1640416.667, SURVEY_FOOT),
    "EPSG:2230": Conic(33 + 53 / 60, 32 + 47 / 60, 32 + 10 / 60, -116.25, 6561666.667, 1640416.667, SURVEY_FOOT),
}


def to_degrees(x: Column, y: Column, crs: str) -> Column:
    """struct(longitude, latitude) of plane coordinates in a system of ``CRS``. NAD83 counts as WGS 84, from which it differs
    by a metre or two.
    """
    return CRS[crs].inverse(x, y)


def from_degrees(longitude: Column, latitude: Column, crs: str) -> Column:
    return CRS[crs].forward(longitude, latitude)
