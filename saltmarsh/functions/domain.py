"""Environmental indices and levels: Column to Column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lower bounds of the hydrogen-sulfide guidance levels, ppb.
LEVELS = ((27000.0, "purple"), (30.0, "orange"), (5.0, "yellow"), (0.0, "green"))

# The US EPA's public AQI breakpoints (concentration low, high, index low, high), 24 h PM2.5 and PM10 in
# micrograms a cubic metre, as in force from 2012 to May 2024.
PM25 = ((0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400), (350.5, 500.4, 401, 500))
PM10 = ((0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150), (255, 354, 151, 200), (355, 424, 201, 300), (425, 504, 301, 400), (505, 604, 401, 500))


def threshold_level(value: Column) -> Column:
    """'white' for null; else the level's color; null below zero."""
    out = F.when(value.isNull(), "white")
    for least, color in LEVELS:
        out = out.when(value >= least, color)
    return out


def _sub_index(value: Column, table: tuple, digits: int) -> Column:
    c = F.floor(value * 10**digits) / 10**digits
    out = F.when(value < 0, None)
    for lo, hi, index_lo, index_hi in table:
        out = out.when(c <= hi, F.round((c - lo) * ((index_hi - index_lo) / (hi - lo)) + index_lo))
    return out.otherwise(500.0).cast("int")


def aqi(pm25: Column, pm10: Column) -> Column:
    """The larger of the two sub-indices; of one where the other is null; 500 beyond the table."""
    part = lambda c, table, digits: F.when(c.isNotNull(), _sub_index(c, table, digits))
    return F.greatest(part(pm25, PM25, 1), part(pm10, PM10, 0))


def gaussian_plume(q: Column, u: Column, y: Column, z: Column, h: Column, sigma_y: Column, sigma_z: Column) -> Column:
    """Concentration of a continuous point source with ground reflection; null where there is no wind or spread."""
    whole = F.when((u != 0) & (sigma_y != 0) & (sigma_z != 0), q / (2 * math.pi * u * sigma_y * sigma_z))
    across = F.exp(-(y * y) / (2 * sigma_y * sigma_y))
    up = lambda d: F.exp(-(d * d) / (2 * sigma_z * sigma_z))
    return whole * across * (up(z - h) + up(z + h))
