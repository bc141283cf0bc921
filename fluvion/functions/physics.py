"""Column functions: thermodynamics, areas, distances, calendar and soil columns. All are built-in expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants in SI units.
GRAVITY = 9.80665
GAS_CONSTANT = 287.05
LAPSE_RATE = 0.0065
EARTH_RADIUS_M = 6371000.0
EARTH_RADIUS_KM = 6371.0


def to_celsius(kelvin: Column) -> Column:
    return kelvin - 273.15


def to_mm_per_day(flux: Column) -> Column:
    """kg m-2 s-1 to mm a day."""
    return flux * 86400.0


def to_km3(mm: Column, area_m2: Column) -> Column:
    return mm * area_m2 * 1e-12


def days_in_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year.cast("int"), F.lit(12), F.lit(31)))


def volume_to_mm_per_day(m3: Column, area_m2: Column, year: Column) -> Column:
    """Yearly volume to a daily depth; null for an empty area."""
    return F.try_divide(m3 * 1000.0, area_m2 * days_in_year(year))


def temperature_at_height(kelvin: Column, dz: Column) -> Column:
    return kelvin - LAPSE_RATE * dz


def mixing_ratio(q: Column) -> Column:
    return q / (1.0 - q)


def vapour_pressure(q: Column, pressure: Column) -> Column:
    r = mixing_ratio(q)
    return r / (0.622 + r) * pressure


def pressure_at_height(pressure: Column, kelvin: Column, q: Column, dz: Column) -> Column:
    """Hypsometric pressure with the mean virtual temperature of both heights."""
    moist = 1.0 + 0.61 * mixing_ratio(q)
    low = kelvin * moist
    high = temperature_at_height(kelvin, dz) * moist
    return pressure * F.exp(-dz * GRAVITY / (GAS_CONSTANT * 0.5 * (low + high)))


def saturation_pressure(celsius: Column) -> Column:
    """kPa over water, with a correction over ice below zero."""
    water = 0.61078 * F.exp(17.269 * celsius / (237.3 + celsius))
    return F.when(celsius < 0, water * (1.0 + 0.00972 * celsius + 0.000042 * celsius * celsius)).otherwise(water)


def emissivity(kelvin: Column, vapour_hpa: Column) -> Column:
    """Clear-sky emissivity of air."""
    return 1.08 * (1.0 - F.exp(-F.pow(vapour_hpa, kelvin / 2016.0)))


def longwave_ratio(high_k: Column, high_hpa: Column, low_k: Column, low_hpa: Column) -> Column:
    return emissivity(high_k, high_hpa) / emissivity(low_k, low_hpa) * F.pow(high_k / low_k, 4)


def sphere_cell_area(lat: Column, size_deg: float, columns: int) -> Column:
    """Area in m2 of a grid cell centred on ``lat``, one of ``columns`` around the globe."""
    upper, lower = F.sin(F.radians(lat + size_deg / 2)), F.sin(F.radians(lat - size_deg / 2))
    return 2 * F.pi() * EARTH_RADIUS_M * EARTH_RADIUS_M * (upper - lower) / columns


def ellipsoid_cell_area(lat: Column, size_deg: float, columns: int, axis_m: float = 6378137.0, flattening: float = 1 / 298.257223563) -> Column:
    """Area in m2 of a grid cell centred on ``lat`` on an ellipsoid of revolution (WGS 84), by the closed form of the authalic latitude."""
    e = math.sqrt(flattening * (2 - flattening))

    def below(degrees: Column) -> Column:
        """Area between the equator and a latitude, over half the polar axis squared and the width in radians."""
        s = F.sin(F.radians(degrees))
        return s / (1 - (e * s) * (e * s)) + F.atanh(e * s) / e

    polar = axis_m * (1 - flattening)
    return (below(lat + size_deg / 2) - below(lat - size_deg / 2)) * (polar * polar * math.pi / columns)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def area_ratio(a: Column, b: Column) -> Column:
    """The larger over the smaller; infinite where one is unknown or not positive."""
    return F.when((a > 0) & (b > 0), F.greatest(a / b, b / a)).otherwise(F.lit(float("inf")))


def porosity(bulk_density: Column, particle_density: Column) -> Column:
    return 1.0 - F.try_divide(bulk_density, particle_density)


def cumulative_roots(depth: Column, a: Column, b: Column) -> Column:
    return 1.0 - 0.5 * (F.exp(-a * depth) + F.exp(-b * depth))


def missing_to_null(value: Column, fill: float = 1e20) -> Column:
    """Fill values, NaN and anything beyond 1e19 become null."""
    return F.when(~F.isnan(value) & (F.abs(value) <= 1e19) & (value != fill), value)


def years_since_1901(offset: Column) -> Column:
    """The year of a ``years since 1901`` axis, rounded half to even."""
    return (1901 + F.rint(offset)).cast("int")
