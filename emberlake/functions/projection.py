"""Projected coordinates to longitude and latitude, a whole array at a time.

The inverse transverse Mercator projection after Krüger: series in the third flattening, to its fourth power, give
conformal coordinates to a nanometre within some 4,000 km of the central meridian; the latitude follows by Newton steps.
"""

from __future__ import annotations

import math
import re
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

# Used in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Coefficients of the series, by multiple of the angle and from the first power of the third flattening on.
TO_GEOGRAPHIC = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360),
    (0, 1 / 48, 1 / 15, -437 / 1440),
    (0, 0, 17 / 480, -37 / 840),
    (0, 0, 0, 4397 / 161280),
)
TO_PROJECTED = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180),
    (0, 13 / 48, -3 / 5, 557 / 1440),
    (0, 0, 61 / 240, -103 / 140),
    (0, 0, 0, 49561 / 161280),
)

# Systems whose longitudes and latitudes are those of SRID 4674 or 4326.
_DATUM = re.compile(r'(?is)GEOG(?:CS|CRS)\s*\[\s*"[^"]*(?:SIRGAS[ _]*2000|WGS[ _]*(?:19)?84)')
_SPHEROID = re.compile(r'(?is)(?:SPHEROID|ELLIPSOID)\s*\[\s*"[^"]*"\s*,\s*([-+.\deE]+)\s*,\s*([-+.\deE]+)')
_PARAMETER = re.compile(r'(?is)PARAMETER\s*\[\s*"([^"]*)"\s*,\s*([-+.\deE]+)')
_UNIT = re.compile(r'(?is)UNIT\s*\[\s*"([^"]*)"\s*,\s*([-+.\deE]+)')


def _series(coefficients: tuple, n: float) -> list[float]:
    return [sum(c * n ** (k + 1) for k, c in enumerate(row)) for row in coefficients]


@dataclass(frozen=True)
class TransverseMercator:
    """A projected system; lengths in ``unit`` metres, angles in degrees."""

    semi_major: float
    inverse_flattening: float
    central_meridian: float
    origin_latitude: float
    scale: float
    false_easting: float
    false_northing: float
    unit: float = 1.0

    @property
    def _flattening(self) -> float:
        return 1 / self.inverse_flattening if self.inverse_flattening else 0.0

    def _conformal(self, tangent: np.ndarray) -> np.ndarray:
        """Tangent of the conformal latitude from that of the latitude."""
        e = math.sqrt(self._flattening * (2 - self._flattening))
        root = np.sqrt(1 + tangent**2)
        sigma = np.sinh(e * np.arctanh(e * tangent / root))
        return tangent * np.sqrt(1 + sigma**2) - sigma * root

    def to_geographic(self, points: np.ndarray) -> np.ndarray:
        """Longitude and latitude of rows (x, y)."""
        f = self._flattening
        n, e2 = f / (2 - f), f * (2 - f)
        radius = self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * self.scale
        conformal = math.atan(float(self._conformal(np.tan(np.radians(np.float64(self.origin_latitude))))))
        origin = conformal + sum(c * math.sin(2 * (j + 1) * conformal) for j, c in enumerate(_series(TO_PROJECTED, n)))
        xi = (points[:, 1] * self.unit - self.false_northing * self.unit) / radius + origin
        eta = (points[:, 0] * self.unit - self.false_easting * self.unit) / radius
        north, east = xi.copy(), eta.copy()
        for j, c in enumerate(_series(TO_GEOGRAPHIC, n)):
            north -= c * np.sin(2 * (j + 1) * xi) * np.cosh(2 * (j + 1) * eta)
            east -= c * np.cos(2 * (j + 1) * xi) * np.sinh(2 * (j + 1) * eta)
        longitude = np.arctan2(np.sinh(east), np.cos(north))
        wanted = np.sin(north) / np.hypot(np.sinh(east), np.cos(north))
        tangent = wanted / (1 - e2)
        for _ in range(6):
            found = self._conformal(tangent)
            tangent = tangent + (wanted - found) / np.sqrt(1 + found**2) * (1 + (1 - e2) * tangent**2) / ((1 - e2) * np.sqrt(1 + tangent**2))
        return np.column_stack([self.central_meridian + np.degrees(longitude), np.degrees(np.arctan(tangent))])


def projection_of(prj: str) -> TransverseMercator | None:
    """What a .prj text says: None for coordinates of SRID 4674 or 4326, a projection of them, or ValueError."""
    text = prj.strip()
    datum = _DATUM.search(text)
    if datum and datum.start() == 0:
        return None
    spheroid = _SPHEROID.search(text)
    if not datum or not spheroid or not re.search(r'(?is)(?:PROJECTION|METHOD)\s*\[\s*"Transverse[ _]Mercator"', text):
        raise ValueError(f"no transformation for the coordinates of {text[:80]!r}")
    values = {re.sub(r"[ _]+", "_", name.lower()): float(value) for name, value in _PARAMETER.findall(text)}
    try:
        origin = values["latitude_of_origin"] if "latitude_of_origin" in values else values["latitude_of_natural_origin"]
        units = [float(v) for name, v in _UNIT.findall(text) if not name.lower().startswith(("deg", "rad", "grad"))]
        return TransverseMercator(
            *map(float, spheroid.groups()),
            values["central_meridian"],
            origin,
            values["scale_factor"],
            values["false_easting"],
            values["false_northing"],
            units[-1] if units else 1.0,
        )
    except KeyError as missing:
        raise ValueError(f"the projection {text[:80]!r} lacks {missing}") from None
