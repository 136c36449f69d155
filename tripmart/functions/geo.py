"""Great-circle distance and the 0.01-degree grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0088
CELLS_PER_DEGREE = 100


def haversine_km(start_lat: str, start_lng: str, end_lat: str, end_lng: str) -> Column:
    """Kilometres between two points; NULL when a coordinate is NULL, NaN when one is NaN."""
    phi_a, phi_b = F.radians(start_lat), F.radians(end_lat)
    sin_phi = F.sin((phi_b - phi_a) / 2)
    sin_lambda = F.sin((F.radians(end_lng) - F.radians(start_lng)) / 2)
    chord = sin_phi * sin_phi + F.cos(phi_a) * F.cos(phi_b) * sin_lambda * sin_lambda
    # Rounding can push the chord of antipodes above 1, where asin is NaN and would spoil averages. The cap names the chord
    # once, so its sines are worked out once a row; NaN is the greatest number, also below zero, and stays NaN.
    capped = -F.greatest(-chord, F.lit(-1.0))
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (start_lat, start_lng, end_lat, end_lng)])
    return F.when(known, 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(capped)))


def grid_edge(coordinate: str) -> Column:
    """South or west edge of the grid cell that holds the coordinate."""
    return F.floor(F.col(coordinate) * CELLS_PER_DEGREE) / CELLS_PER_DEGREE


def area_id(lat: str = "start_lat", lng: str = "start_lng") -> Column:
    """Grid cell as text such as ``40.76_-73.99``; NULL when a coordinate is NULL."""
    return F.concat(grid_edge(lat).cast("string"), F.lit("_"), grid_edge(lng).cast("string"))
