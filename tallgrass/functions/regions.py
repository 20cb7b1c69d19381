"""Rectangles in the plane, compiled into column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Region(NamedTuple):
    """An open rectangle: points on an edge are outside."""

    name: str
    x_min: float
    x_max: float
    y_min: float
    y_max: float
    title: str = ""

    def contains(self, x: Column, y: Column) -> Column:
        return (x > self.x_min) & (x < self.x_max) & (y > self.y_min) & (y < self.y_max)


# The two built-in drop-off areas (longitude, latitude) and the
# names used in counts and in alert messages.
OFFICE_REGIONS = (
    Region("goldman", -74.0144185, -74.013777, 40.7138745, 40.7152275, "Goldman Sachs"),
    Region("citigroup", -74.012083, -74.009867, 40.720053, 40.7217236, "Citigroup"),
)


def first_region(x: Column, y: Column, regions: Sequence[Region]) -> Column:
    """Name of the first region that holds the point, else null."""
    return F.coalesce(*[F.when(r.contains(x, y), F.lit(r.name)) for r in regions])


def all_regions(x: Column, y: Column, regions: Sequence[Region]) -> Column:
    """Names of every region that holds the point, as an array."""
    names = F.array(*[F.when(r.contains(x, y), F.lit(r.name)) for r in regions])
    return F.filter(names, lambda name: name.isNotNull())
