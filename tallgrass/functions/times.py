"""Wall-clock times (``timestamp_ntz``) as instants, read as UTC in any session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WALL_ZERO = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_INSTANT_ZERO = "TIMESTAMP'1970-01-01 00:00:00Z'"


def to_instant(wall: Column) -> Column:
    return F.expr(_INSTANT_ZERO) + (wall - F.expr(_WALL_ZERO))


def to_wall(instant: Column) -> Column:
    return F.expr(_WALL_ZERO) + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(instant)
