"""Flow quantities of horizontal velocity components, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEA_WATER_DENSITY = 1025.0  # kg/m3
UNDEFINED_SPEED = 0.01  # m/s; a direction needs a speed above it

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: ColumnOrName) -> Column:
    """NaN is the files' null: averages and maxima must skip it."""
    return F.when(~F.isnan(as_col(c)), as_col(c))


def speed(u: ColumnOrName, v: ColumnOrName) -> Column:
    u, v = as_col(u).cast("double"), as_col(v).cast("double")
    return F.sqrt(u * u + v * v)


def to_direction(u: ColumnOrName, v: ColumnOrName, threshold: float = UNDEFINED_SPEED) -> Column:
    """Degrees clockwise from true north towards which water flows, in [0, 360); null at or below the threshold."""
    return F.when(speed(u, v) > threshold, F.pmod(F.lit(90.0) - F.degrees(F.atan2(as_col(v), as_col(u))), F.lit(360.0)))


def from_direction(to_dir: ColumnOrName) -> Column:
    return F.pmod(as_col(to_dir) + 180.0, F.lit(360.0))


def power_density(speed_col: ColumnOrName, rho: float = SEA_WATER_DENSITY) -> Column:
    """W/m2 of a flow through a plane across it."""
    s = as_col(speed_col)
    return F.lit(0.5 * rho) * s * s * s


def circular_mean(direction: ColumnOrName) -> Column:
    """Aggregate: mean direction of unit vectors.  The default mean of directions elsewhere is arithmetic."""
    r = F.radians(as_col(direction))
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r)))), F.lit(360.0))


def max_to_mean_ratio(p95: ColumnOrName, mean: ColumnOrName) -> Column:
    return F.try_divide(as_col(p95), as_col(mean))
