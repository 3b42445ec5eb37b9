"""Units, classes and colours of variables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from halocline.functions.flow import ColumnOrName, as_col

# Grid resolution classes in metres; each is [low, high), above the last they are clipped.
RESOLUTION_CLASSES = ((0.0, 50.0, "small"), (50.0, 500.0, "medium"), (500.0, 100_000.0, "large"))
# Units by a part of the variable's name.
UNITS = (("power_density", "W/m^2"), ("speed", "m/s"), ("direction", "degrees"), ("depth", "m"), ("elevation", "m"), ("period", "h"), ("resolution", "m"), ("distance", "NM"))


def unit_of(variable: ColumnOrName, current: ColumnOrName | None = None) -> Column:
    out = None
    for part, unit in UNITS:
        out = (F if out is None else out).when(as_col(variable).contains(part), unit)
    return out.otherwise(as_col(current) if current is not None else F.lit(None).cast("string"))


def level_of(value: ColumnOrName, low: float, high: float, levels: int) -> Column:
    """Class 0 .. levels - 1 of equal widths, ``levels`` from ``high`` on (overflow); below ``low`` is class 0."""
    v = as_col(value)
    return F.when(v >= high, levels).when(v < low, 0).when(v.isNotNull(), F.floor((v - low) / ((high - low) / levels)).cast("int"))


def level_bounds(low: float, high: float, levels: int) -> list[tuple[int, float, float]]:
    step = (high - low) / levels
    return [(k, low + k * step, low + (k + 1) * step) for k in range(levels)]


def resolution_class(metres: ColumnOrName) -> Column:
    out = None
    for low, high, name in RESOLUTION_CLASSES:
        out = (F if out is None else out).when((as_col(metres) >= low) & (as_col(metres) < high), name)
    return out.when(as_col(metres) >= RESOLUTION_CLASSES[-1][1], RESOLUTION_CLASSES[-1][2])


def palette(stops: list[tuple[int, int, int]], levels: int, at_centres: bool = True) -> list[str]:
    """``#rrggbb`` for each class, read off a ramp at bin centres or at k / (levels - 1)."""
    out = []
    for k in range(levels):
        at = ((k + 0.5) / levels if at_centres else k / max(levels - 1, 1)) * (len(stops) - 1)
        i = min(int(at), len(stops) - 2)
        rgb = [round(a + (b - a) * (at - i)) for a, b in zip(stops[i], stops[i + 1], strict=True)]
        out.append("#{:02x}{:02x}{:02x}".format(*rgb))
    return out


#: The colour of what has no value.
NO_VALUE = "#000000"


def fill_color(value: ColumnOrName, low: float, high: float, levels: int, stops: list[tuple[int, int, int]]) -> Column:
    """The class's colour, the last one's from ``high`` on; black for null and NaN."""
    v = as_col(value).cast("double")
    colors = F.array(*[F.lit(c) for c in palette(stops, levels)])
    return F.when(v.isNull() | F.isnan(v), NO_VALUE).otherwise(F.get(colors, F.least(level_of(v, low, high, levels), F.lit(levels - 1))))
