"""High and low water of each face's elevation series: levels, ranges, periods and cycles.

A series is cut into time ranges with an overlap; ranges, not faces, are dealt to tasks, so that a face with most of the
rows is spread like any other.  Peaks are found in each range and count where they lie.  A peak is strictly higher than
both neighbours, plateaus count at their middle, and it needs a prominence: on both sides the water must fall by as much
before it rises higher.  Where a range and its overlap do not tell, the series is done again in longer ranges, at last
in one; that takes a series which keeps within the prominence for longer than the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROMINENCE_M = 0.05
FALLBACK_SHARE = 0.2
#: Hours between high waters that count, open intervals: half-day and day tides.
SEMIDIURNAL_H, DIURNAL_H = (10.0, 14.0), (20.0, 26.0)
#: Days of a range and of its overlap on either side, and how much longer they get where that does not tell.
RANGE_DAYS, OVERLAP_DAYS, LONGER = 64.0, 8.0, 8.0

LEVELS = ("high_max", "high_mean", "low_mean", "low_min", "tidal_range")
PERIODS = ("average_period_s", "min_period_s", "max_period_s")


def local_maxima(x: np.ndarray) -> np.ndarray:
    """Middles of runs of equal values that are higher than both neighbours; ends of the series never count."""
    n = len(x)
    if n < 3:
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    ends = np.append(starts[1:], n) - 1
    value = x[starts]
    inner = np.arange(1, len(starts) - 1)
    peak = inner[(value[inner] > value[inner - 1]) & (value[inner] > value[inner + 1])]
    return (starts[peak] + ends[peak]) // 2


def sides(height: list[float], low: list[float]) -> tuple[list[float], list[bool]]:
    """For each peak the lowest point back to higher ground, and whether there is higher ground; ``low`` is the lowest
    point between it and the peak before.  A stack of the higher peaks so far gives both in one pass."""
    out, bounded, higher = [], [], []
    for h, least in zip(height, low, strict=True):
        least = min(least, h)
        while higher and higher[-1][0] <= h:
            least = min(least, higher.pop()[1])
        bounded.append(bool(higher))
        higher.append((h, least))
        out.append(least)
    return out, bounded


def both_sides(x: np.ndarray, peaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each peak, to the left and to the right: the lowest point before higher ground or the end, and which it was."""
    lows = np.minimum.reduceat(x, np.append(0, peaks))  # before the first peak, between peaks, after the last
    height = x[peaks].tolist()
    left, left_bound = sides(height, lows[:-1].tolist())
    right, right_bound = sides(height[::-1], lows[:0:-1].tolist())
    return np.array(left), np.array(left_bound), np.array(right[::-1]), np.array(right_bound[::-1])


def prominences(x: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Height of each peak over the higher of the two lowest points between it and higher ground (or the ends)."""
    if not len(peaks):
        return np.zeros(0)
    left, _, right, _ = both_sides(x, peaks)
    return x[peaks] - np.maximum(left, right)


def judged(x: np.ndarray, prominence: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(peaks, open peaks, open to the left, open to the right) of a part of a series: what it tells, and what it does not."""
    peaks = local_maxima(x)
    none = np.zeros(0, np.int64)
    found, open_at, open_left, open_right = none, none, none.astype(bool), none.astype(bool)
    if len(peaks):
        left, left_bound, right, right_bound = both_sides(x, peaks)
        h = x[peaks]
        fell_left, fell_right = h - left >= prominence, h - right >= prominence
        found = peaks[fell_left & fell_right]
        open_left, open_right = ~fell_left & ~left_bound, ~fell_right & ~right_bound
        unknown = (open_left | open_right) & (fell_left | open_left) & (fell_right | open_right)
        open_at, open_left, open_right = peaks[unknown], open_left[unknown], open_right[unknown]
    # the first and the last run of equal values may be parts of plateaus
    change = np.flatnonzero(x[1:] != x[:-1])
    ends = []
    if len(x) and (not len(change) or x[0] > x[change[0] + 1]):
        ends.append((change[0] if len(change) else len(x) - 1, True, not len(change)))
    if len(change) and x[-1] > x[change[-1]]:
        ends.append((change[-1] + 1, False, True))
    if ends:
        at, le, ri = zip(*ends, strict=True)
        open_at, open_left, open_right = np.append(open_at, at), np.append(open_left, le), np.append(open_right, ri)
    return found, open_at.astype(np.int64), open_left.astype(bool), open_right.astype(bool)


# ---------------------------------------------------------------- series in ranges

POINT = "kind string, t_ long, level double, n_ long, first_ long, last_ long, left_ boolean, right_ boolean"
POINT_TYPES = (pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())


def of_range(t: np.ndarray, x: np.ndarray, core: tuple[int, int], prominence: float) -> list[tuple]:
    """Rows of POINT of one range: highs and lows in its core, what stays open, and the core's sums."""
    own = (t >= core[0]) & (t < core[1])
    here = own & ~np.isnan(x)
    out = [("stats", None, float(x[here].sum()), int(here.sum()), int(t[here].min()) if here.any() else None, int(t[here].max()) if here.any() else None, None, None)] if own.any() else []
    known = ~np.isnan(x)
    t, x, own = t[known], x[known], own[known]
    for kind, y in (("high", x), ("low", -x)):
        found, open_at, left, right = judged(y, prominence)
        out += [(kind, int(t[i]), float(x[i]), None, None, None, None, None) for i in found if own[i]]
        out += [("open", int(t[i]), float(x[i]), None, int(t[0]), int(t[-1]), bool(a), bool(b)) for i, a, b in zip(open_at, left, right, strict=True) if own[i] or own_run(y, own, i)]
    return out


def own_run(x: np.ndarray, own: np.ndarray, i: int) -> bool:
    """Whether any of the run of equal values at ``i`` lies in the core."""
    same = np.flatnonzero(x != x[i])
    before, after = same[same < i], same[same > i]
    return bool(own[(before[-1] + 1 if len(before) else 0) : (after[0] if len(after) else len(x))].any())


def in_ranges(slim: DataFrame, keys: list[str], prominence: float, days: float | None, overlap: float) -> DataFrame:
    """Rows of POINT of all series in ranges of ``days`` (None: whole series): one shuffle by (series, range), sorted, and
    walked as a stream that holds one range."""
    span, lap = (int(d * 86_400_000_000) for d in (days or 0, overlap))
    if days is None:
        dealt = slim.withColumn("range_", F.lit(0).cast("long"))
    else:
        own = F.floor(F.col("t_") / span).cast("long")
        dealt = slim.withColumn("range_", own)
        dealt = dealt.withColumn("range_", F.explode(F.filter(F.array(own, F.when(F.col("t_") - own * span < lap, own - 1), F.when((own + 1) * span - F.col("t_") <= lap, own + 1)), lambda c: c.isNotNull())))
    dealt = dealt.select(*keys, "range_", "t_", "x_").repartition(*keys, "range_").sortWithinPartitions(*keys, "range_", "t_", "x_")
    width = len(keys)
    schema = dealt.select(*keys).schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", " + POINT

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_types, held, held_key = None, [], None

        def done() -> list[tuple]:
            t, x = (np.concatenate(part) for part in zip(*held, strict=True))
            core = (held_key[-1] * span, (held_key[-1] + 1) * span) if span else (-(2**63), 2**63 - 1)
            return [(*held_key[:-1], *row) for row in of_range(t, x, core, prominence)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((*key_types, *POINT_TYPES))], names)

        names = [*keys, *(c.split()[0] for c in POINT.split(", "))]
        for batch in batches:
            if not batch.num_rows:
                continue
            key_types = [c.type for c in batch.columns[:width]]
            t = batch.column(width + 1).to_numpy(zero_copy_only=False)
            x = batch.column(width + 2).to_numpy(zero_copy_only=False).astype(float)
            labels = list(zip(*(c.to_pylist() for c in batch.columns[: width + 1]), strict=True))
            rows: list[tuple] = []
            start = 0
            while start < len(labels):
                stop = start + 1
                while stop < len(labels) and labels[stop] == labels[start]:
                    stop += 1
                if held and held_key != labels[start]:
                    rows += done()
                    held = []
                held_key = labels[start]
                held.append((t[start:stop], x[start:stop]))
                start = stop
            yield batch_of(rows)
        if held:
            yield batch_of(done())

    return dealt.mapInArrow(walk, schema)


def tidal_points(df: DataFrame, keys: list[str], elevation: str = "zeta_center", time: str = "time", prominence: float = PROMINENCE_M, range_days: float = RANGE_DAYS, overlap_days: float = OVERLAP_DAYS) -> DataFrame:
    """(keys, kind, t_, level, n_): high and low waters with their microseconds, and the sums of each series ("stats").

    Rows without time are left out, missing elevations are skipped; equal times are in order of elevation.  The rows are
    written to the checkpoint folder, a few for each tide.
    """
    if overlap_days > range_days:
        raise ValueError("the overlap is longer than the range")
    slim = df.select(*keys, F.unix_micros(F.col(time).cast("timestamp")).alias("t_"), F.nanvl(F.col(elevation).cast("double"), F.lit(None).cast("double")).alias("x_")).where("t_ IS NOT NULL")
    points = in_ranges(slim, keys, prominence, range_days, overlap_days).checkpoint()
    same = lambda other: [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in other]
    for days in (range_days * LONGER, None):
        ends = points.where("kind = 'stats'").groupBy(*keys).agg(F.min("first_").alias("begins"), F.max("last_").alias("ends"))
        ends = ends.withColumnsRenamed({k: f"{k}_" for k in keys})
        # open towards an end of the series itself means that the water never fell there
        unknown = points.where("kind = 'open'").join(ends, same(keys), "left_outer").where(~(F.col("left_") & (F.col("first_") <= F.col("begins"))) & ~(F.col("right_") & (F.col("last_") >= F.col("ends"))))
        again = unknown.select(*[F.col(k).alias(f"{k}_") for k in keys]).distinct().checkpoint()
        if again.isEmpty():
            break
        longer = in_ranges(slim.join(again, same(keys), "left_semi"), keys, prominence, days, overlap_days * LONGER)
        points = points.join(again, same(keys), "left_anti").unionByName(longer).checkpoint()
    return points.where("kind <> 'open'").select(*keys, "kind", "t_", "level", "n_")


def as_time(micros: str) -> Column:
    return F.timestamp_micros(F.col(micros))


def accepted(hours: Column) -> Column:
    """Whether a time between high waters counts."""
    return ((hours > SEMIDIURNAL_H[0]) & (hours < SEMIDIURNAL_H[1])) | ((hours > DIURNAL_H[0]) & (hours < DIURNAL_H[1]))


def tidal_summary(df: DataFrame, keys: list[str], elevation: str = "zeta_center", time: str = "time", prominence: float = PROMINENCE_M, **ranges: float) -> DataFrame:
    """Per series: mean level; high and low water levels about it, and their range; accepted times between high waters.

    Where a series has no high or no low water, the top or bottom fifth of its values stands in.  Without an accepted time
    the periods are 0 and the type is "Unknown"; a series without values has null levels.
    """
    points = tidal_points(df, keys, elevation, time, prominence, **ranges)
    high, low = (F.when(F.col("kind") == k, F.col("level")) for k in ("high", "low"))
    total = F.when(F.col("kind") == "stats", F.col("level"))
    before = F.lag("t_").over(Window.partitionBy(*keys, "kind").orderBy("t_"))
    gap = F.when(F.col("kind") == "high", F.col("t_") - before)
    hours = F.col("gap") / 3.6e9
    kept = F.when(accepted(hours), F.col("gap"))
    half, day = F.max(hours.between(*SEMIDIURNAL_H) & accepted(hours)), F.max(hours.between(*DIURNAL_H) & accepted(hours))
    kind = F.when(half & day, "Mixed").when(half, "Semidiurnal").when(day, "Diurnal").otherwise("Unknown")
    per = points.withColumn("gap", gap).groupBy(*keys).agg(
        F.try_divide(F.sum(total), F.sum("n_")).alias("mean_level"),
        F.max(high).alias("a"), F.avg(high).alias("b"), F.avg(low).alias("c"), F.min(low).alias("d"),
        *[F.coalesce(f(kept) / 1e6, F.lit(0.0)).alias(name) for f, name in zip((F.avg, F.min, F.max), PERIODS, strict=True)],
        kind.alias("tide_type"),
    ).checkpoint()
    bare = per.where("mean_level IS NOT NULL AND (b IS NULL OR c IS NULL)").select(*[F.col(k).alias(f"{k}_") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    values = df.select(*keys, F.nanvl(F.col(elevation).cast("double"), F.lit(None).cast("double")).alias("x_"), F.col(time).alias("t_")).where("x_ IS NOT NULL AND t_ IS NOT NULL").join(bare, same, "left_semi")
    fifths = extreme_share(values, keys, "x_", "t_").withColumnsRenamed({k: f"{k}_" for k in keys})
    per = per.join(fifths, same, "left")
    level = lambda own, fifth: F.coalesce(F.col(own), F.col(fifth)) - F.col("mean_level")
    out = [level("a", "high_max").alias("high_max"), level("b", "high_mean").alias("high_mean"), level("c", "low_mean").alias("low_mean"), level("d", "low_min").alias("low_min")]
    return per.select(*keys, "mean_level", *out, (level("b", "high_mean") - level("c", "low_mean")).alias("tidal_range"), *PERIODS, "tide_type")


# ---------------------------------------------------------------- cycles


def tidal_cycles(df: DataFrame, keys: list[str], elevation: str = "zeta_center", time: str = "time", prominence: float = PROMINENCE_M, **ranges: float) -> DataFrame:
    """A row per cycle, from a high water to the next with a low water between: both waters, the range and the period.

    The low water is the lowest one between the two high waters (the first of equal ones), the range that from the first
    high water down to it.  ``cycle`` counts the series' high waters.
    """
    points = tidal_points(df, keys, elevation, time, prominence, **ranges).where("kind <> 'stats'")
    w = Window.partitionBy(*keys).orderBy("t_")
    is_high = F.col("kind") == "high"
    numbered = points.withColumn("cycle", F.count(F.when(is_high, 1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = F.struct("level", "t_")
    cycles = numbered.groupBy(*keys, "cycle").agg(F.max(F.when(is_high, at)).alias("high"), F.min(F.when(~is_high, at)).alias("low"))
    cycles = cycles.withColumn("next_", F.lead("high.t_").over(Window.partitionBy(*keys).orderBy("cycle"))).where("high IS NOT NULL AND low IS NOT NULL AND next_ IS NOT NULL")
    return cycles.select(
        *keys,
        "cycle",
        as_time("high.t_").alias("high_time"),
        F.col("high.level").alias("high_level"),
        as_time("low.t_").alias("low_time"),
        F.col("low.level").alias("low_level"),
        (F.col("high.level") - F.col("low.level")).alias("tidal_range"),
        ((F.col("next_") - F.col("high.t_")) / 1e6).alias("period_s"),
    )


def cycle_ranges(cycles: DataFrame, keys: list[str]) -> DataFrame:
    """Per series: number of cycles, mean, least and largest range, and the high waters of those two cycles.

    A series has a row if any of its cycles has an accepted period.
    """
    stats = cycles.groupBy(*keys).agg(
        F.count("*").alias("n_cycles"),
        F.avg("tidal_range").alias("average_range"),
        F.min("tidal_range").alias("min_range"),
        F.max("tidal_range").alias("max_range"),
        F.min_by("high_time", F.struct("tidal_range", "cycle")).alias("min_range_time"),
        F.max_by("high_time", F.struct("tidal_range", -F.col("cycle"))).alias("max_range_time"),
        F.max(accepted(F.col("period_s") / 3600)).alias("some"),
    )
    return stats.where("some").drop("some")


def extreme_share(df: DataFrame, keys: list[str], value: str, tie: str, share: float = FALLBACK_SHARE) -> DataFrame:
    """Mean of the top and bottom ``share`` of each series' values, natively; at least one value each."""
    w = Window.partitionBy(*keys)
    k = F.greatest(F.floor(F.count("*").over(w) * share), F.lit(1))
    up = F.row_number().over(w.orderBy(F.col(value), F.col(tie)))
    ranked = df.withColumn("k_", k).withColumn("low_", up).withColumn("high_", F.count("*").over(w) - F.col("low_") + 1)
    return ranked.groupBy(*keys).agg(F.avg(F.when(F.col("high_") <= F.col("k_"), F.col(value))).alias("high_mean"), F.avg(F.when(F.col("low_") <= F.col("k_"), F.col(value))).alias("low_mean"), F.max(value).alias("high_max"), F.min(value).alias("low_min"))
