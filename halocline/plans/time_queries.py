"""Time axes, gaps, buckets, tides and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.operators import reshape, summary, tides, timeline
from halocline.plans.tables import LAYERS_SQL, SERIES_SQL, Registry, layers, rounded, series, table

REG = Registry()
DAYS = ("2024-01-01 00:00:00", "2024-01-30 00:00:00")


@REG.add("time_delta_check", f"""WITH {SERIES_SQL}, d AS (SELECT *, (epoch_us(time) - lag(epoch_us(time)) OVER (PARTITION BY face_id ORDER BY time, event_id)) / 1e6 AS delta FROM series)
    SELECT face_id, count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time, count(*) FILTER (delta = 0) AS n_duplicates,
           round(avg(delta), 6) AS mean_delta_s, round(min(delta), 6) AS min_delta_s, round(max(delta), 6) AS max_delta_s FROM d GROUP BY face_id""")
def time_delta_check(spark, sf):
    return rounded(timeline.time_report(series(spark, sf), ["face_id"], order=["event_id"]), "mean_delta_s", "min_delta_s", "max_delta_s")


@REG.add("gap_pairs", f"""WITH {SERIES_SQL}, d AS (SELECT *, lag(time) OVER w AS prev_time, (epoch_us(time) - lag(epoch_us(time)) OVER w) / 1e6 AS delta FROM series WINDOW w AS (PARTITION BY face_id ORDER BY time, event_id))
    SELECT face_id, prev_time, time, round(delta, 6) AS delta_s FROM d WHERE abs(delta - 3600) > 86400""")
def gap_pairs(spark, sf):
    return rounded(timeline.bad_pairs(series(spark, sf), ["face_id"], 3600, 86400, order=["event_id"]), "delta_s")


@REG.add("monotonic_check", f"""WITH {SERIES_SQL}, d AS (SELECT *, lag(time) OVER (PARTITION BY face_id ORDER BY event_id * 1103515245 % 2147483647) AS prev_time FROM series)
    SELECT face_id, event_id, time, prev_time FROM d WHERE time < prev_time""")
def monotonic_check(spark, sf):
    """Rows as they lie in files that were written in no order."""
    shuffled = series(spark, sf).withColumn("row", F.col("event_id") * 1103515245 % 2147483647)
    return timeline.order_violations(shuffled, ["face_id"], "row").select("face_id", "event_id", "time", "prev_time")


@REG.add("coverage_check", f"WITH {SERIES_SQL} SELECT face_id, min(time) <= TIMESTAMP '2024-01-02' AND max(time) >= TIMESTAMP '2024-01-29' AS covers FROM series GROUP BY face_id")
def coverage_check(spark, sf):
    return timeline.coverage(series(spark, sf), ["face_id"], "2024-01-02", "2024-01-29")


@REG.add("dedupe_keep_first", f"WITH {SERIES_SQL} SELECT face_id, date_trunc('hour', time) AS hour, arg_min(event_id, (time, event_id)) AS event_id, arg_min(zeta, (time, event_id)) AS zeta FROM series GROUP BY ALL")
def dedupe_keep_first(spark, sf):
    return timeline.keep_first(series(spark, sf).withColumn("hour", F.date_trunc("hour", "time").cast("timestamp_ntz")), ["face_id", "hour"], ["time", "event_id"]).select("face_id", "hour", "event_id", "zeta")


@REG.add("time_clip", f"WITH {SERIES_SQL} SELECT face_id, event_id, time FROM series WHERE time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-10 12:00:00'")
def time_clip(spark, sf):
    return timeline.clip(series(spark, sf), "2024-01-05 00:00:00", "2024-01-10 12:00:00").select("face_id", "event_id", "time")


DAILY_SQL = f"{SERIES_SQL}, daily AS (SELECT face_id, date_trunc('day', time)::TIMESTAMP AS time, max(zeta) AS zeta FROM series GROUP BY ALL)"


def daily(spark, sf):
    return series(spark, sf).groupBy("face_id", F.date_trunc("day", "time").cast("timestamp_ntz").alias("time")).agg(F.max("zeta").alias("zeta"))


CALENDAR_SQL = "cal AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS time)"


@REG.add("calendar_pad", f"""WITH {DAILY_SQL}, {CALENDAR_SQL}
    SELECT f.face_id, cal.time, coalesce(zeta, -999.0) AS zeta FROM (SELECT DISTINCT face_id FROM daily) f CROSS JOIN cal LEFT JOIN daily d ON d.face_id = f.face_id AND d.time = cal.time""")
def calendar_pad(spark, sf):
    return reshape.fill(timeline.pad(daily(spark, sf), ["face_id"], timeline.calendar(spark, *DAYS, 86400)), ["zeta"])


@REG.add("missing_stamps", f"""WITH {DAILY_SQL}, {CALENDAR_SQL}
    SELECT f.face_id, cal.time FROM (SELECT DISTINCT face_id FROM daily) f CROSS JOIN cal WHERE NOT EXISTS (SELECT 1 FROM daily d WHERE d.face_id = f.face_id AND d.time = cal.time)""")
def missing_stamps(spark, sf):
    return timeline.missing(daily(spark, sf), ["face_id"], timeline.calendar(spark, *DAYS, 86400))


ISLANDS_SQL = f"""WITH {DAILY_SQL}, g AS (SELECT face_id, dayofyear(time) AS d, dayofyear(time) - row_number() OVER (PARTITION BY face_id ORDER BY time) AS run FROM daily),
    isl AS (SELECT face_id, min(d) AS first, max(d) AS last, count(*) AS n FROM g GROUP BY face_id, run)"""


def day_numbers(spark, sf):
    return daily(spark, sf).select("face_id", F.dayofyear("time").cast("long").alias("d"))


@REG.add("gap_islands", f"{ISLANDS_SQL} SELECT * FROM isl")
def gap_islands(spark, sf):
    return timeline.islands(day_numbers(spark, sf), ["face_id"], "d")


@REG.add("index_ranges", f"{ISLANDS_SQL} SELECT face_id, string_agg(CASE WHEN first = last THEN first::VARCHAR ELSE first || '-' || last END, ',' ORDER BY first) AS ranges FROM isl GROUP BY face_id")
def index_ranges(spark, sf):
    return timeline.index_ranges(day_numbers(spark, sf), ["face_id"], "d")


@REG.add("tumbling_daily", f"WITH {SERIES_SQL} SELECT date_trunc('day', time)::TIMESTAMP AS day, count(*) AS n, round(avg(zeta), 8) AS zeta_mean, max(zeta) AS zeta_max FROM series GROUP BY ALL")
def tumbling_daily(spark, sf):
    return series(spark, sf).groupBy(timeline.day_bucket().cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"), F.round(F.avg("zeta"), 8).alias("zeta_mean"), F.max("zeta").alias("zeta_max"))


@REG.add("five_day_bucket", f"WITH {SERIES_SQL} SELECT (DATE '2024-01-01' + CAST(floor(date_diff('day', DATE '2024-01-01', time::DATE) / 5.0) * 5 AS INTEGER))::DATE AS bucket, face_id, count(*) AS n, max(zeta) AS zeta_max FROM series GROUP BY ALL")
def five_day_bucket(spark, sf):
    return series(spark, sf).groupBy(timeline.n_day_bucket(5, "2024-01-01").alias("bucket"), "face_id").agg(F.count("*").alias("n"), F.max("zeta").alias("zeta_max"))


@REG.add("monthly_bucket", "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL")
def monthly_bucket(spark, sf):
    return table(spark, sf, "orders").groupBy(timeline.month_bucket("o_orderdate").cast("timestamp_ntz").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@REG.add("elevation_gradient", f"""WITH {SERIES_SQL}, w AS (SELECT *, lag(zeta) OVER w AS a, lead(zeta) OVER w AS b FROM series WINDOW w AS (PARTITION BY face_id ORDER BY time, event_id))
    SELECT face_id, event_id, round(CASE WHEN a IS NULL THEN b - zeta WHEN b IS NULL THEN zeta - a ELSE (b - a) / 2 END, 6) + 0.0 AS slope FROM w""")
def elevation_gradient(spark, sf):
    return series(spark, sf).select("face_id", "event_id", (F.round(summary.gradient("zeta", ["face_id"], ["time", "event_id"]), 6) + 0.0).alias("slope"))


@REG.add("tidal_levels_topk_fallback", f"""WITH {SERIES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY face_id ORDER BY zeta, event_id) AS lo, count(*) OVER (PARTITION BY face_id) AS n FROM series),
    k AS (SELECT *, greatest(floor(n * 0.2), 1) AS k, n - lo + 1 AS hi FROM r)
    SELECT face_id, round(avg(zeta) FILTER (hi <= k), 6) AS high_mean, round(avg(zeta) FILTER (lo <= k), 6) AS low_mean, max(zeta) AS high_max, min(zeta) AS low_min FROM k GROUP BY face_id""")
def tidal_levels_topk_fallback(spark, sf):
    return rounded(tides.extreme_share(series(spark, sf), ["face_id"], "zeta", "event_id"), "high_mean", "low_mean")


#: High and low waters: runs of equal values above (below) both neighbours, from which the water falls (rises) by 5 cm on
#: both sides before it goes beyond them; each value of a series is held against all others of it.
WATERS_SQL = f"""{SERIES_SQL}, s AS (SELECT face_id, time, zeta, row_number() OVER (PARTITION BY face_id ORDER BY time, zeta) AS i FROM series),
    p AS (SELECT *, lag(zeta) OVER (PARTITION BY face_id ORDER BY i) AS before FROM s),
    r AS (SELECT *, sum(CASE WHEN zeta = before THEN 0 ELSE 1 END) OVER (PARTITION BY face_id ORDER BY i) AS run FROM p),
    runs AS (SELECT face_id, run, (min(i) + max(i)) // 2 AS i, min(zeta) AS z FROM r GROUP BY ALL),
    n AS (SELECT *, lag(z) OVER w AS zl, lead(z) OVER w AS zr FROM runs WINDOW w AS (PARTITION BY face_id ORDER BY run)),
    c AS (SELECT face_id, i, z, 1 AS up FROM n WHERE z > zl AND z > zr UNION ALL SELECT face_id, i, z, -1 FROM n WHERE z < zl AND z < zr),
    t AS (SELECT c.face_id, c.i, c.z, c.up, max(s.i) FILTER (s.i < c.i AND up * (c.z - s.zeta) >= 0.05::DOUBLE) AS fell_l, max(s.i) FILTER (s.i < c.i AND up * (s.zeta - c.z) > 0) AS rose_l,
                 min(s.i) FILTER (s.i > c.i AND up * (c.z - s.zeta) >= 0.05::DOUBLE) AS fell_r, min(s.i) FILTER (s.i > c.i AND up * (s.zeta - c.z) > 0) AS rose_r FROM c JOIN s USING (face_id) GROUP BY ALL),
    waters AS (SELECT t.face_id, t.i, t.z, up, s.time FROM t JOIN s USING (face_id, i) WHERE fell_l > coalesce(rose_l, 0) AND fell_r < coalesce(rose_r, 1e18)),
    highs AS (SELECT *, row_number() OVER w AS cycle, lead(i) OVER w AS next, lead(time) OVER w AS next_time, lag(time) OVER w AS last_time FROM waters WHERE up = 1 WINDOW w AS (PARTITION BY face_id ORDER BY i))"""


@REG.add("tidal_peaks_periods", f"""WITH {WATERS_SQL},
    g AS (SELECT face_id, date_diff('microsecond', last_time, time) AS us, us / 3.6e9::DOUBLE AS h FROM highs),
    k AS (SELECT face_id, us, h > 10 AND h < 14 AS half FROM g WHERE h > 10 AND h < 14 OR h > 20 AND h < 26),
    d AS (SELECT face_id, avg(us) / 1e6::DOUBLE AS a, min(us) / 1e6::DOUBLE AS b, max(us) / 1e6::DOUBLE AS c, bool_or(half) AS half, bool_or(NOT half) AS day FROM k GROUP BY face_id),
    m AS (SELECT face_id, avg(zeta) AS mean, count(*) AS n FROM series GROUP BY face_id),
    f AS (SELECT face_id, row_number() OVER (PARTITION BY face_id ORDER BY zeta, time) AS lo, zeta, greatest(floor(n * 0.2), 1) AS k, n FROM series JOIN m USING (face_id)),
    e AS (SELECT face_id, avg(zeta) FILTER (n - lo + 1 <= k) AS high_mean, avg(zeta) FILTER (lo <= k) AS low_mean, max(zeta) AS high_max, min(zeta) AS low_min FROM f GROUP BY face_id),
    l AS (SELECT face_id, max(z) FILTER (up = 1) AS a, avg(z) FILTER (up = 1) AS b, avg(z) FILTER (up = -1) AS c, min(z) FILTER (up = -1) AS d FROM waters GROUP BY face_id)
    SELECT face_id, round(mean, 10) + 0.0 AS mean_level, round(coalesce(l.a, high_max) - mean, 10) + 0.0 AS high_max, round(coalesce(l.b, high_mean) - mean, 10) + 0.0 AS high_mean, round(coalesce(l.c, low_mean) - mean, 10) + 0.0 AS low_mean,
           round(coalesce(l.d, low_min) - mean, 10) + 0.0 AS low_min, round(coalesce(l.b, high_mean) - coalesce(l.c, low_mean), 10) + 0.0 AS tidal_range,
           coalesce(d.a, 0) AS average_period_s, coalesce(d.b, 0) AS min_period_s, coalesce(d.c, 0) AS max_period_s,
           CASE WHEN half AND day THEN 'Mixed' WHEN half THEN 'Semidiurnal' WHEN day THEN 'Diurnal' ELSE 'Unknown' END AS tide_type
    FROM m JOIN e USING (face_id) LEFT JOIN l USING (face_id) LEFT JOIN d USING (face_id)""")
def tidal_peaks_periods(spark, sf):
    out = tides.tidal_summary(series(spark, sf), ["face_id"], "zeta")
    return rounded(out, "mean_level", *tides.LEVELS, digits=10)  # periods come from whole microseconds


CYCLES_SQL = f"""{WATERS_SQL},
    lows AS (SELECT h.face_id, h.cycle, arg_min(w.time, (w.z, w.i)) AS low_time, min(w.z) AS low_level FROM highs h JOIN waters w ON w.face_id = h.face_id AND w.up = -1 AND w.i > h.i AND w.i < h.next GROUP BY ALL),
    cycles AS (SELECT h.face_id, h.cycle, h.time AS high_time, h.z AS high_level, low_time, low_level, h.z - low_level AS tidal_range, date_diff('microsecond', h.time, next_time) / 1e6::DOUBLE AS period_s FROM highs h JOIN lows USING (face_id, cycle))"""


@REG.add("tidal_cycles", f"WITH {CYCLES_SQL} SELECT face_id, cycle, high_time, high_level, low_time, low_level, round(tidal_range, 6) + 0.0 AS tidal_range, round(period_s, 6) + 0.0 AS period_s FROM cycles")
def tidal_cycles(spark, sf):
    """A month of events cut into ranges of six days."""
    out = tides.tidal_cycles(series(spark, sf), ["face_id"], "zeta", range_days=6.0, overlap_days=3.0)
    return rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("high_time", "low_time")}), "tidal_range", "period_s")


@REG.add("tidal_cycle_ranges", f"""WITH {CYCLES_SQL} SELECT face_id, count(*) AS n_cycles, round(avg(tidal_range), 10) AS average_range, round(min(tidal_range), 10) AS min_range, round(max(tidal_range), 10) AS max_range,
    arg_min(high_time, (tidal_range, cycle)) AS min_range_time, arg_max(high_time, (tidal_range, -cycle)) AS max_range_time FROM cycles GROUP BY face_id
    HAVING bool_or(period_s > 36000 AND period_s < 50400 OR period_s > 72000 AND period_s < 93600)""")
def tidal_cycle_ranges(spark, sf):
    out = tides.cycle_ranges(tides.tidal_cycles(series(spark, sf), ["face_id"], "zeta"), ["face_id"])
    return rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("min_range_time", "max_range_time")}), "average_range", "min_range", "max_range", digits=10)


@REG.add("pivot_layers", f"""WITH {LAYERS_SQL} SELECT face_id, {", ".join(f"max(value) FILTER (sigma_layer = {k}) AS value_sigma_level_{k + 1}" for k in range(10))} FROM layers GROUP BY face_id""")
def pivot_layers(spark, sf):
    return reshape.pivot_layers(layers(spark, sf), ["face_id"], ["value"])


@REG.add("unpivot_layers", f"WITH {LAYERS_SQL} SELECT face_id, sigma_layer, value FROM layers")
def unpivot_layers(spark, sf):
    return reshape.unpivot_layers(pivot_layers(spark, sf), ["face_id"], "value")


@REG.add("union_locations", "SELECT 'customer' AS location, c_custkey AS face_id, c_acctbal AS value, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier")
def union_locations(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("face_id"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("face_id"), F.col("s_acctbal").alias("value"))
    return reshape.union_all({"customer": a, "supplier": b})


@REG.add("set_difference", "SELECT p_partkey AS face_id FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 48")
def set_difference(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("face_id")).subtract(table(spark, sf, "lineitem").where("l_quantity > 48").select("l_partkey"))


@REG.add("missing_batches", "SELECT i AS batch FROM (SELECT unnest(generate_series(0, (SELECT max(o_orderkey) FROM orders) // 4)) AS i) WHERE i NOT IN (SELECT o_orderkey // 4 FROM orders WHERE o_orderstatus = 'F')")
def missing_batches(spark, sf):
    orders = table(spark, sf, "orders")
    total = orders.agg(F.max("o_orderkey")).first()[0] + 1
    return reshape.missing_batches(orders.where("o_orderstatus = 'F'").select(reshape.batch_of("o_orderkey", 4).alias("batch")).distinct(), total, 4)


@REG.add("skip_existing", "SELECT o_orderkey AS file_index FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40)")
def skip_existing(spark, sf):
    done = table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("file_index"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("file_index")).join(done, "file_index", "left_anti")


@REG.add("timestamp_membership", f"WITH {SERIES_SQL} SELECT event_id FROM series WHERE date_trunc('day', time) IN (SELECT date_trunc('day', o_orderdate) + INTERVAL 27 YEAR FROM orders)")
def timestamp_membership(spark, sf):
    s = series(spark, sf).withColumn("day", F.date_trunc("day", "time"))
    wanted = table(spark, sf, "orders").select(F.date_trunc("day", F.col("o_orderdate") + F.expr("INTERVAL 27 YEAR")).alias("day"))
    return s.join(wanted, "day", "left_semi").select("event_id")


@REG.add("fill_value", f"WITH {SERIES_SQL} SELECT event_id, CASE WHEN event_type = 'click' THEN -999.0::DOUBLE ELSE zeta END AS zeta FROM series")
def fill_value(spark, sf):
    return reshape.fill(series(spark, sf).withColumn("zeta", F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("zeta"))), ["zeta"]).select("event_id", "zeta")


@REG.add("static_face_join", f"WITH {SERIES_SQL} SELECT event_id, n_name AS jurisdiction, s_acctbal AS distance FROM series LEFT JOIN supplier ON s_suppkey = face_id LEFT JOIN nation ON n_nationkey = s_nationkey")
def static_face_join(spark, sf):
    from halocline.operators.derive import join_static

    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("jurisdiction"))
    face = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.col("s_suppkey").alias("face_id"), "jurisdiction", F.col("s_acctbal").alias("distance"))
    return join_static(series(spark, sf), face, ["face_id"], ["jurisdiction", "distance"]).select("event_id", "jurisdiction", "distance")
