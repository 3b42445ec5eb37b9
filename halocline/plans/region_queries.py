"""Regional statistics and job bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.functions import names
from halocline.operators import bookkeeping, regions
from halocline.plans.tables import Registry, rounded, table

REG = Registry()


def by_region(spark, sf):
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    nation = table(spark, sf, "nation").join(region, "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "region", F.col("n_name").alias("nation"))
    return table(spark, sf, "customer").join(nation, "c_nationkey").select("region", "nation", F.col("c_custkey").alias("face_id"), F.col("c_acctbal").alias("value"))


BY_REGION = "f AS (SELECT r_name AS region, n_name AS nation, c_custkey AS face_id, c_acctbal AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


@REG.add("comparison_stats", f"""WITH {BY_REGION} SELECT region, round(quantile_cont(value, 0.95), 6) + 0.0 AS p95, round(quantile_cont(value, 0.99), 6) + 0.0 AS p99, round(quantile_cont(value, 0.9999), 6) + 0.0 AS p99_99,
    min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) + 0.0 AS mean_value, round(stddev_samp(value), 6) AS std_value, count(*) AS n_rows, count(value) AS n_values FROM f GROUP BY region""")
def comparison_stats(spark, sf):
    return rounded(regions.describe(by_region(spark, sf), ["region"], "value"), "p95", "p99", "p99_99", "mean_value", "std_value")


@REG.add("power_statistics", "SELECT round(min(o_totalprice), 6) AS min_value, round(max(o_totalprice), 6) AS max_value, round(avg(o_totalprice), 4) AS mean_value, round(median(o_totalprice), 6) AS median_value, round(stddev_pop(o_totalprice), 4) AS std_value, round(quantile_cont(o_totalprice, 0.95), 6) AS p95, round(quantile_cont(o_totalprice, 0.99), 6) AS p99 FROM orders")
def power_statistics(spark, sf):
    out = regions.power_statistics(table(spark, sf, "orders"), "o_totalprice")
    return rounded(rounded(out, "min_value", "max_value", "median_value", "p95", "p99"), "mean_value", "std_value", digits=4)


@REG.add("retention_rate", f"WITH {BY_REGION} SELECT region, round(count(*) FILTER (value <= 5000) * 100.0::DOUBLE / count(value), 6) AS retention_pct, count(value) AS n_values FROM f GROUP BY region")
def retention_rate(spark, sf):
    return rounded(regions.retention(by_region(spark, sf), ["region"], "value", 5000), "retention_pct")


@REG.add("regional_rollup", f"WITH {BY_REGION} SELECT region, nation, count(*) AS n, round(avg(value), 6) + 0.0 AS mean_value, max(value) AS max_value FROM f GROUP BY ROLLUP (region, nation)")
def regional_rollup(spark, sf):
    return rounded(regions.with_total(by_region(spark, sf), ["region", "nation"], [F.count("*").alias("n"), F.avg("value").alias("mean_value"), F.max("value").alias("max_value")]), "mean_value")


@REG.add("histogram", f"WITH {BY_REGION} SELECT region, CAST(least(floor((value + 1000) / 550), 19) AS INTEGER) AS bin, count(*) AS n FROM f WHERE value BETWEEN -1000 AND 10000 GROUP BY ALL")
def histogram(spark, sf):
    return regions.histogram(by_region(spark, sf), ["region"], "value", -1000.0, 10000.0, 20)


@REG.add("correlation_matrix", """WITH l AS (SELECT * FROM lineitem) SELECT 'l_quantity' AS x, 'l_quantity' AS y, round(corr(l_quantity, l_quantity), 6) AS r FROM l
    UNION ALL SELECT 'l_quantity', 'l_extendedprice', round(corr(l_quantity, l_extendedprice), 6) FROM l UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) + 0.0 FROM l
    UNION ALL SELECT 'l_extendedprice', 'l_extendedprice', round(corr(l_extendedprice, l_extendedprice), 6) FROM l UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) + 0.0 FROM l
    UNION ALL SELECT 'l_discount', 'l_discount', round(corr(l_discount, l_discount), 6) FROM l""")
def correlation_matrix(spark, sf):
    return rounded(regions.correlations(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), "r")


@REG.add("pooled_stats", "WITH a AS (SELECT c_nationkey AS nation, c_acctbal AS value FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier) SELECT nation, count(value) AS n_values, round(avg(value), 6) + 0.0 AS mean_value, round(stddev_samp(value), 6) AS std_value FROM a GROUP BY nation")
def pooled_stats(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("value"))
    b = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("value"))
    return rounded(regions.pooled([a, b], ["nation"], "value"), "mean_value", "std_value")


@REG.add("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return regions.value_counts(table(spark, sf, "events"), "event_type")


STATUS_SQL = """manifest AS (SELECT o_orderkey AS file_index, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'pending' ELSE 'completed' END AS upload_status,
    'store/' || o_orderkey AS s3_destination, md5(o_orderkey::VARCHAR) AS etag FROM orders)"""


def manifest(spark, sf):
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "pending").otherwise("completed")
    return table(spark, sf, "orders").select(key.alias("file_index"), status.alias("upload_status"), F.concat(F.lit("store/"), key).alias("s3_destination"), F.md5(key.cast("string").cast("binary")).alias("etag"))


def listed(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").where(key % 3 == 0).select(F.concat(F.lit("store/"), key).alias("s3_destination"), F.md5((key + F.when(key % 9 == 0, 1).otherwise(0)).cast("string").cast("binary")).alias("etag"))


LISTED_SQL = "listed AS (SELECT 'store/' || o_orderkey AS s3_destination, md5((o_orderkey + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END)::VARCHAR) AS etag FROM orders WHERE o_orderkey % 3 = 0)"


@REG.add("status_summary", f"WITH {STATUS_SQL} SELECT upload_status, count(*) AS n_files FROM manifest GROUP BY upload_status")
def status_summary(spark, sf):
    return bookkeeping.status_summary(manifest(spark, sf))


@REG.add("pending_slice", f"WITH {STATUS_SQL} SELECT file_index, s3_destination FROM manifest WHERE upload_status = 'pending' AND file_index BETWEEN 500 AND 999")
def pending_slice(spark, sf):
    return bookkeeping.batch_slice(manifest(spark, sf), 1, 500).select("file_index", "s3_destination")


@REG.add("failed_manifest", f"WITH {STATUS_SQL} SELECT file_index, 'pending' AS upload_status, s3_destination, etag FROM manifest WHERE upload_status = 'failed'")
def failed_manifest(spark, sf):
    return bookkeeping.failed_manifest(manifest(spark, sf))


@REG.add("mark_existing", f"WITH {STATUS_SQL}, {LISTED_SQL} SELECT file_index, s3_destination, etag, CASE WHEN upload_status = 'pending' AND s3_destination IN (SELECT s3_destination FROM listed) THEN 'skipped' ELSE upload_status END AS upload_status FROM manifest")
def mark_existing(spark, sf):
    return bookkeeping.mark_existing(manifest(spark, sf), listed(spark, sf))


@REG.add("update_status", f"WITH {STATUS_SQL} SELECT file_index, s3_destination, CASE WHEN file_index % 5 = 0 THEN 'completed' ELSE upload_status END AS upload_status, CASE WHEN file_index % 5 = 0 THEN 'new' ELSE etag END AS etag FROM manifest")
def update_status(spark, sf):
    m = manifest(spark, sf)
    return bookkeeping.update_status(m, m.where("file_index % 5 = 0").select("file_index", F.lit("completed").alias("upload_status"), F.lit("new").alias("etag")))


@REG.add("etag_mismatches", f"WITH {STATUS_SQL}, {LISTED_SQL} SELECT m.file_index, l.etag AS seen_etag FROM manifest m LEFT JOIN listed l USING (s3_destination) WHERE upload_status = 'completed' AND m.etag IS DISTINCT FROM l.etag")
def etag_mismatches(spark, sf):
    return bookkeeping.etag_mismatches(manifest(spark, sf), listed(spark, sf)).select("file_index", "seen_etag")


@REG.add("multipart_etag", """WITH d AS (SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents), p AS (SELECT *, CAST(ceil(n / 4096.0) AS BIGINT) AS k FROM d)
    SELECT doc_id, CASE WHEN n <= 4096 THEN md5(unhex(h)) ELSE md5(unhex(array_to_string(list_transform(generate_series(0, k - 1), lambda i: md5(unhex(substr(h, i * 8192 + 1, 8192)))), ''))) || '-' || k END AS etag FROM p""")
def multipart_etag(spark, sf):
    return table(spark, sf, "documents").select("doc_id", names.multipart_etag(F.col("text").cast("binary"), 4096).alias("etag"))


@REG.add("jobs_needed", "SELECT n_nationkey AS nation, CAST(ceil((n_nationkey * 37 + 1) / 10.0) AS BIGINT) AS jobs FROM nation")
def jobs_needed(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), bookkeeping.jobs_needed(F.col("n_nationkey") * 37 + 1, 10).alias("jobs"))


@REG.add("semver_max", "WITH v AS (SELECT p_size % 3 AS a, p_size % 12 AS b, p_partkey % 15 AS c FROM part) SELECT a || '.' || b || '.' || c AS version, a || '.' || b || '.' || (c + 1) AS next_version FROM (SELECT DISTINCT a, b, c FROM v ORDER BY a DESC, b DESC, c DESC LIMIT 1)")
def semver_max(spark, sf):
    part = table(spark, sf, "part").select(F.concat_ws(".", F.col("p_size") % 3, F.col("p_size") % 12, F.col("p_partkey") % 15).alias("version"))
    return bookkeeping.latest_version(part.distinct()).select("version", names.next_patch("version").alias("next_version"))
