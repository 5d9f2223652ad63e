"""Registered web log queries: access-log lines of the events, networks of nations and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import weblogs
from millrace.plans.registry import query
from millrace.tables import load

# What the lines say, straight from the columns.  A damaged line carries the reason it is rejected for.
REQUESTS = """
    SELECT CASE event_id % 50 WHEN 0 THEN 'format' WHEN 1 THEN 'address' WHEN 2 THEN 'status' WHEN 3 THEN 'time' END AS reason,
           CAST(event_id AS BIGINT) * 37 % 256 * 16777216 + (64 + user_id % 64) * 65536 + user_id * 7 % 256 * 256 + event_id % 254 + 1 AS address,
           CASE WHEN event_type = 'error' THEN 500 WHEN user_id % 17 = 0 THEN 404 ELSE 200 END AS status,
           CASE WHEN value < 1 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS size, strftime(ts, '%Y-%m-%d %H') AS hour
    FROM events
"""

# A nation owns eight first octets, its neighbour a part of the fourth of them; a supplier owns 256 addresses there.
NETWORKS = """
    SELECT CAST(n_nationkey AS BIGINT) * 8 * 16777216 AS first, 5 AS len, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT (CAST(n_nationkey AS BIGINT) * 8 + 3) * 16777216 + 64 * 65536, 10, r_name
    FROM (SELECT a.n_nationkey, b.n_regionkey FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 1) % 25)
    JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT (CAST(s_suppkey AS BIGINT) % 25 * 8 + 3) * 16777216 + (64 + s_suppkey % 64) * 65536 + s_suppkey % 256 * 256, 24, r_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

FOUND = f"""
    nets AS ({NETWORKS}),
    shapes AS (SELECT first >> (32 - len) AS prefix, len, min(region) AS region FROM nets GROUP BY ALL),
    tried AS (SELECT address, unnest([5, 10, 24]) AS len FROM (SELECT DISTINCT address FROM requests)),
    found AS (SELECT address, arg_max(region, tried.len) AS region
              FROM tried JOIN shapes ON shapes.len = tried.len AND shapes.prefix = address >> (32 - tried.len) GROUP BY address)
"""


def _lines(spark, sf):
    """The events as lines of an access log, two in twenty-five of them damaged."""
    i, user = F.col("event_id"), F.col("user_id")
    octets = [i * 37 % 256, user % 64 + 64, user * 7 % 256, i % 254 + 1]
    address = F.concat_ws(".", *[o.cast("string") for o in octets])
    status = F.when(F.col("event_type") == "error", "500").when(user % 17 == 0, "404").otherwise("200")
    size = F.when(F.col("value") < 1, "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    stamp = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))
    line = F.format_string(
        '%s - user%s [%s] "GET /%s/%s HTTP/1.1" %s %s "-" "agent"',
        F.when(i % 50 == 1, "300.1.2.3").otherwise(address), user.cast("string"),
        F.when(i % 50 == 3, "yesterday").otherwise(stamp), "event_type", i.cast("string"),
        F.when(i % 50 == 2, "999").otherwise(status), size,
    )
    events = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    return events.select(F.when(i % 50 == 0, F.concat(F.lit("restarted at "), stamp)).otherwise(line).alias("line"))


def _networks(spark, sf):
    region = load(spark, sf, "region", "r_regionkey", "r_name")
    nation = load(spark, sf, "nation", "n_nationkey", "n_regionkey").join(
        region, F.expr("n_regionkey = r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    own = nation.select(F.format_string("%d.0.0.0/5", F.col("n_nationkey") * 8).alias("cidr"), "region")
    lent = nation.select(
        F.format_string("%d.64.0.0/10", (F.col("n_nationkey") + 24) % 25 * 8 + 3).alias("cidr"), "region")
    k = F.col("s_suppkey")
    hosts = load(spark, sf, "supplier", "s_suppkey", "s_nationkey").join(
        nation, F.expr("s_nationkey = n_nationkey")
    ).select(F.format_string("%d.%d.%d.0/24", k % 25 * 8 + 3, k % 64 + 64, k % 256).alias("cidr"), "region")
    return own.union(lent).union(hosts)


@query("weblog_geo_counts", f"""
    WITH requests AS (SELECT * FROM ({REQUESTS}) WHERE reason IS NULL), {FOUND}
    SELECT coalesce(region, 'unknown') AS region, status, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes
    FROM requests LEFT JOIN found USING (address) GROUP BY 1, 2
""")
def weblog_geo_counts(spark, sf):
    good = weblogs.parse_lines(_lines(spark, sf), "line").filter("reason IS NULL")
    return weblogs.region_counts(good, "address", ["status"], "size", _networks(spark, sf), "cidr", "region")


@query("weblog_rejects", f"SELECT reason, count(*) AS n FROM ({REQUESTS}) WHERE reason IS NOT NULL GROUP BY reason")
def weblog_rejects(spark, sf):
    parsed = weblogs.parse_lines(_lines(spark, sf), "line")
    return parsed.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


@query("weblog_hourly_errors", f"""
    SELECT hour, count(*) AS n, count(*) FILTER (status >= 400) AS n_errors, CAST(sum(size) AS BIGINT) AS bytes
    FROM ({REQUESTS}) WHERE reason IS NULL GROUP BY hour
""")
def weblog_hourly_errors(spark, sf):
    good = weblogs.parse_lines(_lines(spark, sf), "line").filter("reason IS NULL")
    hour = F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM-dd HH")
    return good.groupBy(hour.alias("hour")).agg(
        F.count("*").alias("n"), F.count_if(F.col("status") >= 400).alias("n_errors"), F.sum("size").alias("bytes")
    )


@query("text_address_regions", f"""
    WITH hits AS (SELECT unnest(regexp_extract_all(text, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+')) AS a FROM documents),
    parts AS (SELECT a, string_split(a, '.') AS p FROM hits WHERE regexp_full_match(a, '([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}')),
    requests AS (SELECT ((p[1]::BIGINT * 256 + p[2]::BIGINT) * 256 + p[3]::BIGINT) * 256 + p[4]::BIGINT AS address FROM parts
                 WHERE greatest(p[1]::BIGINT, p[2]::BIGINT, p[3]::BIGINT, p[4]::BIGINT) <= 255), {FOUND}
    SELECT coalesce(region, 'unknown') AS region, count(*) AS n FROM requests LEFT JOIN found USING (address) GROUP BY 1
""")
def text_address_regions(spark, sf):
    """Addresses that stand in texts, by region."""
    hits = load(spark, sf, "documents", "text").select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"), 0)).alias("a")
    )
    addresses = hits.select(weblogs.address_number(F.col("a")).alias("address"), F.lit(0).alias("size")).filter("address IS NOT NULL")
    counted = weblogs.region_counts(addresses, "address", [], "size", _networks(spark, sf), "cidr", "region")
    return counted.select("region", "n")
