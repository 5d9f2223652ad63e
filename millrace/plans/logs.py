"""Registered offset arithmetic.  Offsets are dense: event_id over four partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import offsets
from millrace.plans.registry import query
from millrace.sources import topics
from millrace.tables import load

LOG = """
    WITH log AS (SELECT 'clicks' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
                        ts, user_id, event_id FROM events)
"""


def _log(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "ts")
    return topics.as_topic(
        events, "clicks", F.col("user_id"), F.col("event_id"), F.col("event_id"), F.col("ts"), 4
    )


@query("log_partition_counts", LOG + """
    SELECT topic, "partition", min("offset") AS earliest, max("offset") + 1 AS "end",
           max("offset") + 1 - min("offset") AS n_messages FROM log GROUP BY topic, "partition"
""")
def log_partition_counts(spark, sf):
    return offsets.partition_counts(_log(spark, sf))


@query("consumer_lag", LOG + """
    , ends AS (SELECT "partition", min("offset") AS lo, max("offset") + 1 AS hi FROM log GROUP BY 1),
    c AS (SELECT 'billing' AS "group", "partition", max("offset") + 1 AS c FROM log
          WHERE ts < TIMESTAMP '2024-01-25' GROUP BY 2
          UNION ALL SELECT 'search', "partition", max("offset") + 1 FROM log
          WHERE ts < TIMESTAMP '2024-01-10' AND "partition" <> 3 GROUP BY 2)
    SELECT g."group", 'clicks' AS topic, sum(hi - coalesce(c.c, lo))::BIGINT AS lag
    FROM ends CROSS JOIN (SELECT unnest(['billing', 'search']) AS "group") g
    LEFT JOIN c ON c."group" = g."group" AND c."partition" = ends."partition" GROUP BY 1
""")
def consumer_lag(spark, sf):
    log = _log(spark, sf)
    read = {
        "billing": log.filter("timestamp < TIMESTAMP_NTZ'2024-01-25'"),
        "search": log.filter("timestamp < TIMESTAMP_NTZ'2024-01-10' AND partition <> 3"),
    }
    commits = [offsets.offsets_to_commit(df).withColumn("group", F.lit(g)) for g, df in read.items()]
    return offsets.consumer_lag(
        offsets.partition_counts(log), commits[0].unionByName(commits[1]), list(read)
    )


@query("commit_offsets", LOG + """
    SELECT 'good' AS form, topic, "partition", max("offset") + 1 AS committed FROM log
    WHERE event_id % 3 <> 0 GROUP BY ALL
    UNION ALL SELECT 'all', topic, "partition", max("offset") + 1 FROM log GROUP BY ALL
""")
def commit_offsets(spark, sf):
    log = _log(spark, sf)
    good = offsets.offsets_to_commit(log, F.expr("value % 3 <> 0"))
    return good.withColumn("form", F.lit("good")).unionByName(
        offsets.offsets_to_commit(log).withColumn("form", F.lit("all"))
    )


@query("replay_from_ts", LOG + """
    , j AS (SELECT topic, "partition", "offset",
                   CASE WHEN event_id % 9 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END AS ts FROM log),
    f AS (SELECT "partition", min("offset") AS first FROM j WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1)
    SELECT topic, j."partition", "offset", ts AS "timestamp" FROM j JOIN f ON f."partition" = j."partition"
    WHERE "offset" >= first
""")
def replay_from_ts(spark, sf):
    log = _log(spark, sf).withColumn(
        "timestamp", F.expr("CASE WHEN value % 9 = 0 THEN timestamp - INTERVAL 2 DAYS ELSE timestamp END")
    ).select("topic", "partition", "offset", "timestamp")
    return offsets.replay_from(log, "timestamp", F.expr("TIMESTAMP_NTZ'2024-01-20'"))
