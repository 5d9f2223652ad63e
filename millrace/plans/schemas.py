"""Registered schema evolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evolution, quality
from millrace.operators.evolution import Field
from millrace.plans.registry import query
from millrace.tables import load

V1 = [Field("id", "string"), Field("name", "string"), Field("email", "string"), Field("timestamp", "int")]
V2 = [
    Field("id", "string"), Field("name", "string"), Field("email", "string"), Field("timestamp", "long"),
    Field("phoneNumber", "string", nullable=True, default=None, has_default=True),
    Field("status", "string", default="ACTIVE", has_default=True),
]


@query("schema_resolve_v1_v2", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, lower(c_name) || '@example.com' AS email,
           CAST(c_nationkey AS BIGINT) AS "timestamp",
           CASE WHEN c_custkey % 2 = 1 THEN '555-' || c_custkey END AS phoneNumber,
           CASE WHEN c_custkey % 2 = 1 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status
    FROM customer
""")
def schema_resolve_v1_v2(spark, sf):
    customer = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    common = [
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
    ]
    old = customer.filter("c_custkey % 2 = 0").select(*common, F.col("c_nationkey").alias("timestamp"))
    new = customer.filter("c_custkey % 2 = 1").select(
        *common, F.col("c_nationkey").cast("bigint").alias("timestamp"),
        F.concat(F.lit("555-"), F.col("c_custkey").cast("string")).alias("phoneNumber"),
        F.lit("SUSPENDED").alias("status"),
    )
    return evolution.resolve(old, V1, V2).unionByName(evolution.resolve(new, V2, V2))


@query("schema_compat_matrix", """
    WITH f AS (
      SELECT event_type || '-value' AS subject, event_id % 3 + 1 AS version, unnest(CASE event_id % 3
        WHEN 0 THEN ['id', 'name', 'email', 'timestamp']
        WHEN 1 THEN ['id', 'name', 'email', 'timestamp', 'phoneNumber', 'status']
        ELSE ['id', 'name', 'timestamp', 'age'] END) AS field FROM events),
    v AS (SELECT DISTINCT subject, version FROM f),
    fd AS (SELECT DISTINCT subject, version, field, field IN ('phoneNumber', 'status') AS d FROM f),
    p AS (SELECT o.subject, o.version AS old, 3 AS new FROM v o WHERE o.version < 3),
    b AS (SELECT p.subject, p.old, string_agg('no default: ' || field, '; ' ORDER BY field) AS r
          FROM p JOIN fd ON fd.subject = p.subject AND fd.version = 3
          WHERE NOT d AND NOT EXISTS (SELECT 1 FROM fd o WHERE o.subject = p.subject AND o.version = p.old AND o.field = fd.field)
          GROUP BY 1, 2),
    g AS (SELECT p.subject, p.old, string_agg('no default: ' || field, '; ' ORDER BY field) AS r
          FROM p JOIN fd ON fd.subject = p.subject AND fd.version = p.old
          WHERE NOT d AND NOT EXISTS (SELECT 1 FROM fd o WHERE o.subject = p.subject AND o.version = 3 AND o.field = fd.field)
          GROUP BY 1, 2),
    m AS (SELECT unnest(['BACKWARD', 'FORWARD', 'FULL', 'NONE']) AS mode),
    r AS (SELECT p.subject, p.old, CAST(p.new AS BIGINT) AS new, mode,
            CASE mode WHEN 'BACKWARD' THEN coalesce(b.r, '') WHEN 'FORWARD' THEN coalesce(g.r, '')
                      WHEN 'FULL' THEN concat_ws('; ', b.r, g.r) ELSE '' END AS reasons
          FROM p CROSS JOIN m LEFT JOIN b ON b.subject = p.subject AND b.old = p.old
          LEFT JOIN g ON g.subject = p.subject AND g.old = p.old)
    SELECT *, reasons = '' AS ok FROM r
""")
def schema_compat_matrix(spark, sf):
    """The versions are those seen in the messages: their JSON keys are counted first."""
    base = ["id", "name", "email", "timestamp"]

    def record(names):
        return F.to_json(F.struct(*[F.col("event_id").alias(n) for n in names]))

    messages = load(spark, sf, "events", "event_id", "event_type").select(
        evolution.subject_name("topic", F.col("event_type"), F.lit("User")).alias("subject"),
        (F.col("event_id") % 3 + 1).alias("version"),
        F.when(F.col("event_id") % 3 == 0, record(base))
        .when(F.col("event_id") % 3 == 1, record([*base, "phoneNumber", "status"]))
        .otherwise(record(["id", "name", "timestamp", "age"])).alias("value"),
    )
    seen = messages.select(
        "subject", "version", F.explode(F.json_object_keys("value")).alias("field")
    ).distinct()
    fields = seen.select(
        "*", F.when(F.col("field") == "timestamp", "long").when(F.col("field") == "age", "int")
        .otherwise("string").alias("type"),
        F.col("field").isin("phoneNumber", "status").alias("has_default"),
    )
    return evolution.compatibility(fields, transitive=True)


@query("wire_header_split", """
    SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id + 100000 END AS schema_id,
           CASE WHEN event_id % 13 <> 0 THEN props END AS payload,
           CASE WHEN event_id % 13 = 0 THEN 'bad magic byte' END AS reason FROM events
""")
def wire_header_split(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "props")
    magic = F.when(F.col("event_id") % 13 == 0, 1).otherwise(0)
    framed = events.select(
        "event_id", evolution.frame(F.col("user_id") + 100_000, F.col("props"), magic).alias("value")
    )
    return evolution.split_frame(framed, "value").select(
        "event_id", "schema_id", F.decode("payload", "UTF-8").alias("payload"), "reason"
    )


def damaged(events):
    """Events as JSON text, with every kind of damage on a tenth of the rows each."""
    i = F.col("event_id")
    good = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    return events.withColumn(
        "value",
        F.when(i % 10 == 0, F.to_json(F.struct("event_id", "event_type", "value")))
        .when(i % 10 == 1, F.to_json(F.struct("event_id", F.lit("abc").alias("user_id"), "event_type", "value")))
        .when(i % 10 == 2, F.lit('{"event_id": 12, "user'))
        .when(i % 10 == 3, F.lit("[1, 2]"))
        .otherwise(good),
    )


REQUIRED = {"event_id": "BIGINT", "user_id": "BIGINT", "event_type": "STRING"}


@query("schema_conformance", """
    SELECT event_id AS source_id, CASE event_id % 10 WHEN 0 THEN 'missing:user_id' WHEN 1 THEN 'type:user_id'
           WHEN 2 THEN 'not_json' WHEN 3 THEN 'not_json' ELSE '' END AS violations FROM events
""")
def schema_conformance(spark, sf):
    rows = damaged(load(spark, sf, "events")).select(F.col("event_id").alias("source_id"), "value")
    return quality.with_reject_reason(rows, "value", REQUIRED).select(
        "source_id", F.array_join("violations", ",").alias("violations")
    )
