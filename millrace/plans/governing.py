"""Registered masking, access and lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import lineage, policies
from millrace.plans.registry import query
from millrace.tables import load


@query("mask_sha256", "SELECT c_custkey, sha256(c_name) AS name_hash FROM customer")
def mask_sha256(spark, sf):
    return load(spark, sf, "customer", "c_custkey", "c_name").select(
        "c_custkey", scalars.mask_hash(F.col("c_name")).alias("name_hash")
    )


@query("mask_last4", """
    SELECT c_custkey, repeat('x', CAST(length(c_name) - 4 AS INTEGER)) || right(c_name, 4) AS c_name FROM customer
""")
def mask_last4(spark, sf):
    return load(spark, sf, "customer", "c_custkey", "c_name").select(
        "c_custkey", scalars.mask_last(F.col("c_name")).alias("c_name")
    )


@query("safe_projection", "SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, c_mktsegment FROM customer")
def safe_projection(spark, sf):
    return policies.safe_columns(
        load(spark, sf, "customer"), ["c_acctbal"], {"c_name": scalars.mask_hash(F.col("c_name"))}
    )


@query("row_filter_by_group", """
    SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (1, 2) OR c_mktsegment = 'BUILDING'
""")
def row_filter_by_group(spark, sf):
    rules = {
        "americas_analysts": "c_nationkey IN (1, 2)", "building_desk": "c_mktsegment = 'BUILDING'",
        "asia_analysts": "c_nationkey IN (8, 9)",
    }
    seen = policies.row_filter(load(spark, sf, "customer"), rules, ["americas_analysts", "building_desk", "staff"])
    return seen.select("c_custkey", "c_nationkey")


# kind, name, principal, action, effect
POLICIES = [
    ("resource", "view", "analysts", "read", "allow"),
    ("resource", "click", "analysts", "read", "allow"),
    ("resource", "purchase", "finance", "read", "allow"),
    ("resource", "purchase", "interns", "read", "deny"),
    ("tag", "PII", "interns", "read", "deny"),
    ("tag", "PII", "finance", "read", "allow"),
    ("tag", "PII", "seniors", "read", "deny_exception"),
    ("resource", "click", "seniors", "read", "allow_exception"),
]

DECISION_SQL = """
    WITH p(kind, name, principal, effect) AS (VALUES
      ('resource', 'view', 'analysts', 'allow'), ('resource', 'click', 'analysts', 'allow'),
      ('resource', 'purchase', 'finance', 'allow'), ('resource', 'purchase', 'interns', 'deny'),
      ('tag', 'PII', 'interns', 'deny'), ('tag', 'PII', 'finance', 'allow'),
      ('tag', 'PII', 'seniors', 'deny_exception'), ('resource', 'click', 'seniors', 'allow_exception')),
    rt(resource, tag) AS (VALUES ('purchase', 'PII'), ('signup', 'PII')),
    rule AS (SELECT name AS resource, principal, effect FROM p WHERE kind = 'resource'
             UNION ALL SELECT resource, principal, effect FROM p JOIN rt ON rt.tag = p.name WHERE kind = 'tag'),
    g AS (SELECT c_custkey AS user_id, 'analysts' AS grp FROM customer WHERE c_custkey % 2 = 0
          UNION ALL SELECT c_custkey, 'finance' FROM customer WHERE c_custkey % 3 = 0
          UNION ALL SELECT c_custkey, 'interns' FROM customer WHERE c_custkey % 5 = 0
          UNION ALL SELECT c_custkey, 'seniors' FROM customer WHERE c_custkey % 10 = 0),
    f AS (SELECT e.event_id, e.user_id, e.event_type,
            coalesce(bool_or(effect = 'deny'), false) AS deny, coalesce(bool_or(effect = 'deny_exception'), false) AS dx,
            coalesce(bool_or(effect = 'allow'), false) AS allow, coalesce(bool_or(effect = 'allow_exception'), false) AS ax
          FROM events e LEFT JOIN g ON g.user_id = e.user_id
          LEFT JOIN rule r ON r.resource = e.event_type AND r.principal = g.grp GROUP BY ALL),
    d AS (SELECT event_id, user_id, event_type, CASE WHEN deny AND NOT dx THEN 'DENY' WHEN allow AND ax THEN 'DENY'
                 WHEN allow THEN 'ALLOW' ELSE 'DENY' END AS decision FROM f)
"""


def _decisions(spark, sf):
    requests = load(spark, sf, "events", "event_id", "user_id", "event_type").select(
        "event_id", F.col("user_id").cast("string").alias("user"), F.col("event_type").alias("resource"),
        F.lit("read").alias("action"),
    )
    i = F.col("c_custkey")
    groups = F.array_compact(F.array(
        F.when(i % 2 == 0, "analysts"), F.when(i % 3 == 0, "finance"),
        F.when(i % 5 == 0, "interns"), F.when(i % 10 == 0, "seniors"),
    ))
    memberships = load(spark, sf, "customer", "c_custkey").select(
        i.cast("string").alias("user"), F.explode(groups).alias("group")
    )
    tags = spark.createDataFrame([("purchase", "PII"), ("signup", "PII")], "resource STRING, tag STRING")
    rules = spark.createDataFrame(POLICIES, "kind STRING, name STRING, principal STRING, action STRING, effect STRING")
    return policies.decide(requests, memberships, tags, rules)


@query("policy_decisions", DECISION_SQL + "SELECT event_id, decision FROM d")
def policy_decisions(spark, sf):
    return _decisions(spark, sf).select("event_id", "decision")


@query("audit_summary", DECISION_SQL + """
    SELECT CAST(user_id AS VARCHAR) AS "user", count(*) FILTER (WHERE decision = 'ALLOW') AS allowed,
           count(*) FILTER (WHERE decision = 'DENY') AS denied FROM d GROUP BY user_id
""")
def audit_summary(spark, sf):
    return policies.audit_counts(_decisions(spark, sf))


def _edges(spark, sf):
    """A binary tree over the part keys; steps to the smallest sizes mask."""
    return load(spark, sf, "part", "p_partkey", "p_size").select(
        F.floor(F.col("p_partkey") / 2).cast("bigint").alias("src"), F.col("p_partkey").alias("dst"),
        (F.col("p_size") <= 5).alias("masks"),
    )


EDGES = "e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst, p_size <= 5 AS masks FROM part)"


@query("lineage_reach", f"""
    WITH RECURSIVE {EDGES},
    d AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM d JOIN e ON src = node),
    last AS (SELECT max(p_partkey) AS node FROM part),
    u AS (SELECT node, 0 AS depth FROM last UNION SELECT src, depth + 1 FROM u JOIN e ON dst = node WHERE depth < 3)
    SELECT 'down' AS direction, node, depth FROM d WHERE depth > 0
    UNION ALL SELECT 'up', node, depth FROM u WHERE depth > 0
""")
def lineage_reach(spark, sf):
    edges = _edges(spark, sf)
    nodes = load(spark, sf, "part", "p_partkey")
    down = lineage.reach(edges, nodes.filter("p_partkey = 1").select(F.col("p_partkey").alias("node")))
    up = lineage.reach(edges, nodes.agg(F.max("p_partkey").alias("node")), "up", 3)
    return down.withColumn("direction", F.lit("down")).unionByName(up.withColumn("direction", F.lit("up")))


def _tags(spark, sf):
    return load(spark, sf, "part", "p_partkey", "p_size").filter("p_size IN (20, 30)").select(
        F.col("p_partkey").alias("node"), F.when(F.col("p_size") == 20, "PCI").otherwise("PII").alias("tag"),
    )


TAGS = f"""
    WITH RECURSIVE {EDGES},
    tags AS (SELECT p_partkey AS node, CASE WHEN p_size = 20 THEN 'PCI' ELSE 'PII' END AS tag
             FROM part WHERE p_size IN (20, 30)),
    t AS (SELECT node, tag FROM tags UNION SELECT dst, tag FROM t JOIN e ON src = node WHERE NOT masks)
"""


@query("tag_propagation", TAGS + "SELECT node, tag FROM t")
def tag_propagation(spark, sf):
    return lineage.propagate_tags(_edges(spark, sf), _tags(spark, sf))


@query("impact_analysis", f"""
    WITH RECURSIVE {EDGES},
    i AS (SELECT p_partkey AS changed, p_partkey AS affected, 0 AS depth FROM part
          WHERE p_brand = 'Brand#7'
          UNION SELECT changed, dst, depth + 1 FROM i JOIN e ON src = affected AND dst <> src)
    SELECT changed, affected, depth FROM i WHERE depth > 0
""")
def impact_analysis(spark, sf):
    changed = load(spark, sf, "part", "p_partkey", "p_brand").filter("p_brand = 'Brand#7'")
    return lineage.impact(_edges(spark, sf), changed.select(F.col("p_partkey").alias("node")))


@query("unmasked_leaks", TAGS + """
    SELECT node, tag FROM t JOIN part ON p_partkey = node WHERE p_type = 'ECONOMY' AND (node, tag) NOT IN (SELECT (node, tag) FROM tags)
""")
def unmasked_leaks(spark, sf):
    exposed = load(spark, sf, "part", "p_partkey", "p_type").filter("p_type = 'ECONOMY'").select(
        F.col("p_partkey").alias("node")
    )
    return lineage.unmasked_leaks(_edges(spark, sf), _tags(spark, sf), exposed)
