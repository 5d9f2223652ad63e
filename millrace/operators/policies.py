"""Masking, row filters and access decisions from policy tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EFFECTS = ["deny", "deny_exception", "allow", "allow_exception"]


def safe_columns(df: DataFrame, hidden: list[str], masks: dict[str, Column]) -> DataFrame:
    """The table without hidden columns and with masked ones."""
    return df.select(*[
        masks[c].alias(c) if c in masks else F.col(c) for c in df.columns if c not in hidden
    ])


def row_filter(df: DataFrame, rules: dict[str, str], groups: list[str], default: bool = False) -> DataFrame:
    """Rows any of the user's groups may see.

    ``rules`` maps a group to a condition.  The conditions become one filter, so
    they are pushed to the scan.  Without a matching rule ``default`` decides.
    """
    own = [F.expr(rules[g]) for g in groups if g in rules]
    if not own:
        return df.filter(F.lit(default))
    return df.filter(reduce(lambda a, b: a | b, own))


def decide(requests: DataFrame, memberships: DataFrame, resource_tags: DataFrame,
           policies: DataFrame, default: str = "DENY") -> DataFrame:
    """Access decision per request (``user, resource, action`` and any other column).

    ``policies`` has ``kind`` (resource or tag), ``name``, ``principal``, ``action``, ``effect``.
    Tag policies are turned into resource policies first, so a deny wins whichever
    side it comes from.  Order: deny, its exception, allow, its exception (which
    denies), default.  Every distinct request is decided once, so a user who
    repeats a request a billion times costs one decision.  No rule matches a NULL, so
    a request with one gets the default.
    """
    by_tag = policies.filter("kind = 'tag'").join(
        resource_tags, policies["name"] == resource_tags["tag"]
    ).select("resource", "principal", "action", "effect")
    direct = policies.filter("kind = 'resource'").select(
        F.col("name").alias("resource"), "principal", "action", "effect"
    )
    rules = direct.unionByName(by_tag).groupBy("resource", "principal", "action").agg(
        *[F.max(F.col("effect") == e).alias(e) for e in EFFECTS]
    )
    key = ["user", "resource", "action"]
    distinct = requests.select(*key).distinct()
    own = distinct.select(*key, F.col("user").alias("principal"))
    through = distinct.join(memberships, "user").select(*key, F.col("group").alias("principal"))
    hits = own.unionByName(through).join(rules, ["resource", "principal", "action"], "left")
    flags = hits.groupBy(*key).agg(*[F.coalesce(F.max(e), F.lit(False)).alias(e) for e in EFFECTS])
    decision = (
        F.when(F.col("deny") & ~F.col("deny_exception"), "DENY")
        .when(F.col("allow") & F.col("allow_exception"), "DENY")
        .when(F.col("allow"), "ALLOW")
        .otherwise(default)
    )
    found = flags.select(*[F.col(k).alias(f"_{k}") for k in key], decision.alias("decision"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return requests.join(found, same).drop(*[f"_{k}" for k in key])


def audit_counts(decisions: DataFrame) -> DataFrame:
    """Allowed and denied requests per user."""
    return decisions.groupBy("user").agg(
        F.count(F.when(F.col("decision") == "ALLOW", 1)).alias("allowed"),
        F.count(F.when(F.col("decision") == "DENY", 1)).alias("denied"),
    )
