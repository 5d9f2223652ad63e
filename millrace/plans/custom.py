"""Registered user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.plans.registry import query
from millrace.tables import load


@query("udf_scalar", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price FROM orders")
def udf_scalar(spark, sf):
    return load(spark, sf, "orders", "o_orderkey", "o_totalprice").select(
        "o_orderkey", F.round(udfs.log1p("o_totalprice"), 6).alias("log_price")
    )


@query("udaf_geomean", """
    SELECT event_type, round(exp(avg(ln(value))), 6) AS geomean FROM events WHERE value > 0 GROUP BY event_type
""")
def udaf_geomean(spark, sf):
    out = udfs.geometric_mean(load(spark, sf, "events", "event_type", "value"), ["event_type"], "value")
    return out.select("event_type", F.round("geomean", 6).alias("geomean"))


@query("udtf_tokens", """
    SELECT conv_id, count(*) AS n_tokens, max(pos)::INTEGER AS last_pos FROM (
      SELECT conv_id, turn, token, row_number() OVER (PARTITION BY conv_id, turn, role ORDER BY i) - 1 AS pos FROM (
        SELECT conv_id, turn, role, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM (
          SELECT conv_id, turn, role, regexp_split_to_array(text, '\\s+') AS t FROM conversations))
      WHERE token <> '') GROUP BY conv_id
""")
def udtf_tokens(spark, sf):
    turns = load(spark, sf, "conversations", "conv_id", "text")
    return udfs.tokens(turns, "conv_id", "text").groupBy("conv_id").agg(
        F.count("*").alias("n_tokens"), F.max("pos").alias("last_pos")
    )


@query("mapreduce_counts", """
    SELECT word, count(*) AS n FROM (
      SELECT unnest(regexp_split_to_array(lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g')), '\\s+')) AS word
      FROM conversations) WHERE word <> '' GROUP BY word
""")
def mapreduce_counts(spark, sf):
    def mapper(batch: pd.DataFrame) -> pd.DataFrame:
        clean = batch["text"].str.replace(r"[^a-zA-Z0-9\s]", "", regex=True).str.lower()
        counts = clean.str.split().explode().dropna().value_counts()
        return pd.DataFrame({"word": counts.index.astype(str), "n": counts.to_numpy()})

    return udfs.map_combine_reduce(
        load(spark, sf, "conversations", "text"), mapper, "word STRING, n BIGINT", ["word"], {"n": F.sum("n")}
    )
