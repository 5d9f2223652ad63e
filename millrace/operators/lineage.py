"""Lineage: reach in both directions, label propagation, impact and leaks.

A graph of few edges (counted first) is sent to all tasks, and each walks it from its own
start rows: one job, whatever the depth.  A larger one is walked in rounds.  A round
takes several hops from the newest nodes in one job, keeps for every node found its
smallest depth, drops what earlier rounds have seen and appends the rest to the shared
folder.  So the plan of a round does not grow with the rounds before it, and no round is
lost with an executor.  While a round finds little (a long chain), the next one takes
twice as many hops; the seen nodes are folded into one table now and then.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import BROADCAST_ROWS
from millrace.session import scratch_path, write_through

HOPS, MOST_HOPS = 4, 16  # hops of one round
FOLD = 6  # rounds after which the seen nodes become one table
LITTLE = 1_000  # a round with fewer new nodes doubles the hops of the next


def spread(edges: DataFrame, start: DataFrame, max_depth: int | None = None, few: int = BROADCAST_ROWS) -> DataFrame:
    """Every (label, node) reachable from ``start`` with its smallest depth.

    ``edges`` has ``src, dst``; ``start`` has ``label, node``.  Ends when nothing new is
    found or at ``max_depth``; cycles end by themselves.  A NULL node has no edges.  Up to
    ``few`` distinct edges are walked inside the tasks.
    """
    links = write_through(edges.select("src", "dst").filter("src IS NOT NULL").distinct(), "links")
    first = start.select("label", "node").distinct()
    if links.count() <= few:  # Parquet footers know
        return _walk(links, first, max_depth)
    return _rounds(links, first, max_depth)


def _walk(links: DataFrame, first: DataFrame, max_depth: int | None) -> DataFrame:
    """Each task walks from its own start rows; the smallest depth of all tasks counts."""
    after: dict = defaultdict(list)
    table = links.toArrow()
    for src, dst in zip(table.column("src").to_pylist(), table.column("dst").to_pylist()):
        after[src].append(dst)
    shared = links.sparkSession.sparkContext.broadcast(dict(after))  # of a counted size
    schema = first.withColumn("depth", F.lit(0)).schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: dict = defaultdict(list)
        kinds = None
        for batch in batches:
            kinds = batch.schema.types
            for label, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts[label].append(node)
        for label, level in starts.items():
            seen, depth, get = set(level), 0, shared.value.get
            while level:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(level), kinds[0]), pa.array(level, kinds[1]), pa.array([depth] * len(level), pa.int32())],
                    names=schema.names)
                if depth == max_depth:
                    break
                found = dict.fromkeys(n for here in level for n in get(here, ()) if n not in seen)
                level, depth = list(found), depth + 1
                seen.update(found)

    return first.mapInArrow(walk, schema).groupBy("label", "node").agg(F.min("depth").alias("depth"))


def _rounds(links: DataFrame, first: DataFrame, max_depth: int | None) -> DataFrame:
    """Rounds of joins; every round reads what it found before from the shared folder."""
    spark = links.sparkSession
    first = first.withColumn("depth", F.lit(0))
    path = scratch_path(spark, "spread")
    first.write.parquet(f"{path}/0")
    tables, written, depth, hops = [f"{path}/0"], 0, 0, HOPS

    def read(*paths: str) -> DataFrame:
        return spark.read.schema(first.schema).parquet(*paths)

    while max_depth is None or depth < max_depth:
        hops = hops if max_depth is None else min(hops, max_depth - depth)
        found = read(tables[-1]).filter(F.col("depth") == depth)
        for at in range(depth, depth + hops):
            # Rows of the last hop meet their edges, the others pass; what meets at a node is merged at once.
            met = found.join(links, (F.col("node") == F.col("src")) & (F.col("depth") == at), "left")
            both = F.array(F.struct("node", "depth"), F.struct(F.col("dst").alias("node"), F.lit(at + 1).alias("depth")))
            found = met.select("label", F.explode(F.when(F.col("src").isNull(), F.slice(both, 1, 1)).otherwise(both)).alias("_s")) \
                .groupBy("label", F.col("_s.node").alias("node")).agg(F.min("_s.depth").alias("depth"))
        seen = read(*tables).select(F.col("label").alias("_l"), F.col("node").alias("_n"))
        fresh = found.join(seen, F.col("label").eqNullSafe(F.col("_l")) & F.col("node").eqNullSafe(F.col("_n")), "left_anti")
        written += 1
        fresh.write.parquet(f"{path}/{written}")
        new = read(f"{path}/{written}")
        depth += hops
        if new.filter(F.col("depth") == depth).isEmpty():
            tables.append(f"{path}/{written}")
            break
        if hops < MOST_HOPS and new.limit(LITTLE).count() < LITTLE:
            hops *= 2
        if len(tables) >= FOLD:
            written += 1
            read(*tables).repartition("node").write.parquet(f"{path}/{written}")
            tables = [f"{path}/{written}", f"{path}/{written - 1}"]
        else:
            tables.append(f"{path}/{written}")
    return read(*tables)


def reach(edges: DataFrame, start: DataFrame, direction: str = "down",
          max_depth: int | None = None) -> DataFrame:
    """Nodes reachable from the nodes of ``start`` (column ``node``), without those themselves."""
    if direction == "up":
        edges = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    elif direction != "down":
        raise ValueError("direction is up or down")
    labelled = start.select(F.lit("start").alias("label"), "node")
    return spread(edges, labelled, max_depth).filter("depth > 0").select("node", "depth")


def propagate_tags(edges: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags (``node, tag``) of a node and all it feeds; a masking edge stops them."""
    start = tags.select(F.col("tag").alias("label"), "node")
    return spread(edges.filter("NOT masks"), start).select("node", F.col("label").alias("tag"))


def impact(edges: DataFrame, changed: DataFrame) -> DataFrame:
    """For each changed node, the nodes downstream of it."""
    start = changed.select(F.col("node").alias("label"), "node")
    return spread(edges, start).filter("depth > 0").select(
        F.col("label").alias("changed"), F.col("node").alias("affected"), "depth"
    )


def unmasked_leaks(edges: DataFrame, tags: DataFrame, exposed: DataFrame) -> DataFrame:
    """Exposed nodes a tag reaches without a masking step on the way."""
    tagged = propagate_tags(edges, tags)
    inherited = tagged.join(tags, ["node", "tag"], "left_anti")
    return inherited.join(exposed.select("node"), "node", "left_semi")
