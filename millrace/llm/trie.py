"""The prefix trie of all conversations by truncation peeling.

Every conversation is a path of turns.  Peeling starts at the deepest turns: the
conversations that end there are merged with the nodes that survive from below, each
group of equal prefixes is a node and is complete at that moment, its last turn is
stripped, and what is left joins the next round.  Counts, leaves and savings are summed
on the way up, so a node is discovered and finished in the same step.

Three things keep a round small whatever the data look like.  Equal conversations are
merged before any path is looked at.  Below the shallowest depth at which no prefix has
more than ``MOST`` different continuations, whole subtrees are peeled inside one task;
only the few depths above it take a shuffle each, with partial sums before the shuffle.
And paths are handled in blocks of ``BLOCK`` turns, the deepest block first, so no row
holds a conversation of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, lookup, whole, write_through
from millrace.operators.ordered import ordered, with_row_number, with_running_sum

BLOCK, MOST = 512, 1024
TWO_64 = Decimal(1 << 64)
PIECE = 1 << 16  # ids of one node that travel together
STEP = "array<struct<depth:bigint,node:binary,up:binary,words:bigint>>"
PEELED = f"done boolean, depth long, node binary, up binary, conv_id long, n long, children long, leaves long, saved long, path {STEP}"


def _node(depth: Column, digest: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), digest.cast("string"))))


def _unsigned(hashed: Column) -> Column:
    wide = hashed.cast("decimal(20,0)")
    return F.when(hashed < 0, wide + F.lit(TWO_64)).otherwise(wide)


def rebuild(turns: DataFrame, group: int = 20, most_head: int = 4) -> DataFrame:
    """``conv_id, depth, k1, k2, words, last`` of all rebuilt conversations, from the numbered ``turns``.

    Conversation c begins with the first h turns of conversation c - c % group, and goes
    on with its own turns after its first h; h is crc32(c) % most_head.  A conversation
    without turns left is one row with depth 0.
    """
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most_head) \
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    heads = convs.filter("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = lookup(convs, heads, "base").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0)))) \
        .withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    first = turns.filter(f"place < {most_head} AND conv_id % {group} = 0").withColumnRenamed("conv_id", "base")
    lent = convs.select("conv_id", "base", "h", "length").join(first, "base").filter("place <= h") \
        .select("conv_id", F.col("place").alias("depth"), "k1", "k2", "words", "length")
    own = turns.join(convs.select("conv_id", "h", "head", "length"), "conv_id").filter("place > h") \
        .select("conv_id", (F.col("head") + F.col("place") - F.col("h")).alias("depth"), "k1", "k2", "words", "length")
    bare = convs.filter("length = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
        F.lit(0).cast("long").alias("words"), "length")
    rows = lent.unionByName(own).unionByName(bare)
    return rows.withColumn("last", F.col("depth") == F.col("length")).drop("length")


def paths(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id, depth, node, up, words, last``: one row per rebuilt turn.

    ``node`` names the sequence of the first ``depth`` turns (the sum of the turns' hashes,
    each salted with its depth), ``up`` the sequence without the last one.
    """
    role, text = whole(role_col), whole(text_col)
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("k1"), F.xxhash64(F.lit("text"), text, role).alias("k2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = write_through(rows, "trie-rows")
    turns = with_row_number(ordered(rows, ["conv_id"], ["turn", "role", "k1", "k2"]), "place").rows()
    turns = write_through(turns.select("conv_id", "place", "k1", "k2", "words"), "trie-turns")
    rebuilt = write_through(rebuild(turns), "trie-rebuilt")
    high = F.pmod(F.xxhash64("depth", "k1", "k2"), F.lit(1 << 32)).cast("decimal(10,0)")
    own = high * F.lit(TWO_64) + _unsigned(F.xxhash64("k2", "depth", "k1"))
    own = F.when(F.col("depth") > 0, own.cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)"))
    summed = with_running_sum(ordered(rebuilt, ["conv_id"], ["depth"]), "digest", own).rows()
    node = _node(F.col("depth"), F.col("digest").cast("decimal(38,0)"))
    up = F.when(F.col("depth") > 0, _node(F.col("depth") - 1, (F.col("digest") - own).cast("decimal(38,0)")))
    return write_through(summed.select("conv_id", "depth", node.alias("node"), up.alias("up"), "words", "last"), "trie-paths")


def _peel_in_task(base: int, low: int):
    """Peel whole subtrees below depth ``low``: finished nodes, and what is left at ``low - 1``."""

    def work(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks().to_batches()[0]
        path = rows.column("path")
        flat = path.flatten()
        node, up, words = (flat.field(i).to_pylist() for i in (1, 2, 3))
        ends = [e - path.offsets[0].as_py() for e in path.offsets.to_pylist()[1:]]
        sizes = path.value_lengths().to_pylist()
        levels: dict[int, dict[bytes, list[int]]] = {}

        def add(depth, at, conv, n, children, leaves, saved):
            here = levels.setdefault(depth, {})
            old = here.get(node[at])
            if old is None:
                here[node[at]] = [at, conv, n, children, leaves, saved]
            else:
                old[1] = min(old[1], conv)
                for i, more in enumerate((n, children, leaves, saved), 2):
                    old[i] += more

        columns = [rows.column(c).to_pylist() for c in ("conv_id", "n", "children", "leaves", "saved")]
        for end, size, *values in zip(ends, sizes, *columns):
            add(base + size, end - 1, *values)
        out: list[tuple] = []
        for depth in range(max(levels), low - 1, -1):
            for at, conv, n, children, leaves, saved in levels.pop(depth, {}).values():
                leaves, saved = leaves if children else 1, saved + (n - 1) * words[at]
                out.append((True, depth, node[at], up[at], conv, n, children, leaves, saved, None))
                if depth > low:
                    add(depth - 1, at - 1, conv, n, 1, leaves, saved)
                else:
                    kept = [{"depth": base + 1 + i, "node": node[j], "up": up[j], "words": words[j]}
                            for i, j in enumerate(range(at - (low - 1 - base), at))]
                    out.append((False, depth - 1, up[at], None, conv, n, 1, leaves, saved, kept))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA)

    return work


_STEP = pa.list_(pa.struct([("depth", pa.int64()), ("node", pa.binary()), ("up", pa.binary()), ("words", pa.int64())]))
SCHEMA = pa.schema([("done", pa.bool_()), ("depth", pa.int64()), ("node", pa.binary()), ("up", pa.binary()), ("conv_id", pa.int64()),
                    ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("path", _STEP)])
VALUES = ["conv_id", "n", "children", "leaves", "saved"]


def _merged() -> list[Column]:
    return [F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in VALUES[1:]]]


def _peel_block(steps: DataFrame, attached: DataFrame, base: int, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of the depths above ``base`` up to those of ``attached``, and what is left at ``base``.

    ``steps`` are the path rows of these depths, ``attached`` has ``depth`` and ``VALUES``: what
    ends or survives there, named by one conversation that passes through.
    """
    attached = write_through(attached, "trie-attached")
    inside = steps.join(attached.select("conv_id", F.col("depth").alias("upto")), "conv_id").filter("depth <= upto")
    inside = write_through(inside.select("conv_id", "depth", "node", "up", "words"), "trie-steps")
    low = base
    while True:  # ends at the block's last depth, where a node has at most two rows
        low += 1
        widest, rows = inside.filter(F.col("depth") == low).groupBy("node").agg(F.count("*").alias("rows")) \
            .agg(F.max("rows"), F.sum("rows")).first()
        if widest is None or widest <= max(most, 2):
            break
    step = F.struct("depth", "node", "up", "words")
    path = inside.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("path"))
    placed = attached.join(path, "conv_id")
    depth = F.lit(base) + F.size("path")
    top = F.get("path", F.lit(low - 1 - base))["node"]
    buckets = max(1, -(-(rows or 0) // max(most // 2, 1)))
    whole_trees = placed.filter(depth >= low).select(F.pmod(F.xxhash64(top), F.lit(buckets)).alias("bucket"), *VALUES, "path")
    peeled = write_through(whole_trees.groupBy("bucket").applyInArrow(_peel_in_task(base, low), PEELED), "trie-peeled")
    nodes, left = [peeled.filter("done")], peeled.filter("NOT done")
    for at in range(low - 1, base, -1):
        here = left.select(*VALUES, "path").unionByName(placed.filter(depth == at).select(*VALUES, "path"))
        own = F.element_at("path", -1)
        here = here.select("*", own["node"].alias("node"), own["up"].alias("up"), own["words"].alias("words"))
        met = here.groupBy("node", "up", "words").agg(*_merged(), F.min_by("path", "conv_id").alias("path"))
        met = met.withColumn("leaves", F.when(F.col("children") > 0, F.col("leaves")).otherwise(1)) \
            .withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("words")).withColumn("depth", F.lit(at).cast("long"))
        met = write_through(met, "trie-met")
        nodes.append(met)
        left = met.select("conv_id", "n", F.lit(1).cast("long").alias("children"), "leaves", "saved", F.col("up").alias("node"),
                          F.slice("path", 1, F.size("path") - 1).alias("path"))
    return nodes, left.select("node", *VALUES)


def _digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256``: SHA-256 over the ascending ids of each node, joined by commas.

    The ids are sorted by range over all tasks and packed there, so what one node's task
    reads is a stream of pieces and never a list of its own; it holds one piece at a time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece():
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                names=["node", "first", "ids"])

        for batch in batches:
            for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (own != node or len(ids) >= PIECE):
                    yield piece()
                    ids = []
                node = own
                ids.append(conv)
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])],
                                              names=["node", "ends_sha256"])

        for batch in batches:
            for own, ids in zip(batch.column(0), batch.column(2)):
                own, ids = own.as_py(), ids.as_py()
                if running is not None and own == node:
                    running.update(b"," + ids.encode())
                    continue
                if running is not None:
                    yield row()
                node, running = own, hashlib.sha256(ids.encode())
        if running is not None:
            yield row()

    pieces = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id") \
        .mapInArrow(pack, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def nodes(conversations: DataFrame, block: int = BLOCK, most: int = MOST, **columns: str) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, node``.

    Turns are ordered by turn (null first), equal turns by role, then by the hash of role
    and text; a null role or text counts as empty.  Rows without a conversation id belong
    to no conversation.  Repeated rows are turns of their own.  Without any conversation
    there is no node.  Further columns are not read.  Nodes are told apart by 96-bit sums
    of hashes.
    """
    steps = paths(conversations, **columns)
    at_end = steps.filter("last")
    ended = write_through(at_end.groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")), "trie-ended")
    deepest = ended.agg(F.max("depth")).first()[0]
    zero = F.lit(0).cast("long")
    ended_rows = ended.select("node", "depth", "conv_id", "n", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
    found: list[DataFrame] = []
    left = None
    for base in range(max((deepest or 0) - 1, 0) // block * block, -1, -block):
        attached = ended_rows.filter((F.col("depth") > base) & (F.col("depth") <= base + block)).select("depth", *VALUES)
        if left is not None:
            joined = left.groupBy("node").agg(*_merged()).withColumn("depth", F.lit(base + block).cast("long"))
            attached = attached.unionByName(joined.select("depth", *VALUES))
        own = steps.filter((F.col("depth") > base) & (F.col("depth") <= base + block))
        more, left = _peel_block(own, attached, base, most)
        found += more
    bare = ended_rows.filter("depth = 0").select("node", *VALUES)
    root = bare.unionByName(left).groupBy("node").agg(*_merged()).select(
        zero.alias("depth"), "node", F.lit(None).cast("binary").alias("up"), *VALUES[:3],
        F.when(F.col("children") > 0, F.col("leaves")).otherwise(1).alias("leaves"), "saved")
    root = write_through(root, "trie-root")
    first = root.select(F.min("conv_id")).first()[0]
    everything = reduce(DataFrame.unionByName, [f.select("depth", "node", "up", *VALUES) for f in found])
    # The root is everybody's ancestor but the parent of depth 1 only, which needs no join.
    shallow = everything.filter("depth = 1").withColumn("parent_conv_id", F.lit(first).cast("long"))
    parents = everything.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    deeper = everything.filter("depth > 1").join(parents, "up", "left").select(*shallow.columns)
    out = root.withColumn("parent_conv_id", F.lit(None).cast("long")).unionByName(shallow).unionByName(deeper)
    several = at_end.join(ended.filter("n > 1").select("node"), "node", "left_semi")
    alone = ended.filter("n = 1").select("node", F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    out = out.join(alone.unionByName(_digests(several)), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "node")
