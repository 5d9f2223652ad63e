"""Row-level change on tables: update, delete, merge, snapshots and compaction.

A change log has one row per change with a key, an ordering number and an
operation (``I``, ``U`` or ``D``).  Folding the log is an aggregate, ``max_by``
over the ordering, so a key with many changes is reduced before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_log(log: DataFrame, keys: list[str], offset: str, value: str) -> DataFrame:
    """The last row of each key; a key whose last value is NULL is gone."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(offset)).alias("_last"))
    return last.select(*keys, "_last.*").filter(F.col(value).isNotNull())


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE: set ``values`` where ``condition`` is true; NULL counts as false."""
    return df.withColumns({
        name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()
    })


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE: rows where ``condition`` is true go; NULL counts as false."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def erase_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the erasure list."""
    return df.join(keys.select(key), key, "left_anti")


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Fail when a key occurs twice: a merge from it would depend on row order."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate source key {[twice[0][k] for k in keys]}")


def merge(target: DataFrame, source: DataFrame, keys: list[str],
          matched: list[tuple[Column | None, dict[str, Column] | None]],
          insert: dict[str, Column] | None = None,
          insert_when: Column | None = None) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys``.

    Columns are named ``t.x`` and ``s.x`` in the clauses.  ``matched`` lists
    (condition, new values) in order, values None meaning DELETE; the first true
    clause wins and a row no clause takes stays.  A source row without partner is
    inserted with ``insert`` unless ``insert_when`` says otherwise.
    """
    require_unique(source, keys)
    # The target stays on the left of a left join: a small source is broadcast and
    # the target not shuffled, a large one is split by AQE where a key is frequent.
    t = target.alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left")
    action = F.when(F.col("s._in_s").isNull(), "keep")
    for i, (condition, values) in enumerate(matched):
        test = condition if condition is not None else F.lit(True)
        action = action.when(test, "delete" if values is None else f"update{i}")
    both = both.withColumn("_action", action.otherwise("keep")).filter("_action <> 'delete'")
    out = []
    for name in target.columns:
        value = F.when(F.col("_action") == "keep", F.col(f"t.{name}"))
        for i, (_, values) in enumerate(matched):
            if values is not None:
                new = values.get(name, F.col(f"t.{name}"))
                value = value.when(F.col("_action") == f"update{i}", new)
        out.append(value.alias(name))
    kept = both.select(*out)
    if insert is None:
        return kept

    # Only target keys the source asks for are compared with it.
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    fresh = source.join(known, keys, "left_anti").alias("s")
    if insert_when is not None:
        fresh = fresh.filter(insert_when)
    types = {f.name: f.dataType for f in target.schema}
    added = fresh.select(*[
        insert.get(c, F.lit(None)).cast(types[c]).alias(c) for c in target.columns
    ])
    return kept.unionByName(added)


def committed(log: DataFrame, write_id: int | None, aborted: DataFrame | None) -> DataFrame:
    """Log rows a reader at ``write_id`` may see."""
    if write_id is not None:
        log = log.filter(F.col("write_id") <= write_id)
    if aborted is not None:
        log = log.join(aborted.select("write_id"), "write_id", "left_anti")
    return log


def last_change(log: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: its last change by write id."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("write_id")).alias("_last"))
    return last.select(*keys, "_last.*")


def snapshot(log: DataFrame, keys: list[str], write_id: int | None = None,
             aborted: DataFrame | None = None) -> DataFrame:
    """The table as of ``write_id``: base and deltas minus deletes."""
    return last_change(committed(log, write_id, aborted), keys).filter("op <> 'D'")


def minor_compaction(log: DataFrame, keys: list[str], lo: int, hi: int,
                     aborted: DataFrame | None = None) -> DataFrame:
    """The deltas ``lo..hi`` as one net delta; deletes stay in it."""
    return last_change(
        committed(log.filter(F.col("write_id") >= lo), hi, aborted), keys
    )


def change_feed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Difference of two snapshots as rows ``D`` (old) and ``I`` (new); a change is both.

    Equal rows cancel out in one aggregate, NULLs being equal to each other.
    """
    signed = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
    net = signed.groupBy(*old.columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    return net.select(
        *old.columns, F.when(F.col("_net") < 0, "D").otherwise("I").alias("op"),
        F.explode(F.sequence(F.lit(1), F.abs("_net"))).alias("_copy"),
    ).drop("_copy")
