"""Plans and file layout: what the optimizer is left to do must show."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from millrace import controls, session
from millrace.functions import udfs
from millrace.operators import arranging, changes, grouping, joins, stored
from millrace.plans import registry
from millrace.sources import files, jdbc, sinks
from millrace.tables import load, path_of

registry.load_all()


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = controls.plan_text(registry.QUERIES["scan_parquet"](spark, sf))
    assert "GreaterThanOrEqual(l_shipdate" in plan
    schema = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    assert schema.count(":") == 4  # ReadSchema itself and three columns
    assert "HashAggregate" in plan and plan.count("partial_count") >= 1


def test_join_strategies(spark, sf):
    items = load(spark, sf, "lineitem", "l_partkey", "l_quantity")
    part = load(spark, sf, "part", "p_partkey", "p_brand")
    on = F.expr("l_partkey = p_partkey")
    assert "SortMergeJoin" in controls.plan_text(joins.sort_merge_join(items, part, on))
    assert "ShuffledHashJoin" in controls.plan_text(joins.shuffle_hash_join(items, part, on))
    assert "BroadcastHashJoin" in controls.plan_text(joins.broadcast_join(items, part, on))
    beyond = controls.plan_text(joins.broadcast_join(items, part, on, rows=10))
    assert "BroadcastHashJoin" not in beyond and "SortMergeJoin" in beyond


def test_bucketed_pair_joins_without_exchange(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_quantity")
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderstatus").withColumnRenamed("o_orderkey", "l_orderkey")
    left, right = joins.bucketed_pair(items, orders, "l_orderkey")
    plan = controls.plan_text(joins.bucketed_join(spark, left, right, "l_orderkey"))
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_no_query_uses_row_python_nested_loops_or_one_task_windows(spark, sf):
    python = {"udf_scalar", "udaf_geomean", "udtf_tokens", "mapreduce_counts", "join_theta_like"}
    for name in ("order_transitions", "dense_row_ids", "sessionize", "policy_decisions", "merge_upsert",
                 "latency_percentiles", "wordcount_alnum", "startree_cube", "interval_join", *python):
        plan = controls.plan_text(registry.QUERIES[name](spark, sf))
        assert "BatchEvalPython" not in plan, name
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name
        if name not in python:
            assert "EvalPython" not in plan and "InPandas" not in plan, name


def test_json_and_log_lines_are_parsed_once(spark, sf):
    def optimised(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    plan = optimised(registry.QUERIES["schema_conformance"](spark, sf).filter("violations = ''"))
    assert plan.count("parse_json") + plan.count("parseJson") + plan.count("from_json") == 1, plan
    plan = optimised(registry.QUERIES["weblog_rejects"](spark, sf))
    assert plan.count("regexp_replace") == 1


def test_like_join_moves_no_text(spark, sf):
    plan = controls.plan_text(registry.QUERIES["join_theta_like"](spark, sf))
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and not any("p_name" in line or "_text" in line for line in moved)


def test_table_function_gets_whole_batches(spark):
    texts = [" a  b ", "", None, "   ", "c", "x\ty\nz"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING").coalesce(1)
    out = udfs.tokens(df, "id", "text")
    assert "ArrowEvalPythonUDTF" in controls.plan_text(out)
    want = [(i, pos, w) for i, t in enumerate(texts) for pos, w in enumerate((t or "").split())]
    assert sorted(map(tuple, out.collect())) == want
    assert udfs.tokens(df.limit(0), "id", "text").count() == 0


def test_scalar_udf_is_arrow(spark):
    plan = controls.plan_text(spark.range(3).select(udfs.log1p(F.col("id").cast("double"))))
    assert "ArrowEvalPython" in plan


def test_dynamic_filter_reads_only_keys_of_the_dimension(spark, sf):
    plan = controls.plan_text(registry.QUERIES["join_dynamic_filter"](spark, sf))
    assert "LeftSemi" in plan and "EqualTo(o_orderpriority,1-URGENT)" in plan


def test_partition_filter_prunes_directories(spark, sf):
    plan = controls.plan_text(registry.QUERIES["partition_pruned_filter"](spark, sf))
    line = [x for x in plan.splitlines() if "PartitionFilters" in x][0]
    assert "year" in line


def test_cube_is_built_on_grouped_rows(spark, sf):
    df = load(spark, sf, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice")
    plan = controls.plan_text(grouping.build_cube(df, ["o_orderstatus", "o_orderpriority"], ["o_totalprice"]), "simple")
    assert plan.index("Expand") < plan.rindex("HashAggregate")  # the tree is printed from the top


def test_adaptive_plan_and_partition_count(spark):
    df = spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count()
    assert "AdaptiveSparkPlan isFinalPlan=true" in controls.executed_plan(df)
    with session.settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="3"):
        assert spark.range(1000).groupBy(F.col("id") % 7).count().rdd.getNumPartitions() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_repartition_and_coalesce(spark):
    df = spark.range(0, 1000, 1, 20)
    assert "Exchange" not in controls.plan_text(arranging.fewer_partitions(df, 4))
    assert arranging.fewer_partitions(df, 4).rdd.getNumPartitions() == 4
    assert "Exchange" in controls.plan_text(arranging.distribute_by(df, 4, "id"))
    parts = arranging.cluster_by(df, 4, "id").select(F.spark_partition_id().alias("p"), "id").collect()
    seen = {}
    for p, i in parts:
        assert seen.get(p, -1) < i
        seen[p] = i


def test_cache_checkpoint_and_statistics(spark, tmp_path):
    df = controls.keep(spark.range(100), "memory")
    assert df.count() == 100 and "InMemoryTableScan" in controls.plan_text(df)
    df.unpersist()
    assert "Range" not in controls.plan_text(controls.cut_lineage(spark.range(10).filter("id > 3")))
    name = session.scratch_name("stats")
    sinks.create_table_as(spark.range(50), name, str(tmp_path / "t"))
    controls.analyze(spark, name, ["id"])
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name} id").collect()}
    assert rows["distinct_count"] in ("50", "49", "51", "52", "48") and rows["max"] == "49"


def test_managed_data_goes_and_external_stays(spark, tmp_path):
    managed, external = session.scratch_name("m"), session.scratch_name("e")
    sinks.create_table_as(spark.range(3), managed)
    path = str(tmp_path / "ext")
    sinks.create_table_as(spark.range(3), external, path)
    location = spark.sql(f"DESCRIBE EXTENDED {managed}").filter("col_name = 'Location'").first()[1].replace("file:", "")
    assert glob.glob(location + "/*.parquet")
    spark.sql(f"TRUNCATE TABLE {managed}")
    assert spark.table(managed).count() == 0
    for name in (managed, external):
        spark.sql(f"DROP TABLE {name}")
    assert not os.path.exists(location) and spark.read.parquet(path).count() == 3


def test_partitions_are_listed(spark, tmp_path):
    path, name = str(tmp_path / "p"), session.scratch_name("p")
    sinks.parquet(spark.range(4).withColumn("d", F.col("id") % 2), path, ["d"])
    files.register_partitions(spark, name, "id BIGINT, d BIGINT", "d", path)
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()) == ["d=0", "d=1"]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["d"]
    os.makedirs(f"{path}/d=5")
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (d = 5)")
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_compaction_keeps_rows_and_lowers_the_file_count(spark, tmp_path):
    src = str(tmp_path / "many")
    rows = spark.range(2000).withColumn("month", F.lpad((F.col("id") % 3).cast("string"), 2, "0"))
    rows.filter("month < '02'").repartition(40).write.partitionBy("month").parquet(src)
    rows.filter("month = '02'").coalesce(1).write.mode("append").partitionBy("month").parquet(src)
    alone = glob.glob(src + "/month=02/*.parquet")
    assert len(sinks.compact(spark, src)) == 2
    assert len(glob.glob(src + "/month=0[01]/*.parquet")) == 2 and glob.glob(src + "/month=02/*.parquet") == alone
    assert sorted(os.listdir(src))[-3:] == ["month=00", "month=01", "month=02"]
    assert sinks.read_hourly(spark, src).select("id", "month").exceptAll(rows).count() == 0
    assert sinks.compact(spark, src) == []


def test_one_big_directory_does_not_hide_many_small_ones(spark, tmp_path):
    src = str(tmp_path / "mixed")
    spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(0).alias("d")) \
        .coalesce(1).write.partitionBy("d").parquet(src)
    spark.range(400).select(F.lit("x").alias("v"), (F.col("id") % 4 + 1).alias("d")).repartition(20).write.mode("append").partitionBy("d").parquet(src)
    assert len(sinks.compact(spark, src, small=100_000)) == 4
    assert spark.read.parquet(src).count() == 200_400


def test_changes_of_a_stored_table_leave_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("p"), F.lit(0).alias("v")).write.partitionBy("p").parquet(path)

    def names(p):
        return sorted(glob.glob(f"{path}/p={p}/*.parquet"))
    before = {p: names(p) for p in range(3)}
    assert stored.update(spark, path, ["p"], F.expr("id = 4"), {"v": F.lit(1)}) == 1
    assert names(0) == before[0] and names(2) == before[2] and names(1) != before[1]
    assert spark.read.parquet(path).agg(F.sum("v"), F.count("*")).first()[:] == (1, 90)
    assert stored.delete(spark, path, ["p"], F.expr("p = 2")) == 1
    assert not names(2) and names(0) == before[0] and spark.read.parquet(path).count() == 60
    source = spark.createDataFrame([(4, 7), (1000, 8)], "id BIGINT, v INT")
    clause = [(None, {"v": F.col("s.v")})]
    new = {"id": F.col("s.id"), "v": F.col("s.v"), "p": F.lit(9)}
    assert stored.merge(spark, path, ["p"], source, ["id"], clause, new) == 2
    got = {(r["id"], r["p"], r["v"]) for r in spark.read.parquet(path).filter("v > 0").collect()}
    assert got == {(4, 1, 7), (1000, 9, 8)} and names(0) == before[0]
    with pytest.raises(ValueError):
        stored.update(spark, path, ["p"], F.lit(True), {"p": F.lit(1)})


def test_gzip_text_parts(spark, tmp_path):
    path = str(tmp_path / "gz")
    lines = spark.createDataFrame([("a\t1", 0), ("z\t2", 1)], "value STRING, part INT")
    sinks.gzip_text(lines, path, "part")
    assert sorted(os.listdir(path))[-2:] == ["part=0", "part=1"] and glob.glob(path + "/part=0/*.txt.gz")


def test_rerun_of_a_date_does_not_duplicate(spark, tmp_path):
    path = str(tmp_path / "dt")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, dt STRING")
    for _ in range(2):
        sinks.replace_partitions(df.filter("dt = 'a'"), path, ["dt"])
        sinks.replace_partitions(df.filter("dt = 'b'"), path, ["dt"])
    assert spark.read.parquet(path).count() == 2


def test_jdbc_options():
    opts = jdbc.scan_options("jdbc:mysql://db/x", "users", "id", 0, 1000, 16)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "16" and opts["upperBound"] == "1000"
    with pytest.raises(ValueError):
        jdbc.scan_options("u", "t", "id", 5, 1, 4)


def test_any_file_uri_is_a_path(spark, sf):
    assert files.parquet(spark, "file://" + path_of(sf, "nation")).count() == 25


def test_small_source_merge_does_not_shuffle_the_target(spark, sf):
    target = load(spark, sf, "customer", "c_custkey", "c_acctbal")
    stage = target.limit(5)
    out = changes.merge(target, stage, ["c_custkey"], [(None, {"c_acctbal": F.lit(0.0)})], None)
    assert "BroadcastHashJoin" in controls.plan_text(out) or "BroadcastHashJoin" in controls.executed_plan(out)


def test_every_query_key_is_described(spark):
    assert len(registry.QUERIES) >= 120
    assert all(fn.__module__.startswith("millrace.plans.") for fn in registry.QUERIES.values())


def test_stored_partitions_keep_their_names(spark, tmp_path):
    path = str(tmp_path / "t")
    regions = ["North America", "50% off", "a+b", "plain", None]
    rows = [(i, regions[i % 5], f"{i % 3 + 1:02d}", 0) for i in range(30)]
    spark.createDataFrame(rows, "id INT, region STRING, month STRING, v INT").write.partitionBy("region", "month").parquet(path)

    def table():
        got = spark.read.option("basePath", path).parquet(path)
        return sorted((r["id"], r["v"]) for r in got.collect()), sorted(glob.glob(f"{path}/*/*"))
    before = table()
    assert len(before[0]) == 30 and any("month=01" in p for p in before[1])
    by = ["region", "month"]
    assert stored.update(spark, path, by, F.expr("month = '01'"), {"v": F.lit(1)}) == 5
    after = table()
    assert after[1] == before[1] and [i for i, _ in after[0]] == list(range(30)) and sum(v for _, v in after[0]) == 10
    for n, region in enumerate(regions):
        gone = F.col("region").eqNullSafe(F.lit(region))
        assert stored.delete(spark, path, by, gone) == 3
        left = [(i, int(i % 3 == 0)) for i in range(30) if i % 5 > n]
        if left:
            assert table()[0] == left
    assert glob.glob(f"{path}/*/*") == []


def test_small_files_are_written_by_all_tasks(spark):
    from collections import Counter

    def written(df):
        got = files.multi_file(spark, sinks.many_small_files(df, 7, "small")).select("id", "file").collect()
        return sorted(r["id"] for r in got), Counter(r["file"].rsplit("/", 1)[1] for r in got)
    ids, per_file = written(spark.range(400).coalesce(1))
    assert ids == list(range(400)) and max(per_file.values()) <= 7
    assert len({f.split("-")[1] for f in per_file}) > 1
    # A table that fits one file stays one file, an empty one stays empty.
    assert [len(written(spark.range(n).coalesce(1))[1]) for n in (5, 0)] == [1, 0]


def test_small_files_start_no_process_a_file(spark):
    import datetime as dt
    import os

    from pyspark.sql import functions as F

    from millrace.sources import sinks

    rows = spark.createDataFrame(
        [(i, None if i % 3 else f"é{i}", i / 4, i % 2 == 0, dt.datetime(2026, 1, 1, 5, 6, 7, i), dt.date(1500, 3, 1),
          bytes([i % 256])) for i in range(100)] + [(None,) * 7] * 2,
        "id bigint, s string, d double, b boolean, t timestamp_ntz, day date, x binary",
    ).withColumns({"n": F.col("id").cast("decimal(20,3)"), "at": F.col("t").cast("timestamp"), "k": F.col("id").cast("tinyint")})
    path = sinks.many_small_files(rows, 12, "small")
    folder = path.removeprefix("file:")
    names = sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))
    # Spark's own writer leaves a checksum file beside each, and has changed the mode of both.
    assert len(names) >= 9 and not [n for n in os.listdir(folder) if n.endswith(".crc") or n == "_attempts"]
    back = spark.read.parquet(path)
    assert back.schema == rows.schema
    key = lambda r: (r["id"] is None, r["id"])
    assert sorted(back.collect(), key=key) == sorted(rows.collect(), key=key)
    per_file = back.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) == len(names) and max(r["count"] for r in per_file) <= 12
    # Nested columns take Spark's writer.
    nested = spark.range(30).select(F.array("id").alias("a"))
    assert sorted(r["a"][0] for r in spark.read.parquet(sinks.many_small_files(nested, 7, "nested")).collect()) == [*range(30)]


def test_many_small_files_are_read_as_by_spark(spark, tmp_path, monkeypatch):
    import datetime as dt

    from pyspark.sql import functions as F

    from millrace.sources import files

    path = str(tmp_path / "with space")

    def both():
        taken = []
        read = files._read_arrow
        with monkeypatch.context() as m:
            m.setattr(files, "_read_arrow", lambda *a: taken.append(1) or read(*a))
            plain = files.multi_file(spark, path)
            m.setattr(files, "MANY", 2)
            arrow = files.multi_file(spark, path)
        assert arrow.schema == plain.schema
        assert sorted(map(repr, arrow.collect())) == sorted(map(repr, plain.collect()))
        assert plain.count() and arrow.select("file").distinct().count() == len({r["file"] for r in plain.collect()})
        return len(taken)

    first = spark.createDataFrame(
        [(i, None if i % 3 else f"é{i}", i / 4, i % 2 == 0, dt.datetime(1400, 1, 1, 5, 6, 7, i), bytes([i])) for i in range(50)],
        "Id bigint, s string, d double, b boolean, t timestamp_ntz, x binary",
    ).withColumns({"n": F.col("Id").cast("decimal(20,3)"), "k": F.col("Id").cast("tinyint")})
    first.repartition(5).write.parquet(f"{path}/a")
    # Fewer columns, other order, another column, another case; one file without rows.
    first.selectExpr("s", "Id + 100 AS id", "1.5F AS more").repartition(3).write.parquet(f"{path}/b/c")
    first.selectExpr("s").filter("false").coalesce(1).write.parquet(f"{path}/d")
    assert both() == 1
    # Files above the bound come from Spark, once.
    sizes = sorted(f.stat().st_size for f in (tmp_path / "with space").rglob("*.parquet"))
    assert sizes[0] < sizes[-1]
    monkeypatch.setattr(files, "SMALL", sizes[-1])
    assert both() == 1
    monkeypatch.setattr(files, "SMALL", sizes[0])
    assert both() == 1
    monkeypatch.undo()
    # Dates, instants and nested columns are Spark's, whole.
    first.selectExpr("DATE'1500-01-01' AS day", "array(Id) AS a").write.parquet(f"{path}/e")
    assert both() == 0


def test_very_many_files_are_read_in_rounds(spark, monkeypatch):
    from millrace.sources import files, sinks

    path = sinks.many_small_files(spark.range(100).selectExpr("id", "id AS Other"), 3, "small", folder_files=10)
    spark.range(100, 107).selectExpr("id", "'x' AS later").write.parquet(f"{path}/000009")
    spark.range(5).write.parquet(f"{path}/_hidden")
    # Sorted first, and a round of its own: data that does not count.
    spark.range(60).repartition(30).write.parquet(f"{path}/0/_hidden")
    whole = files.multi_file(spark, path)
    lists = []
    one = files._with_file
    monkeypatch.setattr(files, "ROUND", 25)
    monkeypatch.setattr(files, "_with_file", lambda spark, paths: lists.append(paths) or one(spark, paths))
    for many in (1000, 2):
        lists.clear()
        monkeypatch.setattr(files, "MANY", many)
        parts = files.multi_file(spark, path)
        assert len(lists) > 1 and parts.columns == whole.columns == ["id", "Other", "later", "file"]
        assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect())) and parts.count() == 107
