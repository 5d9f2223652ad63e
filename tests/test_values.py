"""Small inputs with results worked out by hand."""

import datetime as dt

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import scalars, udfs
from millrace.operators import changes, evolution, grouping, joins, metrics, policies, quality, series, text
from millrace.operators import lineage, offsets
from millrace.operators.evolution import Field
from millrace.plans import registry
from millrace.sources import synth, topics
from millrace.streaming import windows


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def t(text):
    return dt.datetime.fromisoformat(text)


def test_benchmark_logs_cover_the_product(spark):
    logs = synth.benchmark_logs(spark.range(10_000), "id")
    got = rows(logs.groupBy("log_level").agg(
        F.count("*").alias("n"), F.round(F.avg("response_time"), 4).alias("a"), F.round(F.sum("response_time"), 1).alias("s")
    ), "log_level", "n", "a", "s")
    assert got == [("ERROR", 3000, 39.38, 118140.0), ("INFO", 4000, 37.8425, 151370.0), ("WARN", 3000, 25.43, 76290.0)]
    assert logs.select("log_id").distinct().count() == 1000


def test_skewed_join_size(spark):
    tx = synth.skewed_transactions(spark.range(1_000_000), "id")
    lookup = spark.range(1000).select(
        F.when(F.col("id") == 0, "KEY_SKEW").otherwise(F.col("id").cast("string")).alias("join_key")
    )
    assert joins.salted_join(tx, lookup, "join_key", 20).count() == 950_050


def test_fanout_of_hundred_keys(spark):
    side = spark.range(50_000).select((F.col("id") % 100).alias("key"))
    out = joins.fanout_count(side, side, "key")
    assert out.agg(F.sum("n_pairs"), F.count("*")).first()[:] == (25_000_000, 100)


def test_word_rules_differ_on_digits_and_marks(spark):
    df = spark.createDataFrame([("Spark3 2024 don't\n Café  spark3",)], "t STRING")
    assert rows(text.count_alnum(df, "t"), "word", "n") == [("2024", 1), ("caf", 1), ("dont", 1), ("spark3", 2)]
    assert rows(text.count_alpha(df, "t"), "word", "n") == [("caf", 1), ("dont", 1), ("spark", 2)]
    assert ("", 2) in rows(text.count_spaced(df, "t"), "word", "n")


def test_alphabet_partition(spark):
    df = spark.createDataFrame([("apple",), ("map",), ("nut",), ("9x",), ("",), ("éa",)], "w STRING")
    got = dict(rows(df.withColumn("p", scalars.alphabet_part(F.col("w"), 4)), "w", "p"))
    assert got == {"apple": 0, "map": 0, "nut": 1, "9x": 3, "": 0, "éa": 1}
    assert {p for _, p in rows(df.withColumn("p", scalars.alphabet_part(F.col("w"), 1)), "w", "p")} == {0}


def test_merge_clauses(spark):
    target = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, "c", None)], "id INT, name STRING, pay DOUBLE")
    stage = spark.createDataFrame(
        [(1, "a2", 15.0, "UPDATE"), (2, "b2", 0.0, "DELETE"), (3, "c2", 1.0, None), (4, "d", 40.0, "INSERT"), (5, "e", 50.0, "DELETE")],
        "id INT, name STRING, pay DOUBLE, action STRING",
    )

    def run(t_, **kw):
        return changes.merge(
            t_, stage, ["id"],
            matched=[(F.col("s.action") == "DELETE", None), (F.col("s.action") == "UPDATE", {"pay": F.col("s.pay")})],
            insert={c: F.col(f"s.{c}") for c in ("id", "name", "pay")}, **kw,
        )

    # A NULL condition is false; an unmatched DELETE row is inserted by default.
    assert rows(run(target).na.fill(-1.0), "id", "name", "pay") == [
        (1, "a", 15.0), (3, "c", -1.0), (4, "d", 40.0), (5, "e", 50.0)]
    only = run(target, insert_when=F.col("s.action") == "INSERT")
    assert [r[0] for r in rows(only, "id")] == [1, 3, 4]
    with pytest.raises(ValueError, match="duplicate"):
        changes.merge(target, stage.union(stage), ["id"], [], None)


def test_merge_with_frequent_target_key(spark):
    target = spark.range(300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("id"), F.lit(1).alias("v"))
    stage = spark.createDataFrame([(7, 2), (1000, 3)], "id BIGINT, v INT")
    out = changes.merge(target, stage, ["id"], [(None, {"v": F.col("s.v")})], {"id": F.col("s.id"), "v": F.col("s.v")})
    assert rows(out.groupBy("v").count(), "v", "count") == [(1, 200), (2, 100), (3, 1)]


def test_snapshot_skips_aborted_and_minor_keeps_deletes(spark):
    log = spark.createDataFrame(
        [(1, 1, "I", "a"), (2, 1, "I", "b"), (1, 2, "U", "a2"), (2, 3, "U", "b3"), (1, 4, "D", None)],
        "id INT, write_id INT, op STRING, v STRING",
    )
    aborted = spark.createDataFrame([(3,)], "write_id INT")
    assert rows(changes.snapshot(log, ["id"], 2, aborted), "id", "v") == [(1, "a2"), (2, "b")]
    assert rows(changes.snapshot(log, ["id"], None, aborted), "id", "v") == [(2, "b")]
    assert rows(changes.minor_compaction(log, ["id"], 2, 4, aborted), "id", "op") == [(1, "D")]
    # Folding the net delta over the base gives what folding the whole log gives.
    net = changes.minor_compaction(log, ["id"], 2, 4, aborted)
    folded = changes.snapshot(log.filter("write_id = 1").unionByName(net), ["id"])
    assert rows(folded, "id", "v") == rows(changes.snapshot(log, ["id"], None, aborted), "id", "v")


def test_change_feed_counts_copies_and_nulls(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (3, "y")], "id INT, v STRING")
    new = spark.createDataFrame([(1, None), (2, "x"), (3, "z"), (4, None)], "id INT, v STRING")
    got = sorted(map(str, rows(changes.change_feed(old, new), "id", "op", F.coalesce("v", F.lit("-")))))
    assert got == ["(2, 'D', 'x')", "(3, 'D', 'y')", "(3, 'I', 'z')", "(4, 'I', '-')"]


def test_log_compaction_drops_tombstones(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, None), ("b", 3, "y")], "k STRING, o INT, v STRING")
    assert rows(changes.compact_log(log, ["k"], "o", "v"), "k", "o", "v") == [("b", 3, "y")]


def test_delete_and_update_treat_null_as_false(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id INT, v INT")
    assert rows(changes.delete_where(df, F.col("v") > 6), "id") == [(1,), (2,)]
    assert rows(changes.update_where(df, F.col("v") > 6, {"v": F.lit(0)}).na.fill(-1), "id", "v") == [(1, -1), (2, 5), (3, 0)]


V1 = [("id", "string"), ("name", "string"), ("email", "string"), ("timestamp", "long")]


def fields(spark, *versions):
    out = []
    for number, spec in enumerate(versions, 1):
        out += [("user", number, f[0], f[1], len(f) > 2) for f in spec]
    return spark.createDataFrame(out, "subject STRING, version INT, field STRING, type STRING, has_default BOOLEAN")


def verdicts(df):
    return {(r["old"], r["mode"]): (r["ok"], r["reasons"]) for r in df.collect()}


def test_compatible_pair(spark):
    got = verdicts(evolution.compatibility(fields(spark, V1, [*V1, ("phoneNumber", "string", 1), ("status", "string", 1)])))
    assert {m: got[1, m][0] for m in evolution.MODES} == {"BACKWARD": True, "FORWARD": True, "FULL": True, "NONE": True}


def test_incompatible_pair(spark):
    new = [f for f in V1 if f[0] != "email"] + [("age", "int")]
    got = verdicts(evolution.compatibility(fields(spark, V1, new)))
    assert got[1, "BACKWARD"] == (False, "no default: age")
    assert got[1, "FORWARD"] == (False, "no default: email")
    assert got[1, "FULL"] == (False, "no default: age; no default: email")
    assert got[1, "NONE"][0]


def test_promotion_and_transitive(spark):
    versions = ([("n", "int")], [("n", "long")], [("n", "long"), ("m", "int", 1)])
    got = verdicts(evolution.compatibility(fields(spark, *versions), transitive=True))
    assert got[1, "BACKWARD"][0] and not got[1, "FORWARD"][0] and got[2, "FULL"][0]
    assert set(k[0] for k in verdicts(evolution.compatibility(fields(spark, *versions)))) == {2}


def test_resolve_rejects_what_cannot_be_read(spark):
    df = spark.createDataFrame([(1,)], "a INT")
    assert evolution.resolve(df, [Field("a", "int")], [Field("a", "double")]).schema["a"].dataType.simpleString() == "double"
    with pytest.raises(ValueError, match="no default"):
        evolution.resolve(df, [Field("a", "int")], [Field("b", "int")])
    with pytest.raises(ValueError, match="cannot be read"):
        evolution.resolve(df, [Field("a", "int")], [Field("a", "string")])


def test_frames(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02hi"),), (bytearray(b"\x01\x00\x00\x00\x01x"),), (bytearray(b"\x00\x00"),), (None,)], "v BINARY")
    got = sorted(map(str, rows(evolution.split_frame(df, "v").na.fill("-", ["reason"]).na.fill(-1), "schema_id", "reason")))
    assert got == ["(-1, 'bad magic byte')", "(-1, 'empty')", "(-1, 'too short')", "(258, '-')"]


def test_subject_names(spark):
    row = spark.range(1).select(*[
        evolution.subject_name(s, F.lit("clicks"), F.lit("User")).alias(s) for s in ("topic", "record", "topic_record")
    ]).first()
    assert tuple(row) == ("clicks-value", "User", "clicks-User")


def test_dead_letters_keep_every_row(spark):
    values = ['{"id": 1, "v": "x"}', '{"id": "one", "v": "x"}', "{broken", "[]", "null", None, '{"v": "x"}', "7"]
    log = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(values)], "topic STRING, partition INT, offset BIGINT, value STRING")
    good, bad = quality.split_bad(log, "value", {"id": "INT", "v": "STRING"})
    assert rows(good, "offset", "id") == [(0, 1)]
    assert rows(bad, "offset", "reason") == [
        (1, "type:id"), (2, "not_json"), (3, "not_json"), (4, "not_json"), (5, "not_json"), (6, "missing:id"), (7, "not_json")]


def test_reconcile_states(spark):
    src = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "d INT")
    dst = spark.createDataFrame([(1,), (2,), (2,), (4,), (None,)], "d INT")
    got = {r["d"]: r["status"] for r in quality.reconcile(src.dropna(), dst.dropna(), ["d"]).collect()}
    assert got == {1: "short", 2: "extra", 3: "missing", 4: "unexpected"}


def test_consumer_lag_counts_from_earliest(spark):
    log = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(5, 10)], "topic STRING, partition INT, offset BIGINT")
    commits = spark.createDataFrame([("g", "t", 0, 8)], "group STRING, topic STRING, partition INT, committed BIGINT")
    assert rows(offsets.consumer_lag(offsets.partition_counts(log), commits, ["g", "h"]), "group", "lag") == [("g", 7), ("h", 10)]


def test_commit_passes_over_an_earlier_bad_row(spark):
    log = spark.createDataFrame([("t", 0, o, o != 3) for o in range(5)], "topic STRING, partition INT, offset BIGINT, ok BOOLEAN")
    assert rows(offsets.offsets_to_commit(log, F.col("ok")), "committed") == [(5,)]


def test_rate_with_reset(spark):
    samples = spark.createDataFrame(
        [("a", t("2024-01-01 00:00:00"), 1, 10.0), ("a", t("2024-01-01 00:01:00"), 2, 16.0), ("a", t("2024-01-01 00:02:00"), 3, 4.0),
         ("a", t("2024-01-01 00:04:00"), 4, 10.0), ("b", t("2024-01-01 00:00:00"), 5, 1.0)],
        "s STRING, ts TIMESTAMP_NTZ, i INT, v DOUBLE",
    )
    # 6, then a reset to 4, then 6 more, over 240 seconds; one sample gives no rate.
    got = metrics.increase(samples, ["s"], "ts", "i", "v", "5 minutes")
    assert rows(got, "s", "increase", "rate") == [("a", 16.0, 16.0 / 240)]
    assert rows(metrics.instant_rate(samples, ["s"], "ts", "i", "v", "5 minutes"), "s", "irate") == [("a", 6.0 / 120)]


def test_falling_gauge_is_predicted_below_zero(spark):
    base = t("2024-01-01 00:00:00")
    samples = spark.createDataFrame([("d", base + dt.timedelta(minutes=m), 100.0 - m) for m in range(60)], "s STRING, ts TIMESTAMP_NTZ, v DOUBLE")
    out = metrics.predict_linear(samples, ["s"], "ts", "v", "4 hours", 3600).first()
    assert abs(out["predicted"] - (41.0 - 60)) < 1e-6


def test_histogram_quantile(spark):
    inf = float("inf")
    buckets = spark.createDataFrame(
        [("a", 10.0, 5), ("a", 20.0, 15), ("a", inf, 20), ("b", 10.0, 0), ("b", inf, 4), ("c", 10.0, 0), ("c", inf, 0)],
        "s STRING, le DOUBLE, n BIGINT",
    )
    assert rows(metrics.histogram_quantile(buckets, ["s"], 0.5), "s", "quantile") == [("a", 15.0), ("b", 10.0)]


def test_alert_pending_then_firing(spark):
    base = t("2024-01-01 00:00:00")
    flags = [1, 1, 1, 0, 1, 1, None, 1]
    samples = spark.createDataFrame(
        [("x", base + dt.timedelta(minutes=i), v) for i, v in enumerate(flags) if v is not None], "s STRING, ts TIMESTAMP_NTZ, v INT"
    )
    got = metrics.alerts(samples, ["s"], "ts", F.col("v") == 1, 120, 60)
    assert [r["state"] for r in got.orderBy("ts").collect()] == ["pending", "pending", "firing", "pending", "pending", "pending"]


def test_decisions(spark):
    requests = spark.createDataFrame([("u1", "t1"), ("u2", "t1"), ("u3", "t1"), ("u4", "t1"), ("u5", "t1")], "user STRING, resource STRING").withColumn("action", F.lit("read"))
    members = spark.createDataFrame([("u1", "a"), ("u2", "a"), ("u2", "d"), ("u3", "a"), ("u3", "d"), ("u3", "dx"), ("u4", "a"), ("u4", "ax")], "user STRING, group STRING")
    tags = spark.createDataFrame([("t1", "PII")], "resource STRING, tag STRING")
    rules = spark.createDataFrame(
        [("resource", "t1", "a", "read", "allow"), ("tag", "PII", "d", "read", "deny"), ("tag", "PII", "dx", "read", "deny_exception"),
         ("resource", "t1", "ax", "read", "allow_exception")], "kind STRING, name STRING, principal STRING, action STRING, effect STRING")
    got = dict(rows(policies.decide(requests, members, tags, rules, "NONE"), "user", "decision"))
    assert got == {"u1": "ALLOW", "u2": "DENY", "u3": "ALLOW", "u4": "DENY", "u5": "NONE"}


EDGES = [("topic", "raw", False), ("raw", "clean", True), ("clean", "board", False), ("board", "topic", True)]


def test_lineage_case(spark):
    edges = spark.createDataFrame(EDGES, "src STRING, dst STRING, masks BOOLEAN")
    start = spark.createDataFrame([("topic",)], "node STRING")
    assert rows(lineage.reach(edges, start), "node", "depth") == [("board", 3), ("clean", 2), ("raw", 1)]
    assert rows(lineage.reach(edges, start, "up", 1), "node") == [("board",)]
    tags = spark.createDataFrame([("topic", "PII"), ("topic", "PCI")], "node STRING, tag STRING")
    assert rows(lineage.propagate_tags(edges, tags), "node", "tag") == [("raw", "PCI"), ("raw", "PII"), ("topic", "PCI"), ("topic", "PII")]
    exposed = spark.createDataFrame([("raw",), ("board",)], "node STRING")
    assert rows(lineage.unmasked_leaks(edges, tags, exposed), "node", "tag") == [("raw", "PCI"), ("raw", "PII")]


def test_masks(spark):
    df = spark.createDataFrame([("4111222233334444",), ("abc",), (None,)], "c STRING")
    got = [r[0] for r in df.select(scalars.mask_last(F.col("c"))).collect()]
    assert got == ["xxxxxxxxxxxx4444", "xxx", None]


def test_wildcard_takes_other_signs_literally(spark):
    df = spark.createDataFrame([("a_b@x.com",), ("aXb@x.com",)], "c STRING")
    assert rows(df.filter(scalars.wildcard(F.col("c"), "*A_B*")), "c") == [("a_b@x.com",)]


def test_pi(spark):
    assert abs(series.pi_leibniz(spark.range(200_000), "id").first()[0] - 3.1415877) < 1e-6
    assert abs(series.pi_sampling(spark.range(100_000), "id").first()["pi"] - 3.14159) < 0.01


def test_sessions_split_at_the_gap(spark):
    times = ["00:00", "00:29", "00:59", "01:28"]
    df = spark.createDataFrame([("u", t(f"2024-01-01 {x}:00"), i) for i, x in enumerate(times)], "k STRING, ts TIMESTAMP_NTZ, i INT")
    got = windows.sessionize(df, "k", "ts", "i", 1800)
    assert rows(got, "session_start", "session_end", "n") == [
        (t("2024-01-01 00:00:00"), t("2024-01-01 00:59:00"), 2), (t("2024-01-01 00:59:00"), t("2024-01-01 01:58:00"), 2)]


def test_cube_lookup_equals_group_by(spark):
    df = spark.createDataFrame([("a", "x", None, 1.0), ("a", "y", "m", 2.0), (None, "x", "m", 4.0)], "d1 STRING, d2 STRING, d3 STRING, v DOUBLE")
    cube = grouping.build_cube(df, ["d1", "d2", "d3"], ["v"])
    for by in (["d1"], ["d2", "d3"], []):
        want = df.groupBy(*by).agg(F.sum("v").alias("sum_v"), F.count("*").alias("n_rows"))
        got = grouping.query_cube(cube, ["d1", "d2", "d3"], by)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        grouping.query_cube(cube, ["d1"], ["other"])


def test_topic_table_keeps_the_raw_message(spark):
    df = spark.createDataFrame([(0, '{"k": 1}'), (1, "junk")], "id BIGINT, v STRING")
    topic = topics.as_topic(df, "t", F.col("id"), F.encode("v", "UTF-8"), F.col("id"), F.current_timestamp(), 2)
    assert sorted(map(str, rows(topics.topic_table(topic, "k INT").na.fill(-1), "_partition", "_message", "k"))) == [
        "(0, '{\"k\": 1}', 1)", "(1, 'junk', -1)"]


def test_geometric_mean_of_nulls_and_signs(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 8.0), ("a", -1.0), ("b", -3.0), (None, 5.0)], "k STRING, v DOUBLE")
    got = {r["k"]: r["geomean"] for r in udfs.geometric_mean(df, ["k"], "v").collect()}
    assert abs(got["a"] - 4.0) < 1e-9 and got["b"] is None and abs(got[None] - 5.0) < 1e-9


def test_times_do_not_depend_on_the_session_zone(spark, sf):
    registry.load_all()
    con = duck(sf)
    names = ["sink_hourly_partitions", "fn_epoch_parts", "fn_iso_parse", "bronze_to_parquet", "stream_hourly_ingest"]
    with session.settings(spark, spark__sql__session__timeZone="America/New_York"):
        for name in names:
            assert compare(spark, con, sf, name)[0] is None
        table = spark.createDataFrame([(1710037800000,), (1710037800999,)], "ms BIGINT")  # inside the spring gap
        got = table.select(*[c.alias(n) for n, c in scalars.epoch_parts(F.col("ms")).items()]).withColumn("back", scalars.utc_millis(F.col("ts")))
        assert [(r["hour"], r["back"]) for r in got.collect()] == [("02", 1710037800000), ("02", 1710037800999)]
        iso = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T02:00:00+02:00",), ("2024-01-01T00:00:00",), ("x",)], "t STRING")
        assert [str(r[0]) for r in iso.select(scalars.parse_iso(F.col("t"))).collect()] == ["2024-01-01 00:00:00"] * 3 + ["None"]


def test_a_long_card_text_is_not_cut(spark):
    names = ["Customer#" + "x" * 105 + str(i) for i in range(3)]
    df = spark.createDataFrame([(n,) for n in names], "c_name STRING")
    assert df.select(scalars.mask_hash(F.expr("substring(c_name, 10)"))).distinct().count() == 3


def test_requests_and_rows_with_nulls_stay(spark):
    requests = spark.createDataFrame([("u", "r", "read"), (None, "r", "read"), ("u", None, "read")], "user STRING, resource STRING, action STRING")
    members = spark.createDataFrame([("u", "g")], "user STRING, `group` STRING")
    tags = spark.createDataFrame([("r", "t")], "resource STRING, tag STRING")
    rules = spark.createDataFrame([("resource", "r", "g", "read", "allow")], "kind STRING, name STRING, principal STRING, action STRING, effect STRING")
    got = policies.decide(requests, members, tags, rules)
    assert sorted((str(r["user"]), str(r["resource"]), r["decision"]) for r in got.collect()) == [
        ("None", "r", "DENY"), ("u", "None", "DENY"), ("u", "r", "ALLOW")]
    copies = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (None, 0, "c"), (None, 1, "d")], "id INT, at INT, v STRING")
    assert sorted(r["v"] for r in quality.first_copy(copies, ["id"], "at").collect()) == ["a", "c", "d"]


def test_seeded_random_repeats_itself(spark):
    df = spark.range(2000).withColumn("n", F.when(F.col("id") % 9 > 0, F.col("id")))
    one, two, other = (scalars.seeded_random(s, "id", "n") for s in (1, 1, 2))
    got = df.repartition(5).select(one.alias("a"), two.alias("b"), other.alias("c")).collect()
    assert all(r["a"] == r["b"] and 0 <= r["a"] < 1 for r in got) and sum(r["a"] == r["c"] for r in got) == 0
    assert abs(sum(r["a"] for r in got) / 2000 - 0.5) < 0.03
