"""Access-log lines and networks against results worked out by hand and Python's own address module."""

import ipaddress
import random

from pyspark.sql import functions as F

from millrace.operators import weblogs


def test_lines_and_their_rejects(spark):
    good = '1.2.3.4 - - [05/Mar/2024:10:00:01 +0100] "GET /a?b=c HTTP/1.1" 200 512'
    lines = [
        good, good + ' "http://x" "agent \u0001"', good.replace("512", "-").replace("- -", "- ann"),
        good.replace("1.2.3.4", "1.2.3.256"), good.replace("1.2.3.4", "host"), good.replace("200", "20"),
        good.replace("200", "2x0"), good.replace("05/Mar", "45/Mar"), "", None, "\u0001" * 6, good + "x",
        good.replace("512", "9" * 18),
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i INT, line STRING")
    got = {r["i"]: r for r in weblogs.parse_lines(df, "line").withColumn("utc", F.unix_timestamp("at")).collect()}
    assert [got[i]["reason"] for i in range(len(lines))] == [
        None, None, None, "address", "address", "status", "status", "time", "format", "format", "format", "format", None]
    first = got[0]
    assert (first["address"], first["user"], first["method"], first["path"], first["status"], first["size"]) == (
        0x01020304, None, "GET", "/a?b=c", 200, 512)
    assert first["utc"] == 1709629201
    assert (got[2]["user"], got[2]["size"], got[12]["size"]) == ("ann", 0, 10 ** 18 - 1)


def test_longest_prefix_equals_a_scan_of_all_networks(spark):
    rng = random.Random(5)
    networks = [("0.0.0.0/0", "all"), ("10.0.0.0/8", "b"), ("10.0.0.0/8", "a"), ("10.1.2.3/32", "host"),
                ("255.255.255.255/32", "top"), ("10.1.0.77/16", "loose"), ("1.2.3.4", "none"), ("x/8", "none"),
                ("10.0.0.0/33", "none"), (None, "none")]
    networks += [(f"10.{rng.randrange(4)}.{rng.randrange(8)}.0/{rng.choice([9, 14, 20, 24])}", f"r{i}") for i in range(40)]
    numbers = [0, 2 ** 32 - 1, 0x0A010203] + [rng.randrange(0x0A000000, 0x0A040800) for _ in range(300)] + [0x0A010203, None]
    known: dict = {}
    for cidr, label in networks:
        if label != "none":
            net = ipaddress.ip_network(cidr, strict=False)
            known[net] = min(label, known.get(net, label))
    want = {}
    for n in set(numbers) - {None}:
        around = [net for net in known if ipaddress.ip_address(n) in net]
        want[n] = known[max(around, key=lambda net: net.prefixlen)]
    nets = spark.createDataFrame(networks, "cidr STRING, region STRING")
    got = weblogs.longest_prefix(spark.createDataFrame([(n,) for n in numbers], "a BIGINT"), "a", nets, "cidr", "region")
    assert {r["a"]: r["region"] for r in got.collect()} == want


def test_empty_logs_and_no_networks(spark):
    lines = spark.createDataFrame([], "line STRING")
    nets = spark.createDataFrame([], "cidr STRING, region STRING")
    parsed = weblogs.parse_lines(lines, "line")
    assert weblogs.region_counts(parsed, "address", ["status"], "size", nets, "cidr", "region").count() == 0
    one = spark.createDataFrame([(7, 200, 5), (None, 200, None)], "address BIGINT, status INT, size BIGINT")
    got = weblogs.region_counts(one, "address", ["status"], "size", nets, "cidr", "region").collect()
    assert [tuple(r) for r in got] == [("unknown", 200, 2, 5)]
