"""Web access logs: lines to typed fields, addresses to networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import fits_broadcast
from millrace.session import write_through

# host identity user [time] "method path protocol" status size
LINE = r'^(\S+) \S+ (\S+) \[([^\]]+)\] "([A-Z]+) (\S+)[^"]*" (\S+) (\d{1,18}|-)(?: .*)?$'
FIELDS = ("host", "user", "time", "method", "path", "status_text", "size_text")
TIME = "dd/MMM/yyyy:HH:mm:ss Z"
OCTET = r"(\d{1,3})"


def address_number(address: Column) -> Column:
    """An IPv4 address as a number; NULL for anything else, or with a part above 255."""
    octets = [F.split_part(address, F.lit("."), F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    whole = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    return F.when(address.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$") & (F.greatest(*octets) <= 255), whole)


def parse_lines(df: DataFrame, line: str) -> DataFrame:
    """Typed fields of access-log lines in the common format; what follows the size is ignored.

    Adds ``address`` (number), ``user``, ``at``, ``method``, ``path``, ``status``, ``size`` (``-`` is
    zero) and ``reason``, which is NULL for a good line and else ``format``, ``address``, ``status``
    or ``time``.  A NULL line has the reason ``format``.  The pattern runs once per line.
    """
    # The marks cannot stand in a field, since they are blanked out before.
    clean = F.translate(F.col(line), "\u0001", " ")
    marked = F.regexp_replace(clean, LINE, "\u0001".join(f"${i}" for i in range(1, len(FIELDS) + 1)))
    # A generator of one row: a filter on what it makes is not pushed below it, which would run the pattern again.
    parts = df.select("*", F.explode(F.array(F.coalesce(F.split(marked, "\u0001"), F.array(F.lit(""))))).alias("_p"))
    whole = F.size("_p") == len(FIELDS)
    field = {name: F.when(whole, F.get("_p", F.lit(i))) for i, name in enumerate(FIELDS)}
    status = field["status_text"].try_cast("int")
    typed = {
        "address": address_number(field["host"]), "user": F.nullif(field["user"], F.lit("-")),
        "at": F.try_to_timestamp(field["time"], F.lit(TIME)), "method": field["method"], "path": field["path"],
        "status": F.when(status.between(100, 599), status),
        "size": F.when(field["size_text"] == "-", F.lit(0)).otherwise(field["size_text"].try_cast("bigint")).cast("bigint"),
    }
    record = F.struct(*[c.alias(n) for n, c in typed.items()], whole.alias("_whole"))
    reason = (
        F.when(~F.col("_whole"), "format").when(F.col("address").isNull(), "address")
        .when(F.col("status").isNull(), "status").when(F.col("at").isNull(), "time")
    )
    typed_rows = parts.select(*df.columns, F.inline(F.array(record)))
    return typed_rows.withColumn("reason", reason).drop("_whole")


def network_bounds(networks: DataFrame, cidr: str) -> DataFrame:
    """Add ``prefix_length`` and ``prefix``, the leading bits of a network ``a.b.c.d/length``.

    Bits behind the length are ignored.  Rows that are no network are dropped.
    """
    parts = F.split(F.col(cidr), "/")
    length = F.get(parts, F.lit(1)).try_cast("int")
    first = address_number(F.get(parts, F.lit(0)))
    split = networks.withColumn("prefix_length", length).withColumn("_first", first)
    valid = split.filter("prefix_length BETWEEN 0 AND 32 AND _first IS NOT NULL")
    return valid.withColumn("prefix", F.expr("shiftright(_first, 32 - prefix_length)")).drop("_first")


def longest_prefix(addresses: DataFrame, address: str, networks: DataFrame, cidr: str, label: str) -> DataFrame:
    """The label of the most specific network around each distinct address; none: no row.

    An address meets networks by equality, once per prefix length that occurs (33 at most), so
    neither side is compared with all of the other.  Of equal networks the smallest label counts.
    """
    bounds = write_through(
        network_bounds(networks.select(cidr, label), cidr).groupBy("prefix_length", "prefix").agg(F.min(label).alias(label)),
        "networks",
    )
    lengths = sorted(r[0] for r in bounds.select("prefix_length").distinct().collect())
    options = F.array(*[
        F.struct(F.lit(n).alias("prefix_length"), F.expr(f"shiftright(`{address}`, {32 - n})").alias("prefix"))
        for n in lengths
    ]) if lengths else F.expr("CAST(array() AS ARRAY<STRUCT<prefix_length: INT, prefix: BIGINT>>)")
    tried = addresses.select(address).filter(F.col(address).isNotNull()).distinct().select(
        address, F.inline(options)
    )
    side = F.broadcast(bounds) if fits_broadcast(bounds) else bounds
    found = tried.join(side, ["prefix_length", "prefix"])
    return found.groupBy(address).agg(F.max_by(label, "prefix_length").alias(label))


def region_counts(requests: DataFrame, address: str, by: list[str], size: str,
                  networks: DataFrame, cidr: str, region: str) -> DataFrame:
    """Requests and bytes per region and further columns; addresses in no network are ``unknown``.

    Requests are counted per address before anything else, so a busy client is one row per task;
    the counts are written, since they are read twice and the lines behind them once.
    """
    counts = write_through(
        requests.groupBy(address, *by).agg(F.count("*").alias("_n"), F.sum(size).alias("_bytes")), "requests"
    )
    named = counts.join(longest_prefix(counts, address, networks, cidr, region), address, "left")
    return named.groupBy(F.coalesce(region, F.lit("unknown")).alias(region), *by).agg(
        F.sum("_n").alias("n"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes")
    )
