"""Derived demonstration data.

Each generator turns an id column of a given table into the rows a lab would
have generated, by arithmetic on the id: the output grows with the input and
is the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
PAGES = [
    "/home", "/products", "/products/electronics", "/products/apparel",
    "/cart", "/checkout", "/payment", "/order-confirmation",
]
ACTIONS = ["view", "click", "add_to_cart", "remove_from_cart", "purchase"]
DEVICES = ["mobile-ios", "mobile-android", "desktop-chrome", "desktop-firefox", "tablet-safari"]
SEED_VALUES = [12.5, 8.4, 19.1, 4.3, 10.0, 15.6, 25.1, 3.2, 14.8, 20.0]


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def mixed(id_: Column, salt: int, modulus: int) -> Column:
    """A reproducible number in ``[0, modulus)`` from an id: a multiplicative mix."""
    return (F.pmod(id_, F.lit(1_000_003)) * F.lit(7919 + 2 * salt) + F.lit(salt * 104_729)) % F.lit(
        1_000_003
    ) % F.lit(modulus)


def skewed_transactions(df: DataFrame, id_col: str) -> DataFrame:
    """Add ``join_key``: ids whose last two digits are below 95 share one key."""
    i = F.col(id_col)
    return df.withColumn(
        "join_key", F.when(i % 100 < 95, F.lit("KEY_SKEW")).otherwise(i.cast("string"))
    )


def users(df: DataFrame, id_col: str) -> DataFrame:
    """Users of which every tenth lives in city 999, the rest in one of five."""
    i = F.col(id_col)
    return df.select(
        i.alias("id"),
        F.concat(F.lit("User_"), i.cast("string")).alias("name"),
        (mixed(i, 1, 50) + 18).cast("int").alias("age"),
        F.when(i % 10 == 0, F.lit(999)).otherwise(i % 5).cast("int").alias("city_id"),
    )


def benchmark_logs(df: DataFrame, id_col: str) -> DataFrame:
    """The product of a ten-row seed table with itself four times, one row per id.

    The four decimal digits of the id name the four seed rows, which gives the
    product without joining: ids 0..9999 make it complete, later ids repeat it.
    """
    digit = [F.floor(F.col(id_col) / F.lit(10 ** k)).cast("bigint") % 10 for k in range(4)]
    val = [_pick(SEED_VALUES, d) for d in digit]
    s = [d + 1 for d in digit]
    return df.select(
        (s[0] + s[1] * 10 + s[2] * 100).alias("log_id"),
        F.when(s[0] % 3 == 0, "ERROR").when(s[0] % 3 == 1, "INFO").otherwise("WARN").alias("log_level"),
        (val[0] * 1.5 + val[1] * 0.8 + val[2] * 0.2 + val[3] * 0.1).alias("response_time"),
    )


def clickstream(df: DataFrame, id_col: str) -> DataFrame:
    """Click events with page, device and an IPv4 address."""
    i = F.col(id_col)
    octets = [
        mixed(i, 5, 223) + 1, mixed(i, 6, 256), mixed(i, 7, 256), mixed(i, 8, 254) + 1,
    ]
    return df.select(
        i.alias("event_id"),
        _pick(ACTIONS, mixed(i, 2, 5)).alias("event_type"),
        _pick(PAGES, mixed(i, 3, 8)).alias("page_url"),
        _pick(DEVICES, mixed(i, 4, 5)).alias("device"),
        F.concat_ws(".", *[o.cast("string") for o in octets]).alias("ip_address"),
    )


def order_events(df: DataFrame, id_col: str) -> DataFrame:
    """Orders of ten customers, 10 to 1000 in money, five in a hundred failed."""
    i = F.col(id_col)
    body = df.select(
        F.concat(F.lit("order_"), i.cast("string")).alias("orderId"),
        F.concat(F.lit("cust_"), (mixed(i, 9, 10) + 1).cast("string")).alias("customerId"),
        F.round(F.lit(10.0) + mixed(i, 10, 99_001) / 100.0, 2).alias("amount"),
        F.when(mixed(i, 11, 100) < 5, "FAILED").otherwise("CREATED").alias("status"),
    )
    return body.withColumn("key", F.col("customerId")).withColumn(
        "payload", F.to_json(F.struct("orderId", "customerId", "amount", "status"))
    )
