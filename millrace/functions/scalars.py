"""Small column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(df: DataFrame, value: Column) -> Column:
    """The one value of an aggregate, as a literal: later filters can push it down.

    It travels as text and is cast back, so no time zone of the driver comes in.
    """
    out = df.agg(value.alias("v"))
    text = out.select(F.col("v").cast("string")).first()[0]
    return F.lit(text).cast(out.schema["v"].dataType)


def utc_from_micros(us: Column) -> Column:
    """UTC timestamp without zone from epoch microseconds, whatever the session's zone."""
    seconds = (us.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without zone read as UTC, rounded down."""
    millis = F.floor(F.expr("1000") * F.extract(F.lit("SECOND"), ts)).cast("bigint")
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000 + millis


def time_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month, day and hour of a timestamp without zone."""
    return {
        name: F.lpad(part(ts).cast("string"), size, "0")
        for name, part, size in (("year", F.year, 4), ("month", F.month, 2), ("day", F.day, 2), ("hour", F.hour, 2))
    }


def epoch_parts(ms: Column) -> dict[str, Column]:
    """UTC timestamp and its zero-padded parts from epoch milliseconds."""
    ts = utc_from_micros(ms * 1000)
    return {"ts": ts, **time_parts(ts)}


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp without zone; NULL when it is not one.

    With a zone or ``Z`` it is taken to UTC, without one it stands as written.
    """
    zoned = text.rlike(r"(Z|[+-]\d\d:?\d\d)$") & text.contains(":")
    return F.when(zoned, utc_from_micros(F.unix_micros(F.try_to_timestamp(text)))).otherwise(
        text.try_cast("timestamp_ntz"))


def wildcard(text: Column, pattern: str) -> Column:
    """Case-insensitive match with ``*`` for any run of characters."""
    escaped = pattern.lower().replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.lower(text).like(escaped.replace("*", "%"))


def mask_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def mask_last(text: Column, keep: int = 4, fill: str = "x") -> Column:
    """Hide all but the last ``keep`` characters; shorter text stays hidden whole."""
    hidden = F.length(text) - keep
    return F.when(hidden <= 0, F.repeat(F.lit(fill), F.length(text))).otherwise(
        F.concat(F.repeat(F.lit(fill), hidden), F.right(text, F.lit(keep)))
    )


def words_spaced(line: Column) -> Column:
    """The pieces between single spaces, empty ones included."""
    return F.split(line, " ")


def alphabet_part(word: Column, parts: int) -> Column:
    """Partition number by first character: a-m first, other letters second, rest last."""
    if parts <= 1:
        return F.lit(0)
    first = F.substring(word, 1, 1)
    return (
        F.when(word == "", 0)
        .when(first.rlike("^[a-m]$"), 0)
        .when(first.rlike(r"^\p{L}$"), 1 % parts)
        .otherwise(parts - 1)
    )


def seeded_random(seed: int, *identity: str) -> Column:
    """A number from 0 up to 1 drawn from a row's identity: the same seed and row always
    give the same number, also in a recomputed partition, which ``rand(seed)`` does not
    promise.  A NULL part counts as a value of its own.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in identity]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
