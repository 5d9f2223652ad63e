"""Small helpers the document operators share."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import write_through

WORD = r"[^\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text itself, null as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else.  ``lower`` does the same on pure ASCII and is faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def lookup(rows: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """Left join on null-safe ``keys``; ``table`` has one row per key and its keys go."""
    other = table.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in table.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"_r_{k}"]) for k in keys])
    return rows.join(other, on, "left").drop(*[f"_r_{k}" for k in keys])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


__all__ = ["WORD", "whole", "lower_az", "crc_mod", "lookup", "unused", "write_through"]
