"""Word counts under three sets of rules.

Dropping characters other than blanks does not move a token's borders, so the
tokens are counted as they stand first and only the distinct ones are cleaned:
the regular expressions run on the vocabulary and not on the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import words_spaced


def _count(df: DataFrame, words: Column) -> DataFrame:
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _clean(df: DataFrame, text: str, dropped: str) -> DataFrame:
    raw = _count(df, F.split(text, r"\s+"))
    word = F.lower(F.regexp_replace("word", dropped, ""))
    counts = raw.select(word.alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))
    # Naming n keeps this filter here: on the word alone it would be pushed below the
    # first count and clean every token after all.
    return counts.filter("word <> '' OR n < 0")


def count_alnum(df: DataFrame, text: str) -> DataFrame:
    """Letters and digits, lower case, other characters dropped."""
    return _clean(df, text, "[^a-zA-Z0-9]")


def count_alpha(df: DataFrame, text: str) -> DataFrame:
    """Letters only, lower case: a token of digits vanishes."""
    return _clean(df, text, "[^a-zA-Z]")


def count_spaced(df: DataFrame, text: str) -> DataFrame:
    """Pieces between single spaces of each line, as they are."""
    lines = df.select(F.explode(F.split(text, "\n")).alias("_line"))
    return _count(lines, words_spaced(F.col("_line")))
