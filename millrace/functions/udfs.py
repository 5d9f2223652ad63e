"""User-defined functions, for what built-in functions cannot say.

They block pushdown and leave generated code, so they come last.  Scalars run on
Arrow batches.  An aggregate is given as three parts (per batch, merge, finish):
the first runs where the rows are, and only its small results are shuffled, so no
task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def log1p(values: pd.Series) -> pd.Series:
    return np.log1p(values)


def tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per blank-separated token with the row's key and its position.

    A table function on whole Arrow batches: a batch is split at once, without a Python
    step per row.  Rows whose text is NULL, empty or blank give none.
    """
    kind = df.select(key).schema[0].dataType.simpleString()

    class Tokens:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            keys, texts = batch.column(0), batch.column(1)
            words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
            parent, word = pc.list_parent_indices(words), pc.list_flatten(words)
            rows = parent.to_numpy(zero_copy_only=False)
            first = np.searchsorted(rows, rows, side="left")
            pos = pa.array((np.arange(len(rows)) - first).astype("int32"))
            out = pa.table([keys.take(parent), pos, word], names=[key, "pos", "token"])
            yield out.filter(pc.not_equal(word, ""))

    function = F.arrow_udtf(Tokens, returnType=f"`{key}` {kind}, pos INT, token STRING")
    return function(df.select(key, text).asTable())


def aggregate(df: DataFrame, keys: list[str], columns: list[str],
              per_batch: Callable[[pd.DataFrame, list[str]], pd.DataFrame], partial_ddl: str,
              merge: dict[str, Column], finish: dict[str, Column]) -> DataFrame:
    """A user-defined aggregate.

    ``per_batch`` turns a whole Arrow batch into one row of partial results per key
    (key columns first), without a Python step per key; ``merge`` combines partials
    with built-in aggregates, ``finish`` gives the value.
    """
    key_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield per_batch(batch, keys)

    partial = df.select(*keys, *columns).mapInPandas(run, f"{key_ddl}, {partial_ddl}")
    merged = partial.groupBy(*keys).agg(*[c.alias(n) for n, c in merge.items()])
    return merged.select(*keys, *[c.alias(n) for n, c in finish.items()])


def geometric_mean(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Geometric mean of positive values."""

    def per_batch(batch: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
        positive = batch[value] > 0
        # As objects: a text column of the batch may be chunked, which has no way back into a struct.
        parts = batch[keys].astype(object).assign(_n=positive.astype("int64"), _s=np.log(batch[value].where(positive)).fillna(0.0).astype(float))
        sums = parts.groupby(keys, dropna=False, sort=False)[["_n", "_s"]].sum().reset_index()
        return sums.assign(**{k: sums[k].astype(object).where(sums[k].notna(), None) for k in keys})

    return aggregate(
        df, keys, [value], per_batch, "_n BIGINT, _s DOUBLE",
        {"_n": F.sum("_n"), "_s": F.sum("_s")},
        {"geomean": F.when(F.col("_n") > 0, F.exp(F.col("_s") / F.col("_n")))},
    )


def map_combine_reduce(df: DataFrame, mapper: Callable[[pd.DataFrame], pd.DataFrame],
                       pair_ddl: str, keys: list[str], reducer: dict[str, Column]) -> DataFrame:
    """Mapper in Python, combiner and reducer as built-in aggregates.

    ``mapper`` gets Arrow batches and may already combine inside one; Spark
    combines again before the shuffle and reduces after it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield mapper(batch)

    return df.mapInPandas(run, pair_ddl).groupBy(*keys).agg(
        *[c.alias(n) for n, c in reducer.items()]
    )
