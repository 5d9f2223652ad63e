"""A stateful operator of our own: sessions kept in state and closed by timers.

``session_window`` covers the plain case; this form is the pattern to change when
the rule for a session's end is not a fixed pause.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.windows import event_time


def merge_spans(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Join spans (start, end, n) that overlap; touching ones stay apart."""
    out: list[tuple[int, int, int]] = []
    for start, end, n in sorted(spans):
        if out and start < out[-1][1]:
            last = out.pop()
            out.append((last[0], max(last[1], end), last[2] + n))
        else:
            out.append((start, end, n))
    return out


def _local_spans(key: str, gap_us: int):
    """Reduce each Arrow batch to its spans, so a busy key is small before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.dropna(subset=["_us"]).sort_values([key, "_us"])
            fresh = (rows["_us"] - rows.groupby(key, dropna=False)["_us"].shift()).fillna(gap_us) >= gap_us
            spans = rows.groupby([key, fresh.cumsum().rename("_s")], dropna=False)["_us"].agg(["min", "max", "count"])
            spans = spans.reset_index(level=key).reset_index(drop=True)
            yield pd.DataFrame({
                key: spans[key], "start_us": spans["min"], "end_us": spans["max"] + gap_us,
                "n": spans["count"], "ts": pd.to_datetime(spans["max"], unit="us", utc=True),
            })

    return run


class Sessions(StatefulProcessor):
    """Open spans of a key in a list state; a timer at the end of each closes it."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start_us BIGINT, end_us BIGINT, n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        spans = self._spans()
        earliest = self._due(spans)
        for batch in rows:
            new = zip(batch["start_us"], batch["end_us"], batch["n"])
            spans = merge_spans(spans + [(int(a), int(b), int(n)) for a, b, n in new])
        if spans:
            self.open.put(spans)
        # One timer per key, for the span that ends first.
        if self._due(spans) != earliest:
            if earliest is not None:
                self.handle.deleteTimer(earliest)
            self.handle.registerTimer(self._due(spans))
        yield self._frame(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        spans = self._spans()
        done = [s for s in spans if self._due([s]) <= now]
        left = [s for s in spans if self._due([s]) > now]
        if left:
            self.open.put(left)
            self.handle.registerTimer(self._due(left))
        elif spans:
            self.open.clear()
        yield self._frame(key, done)

    def close(self) -> None:
        pass

    def _spans(self) -> list[tuple[int, int, int]]:
        if not self.open.exists():
            return []
        return [(int(a), int(b), int(n)) for a, b, n in self.open.get()]

    @staticmethod
    def _due(spans) -> int | None:
        """The first millisecond at which one of the spans has ended."""
        return min((-(-end // 1000) for _, end, _ in spans), default=None)

    def _frame(self, key, spans) -> pd.DataFrame:
        # Plain object strings: the state serializer takes no chunked Arrow strings.
        return pd.DataFrame({
            self.key: pd.Series([key[0]] * len(spans), dtype=object),
            **{name: [s[i] for s in spans] for i, name in enumerate(("start_us", "end_us", "n"))},
        })


def custom_sessions(df: DataFrame, key: str, ts: str, gap_seconds: int, delay: str) -> DataFrame:
    """Sessions of a stream through ``Sessions``; needs the RocksDB state store.

    Keys travel as text, so a NULL key is a key of its own and leaves others exact;
    rows without a time have no session.
    """
    kind = df.schema[key].dataType.simpleString()
    gap_us = gap_seconds * 1_000_000
    micros = df.select(F.col(key).cast("string").alias(key), F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    spans = micros.mapInPandas(
        _local_spans(key, gap_us), f"{key} STRING, start_us BIGINT, end_us BIGINT, n BIGINT, ts TIMESTAMP"
    )
    out = (
        event_time(spans, "ts").withWatermark("ts", delay).groupBy(key)
        .transformWithStateInPandas(
            statefulProcessor=Sessions(key),
            outputStructType=f"{key} STRING, start_us BIGINT, end_us BIGINT, n BIGINT",
            outputMode="append", timeMode="eventTime",
        )
    )
    return out.select(
        F.col(key).cast(kind).alias(key), F.timestamp_micros("start_us").cast("timestamp_ntz").alias("session_start"),
        F.timestamp_micros("end_us").cast("timestamp_ntz").alias("session_end"), "n",
    )
