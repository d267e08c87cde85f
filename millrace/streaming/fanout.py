"""Fan-out receipts that are closed as a stream of child receipts goes on."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.receipts import receipt_summary

#: The provider that stateful processors with timers need.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_PARENT = (
    "status string, ok boolean, expected int, missing int, child_count int, ok_children int, "
    "failed_children int, attempts int, retryable boolean, failure_kind string, error_code string"
)
_COLUMNS = ("delivery", "ms", "expected", "destination", "ok", "attempts", "retry", "kind", "code")
#: Shares of the deliveries whose state is kept together.
BUCKETS = 1024
_EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


class _Deliveries(StatefulProcessor):
    """The deliveries of a bucket: the last receipt of each of their destinations.

    A delivery is closed when all its destinations have answered, or ``timeout_ms`` after
    its first receipt.  What comes for a closed delivery before that time is over changes
    nothing; then its state is dropped.

    The state of a bucket is one JSON text, ``{delivery: [expected, closed, expires,
    {destination: [ok, attempts, retry, kind, code]}]}``, so a batch reads and writes each
    bucket once.  A timer stands at the first time at which one of them expires.
    """

    def __init__(self, columns: list[str], timeout_ms: int) -> None:
        self.columns, self.timeout_ms = columns, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("deliveries", "deliveries string, timer long")

    def _read(self) -> tuple[dict, int | None]:
        known = self.state.get()
        return ({}, None) if known is None else (json.loads(known[0]), known[1])

    def _write(self, deliveries: dict, timer: int | None) -> None:
        if not deliveries:
            self.state.clear()
            return
        first = min(d[2] for d in deliveries.values())
        if timer is None or first < timer:
            self.handle.registerTimer(first)
            timer = first
        self.state.update((json.dumps(deliveries, ensure_ascii=False), timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        deliveries, timer = self._read()
        touched = {}
        for frame in rows:
            columns = [[None if v != v else v for v in frame[c].tolist()] for c in _COLUMNS]
            for name, at, expected, destination, *child in zip(*columns, strict=True):
                one = deliveries.get(name)
                if one is None:
                    one = deliveries[name] = [int(expected), False, int(at) + self.timeout_ms, {}]
                one[0] = max(one[0], int(expected))
                if not one[1]:
                    one[3][destination] = child
                touched[name] = one
        closing = [n for n, d in touched.items() if not d[1] and len(d[3]) >= d[0]]
        parents = [self._parent(name, "complete", deliveries[name]) for name in closing]
        for name in closing:
            # What a closed delivery needs is that it is closed.
            deliveries[name][1:] = [True, deliveries[name][2], {}]
        self._write(deliveries, timer)
        if parents:
            yield pd.DataFrame(parents, columns=self.columns, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        deliveries, timer = self._read()
        passed = timerValues.getCurrentWatermarkInMs()
        gone = {n: d for n, d in deliveries.items() if d[2] < passed}
        parents = [self._parent(n, "timed_out", d) for n, d in gone.items() if not d[1]]
        left = {n: d for n, d in deliveries.items() if n not in gone}
        self._write(left, None if timer is None or timer < passed else timer)
        if parents:
            yield pd.DataFrame(parents, columns=self.columns, dtype=object)

    def close(self) -> None:
        pass

    def _parent(self, name: str, status: str, delivery: list) -> tuple:
        expected, children = delivery[0], list(delivery[3].values())
        failed = [c for c in children if not c[0]]
        missing = max(0, expected - len(children))

        def agreed(place: int) -> str | None:
            values = {c[place] for c in failed if c[place] is not None}
            return values.pop() if len(values) == 1 else None

        retry = agreed(2)
        return (
            name,
            status,
            not failed and not missing,
            expected,
            missing,
            len(children),
            len(children) - len(failed),
            len(failed),
            max(c[1] for c in children),
            None if retry is None else retry == "retryable",
            agreed(3),
            agreed(4),
        )


def stream_fanout(
    children: DataFrame,
    keys: Sequence[str],
    event_time: str = "at",
    timeout: str = "1 hour",
    delay: str = "10 minutes",
    buckets: int = BUCKETS,
) -> DataFrame:
    """A parent receipt for every delivery of a stream of child receipts.

    ``children`` has the columns of ``receipts.fanout`` and ``expected``, the number of
    destinations.  The parent has ``status``, ``complete`` or ``timed_out``, and ``missing``
    destinations; ``ok`` needs all of them.  Of receipts that repeat a destination the last
    counts.  The session needs the state store of ``ROCKS``.

    State is kept by bucket of the deliveries' hash, so a batch costs a read and a write for
    each bucket that it touches.  A bucket is text of its open and lately closed deliveries
    and has to fit a row: more deliveries within ``timeout`` want more ``buckets``.  Their
    number belongs to the stream's checkpoint and stays as it began.
    """
    spark = children.sparkSession
    spark.conf.set(STATE_STORE, ROCKS)
    micros = spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {timeout}) AS m").first().m

    def known(name: str):
        return F.when(F.col(name) != "unknown", F.col(name))

    names = F.struct(*keys)
    shaped = receipt_summary(children).select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        F.to_json(names, _EXACT).alias("delivery"),
        F.col(event_time).alias("at"),
        F.unix_millis(event_time).alias("ms"),
        F.col("expected").cast("int").alias("expected"),
        F.col("destination").cast("string").alias("destination"),
        "ok",
        F.col("attempt_count").cast("int").alias("attempts"),
        F.when(
            F.col("failure_retryability").isin("retryable", "non_retryable"),
            F.col("failure_retryability"),
        ).alias("retry"),
        known("shared_failure_kind").alias("kind"),
        known("shared_error_code").alias("code"),
    )
    parent = T._parse_datatype_string(f"delivery string, {_PARENT}")
    closed = (
        shaped.withWatermark("at", delay)
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=_Deliveries(parent.names, micros // 1000),
            outputStructType=parent,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    key_type = children.select(names.alias("k")).schema["k"].dataType
    found = F.from_json("delivery", key_type, _EXACT)
    return closed.select(
        *[found[f.name].alias(f.name) for f in key_type.fields], *parent.names[1:]
    )
