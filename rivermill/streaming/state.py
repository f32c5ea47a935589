"""Streaming forms of the per-key rules, on Spark's keyed state with its own expiry.

A key's rows of one micro-batch are put in arrival order and taken one by one; the state is a row of a few scalars. Expiry counts
from processing time and, as in the rules' source, from the last write. A replay that stops at the end of its input (a
``finite`` arrival) keeps all state, as Spark's expiry would keep such a query running.

Order holds inside a micro-batch. Where rows may come later than others of their key that follow them, let :func:`in_order` go
before a rule: it holds rows until the watermark has passed them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivermill.config import DAILY_TTL_MS, DAY_MS, DELTA_TTL_MS, RETURN_AFTER_MS
from rivermill.functions import times
from rivermill.operators.skew import Arrival

# A rule takes a row and the key's live state, and gives the columns it adds or replaces (None drops the row) and the
# state to write (None leaves it, and its expiry, as it is).
Rule = Callable[[Row, tuple | None], tuple[dict[str, Any] | None, tuple | None]]


def arrival_key(names: Sequence[str]) -> Callable[[Row], tuple]:
    """Sort key of rows by columns, null first."""
    return lambda row: tuple((row[c] is not None, row[c]) if row[c] is not None else (False,) for c in names)


class KeyedRule(StatefulProcessor):
    def __init__(self, rule: Rule, order: Sequence[str], state_type: T.StructType, ttl_ms: int | None, names: list[str]):
        self.rule, self.order, self.names = rule, tuple(order), names
        self.state_type, self.ttl_ms = state_type, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.state_type, self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        out = Row(*self.names)
        live, stored = tuple(self.state.get()) if self.state.exists() else None, None
        for row in sorted(rows, key=arrival_key(self.order)):
            added, new = self.rule(row, live)
            if new is not None:
                live = stored = new
            if added is not None:
                yield out(*[added[c] if c in added else row[c] for c in self.names])
        if stored is not None:
            self.state.update(stored)

    def close(self) -> None:
        pass


def run_rule(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Arrival,
    rule: Rule,
    added: Sequence[T.StructField],
    state_type: T.StructType,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Applies ``rule`` per key; output has the columns of ``df`` and the ``added`` ones."""
    kept = [f for f in df.schema.fields if f.name not in {a.name for a in added}]
    out_type = T.StructType([*kept, *added])
    expiring = None if arrival.finite else ttl_ms
    processor = KeyedRule(rule, arrival.order, state_type, expiring, out_type.fieldNames())
    mode = "ProcessingTime" if expiring else "None"
    return df.groupBy(*keys).transformWithState(processor, out_type, "Append", mode)


class InOrder(StatefulProcessor):
    """Holds a key's rows until the watermark has passed their event time, then lets them out in arrival order."""

    def __init__(self, order: Sequence[str], schema: T.StructType):
        self.order, self.schema = tuple(order), schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        came = list(rows)
        self.held.appendList([tuple(r) for r in came])
        # One timer a key, at its earliest row.
        first = min(r["_ms"] for r in came)
        waiting = list(self.handle.listTimers())
        if not waiting or first < min(waiting):
            for timer in waiting:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        rows = [Row(*self.schema.fieldNames())(*r) for r in self.held.get()]
        due = [r for r in rows if r["_ms"] <= passed]
        late = [r for r in rows if r["_ms"] > passed]
        if late:
            self.held.put([tuple(r) for r in late])
            self.handle.registerTimer(min(r["_ms"] for r in late))
        else:
            self.held.clear()
        yield from sorted(due, key=arrival_key(self.order))

    def close(self) -> None:
        pass


def in_order(df: DataFrame, keys: Sequence[str], arrival: Arrival, event_time: str = "row_time") -> DataFrame:
    """Rows of a stream, those of a key in arrival order across micro-batches, once the watermark has passed them.

    ``df`` is watermarked on ``event_time``, which must not run against the arrival order within a key. Rows later than the
    watermark allows are dropped. Rows come out with their event time, so that rules and windows can follow.
    """
    timed = df.filter(F.col(event_time).isNotNull()).withColumn("_ms", F.unix_millis(event_time))
    processor = InOrder(arrival.order, timed.schema)
    held = timed.groupBy(*keys).transformWithState(
        processor, timed.schema, "Append", "EventTime", eventTimeColumnName=event_time
    )
    return held.drop("_ms")


def _dated(df: DataFrame, ts: str) -> DataFrame:
    """Day number and local midnight computed by Spark, so that Python needs no time zone."""
    day = times.ms_to_day(ts)
    return df.withColumn("_day", F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint"))


_DAY_STATE = T.StructType([T.StructField("day", T.LongType())])


def _flag(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _repair(flag: str, row: Row, live: tuple | None):
    says_new = row[flag] == "1"
    stored = None
    if live is None:
        live = stored = (row["_day"] if says_new else row["_before"],)
    return {flag: "0"} if says_new and row["_day"] != live[0] else {}, stored


def repair_new_visitors(df: DataFrame, arrival: Arrival, key: str, flag: str, ts: str) -> DataFrame:
    dated = _dated(df, ts).withColumn("_shifted", F.col(ts) - DAY_MS)
    day_before = F.datediff(times.ms_to_day("_shifted"), F.lit("1970-01-01").cast("date"))
    dated = dated.withColumn("_before", day_before.cast("bigint")).drop("_shifted")
    result = run_rule(dated, [key], arrival, partial(_repair, flag), [], _DAY_STATE)
    return result.drop("_day", "_before")


def _daily(out: str, row: Row, live: tuple | None):
    # The state is written on a change of day only: its expiry must not move otherwise.
    new = live is None or live[0] != row["_day"]
    return {out: int(new)}, (row["_day"],) if new else None


def daily_first(
    df: DataFrame, arrival: Arrival, keys: Sequence[str], out: str, ts: str
) -> DataFrame:
    rule = partial(_daily, out)
    flagged = run_rule(_dated(df, ts), keys, arrival, rule, [_flag(out)], _DAY_STATE, DAILY_TTL_MS)
    return flagged.drop("_day")


def _login(ts: str, row: Row, live: tuple | None):
    stored = (row["_day"], row["_midnight"])
    if live is not None and live[0] == row["_day"]:
        return None, stored
    back = live is not None and row[ts] - live[1] > RETURN_AFTER_MS
    return {"back_ct": int(back), "uu_ct": 1}, stored


def unique_and_returning(df: DataFrame, arrival: Arrival, key: str, ts: str) -> DataFrame:
    dated = _dated(df, ts).withColumn("_midnight", times.midnight_ms(times.ms_to_day(ts)))
    stored = T.StructType([*_DAY_STATE.fields, T.StructField("midnight", T.LongType())])
    added = [_flag("back_ct"), _flag("uu_ct")]
    return run_rule(dated, [key], arrival, partial(_login, ts), added, stored).drop("_day", "_midnight")


def _delta(names: Sequence[str], row: Row, live: tuple | None):
    before = live or (Decimal(0),) * len(names)
    return {name: row[name] - b for name, b in zip(names, before, strict=True)}, tuple(row[name] for name in names)


def amount_deltas(df: DataFrame, arrival: Arrival, names: Sequence[str], key: str) -> DataFrame:
    money = T.DecimalType(38, 2)
    added = [T.StructField(name, money) for name in names]
    stored = T.StructType([T.StructField(name, money) for name in names])
    return run_rule(df, [key], arrival, partial(_delta, list(names)), added, stored, DELTA_TTL_MS)
