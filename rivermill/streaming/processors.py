"""Stateful processors of the order join: early rows, retractions and corrected rows, with idle state dropped.

State is a few texts a key, held by Spark's state store with its own expiry. It expires after ``retention_ms`` without access,
by processing time; every access writes, and so renews, what it read. How far apart the event times are does not matter.
Without ``retention_ms`` state stays, as for a replay that stops at the end of its input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Slots of a fact, in the order in which rows of one moment count.
SLOTS = ("info", "line", "activity", "coupon")
INSERT, RETRACT, REINSERT = "insert", "retract", "reinsert"
PIECES = 16


def _nulls_first(value: Any) -> tuple:
    return (False,) if value is None else (True, value)


class _Ordered(StatefulProcessor):
    """Takes a key's rows of a micro-batch in arrival order, those of one moment by their slot."""

    def __init__(self, moment: Sequence[T.StructField], retention_ms: int | None) -> None:
        self.moment = list(moment)
        self.names = [f.name for f in moment]
        self.retention_ms = retention_ms

    def in_order(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda r: (*[_nulls_first(r[c]) for c in self.names], SLOTS.index(r["slot"])))

    def moment_of(self, row: Row) -> tuple:
        return tuple(row[c] for c in self.names)

    def close(self) -> None:
        pass


class OrderOfLines(_Ordered):
    """Keyed by order: hands every line on, and the order's record to each of its lines, whichever came first.

    The order's record keeps its own moment, so that all rows of a line can be put in order afterwards.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        stored = T.StructType([T.StructField("value", T.StringType()), *self.moment])
        self.info = handle.getValueState("info", stored, self.retention_ms)
        self.lines = handle.getMapState("lines", "id string", "known boolean", self.retention_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        out = Row("id", "slot", "value", *self.names)
        for row in self.in_order(rows):
            moment = self.moment_of(row)
            if row["slot"] == "info":
                self.info.update((row["value"], *moment))
                for (line,) in list(self.lines.keys()):
                    self.lines.updateValue((line,), (True,))
                    yield out(line, "info", row["value"], *moment)
                continue
            if self.info.exists():
                stored = tuple(self.info.get())
                self.info.update(stored)
                if not self.lines.containsKey((row["id"],)):
                    yield out(row["id"], "info", *stored)
            self.lines.updateValue((row["id"],), (True,))
            yield out(row["id"], "line", row["value"], *moment)


class FactChanges(_Ordered):
    """Keyed by line: the changelog of its fact, as soon as its line and order are known.

    A row that changes a fact already sent is sent as a retraction of the old fact and the new one; ``version`` counts what was sent.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        stored = ", ".join(f"{slot} string" for slot in SLOTS)
        self.slots = handle.getValueState("slots", f"{stored}, sent bigint", self.retention_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        out = Row("id", "op", "version", *SLOTS, *self.names)
        stored = tuple(self.slots.get()) if self.slots.exists() else (None,) * len(SLOTS) + (0,)
        now, sent = stored[:-1], stored[-1]
        for row in self.in_order(rows):
            at = SLOTS.index(row["slot"])
            before, now = now, (*now[:at], row["value"], *now[at + 1 :])
            if now[0] is None or now[1] is None or (sent and now == before):
                continue
            moment = self.moment_of(row)
            if sent:
                yield out(key[0], RETRACT, sent, *before, *moment)
                sent += 1
            yield out(key[0], REINSERT if sent else INSERT, sent, *now, *moment)
            sent += 1
        self.slots.update((*now, sent))


def _processed(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, fields: str, moment) -> DataFrame:
    mode = "None" if processor.retention_ms is None else "ProcessingTime"
    schema = T.StructType([*T.StructType.fromDDL(fields).fields, *moment])
    return df.groupBy(*keys).transformWithState(processor, schema, "Append", mode)


def fact_changes(rows: DataFrame, order: Sequence[str], retention_ms: int | None) -> DataFrame:
    """Changelog (id, op, version, the four slots, ``order``) of streamed rows (id, order_id, slot, value, ``order``).

    The lines of an order are spread over ``PIECES`` keys, to each of which its record goes, so that an order of very many lines
    is not the state of one task. Rows without their key are dropped.
    """
    moment = [rows.schema[c] for c in order]
    ofs = rows.filter(F.col("slot").isin("info", "line") & F.col("order_id").isNotNull())
    own = F.array(F.pmod(F.xxhash64("id"), F.lit(PIECES)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(PIECES - 1).cast("long"))
    dealt = ofs.withColumn("piece", F.explode(F.when(F.col("slot") == "info", every).otherwise(own)))
    fields = "id string, slot string, value string"
    joined = _processed(dealt, ["order_id", "piece"], OrderOfLines(moment, retention_ms), fields, moment)
    others = rows.filter(F.col("slot").isin("activity", "coupon")).select(*joined.columns)
    events = joined.unionByName(others).filter(F.col("id").isNotNull())
    slots = ", ".join(f"{slot} string" for slot in SLOTS)
    return _processed(events, ["id"], FactChanges(moment, retention_ms), f"id string, op string, version bigint, {slots}", moment)
