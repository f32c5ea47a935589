"""Fact-to-fact joins of the trade layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermill import schemas
from rivermill.config import JOIN_RETENTION, JOIN_RETENTION_MS, PAY_AFTER, PAY_BEFORE
from rivermill.operators import skew, upsert
from rivermill.operators.skew import Arrival
from rivermill.streaming import processors


def order_facts(
    details: DataFrame,
    infos: DataFrame,
    activities: DataFrame,
    coupons: DataFrame,
    arrival: Arrival,
) -> DataFrame:
    """Order lines with their order, activity and coupon: the upserted table, one row per line id.

    All inputs carry the ``arrival`` columns. Each is first reduced to its latest row per key with
    map-side pruning. The three inputs keyed by line id then join on one shared partitioning, and
    only the join to the order, where one order may own very many lines, splits hot keys.
    """
    order = arrival.order
    line = upsert.latest(details, ["id"], order)
    activity = upsert.latest(activities, ["id"], order).drop(*order)
    coupon = upsert.latest(coupons, ["id"], order).drop(*order)
    info = upsert.latest(infos, ["id"], order).drop(*order).withColumnRenamed("id", "order_id")
    lines = line.join(activity, "id", "left").join(coupon, "id", "left")
    joined = skew.equi_join(
        lines, info, ["order_id"], right_unique=True, rows_per_task=arrival.rows_per_task,
        left_counted=details,
    )
    return joined.select(*dict.fromkeys([*schemas.ORDER_FACT_COLUMNS, *order]))


def order_changelog(
    details: DataFrame,
    infos: DataFrame,
    activities: DataFrame,
    coupons: DataFrame,
    arrival: Arrival,
    retention_ms: int | None = JOIN_RETENTION_MS,
) -> DataFrame:
    """Every change of the joined order lines: early rows, retractions and corrected rows.

    A line comes out as soon as its order is known, without activity and coupon if they are not there yet. Each later row that
    changes it sends a retraction (``op`` is ``retract``, with the columns sent before) and the new row (``reinsert``). ``version`` numbers
    what was sent of a line, from 0; the arrival columns are those of the row that caused it. Rows that change nothing send nothing.
    The last row of each line that is no retraction is the row of :func:`order_facts`.

    All inputs carry the arrival columns. On a stream a line, its order, activity and coupon meet as long as their state is
    alive: ``retention_ms`` of processing time since it was last used, or for ever where the arrival is ``finite``. In batch
    state never expires; a line and what belongs to it are few rows, so one window per line id gives the same changes.
    """
    order = list(arrival.order)

    def slot(df: DataFrame, name: str, order_id: Column) -> DataFrame:
        value = F.to_json(F.struct(*_fields(df, name)))
        return df.select("id", order_id.alias("order_id"), F.lit(name).alias("slot"), value.alias("value"), *order)

    nothing = F.lit(None).cast("string")
    lines = slot(details, "line", F.col("order_id"))
    records = slot(infos, "info", F.col("id")).withColumn("id", nothing)
    others = slot(activities, "activity", nothing).unionByName(slot(coupons, "coupon", nothing))
    if details.isStreaming:
        rows = lines.unionByName(records).unionByName(others)
        changes = processors.fact_changes(rows, order, None if arrival.finite else retention_ms)
    else:
        owners = lines.filter(F.col("id").isNotNull()).select("id", "order_id").distinct()
        # Orders are counted on the lines as they come: owners, which are fewer, would be shuffled once more for it.
        records = skew.equi_join(
            owners, records.drop("id"), ["order_id"], rows_per_task=arrival.rows_per_task, left_counted=lines
        )
        keyed = lines.filter(F.col("order_id").isNotNull()).unionByName(others).unionByName(records)
        changes = _changes_in_batch(keyed.filter(F.col("id").isNotNull()), order)
    return _typed_changes(changes, {"line": details, "info": infos, "activity": activities, "coupon": coupons}, order)


def _fields(df: DataFrame, slot: str) -> list[str]:
    """The columns of order facts that a slot's rows bring; an arrival column of the same name belongs to the line."""
    own = ("id", "ts") if slot != "line" else ("id",)
    return [c for c in schemas.ORDER_FACT_COLUMNS if c in df.columns and c not in own]


def _changes_in_batch(rows: DataFrame, order: list[str]) -> DataFrame:
    """What the stateful form sends for rows (id, slot, value, ``order``), from running last values."""
    number = F.array_position(F.array(*[F.lit(s) for s in processors.SLOTS]), F.col("slot"))
    by_arrival = Window.partitionBy("id").orderBy(*order, number)
    so_far = by_arrival.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [
        F.last(F.when(F.col("slot") == slot, F.col("value")), ignorenulls=True).over(so_far).alias(slot)
        for slot in processors.SLOTS
    ]
    known = rows.select("id", *order, number.alias("_slot"), F.struct(*last).alias("now"))
    whole = F.col("now.info").isNotNull() & F.col("now.line").isNotNull()
    again = Window.partitionBy("id").orderBy(*order, "_slot")
    seen = known.filter(whole).withColumn("before", F.lag("now").over(again))
    changed = seen.filter(F.col("before").isNull() | (~F.col("now").eqNullSafe(F.col("before"))))
    sent = changed.withColumn("_nth", F.row_number().over(again).cast("long") - 1)

    def row(op: Column, version: Column, fact: str) -> Column:
        return F.struct(op.alias("op"), version.alias("version"), F.col(fact).alias("fact"))

    nth = F.col("_nth")
    first = F.array(row(F.lit(processors.INSERT), nth, "now"))
    later = F.array(
        row(F.lit(processors.RETRACT), nth * 2 - 1, "before"), row(F.lit(processors.REINSERT), nth * 2, "now")
    )
    rows_sent = sent.select("id", *order, F.explode(F.when(nth == 0, first).otherwise(later)).alias("sent"))
    return rows_sent.select("id", "sent.op", "sent.version", "sent.fact.*", *order)


def _typed_changes(changes: DataFrame, inputs: dict[str, DataFrame], order: list[str]) -> DataFrame:
    """The slots' texts as the columns of order facts."""
    columns = {"id": F.col("id")}
    for slot, df in inputs.items():
        fields = _fields(df, slot)
        changes = changes.withColumn(slot, F.from_json(slot, T.StructType([df.schema[c] for c in fields])))
        columns |= {c: F.col(slot)[c] for c in fields}
    chosen = [columns[c].alias(c) for c in schemas.ORDER_FACT_COLUMNS]
    return changes.select("op", "version", *chosen, *[c for c in order if c not in schemas.ORDER_FACT_COLUMNS])


def fold_changelog(changes: DataFrame, arrival: Arrival) -> DataFrame:
    """The table that a changelog of facts leaves: the last row of each line, unless that is a retraction."""
    kept = upsert.latest_live(changes, ["id"], ["version"], F.col("op") == processors.RETRACT)
    return kept.select(*dict.fromkeys([*schemas.ORDER_FACT_COLUMNS, *arrival.order]))


def order_facts_stream(
    details: DataFrame,
    infos: DataFrame,
    activities: DataFrame,
    coupons: DataFrame,
    retention: str = JOIN_RETENTION,
) -> DataFrame:
    """Streaming form: rows match when their ``row_time`` is within ``retention`` of the line's.

    Every input has a watermarked ``row_time``. A line without activity or coupon comes out once,
    with nulls, when the watermark shows that none can follow; there are no retractions.
    """
    def near(other: str) -> str:
        return (
            f"{other}_time between row_time - interval {retention} "
            f"and row_time + interval {retention}"
        )

    def side(df: DataFrame, name: str, key: str) -> DataFrame:
        return df.withColumnRenamed("row_time", f"{name}_time").withColumnRenamed(key, f"{name}_key")

    info, activity, coupon = side(infos, "oi", "id"), side(activities, "oda", "id"), side(coupons, "odc", "id")
    joined = (
        details.join(info, F.expr(f"order_id = oi_key and {near('oi')}"), "inner")
        .join(activity, F.expr(f"id = oda_key and {near('oda')}"), "left")
        .join(coupon, F.expr(f"id = odc_key and {near('odc')}"), "left")
    )
    return joined.select(*schemas.ORDER_FACT_COLUMNS, "row_time")


def paid_lines(
    payments: DataFrame,
    lines: DataFrame,
    before: str = PAY_BEFORE,
    after: str = PAY_AFTER,
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """Interval join: payments between ``before`` earlier and ``after`` later than the line.

    Time is cut into slots as long as the interval, and a line is repeated in the one or two slots
    its interval touches. The join key is order and slot, so a hot order compares only rows that
    are near in time; slots that are still hot are salted. Streams join on the interval itself,
    which also bounds their state.
    """
    p = payments.select(
        "order_id",
        F.col("user_id").alias("p_user_id"),
        "payment_type",
        F.col("callback_time").alias("payment_time"),
        F.col("ts").alias("p_ts"),
        F.col("row_time").alias("p_time"),
    )
    od = lines.drop("user_id", "ts")
    low = F.col("row_time") - F.expr(f"interval {before}")
    high = F.col("row_time") + F.expr(f"interval {after}")
    if payments.isStreaming or lines.isStreaming:
        p = p.withColumnRenamed("order_id", "p_order_id")
        within = (F.col("p_order_id") == F.col("order_id")) & F.col("p_time").between(low, high)
        joined = p.join(od, within, "inner")
    else:
        span = F.expr(
            f"unix_micros(timestamp'1970-01-01' + interval {before} + interval {after})"
            " - unix_micros(timestamp'1970-01-01')"
        )
        slots = F.sequence(F.floor(F.unix_micros(low) / span), F.floor(F.unix_micros(high) / span))
        p = p.withColumn("_slot", F.floor(F.unix_micros("p_time") / span))
        od = od.filter(F.col("row_time").isNotNull()).withColumn("_slot", F.explode(slots))
        joined = skew.equi_join(p, od, ["order_id", "_slot"], rows_per_task=rows_per_task)
        joined = joined.filter(F.col("p_time").between(low, high)).drop("_slot")
    return joined.withColumnRenamed("p_user_id", "user_id").withColumnRenamed("p_ts", "ts")
