"""Mixing of sources to target weights by pivotal dependent rounding (DataFrame functions only).

Each document of a source with target ``t`` and size total ``s`` is due ``t / s`` copies: whole copies outright, the
fraction as a probability. Two fractional documents are paired: words move from one to the other until one of the two is
whole, in the random direction that keeps both expectations. The open document meets the next one. Words are kept in
every pairing, so a source takes its target up to one document's size. Groups of ``FAN_IN`` documents are folded alone and
leave at most one open document each; those meet in the next level of the tree, so that no task holds more than a group,
however large the source is.

Defined cases: a null text has size 0 and takes 0 words; a null source is a source of its own, last in order; a null
doc_id is an id like any other; repeated rows are rounded each on its own, and identical rows are interchangeable; an
empty table gives no rows. The draw depends on the seed, ids and sizes alone, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.llm.common import cut, uniform, word_count

FAN_IN = 48
SEED = 20_011


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size and target, one row per source.

    ``sizes``: source and source_size. Sources in code point order take ``weights`` in turn and share ``share`` of all
    words; a target stops at ``most`` times its source's size, and the rest is shared again by weight. That ends where
    every target is the lower of its stop and its weight times one common level: sources sorted by the level at which
    they stop give that level from running sums. One task sees one row per source.
    """
    whole = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_n") - 1, F.lit(len(weights))).cast("int") + 1)
    named = sizes.withColumn("_n", F.row_number().over(by_name)).withColumn("_w", weight)
    stop = F.col("source_size") * F.lit(float(most))
    by_stop = Window.partitionBy().orderBy("_stop_level", "_n").rowsBetween(Window.unboundedPreceding, -1)
    levelled = (
        named.withColumn("_stop", stop)
        .withColumn("_stop_level", F.col("_stop") / F.col("_w"))
        .withColumn("_left", F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("_stop").over(by_stop), F.lit(0.0)))
        .withColumn("_weight", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(by_stop), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_weight"))
    )
    # The first source in this order that does not stop sets the level for itself and all after it.
    level = F.min(F.when(F.col("_level") <= F.col("_stop_level"), F.struct("_stop_level", "_n", "_level"))).over(whole)
    target = F.least(F.col("_stop"), F.coalesce(F.col("_w") * level["_level"], F.col("_stop")))
    return levelled.select("source", "source_size", target.alias("target"))


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _fold(units: Column, seed: int) -> Column:
    """Folds an array of open units (doc_id, size, base, words) into ``done`` units and at most one ``open`` one.

    ``words`` is the fractional part of the unit's due words, between 0 and its size.
    """
    unit = "struct<doc_id:bigint,size:bigint,base:bigint,words:double>"
    done_type = "array<struct<doc_id:bigint,size:bigint,copies:bigint>>"

    def done(x: Column, extra: int) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), (x["base"] + extra).alias("copies"))

    def still(x: Column, words: Column) -> Column:
        return F.struct(
            x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["base"].alias("base"), words.alias("words")
        )

    def pair(a: Column, b: Column) -> Column:
        up = F.least(a["size"] - a["words"], b["words"])  # words that can move from b to a
        down = F.least(a["words"], b["size"] - b["words"])
        draw = uniform(seed, a["doc_id"], a["size"], b["doc_id"], b["size"])
        go_up = draw * (up + down) < down
        both = a["words"] + b["words"]
        rose = F.when(
            a["size"] - a["words"] <= b["words"],
            F.struct(still(b, both - a["size"]).alias("open"), done(a, 1).alias("done")),
        ).otherwise(F.struct(still(a, both).alias("open"), done(b, 0).alias("done")))
        fell = F.when(
            a["words"] <= b["size"] - b["words"],
            F.struct(still(b, both).alias("open"), done(a, 0).alias("done")),
        ).otherwise(F.struct(still(a, both - b["size"]).alias("open"), done(b, 1).alias("done")))
        return F.when(go_up, rose).otherwise(fell)

    def step(acc: Column, x: Column) -> Column:
        met = _let(
            pair(acc["open"], x),
            lambda p: F.struct(p["open"].alias("open"), F.concat(acc["done"], F.array(p["done"])).alias("done")),
        )
        first = F.struct(still(x, x["words"]).alias("open"), acc["done"].alias("done"))
        return F.when(acc["open"].isNull(), first).otherwise(met)

    start = F.struct(F.lit(None).cast(unit).alias("open"), F.array().cast(done_type).alias("done"))
    return F.aggregate(units, start, step)


def _close(seed: int) -> Column:
    """The last open unit of a source becomes whole with the probability of its fraction."""
    up = uniform(seed + 1, F.col("open.doc_id"), F.col("open.size")) * F.col("open.size") < F.col("open.words")
    return F.col("open.base") + up.cast("long")


def mix(units: DataFrame, goals: DataFrame, seed: int = SEED, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every unit.

    ``units``: doc_id, source, size; ``goals``: result of :func:`targets`. Sources are dealt over groups by a hash of
    the unit, so one source may hold most rows.
    """
    spark = units.sparkSession
    order = [F.xxhash64(F.lit(seed), "doc_id", "size").alias("_h")]
    goals = cut(goals)
    due = units.join(goals, units["source"].eqNullSafe(goals["source"])).select(
        units["source"], "doc_id", "size", "source_size", "target",
        # The share first: it is at most ``most`` exactly, so that no document is due more, however large the totals.
        (F.col("size") * (F.col("target") / F.col("source_size"))).alias("_due"), *order,
    )
    base = F.when(F.col("size") > 0, F.floor(F.col("_due") / F.col("size"))).otherwise(0)
    due = due.withColumn("base", base.cast("long"))
    due = due.withColumn("words", F.greatest(F.lit(0.0), F.col("_due") - F.col("base") * F.col("size")))
    keys = ["source", "source_size", "target"]
    whole = due.filter("size = 0 or words <= 0 or words is null").select(
        *keys, "doc_id", "size", F.col("base").alias("copies")
    )
    open_units = due.filter("size > 0 and words > 0").select(*keys, "_h", F.struct("doc_id", "size", "base", "words").alias("unit"))

    most = goals.agg(F.max("units")).first()[0] if "units" in goals.columns else units.count()
    groups = max(1, math.ceil((most or 1) / fan_in))
    parts = [whole]
    while True:
        # Groups follow the hash order of the units, so that a level is a plain grouping with small lists.
        group = F.pmod(F.shiftrightunsigned("_h", 8), F.lit(groups))
        folded = (
            open_units.groupBy(*keys, group.alias("_g"))
            .agg(F.array_sort(F.collect_list(F.struct("_h", "unit"))).alias("_units"))
            .select(*keys, "_g", _fold(F.transform("_units", lambda u: u["unit"]), seed).alias("_f"))
        )
        folded = cut(folded.select(*keys, "_g", "_f.open", "_f.done"))
        parts.append(folded.select(*keys, F.inline("done")))
        if groups == 1:
            parts.append(folded.select(*keys, "open.doc_id", "open.size", _close(seed).alias("copies")))
            break
        # Open units of neighbouring groups meet: the next hash is a hash of the group.
        open_units = folded.select(*keys, F.xxhash64(F.lit(seed), "_g").alias("_h"), F.col("open").alias("unit"))
        groups = math.ceil(groups / fan_in)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*keys, "doc_id", "size", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = SEED
) -> DataFrame:
    """source, source_size, target, doc_id, size, copies and taken of every document; texts are read once."""
    units = cut(docs.select(F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size")))
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("units"))
    goals = targets(sizes, weights, share, most).join(sizes.select(F.col("source").alias("_s"), "units"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return mix(units, goals, seed)


def _key(doc_id: Column, size: Column) -> list[Column]:
    """A row's name and size without nulls, so that a window and an equal join over them ask for the same shuffle."""
    return [F.coalesce(doc_id, F.lit(0)).alias("_id"), doc_id.isNull().alias("_nameless"), size.alias("_size")]


def take(docs: DataFrame, **setting) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns alone; texts are shuffled once."""
    columns, key = docs.columns, ["_id", "_nameless", "_size"]
    copies = mixed(docs, **setting).select(*_key(F.col("doc_id"), F.col("size")), "copies")
    held = copies.groupBy(*key).agg(F.array_sort(F.collect_list("copies")).alias("_copies"))
    rows = docs.select(
        F.struct(*[docs[c] for c in columns]).alias("_doc"), *_key(docs["doc_id"].cast("long"), word_count(docs["text"]))
    )
    # Numbered before they are joined: the window's shuffle and order serve the join as well.
    numbered = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy("_doc")))
    times = F.element_at("_copies", F.col("_nth"))
    repeated = numbered.join(held, key).select("_doc", times.cast("int").alias("_times")).filter("_times > 0")
    return repeated.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).select("_doc.*")
