"""Quality rules with risk-controlled thresholds (DataFrame functions only).

A rule rejects a document whose score exceeds the cutoff of its stratum. Labelled documents are split by a hash of their
id. One half proposes: on a fixed grid, each rule's cutoff with the best balance of rejected bad and good documents,
the most lenient of equals, and none if no cutoff rejects enough bad ones. The other half certifies: a path of ``PATH`` steps
leads all rules of a stratum together from rejecting nothing to the proposed cutoffs, and each step is tested against the
hypothesis "the rules together reject more than ``risk`` of the good documents of the stratum" with the exact binomial tail.
The tests of a stratum run in this fixed order and end at the first failure, so only strata share the error ``delta``
(Bonferroni), and rules share no risk. So with probability 1 - ``delta`` no stratum loses more than ``risk`` of its good
documents to the method. The certified step with the best balance on the certifying half is used. Where no step is
certified, or none rejects enough bad documents, nothing is rejected. Without a single false rejection, certifying takes
log(delta / strata) / log(1 - risk) good labels in that half: 144 with four strata.

Defined cases: a null text has no words (base rule fails); a null stratum is a stratum of its own; labels that are null or
whose document is missing are ignored; a document labelled twice counts as bad if any label says so; in strata without
cutoffs only the base rule rejects. Repeated rows are judged alike; with labels they count once per row. Without labels only
the base rule works. The number of strata has no limit: cutoffs are a
table that goes to every task if it is small, and is shuffled beyond ``NEAR`` rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.llm.common import WORD, cut, kept

SYMBOLS = "#*$%&|<>"
TAIL_TERMS = 4096


@dataclass(frozen=True)
class Risk:
    """``risk``: highest share of good documents rejected per stratum; ``delta``: chance that any stratum exceeds it."""

    risk: float = 0.03
    delta: float = 0.05
    good_weight: float = 4.0  # rejected good documents weigh so much against rejected bad ones


#: Scores of the rules, as SQL over the measures: each grows with worse quality and lies in [0, 1].
RULES = {
    "symbols": "least(1D, n_symbols / greatest(1L, n_words))",
    "capitals": "n_capitals / greatest(1L, n_capitals + n_small)",
    "marks": "least(1D, n_marks / greatest(1L, n_words))",
    "lines": "n_dup_lines / greatest(1L, n_lines)",
    "repeats": "n_repeat_words / greatest(1L, n_words)",
}
#: Cutoffs from the most lenient on: cutoff i rejects scores above (STEPS - i) / STEPS.
STEPS = 40
#: Steps from rejecting nothing to the proposed cutoffs.
PATH = 8
#: Tables of strata of at most so many rows, which are counted first, go to every task; larger ones are shuffled.
NEAR = 100_000


def _count(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, "")).cast("long")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, window: int = 5) -> Column:
    """Number of words inside ``window``-word windows found twice or more among ``words``.

    Window hashes are sorted with their places; equal neighbours, compared word by word, mark their places.
    """

    def marked(sorted_windows: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            equal = F.slice(words, a["at"], window) == F.slice(words, b["at"], window)
            return (a["h"] == b["h"]) & equal

        size = F.size(sorted_windows)
        hit = F.filter(
            sorted_windows,
            lambda x, i: (
                ((i > 0) & same(F.get(sorted_windows, i - 1), x))
                | ((i < size - 1) & same(x, F.get(sorted_windows, i + 1)))
            ),
        )
        return F.array_sort(F.transform(hit, lambda x: x["at"]))

    def covered(places: Column) -> Column:
        gaps = F.zip_with(
            places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))),
            lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (window - 1)),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(window)]).alias("h"), i.alias("at")),
    )
    counted = _let(F.array_sort(windows), lambda s: _let(marked(s), covered))
    return F.when(F.size(words) > window, counted).otherwise(0).cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures of every text: words, their code points, symbols, lines, repeats, letters."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD))
    return (
        docs.withColumns({"_words": words, "_lines": lines})
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": _count(body, r"[\x20\x09-\x0D]+"),
                "n_symbols": _count(body, f"[^{SYMBOLS}]+"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": repeated_words(F.col("_words")),
                "n_capitals": _count(body, "[^A-Z]+"),
                "n_small": _count(body, "[^a-z]+"),
                "n_marks": _count(body, "[^!?=~^_]+"),
            }
        )
        .drop("_words", "_lines")
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n)


def _bins() -> list[Column]:
    """For each rule the first cutoff, counted from the lenient end, that rejects the row: 1 to STEPS + 1 (none)."""
    score = [F.coalesce(F.expr(sql), F.lit(0.0)) for sql in RULES.values()]
    return [(F.lit(STEPS + 1) - F.ceil(s * STEPS)).cast("int").alias(f"_{name}") for name, s in zip(RULES, score)]


def _log_gamma(x: Column) -> Column:
    """log Gamma(x) for x >= 1: Stirling's series at x + 8, taken back by the recurrence."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi)
    series = series + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    return series - reduce(lambda a, b: a + b, [F.log(x + k) for k in range(8)])


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exact up to rounding for k < n p, else 1.

    The largest ``TAIL_TERMS`` terms are summed downwards from k; what is left is bounded by a geometric series.
    """
    k, n, odds = k.cast("double"), n.cast("double"), (1 - p) / p
    log_top = (
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    walked = F.aggregate(
        F.sequence(F.lit(0), F.least(k, F.lit(TAIL_TERMS)).cast("int")),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total")),
        lambda acc, j: F.struct(
            (acc["term"] * (k - j) / (n - k + j + 1) * odds).alias("term"), (acc["total"] + acc["term"]).alias("total")
        ),
    )
    ratio = k / (n - k + 1) * odds
    total = _let(walked, lambda w: w["total"] + w["term"] / F.greatest(1 - ratio, F.lit(1e-12)))
    return F.when(k < n * p, F.least(F.lit(1.0), F.exp(log_top) * total)).otherwise(1.0)


def _by_size(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= NEAR else table


def _proposed(half: DataFrame, setting: Risk) -> DataFrame:
    """One row per stratum of ``half`` with each rule's cutoff as ``_at_<rule>``, null for none.

    Rows are summed per stratum, rule and bin before anything else, so the work after the sum does not grow with them.
    """
    rules = F.map_from_arrays(F.array(*[F.lit(r) for r in RULES]), F.array(*[F.col(f"_{r}") for r in RULES]))
    summed = half.select("_stratum", "good", F.explode(rules).alias("rule", "bin")).groupBy("_stratum", "rule", "bin").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    # A row of bin b is rejected by the cutoffs from b on, counted from the lenient end: at most STEPS rows a window.
    so_far = Window.partitionBy("_stratum", "rule").orderBy("bin")
    worth = F.sum(F.col("bad") - setting.good_weight * F.col("good")).over(so_far)
    best = (
        summed.filter(F.col("bin") <= STEPS).withColumn("worth", worth).filter("worth > 0")
        .groupBy("_stratum", "rule").agg(F.max(F.struct("worth", (-F.col("bin")).alias("at"))).alias("best"))
    )
    return best.groupBy("_stratum").agg(*[F.max(F.when(F.col("rule") == r, -F.col("best.at"))).alias(f"_at_{r}") for r in RULES])


def thresholds(labelled: DataFrame, stratum: str, setting: Risk = Risk()) -> DataFrame:
    """One row per stratum with certified cutoffs: for each rule the one in use as ``_cut_<rule>``, null for none.

    ``labelled``: doc_id, measures, ``stratum`` and ``good`` (boolean), one row per labelled document.
    """
    binned = cut(labelled.select(
        F.col(stratum).alias("_stratum"), "good", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("_proposes"), *_bins()
    ))
    proposed = cut(_proposed(binned.filter("_proposes"), setting))
    strata = max(1, proposed.count())
    names = _by_size(proposed.withColumnRenamed("_stratum", "_name"), strata)
    holdout = binned.filter("not _proposes").join(names, F.col("_stratum").eqNullSafe(F.col("_name")))
    # At step j a rule's cutoff is ceil(at * j / PATH): the first step that rejects a row, PATH + 1 or more for none.
    step = F.least(*[F.coalesce(F.floor((F.col(f"_{r}") - 1) * PATH / F.col(f"_at_{r}")) + 1, F.lit(PATH + 1)) for r in RULES])
    summed = holdout.groupBy("_stratum", F.least(step, F.lit(PATH + 1)).alias("step")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    whole = summed.groupBy("_stratum").agg(
        F.sum("good").alias("n"), F.collect_list(F.struct("step", "good", "bad")).alias("steps")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(PATH))).alias("at"))

    def rejected(field: str) -> Column:
        taken = F.filter("steps", lambda b: b["step"] <= F.col("at"))
        return F.aggregate(taken, F.lit(0).cast("long"), lambda total, b: total + b[field])

    fails = binomial_tail(F.col("rejected_good"), F.col("n"), setting.risk) > setting.delta / strata
    worth = F.col("rejected_bad") - setting.good_weight * F.col("rejected_good")
    best = (
        whole.withColumns({"rejected_good": rejected("good"), "rejected_bad": rejected("bad")})
        .withColumn("_failed", F.max(fails).over(Window.partitionBy("_stratum").orderBy("at")))
        .filter(~F.col("_failed") & (worth > 0))
        .groupBy("_stratum")
        .agg(F.max(F.struct(worth.alias("worth"), (-F.col("at")).alias("at"))).alias("best"))
    )
    used = best.join(names, F.col("_stratum").eqNullSafe(F.col("_name")))
    return used.select(
        "_stratum", *[F.ceil(F.col(f"_at_{r}") * -F.col("best.at") / PATH).cast("int").alias(f"_cut_{r}") for r in RULES]
    )


def labels_once(labels: DataFrame) -> DataFrame:
    """doc_id and good, one row per labelled document."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy(F.col("doc_id").alias("_label_id")).agg((F.min("quality") > 0).alias("good"))


def verdict(measured: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    """Adds ``base_failed`` and ``kept``. ``cuts`` has a row per stratum, kept as a table."""
    cuts = _by_size(cuts, cuts.count())
    joined = measured.join(cuts, measured[stratum].eqNullSafe(cuts["_stratum"]), "left")
    rejected = [
        F.coalesce(b <= F.col(f"_cut_{rule}"), F.lit(False)) for rule, b in zip(RULES, _bins(), strict=True)
    ]
    bad = reduce(lambda a, b: a | b, rejected)
    out = joined.withColumn("base_failed", base_failed())
    out = out.withColumn("kept", ~F.col("base_failed") & ~bad)
    return out.drop("_stratum", *[f"_cut_{rule}" for rule in RULES])


NARROW = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_small",
          "n_marks")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", setting: Risk = Risk()) -> DataFrame:
    """doc_id, stratum, measures, ``base_failed`` and ``kept`` of every document; texts are read once."""
    measured = cut(measures(docs.select("doc_id", stratum, "text")).select("doc_id", stratum, *NARROW))
    known = labels_once(labels)
    labelled = measured.join(known, measured["doc_id"] == known["_label_id"])
    return verdict(measured, cut(thresholds(labelled, stratum, setting)), stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", setting: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns alone.

    Rows are written once beside their measures, so that texts are measured once and none goes through a shuffle.
    """
    columns = docs.columns
    plain = docs.select(F.struct(*[docs[c] for c in columns]).alias("_doc"), docs[stratum].alias("_s"), docs["text"])
    measured = kept(measures(plain).select("_doc", "_s", *NARROW), "measures")
    narrow = measured.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_s").alias(stratum), *NARROW)
    known = labels_once(labels)
    labelled = narrow.join(known, narrow["doc_id"] == known["_label_id"])
    cuts = cut(thresholds(labelled, stratum, setting))
    return verdict(measured, cuts, "_s").filter("kept").select("_doc.*")
