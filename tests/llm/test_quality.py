from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivermill.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
        n < 10 or 100 * len(repeated) > 20 * n,
    )


def test_base_measures(spark, odd_rows):
    texts = [r[1] for r in odd_rows] + [
        "a b c d e a b c d e", "a b c d e f a b c d e", "a a a a a a", "a a a a a", "1 2 3 4 5 6 1 2 3 4 5 6 7 1 2 3 4 5",
        "x\nx\n \n \ny\nx", "    a\x1cb \x85", "w " * 3000, "\n\n", "p q r s t u " * 2 + "v w x y z " * 3,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = quality.measures(df).withColumn("base_failed", quality.base_failed()).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 1, 0.5), (0, 300, 0.01), (3, 900, 0.02), (150, 20_000, 0.01), (9, 100, 0.2)])
def test_binomial_tail(spark, k, n, p):
    got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    assert got == pytest.approx(want, rel=1e-6)


def test_tail_of_many_rows_is_bounded(spark):
    got = spark.range(1).select(quality.binomial_tail(F.lit(9_900_000), F.lit(10**9), 0.01)).first()[0]
    assert 0 < got < 1e-200 or got == 0


@pytest.fixture(scope="module")
def corpus(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 5 == 0, F.lit("$$# " * 6 + words)).otherwise(F.lit(words)).alias("text"),
        F.when(F.col("id") < 5000, "en").when(F.col("id") < 5100, "few").alias("lang"),
        F.lit("kept").alias("n_words"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    return docs, labels


def test_thresholds_reject_bad_and_keep_good(corpus):
    docs, labels = corpus
    got = quality.judge(docs, labels).groupBy("lang", (F.col("doc_id") % 5 == 0).alias("bad"), "kept").count().collect()
    by = {(r.lang, r.bad, r.kept): r["count"] for r in got}
    assert by == {
        ("en", True, False): 1000, ("en", False, True): 4000,
        ("few", True, True): 20, ("few", False, True): 80,  # too few labels for a promise
        (None, True, False): 180, (None, False, True): 720,
    }
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4000 + 100 + 720


def test_texts_are_not_shuffled_for_their_labels(corpus, shuffled, monkeypatch):
    docs, labels = corpus
    seen, thresholds = [], quality.thresholds

    def watched(labelled, *rest):
        seen.append(columns(labelled))
        return thresholds(labelled, *rest)

    monkeypatch.setattr(quality, "thresholds", watched)
    with shuffled() as columns:
        assert quality.keep_good(docs, labels).count() == 4000 + 100 + 720
    assert seen[0] and not any({"text", "_doc"} & set(c) for c in seen[0])


def test_risk_is_held_when_labels_are_noise(spark, corpus):
    docs, _ = corpus
    noise = docs.select("doc_id", (F.xxhash64("doc_id") % 2 == 0).cast("int").alias("quality"))
    assert quality.judge(docs, noise).filter("not kept").count() == 0


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 1), (None, 1, 1), (3, None, None), (99, 0, 0)], LABELS)
    got = quality.judge(odd, labels)
    assert got.count() == odd.count() and got.filter("kept is null or base_failed is null").count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns
    none = spark.createDataFrame([], LABELS)
    assert quality.judge(nothing, none).count() == 0
    assert quality.keep_good(odd, none).count() == quality.judge(odd, none).filter("kept").count()


def test_cutoffs_equal_brute_force(spark):
    setting = quality.Risk(risk=0.1, delta=0.2, good_weight=2.0)
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.repeat(F.lit("$# "), (F.xxhash64("id") % 5 + 5).cast("int")),
            F.repeat(F.lit("HELLO "), (F.xxhash64(F.lit(1), "id") % 7 + 7).cast("int")),
            F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(25)), lambda i: F.concat(F.lit("w"), (F.col("id") + i).cast("string")))),
        ).alias("text"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("lang"),
    )
    measured = quality.measures(docs)
    noisy = F.when(F.xxhash64(F.lit(2), "doc_id") % 20 == 0, 1).otherwise(0)
    bad = (F.col("n_symbols") >= 14) & (noisy == 0)
    labelled = measured.withColumn("good", ~bad).cache()
    half = (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("proposes")
    rows = labelled.select("lang", "good", half, F.array(*quality._bins()).alias("bins")).collect()
    got = {r[0]: tuple(r)[1:] for r in quality.thresholds(labelled, "lang", setting).collect()}
    proposed = {}
    for lang in {r.lang for r in rows}:
        mine, at = [r for r in rows if r.lang == lang and r.proposes], []
        for rule in range(len(quality.RULES)):
            worth = {b: sum(-2.0 if r.good else 1 for r in mine if r.bins[rule] <= b) for b in {r.bins[rule] for r in mine}}
            best = [(w, -b) for b, w in worth.items() if b <= quality.STEPS and w > 0]
            at.append(-max(best)[1] if best else None)
        if any(at):
            proposed[lang] = at
    want = {}
    for lang, at in proposed.items():
        mine, best = [r for r in rows if r.lang == lang and not r.proposes], None
        n = sum(r.good for r in mine)
        for step in range(1, quality.PATH + 1):
            cuts = tuple(None if a is None else math.ceil(a * step / quality.PATH) for a in at)
            out = [r for r in mine if any(c is not None and b <= c for b, c in zip(r.bins, cuts))]
            k = sum(r.good for r in out)
            tail = sum(math.comb(n, i) * 0.1**i * 0.9 ** (n - i) for i in range(k + 1)) if k < n * 0.1 else 1
            if tail > 0.2 / len(proposed):
                break
            worth = len(out) - k - 2 * k
            if worth > 0 and (best is None or worth > best[0]):
                best = worth, cuts
        if best:
            want[lang] = best[1]
    assert got == want and len(want) >= 3


def test_every_stratum_gets_cutoffs(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(120 * 300).select(
        F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("host"),
        F.when(F.col("id").between(0, 5999), F.lit("$$# " * 6 + words)).otherwise(F.lit(words)).alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") >= 6000).cast("int").alias("quality"))
    got = quality.judge(docs, labels, "host", quality.Risk(risk=0.3))
    assert got.filter("not kept").agg(F.count_distinct("host"), F.count(F.lit(1))).first() == (300, 6000)
