"""Personal data: overlapping candidates, boosted trees, calibrated thresholds.

Base rules find spans that are personal data by their form. Generators of high recall propose more spans, which may
overlap: addresses with "at" and "dot" spelled out, numbers with other separators, without a plus sign, or with dots in
brackets. Trees score a candidate by features of its form and of the text around it. A candidate past the threshold of its
kind is a span too, unless it touches a base span or a better candidate.

Trees and thresholds are learnt from all distinct texts, half of which, by hash, fit the trees. Positives are base spans, as
found and in respelled forms; negatives are candidates that touch no base span, and base spans spoilt (wrong check digit, part
beyond 255, too many digits). On the other half each kind gets the lowest threshold of a fine fixed grid at which false
candidates are at most ``FALSE_SHARE`` of what passes, by the exact binomial bound at ``LEVEL``, where copies of a text count
once and the candidates of a text count each; thresholds are at least ``LEAST_SCORE``, and a kind without one adds nothing.
Tasks sum gradients and count candidates by score, so the driver holds one histogram whatever the number of documents.
All documents are searched in whole.

Defined cases: a null or empty text has no spans; a text of one long run of digits or signs takes time in proportion to
its length, and one of very many spans hardly more; spelled addresses have any length and number of parts; spans of different
kinds may overlap; repeated rows give equal spans; without base spans to learn from
only the base rules work.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, islice
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.boosting import Boosted, fit, fit_table, matrix
from rivermill.llm.common import kept, map_texts

KINDS = ("email", "ip", "card", "phone")
FALSE_SHARE = 0.02
LEAST_SCORE = 0.9
LEVEL = 0.05
SEED = 7
HANDED_ON = 10_000  # examples at a time
#: Thresholds that are tried: even steps of the log-odds.
GRID = np.unique(np.append(0.0, 1 / (1 + np.exp(-np.arange(-16 * 128, 36 * 128) / 128))))

Span = tuple[int, int, int]  # start, kind, end

# The base rules. No part can be left and entered again, so each takes time in proportion to the text.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[Span]:
    """The local part of an at sign reaches back to the last character that cannot be in one, or to the last match."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            low = domain.end()
            yield start, 0, low
        at = text.find("@", max(at + 1, low))


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start, then kind."""
    spans = list(_emails(text)) if "@" in text else []
    spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _DIGITS.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


# The generators. Those of numbers look only into zones that hold enough digits and signs.
_ZONE = re.compile(r"(?:\+|\()?[0-9][0-9 ()\[\].+_/-]{5,}[0-9]")
_NUMBERS = (
    (1, re.compile(r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?\. ?|-)[0-9]{1,3}){3}")),
    (2, re.compile(r"[0-9](?:[ ._/-]{0,2}[0-9]){11,18}")),
    (3, re.compile(r"(?:\+|00|\()?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}")),
)
_SPELLED = re.compile(r"(?:@| at |\(at\)|\[at\])(?=[A-Za-z0-9])")
_REST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| dot |\(dot\)|\[dot\])[A-Za-z0-9-]+)+")


def candidates(text: str) -> list[Span]:
    """Proposed spans; they may overlap."""
    found = []
    for zone in _ZONE.finditer(text):
        for kind, pattern in _NUMBERS:
            found += [(zone.start() + m.start(), kind, zone.start() + m.end()) for m in pattern.finditer(zone[0])]
    for sign in _SPELLED.finditer(text):
        start = sign.start()
        while start and text[start - 1] in LOCAL:
            start -= 1
        rest = _REST.match(text, sign.end())
        if rest and start < sign.start() and (sign[0] != " at " or " dot " in rest[0]):
            found.append((start, 0, rest.end()))
    return sorted(found)


def _class(c: str) -> float:
    return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0


# Words that tell of personal data nearby.
CUES = (
    ("mail", "email", "e-mail", "contact", "correo", "write"), ("ip", "host", "server", "address", "from"),
    ("card", "visa", "tarjeta", "karte", "carte", "payment"), ("phone", "tel", "call", "mobile", "fax", "telefon"),
)


def features(text: str, span: Span) -> list[float]:
    """Form and context of a candidate."""
    start, kind, end = span
    body = text[start:end]
    digits = _DIGITS.sub("", body)
    groups = [g for g in re.split(r"[^0-9]+", body) if g]
    signs = re.sub(r"[A-Za-z0-9]", "", body)
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    words = re.findall(r"[\w-]+", before.lower())
    cue = any(w in CUES[kind] for w in words[-3:])
    labels = re.split(r"\.| dot |\(dot\)|\[dot\]", re.split(r"@| at |\(at\)|\[at\]", body)[-1]) if kind == 0 else []
    sizes = list(map(len, groups)) or [0]
    around = before + after
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        len(body), len(digits), len(groups), max(sizes), min(sizes), sizes[0], len(signs), len(set(signs)),
        float(len(digits) > 1 and luhn(digits)), float(all(map(_small, groups))),
        float(digits[:1] in ("3", "4", "5", "6")), max((digits.count(d) for d in set(digits)), default=0) / (len(digits) or 1),
        float(body.startswith("+")), float(body.startswith("00")), float("(" in body),
        float(kind == 0 and bool(re.search("[0-9._%+-]", re.split(r"@| at |\(at\)|\[at\]", body)[0]))),
        len(labels), len(labels[-1]) if labels else 0, float(labels[-1].isalpha()) if labels else 0.0,
        _class(before[-1:]), _class(after[:1]), float(cue), sum(map(str.isdigit, around)) / (len(around) or 1),
        sum(map(str.isalpha, around)) / (len(around) or 1),
    ]


WIDTH = len(features("", (0, 0, 0)))


def _respelled(kind: int, body: str, rng: Random) -> str:
    if kind == 0:
        at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]")])
        name, _, host = body.partition("@")
        return name + at + host.replace(".", dot)
    if kind == 1:
        return body.replace(".", rng.choice(["[.]", "(.)"]))
    digits = _DIGITS.sub("", body)
    if kind == 2:
        sign = rng.choice([".", "_", "/", "  "])
        return sign.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return rng.choice(["00", "("]) + body[1:] if "(" not in body else "00" + body[1:]


def _spoilt(kind: int, body: str, rng: Random) -> str:
    digits = _DIGITS.sub("", body)
    if kind == 1:
        parts = body.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return rng.choice([".", "[.]"]).join(parts)
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        return rng.choice(["", ".", " "]).join(wrong[i : i + 4] for i in range(0, len(wrong), 4))
    if kind == 3:
        return rng.choice([digits[:7], digits + digits[:6], digits[:4] + "-" + digits[4:7]])
    # An address that is prose with "at" and "dot" in it, or that has no name after its dot.
    name = re.sub("[^A-Za-z]", "", body.partition("@")[0])
    if name and rng.random() < 0.7:
        return f"{name} at {rng.choice(['that', 'the', 'a', 'one'])} dot {rng.choice(['on', 'of', 'the', 'com', 'here'])}"
    return body.replace("@", " at ").split(".")[0] + rng.choice([" dot 5", ".4"])


class _Covered:
    """Spans by start with the furthest end so far: whether a span touches any takes a bisection."""

    def __init__(self, spans: list[Span]):
        self.starts = [s[0] for s in spans]
        self.ends = list(accumulate((s[2] for s in spans), max))

    def touches(self, span: Span) -> bool:
        before = bisect_left(self.starts, span[2])
        return before > 0 and self.ends[before - 1] > span[0]

    def add(self, span: Span) -> None:
        """Takes a span that touches none."""
        at = bisect_left(self.starts, span[0])
        self.starts.insert(at, span[0])
        self.ends.insert(at, span[2])


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and labels of what a sampled text teaches."""
    rng = Random(hashlib.sha256(text.encode()).digest())
    base = base_spans(text)
    covered = _Covered(base)
    for span in candidates(text):
        if not covered.touches(span):
            yield features(text, span), 0
    for start, kind, end in base:
        body = text[start:end]
        yield features(text, (start, kind, end)), 1
        for label, make in ((1, _respelled), (0, _spoilt)):
            other = make(kind, body, rng)
            around = text[max(0, start - 40) : start], text[end : end + 40]
            changed = around[0] + other + around[1]
            yield features(changed, (len(around[0]), kind, len(around[0]) + len(other))), label


@dataclass(frozen=True)
class Detector:
    model: Boosted | None
    thresholds: tuple[float, ...]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans, both by start, then kind."""
        base = base_spans(text)
        if self.model is None:
            return base, base
        covered = _Covered(base)
        fresh = [c for c in candidates(text) if self.thresholds[c[1]] <= 1 and not covered.touches(c)]
        if not fresh:
            return base, base
        scores = self.model(np.array([features(text, c) for c in fresh]))
        taken: list[Span] = []
        covered = _Covered([])
        for score, span in sorted(zip(scores.tolist(), fresh, strict=True), key=lambda x: (-x[0], x[1])):
            if score >= self.thresholds[span[1]] and not covered.touches(span):
                taken.append(span)
                covered.add(span)
        return base, sorted(base + taken)


def _tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k) for k <= n p; terms below 1e-30 of the largest are left out."""
    top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    i = np.arange(k, max(0, k - 64 - int(12 * math.sqrt(n * p))), -1, dtype=float)
    return float(np.exp(top + np.append(0.0, np.cumsum(np.log(i * (1 - p) / ((n - i + 1) * p))))).sum())


def _lowest(scores: np.ndarray, counts: np.ndarray, wrong: np.ndarray, share: float, level: float) -> float:
    """As ``threshold``, of distinct scores, highest first, with the candidates and the false ones of each."""
    best = 2.0
    for score, n, k in zip(scores.tolist(), np.cumsum(counts).tolist(), np.cumsum(wrong).tolist(), strict=True):
        if k <= share * n and _tail(k, n, share) <= level:
            best = score
        elif best < 2:
            break
    return max(best, LEAST_SCORE)


def threshold(scores: np.ndarray, labels: np.ndarray, share: float = FALSE_SHARE, level: float = LEVEL) -> float:
    """The lowest score such that all thresholds down to it keep false candidates at most ``share``; 2 for none."""
    values, place = np.unique(-scores, return_inverse=True)
    counts = np.bincount(place, minlength=len(values))
    return _lowest(-values, counts, np.bincount(place[labels == 0], minlength=len(values)), share, level)


def _thresholds(held: DataFrame, model: Boosted) -> tuple[float, ...]:
    """``threshold`` of each kind over all rows of ``held``, with the steps of ``GRID`` as scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = matrix(batch.column(0), WIDTH), batch.column(1).to_numpy()
            step = np.searchsorted(GRID, model(rows), side="right") - 1
            key, place = np.unique(rows[:, : len(KINDS)].argmax(axis=1) * len(GRID) + step, return_inverse=True)
            columns = [key, np.bincount(place), np.bincount(place[labels == 0], minlength=len(key))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "n", "wrong"])

    counted = held.select("features", "label").mapInArrow(run, "key bigint, n bigint, wrong bigint")
    summed = counted.groupBy("key").agg(F.sum("n"), F.sum("wrong")).toArrow()
    found = np.array(sorted(zip(*(c.to_pylist() for c in summed.columns), strict=True), reverse=True), np.int64).reshape(-1, 3)
    out = []
    for kind in range(len(KINDS)):
        own = found[found[:, 0] // len(GRID) == kind]
        out.append(_lowest(GRID[own[:, 0] % len(GRID)], own[:, 1], own[:, 2], FALSE_SHARE, LEVEL))
    return tuple(out)


def _taught(docs: DataFrame) -> DataFrame:
    """What every distinct text teaches: its hash and sha256, and place, label and features (doubles as bytes) of each example."""
    schema = StructType.fromDDL("hash bigint, name binary, place int, label int, features binary")
    arrow = to_arrow_schema(schema)

    def taught(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for h, text in zip(batch.column(0), batch.column(1), strict=True):
                name = hashlib.sha256(text.as_py().encode()).digest()
                for place, (found, label) in enumerate(examples(text.as_py())):
                    yield h.as_py(), name, place, label, np.array(found, "<f8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = taught(batches)
        while some := list(islice(rows, HANDED_ON)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    read = docs.select(F.xxhash64(F.lit(SEED), docs["text"]).alias("hash"), docs["text"]).filter("text is not null")
    # Copies are one text: neither trees nor thresholds count them more than once.
    return read.mapInArrow(run, schema).distinct()


def train(docs: DataFrame, most_rows: int | None = None) -> Detector:
    """Fits and calibrates on all of ``docs``; with ``most_rows``, for a quick look, on so many rows, for which texts take turns."""
    if most_rows is not None:
        return _quick(_taught(docs), most_rows)
    taught = kept(_taught(docs), "taught")
    fits = (F.col("hash").bitwiseAND(F.lit(1)) == 0).alias("fits")
    if taught.filter(fits).select("label").distinct().count() < 2:
        return Detector(None, ())
    model = fit_table(taught.filter(fits), WIDTH)
    return Detector(model, _thresholds(taught.filter(~fits), model))


def _quick(taught: DataFrame, most_rows: int) -> Detector:
    # Texts take turns, so that a text of many spans displaces no other; the halves get equal shares of the rows.
    turns = Window.partitionBy("hash").orderBy(F.xxhash64("label", "features"), "label", "features")
    places = Window.partitionBy(F.col("hash").bitwiseAND(F.lit(1))).orderBy("turn", "hash")
    taken = taught.withColumn("turn", F.row_number().over(turns)).withColumn("nth", F.row_number().over(places))
    table = taken.filter(F.col("nth") <= most_rows // 2).orderBy("turn", "hash").toArrow()
    rows = matrix(table["features"], WIDTH)
    labels, fold = np.array(table["label"]), np.array(table["hash"]) & 1
    if len(set(labels[fold == 0])) < 2:
        return Detector(None, ())
    model = fit(rows[fold == 0], labels[fold == 0])
    held, truth = rows[fold == 1], labels[fold == 1]
    scores = model(held)
    limits = [threshold(scores[held[:, k] == 1], truth[held[:, k] == 1]) for k in range(len(KINDS))]
    return Detector(model, tuple(limits))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """doc_id, number of base spans per kind, base_sha256 and spans of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(detector or train(docs))

    def make():
        found = sent.value

        def work(text: str) -> tuple:
            base, spans = found.spans(text)
            counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
            return *counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)

        return work

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_texts(docs, make, f"{counts}, base_sha256 string, spans string")


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each run of overlapping spans replaced by the name of its first kind."""
    out, at, reach = [], 0, -1
    for start, kind, end in spans:
        if start >= max(reach, 0):
            out += [text[max(at, reach, 0) : start], f"[{KINDS[kind].upper()}]"]
        at = reach = max(reach, end)
    out.append(text[max(at, 0) :])
    return "".join(out)


def redacted(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """``docs`` with personal data replaced in text, and n_chars, where there is one, counted anew."""
    sent = docs.sparkSession.sparkContext.broadcast(detector or train(docs))
    schema = docs.schema
    arrow = to_arrow_schema(schema)
    place = docs.columns.index("text")
    sized = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value
        for batch in batches:
            texts = [t if t is None else redact(t, found.spans(t)[1]) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, arrow.field(place).type)
            if sized is not None:
                old = batch.column(sized).to_pylist()
                sizes = [o if t is None else len(t) for t, o in zip(texts, old, strict=True)]
                columns[sized] = pa.array(sizes, arrow.field(sized).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)
