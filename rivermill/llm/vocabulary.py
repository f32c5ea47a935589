"""Byte-level BPE files: symbols, merges, pattern. The file is read by the driver and sent to tasks as it is.

A file has a fixed size, so its broadcast is bounded. Its tables are built once per worker process.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark.sql import SparkSession

# The pattern that cuts texts into pre-tokens, and the printable bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = (range(ord("!"), ord("~") + 1), range(ord("¡"), ord("¬") + 1), range(ord("®"), ord("ÿ") + 1))

BITS = 20  # of an id in a packed pair
MASK = (1 << BITS) - 1


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes as they are, the others from U+0100 on in order."""
    plain = {b for part in PRINTABLE for b in part}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass(frozen=True)
class Tables:
    """``merges`` maps a packed pair of ids to its packed rank and result; ``spelled`` gives the bytes of an id."""

    base: list[int]
    merges: dict[int, int]
    spelled: list[bytes]
    special: dict[str, int]
    lookahead: int

    @property
    def pattern(self) -> regex.Pattern:
        return _pattern()


@lru_cache
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


#: The same pattern for texts of plain letters only, which the standard library's engine takes at twice the speed.
PLAIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NOT_PLAIN = re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")
_PLAIN = re.compile(
    rf" ?[{PLAIN_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s0-9{PLAIN_LETTERS}]+|\s+(?!\S)|\s+"
)


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a whole text."""
    return (_pattern() if _NOT_PLAIN.search(text) else _PLAIN).findall(text)


class Remembered(dict):
    """Results by short word in two generations: when the newer one is full, it becomes the older one."""

    def __init__(self, make: Callable[[str], object], words: int = 250_000, length: int = 32):
        self.make, self.words, self.length = make, words, length
        self.older: dict = {}

    def __missing__(self, word: str):
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= self.length:
            if len(self) >= self.words:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


def sufficient_lookahead(ordered: list[tuple[int, int, int]], lengths: dict[int, int]) -> int:
    """Bytes past a token's end after which no further text can change it, from the merge list alone.

    A merge of rank r at the end of known text fails only if its right part was taken by a merge of lower rank. So what a
    token needs to see is a chain of ever lower ranks: ``formed[t]`` bytes past t for t to be sure, and ``taken[t]`` bytes
    past t for merges so far that take t as their left part. Both follow in one pass in rank order.
    """
    formed: dict[int, int] = {}
    taken: dict[int, int] = {}
    for left, right, result in ordered:
        sure = max(formed.get(right, 0), taken.get(right, 0), formed.get(left, 0) - lengths[right])
        formed[result] = max(formed.get(result, 0), sure)
        taken[left] = max(taken.get(left, 0), lengths[right] + formed.get(right, 0))
    return max([0, *formed.values(), *taken.values()])


@lru_cache(maxsize=4)
def tables(text: str) -> Tables:
    spec = json.loads(text)
    vocab: dict[str, int] = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    spelled = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for token, number in vocab.items():
        spelled[number] = bytes(byte_of[c] for c in token)
    for token, number in special.items():
        spelled[number] = token.encode()
    ordered = []
    for pair in spec["model"]["merges"]:
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        ordered.append((vocab[left], vocab[right], vocab[left + right]))
    merges = {a << BITS | b: rank << BITS | c for rank, (a, b, c) in enumerate(ordered)}
    lengths = {number: len(spelled[number]) for number in vocab.values()}
    base = [vocab[letter] for letter in byte_letters()]
    return Tables(base, merges, spelled, special, sufficient_lookahead(ordered, lengths))


class Shipped:
    """A vocabulary file on its way to tasks."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            self._sent = spark.sparkContext.broadcast(file.read())

    def tables(self) -> Tables:
        return tables(self._sent.value)
