"""Token counts by heap-and-linked-list byte-pair merging.

The bytes of a pre-token form a linked list of symbols, and a heap holds its adjacent pairs by rank, then place. The lowest
pair is popped and merged, and the pairs with its neighbours are pushed, until no pair merges. Every merge makes one symbol
of two, so the count is the number of bytes minus the number of merges; no identifier is put out.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings of the file count as one token each; repeated
rows are counted each; a pre-token of n bytes takes O(n log n) time and O(n) memory, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermill.llm.common import map_texts
from rivermill.llm.vocabulary import BITS, MASK, Remembered, Shipped, Tables, pre_tokens

def merge(word: bytes, table: Tables) -> tuple[int, list[int], list[int]]:
    """Number of merges made in ``word``, its symbols, and the links from each live symbol to the next."""
    look = table.merges.get
    n = len(word)
    symbols = [table.base[b] for b in word]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = look(symbols[i] << BITS | symbols[i + 1])
        if found is not None:
            heap.append((found, i))
    heapify(heap)
    merges = 0
    while heap:
        found, i = heappop(heap)
        j = after[i]
        # A pair is out of date if one of its symbols has changed since.
        if j >= n or symbols[i] < 0 or look(symbols[i] << BITS | symbols[j]) != found:
            continue
        symbols[i], symbols[j] = found & MASK, -1
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            found = look(symbols[i] << BITS | symbols[k])
            if found is not None:
                heappush(heap, (found, i))
        h = before[i]
        if h >= 0:
            found = look(symbols[h] << BITS | symbols[i])
            if found is not None:
                heappush(heap, (found, h))
    return merges, symbols, after


def counter(table: Tables) -> Callable[[str], int]:
    """A function that counts the tokens of a text."""

    def of_word(word: str) -> int:
        data = word.encode()
        return len(data) - merge(data, table)[0]

    counts = Remembered(of_word)
    special = re.compile("|".join(map(re.escape, table.special))) if table.special else None

    def plain(text: str) -> int:
        return sum(map(counts.__getitem__, pre_tokens(text)))

    def count(text: str) -> int:
        if special is None or not special.search(text):
            return plain(text)
        return len(special.findall(text)) + sum(map(plain, special.split(text)))

    return count


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text."""
    shipped = Shipped(docs.sparkSession, vocabulary)

    def make():
        count = counter(shipped.tables())
        return lambda text: (len(text.encode()), count(text))

    counted = map_texts(docs, make, "n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
