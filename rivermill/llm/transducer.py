"""BPE encoding by a streaming transducer with bounded lookahead, and decoding by an incremental state machine.

Text comes in chunks. Pre-tokens are cut as soon as no further text can change them. A pre-token goes through the merges
in windows: tokens that end at least the merge list's sufficient lookahead before the window's end are stable and put out,
and the rest opens the next window, as a boundary between tokens never moves. So the memory of an encoder is bounded by
its chunk, window and word cache, whatever the length of text or pre-token. A decoder keeps the at most three bytes of an
unfinished character.

Defined cases: a null or empty text has no tokens; special strings of the file become their own id, as in the library;
bytes that are no text decode to U+FFFD; repeated rows are encoded each.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import regex
from pyspark.sql import DataFrame

from rivermill.llm.common import map_texts
from rivermill.llm.token_counts import merge
from rivermill.llm.vocabulary import BITS, MASK, Remembered, Shipped, Tables, pre_tokens

CHUNK = 1 << 16  # characters
HELD = 3  # characters a contraction can still need
SHORT = 48  # bytes merged by plain search
RUNS = (r"\p{L}*", r"\p{N}*", r"\s*", r"[^\s\p{L}\p{N}]*")


def _short(word: bytes, table: Tables) -> list[int]:
    """Merges of a short word: the lowest pair is searched among all, each time."""
    look = table.merges.get
    symbols = [table.base[b] for b in word]
    while len(symbols) > 1:
        best, at, left = -1, 0, symbols[0]
        for i, right in enumerate(symbols[1:]):
            found = look(left << BITS | right)
            if found is not None and (found < best or best < 0):
                best, at = found, i
            left = right
        if best < 0:
            break
        symbols[at : at + 2] = [best & MASK]
    return symbols


def _tokens(data: bytes, table: Tables) -> list[int]:
    if len(data) <= SHORT:
        return _short(data, table)
    _, symbols, after = merge(data, table)
    out, i = [], 0
    while i < len(data):
        out.append(symbols[i])
        i = after[i]
    return out


class Window:
    """The open bytes of one pre-token."""

    def __init__(self, table: Tables, size: int | None = None):
        self.table = table
        self.size = size or 4 * table.lookahead + 256
        self.open = b""

    def feed(self, data: bytes, last: bool) -> Iterator[int]:
        """Ids that are stable once ``data`` is known; all of them if it is the pre-token's ``last``."""
        spelled, keep = self.table.spelled, self.table.lookahead
        data, at = self.open + data, 0
        while len(data) - at > self.size:
            end = at + self.size
            for token in _tokens(data[at:end], self.table):
                if at + len(spelled[token]) > end - keep:
                    break
                yield token
                at += len(spelled[token])
        self.open = data[at:]
        if last:
            yield from _tokens(self.open, self.table)
            self.open = b""


class Words(Remembered):
    """Ids of whole pre-tokens."""

    def __init__(self, table: Tables):
        super().__init__(self.ids)
        self.table = table
        self.numbers = list(range(len(table.spelled)))  # one object per id

    def ids(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        ids = _short(data, self.table) if len(data) <= SHORT else Window(self.table).feed(data, True)
        return tuple(map(self.numbers.__getitem__, ids))


class Encoder:
    """``feed`` text chunks, then ``end``: each gives the ids that became stable, in groups."""

    def __init__(self, words: Words, run_limit: int = CHUNK):
        self.words, self.table = words, words.table
        self.runs = [regex.compile(p) for p in RUNS]
        self.run_limit = run_limit
        self.margin = max(map(len, self.table.special), default=1) - 1
        self.pending = ""  # may hold the start of a special string
        self.carry = ""  # from the first pre-token that may still change
        self.run = None  # pattern of a pre-token too long to hold, and its window
        self.window = Window(self.table)

    def _go_on(self, text: str, last: bool) -> Iterator[Sequence[int]]:
        """Goes on with a long pre-token: what still belongs to it goes to its window."""
        end = self.run.match(text).end()
        blank = self.run is self.runs[2]
        # The last white space before another character belongs to the next pre-token.
        whole, over = end == len(text), end
        if blank and not (whole and last):
            over = max(0, end - 1)
        done = last or not whole
        yield list(self.window.feed(text[:over].encode(), done))
        self.carry = text[over:]
        if done:
            self.run = None

    def _feed(self, text: str, last: bool) -> Iterator[Sequence[int]]:
        text = self.carry + text
        self.carry = ""
        if self.run is not None:
            yield from self._go_on(text, last)
            if self.run is not None:
                return
            text, self.carry = self.carry, ""
        if last:
            yield from map(self.words.__getitem__, pre_tokens(text))
            return
        at = 0
        for found in self.table.pattern.finditer(text):
            if found.end() > len(text) - HELD:
                break
            yield self.words[found[0]]
            at = found.end()
        self.carry = text[at:]
        if len(self.carry) > self.run_limit:
            tail = self.carry[-1 - HELD]
            lead = 1 if self.carry[0] == " " and not tail.isspace() else 0
            self.run = next(r for r in self.runs if r.match(tail).end())
            text, self.carry = self.carry, ""
            yield list(self.window.feed(text[:lead].encode(), False))
            yield from self._go_on(text[lead:], False)

    def feed(self, chunk: str) -> Iterator[Sequence[int]]:
        self.pending += chunk
        while True:
            places = [(i, s) for s in self.table.special if (i := self.pending.find(s)) >= 0]
            if not places:
                break
            at, text = min(places)
            yield from self._feed(self.pending[:at], True)
            yield [self.table.special[text]]
            self.pending = self.pending[at + len(text) :]
        sure = max(0, len(self.pending) - self.margin)
        yield from self._feed(self.pending[:sure], False)
        self.pending = self.pending[sure:]

    def end(self) -> Iterator[Sequence[int]]:
        yield from self._feed(self.pending, True)
        self.pending = ""


def encode(text: str, words: Words) -> Iterator[Sequence[int]]:
    """Ids of a whole text, in groups, chunk by chunk."""
    if len(text) <= CHUNK and not any(s in text for s in words.table.special):
        return map(words.__getitem__, pre_tokens(text))
    encoder = Encoder(words)
    chunks = (text[i : i + CHUNK] for i in range(0, len(text), CHUNK))
    return chain(chain.from_iterable(map(encoder.feed, chunks)), encoder.end())


class Decoder:
    """Ids to text, piece by piece."""

    def __init__(self, table: Tables):
        self.spelled = table.spelled
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.spelled.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", final=True)


BATCH = 8192  # pre-tokens


def digest(text: str, words: Words) -> tuple[int, str, str]:
    """Number of tokens, and digests of the ids and of the text decoded from them."""
    count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
    decoder, comma = Decoder(words.table), ""
    groups = encode(text, words)
    while batch := list(islice(groups, BATCH)):
        ids = list(chain.from_iterable(batch))
        if ids:
            count += len(ids)
            ids_hash.update((comma + ",".join(map(str, ids))).encode())
            text_hash.update(decoder.feed(ids).encode())
            comma = ","
    text_hash.update(decoder.end().encode())
    return count, ids_hash.hexdigest(), text_hash.hexdigest()


def token_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ids of every text."""
    shipped = Shipped(docs.sparkSession, vocabulary)

    def make():
        words = Words(shipped.tables())
        return lambda text: (list(chain.from_iterable(encode(text, words))),)

    return map_texts(docs, make, "ids array<int>")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded in one pass."""
    shipped = Shipped(docs.sparkSession, vocabulary)

    def make():
        words = Words(shipped.tables())
        return lambda text: digest(text, words)

    return map_texts(docs, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
