from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rivermill.llm import token_counts, token_files, transducer, vocabulary as vocab

PARTS = [
    "a", "e", "the", " ", "  ", "\n", "'", "'s", "'re", "1", "23", "-", "----", "é", "日本", "😀", "\x1c", "\x85", " ",
    "<|endoftext|>", "<|endo", "<", " a", "ing", "=", "٣", "²", "́", "　", "İ",
]


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


@pytest.fixture(scope="module")
def table(vocabulary):
    with open(vocabulary, encoding="utf-8") as file:
        return vocab.tables(file.read())


def texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        parts = PARTS[: rng.choice([3, 8, len(PARTS)])]
        head = rng.choice(["a", "ab", "-", "  ", "é", "="]) * rng.choice([50, 400, 3000]) if rng.random() < 0.2 else ""
        yield head + "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 10, 60, 200])))


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_streaming_equals_the_library(library, table):
    words, rng = transducer.Words(table), random.Random(1)
    for text in texts(400, 2):
        encoder = transducer.Encoder(words, run_limit=rng.choice([10, 50, 10**5]))
        size, out = rng.choice([1, 2, 7, 50, 10**6]), []
        for i in range(0, len(text), size):
            for ids in encoder.feed(text[i : i + size]):
                out += ids
        for ids in encoder.end():
            out += ids
        assert out == ids_of(library, text)


def test_memory_of_a_long_run_is_bounded(table):
    encoder = transducer.Encoder(transducer.Words(table), run_limit=1000)
    for _ in range(200):
        list(encoder.feed("ab" * 500))
        assert len(encoder.carry) <= 2000 and len(encoder.window.open) <= encoder.window.size


def test_digests_and_counts_equal_the_library(library, table):
    words, count = transducer.Words(table), token_counts.counter(table)
    for text in texts(300, 3):
        ids = ids_of(library, text)
        want = library.decode(ids, skip_special_tokens=False)
        assert transducer.digest(text, words) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(want.encode()).hexdigest()
        )
        assert count(text) == len(ids)


def test_decoder_holds_unfinished_characters(table):
    decoder = transducer.Decoder(table)
    number = {spelled: i for i, spelled in enumerate(table.spelled)}
    split = [number[bytes([b])] for b in "日".encode()]
    assert [decoder.feed([i]) for i in split] == ["", "", "日"]
    decoder.feed(split[:1])
    assert decoder.end() == "�"


def test_queries_on_odd_rows(odd, odd_rows, nothing, vocabulary, library):
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(ids_of(library, r[1] or ""))) for r in odd_rows)
    counts = token_counts.token_counts(odd, vocabulary).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in counts) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in counts)
    trip = transducer.round_trip(odd, vocabulary).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in trip) == sorted((a, c) for a, _, c in want)
    ids = transducer.token_ids(odd, vocabulary).filter("doc_id = 8").first().ids
    assert ids == ids_of(library, next(r[1] for r in odd_rows if r[0] == 8))
    for made in (token_counts.token_counts, transducer.round_trip):
        assert made(nothing, vocabulary).count() == 0


@pytest.mark.parametrize("most", [200, 256, 70_000, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_codes(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most + 1, n, dtype=np.uint64)
    codes = token_files.Codes(token_files.pack(ids))
    assert len(codes) == n and [codes[i] for i in range(0, n, 7)] == ids[::7].tolist()
    for _ in range(20):
        first, last = sorted(rng.integers(0, n + 1, 2))
        assert (codes.slice(first, last) == ids[first:last]).all()
    with pytest.raises(IndexError):
        codes[n]


def test_files_of_odd_rows(monkeypatch, odd, odd_rows, nothing, vocabulary, library):
    monkeypatch.setattr(token_files, "SEGMENT", 5000)
    segments = token_files.write(odd, vocabulary, 3)
    assert segments.count() > 3
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for r in order:
        ids = [*ids_of(library, r[1] or ""), 0]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in token_files.read(segments).collect()), key=lambda r: r[1])
    assert got == want
    assert token_files.read(token_files.write(nothing, vocabulary)).count() == 0
