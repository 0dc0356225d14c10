"""Token files: exact round trips, against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from verbascope.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Plain words, and more words.", "two  spaces and   three", " leading", "trailing ", "tab\tand\nline \n next", "don't we'll it's 'tis",
    "nb sp  em", "number 12 345 x1y2", "<|endoftext|> inside <|endoftext|>", "é ü ñ 日本 語 🙂 🙂", "a", " ", "", None, "\n", "!? ... ,,",
    "x" * 3000, "word " * 2000, "'s 't 're", "end<|endoftext|>", "a ​ b",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_chunks_give_the_ids_of_the_whole_text(tokenizer):
    known, rng = tokens.ChunkIds(tokenizer), random.Random(3)
    alphabet = ["a", "Zé", " ", " ", "  ", "\n", "'s", "1", "!", " ", "<|", "\t", "ñ"]
    for text in [t or "" for t in TEXTS] + ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(500)]:
        assert tokens.text_ids(text, tokenizer, known, tokens.ids_bytes([2])) == tokens.ids_bytes(ids(tokenizer, text)), text


def test_other_tokenizers_encode_whole_texts(tokenizer):
    assert tokens.in_chunks(tokenizer)
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert not tokens.in_chunks(other)
    assert tokens.text_ids("Some words", other, None, b"") == tokens.ids_bytes(other.encode("Some words", add_special_tokens=False).ids)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_packing_round_trip(n):
    rng = np.random.default_rng(n)
    for values in (rng.integers(0, 50_000, n), np.where(rng.random(n) < 0.05, 2**32 - 1, rng.integers(7, 9, n)), np.full(n, 5)):
        values = values.astype(np.uint32)
        payload = tokens.pack(values)
        assert np.array_equal(tokens.unpack(payload), values)
        assert np.array_equal(tokens.unpack(payload, 1, 3), values[512:1536])


def test_outliers_are_kept_apart():
    values = np.array([3] * 500 + [2**31] * 12, np.uint32)
    assert len(tokens.pack(values)) < 16 + 7 + 12 * 6 + 1


def test_round_trip(spark, tokenizer, monkeypatch):
    rows = [(i * 5 % 97, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, start int, payload string").repartition(3)
    found = tokens.token_round_trip(docs, PATH).orderBy("start").collect()
    start, want = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        got = ids(tokenizer, text)
        want.append((key, start, len(got), zlib.crc32(tokens.ids_bytes(got))))
        start += len(got)
    assert [tuple(r) for r in found] == want


def test_empty_table(spark):
    assert tokens.token_round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
