"""Removal of repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from verbascope.llm import repeats
from verbascope.llm.queries import REGISTRY


def brute(rows, length):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for d, text in enumerate(texts):
        for s in range(len(text) - length + 1):
            seen.setdefault(text[s : s + length], []).append((d, s))
    marks = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, s in places:
                marks[d][s : s + length] = True
    out = []
    for (key, _), text, mark in zip(rows, texts, marks, strict=True):
        kept = bytes(np.frombuffer(text, np.uint8)[~mark])
        runs = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        out.append((key, len(text), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def answer(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in frame.drop("kept_text").collect()), key=repr)


def make(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéf") for _ in range(rng.randrange(1, 7)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            passage = rng.choice(shared)
            cut = rng.randrange(len(passage))
            parts.append(rng.choice([passage, passage[cut:], passage[:cut], " ".join(word() for _ in range(20))]))
        rows.append((i, " ".join(parts)))
    rows += [(n, None), (n + 1, ""), (n + 2, "ab" * 90), (n + 3, "x" * 300), (n + 4, "short"), (1, rows[1][1]), (None, rows[2][1]), (None, None)]
    return rows


@pytest.mark.parametrize(("seed", "length", "gram", "limit"), [(1, 40, 8, 50_000), (2, 60, 12, 3), (3, 30, 30, 50_000), (4, 25, 8, 0)])
def test_equals_brute_force(spark, seed, length, gram, limit):
    rows = make(seed, 40)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start int, anchor int").repartition(3)
    assert answer(repeats.remove_repeats(docs, length, gram, limit)) == brute(rows, length)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert answer(repeats.remove_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()], 400)


def test_long_texts_are_cut_into_steps(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_STEP", 64)
    rng = random.Random(5)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(900)).encode(), np.uint8)
    hashes = repeats.RangeHash(data)
    at, low, high = repeats.anchor_runs(hashes, len(data), 50, 8)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high, strict=True)])
    assert covered.tolist() == list(range(len(data) - 49))
    assert all(a >= h and a + 8 <= lo + 50 for a, lo, h in zip(at, low, high, strict=True))


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def sharing(rows, width):
    """Rows, in order, that have ``width`` words in a row in common with another row."""
    held = [{tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows)]
    times = Counter(x for one in held for x in one)
    return sorted(((key, any(times[x] > 1 for x in one)) for (key, _), one in zip(rows, held, strict=True)), key=repr)


@pytest.mark.parametrize(("seed", "words", "gram"), [(1, 20, 4), (2, 12, 12), (3, 9, 1), (4, 51, 8)])
def test_shared_passages_equal_brute_force(spark, seed, words, gram):
    rows = make(seed, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.remove_repeats(docs, 400, words=words, word_gram=gram)
    got = sorted(((r.doc_id, r.shares_passage) for r in found.collect()), key=repr)
    assert got == sharing(rows, words)


def test_short_passage_of_many_words_is_told(spark):
    """51 words of fewer than 400 bytes between two rows: nothing is removed, and both say so; own repeats are not shared."""
    word = random.Random(7).randrange
    some = lambda n: " ".join(f"w{word(10**6)}" for _ in range(n))
    passage, fewer, own = " ".join(f"{i}a" for i in range(51)), some(50), some(60)
    rows = [(1, f"{some(40)} {passage} {some(9)}"), (2, passage.replace(" ", "\n")), (3, f"{some(30)} {fewer}"), (4, f"{fewer} {some(3)}"), (5, f"{own} {own}")]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if r.shares_passage} == {1, 2}
    assert {r.doc_id for r in found if r.n_removed} == {5}


def test_query_tells_shared_passages(spark, tmp_path):
    rows = [(i, t) for i, t in make(5, 30) if i is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = REGISTRY["op9_repeat_removal"](spark, str(tmp_path)).collect()
    want = sharing(rows, 51)
    assert sorted(((r.doc_id, r.shares_passage) for r in found), key=repr) == want and len({x for _, x in want}) == 2
    assert any(r.shares_passage and not r.has_repeat for r in found)
