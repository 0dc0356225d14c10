"""The five stages over a given table, each against a plain version or what it may change."""

import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()


def first_of_groups(rows):
    """Least id of every component of linked documents."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                one, two = sorted((root(a), root(b)))
                up[two] = one
    return {root(i) for i in ids}


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outputs = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        outputs.append(docs.collect())
        if name != "tokens":
            assert docs.columns == columns
    given, known, single, clean, mixed, encoded = outputs
    assert set(known) <= set(given) and len(known) >= 0.8 * len(given)
    assert sorted(r.doc_id for r in single) == sorted(first_of_groups(known)) and set(single) <= set(known)
    assert set(clean) <= set(single) and clean
    copies = Counter(mixed)
    assert set(copies) <= set(clean) and max(copies.values()) <= 3
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = sorted((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in mixed)
    assert sorted((r.doc_id, r.n_tokens) for r in encoded) == sizes
    starts = sorted((r.start, r.n_tokens) for r in encoded)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
