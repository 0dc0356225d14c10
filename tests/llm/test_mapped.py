"""Quality, mixing, sharding, decontamination, language, toxicity and personal data on small tables, against brute force."""

import hashlib
import math
import random
import re
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from verbascope.llm import decontam, langid, mixing, pii, quality, sharding, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\n", "a b c d e a b c d e", "é ñ # | <>\n\nx\nx\nx", "one two three four five six seven eight nine ten " * 3, "w" * 20_000]


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string" + extra).repartition(3)


def odd_rows(texts=ODD):
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, "en" if i % 5 else None) for i, t in enumerate(texts)]
    return [*rows, (None, "null id here", None, None), (1, "same id", "s1", "en"), (1, "same id", "s1", "en")]


# --- quality -----------------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)} if len(grams) < 3000 else set()
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(lines), len(covered)


def test_measures():
    rng = random.Random(1)
    made = ["".join(rng.choice(["a", "b ", "é", " ", "\n", "#", "a b c d e "]) for _ in range(60)) for _ in range(300)]
    for text in [*ODD, *made]:
        assert quality.measures(None if text is None else text.encode()) == brute_measures(text), text


def test_host_verdicts(spark):
    good, bad = " ".join(f"word{i}" for i in range(30)), "short"
    rows = [(i, bad if i % 10 < (9 if host == "junk" else 1) else f"{good} {i}", host, None) for host in ("junk", "fine", "good", None) for i in range(40)]
    found = quality.host_verdicts(frame(spark, [(*r, 1, 2) for r in rows], ", host int, n_docs int")).collect()
    assert len(found) == 160
    for r in found:
        assert r.base_failed == (r.n_words < 10)
        assert r.kept == (not r.base_failed and r.host != "junk")
    assert {r.host for r in found if r.host_rate > 0.5} == {"junk"}


def test_quality_of_odd_rows(spark):
    found = quality.host_verdicts(frame(spark, odd_rows())).collect()
    assert len(found) == len(odd_rows())
    want = {i: brute_measures(t)[:2] for i, t, *_ in odd_rows() if i not in (None, 1)}
    assert {r.doc_id: (r.n_words, r.word_chars) for r in found if r.doc_id in want} == want
    assert quality.host_verdicts(frame(spark, [])).count() == 0


# --- mixing ------------------------------------------------------------------------------------------------


def brute_mix(rows, weights=(5, 2, 1), cap=3):
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = sum(weight[s] for s in order if s not in full)
        level = (total - sum(cap * sizes[s] for s in full)) / open_ if open_ else 0.0
        more = {s for s in order if weight[s] * level > cap * sizes[s]}
        if more <= full:
            return {s: (sizes[s], min(weight[s] * level, cap * sizes[s])) for s in order}
        full |= more


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["a", "a", "a", "b", "c", "d", None]), None) for i in range(1500)]
    docs = frame(spark, [(*r, 0) for r in rows], ", size int")
    found = mixing.mix(docs).collect()
    want = brute_mix(rows)
    assert len(found) == len(rows)
    for source, (size, target) in want.items():
        own = [r for r in found if r.source == source]
        assert all(r.source_size == size and math.isclose(r.target, target) for r in own)
        assert sum(r.taken for r in own) == math.floor(own[0].target)
        assert all(r.size * (math.floor(r.target) // size) <= r.taken <= 3 * r.size for r in own)
        assert sum(0 < r.taken % r.size for r in own if r.size) <= 1
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in found}


def test_mixed_documents(spark):
    rows = odd_rows(ODD * 6)
    docs = frame(spark, [(*r, 7) for r in rows], ", taken int")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} <= {(r[0], r[1]) for r in rows}
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.mixed_documents(frame(spark, [])).count() == 0
    empty = mixing.mix(frame(spark, [(1, None, "a", None), (2, "", None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


# --- sharding ----------------------------------------------------------------------------------------------


def brute_shards(rows, limit):
    bits = {}
    for i, (key, text, *_) in enumerate(rows):
        inner = hashlib.md5((text or "").encode()).hexdigest()
        digest = hashlib.md5(f"{'' if key is None else key}:{inner}".encode()).hexdigest()
        bits[i] = format(int(digest[:15], 16), "060b")
    size = {i: len((r[1] or "").encode()) for i, r in enumerate(rows)}
    out, todo = [], [""]
    while todo:
        prefix = todo.pop()
        own = [i for i in bits if bits[i].startswith(prefix)]
        if sum(size[i] for i in own) <= limit or len(own) < 2 or len(prefix) == 60:
            out += [(rows[i][0], size[i], prefix, sum(size[j] for j in own)) for i in own]
        else:
            todo += [prefix + "0", prefix + "1"]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1, 50, 700, 10**9])
def test_shards_equal_brute_force(spark, limit):
    rng = random.Random(limit)
    rows = odd_rows() + [(100 + i, "x" * rng.randrange(80), "s", None) for i in range(200)] + [(9, "twin " * 30, "s", None)] * 3
    docs = frame(spark, [(*r, 1, 2) for r in rows], ", depth int, prefix int")
    found = sorted(((r.doc_id, r.n_bytes, r.shard, r.shard_bytes) for r in sharding.shards(docs, limit).collect()), key=repr)
    assert found == brute_shards(rows, limit)


def test_written_shards_keep_every_row(spark, tmp_path):
    docs = frame(spark, odd_rows())
    sharding.write_shards(docs, str(tmp_path / "out"), 60)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    assert sharding.shards(frame(spark, [])).count() == 0


# --- decontamination ---------------------------------------------------------------------------------------


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_bit_parallel_distance_and_matcher():
    rng = random.Random(2)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 60)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 90)))
        assert decontam.best_distance(item, text) == edit_distance(item, text)
    items = [(i, "".join(rng.choice("abcdef ") for _ in range(60))) for i in range(8)]
    matcher = decontam.Matcher(items, 0.1)
    for _ in range(150):
        chars = list(rng.choice(items)[1])
        for _ in range(rng.randrange(9)):
            chars[rng.randrange(len(chars))] = rng.choice(["", "z", "ab"])
        text = "".join(rng.choice("abcdef ") for _ in range(40)) + "".join(chars) + "fed cab" * rng.randrange(5)
        assert sorted(matcher.find(text)) == [(k, d) for k, t in items if (d := edit_distance(t, text)) <= 6]


def test_contamination(spark):
    item = "The quick brown fox jumps over the lazy dog and runs away from the farm today"
    rows = [(1, f"before {item.upper()}! after", None, None), (2, item.replace("lazy", "tired"), None, None), (3, "the quick brown fox went home", None, None)]
    rows += [(4, None, None, None), (5, "", None, None), (None, item, None, None), (1, rows[0][1], None, None)]
    docs = frame(spark, [(*r, 5) for r in rows], ", item_id int")
    bench = spark.createDataFrame([(7, item, 1), (8, "too short", 1), (None, item, 1), (9, None, 1), (7, item, 1)], "item_id long, text string, doc_id int")
    for size in (4_000_000, 60):
        found = decontam.contamination(docs, bench, block_chars=size).collect()
        assert sorted(((r.doc_id or 0, r.contaminated, r.n_items) for r in found)) == [
            (0, True, 1), (1, True, 1), (1, True, 1), (2, True, 1), (3, False, 0), (4, False, 0), (5, False, 0)]
    assert {r["items"][0]["distance"] for r in found if r.doc_id == 1} == {0}
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 5]
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(frame(spark, []), bench).count() == 0


def test_short_items_are_matched_as_whole_words(spark):
    bench = spark.createDataFrame([(1, "Too short!"), (2, "42"), (3, "..."), (4, "日本"), (5, "é")], "item_id long, text string")
    texts = ["it is too  SHORT, really", "much too shorter", "answer: 42", "142 and 421", "日本", "日本語", "... !", "É", "ée", "too short" * 2, None, "too short " * 5000]
    found = decontam.contamination(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]), bench).collect()
    assert {r.doc_id: [x.item_id for x in r["items"]] for r in found if r.contaminated} == {0: [1], 2: [2], 4: [4], 7: [5], 11: [1]}
    assert all(x.distance == 0 for r in found for x in r["items"])
    matcher = decontam.Matcher([(1, "a b"), (2, "b")], 0.08)
    assert sorted(matcher.find("a b c")) == [(1, 0), (2, 0)] and sorted(matcher.find("ca b")) == [(2, 0)] and not list(matcher.find("ab"))


# --- models ------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_languages_of_held_out_documents(given):
    docs, _ = given
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.count_if(F.col("lang_pred") == F.col("lang")), F.count("*")).first()
    assert n > 200 and right / n > 0.97
    assert found.where("score < 0 or score > 1").count() == 0


def test_odd_texts_have_no_language(spark, given):
    model = langid.fit(given[0])
    texts = [None, "", "123 !?", "_", "Und der die das ist nicht", "12 the and of that 7"]
    found = {r.doc_id: r for r in langid.identify(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]), model).collect()}
    assert [found[i].lang_pred for i in range(6)] == ["und"] * 4 + ["de", "en"]
    assert all(found[i].score == 0 for i in range(4))
    unlabelled = langid.identify(frame(spark, [(1, "some words", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
    assert langid.identify(frame(spark, [])).count() == 0


def test_numbers_are_no_letters_and_marks_belong_to_words():
    for text in ("²", "½ ¾", "Ⅷ", "٣", "①", "\u0301", "_", "5%"):
        assert langid.words_of(text) == [], text
    assert langid.words_of("हिन्दी में é e\u0301 x² naïve ʼn") == ["हिन्दी", "में", "é", "e\u0301", "x", "naïve", "ʼn"]
    import unicodedata

    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    assert {c for c in every if langid.words_of(c) == [c]} == {c for c in every if unicodedata.category(c)[0] == "L"}


def test_odd_rows_of_languages(spark, given):
    model = langid.fit(given[0])
    long = "and the of that with from " * 40_000
    rows = [(1, "½ ² Ⅷ", None, "en"), (2, "und der die das", None, "en"), (2, "und der die das", None, "en"), (None, long, "s", None), (3, "qqqq", None, None)]
    docs = frame(spark, [(*r, 7, "x") for r in rows], ", score int, lang_pred string")
    found = langid.identify(docs, model).collect()
    assert len(found) == 5 and {(r.lang_pred, r.score) for r in found if r.doc_id == 1} == {("und", 0.0)}
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == 2}) == 1
    assert [r.lang_pred for r in found if r.doc_id is None] == ["en"]
    # Equal evidence: the first language in code point order.
    learned = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    tied = frame(spark, [(i, "aaa bbb", None, "xx" if n % 2 else "yy") for n, i in enumerate(learned)])
    assert {r.lang_pred for r in langid.identify(tied).collect()} == {"xx"}


def test_toxic_held_out_documents(given):
    docs, labels = given
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    hits, said, true, n = found.agg(F.sum(F.col("predicted") * F.col("toxic")), F.sum("predicted"), F.sum("toxic"), F.count("*")).first()
    assert n > 80 and hits / said > 0.8 and hits / true > 0.5


def test_grammar_scores_clauses():
    g = toxicity.Grammar({"idiot": 4.0, "moro*": 3.0}, {toxicity.NEGATION: -5.0, toxicity.REPORT: -4.0, toxicity.TARGET: 1.0}, -5.0)
    plain, negated, told, aimed = (g.score(t)[0] for t in ("some idiot here", "he is not an idiot", "she said some idiot here", "you are an idiot"))
    assert aimed > plain > told > negated
    assert g.score("never. some idiot")[0] == pytest.approx(plain)
    assert g.score("morons")[0] > 0.9 and g.score("moro")[0] == g.score("")[0]
    assert g.score("kill time")[0] < 0.3 < g.score("i will tell you kill")[0]


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None), (6, 3), (999, 1)], "doc_id long, toxic int")
    found = toxicity.toxicity(frame(spark, [(*r, 1) for r in odd_rows()], ", toxic int"), labels).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.toxicity(frame(spark, []), labels).count() == 0


def test_small_and_large_samples_give_alike_scores(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(4000):
        bad = rng.random() < 0.12
        words = [f"word{chr(97 + rng.randrange(26))}" for _ in range(6)]
        # "grumpy" is far commoner in toxic texts, but most texts that hold it are clean.
        words += ["idiot"] * (bad and rng.random() < 0.6) + ["grumpy"] * (rng.random() < (0.6 if bad else 0.13))
        rows.append((i, " ".join(words), None, None))
        marks.append((i, int(bad)))
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    small, large = (toxicity.fit(docs, labels, n) for n in (150, 5000))
    for grammar in (small, large):
        assert grammar.weight("idiot") is not None and grammar.weight("grumpy") is None
    for text in ("worda idiot", "wordb grumpy", "wordc", "you idiot", ""):
        assert small.score(text)[0] == pytest.approx(large.score(text)[0], abs=0.06), text
    assert large.score("wordc grumpy")[0] < 0.3 < large.score("some idiot")[0]
    # Labels without a document take no place in the sample.
    absent = spark.createDataFrame([(100_000 + i, 1) for i in range(3000)], "doc_id long, toxic int")
    crowded = toxicity.fit(docs, labels.unionByName(absent), 150)
    assert crowded.words == small.words and crowded.silent == small.silent


# --- personal data -----------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return kind == "email" or (16 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0)


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(4)
    bits = [*"0123456789" * 2, *"..--  @@a%+()\nZ_é,🙂", "4111 1111 1111 1111", "a@b.co", "1.2.3.4", "+1 (555) 123-4567", "300.1.1.1", "0001.2.3.4"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(80))) for _ in range(800)]
    texts += [None, "", "1 " * 30_000, "9" * 50_000, "a@b.c%d@e.f x@y", "a" * 50_000, "a@b.co " * 300]
    rows = [(i, t, None, None, 1, 2) for i, t in enumerate(texts)]
    found = pii.find_personal_data(frame(spark, rows, ", base int, term int")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [tuple(s) for s in r.base] == base_spans(texts[r.doc_id]), texts[r.doc_id]
        assert r.spans[: len(r.base)] == r.base


def test_long_parts_of_addresses(spark):
    texts = ["1.2.3." + "7" * 45, "1.2.3." + "0" * 45, "1.2.3." + "0" * 45 + "12", "0.0.0.0", "1.2.3.256", "1.2.3.0255", "1.2.3.999"]
    rows = [(i, f"at {t} now", None, None) for i, t in enumerate(texts)]
    found = {r.doc_id: r.base for r in pii.find_personal_data(frame(spark, rows)).collect()}
    for i, text, *_ in rows:
        assert [tuple(s) for s in found[i]] == base_spans(text), text


def test_disclosing_terms(spark):
    secret = [(i, f"Meet Zebulon at zeb@mail.example for lunch number {i} today", None, None) for i in range(20)]
    plain = [(100 + i, f"Meet someone for lunch number {i} today", None, None) for i in range(600)]
    lone = [(9000, "Where is Zebulon now", None, None), (9001, None, None, None), (None, "Zebulon", None, None)]
    docs = frame(spark, secret + plain + lone)
    shown = {r.doc_id: r.sanitised for r in pii.sanitise(docs).collect()}
    assert shown[0] == "Meet  at [EMAIL] for lunch number 0 today"
    assert shown[9000] == "Where is  now" and shown[None] == "" and shown[100] == "Meet someone for lunch number 0 today"
    assert shown[9001] is None or shown[9001] == ""
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_disclosing_terms_far_from_their_entity(spark):
    fill = "lorem ipsum dolor sit amet " * 12
    names = ["Bob", "AB12", "田中", "Zebulon", "कमल"]
    rows = [(i * 100 + k, f"Dear {name}, {fill} greetings from p{i}@mail.example", None, None) for i, name in enumerate(names) for k in range(8)]
    rows += [(5000 + i, f"Dear nobody, {fill} greetings", None, None) for i in range(700)]
    shown = {r.doc_id: r.sanitised for r in pii.sanitise(frame(spark, rows)).collect()}
    for i in range(len(names)):
        assert shown[i * 100] == f"Dear , {fill} greetings from [EMAIL]"
    assert shown[5000] == rows[-1][1]


def test_repeated_rows_are_one_document(spark):
    rows = [(i, f"Meet Zebulon via zeb@mail.example about number {i}", None, None) for i in range(20)]
    rows += [(100 + i, f"Meet someone about number {i}", None, None) for i in range(600)]
    lone = [(None, "Where is Zebulon", None, None)]
    once = {(r.doc_id, r.sanitised) for r in pii.sanitise(frame(spark, rows + lone)).collect()}
    assert (None, "Where is ") in once
    twice = pii.sanitise(frame(spark, rows * 2 + lone * 30)).collect()
    assert len(twice) == 2 * len(rows) + 30 and {(r.doc_id, r.sanitised) for r in twice} == once
    # A term that fewer documents show than the statistics ask for shows no more by coming twice.
    few = [(700 + i, f"Meet Quillon via quill@mail.example about number {i}", None, None) for i in range(2)]
    assert any("Quillon" in r.sanitised for r in pii.sanitise(frame(spark, (rows + few) * 2)).collect())


def test_personal_data_runs_no_python(spark, plan_of):
    plan = plan_of(pii.find_personal_data(frame(spark, odd_rows())))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
