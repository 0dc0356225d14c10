import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from verbascope.functions import text as t

WORD = re.compile(r"[^\W\d_]+")


def column(spark, values, make):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row.out for row in frame.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


SAMPLES = [
    "", None, "42 + 17", "a_b", "É Ñandú ß", "été", "ΟΔΟΣ ΣΑΣ", "İstanbul IŞIK", "x²y Ⅷ ⅷ Ⓐ", "مَرحبا بك", "สวัสดีครับ",
    "😀wow😀", "don't gak2 yg_x", "A B C", "ǅungla ŉ ﬁ",
]


def test_tokens_match_python(spark):
    expected = [[w.lower() for w in WORD.findall(v or "")] for v in SAMPLES]
    assert column(spark, SAMPLES, t.tokens) == expected


def test_letter_class_and_case_over_all_code_points(spark):
    """Every assigned code point that this Java knows gives the token Python gives it."""
    points = [c for c in range(1, sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    values = ["".join(chr(c) + " " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    got = column(spark, values, t.tokens)
    unknown_to_java = 0
    for text, tokens in zip(values, got):
        want = [w.lower() for w in WORD.findall(text)]
        extra = set(tokens) - set(want)
        assert not extra, extra
        unknown_to_java += len(set(want) - set(tokens))
    assert unknown_to_java < 7000


def test_whitespace_is_pythons(spark):
    assert sorted(t.WHITESPACE) == [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    texts = [f"{c}a{c}{c}b{c}" for c in t.WHITESPACE] + ["", " ", None, "​a​", "a᠎b"]
    assert column(spark, texts, t.word_count) == [len((v or "").split()) for v in texts]
    assert column(spark, texts, t.strip) == [v if v is None else v.strip() for v in texts]


@pytest.mark.parametrize("length", [0, 1, 499, 500, 501, 1200])
def test_truncate(spark, length):
    for unit in ("x", "😀"):
        text = unit * length
        want = text if length <= 500 else unit * 499 + "…"
        assert column(spark, [text], t.truncate) == [want]


def test_preview_and_lengths(spark):
    assert column(spark, [None, "a\nb", "z" * 80, "z" * 81], t.preview) == ["", "a b", "z" * 80, "z" * 79 + "…"]
    assert column(spark, [None, "", "😀a"], t.char_length) == [0, 0, 2]


def test_clip(spark):
    assert column(spark, [None, "a\nb", "z" * 140, "z" * 141], t.clip) == ["", "a b", "z" * 140, "z" * 140 + "…"]


def test_label(spark):
    frame = spark.createDataFrame([("d", "id", "x\ny"), ("d", None, "z")], "d string, l string, s string")
    got = [r[0] for r in frame.select(t.selector_label(F.col("d"), F.col("l"), F.col("s"))).collect()]
    assert got == ["[d/id]  x y", "[d/None]  z"]


NAMES = [
    "Org_LM-60-4B_mono_sea_scored.csv",
    "a_b_c_mono_me_scored.csv",
    "x_bilingual_scored.csv",
    "y_mono_sea_id_slang_scored.csv",
    "mono_sea_scored.csv",
]


def test_scored_names(spark):
    two, three = ("mono_sea", "mono_me"), ("mono_me", "mono_sea", "bilingual")
    assert column(spark, NAMES, lambda c: t.name_parts(c, two)[0]) == ["Org_LM-60-4B", "a_b_c", None, None, None]
    assert column(spark, NAMES, lambda c: t.model_from_slug(t.name_parts(c, two)[0])) == [
        "Org/LM-60-4B", "a/b_c", None, None, None,
    ]
    assert column(spark, NAMES, lambda c: t.name_parts(c, three)[1]) == ["mono_sea", "mono_me", "bilingual", None, None]
    assert column(spark, NAMES, t.dataset_of_scored_name) == ["mono_sea", "mono_me", "unknown", "unknown", "unknown"]


def test_file_names(spark):
    assert column(spark, ["a.b.jsonl", ".hidden", "x", "a..b"], t.file_stem) == ["a.b", ".hidden", "x", "a."]
    assert column(spark, ["org/m:7b"], t.model_slug) == ["org_m_7b"]
    made = column(spark, ["mono_sea.jsonl"], lambda c: t.translations_name(F.lit("org/m:7b"), c))
    assert made == ["org_m_7b_translations_mono_sea.csv"]
    assert column(spark, made, t.scored_name) == ["org_m_7b_mono_sea_scored.csv"]
    meta = column(spark, ["org_m_translations_mono_me.csv.meta.json"], lambda c: t.dataset_of_meta_name(c, F.lit("org_m")))
    assert meta == ["mono_me"]


def test_arguments():
    assert t.comma_list(" a, ,B ,") == ["a", "B"]
    assert t.comma_list("QE, Ref", lower=True) == ["qe", "ref"]
    assert t.comma_list(None) == []
    assert [t.row_limit(v) for v in (None, "", " None ", "null", "12")] == [None, None, None, None, 12]


def test_code_list(spark):
    assert column(spark, ["ar,id", " ar , ,id ", "", None], t.code_list) == [["ar", "id"], ["ar", "id"], [], []]
