import json
import random

import pytest
from pyspark.sql import functions as F

from verbascope.operators import joins, lexicon

WORDS = ["gak", "yg", "bgt", "buku", "rumah", "merah", "a", "É"]


@pytest.fixture(scope="module")
def slang(spark):
    return spark.createDataFrame([("gak", "tidak"), ("yg", "yang"), ("é", "e"), ("don't", "do not"), ("Bgt", "banget")],
                                 "slang string, formal string")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    data = [(i, "id" if i % 4 else "ms", " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))) for i in range(120)]
    data += [(200, "id", None), (201, "id", ""), (202, "id", "gak GAK yg! 12 gak_yg")]
    return spark.createDataFrame(data, "row_id bigint, lang_codes string, source string").cache()


def density(text, words):
    import re

    tokens = [w.lower() for w in re.findall(r"[^\W\d_]+", text or "")]
    hits = sum(w in words for w in tokens)
    return (hits / len(tokens) if tokens else 0.0), hits, len(tokens)


@pytest.mark.parametrize("entries", [lexicon.LITERAL_ENTRIES, 2, 0])
def test_density_matches_python(rows, slang, entries):
    words = {r.slang for r in slang.collect()}
    got = lexicon.with_density(rows, slang, literal_entries=entries).collect()
    assert len(got) == 123
    for r in got:
        assert (r.slang_density, r.slang_hits, r.n_tokens) == density(r.source, words)
        assert 0 <= r.slang_density <= 1


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_joined_density_of_copies(rows, slang, monkeypatch, limit):
    """Copies share out their hits, null ids and texts included, on either side of the broadcast limit."""
    monkeypatch.setattr(lexicon, "small_side", lambda df: joins.small_side(df, limit))
    thrice = rows.unionByName(rows).unionByName(rows.withColumn("row_id", F.lit(None).cast("bigint")))
    words = {r.slang for r in slang.collect()}
    got = lexicon.with_density(thrice, slang, literal_entries=0).collect()
    assert len(got) == 3 * 123
    for r in got:
        assert (r.slang_density, r.slang_hits, r.n_tokens) == density(r.source, words)


def test_joined_density_writes_no_corpus(rows, slang, plan_of):
    plan = plan_of(lexicon.with_density(rows, slang, literal_entries=0))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_empty_lexicon(rows, slang):
    assert lexicon.with_density(rows, slang.where("false")).agg(F.sum("slang_hits")).first()[0] == 0


def test_density_stays_narrow(rows, slang, plan_of):
    plan = plan_of(lexicon.with_density(rows, slang))
    assert "Exchange" not in plan and "Python" not in plan


def test_enrich_twice_is_once(rows, slang):
    once, changed = lexicon.enrich(rows, slang)
    twice, again = lexicon.enrich(once, slang)
    assert changed and not again and twice is once
    redone, forced = lexicon.enrich(once, slang, overwrite=True)
    assert forced and redone.columns == once.columns
    assert sorted(map(str, redone.collect())) == sorted(map(str, once.collect()))
    with pytest.raises(ValueError):
        lexicon.enrich(rows, slang, text="nothing")


def test_build_lexicon(spark):
    raw = [(" GAK ", "Tidak", 3), ("gak", "nggak", 7), ("gak", "bukan", 1), ("sama", "SAMA", 2), ("  ", "x", 4),
           (None, "y", 5), ("kosong", None, 6)]
    built = lexicon.build_lexicon(spark.createDataFrame(raw, "slang string, formal string, row_id int"))
    assert {r.slang: r.formal for r in built.collect()} == {"gak": "bukan", "kosong": ""}


def python_split(rows, n_slang, lang="id", min_tokens=5):
    kept = [r for r in rows if r.lang_codes == lang and r.n_tokens >= min_tokens]
    kept.sort(key=lambda r: r.row_id)
    kept.sort(key=lambda r: (r.slang_density, r.slang_hits), reverse=True)
    return kept[:n_slang], kept[n_slang:]


@pytest.mark.parametrize("n_slang", [0, 1, 7, 1000])
@pytest.mark.parametrize("direct", [1_000_000, 0])
def test_split_tracks(rows, slang, n_slang, direct):
    dense = lexicon.with_density(rows, slang)
    labelled = lexicon.split_tracks(dense, n_slang, "id", direct=direct).collect()
    assert len(labelled) == 123
    top, rest = python_split(dense.collect(), n_slang)
    by_label = lambda label: {r.row_id for r in labelled if r.slang_bucket == label}
    assert by_label("slang") == {r.row_id for r in top}
    assert by_label("formal") == {r.row_id for r in rest}


@pytest.mark.parametrize("n_slang", [1, 2, 7, 8, 1000])
def test_split_report(rows, slang, n_slang):
    dense = lexicon.with_density(rows, slang)
    top, _ = python_split(dense.collect(), n_slang)
    densities, hits = [r.slang_density for r in top], [r.slang_hits for r in top]
    row = lexicon.split_report(dense, n_slang, "id").first()
    n = len(top)
    assert (row.n_slang, row.min_density, row.max_density) == (n, min(densities), max(densities))
    assert (row.median_density, row.median_hits) == (densities[n // 2], sorted(hits)[n // 2])
    assert (row.min_hits, row.max_hits, row.cutoff_density) == (min(hits), max(hits), densities[-1])


def test_nothing_eligible(rows, slang):
    dense = lexicon.with_density(rows, slang)
    assert lexicon.split_tracks(dense, 5, "id", min_tokens=99).where("slang_bucket is not null").count() == 0
    row = lexicon.split_report(dense, 5, "id", min_tokens=99).first()
    assert (row.n_slang, row.median_density, row.cutoff_density) == (0, None, None)
    summary = lexicon.slang_summary(dense, min_tokens=99).first()
    assert (summary.n_rows, summary.mean_density) == (0, None)


def test_rescore_selection(rows, slang):
    dense = lexicon.with_density(rows, slang).withColumn("model", F.col("lang_codes"))
    got = lexicon.rescore_selection(dense, n=4).collect()
    top, _ = python_split(dense.collect(), 4)
    assert {r.row_id for r in got if r.model == "id"} == {r.row_id for r in top}


def test_same_result_however_partitioned(rows, slang):
    def labels(frame):
        dense = lexicon.with_density(frame, slang)
        return sorted(json.dumps(r.asDict()) for r in lexicon.split_tracks(dense, 9, "id").collect())

    assert labels(rows.repartition(1)) == labels(rows.repartition(7, "source"))
