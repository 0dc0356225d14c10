import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from verbascope.functions import scores as s
from verbascope.operators import filters, metrics
from verbascope.plans import explore, profile, stats, summary

SCHEMA = (
    "row_id bigint, model string, dataset string, language string, id1 string, id2 string, source string, "
    "hypothesis string, reference string, ifeval double, comet_qe double, comet double"
)


@pytest.fixture(scope="module")
def pandas_rows():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        rows.append((
            i, rng.choice(["o/a", "o/b", "o/c"]), rng.choice(["mono_sea", "mono_me"]), rng.choice(["id", "ms", None]),
            rng.choice(["s1", None]), str(rng.randint(0, 25)), f"source {i % 9}\nline", rng.choice([f"HYP {i}", None, ""]),
            rng.choice(["ref", None]), rng.choice([0.0, 1.0, None]), rng.choice([round(rng.random(), 2), None]),
            rng.choice([round(rng.random(), 3), None]),
        ))
    return pd.DataFrame(rows, columns=[part.split()[0] for part in SCHEMA.split(", ")])


@pytest.fixture(scope="module")
def scored(spark, pandas_rows):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pandas_rows.itertuples(index=False)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def meta(spark):
    rows = [("o/a", "mono_sea", 200, 5, 12.5, 16.0, 32), ("o/b", "mono_sea", 0, 0, 0.0, None, 32),
            ("o/c", "mono_me", 100, None, 9.0, 11.1, None)]
    return spark.createDataFrame(
        rows, "model string, dataset string, n_rows bigint, n_errors bigint, elapsed_seconds double, "
        "req_per_s double, concurrency bigint"
    )


def block(frame, threshold=0.8):
    ifeval, quality = frame.ifeval.fillna(0), frame.comet_qe.fillna(0)
    return {
        "mean_ifeval": ifeval.mean(), "mean_comet_qe": quality.mean(), "median_comet_qe": quality.median(),
        "p10_comet_qe": quality.quantile(0.1), "p90_comet_qe": quality.quantile(0.9),
        "joint_pass_rate": ((ifeval >= 1) & (quality >= threshold)).mean(),
    }


def check(row, want):
    for name, value in want.items():
        assert row[name] == pytest.approx(value, abs=1e-12), name


def test_overall(scored, meta, pandas_rows):
    got = {(r.model, r.dataset): r for r in summary.overall(scored, meta).collect()}
    groups = dict(list(pandas_rows.groupby(["model", "dataset"])))
    assert set(got) == set(groups)
    for key, frame in groups.items():
        assert got[key].n_rows_scored == len(frame)
        check(got[key], block(frame))
    assert got["o/a", "mono_sea"].error_rate == pytest.approx(0.025)
    assert got["o/b", "mono_sea"].n_source_rows == 0 and got["o/b", "mono_sea"].error_rate is None
    assert got["o/c", "mono_me"].error_rate is None and got["o/c", "mono_me"].req_per_s == 11.1
    assert got["o/a", "mono_me"].n_source_rows is None


def test_by_language_keeps_missing_language(scored, pandas_rows):
    got = {(r.model, r.dataset, r.language): r for r in summary.by_language(scored, low_sample=20).collect()}
    groups = pandas_rows.fillna({"language": "?"}).groupby(["model", "dataset", "language"])
    assert len(got) == len(groups)
    for (model, dataset, language), frame in groups:
        row = got[model, dataset, None if language == "?" else language]
        assert row.n_rows == len(frame) and row.low_sample == (len(frame) < 20)
        assert row.joint_pass_rate <= row.mean_ifeval
        check(row, block(frame))
    totals = {}
    for (model, dataset, _), row in got.items():
        totals[model, dataset] = totals.get((model, dataset), 0) + row.n_rows
    assert totals == {k: len(v) for k, v in pandas_rows.groupby(["model", "dataset"])}


def test_skipping_summaries(scored, pandas_rows):
    quality = {(r.model, r.dataset): r for r in metrics.quality_summary(scored, half_even=True).collect()}
    clean = {(r.model, r.dataset): r for r in metrics.cleanliness_summary(scored).collect()}
    reference = {(r.model, r.dataset): r for r in metrics.reference_summary(scored).collect()}
    for key, frame in pandas_rows.groupby(["model", "dataset"]):
        values = frame.comet_qe.dropna()
        assert quality[key].n_rows == len(frame)
        assert quality[key].mean_comet_qe == pytest.approx(round(values.mean(), 4), abs=1e-9)
        assert quality[key].p10_comet_qe == pytest.approx(round(np.percentile(values, 10), 4), abs=1e-9)
        assert clean[key].ifeval_clean_pct == pytest.approx(round(frame.ifeval.mean() * 100, 1), abs=0.1)
        assert reference[key].mean_comet_ref == pytest.approx(frame.comet.mean(), abs=1e-4)


def test_rounding_choices(spark):
    row = spark.range(1).select(
        s.rounded(F.lit(0.125), 2).alias("up"), s.rounded(F.lit(0.125), 2, half_even=True).alias("even")
    ).first()
    assert (row.up, row.even) == (0.13, 0.12)


def test_model_stats(scored):
    tracked = scored.withColumns({
        "source_copy": F.when(F.col("row_id") % 3 == 0, True), "slang_bucket": F.when(F.col("row_id") % 2 == 0, "slang"),
    })
    row = metrics.model_stats(tracked, ["dataset"]).where("dataset = 'mono_me'").first()
    mine = tracked.where("dataset = 'mono_me'").toPandas()
    assert row.src_copy_pct == pytest.approx(100 * (mine.row_id % 3 == 0).mean())
    assert row.slang_pct == pytest.approx(100 * (mine.row_id % 2 == 0).mean())
    assert row.slang_comet_qe == pytest.approx(mine[mine.row_id % 2 == 0].comet_qe.mean())
    assert row.formal_comet_qe is None
    bare = metrics.model_stats(scored.drop("comet_qe"), ["dataset"]).first()
    assert bare.comet_qe is None and bare.slang_pct is None and bare.ifeval is not None


def test_merge_metrics(spark):
    parts = [spark.createDataFrame(rows, f"row_id int, {name} double") for name, rows in (
        ("ifeval", [(1, 1.0), (2, 0.0)]), ("comet_qe", [(2, 0.5), (3, 0.6)]), ("comet", [(1, 0.1)]))]
    got = {r.row_id: (r.ifeval, r.comet, r.comet_qe) for r in metrics.merge_metrics(parts).collect()}
    assert got == {1: (1.0, 0.1, None), 2: (0.0, None, 0.5), 3: (None, None, 0.6)}


def test_merge_metrics_of_files_with_other_ids(spark):
    shape = "model string, dataset string, id1 string, id2 string, language string, source string, row_id int, {} double"
    one = [("m", "d", None, "1", "id", "a", 0, 1.0), ("m", "d", None, "1", "id", "b", 1, 0.0), ("n", "d", None, "1", "id", "c", 2, 0.5)]
    two = [("n", "d", None, "1", "id", "c", 0, 0.7), ("m", "d", None, "1", "id", "a", 5, 0.8), ("m", "d", None, "1", "id", "b", 6, 0.9)]
    parts = [spark.createDataFrame(one, shape.format("ifeval")), spark.createDataFrame(two, shape.format("comet_qe"))]
    got = sorted((r.model, r.source, r.ifeval, r.comet_qe) for r in metrics.merge_metrics(parts).collect())
    assert got == [("m", "a", 1.0, 0.8), ("m", "b", 0.0, 0.9), ("n", "c", 0.5, 0.7)]


def test_merge_metrics_of_repeated_keys(spark):
    shape = "model string, dataset string, id2 string, row_id int, {} double"

    def parts(*tables):
        return [spark.createDataFrame([("m", "d", *r) for r in rows], shape.format(name)) for name, rows in zip("abc", tables, strict=False)]

    def merged(outputs, **options):
        return sorted(((r.id2 or "", r.a, r.b) for r in metrics.merge_metrics(outputs, **options).collect()), key=repr)

    # Equal ids, and rows that one output lacks: of a null key and of a repeated one.
    one = [(None, i, float(i)) for i in range(5)] + [("x", 10 + i, 10.0 + i) for i in range(3)] + [("y", 20, 20.0)]
    two = [(k, i, v) for k, i, v in one if i not in (1, 11, 20)]
    want = sorted(((k or "", v, v if i not in (1, 11, 20) else None) for k, i, v in one), key=repr)
    assert merged(parts(one, two)) == want
    # Only the end is lacking, or ids of other readings: no telling which rows belong together.
    for other in ([r for r in one if r[1] != 4], [(k, i + 50, v) for k, i, v in two], [(k, None, v) for k, _, v in two]):
        with pytest.raises(ValueError, match="id2=None"):
            merged(parts(one, other))
    # Gaps elsewhere show that the ids are those of one reading.
    ends = [r for r in one if r[1] not in (4, 11)]
    assert [a for _, a, b in merged(parts(one, ends)) if b is None] == [4.0, 11.0]
    assert merged(parts(one, one[:4]), key=["model", "dataset", "id2", "row_id"])[3] == ("", 3.0, 3.0)


def text_outputs(spark, path, rows, shape, names):
    """Outputs of rows (key..., id, text, other text, score or None for each name), read again from files."""
    outputs = []
    for i, name in enumerate(names):
        mine = [(*r[:-1], r[-1][i]) for r in rows if r[-1][i] is not None]
        spark.createDataFrame(mine, f"{shape}, {name} double").repartition(3).write.parquet(f"{path}/{name}")
        outputs.append(spark.read.parquet(f"{path}/{name}"))
    return outputs


def test_merge_metrics_shuffles_a_text_once(spark, tmp_path, plan_of):
    """Texts are read for the result from the first output alone, and only from others if it lacks them."""
    rows = [(m, str(i), i, f"text {i} " * 40, None, (1.0, None if i == 3 else 2.0)) for i in range(50) for m in ("a", "b")]
    outputs = text_outputs(spark, tmp_path, rows, "model string, id2 string, row_id int, hypothesis string, note string", ["x", "y"])
    merged = metrics.merge_metrics(outputs)
    scans = [line for line in plan_of(merged).splitlines() if "FileScan" in line and str(tmp_path) in line and "hypothesis" in line.split("ReadSchema")[1]]
    assert scans and all(f"{tmp_path}/x" in line for line in scans)
    assert {(r.model, r.id2, r.hypothesis, r.note, r.x, r.y) for r in merged.collect()} == {(m, i, t, None, *v) for m, i, _, t, _, v in rows}


def test_merge_metrics_shuffles_rare_texts_once(spark, tmp_path, plan_of):
    """Without very common texts too, the join takes the texts as their aggregation has dealt them out."""
    rows = [("a", str(i), i, f"text {i} " * 40, (1.0, 2.0)) for i in range(1100)]
    outputs = text_outputs(spark, tmp_path, rows, "model string, id2 string, row_id int, hypothesis string", ["x", "y"])
    merged = metrics.merge_metrics(outputs)
    dealt = [line for line in plan_of(merged).splitlines() if "Exchange hashpartitioning(__token" in line]
    assert len(dealt) == 2 and all("__salt" in line for line in dealt)
    assert {(r.id2, r.hypothesis, r.x, r.y) for r in merged.collect()} == {(i, t, *v) for _, i, _, t, v in rows}


@pytest.mark.parametrize("repeated", [False, True])
def test_merge_metrics_of_texts(spark, tmp_path, repeated):
    """Null, empty, short, long and very common texts, of rows that the first output lacks too."""
    rng = random.Random(3)
    kinds = [None, "", "sixteen bytes ..", "fifteen bytes .", "ü" * 8, "common " * 30, "\u0000 " * 20]
    rows = []
    for i in range(300):
        values = tuple(rng.choice([None, i + j / 4]) for j in range(3))
        texts = [rng.choice([*kinds, f"text {i} " * 9, f"text {i % 9} " * 9]) for _ in range(2)]
        rows.append((rng.choice("ab"), None if repeated and i % 3 == 0 else str(i), i, *texts, values))
    rows = [r for r in rows if any(v is not None for v in r[-1])]
    shape = "model string, id2 string, row_id int, hypothesis string, note string"
    outputs = text_outputs(spark, tmp_path, rows, shape, ["x", "y", "z"])
    outputs = [o.withColumnRenamed("note", f"note_{o.columns[-1]}") if i else o for i, o in enumerate(outputs)]
    got = metrics.merge_metrics(outputs)
    assert got.columns == ["model", "id2", "hypothesis", "note", "x", "note_y", "y", "note_z", "z"]
    want = [(m, k, h, *(x for v in zip((n if a is not None else None for a in vs), vs) for x in v)) for m, k, _, h, n, vs in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_merge_metrics_takes_a_text_from_the_first_that_has_it(spark):
    shape = "id2 string, hypothesis string, {} double"
    one = spark.createDataFrame([("1", None, 1.0), ("2", "first " * 9, 2.0)], shape.format("x"))
    two = spark.createDataFrame([("1", "second " * 9, 3.0), ("2", "other " * 9, 4.0), ("3", "third " * 9, 5.0)], shape.format("y"))
    got = sorted(map(tuple, metrics.merge_metrics([one, two.withColumn("none", F.lit(None))]).collect()))
    assert got == [("1", "second " * 9, 1.0, 3.0, None), ("2", "first " * 9, 2.0, 4.0, None), ("3", "third " * 9, None, 5.0, None)]
    # A text in the key; then rows that cannot be told apart.
    got = metrics.merge_metrics([one, two], key=["id2", "hypothesis"], row_id="id2").count()
    assert got == 5
    shape = "hypothesis string, row_id int, {} double"
    one, two = (spark.createDataFrame([("long " * 9, r, 1.0) for r in ids], shape.format(c)) for c, ids in (("x", (1, 2)), ("y", (1,))))
    with pytest.raises(ValueError, match="hypothesis='long long"):
        metrics.merge_metrics([one, two], key=["hypothesis"])


def test_judges(spark):
    data = [("a", 1, 1), ("a", 1, 0), ("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("b", 0, 0)]
    quality = metrics.judge_quality(spark.createDataFrame(data, "judge string, pred int, gold int"))
    got = {r.judge: r for r in quality.collect()}
    assert (got["a"].precision, got["a"].recall) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert got["b"].precision is None and got["b"].f1 == 0
    assert metrics.judge_accepted(quality, "a", "b").first().accepted is True


def test_filters(scored, pandas_rows):
    frame = pandas_rows
    quality, clean = frame.comet_qe.fillna(0), frame.ifeval.fillna(0) >= 1

    def ids(**kwargs):
        return sorted(r.row_id for r in filters.select_rows(scored, **kwargs).collect())

    assert ids() == list(frame.row_id)
    assert ids(models=[], languages=["id"]) == list(frame[frame.language == "id"].row_id)
    assert ids(ifeval="clean") == list(frame[clean].row_id)
    assert ids(ifeval="polluted", comet_qe=(0.0, 0.3)) == list(frame[~clean & quality.between(0, 0.3)].row_id)
    assert ids(text="yP 3") == list(frame[frame.hypothesis.fillna("").str.lower().str.contains("yp 3")].row_id)
    assert ids(text="%") == [] and ids(text="SOURCE 1\nL") == list(frame[frame.row_id % 9 == 1].row_id)
    assert ids(slang_density=(0.9, 1.0), min_slang_hits=5) == list(frame.row_id)
    with pytest.raises(ValueError):
        filters.select_rows(scored, ifeval="dirty")
    dense = scored.withColumns({"slang_density": F.lit(None).cast("double"), "slang_hits": F.lit(3)})
    assert filters.select_rows(dense, slang_density=(0.1, 1.0)).count() == 0
    assert filters.select_rows(dense, min_slang_hits=3).count() == 400


def test_drop_missing(scored, pandas_rows):
    assert filters.drop_missing(scored).count() == (pandas_rows.hypothesis.fillna("") != "").sum()
    counts = filters.count_missing(scored, []).first()
    assert counts.n_before == 400 and counts.n_dropped + counts.n_after == 400


def test_candidates_and_disagreements(scored, pandas_rows):
    keys = list(explore.SOURCE_KEY)
    models = pandas_rows.groupby(keys, dropna=False).model.nunique()
    found = explore.candidates(scored).collect()
    assert len(found) == (models >= 2).sum()
    spread = pandas_rows.groupby(keys).agg(n=("model", "nunique"), lo=("ifeval", "min"), hi=("ifeval", "max"))
    want = spread[(spread.n >= 2) & (spread.lo < 1) & (spread.hi >= 1)]
    got = explore.candidates(scored, disagreements=True).collect()
    assert {tuple(r[k] for k in keys) for r in got} == set(want.index)
    assert all(r.language == "id" for r in explore.candidates(scored, "mono_me", "id").collect())


def test_labels_and_references(scored, pandas_rows):
    keys = list(explore.SOURCE_KEY)
    first = pandas_rows.sort_values("row_id").drop_duplicates(keys)
    labels = explore.candidate_labels(scored, limit=None).collect()
    by_key = {tuple(None if pd.isna(v) else v for v in r[:4]): r[4] for r in first[[*keys, "source"]].itertuples(index=False)}
    for r in labels:
        shown = by_key[r.id1, r.id2, r.language, r.dataset].replace("\n", " ")
        assert r.label == f"[{r.dataset}/{r.language}]  {shown}"
    assert explore.candidate_labels(scored, limit=3).count() == 3
    assert all(r.reference == "ref" for r in explore.first_references(scored).collect())


def test_side_by_side(scored, pandas_rows):
    key = {"id1": None, "id2": "7", "language": None, "dataset": "mono_me"}
    got = explore.side_by_side(scored, key).collect()
    mine = pandas_rows[pandas_rows.id1.isna() & (pandas_rows.id2 == "7") & pandas_rows.language.isna()
                       & (pandas_rows.dataset == "mono_me")]
    assert [r.row_id for r in got] == list(mine.sort_values(["comet_qe", "row_id"], ascending=[False, True]).row_id)
    everything = explore.side_by_side_all(scored).collect()
    found = {tuple(r[k] for k in explore.SOURCE_KEY): r.n_rows for r in explore.candidates(scored).collect()}
    assert len(everything) == sum(found.values())


@pytest.mark.parametrize("order, column, rising, nulls", [
    ("worst", "comet_qe", True, "first"), ("best", "comet_qe", False, "last"), ("polluted", "ifeval", True, "last"),
])
def test_browse_orders(scored, pandas_rows, order, column, rising, nulls):
    columns = [column, "comet_qe"] if order == "polluted" else [column]
    want = pandas_rows.sort_values(columns, ascending=rising, na_position=nulls, kind="stable").head(60)
    got = explore.browse(scored, order, 60).collect()
    assert [r.row_id for r in got] == list(want.row_id)
    assert all("\n" not in r.source_preview and len(r.source_preview) <= 100 for r in got)


def test_model_tables(scored, meta, pandas_rows):
    counts = pandas_rows.groupby(["model", "dataset"]).size()
    got = {r.model: r for r in stats.coverage(scored).collect()}
    assert got["o/a"].mono_sea == f"ran ({counts['o/a', 'mono_sea']})" and got["o/a"].bilingual == "missing"
    assert {(r.model, r.dataset) for r in stats.speed(scored, meta).collect()} == {
        ("o/a", "mono_sea"), ("o/b", "mono_sea"), ("o/c", "mono_me"),
    }
    options = stats.option_values(scored).collect()
    assert [r.value for r in options if r.option == "language"] == ["id", "ms"]


def test_revisions(spark):
    frame = spark.createDataFrame([("m", "r2"), ("m", "r1"), ("m", "r2"), ("n", "x"), ("n", None)],
                                  "model string, model_revision string")
    got = {r.model: (r.model_revision, r.consistent) for r in stats.revisions(frame).collect()}
    assert got == {"m": ("r1,r2", False), "n": ("x", True)}


def test_profile(spark):
    rows = [("d", "ar,id", True, 2, 0.5, 4, 1), ("d", "ar", None, 1, None, 10, 3), ("e", None, False, None, 0.1, 0, 0)]
    frame = spark.createDataFrame(
        rows, "dataset string, lang_codes string, is_code_switched boolean, lang_count int, "
        "semantic_similarity double, text_chars int, text_words int"
    )
    got = {r.dataset: r for r in profile.source_profile(frame).collect()}
    assert (got["d"].n_rows, got["d"].mean_chars, got["d"].median_chars, got["d"].pct_code_switched) == (2, 7, 7, 1.0)
    assert got["d"].mean_sem_sim == 0.5 and got["d"].p90_chars == pytest.approx(9.4)
    counts = [(r.dataset, r.lang, r.n) for r in profile.language_counts(frame).collect()]
    assert counts == [("d", "ar", 2), ("d", "id", 1)]
    assert profile.language_count_sizes(frame).count() == 2
    assert {r.lang_codes for r in profile.language_breakdown(frame).collect()} == {"ar,id", "ar", None}


def test_both_levels_read_the_rows_once(spark, scored, meta, tmp_path, monkeypatch):
    from verbascope.operators import metrics as module

    path = str(tmp_path / "scored")
    scored.write.parquet(path)
    rows = spark.read.parquet(path)
    made = []
    original = module.stable_table
    monkeypatch.setattr(module, "stable_table", lambda df: made.append(df) or original(df))
    overall, languages = summary.both_levels(rows, meta)
    close = lambda a, b: all(x == pytest.approx(y, abs=1e-12) if isinstance(x, float) else x == y for x, y in zip(a, b))
    for got, want in ((overall, summary.overall(rows, meta)), (languages, summary.by_language(rows))):
        assert got.columns == want.columns
        order = [c for c in ("model", "dataset", "language") if c in got.columns]
        a, b = (sorted(df.collect(), key=lambda r: str([r[c] for c in order])) for df in (got, want))
        assert len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    assert len(made) == 1 and made[0].columns == ["model", "dataset", "language", "__value", "mean_ifeval", "mean_comet_qe", "joint_pass_rate"]
    for table in (overall, languages):
        assert path not in table._jdf.queryExecution().executedPlan().toString()


def test_alignment(spark):
    import numpy as np

    from verbascope.functions.scores import alignment

    rng = np.random.default_rng(5)
    pairs = [(rng.normal(size=(a, 4)), rng.normal(size=(b, 4))) for a, b in ((1, 1), (3, 5), (6, 2))]
    rows = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(pairs)]
    rows += [(10, [], [[1.0]]), (11, None, [[1.0]]), (12, [[0.0, 0.0]], [[1.0, 0.0]]), (13, [[2.0, 0.0]], [[5.0, 0.0], [0.0, 1.0]])]
    frame = spark.createDataFrame(rows, "id int, a array<array<double>>, b array<array<double>>")
    got = {r.id: r.s for r in frame.select("id", alignment(F.col("a"), F.col("b")).alias("s")).collect()}
    for i, (a, b) in enumerate(pairs):
        cosine = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
        precision, recall = cosine.max(axis=1).mean(), cosine.max(axis=0).mean()
        want = (precision, recall, 2 * precision * recall / (precision + recall))
        assert tuple(got[i]) == pytest.approx(want, abs=1e-12)
    assert tuple(got[10]) == tuple(got[11]) == (None, None, None)
    assert tuple(got[12]) == (0.0, 0.0, 0.0) and tuple(got[13]) == pytest.approx((1.0, 0.5, 2 / 3))
