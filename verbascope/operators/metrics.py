"""Score roll-ups. Three null policies: missing scores count as zero, are skipped, or fill only the denominator."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbascope.functions import scores as s
from verbascope.operators.joins import HOT_SHARE, SALTS, null_safe_join, small_side
from verbascope.operators.quantiles import order_bucket, quantiles, quantiles_of_counts
from verbascope.session import stable_copy, stable_table

# What names a row in files written per metric.
NATURAL_KEY = ("model", "dataset", "id1", "id2", "language")

# Bytes of a text's digest; shorter texts stand for themselves.
DIGEST = 16

QE_QUANTILES = {"median_comet_qe": 0.5, "p10_comet_qe": 0.1, "p90_comet_qe": 0.9}


def means_and_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, Column],
    value: Column,
    probabilities: Mapping[str, float],
) -> DataFrame:
    """Rows and means per group with exact quantiles of one column beside them; nulls are skipped.

    Both come from counts and sums per bucket of nearby values; ``df`` is read again for the buckets that hold a quantile.
    """
    narrow = df.select(*keys, value.cast("double").alias("__value"), *[c.cast("double").alias(name) for name, c in means.items()])
    return _from_buckets(narrow, keys, list(means), probabilities, [keys])[0]


def means_and_quantiles_of_levels(
    df: DataFrame,
    levels: Sequence[Sequence[str]],
    means: Mapping[str, Column],
    value: Column,
    probabilities: Mapping[str, float],
) -> list[DataFrame]:
    """:func:`means_and_quantiles` for several groupings, each a part of the first, in one go.

    ``df`` is read once, into a table of keys and figures. Sums and bucket counts of all groupings come from one
    aggregation over grouping sets, and the ranks of all of them are found together.
    """
    keys = levels[0]
    narrow = stable_table(df.select(*keys, value.cast("double").alias("__value"), *[c.cast("double").alias(name) for name, c in means.items()]))
    return _from_buckets(narrow, keys, list(means), probabilities, levels)


def _from_buckets(
    narrow: DataFrame, keys: Sequence[str], means: Sequence[str], probabilities: Mapping[str, float], levels: Sequence[Sequence[str]]
) -> list[DataFrame]:
    """Means and quantiles of each level from counts and sums per bucket of values, which are computed once."""
    known = F.col("__value").isNotNull() & ~F.isnan("__value")
    bucketed = narrow.withColumns({"__bucket": F.when(known, order_bucket(F.col("__value"))), "__known": F.when(known, F.col("__value"))})
    sums = [f(F.col(name)).alias(f"__{kind}_{name}") for name in means for kind, f in (("sum", F.sum), ("n", F.count))]
    figures = [F.count(F.lit(1)).alias("__rows"), F.count("__known").alias("__in_bucket"), F.min("__known").alias("__least"), F.max("__known").alias("__most"), *sums]
    if len(levels) == 1:
        counted = bucketed.groupBy(*keys, "__bucket").agg(*figures).withColumn("__level", F.lit(0))
    else:
        sets = [[F.col(c) for c in (*level, "__bucket")] for level in levels]
        columns = [F.col(c) for c in (*keys, "__bucket")]
        # The bits of a grouping id say which keys a row's level leaves out.
        out = {level_id: n for n, level in enumerate(levels) for level_id in [sum(2 ** (len(keys) - i) for i, k in enumerate(keys) if k not in level)]}
        number = F.create_map(*[F.lit(x) for pair in out.items() for x in pair])
        counted = bucketed.groupingSets(sets, *columns).agg(*figures, F.grouping_id().alias("__id"))
        counted = counted.withColumn("__level", number[F.col("__id").cast("int")]).drop("__id")
    counted = stable_copy(counted)
    group = [*keys, "__level"]
    plain = counted.groupBy(*group).agg(
        F.sum("__rows").alias("n_rows"), *[F.try_divide(F.sum(f"__sum_{name}"), F.sum(f"__n_{name}")).alias(name) for name in means]
    )
    numbers = F.explode(F.array(*[F.lit(n) for n in range(len(levels))]))
    rows = narrow.select(*keys, "__value").withColumn("__level", numbers)
    for key in keys:
        holding = [n for n, level in enumerate(levels) if key in level]
        if len(holding) < len(levels):
            rows = rows.withColumn(key, F.when(F.col("__level").isin(holding), F.col(key)))
    buckets = counted.where(F.col("__bucket").isNotNull()).select(*group, "__bucket", "__in_bucket", "__least", "__most")
    spread = quantiles(rows, group, F.col("__value"), probabilities, buckets)
    whole = null_safe_join(plain, spread, group, "left")
    if len(levels) > 1:
        whole = stable_copy(whole)
    return [whole.where(F.col("__level") == n).select(*level, "n_rows", *means, *probabilities) for n, level in enumerate(levels)]


def means_and_quantiles_in_one_pass(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, Column],
    value: Column,
    probabilities: Mapping[str, float],
) -> DataFrame:
    """The same for inputs that are costly to read and values that repeat, such as lengths of texts.

    Sums per distinct value are written once; means and quantiles both come from that small table.
    """
    given = df.select(*keys, value.cast("double").alias("__value"), *[c.alias(name) for name, c in means.items()])
    sums = [f(F.col(name)).alias(f"__{kind}_{name}") for name in means for kind, f in (("sum", F.sum), ("n", F.count))]
    counts = stable_copy(given.groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__n"), *sums))
    plain = counts.groupBy(*keys).agg(
        F.sum("__n").alias("n_rows"),
        *[F.try_divide(F.sum(f"__sum_{name}"), F.sum(f"__n_{name}")).alias(name) for name in means],
    )
    known = counts.where(F.col("__value").isNotNull() & ~F.isnan("__value")).select(*keys, "__value", "__n")
    spread = quantiles_of_counts(known, keys, probabilities)
    return null_safe_join(plain, spread, keys, "left").select(*keys, "n_rows", *means, *probabilities)


def _block_means(threshold: float) -> dict[str, Column]:
    return {
        "mean_ifeval": s.zero_filled(F.col("ifeval")),
        "mean_comet_qe": s.zero_filled(F.col("comet_qe")),
        "joint_pass_rate": s.joint_pass(F.col("ifeval"), F.col("comet_qe"), threshold),
    }


def metric_block(df: DataFrame, keys: Sequence[str], threshold: float = s.JOINT_THRESHOLD) -> DataFrame:
    """Rows, mean cleanliness, quality mean and quantiles, and joint pass rate; missing scores count as zero."""
    return means_and_quantiles(df, keys, _block_means(threshold), s.zero_filled(F.col("comet_qe")), QE_QUANTILES)


def metric_blocks(df: DataFrame, levels: Sequence[Sequence[str]], threshold: float = s.JOINT_THRESHOLD) -> list[DataFrame]:
    """:func:`metric_block` for several groupings, each a part of the first, from one reading of ``df``."""
    return means_and_quantiles_of_levels(df, levels, _block_means(threshold), s.zero_filled(F.col("comet_qe")), QE_QUANTILES)


def headline(df: DataFrame, threshold: float = s.JOINT_THRESHOLD) -> DataFrame:
    """Metric block per model and dataset of already filtered rows; rows without a key are left out."""
    keys = ["model", "dataset"]
    return (
        metric_block(df.na.drop(subset=keys), keys, threshold)
        .withColumnsRenamed({"n_rows": "n", "joint_pass_rate": "joint_pass"})
        .orderBy("dataset", "model")
    )


def mean_by_language(df: DataFrame) -> DataFrame:
    """Mean quality per model, dataset and language; missing scores skipped, rows without a key left out."""
    keys = ["model", "dataset", "language"]
    return df.na.drop(subset=keys).groupBy(*keys).agg(F.avg("comet_qe").alias("comet_qe"))


def quality_summary(df: DataFrame, keys: Sequence[str] = ("model", "dataset"), half_even: bool = False) -> DataFrame:
    """All rows counted; quality mean and quantiles over scored rows, to 4 places."""
    quality = F.col("comet_qe")
    block = means_and_quantiles(df, keys, {"mean_comet_qe": quality}, quality, QE_QUANTILES)
    figures = ["mean_comet_qe", *QE_QUANTILES]
    return block.select(*keys, "n_rows", *[s.rounded(F.col(c), 4, half_even).alias(c) for c in figures])


def quality_by_language(df: DataFrame, keys: Sequence[str] = ("model", "dataset"), half_even: bool = False) -> DataFrame:
    """Mean quality per language code value within each file, to 4 places."""
    mean = s.rounded(F.avg("comet_qe"), 4, half_even).alias("mean_comet_qe")
    return df.na.drop(subset=["lang_codes"]).groupBy(*keys, "lang_codes").agg(mean)


def cleanliness_summary(df: DataFrame, keys: Sequence[str] = ("model", "dataset"), half_even: bool = False) -> DataFrame:
    """Rows, mean cleanliness to 4 places and as a percentage to 1 place."""
    mean = F.avg("ifeval")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        s.rounded(mean, 4, half_even).alias("mean_ifeval"),
        s.rounded(mean * 100, 1, half_even).alias("ifeval_clean_pct"),
    )


def reference_summary(df: DataFrame, keys: Sequence[str] = ("model", "dataset"), half_even: bool = False) -> DataFrame:
    """Rows and mean reference-based quality to 4 places."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), s.rounded(F.avg("comet"), 4, half_even).alias("mean_comet_ref")
    )


def score_averages(df: DataFrame, keys: Sequence[str] = ("model", "dataset")) -> DataFrame:
    """Averages of whichever score columns are present."""
    present = [c for c in ("ifeval", "comet", "comet_qe") if c in df.columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in present])


def model_stats(df: DataFrame, keys: Sequence[str] = ("model", "dataset")) -> DataFrame:
    """Rows, mean scores, copied-source and slang shares, and mean quality per slang track.

    A figure whose column the input lacks is null.
    """
    have = set(df.columns)
    missing = F.lit(None).cast("double")

    def when_present(figure, *needed: str) -> Column:
        return figure() if have >= set(needed) else F.max(missing)

    def track_mean(label: str):
        return lambda: F.avg(F.when(F.col("slang_bucket") == label, F.col("comet_qe")))

    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        when_present(lambda: F.avg("comet_qe"), "comet_qe").alias("comet_qe"),
        when_present(lambda: F.avg("ifeval"), "ifeval").alias("ifeval"),
        when_present(lambda: s.percent_equal(F.col("source_copy"), True), "source_copy").alias("src_copy_pct"),
        when_present(lambda: s.percent_equal(F.col("slang_bucket"), "slang"), "slang_bucket").alias("slang_pct"),
        when_present(track_mean("formal"), "slang_bucket", "comet_qe").alias("formal_comet_qe"),
        when_present(track_mean("slang"), "slang_bucket", "comet_qe").alias("slang_comet_qe"),
    )


def merge_metrics(outputs: Sequence[DataFrame], key: Sequence[str] | None = None, row_id: str = "row_id") -> DataFrame:
    """Bring separately computed score tables together: one row for each row of any output, all columns kept.

    ``key`` is what names a row in every output: by default those of :data:`NATURAL_KEY` that all have, else ``row_id``.
    Null keys match null keys; a score an output does not have is null. If an output has several rows of a key:

    - ids of one reading pair the rows of all keys. Such ids are neither null nor repeated in a key, and the other columns
      that all outputs have agree wherever they meet. Without such columns, each key's ids must all be in one output,
      and an output that lacks the last ids of a key, as if later rows had moved up, must show gaps in another;
    - else rows are paired by their place in the order of the ids, so ids that depend on how files were read don't
      count, if all outputs that have a key have as many rows of it, without ties;
    - else ValueError names the keys. A ``key`` that holds ``row_id`` says that the ids are the same in all outputs.

    Rows are paired without their texts, which go by a digest; each different text is shuffled once and put back last.
    """
    shared = set.intersection(*[set(o.columns) for o in outputs])
    keys = list(key or [c for c in NATURAL_KEY if c in shared] or [row_id])
    texts = _texts(outputs, row_id)
    if not texts:
        return _merged(outputs, keys, row_id)[0]
    narrow = [_kept(o.withColumns({c: _token(c) for c in texts if c in o.columns})) for o in outputs]
    try:
        merged, own = _merged(narrow, keys, row_id)
    except _Unclear as found:
        raise ValueError(found.said(_spelled(outputs, found, texts))) from None
    return _with_texts(merged, outputs, narrow, texts, keys, {c: row_id for c in own}).select(*[c for c in merged.columns if c not in own])


class _Unclear(ValueError):
    """Rows of these keys cannot be paired."""

    def __init__(self, row_id: str, rows: list):
        self.row_id, self.rows = row_id, [r.asDict() for r in rows]
        super().__init__(self.said(self.rows))

    def said(self, rows: list[dict]) -> str:
        named = "; ".join(", ".join(f"{k}={v!r}" for k, v in r.items()) for r in rows)
        return f"outputs differ in their rows of a key, and {self.row_id} cannot pair them (20 keys at most are shown): {named}"


def _merged(outputs: Sequence[DataFrame], keys: Sequence[str], row_id: str) -> tuple[DataFrame, list[str]]:
    """The outputs joined, and the column that tells rows of a key apart if they were paired by id."""
    shared = set.intersection(*[set(o.columns) for o in outputs])
    if not _repeats(outputs, keys):
        return reduce(lambda one, two: _full_join(one, two, keys), [o.drop(*({row_id} - set(keys))) for o in outputs]), []
    maps = {f.name for o in outputs for f in o.schema if "map<" in f.dataType.simpleString() or f.dataType.typeName() == "variant"}
    found = _pairing(outputs, keys, row_id, sorted(shared - {*keys, row_id} - maps))
    seen = found.agg(
        F.max("repeated").alias("repeated"), F.min("alone").alias("alone"), F.min("agree").alias("agree"), F.min("within").alias("within"),
        *[F.max(f"{c}{i}").alias(f"{c}{i}") for c in ("met", "gap", "cut") for i in range(len(outputs))],
    ).first()
    by_id = False
    if seen["repeated"]:
        vouched = seen["agree"] and all(seen[f"met{i}"] for i in range(len(outputs)))
        nested = seen["agree"] is None and seen["within"] and all(seen[f"gap{i}"] or not seen[f"cut{i}"] for i in range(len(outputs)))
        by_id = bool(row_id not in keys and seen["alone"] and (vouched or nested))
        if not by_id and (unclear := found.where("repeated and not placed").select(*keys).limit(20).collect()):
            raise _Unclear(row_id, unclear)
    if by_id:  # An id is there once in a key and output, so no places are needed.
        named = [o.withColumnRenamed(row_id, "__own") for o in outputs]
        return reduce(lambda one, two: _full_join(one, two, [*keys, "__own"]), named), ["__own"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(row_id))
    numbered = [o.withColumn("__nth", place).drop(*({row_id} - set(keys))) for o in outputs]
    return reduce(lambda one, two: _full_join(one, two, [*keys, "__nth"]), numbered).drop("__nth"), []


def _texts(outputs: Sequence[DataFrame], row_id: str) -> list[str]:
    """Columns that are plain strings wherever they are, without the short ones that name a row."""
    fields = [f for o in outputs for f in o.schema if f.name not in (*NATURAL_KEY, row_id)]
    other = {f.name for f in fields if f.dataType != T.StringType()}
    return list(dict.fromkeys(f.name for f in fields if f.name not in other))


def _token(text: str) -> Column:
    """Short texts as their bytes, others as a digest of DIGEST bytes."""
    return F.when(F.octet_length(text) < DIGEST, F.col(text).cast("binary")).otherwise(F.unhex(F.md5(text)))


def _is_digest(token: str) -> Column:
    return F.coalesce(F.octet_length(token) == DIGEST, F.lit(False))


def _kept(narrow: DataFrame) -> DataFrame:
    """Computed once; parquet cannot hold all types."""
    kinds = " ".join(f.dataType.simpleString() for f in narrow.schema)
    return stable_copy(narrow) if "void" in kinds or "interval" in kinds else stable_table(narrow)


def _spelled(outputs: Sequence[DataFrame], found: _Unclear, texts: Sequence[str]) -> list[dict]:
    """Rows of keys with the texts that their tokens stand for."""
    rows = found.rows
    for c in [c for c in texts if c in rows[0]]:
        asked = list({bytes(r[c]) for r in rows if r[c] is not None})
        pairs = [o.select(_token(c).alias("token"), F.col(c).alias("text")).where(F.col("token").isin(asked)) for o in outputs]
        text = {bytes(r.token): r.text for r in reduce(DataFrame.unionByName, pairs).distinct().collect()} if asked else {}
        rows = [r | {c: None if r[c] is None else text[bytes(r[c])]} for r in rows]
    return rows


def _with_texts(
    merged: DataFrame, outputs: Sequence[DataFrame], narrow: Sequence[DataFrame], texts: Sequence[str], keys: Sequence[str], own: Mapping[str, str]
) -> DataFrame:
    """``merged`` with the texts of its tokens. ``own``: its columns that have another name in the outputs.

    A text is sent from the first output that has it; map-side aggregation sends one copy of those a task meets again.
    Very common texts are spread by the keys of their rows, which are the same in ``merged`` and in the output.
    """
    kinds = {f.name: f.dataType for f in merged.schema}
    hashed = lambda names: F.xxhash64(*[F.col(c).cast(kinds[k]) for k, c in names.items()])
    row = hashed({k: k for k in keys} | dict(own))
    held = [
        n.select(row.alias("__row"), F.lit(i).alias("__out"), F.inline(F.array(*[F.struct(F.lit(texts.index(c)).alias("__in"), F.col(c).alias("__token")) for c in texts if c in n.columns])))
        for i, n in enumerate(narrow) if set(texts) & set(n.columns)
    ]
    held = reduce(DataFrame.unionByName, held).where(_is_digest("__token"))
    counted = stable_copy(held.groupBy("__token", "__in").agg(F.count(F.lit(1)).alias("n")))
    rows = {texts[r["__in"]]: r["n"] for r in counted.groupBy("__in").agg(F.sum("n").alias("n")).collect()}
    long = [c for c in texts if c in rows]
    if long:
        often = counted.where(F.col("n") > sum(rows.values()) * HOT_SHARE).where("n > 1")
        hot = [bytes(r["__token"]) for r in often.select("__token").distinct().collect()]

        def salt(token: str, row: Column) -> Column:
            # Never a constant, even if nothing is hot: Spark drops constants from groups, and would then shuffle the texts again to join them.
            return F.pmod(row, F.when(F.col(token).isin(hot), F.lit(SALTS)).otherwise(F.lit(1)).cast("long")).alias("__salt")

        place = ["__token", "__salt"]
        homes = held.select("__token", salt("__token", F.col("__row")), "__out").groupBy(*place).agg(F.min("__out").alias("__out"))
        first = min(i for i, o in enumerate(outputs) if set(long) & set(o.columns))
        late, _ = small_side(homes.where(F.col("__out") > first))
        sent = []
        for i in [first, *sorted(r["__out"] for r in late.select("__out").distinct().collect())]:
            o = outputs[i]
            pairs = F.inline(F.array(*[F.struct(_token(c).alias("__token"), F.col(c).alias("__text")) for c in long if c in o.columns]))
            row_of = o.withColumns({f"__key{j}": _token(k) if k in texts else F.col(k) for j, k in enumerate(keys)})
            names = {k: f"__key{j}" for j, k in enumerate(keys)} | dict(own)
            pairs = row_of.select(hashed(names).alias("__row"), pairs).where(_is_digest("__token")).select("__token", salt("__token", F.col("__row")), "__text")
            sent.append(pairs if i == first else pairs.join(late.where(F.col("__out") == i).select(*place), place, "left_semi"))
        store = reduce(DataFrame.unionByName, sent).groupBy(*place).agg(F.first("__text").alias("__text"))
        row = hashed({k: k for k in (*keys, *own)})
        merged = merged.withColumn("__row", row)
    for c in texts:
        spelled = F.col(c).cast("string")
        if c in long:
            # Rows without a digest match nothing and are spread by their keys.
            to = {"__token": F.when(_is_digest(c), F.col(c)), "__salt": F.when(_is_digest(c), salt(c, F.col("__row"))).otherwise(F.col("__row"))}
            merged = merged.withColumns(to).join(store, place, "left")
            lost = F.raise_error(F.lit(f"a text of {c} was not there when the outputs were read again"))
            spelled = F.when(_is_digest(c), F.coalesce("__text", lost)).otherwise(spelled)
        merged = merged.withColumn(c, spelled).drop("__token", "__salt", "__text")
    return merged.drop("__row")


def _repeats(outputs: Sequence[DataFrame], keys: Sequence[str]) -> bool:
    """Has any output several rows of one key?"""
    named = reduce(DataFrame.unionByName, [o.select(*keys, F.lit(i).alias("__out")) for i, o in enumerate(outputs)])
    return not named.groupBy(*keys, "__out").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _pairing(outputs: Sequence[DataFrame], keys: Sequence[str], row_id: str, texts: Sequence[str]) -> DataFrame:
    """What the rows of each key say: is it repeated in an output, and can ids or places pair its rows?"""
    every = range(len(outputs))
    text = F.xxhash64(*texts) if texts else F.lit(None).cast("long")
    ids = [o.select(*keys, F.col(row_id).alias("__id"), F.lit(i).alias("__out"), text.alias("__text")) for i, o in enumerate(outputs)]
    counts = [F.count_if(F.col("__out") == i).alias(f"__n{i}") for i in every]
    outs = F.size(F.collect_set("__out")).alias("__outs")
    each = reduce(DataFrame.unionByName, ids).groupBy(*keys, "__id").agg(*counts, outs, F.min("__text").alias("__a"), F.max("__text").alias("__z"))
    n = [F.col(f"__n{i}") for i in every]
    rows, last, lacks = [[F.col(f"__{c}{i}") for i in every] for c in ("rows", "last", "lacks")]
    figures = [F.count(F.lit(1)).alias("__ids"), F.count_if(F.col("__id").isNull()).alias("__nulls"), F.max(reduce(_greater, n)).alias("__most")]
    figures += [F.min(F.when(F.col("__outs") > 1, F.col("__a") == F.col("__z"))).alias("__same")]
    for i in every:
        figures += [F.sum(n[i]).alias(f"__rows{i}"), F.max((n[i] > 0) & (F.col("__outs") > 1)).alias(f"met{i}")]
        figures += [F.max(F.when(n[i] > 0, F.col("__id"))).alias(f"__last{i}"), F.min(F.when(n[i] == 0, F.col("__id"))).alias(f"__lacks{i}")]
    found = each.groupBy(*keys).agg(*figures)
    largest = reduce(_greater, rows)
    as_many = reduce(lambda a, b: a & b, [(r == 0) | (r == largest) for r in rows])
    # Rows without an order between them have no place, unless one output alone has the key.
    single = reduce(lambda a, b: a + b, [(r > 0).cast("int") for r in rows]) == 1
    return found.select(
        *keys,
        (largest > 1).alias("repeated"),
        ((F.col("__nulls") == 0) & (F.col("__most") <= 1)).alias("alone"),
        F.col("__same").alias("agree"),
        (F.col("__ids") == largest).alias("within"),
        (as_many & ((F.col("__most") <= 1) | single)).alias("placed"),
        *[F.col(f"met{i}") for i in every],
        *[((rows[i] > 0) & F.coalesce(lacks[i] < last[i], F.lit(False))).alias(f"gap{i}") for i in every],
        *[((rows[i] > 0) & F.coalesce(lacks[i] > last[i], F.lit(False))).alias(f"cut{i}") for i in every],
    )


def _greater(one: Column, two: Column) -> Column:
    return F.when(one >= two, one).otherwise(two)


def _full_join(one: DataFrame, two: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe full join; a column both sides have comes from the first that has a value."""
    other = two.withColumnsRenamed({c: f"__two_{c}" for c in two.columns})
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__two_{k}")) for k in keys])
    both = [F.coalesce(c, f"__two_{c}").alias(c) if c in two.columns else F.col(c) for c in one.columns]
    added = [F.col(f"__two_{c}").alias(c) for c in two.columns if c not in one.columns]
    return one.join(other, matches, "full").select(*both, *added)


def judge_quality(df: DataFrame, positive: int = 1) -> DataFrame:
    """Precision, recall and F1 of every judge's ``pred`` against ``gold``."""
    said, true = F.col("pred") == positive, F.col("gold") == positive
    counted = df.groupBy("judge").agg(
        F.count_if(said & true).alias("tp"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & true).alias("fn"),
    )
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    return counted.select(
        "*",
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def judge_accepted(quality: DataFrame, candidate: str, baseline: str, margin: float = 0.05) -> DataFrame:
    """Is the candidate's F1 at least ``margin`` above the baseline's?"""
    f1 = lambda judge: F.max(F.when(F.col("judge") == judge, F.col("f1")))
    return quality.agg(f1(candidate).alias("candidate_f1"), f1(baseline).alias("baseline_f1")).withColumn(
        "accepted", F.col("candidate_f1") - F.col("baseline_f1") >= margin
    )
