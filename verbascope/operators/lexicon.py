"""Slang density of texts, and the slang / formal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.functions import text as t
from verbascope.operators.joins import small_side, spread_join
from verbascope.operators.quantiles import quantiles_of_counts, value_counts, values_at
from verbascope.operators.ranking import DIRECT_LIMIT, flag_first, top_per_group
from verbascope.session import stable_copy

ENRICHED = ("slang_density", "slang_hits", "n_tokens")

# Defaults of the split.
MIN_TOKENS = 5
N_SLANG = 1000
RESCORE_ROWS = 50
PREVIEW_ROWS = 3

# A lexicon up to this size travels inside the plan as a hash set; a larger one is joined.
LITERAL_ENTRIES = 50_000

SPLIT_ORDER = (("slang_density", True), ("slang_hits", True), ("row_id", False))


def build_lexicon(entries: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(slang, formal) pairs trimmed and lower-cased; blank or unchanged slang dropped, first mapping kept."""
    slang = F.lower(t.strip(t.text_or_empty(F.col("slang"))))
    formal = F.lower(t.strip(t.text_or_empty(F.col("formal"))))
    return (
        entries.select(slang.alias("slang"), formal.alias("formal"), row_id)
        .where((F.col("slang") != "") & (F.col("slang") != F.col("formal")))
        .groupBy("slang")
        .agg(F.min_by("formal", row_id).alias("formal"))
    )


def with_density(
    df: DataFrame, lexicon: DataFrame, text: str = "source", row_id: str = "row_id", literal_entries: int = LITERAL_ENTRIES
) -> DataFrame:
    """Add ``slang_density``, ``slang_hits`` and ``n_tokens`` to every row.

    Only entries that are a single token can match. As many as fit in the plan make this a narrow step: no
    join, no shuffle. More are joined to the distinct tokens of each row.
    """
    usable = lexicon.where(F.col("slang").rlike(f"^{t.TOKEN_PATTERN}\\z")).select("slang").distinct()
    listed = [row["slang"] for row in usable.limit(literal_entries + 1).collect()]
    kept = [c for c in df.columns if c not in ENRICHED]
    if len(listed) > literal_entries:
        counted = _joined_hits(df.select(*kept), usable, text)
    else:
        # Entries are letters and number signs only, so they need no escaping.
        words = ", ".join(f"'{word}'" for word in sorted(listed))
        hits = F.expr(f"size(filter(__tokens, token -> token IN ({words})))") if listed else F.lit(0)
        tokened = df.select(*kept, t.tokens(F.col(text)).alias("__tokens"))
        # As a generator the counts are computed once per row, however often later filters and sorts use them.
        counts = F.struct(
            hits.cast("long").alias("slang_hits"), F.size("__tokens").cast("long").alias("n_tokens")
        )
        counted = tokened.select("*", F.inline(F.array(counts)))
    density = F.coalesce(F.try_divide("slang_hits", "n_tokens"), F.lit(0.0))
    return counted.withColumn("slang_density", density).select(*kept, *ENRICHED)


def _joined_hits(df: DataFrame, entries: DataFrame, text: str) -> DataFrame:
    """Hits and tokens by a join on the token, without a copy of the corpus.

    Texts go by their digest, which no rerun changes and which needs no unique row id. An empty token is added to each
    text: it counts the rows that hold the text, so the hits of all copies can be shared out among them.
    """
    key = F.unhex(F.md5(t.text_or_empty(F.col(text))))
    tokened = df.select(key.alias("__key"), t.tokens(F.col(text)).alias("__tokens"))
    exploded = tokened.select(
        "__key", F.size("__tokens").cast("long").alias("n_tokens"), F.explode(F.concat(F.array(F.lit("")), "__tokens")).alias("token")
    )
    marker = df.sparkSession.createDataFrame([("",)], "token string")
    words, fits = small_side(entries.select(F.col("slang").alias("token")).unionByName(marker))
    if fits:
        matched = exploded.join(words, "token").withColumn("times", F.lit(1))
    else:
        counted = exploded.groupBy("__key", "n_tokens", "token").agg(F.count(F.lit(1)).alias("times"))
        matched = spread_join(counted, words, ["token"], ["__key"])
    is_marker = F.col("token") == ""
    copies, found = F.sum(F.when(is_marker, F.col("times"))), F.sum(F.when(~is_marker, F.col("times")))
    share = F.coalesce((found / copies).cast("long"), F.lit(0).cast("long"))
    hits, _ = small_side(matched.groupBy("__key", "n_tokens").agg(share.alias("slang_hits")))
    return df.withColumn("__key", key).join(hits, "__key").drop("__key")


def enrich(df: DataFrame, lexicon: DataFrame, text: str = "source", overwrite: bool = False) -> tuple[DataFrame, bool]:
    """:func:`with_density`, unless all three columns are there already; says whether anything was added."""
    if text not in df.columns:
        raise ValueError(f"no column {text!r} (have: {df.columns})")
    if set(ENRICHED) <= set(df.columns) and not overwrite:
        return df, False
    return with_density(df, lexicon, text), True


def is_eligible(lang: str | None = None, min_tokens: int = MIN_TOKENS) -> Column:
    """Rows of one exact language value with enough tokens for a meaningful density."""
    enough = F.col("n_tokens") >= min_tokens
    return enough if lang is None else enough & F.col("lang_codes").eqNullSafe(F.lit(lang))


def split_tracks(
    rows: DataFrame,
    n_slang: int = N_SLANG,
    lang: str | None = None,
    min_tokens: int = MIN_TOKENS,
    direct: int = DIRECT_LIMIT,
) -> DataFrame:
    """Label rows: of the eligible ones the densest ``n_slang`` are ``slang``, the others ``formal``.

    Rows that are not eligible get null.
    """
    chosen = is_eligible(lang, min_tokens)
    flagged = flag_first(rows, SPLIT_ORDER, n_slang, "__slang", chosen, direct)
    label = F.when(F.col("__slang"), "slang").when(chosen, "formal")
    return flagged.withColumn("slang_bucket", label).drop("__slang")


def split_report(
    rows: DataFrame, n_slang: int = N_SLANG, lang: str | None = None, min_tokens: int = MIN_TOKENS
) -> DataFrame:
    """Range and middle element of density and hits in the slang track, and its cutoff density.

    The middle is element ``n // 2``: of densities in falling order, of hits in rising order.
    """
    columns = [*[name for name, _ in SPLIT_ORDER], "n_tokens", *(["lang_codes"] if lang is not None else [])]
    labelled = split_tracks(rows.select(*columns), n_slang, lang, min_tokens)
    slang = stable_copy(labelled.where(F.col("slang_bucket") == "slang").select("slang_density", "slang_hits"))
    densities = values_at(
        value_counts(slang, [], F.col("slang_density")), [], {"density": lambda total: total - 1 - F.floor(total / 2)}
    )
    hits = values_at(value_counts(slang, [], F.col("slang_hits")), [], {"hits": lambda total: F.floor(total / 2)})
    return slang.agg(
        F.count(F.lit(1)).alias("n_slang"),
        F.min("slang_density").alias("min_density"),
        F.max("slang_density").alias("max_density"),
        F.min("slang_hits").alias("min_hits"),
        F.max("slang_hits").alias("max_hits"),
    ).select(
        "*",
        densities.select("density").scalar().alias("median_density"),
        hits.select("hits").scalar().cast("long").alias("median_hits"),
        F.col("min_density").alias("cutoff_density"),
    )


def track_preview(rows: DataFrame, n: int = PREVIEW_ROWS, lang: str | None = None, text: str = "text") -> DataFrame:
    """The ``n`` densest eligible rows with the start of their text."""
    order = [F.desc(name) if down else F.asc(name) for name, down in SPLIT_ORDER]
    shown = t.clip(F.col(text)).alias("preview")
    return rows.where(is_eligible(lang)).select(*[name for name, _ in SPLIT_ORDER], shown).orderBy(*order).limit(n)


def slang_summary(rows: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """Row count, density statistics and share of rows with a hit, over rows with enough tokens."""
    counts = value_counts(rows.where(is_eligible(min_tokens=min_tokens)), [], F.col("slang_density"))
    middle = quantiles_of_counts(counts, [], {"median_density": 0.5, "p90_density": 0.9})
    both = middle.select(F.struct("median_density", "p90_density")).scalar()
    value, n = F.col("__value"), F.col("__n")
    total = F.sum(n)
    return counts.agg(
        F.coalesce(total, F.lit(0)).alias("n_rows"),
        F.try_divide(F.sum(value * n), total).alias("mean_density"),
        F.try_divide(100.0 * F.sum(F.when(value > 0, n).otherwise(0)), total).alias("pct_with_hit"),
    ).select("*", both["median_density"].alias("median_density"), both["p90_density"].alias("p90_density"))


def rescore_selection(rows: DataFrame, n: int = RESCORE_ROWS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """Per model, the ``n`` densest rows with enough tokens."""
    order = [F.desc(name) if down else F.asc(name) for name, down in SPLIT_ORDER]
    narrow = rows.where(is_eligible(min_tokens=min_tokens)).select("model", *[name for name, _ in SPLIT_ORDER], "n_tokens")
    return top_per_group(narrow, ["model"], order, n)
