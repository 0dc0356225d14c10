"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior, joined back to the documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import SPACES, batch_of, map_rows, stable_table, text_bytes, windows, word_hashes
from verbascope.operators.joins import null_safe_join, small_side, spread_join

WIDTH = 5
SYMBOLS = b"#*$%&|<>"
# A host whose shrunk rate of any rule is above this loses all its documents.
MAX_RATE = 0.5
# Bounds of the prior's strength, in documents.
STRENGTH = (1.0, 1e6)

_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *((m, pa.int64()) for m in _MEASURES)])
# Every byte that does not start a character.
_INSIDE = bytes(range(0x80, 0xC0))


def rules() -> dict[str, Column]:
    """Whether a document fails each rule; the first two are the base."""
    words = F.col("n_words")
    return {
        "few_words": words < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 15 * words),
    }


def measures(text: bytes | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``_MEASURES``."""
    text = text or b""
    words = word_hashes(text)
    chars = len(text.translate(None, SPACES + _INSIDE))
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    covered = 0
    if len(words) >= WIDTH:
        _, inverse, counts = np.unique(windows(words, WIDTH), return_inverse=True, return_counts=True)
        edges = np.zeros(len(words) + 1, np.int64)
        at = np.flatnonzero(counts[inverse] > 1)
        edges[at] += 1
        edges[at + WIDTH] -= 1
        covered = int((np.cumsum(edges) > 0).sum())
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, n_symbols, len(lines) - len(set(lines)), len(lines), covered


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(zip(*map(measures, text_bytes(batch)), strict=True)) or [[]] * len(_MEASURES)
        yield batch_of(_SCHEMA, doc_id=batch.column("doc_id"), host=batch.column("host"), **dict(zip(_MEASURES, found, strict=True)))


def host_rates(measured: DataFrame) -> DataFrame:
    """One row per host: n_docs and the shrunk failure rate of each rule.

    The prior of a rule is the beta distribution with the mean and variance of the hosts' rates (less what chance alone
    makes of it), fitted by moments; a host's rate is the mean of its posterior.
    """
    names = list(rules())
    counts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(rule.cast("long")).alias(f"bad_{name}") for name, rule in rules().items()]
    )
    counts = stable_table(counts)
    rate = {n: F.col(f"bad_{n}") / F.col("n_docs") for n in names}
    spread = {n: F.var_pop(rate[n]) - F.avg(rate[n] * (1 - rate[n]) / F.col("n_docs")) for n in names}
    prior = counts.agg(*[F.avg(rate[n]).alias(f"mean_{n}") for n in names], *[spread[n].alias(f"var_{n}") for n in names]).first()
    out = []
    for n in names:
        mean, var = prior[f"mean_{n}"] or 0.0, prior[f"var_{n}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, STRENGTH[0]), STRENGTH[1]) if var > 0 else STRENGTH[1]
        out.append(((F.col(f"bad_{n}") + mean * strength) / (F.col("n_docs") + strength)).alias(f"rate_{n}"))
    return counts.select("host", "n_docs", *out)


def host_verdicts(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """Counts and verdicts for each row of ``docs`` (doc_id, text and the column named by ``host``).

    Returns doc_id, host, the counts of ``measures``, base_failed, host_rate (the highest shrunk rate of its host, to 6
    places), kept. Null and empty texts have no words and fail the base. A null host is a host of its own. Every row is
    judged, repeated ones too; other columns are ignored; an empty table gives no rows. Rates come from counts per host,
    so a host with a third of all rows costs no more than another.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), F.col("text").cast("string"))
    schema = "doc_id long, host string, " + ", ".join(f"{m} long" for m in _MEASURES)
    measured = stable_table(map_rows(rows, _measured, schema))
    rates = host_rates(measured).select("host", F.round(F.greatest(*[F.col(f"rate_{n}") for n in rules()]), 6).alias("host_rate"))
    hosts, fits = small_side(rates)
    judged = null_safe_join(measured, hosts, ["host"]) if fits else spread_join(measured, hosts, ["host"], ["doc_id"])
    base = rules()["few_words"] | rules()["repeats"]
    return judged.select(
        "doc_id", "host", *_MEASURES, base.alias("base_failed"), "host_rate", (~base & (F.col("host_rate") <= max_rate)).alias("kept")
    )
