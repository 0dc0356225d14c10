"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Each word of a clause gets a class: insult (a learned word or word beginning, with a learned weight), threat, target,
negation, reported speech or other. Small transducers read the classes side by side; their product, built as states are
met, gives each insult or threat its weight plus the weights of the scopes it stands in. Weights are log odds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, held_out, map_rows, stable_table

# The grammar is fitted on whole texts of this many labelled rows of either label at most, the least hashes of id and text.
SAMPLE_ROWS = 6000
# Patterns that the grammar holds at most, the best supported.
PATTERNS = 50_000
PREFIXES = (3, 4, 5, 6)
MIN_DOCS = 3
MIN_PRECISION = 0.8
THRESHOLD = 0.3

# Words of the closed classes, in the languages of the corpora.
TARGETS = frozenset("you your yours youre they he she him her them du dich dir ihr euch dein sie tu toi te vous votre ton usted ustedes tú ti".split())
NEGATIONS = frozenset("not no never nobody nothing isnt arent wasnt dont nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split())
REPORTS = frozenset("said says say wrote writes claimed called quoted reported sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt destroy murder töten umbringen verletzen tuer blesser détruire matar herir destruir".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "other", "insult", "threat", "target", "negation", "report"
# A threat alone says little; aimed at somebody it weighs as much as an insult.
THREAT_WEIGHT, AIM_WEIGHT = -2.0, 4.0
# Words that a negation or a target reaches.
NEGATION_SPAN, TARGET_SPAN = 3, 4

_CLAUSE = re.compile(r"[.,;:!?\n|]+")
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = frozenset("\"“”«»„")

_COUNTED = pa.schema([("pattern", pa.string()), ("bad", pa.int64()), ("good", pa.int64())])
_SCOPED = pa.schema([("scope", pa.string()), ("bad", pa.int64()), ("good", pa.int64())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("n_clauses", pa.int64())])


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, class) -> state; a state may weigh what is matched in it. Classes without an arc take ``rest``."""

    start: int
    arcs: dict[tuple[int, str], int]
    rest: dict[int, int]
    weights: dict[tuple[int, str], float] = field(default_factory=dict)

    def step(self, state: int, kind: str) -> tuple[int, float]:
        weight = self.weights.get((state, kind), 0.0)
        return self.arcs.get((state, kind), self.rest.get(state, state)), weight


def scope(trigger: str, span: int, weights: dict[str, float]) -> Transducer:
    """In scope for ``span`` words after the trigger."""
    states = range(1, span + 1)
    return Transducer(
        0,
        {(s, trigger): span for s in range(span + 1)},
        {0: 0, **{s: s - 1 for s in states}},
        {(s, kind): w for s in states for kind, w in weights.items()},
    )


def reported(weights: dict[str, float]) -> Transducer:
    """In scope until the clause ends."""
    return Transducer(0, {(0, REPORT): 1}, {0: 0, 1: 1}, {(1, kind): w for kind, w in weights.items()})


class Grammar:
    """The product of the transducers, and the patterns with their weights."""

    def __init__(self, patterns: dict[str, float], scopes: dict[str, float] | None = None, silent: float = -6.0):
        """``patterns``: words, and beginnings marked with a final ``*``; ``silent``: log odds of a text without a match."""
        self.words = {p: w for p, w in patterns.items() if not p.endswith("*")}
        self.beginnings = {p[:-1]: w for p, w in patterns.items() if p.endswith("*")}
        self.heads = {p[: PREFIXES[0]] for p in self.beginnings}
        self.silent = silent
        scopes = scopes or {}
        aim = {THREAT: AIM_WEIGHT, INSULT: scopes.get(TARGET, 0.0)}
        self.transducers = (
            scope(NEGATION, NEGATION_SPAN, dict.fromkeys((INSULT, THREAT), scopes.get(NEGATION, 0.0))),
            reported(dict.fromkeys((INSULT, THREAT), scopes.get(REPORT, 0.0))),
            scope(TARGET, TARGET_SPAN, aim),
        )
        self.product: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float]] = {}

    def weight(self, word: str) -> float | None:
        """Of an insult: that of the word, or of its longest known beginning."""
        found = self.words.get(word)
        if found is None and word[: PREFIXES[0]] in self.heads:
            for size in reversed(PREFIXES):
                if size < len(word) and (found := self.beginnings.get(word[:size])) is not None:
                    return found
        return found

    def kind(self, token: str) -> tuple[str, float]:
        if token in THREATS:
            return THREAT, THREAT_WEIGHT
        found = self.weight(token)
        if found is not None:
            return INSULT, found
        if token in NEGATIONS:
            return NEGATION, 0.0
        if token in REPORTS or token in _QUOTES:
            return REPORT, 0.0
        return (TARGET, 0.0) if token in TARGETS else (OTHER, 0.0)

    def step(self, state: tuple[int, ...], kind: str) -> tuple[tuple[int, ...], float]:
        arc = self.product.get((state, kind))
        if arc is None:
            steps = [t.step(s, kind) for t, s in zip(self.transducers, state, strict=True)]
            arc = self.product[state, kind] = tuple(s for s, _ in steps), sum(w for _, w in steps)
        return arc

    def matches(self, clause: str) -> Iterator[tuple[str, float, tuple[int, ...]]]:
        """Class, total weight and scopes of each insult or threat of a clause."""
        state = tuple(t.start for t in self.transducers)
        for token in _TOKEN.findall(clause):
            kind, own = self.kind(token)
            after, weight = self.step(state, kind)
            if kind in (INSULT, THREAT):
                yield kind, own + weight, state
            state = after

    def suspects(self, words: set[str]) -> bool:
        """Whether any word can match; most texts end here."""
        return (
            not self.words.keys().isdisjoint(words)
            or not THREATS.isdisjoint(words)
            or any(w[: PREFIXES[0]] in self.heads and self.weight(w) is not None for w in words)
        )

    def clauses(self, text: str) -> list[tuple[float, list[tuple[str, float, tuple[int, ...]]]]]:
        """Score and matches of the clauses with a match: the strongest path decides."""
        low = text.lower()
        if not self.suspects(set(_WORD.findall(low))):
            return []
        found = ((list(self.matches(c))) for c in _CLAUSE.split(low))
        return [(max(w for _, w, _ in m), m) for m in found if m]

    def score(self, text: str) -> tuple[float, int]:
        """Chance that a text is toxic: that not every clause is harmless, with the chance of texts without a match."""
        rest = 1 - logistic(self.silent)
        found = self.clauses(text)
        for weight, _ in found:
            rest *= 1 - logistic(weight)
        return 1 - rest, len(found)


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def patterns_of(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


def _pattern_counts(wanted):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good = Counter(), Counter()

        def flush():
            keys = list(bad.keys() | good.keys())
            out = batch_of(_COUNTED, pattern=keys, bad=[bad[k] for k in keys], good=[good[k] for k in keys])
            bad.clear(), good.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found = patterns_of(text)
                (bad if toxic else good).update(found if wanted is None else found & wanted.value)
            if len(bad) + len(good) > 300_000:
                yield flush()
        if bad or good:
            yield flush()

    return counted


def _scope_counts(grammar):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                states = [s for _, matches in grammar.value.clauses(text) for kind, _, s in matches if kind == INSULT]
                scopes = {"none"} if not states else set()
                for name, place in ((NEGATION, 0), (REPORT, 1), (TARGET, 2)):
                    if states and all(s[place] for s in states):
                        scopes.add(name)
                for name in scopes:
                    found[name, int(toxic)] += 1
        keys = sorted({name for name, _ in found})
        yield batch_of(_SCOPED, scope=keys, bad=[found[k, 1] for k in keys], good=[found[k, 0] for k in keys])

    return counted


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, print (hash of id and text), toxic of every document to learn from: labelled, not empty, never held out."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).distinct()
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    return _keyed(docs).drop("text").distinct().join(known, "doc_id")


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null and length(text) > 0")
    return rows.withColumn("print", F.xxhash64("doc_id", "text"))


def labelled_sample(docs: DataFrame, known: DataFrame, rows: int) -> DataFrame:
    """text, toxic of ``known`` (see ``labelled_documents``): ``rows`` documents of either label at most."""
    picked = [known.where(F.col("toxic") == t).orderBy("print", "doc_id").limit(rows) for t in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * rows short rows at most
    return _keyed(docs).join(chosen, ["doc_id", "print"]).dropDuplicates(["doc_id", "print"]).select("text", "toxic")


def odds(bad: float, good: float, shift: float = 0.0) -> float:
    """Log odds from counts; ``shift`` brings those of a sample to those of the corpus."""
    return math.log((bad + 0.5) / (good + 0.5)) + shift


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, patterns: int = PATTERNS) -> Grammar:
    """Learn patterns, scope weights and the rate of silent texts from labelled rows that are not held out.

    A pattern is kept if it is precise and its counts are no accident among all patterns tried. Each label is sampled by
    itself, so a sampled document stands for as many as its label has for each one sampled: precision and odds are those
    of all labelled documents. Whether counts are an accident is asked of the counts seen, which weighing would inflate.
    """
    spark = docs.sparkSession
    known = stable_table(labelled_documents(docs, labels))
    labelled = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = labelled_sample(docs, known, rows).persist()
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_bad, n_good = sizes.get(1, 0), sizes.get(0, 0)
    if not n_bad or not n_good:
        sample.unpersist()
        return Grammar({}, silent=odds(labelled.get(1, 0), labelled.get(0, 0)))
    bad_weight, good_weight = labelled[1] / n_bad, labelled[0] / n_good
    shift = math.log(bad_weight / good_weight)
    schema = "pattern string, bad long, good long"
    counted = map_rows(sample.where("toxic = 1"), _pattern_counts(None), schema).groupBy("pattern").agg(F.sum("bad").alias("bad"))
    counted = counted.where(F.col("bad") >= MIN_DOCS)
    tried = max(2, counted.count())
    best = {r["pattern"]: r["bad"] for r in counted.orderBy(F.desc("bad"), "pattern").limit(patterns).collect()}
    wanted = spark.sparkContext.broadcast(frozenset(best))
    clean = map_rows(sample.where("toxic = 0"), _pattern_counts(wanted), schema).groupBy("pattern").agg(F.sum("good").alias("good"))
    good = {r["pattern"]: r["good"] for r in clean.toLocalIterator()}
    base, kept = n_bad / (n_bad + n_good), {}
    for pattern, a in best.items():
        c = good.get(pattern, 0)
        share = a / (a + c)
        gain = a * math.log(share / base) + (c * math.log((1 - share) / (1 - base)) if c else 0.0)
        precision = (a + 0.5) * bad_weight / ((a + 0.5) * bad_weight + (c + 0.5) * good_weight)
        if precision >= MIN_PRECISION and gain > math.log(tried) + 4:
            kept[pattern] = odds(a, c, shift)
    first = Grammar(kept)
    sent = spark.sparkContext.broadcast(first)
    scoped = map_rows(sample, _scope_counts(sent), "scope string, bad long, good long").groupBy("scope").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = {r["scope"]: (r["bad"], r["good"]) for r in scoped.collect()}
    sample.unpersist()
    typical = sorted(kept.values())[len(kept) // 2] if kept else 0.0
    # What only ever stands in a negation or a report is held harmless, three to one, until labels say otherwise.
    scopes = {
        n: min(0.0, math.log((b * bad_weight + 1) / (g * good_weight + 3)) - typical) for n in (NEGATION, REPORT) for b, g in [found.get(n, (0, 0))]
    }
    scopes[TARGET] = max(0.0, odds(*found[TARGET], shift) - typical) if TARGET in found else 0.0
    return Grammar(kept, scopes, odds(*found.get("none", (0, 0)), shift))


def _scored(grammar):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grammar.value.score(t or "") for t in batch.column("text").to_pylist()]
            yield batch_of(
                _SCORED, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=[s for s, _ in found], n_clauses=[n for _, n in found]
            )

    return scored


def toxicity(docs: DataFrame, labels: DataFrame | None = None, grammar: Grammar | None = None) -> DataFrame:
    """Score each row of ``docs`` (doc_id, text) with a grammar, or with one learned from ``labels`` (doc_id, toxic).

    Returns doc_id, held_out, score (0 to 1), predicted (1 from a score of 0.3), n_clauses (clauses with a match). Null
    and empty texts have no match and get the rate of such texts. Labels that are null, neither 0 nor 1, contradict each
    other or have no document teach nothing. Repeated rows get equal scores and teach once; other columns are ignored; an
    empty table gives no rows.
    """
    grammar = grammar or fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(grammar)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out().alias("held_out"))
    found = map_rows(rows, _scored(sent), "doc_id long, held_out boolean, score double, n_clauses long")
    return found.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_clauses")
