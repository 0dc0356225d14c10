"""Information-theoretic sanitisation, in DataFrame functions only.

Personal data is found by pattern. The terms of the documents that hold it are tested on the whole corpus: a term whose
documents nearly all hold one protected entity reveals it, however far apart the two stand. Such terms are spans too,
wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import stable_table
from verbascope.operators.joins import small_side

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# A term discloses an entity if so many documents have both, the entity has this share of the term's documents, and the
# term says so many bits about it.
MIN_DOCS, MIN_SHARE, MIN_BITS = 3, 0.8, 4.0

# What counts as personal data. Possessive repetition and the conditions before a match change no match
# (a match can only start where its run of characters does, or where the last match ended); they bound time and stack.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_MARKS = {"email": "@", "ip": ".", "phone": "+"}
# A term is a whole run of letters, their marks and digits, of any length.
_IN_TERM = r"[\p{L}\p{M}\p{N}]"
_WORD = _IN_TERM + "++"
# Short words of the closed classes, in lower case and in the languages of the corpora: they name nobody. Longer ones are
# left to the statistics.
FUNCTION_WORDS = tuple(
    "a an and are as at be but by can did do for had has he her him his how i if in is it its let may me my no nor not of off on or "
    "our out per she so the to too up us via was we who why yet you "
    "ab am da das dem den der des die du ein er es für hat ich ihm ihn ihr im ist ja man mir mit nie nun nur ob sie so um und uns vom "
    "von vor war was wer wie wir wo zu zum zur "
    "à au aux ce ces car de du elle en est et eu eux il ils je la le les lui ma me mes moi mon ne ni non nos on ont où ou par pas peu "
    "que qui sa se ses si son sur ta te tes toi ton tu un une va vos y "
    "al con de del e el él en era es eso fue ha han hay la las le les lo los mi mis muy nos o os para por que qué se sea ser si sí "
    "sin son su sus te tu tú tus u un una uno y ya yo".split()
)
_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
_KEY = ["id", "print"]


def located(text: Column, pattern: Column) -> Column:
    """Matches of a pattern with their places: array of (value, start, end) in code points.

    The pieces between matches give the places: a match starts after all pieces and matches before it.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("value"), F.slice(pieces, F.lit(1), F.size(found)).alias("piece"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<value:string,start:int,end:int>>").alias("all"))

    def add(done: Column, item: Column) -> Column:
        start = done["at"] + F.length(item["piece"])
        end = start + F.length(item["value"])
        entry = F.struct(item["value"].alias("value"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(done["all"], F.array(entry)).alias("all"))

    return F.aggregate(both, empty, add, lambda done: done["all"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def weighed(i: Column) -> Column:
        digit = F.substring(digits, i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, b: a + b) % 10 == 0


def _small(digits: Column) -> Column:
    """Whether digits without leading zeros are a number up to 255."""
    return (F.length(digits) <= 3) & (F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = F.transform(F.split(value, r"\."), lambda p: _small(F.ltrim(p, F.lit("0"))))
        return F.forall(part, lambda ok: F.coalesce(ok, F.lit(False)))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda match: _valid(kind, match["value"])


def _span_of(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].cast("long").alias("start"), m["end"].cast("long").alias("end"))


def _entity_of(kind: str):
    return lambda m: F.concat(F.lit(kind + ":"), m["value"])


def entities(text: Column) -> dict[str, Column]:
    """For each kind the valid matches, as ``located`` gives them."""
    out = {}
    none = F.array().cast("array<struct<value:string,start:int,end:int>>")
    for kind in KINDS:
        maybe = F.contains(text, F.lit(_MARKS[kind])) if kind in _MARKS else F.lit(True)
        found = F.filter(located(text, F.lit(_PATTERNS[kind])), _is_valid(kind))
        out[kind] = F.when(maybe & F.regexp_like(text, F.lit(_PATTERNS[kind])), found).otherwise(none)
    return out


def terms_of(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_except(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.array(*map(F.lit, FUNCTION_WORDS)))


def _keyed(docs: DataFrame) -> DataFrame:
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(
        F.coalesce(key, F.lit(-(2**63))).alias("id"), F.xxhash64(key, text).alias("print"), key.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )


def disclosing_terms(based: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, term, n_term, n_entity, n_both, bits) of disclosing terms, and (id, print, term) of where they stand.

    All counts are of documents, over the whole corpus; rows equal in id and text are one document.
    """
    repeated = based.groupBy(*_KEY).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    repeated, _ = small_side(repeated)
    based = based.join(repeated, _KEY, "left").where("first is null or row = first")
    n_docs = based.count()
    words = based.select(*_KEY, F.explode("words").alias("term"))
    named = based.where(F.size("entities") > 0).select(*_KEY, F.explode("entities").alias("entity"))
    # As n_both exceeds neither count, terms and entities that are too rare or too common can't reach the thresholds.
    able = F.col("n").between(MIN_DOCS, n_docs / 2**MIN_BITS)
    n_entity, _ = small_side(named.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(able).withColumnRenamed("n", "n_entity"))
    n_term, _ = small_side(words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(able).withColumnRenamed("n", "n_term"))
    named, _ = small_side(named.join(n_entity, "entity"))
    held = based.join(named.select(*_KEY).distinct(), _KEY, "left_semi").select(*_KEY, F.explode("words").alias("term"))
    pairs = held.join(n_term, "term").join(named, _KEY).where(F.col("n_entity") >= MIN_SHARE * F.col("n_term"))
    both = pairs.groupBy("entity", "term", "n_term", "n_entity").agg(F.count(F.lit(1)).alias("n_both"))
    bits = F.log2(F.col("n_both") * F.lit(float(n_docs)) / (F.col("n_term") * F.col("n_entity")))
    enough = (F.col("n_both") >= MIN_DOCS) & (F.col("n_both") >= MIN_SHARE * F.col("n_term")) & (F.col("bits") >= MIN_BITS)
    found = stable_table(both.withColumn("bits", bits).where(enough))
    terms, _ = small_side(found.select("term").distinct())
    return found, words.join(terms, "term")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data and of disclosing terms in each row of ``docs`` (doc_id, text).

    Returns doc_id, base (spans found by pattern: kind, start, end in code points, by kind, then start) and spans (base,
    then terms that don't touch them). Null texts count as empty. Repeated rows get equal spans and are one document in
    the statistics, as are rows without id that have equal texts. Other columns are ignored; an empty table gives no rows.
    """
    texts = _keyed(docs)
    found = entities(F.col("text"))
    spans = F.concat(*[F.transform(k, _span_of(k)) for k in KINDS])
    held = F.array_distinct(F.concat(*[F.transform(k, _entity_of(k)) for k in KINDS]))
    words = terms_of(F.col("text"))
    based = texts.withColumns(found).select(*_KEY, "doc_id", spans.cast(_SPAN).alias("base"), held.alias("entities"), words.alias("words"))
    based = stable_table(based.withColumn("row", F.monotonically_increasing_id()))
    _, places = disclosing_terms(based)
    terms, _ = small_side(places.groupBy(*_KEY).agg(F.sort_array(F.collect_set("term")).alias("terms")))
    pattern = F.concat(F.lit(f"(?<!{_IN_TERM})(?:"), F.array_join("terms", "|"), F.lit(f")(?!{_IN_TERM})"))
    held = texts.select(*_KEY, "text").join(terms, _KEY).withColumn("found", located(F.col("text"), pattern))
    held = held.select(*_KEY, F.transform("found", _span_of(TERM)).cast(_SPAN).alias("found"))
    joined = based.select(*_KEY, "doc_id", "base").join(held.dropDuplicates(_KEY), _KEY, "left")
    apart = F.filter(
        F.coalesce("found", F.array().cast(_SPAN)),
        lambda t: ~F.exists(F.col("base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return joined.select("doc_id", "base", F.concat("base", apart).alias("spans"), *_KEY)


def sanitise(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with ``sanitised``: entities generalised to their kind in brackets, disclosing terms removed."""
    spans = find_personal_data(docs).select(*_KEY, F.array_sort("spans", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)).alias("__spans"))
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.withColumns({"__id": F.coalesce(key, F.lit(-(2**63))), "__print": F.xxhash64(key, text)})
    joined = rows.join(spans.dropDuplicates(_KEY).select(F.col("id").alias("__id"), F.col("print").alias("__print"), "__spans"), ["__id", "__print"])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(done: Column, span: Column) -> Column:
        # Spans of two kinds can overlap: what is covered already is not written again.
        gap = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(F.lit(0), span["start"] - done["at"]).cast("int"))
        mark = F.when(span["kind"] == TERM, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        shown = F.when(span["start"] < done["at"], F.lit("")).otherwise(F.concat(gap, mark))
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["out"], shown).alias("out"))

    done = F.aggregate("__spans", start, add)
    tail = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    return joined.select(*docs.columns, F.concat(done["out"], tail).alias("sanitised"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
