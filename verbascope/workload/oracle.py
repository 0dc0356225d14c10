"""DuckDB SQL for the registered queries, written on its own over the given tables."""

from __future__ import annotations

# Python's whitespace as a character class body of the regular expression dialect.
_WS = r"\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_TOKENS = r"[\p{L}\p{Nl}\p{No}]+"
_KEY = "id1, id2, language, dataset"


def _trim(text: str) -> str:
    return rf"regexp_replace({text}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _preview(text: str, limit: int = 100) -> str:
    line = f"replace(coalesce({text}, ''), chr(10), ' ')"
    return f"case when length({line}) <= {limit} then {line} else concat(left({line}, {limit - 1}), '…') end"


def _cut(text: str, limit: int = 500) -> str:
    return f"case when {text} is null then '' when length({text}) <= {limit} then {text} else concat(left({text}, {limit - 1}), '…') end"


def _dataset(number: str) -> str:
    return f"case {number} % 3 when 0 then 'mono_sea' when 1 then 'mono_me' else 'bilingual' end"


def _quality(factor: int) -> str:
    return f"((d.doc_id * {factor} + m.mi * 104729 + d.n_chars * 13) % 1010) / 1009e0"


_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bench": ((), "select item_id, text as btext, count(*) over () as bn from benchmark"),
    "eval_rows": (
        ("bench",),
        f"""select doc_id as row_id, case when doc_id % 89 = 0 then null else source end as id1,
            cast(doc_id as varchar) as id2,
            case when doc_id % 97 = 0 then null
                 when doc_id % 7 = 0 then concat(lang, ',', case lang when 'en' then 'de' else 'en' end)
                 else lang end as lang_codes,
            text, b.btext as translation, doc_id % 7 = 0 as is_code_switched,
            case when doc_id % 7 = 0 then 2 else 1 end as lang_count,
            case when doc_id % 53 = 0 then null else (doc_id * 37 % 1010) / 1009e0 end as semantic_similarity,
            {_dataset('doc_id')} as dataset
        from documents left join bench b on b.item_id = doc_id % (select count(*) from benchmark)""",
    ),
    "models": (
        (),
        "select * from (values (0, 'org0/model-a'), (1, 'org0/model-b'), (2, 'org1/model_c'), (3, 'org1/model-d')) v(mi, model)",
    ),
    "scored": (
        ("bench", "models"),
        f"""select m.model, {_dataset('d.doc_id')} as dataset,
            case when d.doc_id % 97 = 0 then null else d.lang end as language,
            case when d.doc_id % 97 = 0 then null else d.lang end as lang_codes,
            case when d.doc_id % 89 = 0 then null else d.source end as id1, cast(d.doc_id as varchar) as id2,
            d.doc_id, d.doc_id * 4 + m.mi as row_id, d.text as source,
            case when (d.doc_id + m.mi) % 50 = 0 then null else case when d.doc_id % 10 = 0 then d.text else reverse(d.text) end end as hypothesis,
            b.btext as reference,
            case when (d.doc_id + m.mi) % 41 = 0 then null
                 when (d.doc_id * 31 + m.mi * 17) % 10 < 8 then 1e0 else 0e0 end as ifeval,
            case when (d.doc_id + m.mi) % 43 = 0 then null else {_quality(7919)} end as comet_qe,
            case when (d.doc_id + m.mi) % 47 = 0 then null else {_quality(6271)} end as comet,
            case when (d.doc_id + m.mi) % 50 = 0 then 'timeout' end as error
        from documents d cross join models m
        left join bench b on b.item_id = d.doc_id % (select count(*) from benchmark)""",
    ),
    "run_meta": (
        (),
        f"""select model, dataset, n_rows, n_errors, elapsed_seconds,
            round(n_rows / elapsed_seconds, 3) as req_per_s, cast(32 as bigint) as concurrency
        from (select case user_id % 3 when 0 then 'org0/model-a' when 1 then 'org0/model-b' else 'org1/model_c' end as model,
                     {_dataset('event_id')} as dataset, count(*) as n_rows,
                     count(*) filter (where event_type = 'error') as n_errors,
                     date_diff('microsecond', min(ts), max(ts)) / 1e10 as elapsed_seconds
              from events group by 1, 2)
        union all select 'org1/model-d', 'mono_sea', 0, 0, 0e0, null, 32""",
    ),
    "lexicon": (
        (),
        f"""select distinct token from
            (select unnest(list_transform(regexp_extract_all(text, '{_TOKENS}'), lambda x: lower(x))) as token from benchmark)""",
    ),
    "doc_tokens": (
        (),
        f"select doc_id, list_transform(regexp_extract_all(text, '{_TOKENS}'), lambda x: lower(x)) as toks from documents",
    ),
    "density": (
        ("lexicon", "doc_tokens"),
        """select t.doc_id, coalesce(h.hits, 0) as slang_hits, len(t.toks) as n_tokens,
            case when len(t.toks) = 0 then 0e0 else coalesce(h.hits, 0) / len(t.toks) end as slang_density
        from doc_tokens t left join
            (select doc_id, count(*) as hits from (select doc_id, unnest(toks) as token from doc_tokens)
             where token in (select token from lexicon) group by doc_id) h on h.doc_id = t.doc_id""",
    ),
    "tracks": (
        ("density",),
        """select doc_id, slang_density, slang_hits, n_tokens,
            case when n_tokens < 5 then null
                 when row_number() over (partition by n_tokens >= 5
                      order by slang_density desc, slang_hits desc, doc_id) <= 100 then 'slang' else 'formal' end as slang_bucket
        from density""",
    ),
    "tracked": (
        ("scored", "tracks"),
        "select s.*, t.slang_density, t.slang_hits, t.n_tokens, t.slang_bucket from scored s join tracks t on t.doc_id = s.doc_id",
    ),
    "en_tracks": (
        ("density", "eval_rows"),
        """select row_id, lang_codes, slang_density, slang_hits, n_tokens,
            row_number() over (order by slang_density desc, slang_hits desc, row_id) as place
        from eval_rows join density on doc_id = row_id where lang_codes = 'en' and n_tokens >= 5""",
    ),
    "lengths": (
        ("eval_rows",),
        f"""select *, length(coalesce(text, '')) as text_chars, length(coalesce(translation, '')) as translation_chars,
            len(regexp_extract_all(coalesce(text, ''), '[^{_WS}]+')) as text_words from eval_rows""",
    ),
    "names": (
        ("scored",),
        """select model, dataset, count(*) as n,
            concat(replace(replace(model, '/', '_'), ':', '_'), '_', dataset, '_scored.csv') as file_name
        from scored group by 1, 2""",
    ),
    "comparable_keys": (
        ("scored",),
        f"select {_KEY}, count(distinct model) as n_models, count(*) as n_rows from scored group by all having count(distinct model) >= 2",
    ),
    "judgements": (
        (),
        """select 'baseline' as judge, quality as gold, case when doc_id % 3 <> 0 then 1 else 0 end as pred from labels
        union all select 'candidate', quality, case when doc_id % 10 = 0 then 1 - quality else quality end from labels""",
    ),
    "judged": (
        ("judgements",),
        """select judge, count(*) filter (where pred = 1 and gold = 1) as tp,
            count(*) filter (where pred = 1 and gold <> 1) as fp, count(*) filter (where pred <> 1 and gold = 1) as fn
        from judgements group by judge""",
    ),
    "pair_rows": (
        (),
        """select u.conv_id * 1000 + u.turn as row_id, coalesce(u.text, '') as source, a.text as hypothesis
        from conversations u left join conversations a
          on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
        where u.role = 'user'""",
    ),
}


def _sql(body: str, *names: str) -> str:
    """The body behind the views it names and those they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _VIEWS[name][0]:
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({_VIEWS[n][1]})" for n in ordered) + "\n" + body


def _block() -> str:
    zero = "coalesce(comet_qe, 0)"
    return f"""round(avg(coalesce(ifeval, 0)), 6) as mean_ifeval, round(avg({zero}), 6) as mean_comet_qe,
        round(quantile_cont({zero}, 0.5), 6) as median_comet_qe, round(quantile_cont({zero}, 0.1), 6) as p10_comet_qe,
        round(quantile_cont({zero}, 0.9), 6) as p90_comet_qe"""


_JOINT = "round(avg(case when coalesce(ifeval, 0) >= 1 and coalesce(comet_qe, 0) >= 0.8 then 1e0 else 0e0 end), 6)"


def _box(value: str, keys: str, source: str) -> str:
    return f"""select {keys}, n, round("min", 6) as "min",
        round((select min({value})::double from {source} x where {_same('x', 'g', keys)} and x.{value} >= q1 - 1.5 * (q3 - q1)), 6) as lower_fence,
        round(q1, 6) as q1, round("median", 6) as "median", round(q3, 6) as q3,
        round((select max({value})::double from {source} x where {_same('x', 'g', keys)} and x.{value} <= q3 + 1.5 * (q3 - q1)), 6) as upper_fence,
        round("max", 6) as "max"
    from (select {keys}, count({value}) as n, min({value})::double as "min", max({value})::double as "max",
            quantile_cont({value}, 0.25)::double as q1, quantile_cont({value}, 0.5)::double as "median",
            quantile_cont({value}, 0.75)::double as q3 from {source} where {value} is not null group by {keys}) g"""


def _same(a: str, b: str, keys: str) -> str:
    return " and ".join(f"{a}.{k.strip()} is not distinct from {b}.{k.strip()}" for k in keys.split(","))


def _browse(order: str) -> str:
    return _sql(
        f"""select model, dataset, language, {_preview('source')} as source_preview, {_preview('hypothesis')} as hyp_preview,
        {_preview('reference')} as reference_preview, ifeval, comet_qe, id1, id2, row_id
        from scored where coalesce(comet_qe, 0) between 0 and 1 order by {order}, row_id limit 500""",
        "scored",
    )


def _examples() -> str:
    def part(label: str, where: str, order: str) -> str:
        return f"""select model, dataset, '{label}' as category, language, source, hypothesis, reference, ife, qe,
            row_number() over (partition by model, dataset order by qe {order}, row_id) as position from filled {where}"""

    return _sql(
        f"""select model, dataset, category, language, {_cut('source')} as source, {_cut('hypothesis')} as hypothesis,
        {_cut('reference')} as reference, ife as ifeval, qe as comet_qe, cast(position as integer) as position
        from ({part('best', 'where ife >= 1', 'desc')} union all {part('worst', '', 'asc')}
              union all {part('polluted', 'where ife < 1', 'asc')}) where position <= 5""".replace(
            "filled",
            "(select *, coalesce(ifeval, 0) as ife, coalesce(comet_qe, 0) as qe from scored) f",
        ),
        "scored",
    )


_SHOT_LINES = """concat('Source (', coalesce(nullif(lang_codes, ''), 'Unknown'), '): ', coalesce(text, ''))"""
_ASK = """concat('Translate the following ', case when coalesce(lang_codes, '') = '' then '' else concat(lang_codes, ' ') end,
    'text to English. Output only the translation, nothing else.')"""

SQL: dict[str, str] = {
    "summary_overall": _sql(
        f"""select g.model, g.dataset, n_rows_scored, n_rows as n_source_rows, n_errors,
            round(case when n_rows > 0 then n_errors / n_rows end, 6) as error_rate, mean_ifeval, mean_comet_qe,
            median_comet_qe, p10_comet_qe, p90_comet_qe, joint_pass_rate,
            round(elapsed_seconds, 6) as elapsed_seconds, req_per_s
        from (select model, dataset, count(*) as n_rows_scored, {_block()}, {_JOINT} as joint_pass_rate
              from scored group by model, dataset) g
        left join run_meta m on m.model = g.model and m.dataset = g.dataset""",
        "scored",
        "run_meta",
    ),
    "summary_by_language": _sql(
        f"""select model, dataset, language, count(*) as n_rows, {_block()}, {_JOINT} as joint_pass_rate,
            count(*) < 30 as low_sample from scored group by model, dataset, language""",
        "scored",
    ),
    "eda_headline": _sql(
        f"""select model, dataset, count(*) as n, {_block()}, {_JOINT} as joint_pass from scored
        where language in ('en', 'de', 'fr') and coalesce(comet_qe, 0) between 0.05 and 1
        group by model, dataset""",
        "scored",
    ),
    "lang_mean": _sql(
        """select model, dataset, language, round(avg(comet_qe), 6) as comet_qe from scored
        where language is not null group by 1, 2, 3""",
        "scored",
    ),
    "qe_summary": _sql(
        """select model, dataset, count(*) as n_rows, round(avg(comet_qe), 4) as mean_comet_qe,
            round(quantile_cont(comet_qe, 0.5), 4) as median_comet_qe, round(quantile_cont(comet_qe, 0.1), 4) as p10_comet_qe,
            round(quantile_cont(comet_qe, 0.9), 4) as p90_comet_qe from scored group by 1, 2""",
        "scored",
    ),
    "qe_by_lang": _sql(
        """select model, dataset, lang_codes, round(avg(comet_qe), 4) as mean_comet_qe from scored
        where lang_codes is not null group by 1, 2, 3""",
        "scored",
    ),
    "ifeval_summary": _sql(
        """select model, dataset, count(*) as n_rows, round(avg(ifeval), 4) as mean_ifeval,
            round(avg(ifeval) * 100, 1) as ifeval_clean_pct from scored group by 1, 2""",
        "scored",
    ),
    "ref_summary": _sql(
        "select model, dataset, count(*) as n_rows, round(avg(comet), 4) as mean_comet_ref from scored group by 1, 2",
        "scored",
    ),
    "score_averages": _sql(
        """select model, dataset, count(*) as n, round(avg(ifeval), 6) as mean_ifeval, round(avg(comet), 6) as mean_comet,
            round(avg(comet_qe), 6) as mean_comet_qe from scored group by 1, 2""",
        "scored",
    ),
    "model_stats": _sql(
        f"""select model, dataset, count(*) as n, round(avg(comet_qe), 6) as comet_qe, round(avg(ifeval), 6) as ifeval,
            round(100e0 * count(*) filter (where lower({_trim('source')}) = lower({_trim('hypothesis')})) / count(*), 6) as src_copy_pct,
            round(100e0 * count(*) filter (where slang_bucket = 'slang') / count(*), 6) as slang_pct,
            round(avg(comet_qe) filter (where slang_bucket = 'formal'), 6) as formal_comet_qe,
            round(avg(comet_qe) filter (where slang_bucket = 'slang'), 6) as slang_comet_qe
        from tracked group by 1, 2""",
        "tracked",
    ),
    "slang_conditional_means": _sql(
        """select model, slang_bucket, count(*) as n, round(avg(comet_qe), 6) as mean_comet_qe from tracked
        where slang_bucket is not null group by 1, 2""",
        "tracked",
    ),
    "metric_merge": _sql(
        """select coalesce(a.row_id, b.row_id, c.row_id) as row_id, a.ifeval, c.comet, b.comet_qe
        from (select row_id, ifeval from scored where ifeval is not null) a
        full join (select row_id, comet_qe from scored where comet_qe is not null) b on b.row_id = a.row_id
        full join (select row_id, comet from scored where comet is not null) c on c.row_id = coalesce(a.row_id, b.row_id)""",
        "scored",
    ),
    "metric_merge_rows": _sql(
        """select model, dataset, id1, id2, language, hypothesis, ifeval, comet_qe, comet from scored
        where ifeval is not null or comet_qe is not null or comet is not null""",
        "scored",
    ),
    "metric_merge_repeats": _sql(
        """select model, dataset, case when cast(id2 as bigint) % 2 = 0 then id2 when cast(id2 as bigint) % 4 = 1 then 'again' end as id2,
            language, hypothesis, ifeval, comet_qe, comet from scored
        where ifeval is not null or comet_qe is not null or comet is not null""",
        "scored",
    ),
    "judge_f1": _sql(
        """select judge, tp, fp, fn, round(case when tp + fp > 0 then tp / (tp + fp) end, 6) as precision,
            round(case when tp + fn > 0 then tp / (tp + fn) end, 6) as recall,
            round(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) end, 6) as f1 from judged""",
        "judged",
    ),
    "judge_decision": _sql(
        """select round(c, 6) as candidate_f1, round(b, 6) as baseline_f1, c - b >= 0.05 as accepted from
        (select max(2 * tp / (2 * tp + fp + fn)) filter (where judge = 'candidate') as c,
                max(2 * tp / (2 * tp + fp + fn)) filter (where judge = 'baseline') as b from judged)""",
        "judged",
    ),
    "coverage_matrix": _sql(
        "select model, "
        + ", ".join(
            f"case when count(*) filter (where dataset = '{d}') > 0 then concat('ran (', count(*) filter (where dataset = '{d}'), ')') else 'missing' end as {d}"
            for d in ("mono_me", "mono_sea", "bilingual")
        )
        + " from scored group by model",
        "scored",
    ),
    "speed_table": _sql(
        """select m.model, m.dataset, round(elapsed_seconds, 6) as elapsed_seconds, req_per_s, concurrency, n_errors
        from run_meta m where (m.model, m.dataset) in (select (model, dataset) from scored)""",
        "scored",
        "run_meta",
    ),
    "revision_check": """select model, string_agg(rev, ',' order by rev) as model_revision, count(*) as n_revisions, count(*) = 1 as consistent
        from (select distinct case user_id % 3 when 0 then 'org0/model-a' when 1 then 'org0/model-b' else 'org1/model_c' end as model,
                concat('rev', cast(json_extract_string(props, '$.k') as int) % 2) as rev
              from events where event_type <> 'error') group by model""",
    "run_totals": _sql(
        """select g.model, g.dataset, g.n_rows, g.n_errors, round(m.elapsed_seconds, 6) as elapsed_seconds,
            case when m.elapsed_seconds > 0 then round(g.n_rows / m.elapsed_seconds, 3) end as req_per_s
        from (select model, dataset, count(*) as n_rows, count(*) filter (where error <> '') as n_errors from scored group by 1, 2) g
        left join run_meta m on m.model = g.model and m.dataset = g.dataset""",
        "scored",
        "run_meta",
    ),
    "load_counts": _sql(
        """select count(*) as n_rows, count(distinct concat(model, '|', dataset)) as n_files,
            count(distinct dataset) as n_datasets from scored""",
        "scored",
    ),
    "option_values": _sql(
        """select distinct 'model' as option, model as value from scored union all select distinct 'dataset', dataset from scored
        union all select distinct 'language', language from scored where language is not null""",
        "scored",
    ),
    "meta_json": """select event_id, cast(json_extract(props, '$.k') as double) as k, cast(null as double) as absent from events""",
    "compare_candidates": _sql("select * from comparable_keys", "comparable_keys"),
    "ifeval_disagreements": _sql(
        f"""select {_KEY}, count(distinct model) as n_models from scored
        where id1 is not null and id2 is not null and language is not null and dataset is not null group by {_KEY}
        having count(distinct model) >= 2 and min(ifeval) < 1 and max(ifeval) >= 1""",
        "scored",
    ),
    "source_preview": _sql(
        f"""select f.id1, f.id2, f.language, f.dataset,
            concat('[', f.dataset, '/', coalesce(f.language, 'None'), ']  ', {_preview('f.source')}) as label
        from (select *, row_number() over (partition by {_KEY} order by row_id) as place from scored) f
        join comparable_keys k on {_same('f', 'k', _KEY)} where place = 1""",
        "comparable_keys",
    ),
    "side_by_side": _sql(
        f"""select f.id1, f.id2, f.language, f.dataset, model, hypothesis, reference, ifeval, comet_qe, row_id
        from scored f join comparable_keys k on {_same('f', 'k', _KEY)}""",
        "comparable_keys",
    ),
    "first_reference": _sql(
        f"""select {_KEY}, reference from (select *, row_number() over (partition by {_KEY} order by row_id) as place
        from scored where reference is not null) where place = 1""",
        "scored",
    ),
    "browse_worst": _browse("comet_qe asc nulls first"),
    "browse_best": _browse("comet_qe desc nulls last"),
    "browse_polluted": _browse("ifeval asc nulls last, comet_qe asc nulls last"),
    "browse_longest": _browse("length(source) desc"),
    "text_search": _sql(
        """select row_id, model, dataset from scored
        where contains(lower(source), 'thand') or contains(lower(coalesce(hypothesis, '')), 'thand')""",
        "scored",
    ),
    "text_search_indexed": _sql(
        """select row_id, dataset, contains(lower(text), 'schach') as in_source, contains(lower(coalesce(translation, '')), 'schach') as in_hypothesis
        from eval_rows where in_source or in_hypothesis""",
        "eval_rows",
    ),
    "filters_all": _sql(
        """select row_id, model, dataset, language, ifeval, comet_qe, slang_density, slang_hits
        from tracked where dataset in ('mono_sea', 'bilingual') and language in ('en', 'fr', 'es') and coalesce(ifeval, 0) >= 1
          and coalesce(comet_qe, 0) between 0.2 and 0.9 and slang_density between 0.1 and 0.8 and slang_hits >= 3
          and (contains(lower(source), 'the') or contains(lower(coalesce(hypothesis, '')), 'the'))""",
        "tracked",
    ),
    "filter_polluted": _sql(
        """select row_id, model, dataset, ifeval, comet_qe from scored
        where coalesce(ifeval, 0) < 1 and coalesce(comet_qe, 0) between 0 and 0.5""",
        "scored",
    ),
    "drop_missing": _sql(
        """select model, dataset, count(*) as n_before, count(*) filter (where coalesce(hypothesis, '') = '') as n_dropped,
            count(*) filter (where hypothesis <> '') as n_after from scored group by 1, 2""",
        "scored",
    ),
    "exemplars": _examples(),
    "worst_per_file": _sql(
        """select model, dataset, lang_codes, source, hypothesis, comet_qe, row_id from
        (select *, row_number() over (partition by model, dataset order by comet_qe asc nulls last, row_id) as place from scored)
        where place <= 5""",
        "scored",
    ),
    "source_profile": _sql(
        """select dataset, count(*) as n_rows, round(avg(text_chars), 6) as mean_chars,
            round(quantile_cont(text_chars, 0.5), 6) as median_chars, round(quantile_cont(text_chars, 0.9), 6) as p90_chars,
            round(avg(text_words), 6) as mean_words, round(avg(is_code_switched::int), 6) as pct_code_switched,
            round(avg(lang_count), 6) as mean_lang_count, round(avg(semantic_similarity), 6) as mean_sem_sim
        from lengths group by dataset""",
        "lengths",
    ),
    "text_lengths": _sql("select row_id, text_chars, text_words, translation_chars from lengths", "lengths"),
    "language_distribution": _sql(
        """select dataset, trim(code) as lang, count(*) as n from
        (select dataset, unnest(string_split(coalesce(lang_codes, ''), ',')) as code from eval_rows)
        where trim(code) <> '' group by 1, 2""",
        "eval_rows",
    ),
    "code_switch_rate": _sql(
        "select dataset, round(avg(is_code_switched::int), 6) as pct_code_switched from eval_rows group by 1", "eval_rows"
    ),
    "lang_count_dist": _sql("select dataset, lang_count, count(*) as n from eval_rows group by 1, 2", "eval_rows"),
    "lang_breakdown": _sql("select lang_codes, count(*) as n from eval_rows group by 1", "eval_rows"),
    "length_histogram": _sql(
        """select dataset, bin, n, round(lo + bin * (hi - lo) / 80, 6) as bin_start from
        (select dataset, lo, hi, cast(least(79, floor((text_chars - lo) / ((hi - lo) / 80))) as int) as bin, count(*) as n
         from lengths, (select min(text_chars)::double as lo, max(text_chars)::double as hi from lengths) group by all)""",
        "lengths",
    ),
    "score_histogram": _sql(
        """select model, dataset, cast(least(49, floor(comet_qe / 2e-2)) as int) as bin, count(*) as n,
            round(cast(least(49, floor(comet_qe / 2e-2)) as int) * 2e-2, 6) as bin_start
        from scored where comet_qe is not null group by all""",
        "scored",
    ),
    "box_scores": _sql(_box("comet_qe", "model, dataset", "scored"), "scored"),
    "box_lengths": _sql(_box("text_chars", "dataset", "lengths"), "lengths"),
    "box_similarity": _sql(_box("semantic_similarity", "dataset", "eval_rows"), "eval_rows"),
    "embedding_cosine": """select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as similarity
        from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
    "tokens": _sql(
        "select doc_id, array_to_string(toks, ' ') as tokens, len(toks) as n_tokens from doc_tokens", "doc_tokens"
    ),
    "lexicon_build": f"""with words as (select conv_id, turn, regexp_extract_all(text, '{_TOKENS}') as w from conversations),
        placed as (select conv_id, turn, w, unnest(range(len(w))) as pos from words),
        raw as (select case when pos % 11 = 0 then '' else lower(w[pos + 1]) end as slang,
                case when pos % 5 = 0 then lower(w[pos + 1]) else lower(coalesce(w[pos + 2], '')) end as formal,
                (conv_id * 1000 + turn) * 100000 + pos as row_id from placed)
        select slang, formal from (select *, row_number() over (partition by slang order by row_id) as place from raw
            where slang <> '' and slang <> formal) where place = 1""",
    "slang_density": _sql(
        "select doc_id, slang_density, slang_hits, n_tokens from density", "density"
    ),
    "slang_summary": _sql(
        """select count(*) as n_rows, round(avg(slang_density), 6) as mean_density,
            round(100e0 * count(*) filter (where slang_hits > 0) / count(*), 6) as pct_with_hit,
            round(quantile_cont(slang_density, 0.5), 6) as median_density, round(quantile_cont(slang_density, 0.9), 6) as p90_density
        from density where n_tokens >= 5""",
        "density",
    ),
    "slang_histogram": _sql(
        """select cast(least(49, floor(slang_density / 2e-2)) as int) as bin, count(*) as n,
            round(cast(least(49, floor(slang_density / 2e-2)) as int) * 2e-2, 6) as bin_start
        from density where n_tokens >= 5 group by all""",
        "density",
    ),
    "slang_track": _sql(
        "select row_id, lang_codes, slang_density, slang_hits, n_tokens from en_tracks where place <= 100",
        "en_tracks",
    ),
    "formal_track": _sql(
        "select row_id, lang_codes, slang_density, slang_hits, n_tokens from en_tracks where place > 100",
        "en_tracks",
    ),
    "split_report": _sql(
        """select count(*) as n_slang, min(slang_density) as min_density, max(slang_density) as max_density,
            min(slang_hits) as min_hits, max(slang_hits) as max_hits,
            list(slang_density order by slang_density desc)[count(*) // 2 + 1] as median_density,
            list(slang_hits order by slang_hits)[count(*) // 2 + 1] as median_hits,
            min(slang_density) as cutoff_density
        from en_tracks where place <= 100""",
        "en_tracks",
    ),
    "track_preview": _sql(
        """select slang_density, slang_hits, t.row_id,
            concat(left(replace(text, chr(10), ' '), 140), case when length(text) > 140 then '…' else '' end) as preview
        from en_tracks t join eval_rows e on e.row_id = t.row_id where place <= 3""",
        "en_tracks",
    ),
    "rescore_selection": _sql(
        """select model, slang_density, slang_hits, row_id, n_tokens from
        (select *, row_number() over (partition by model order by slang_density desc, slang_hits desc, row_id) as place
         from tracked where n_tokens >= 5) where place <= 50""",
        "tracked",
    ),
    "row_cap": _sql(
        """select dataset, row_id, id2 from (select *, row_number() over (partition by dataset order by row_id) as place from eval_rows)
        where place <= 10""",
        "eval_rows",
    ),
    "prompt_zero_shot": _sql(
        f"select row_id, concat({_ASK}, chr(10), chr(10), coalesce(text, '')) as prompt from eval_rows", "eval_rows"
    ),
    "prompt_few_shot": _sql(
        f"""select p.row_id, p.dataset, concat('The following are example translations:', chr(10), e.block, chr(10), {_ASK}, chr(10),
            {_SHOT_LINES}, chr(10), 'Translation:') as prompt
        from (select *, row_number() over (partition by dataset order by row_id) as place from eval_rows) p
        join (select dataset, string_agg(concat({_SHOT_LINES}, chr(10), 'Translation: ', coalesce(translation, ''), chr(10)), chr(10) order by row_id) as block
              from (select *, row_number() over (partition by dataset order by row_id) as place from eval_rows) where place <= 3
              group by dataset) e on e.dataset = p.dataset
        where p.place > 3""",
        "eval_rows",
    ),
    "translations_projection": _sql(
        f"""select 'org0/model-a' as model, id1, id2, lang_codes, lang_codes as language, coalesce(text, '') as source,
            case when row_id % 50 = 0 then '' else {_trim('case when row_id % 10 = 0 then text else reverse(text) end')} end as hypothesis,
            coalesce(translation, '') as reference, case when row_id % 50 = 0 then 'timeout' end as error from eval_rows""",
        "eval_rows",
    ),
    "name_parse_summary": _sql(
        r"""select file_name, n, slug, parsed_dataset, regexp_replace(slug, '^([^_]*)_', '\1/') as parsed_model
        from (select *, regexp_extract(file_name, '^(.*)_(mono_sea|mono_me)_scored\.csv$', 1) as slug,
                regexp_extract(file_name, '^(.*)_(mono_sea|mono_me)_scored\.csv$', 2) as parsed_dataset from names)
        where parsed_dataset <> ''""",
        "names",
    ),
    "name_parse_stats": _sql(
        r"""select file_name, n, regexp_extract(file_name, '^(.*)_(mono_me|mono_sea|bilingual)_scored\.csv$', 1) as slug,
            regexp_extract(file_name, '^(.*)_(mono_me|mono_sea|bilingual)_scored\.csv$', 2) as split,
            case when file_name like '%\_mono\_sea\_scored.csv' escape '\' then 'mono_sea'
                 when file_name like '%\_mono\_me\_scored.csv' escape '\' then 'mono_me' else 'unknown' end as eda_dataset
        from names""",
        "names",
    ),
    "file_names": _sql(
        """select model, dataset, n, concat(slug, '_translations_', dataset, '.csv') as csv_name,
            concat(slug, '_', dataset, '_scored.csv') as scored_name, dataset as meta_dataset
        from (select *, replace(replace(model, '/', '_'), ':', '_') as slug from names)""",
        "names",
    ),
    "batch_infer": _sql(
        f"""select row_id, dataset, 'org0/model-a' as model, lang_codes,
            case when contains(prompt, 'onesen') then null else concat('[', string_split(prompt, chr(10))[-1], ']') end as hypothesis,
            case when contains(prompt, 'onesen') then 'refused' end as error
        from (select row_id, dataset, lang_codes, concat({_ASK}, chr(10), chr(10), coalesce(text, '')) as prompt from eval_rows)""",
        "eval_rows",
    ),
    "score_pairs": _sql(
        f"""select row_id,
            case when {_trim('hypothesis')} = '' then 0e0 when length({_trim('hypothesis')}) < 300 then 1e0 else 0e0 end as ifeval,
            round(length(hypothesis)::double / (length(source) + length(hypothesis)), 6) as comet_qe,
            round(length(hypothesis)::double / (length(source) + length(hypothesis) + 1), 6) as comet
        from pair_rows where hypothesis <> ''""",
        "pair_rows",
    ),
    "infer_resumed": _sql(
        f"""select row_id, dataset,
            case when contains(prompt, 'onesen') then null else concat('[', string_split(prompt, chr(10))[-1], '] 1024/0.0') end as hypothesis,
            case when contains(prompt, 'onesen') then 'refused' end as error,
            1 as times_asked
        from (select row_id, dataset, lang_codes, concat({_ASK}, chr(10), chr(10), coalesce(text, '')) as prompt from eval_rows)""",
        "eval_rows",
    ),
    "score_resumed": _sql(
        f"""select row_id,
            case when {_trim('hypothesis')} = '' then 0e0 when length({_trim('hypothesis')}) < 250 then 1e0 else 0e0 end as ifeval,
            round(length(hypothesis)::double / (length(source) + length(hypothesis)), 6) as comet_qe,
            round((length(hypothesis) + r)::double / (length(source) + length(hypothesis) + r + 1), 6) as comet, 1 as times_asked
        from (select *, case when row_id % 3 <> 0 then length(coalesce(source, '')) else 0 end as r from pair_rows) where hypothesis <> ''""",
        "pair_rows",
    ),
    "csv_mixed_headers": """select conv_id::bigint as conv_id, turn::bigint as turn,
        case when role in ('user', 'assistant') then role end as role, nullif(text, '') as text from conversations""",
    "jsonl_round_trip": _sql(
        """select e.id1, e.id2, e.lang_codes, e.is_code_switched, e.lang_count, round(e.semantic_similarity, 6) as semantic_similarity,
            l.text_chars, l.text_words, l.translation_chars, md5(e.text) as text_md5
        from eval_rows e join lengths l on l.row_id = e.row_id""",
        "eval_rows",
        "lengths",
    ),
    "file_row_cap": """select conv_id // 50 as file, conv_id * 1000 + turn as at, length(text) as chars from conversations
        qualify row_number() over (partition by conv_id // 50 order by conv_id, turn) <= 25""",
    "catalogue": "select source, count(*) as n_first, count(*) as n_rows from documents where source in ('src0', 'src1') group by source",
    "summary_levels": _sql(
        f"""select model, dataset, null::varchar as language, 'run' as level, count(*) as n_rows, {_block()}, {_JOINT} as joint_pass_rate
            from scored group by model, dataset
        union all select model, dataset, language, 'language', count(*), {_block()}, {_JOINT} from scored group by model, dataset, language""",
        "scored",
    ),
    "pair_scores": """with parts as (
            select vec_id, i, list_transform(embedding[i * 8 + 1:i * 8 + 8], lambda x: x::double) as v from embeddings, range(8) r(i)),
        sides as (select l.vec_id, l.i as i, r.i as j, list_cosine_similarity(l.v, r.v) as c
            from parts l join parts r on r.vec_id = l.vec_id + 1),
        p as (select vec_id, avg(m) as precision from (select vec_id, i, max(c) as m from sides group by 1, 2) group by 1),
        q as (select vec_id, avg(m) as recall from (select vec_id, j, max(c) as m from sides group by 1, 2) group by 1)
        select p.vec_id, round(precision, 6) as precision, round(recall, 6) as recall,
            round(2 * precision * recall / (precision + recall), 6) as f1 from p join q on p.vec_id = q.vec_id""",
    "store_rerun": _sql(
        f"""select g.model, g.dataset, n_rows_scored, n_source_rows, n_errors, round(n_errors / n_source_rows, 6) as error_rate,
            mean_ifeval, mean_comet_qe, median_comet_qe, p10_comet_qe, p90_comet_qe, joint_pass_rate, 3 as n_records
        from (select model, dataset, count(*) as n_rows_scored, {_block()}, {_JOINT} as joint_pass_rate
              from scored where language <> '' group by model, dataset) g
        join (select model, dataset, count(*) as n_source_rows, count(error) as n_errors from scored group by model, dataset) s
          on s.model = g.model and s.dataset = g.dataset""",
        "scored",
    ),
    "meta_round_trip": _sql(
        """select model, dataset, 2 as n_records, n_rows, n_errors, 32 as concurrency, round(elapsed_seconds, 6) as elapsed_seconds,
            round(req_per_s, 6) as req_per_s from run_meta""",
        "run_meta",
    ),
}
SQL["lexicon_json_round_trip"] = SQL["lexicon_build"]
SQL["slang_density_joined"] = SQL["slang_density"]
# The same rows under ids that are unique in their group only.
SQL["exemplars_repeated_ids"] = SQL["exemplars"]
SQL["worst_repeated_ids"] = f"select * replace (row_id // 4 as row_id) from ({SQL['worst_per_file']})"
SQL["few_shot_repeated_ids"] = f"select * replace (row_id // 3 as row_id) from ({SQL['prompt_few_shot']})"
SQL["tracks_round_trip"] = _sql(
    """select case when place <= 100 then 'slang' else 'formal' end as track,
        case when place <= 100 then place else place - 100 end as place, t.row_id, md5(e.text) as text_md5
    from en_tracks t join eval_rows e on e.row_id = t.row_id""",
    "en_tracks",
)
SQL["bundle_round_trip"] = f"""select 'overall' as section, model, dataset, null::varchar as language, null::varchar as category,
        n_rows_scored as n, mean_comet_qe, joint_pass_rate, null::varchar as hypothesis_md5 from ({SQL['summary_overall']})
    union all select 'by_language', model, dataset, language, null, n_rows, mean_comet_qe, joint_pass_rate, null from ({SQL['summary_by_language']})
    union all select 'examples', model, dataset, language, category, null, null, null, md5(hypothesis) from ({SQL['exemplars']})"""
SQL["enrich_mixed"] = f"""select *, (select count(*) from documents where doc_id % 3 <> 0) as n_rows
    from ({SQL['slang_density']}) where doc_id % 3 <> 0"""
