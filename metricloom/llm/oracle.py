"""SQL with the same results for a second engine, where SQL can state the whole result."""

from __future__ import annotations

from metricloom.llm import line_frequency, url_rules

WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(source: str, text: str) -> str:
    """(doc_id, word, pos) of the words of each text."""
    found = f"regexp_extract_all({text}, '{WORD}')"
    return f"""
        select doc_id, unnest({found}) as word, unnest(range(1, len({found}) + 1)) as pos
        from {source}"""


def lines(source: str) -> str:
    """(doc_id, line, pos) of the lines of each text."""
    found = "string_split(text, chr(10))"
    return f"""
        select *, unnest({found}) as line, unnest(range(1, len({found}) + 1)) as pos
        from {source}"""


OP2 = f"""
    with docs as (
        select doc_id, coalesce(text, '') as text, coalesce(source, '') as host from documents),
    w as ({words('docs', 'text')}),
    eight as (
        select *, string_agg(word, ' ') over next_eight as run, count(*) over next_eight as n
        from w
        window next_eight as (
            partition by doc_id order by pos rows between current row and 7 following)),
    seen as (
        select *, n = 8 and count(*) over (partition by doc_id, n, run) > 1 as again from eight),
    covered as (
        select *, max(cast(again as integer)) over (
                partition by doc_id order by pos rows between 7 preceding and current row) as inside
        from seen),
    counted as (
        select doc_id, count(*) as n_words, cast(sum(length(word)) as bigint) as word_chars,
               cast(sum(inside) as bigint) as n_repeat_words
        from covered group by doc_id),
    l as (select * from ({lines('docs')}) where regexp_matches(line, '{WORD}')),
    dup as (
        select doc_id, count(*) - count(distinct line) as n_dup_lines from l group by doc_id),
    normal as (
        select *, {lower(f"regexp_replace(trim(line, {ENDS}), '{WS}+', ' ', 'g')")} as key
        from l),
    frequent as (
        select host, key from normal group by host, key
        having count(distinct text) > {line_frequency.LINE_DOCUMENTS}),
    gone as (
        select doc_id, cast(sum(len(regexp_extract_all(key, '{WORD}'))) as bigint) as n
        from normal join frequent using (host, key) group by doc_id),
    judged as (
        select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
               cast(length(text) - length(translate(text, '{line_frequency.SYMBOLS}', ''))
                    as bigint) as n_symbols,
               coalesce(n_dup_lines, 0) as n_dup_lines,
               coalesce(n_repeat_words, 0) as n_repeat_words,
               coalesce(gone.n, 0) as n_boilerplate_words
        from docs left join counted using (doc_id) left join dup using (doc_id)
        left join gone using (doc_id)),
    based as (
        select *, n_words < {line_frequency.LEAST_WORDS}
               or 100 * n_repeat_words > {line_frequency.MOST_REPEATED_PERCENT} * n_words
                   as base_failed
        from judged)
    select *, not base_failed
              and 100 * n_boilerplate_words <= {line_frequency.DEPLETED_PERCENT} * n_words as kept
    from based"""

OP4 = f"""
    with docs as (select doc_id, coalesce(text, '') as text from documents),
    l as (
        select doc_id, line, pos, {lower(f"trim(line, {ENDS})")} as key
        from ({lines('docs')})),
    full_keys as (
        select key from (select distinct doc_id, key from l where key <> '')
        group by key having count(*) >= 10),
    marked as (
        select l.*, f.key is not null as dropped
        from l left join full_keys f on f.key = l.key)
    select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), ''))
               as kept_sha256
    from marked group by doc_id"""

OP5 = f"""
    with recursive docs as (
        select doc_id, {lower("coalesce(text, '')")} as text from documents),
    w as ({words('docs', 'text')}),
    five as (
        select *, string_agg(word, ' ') over next_five as run, count(*) over next_five as n,
               count(*) over (partition by doc_id) as n_words
        from w
        window next_five as (
            partition by doc_id order by pos rows between current row and 4 following)),
    shingles as materialized (
        select distinct doc_id, run from five where n = 5 or (n_words < 5 and pos = 1)),
    sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
    links as materialized (
        select a.doc_id as a, b.doc_id as b
        from shingles a join shingles b on a.run = b.run and a.doc_id <> b.doc_id
        join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
        group by a.doc_id, b.doc_id, m.n, n.n
        having 100 * count(*) >= 75 * (m.n + n.n - count(*))),
    reached(doc_id, other) as (
        select doc_id, doc_id from docs
        union
        select r.doc_id, l.b from reached r join links l on l.a = r.other)
    select r.doc_id, any_value(coalesce(s.n, 0)) as n_shingles, min(r.other) as component_id
    from reached r left join sizes s on s.doc_id = r.doc_id group by r.doc_id"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_rules.RULES)
OP9 = f"""
    with placed as (
        select page_id,
               {lower(f"coalesce(regexp_extract(url, '{url_rules.ADDRESS}', 1), '')")} as host,
               coalesce(regexp_extract(url, '{url_rules.ADDRESS}', 2), '') as path
        from pages),
    rules as (
        select *, r.host || r.path as rule
        from (values {_RULES}) as r(verdict, host, path)),
    fit as (
        select p.*, r.rule, r.verdict, row_number() over (
                   partition by p.page_id order by length(r.rule) desc, length(r.host) desc) as n
        from placed p left join rules r
          on (p.host = r.host or ends_with(p.host, '.' || r.host))
         and starts_with(p.path, r.path))
    select page_id, host, path, rule,
           coalesce(verdict, '{url_rules.DEFAULT_VERDICT}') as verdict
    from fit where n = 1"""

OP10 = """
    with full_pages as (select page_id, coalesce(html, '') as payload from pages),
    firsts as (
        select payload, min(page_id) as first_id from full_pages
        where strlen(payload) >= 100 group by payload)
    select page_id, cast(strlen(p.payload) as bigint) as payload_bytes,
           sha256(p.payload) as payload_digest,
           if(first_id < page_id, 'revisit', 'response') as record_type,
           if(first_id < page_id, first_id, null) as refers_to
    from full_pages p left join firsts f on f.payload = p.payload"""

TERMS = """
regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')
"""
OP13 = f"""
with terms as (select doc_id, unnest({TERMS}) as term from documents),
tfs as (select doc_id, term, count(*) as tf from terms group by all),
sizes as (select doc_id, cast(sum(tf) as bigint) as n from tfs group by doc_id),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
weights as (
    select term, cast(floor(1000 * ln((2.0::double * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) as w
    from tfs cross join totals group by term),
lengths as (
    select doc_id, 100 - 90 + ((90 * n * n_docs) // n_terms) as m from sizes cross join totals),
asked as (select distinct item_id, unnest({TERMS}) as term from benchmark),
scores as (
    select item_id, doc_id,
           cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
    from asked join tfs using (term) join weights using (term) join lengths using (doc_id)
    group by all),
ranked as (
    select item_id, doc_id, score,
           cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
    from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

ORACLE = {
    "op2_quality_rules": OP2,
    "op4_line_dedup": OP4,
    "op5_jaccard_join": OP5,
    "op9_url_filter": OP9,
    "op10_warc_round_trip": OP10,
    "op13_lexical_search": OP13,
}
