"""The same queries in SQL, for a second engine to run on the same tables."""

from __future__ import annotations

from checks import tables as t
from papyra.functions import fixed_values as fixed

# PageRank: enough steps from equal scores for ten decimals, as each shrinks the error to 0.85.
DAMPING, STEPS = 0.85, 150


# Stated here once more, so that a wrong constant in the library shows.
SPACES = (
    "\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
REMOVED = "():,;.’”“?%><≥≤~`'"
SEPARATOR = r"""[\s!@#$&\[\]{}"*«»‘„]+|--"""
TOKEN = r"^(19|20)[0-9]{2}|^[a-z][\p{L}\p{N}_\-]*$"
SENTENCE = r"(?:\S[^\n]+?[.!?](?:\s+|$))|(?:\S[^\n]+?(?:\n|$))"
ABBREVIATIONS = (
    r"([A-Z][a-z]{1,2}\.)\s([\p{L}\p{N}_])", r"(\.[a-zA-Z]\.)\s([\p{L}\p{N}_])",
)
K1, B, EPSILON = 1.5, 0.75, 0.25


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def with_(*parts: str, select: str) -> str:
    """A query with common tables, each given as ``name as (...)``, and a final select."""
    return "with " + ",\n".join(parts) + "\n" + select


# --- expressions -------------------------------------------------------------------------


def clean_text(text: str) -> str:
    return f"translate(lower({text}), {quote('/' + SPACES + REMOVED)}, {quote(' ' * (1 + len(SPACES)))})"


def plain_spaces(text: str) -> str:
    return f"translate({text}, {quote(SPACES)}, {quote(' ' * len(SPACES))})"


def tokens(text: str, stop_words=fixed.STOP_WORDS) -> str:
    words = ", ".join(quote(w) for w in sorted(set(stop_words)))
    return (
        f"list_filter(string_split_regex({clean_text(text)}, {quote(SEPARATOR)}),"
        f" lambda w: length(w) >= 2 and w not in ({words})"
        f" and regexp_matches(w, {quote(TOKEN)}))"
    )


def shorten(text: str, length: int) -> str:
    return (
        f"coalesce(case when length({text}) > {length}"
        f" then substr({text}, 1, {length}) || '...' else {text} end, '')"
    )


def iso_date(date: str) -> str:
    return f"""case when {date} is null then ''
        when regexp_full_match({date}, '[0-9]{{4}}') then {date} || '-01-01'
        when regexp_full_match({date}, '[0-9]{{4}}-[0-9]{{2}}') then {date} || '-01'
        else strftime(try_cast({date} as date), '%Y-%m-%d') end"""


def widened(text: str) -> str:
    for plain, wide in t.WIDE_SPACES:
        text = f"replace({text}, {quote(plain)}, {quote(wide)})"
    return text


def sentence_list(text: str) -> str:
    return f"regexp_extract_all({plain_spaces(text)}, {quote(SENTENCE)})"


def summary_sentence_list(text: str) -> str:
    text = plain_spaces(text)
    for abbreviation in ABBREVIATIONS:
        text = f"regexp_replace({text}, {quote(abbreviation)}, '\\1' || chr(1) || '\\2', 'g')"
    return (
        f"list_transform({sentence_list(text)},"
        r" lambda s: replace(regexp_replace(s, '\s+$', ''), chr(1), ' '))"
    )


# --- common tables -----------------------------------------------------------------------

PAPERS = """papers as (select doc_id,
    case when doc_id % 11 = 0 then null else split_part(text, chr(10), 1) end as title,
    case when doc_id % 13 = 0 then 'Unknown' when doc_id % 17 = 0 then null else text end
        as abstract,
    case when doc_id % 7 = 0 then null when doc_id % 5 = 0 then '2020'
        else strftime(date '2019-01-01' + cast(doc_id % 730 as int), '%Y-%m-%d') end
        as publish_time,
    cast(null as varchar) as authors, 'http://x/' || doc_id as url
  from documents)"""
DATED = """dated as (select o_orderkey as doc_id,
    case when o_orderkey % 7 = 0 then null when o_orderkey % 5 = 0 then strftime(o_orderdate + interval 22 years, '%Y')
        when o_orderkey % 19 = 0 then 'spring ' || o_orderkey
        when o_orderkey % 23 = 0 then strftime(o_orderdate + interval 22 years, '%Y-%m')
        else strftime(o_orderdate + interval 22 years, '%Y-%m-%d') end as publish_time
  from orders)"""
ISO_DATED = f"iso_dated as (select doc_id, {iso_date('publish_time')} as publish_time from dated)"
# Papers without ids, each told apart by a hash of its row.
NAMELESS = """papers as (select *, substr(sha256(
    concat_ws(',', length(a), length(b), length(c), length(d), length(e), a, b, c, d, e)), 1, 30) as doc_id
  from (select *, coalesce('=' || title, '-') as a, coalesce('=' || abstract, '-') as b,
      coalesce('=' || publish_time, '-') as c, coalesce('=' || authors, '-') as d,
      coalesce('=' || url, '-') as e
    from (select distinct case when doc_id % 11 = 0 then null
          else nullif(split_part(text, chr(10), 1), '') end as title,
        case when doc_id % 13 = 0 then 'Unknown' when doc_id % 17 = 0 then null
          else nullif(text, '') end as abstract,
        case when doc_id % 7 = 0 then null when doc_id % 5 = 0 then '2020'
          else strftime(date '2019-01-01' + cast(doc_id % 730 as int), '%Y-%m-%d') end
          as publish_time,
        cast(null as varchar) as authors, 'http://x/' || doc_id as url
      from documents)))"""
CLEAN_TITLE = f"""clean_title as (select * replace (
    case when length(coalesce(title, '')) < {fixed.SHORT_TITLE}
        and not regexp_matches(coalesce(title, ''), {quote(t.RELEVANT)})
        then '' else coalesce(title, '') end as title)
  from papers)"""
CLEAN_ABSTRACT = f"""clean_abstract as (select * replace (
    regexp_replace(coalesce(nullif(abstract, 'Unknown'), title), {quote(t.NOISE)}, '', 'g')
        as abstract)
  from clean_title)"""
DEDUP = """dedup as (select * exclude (copy) from (
    select *, row_number() over (partition by abstract order by doc_id) as copy
    from clean_abstract) where copy = 1)"""
CLEANED = (PAPERS, CLEAN_TITLE, CLEAN_ABSTRACT)

IS_COVID = f"""coalesce(publish_time > '{fixed.COVID_TAG_DATE}' or publish_time is null
    or regexp_matches(abstract, {quote('|'.join(t.COVID_TERMS))}), false)"""
IS_VIRUS = f"coalesce(regexp_matches(abstract, {quote(t.VIRUS)}), false)"
IS_CORONA = f"coalesce(regexp_matches(abstract, {quote(t.CORONA)}), false)"
IS_SARS = f"(not {IS_COVID} and coalesce(regexp_matches(abstract, {quote(t.SARS)}), false))"
PREPARED = (*CLEANED, DEDUP, f"""prepared as materialized (select doc_id,
    {iso_date('publish_time')} as publish_time, title, abstract,
    {IS_COVID} as covid_related, {IS_VIRUS} as virus_related, {IS_CORONA} as corona_related,
    {IS_SARS} as sars_related, url
  from dedup)""")

# As "prepared", with the library's default patterns: here stated once more.
DEFAULTS = """
  select doc_id, case when publish_time is null then '' when length(publish_time) = 4
      then publish_time || '-01-01' else publish_time end as publish_time, title, abstract,
    coalesce(publish_time > '2019-11-30' or publish_time is null or regexp_matches(abstract,
      'covid|sars-?n?cov-?2|2019-ncov|novel coronavirus|sars coronavirus 2'), false) as covid_related,
    coalesce(regexp_matches(abstract, 'virus|viruses|viral'), false) as virus_related,
    coalesce(regexp_matches(abstract, 'corona'), false) as corona_related,
    coalesce(not (publish_time > '2019-11-30' or publish_time is null or regexp_matches(abstract,
      'covid|sars-?n?cov-?2|2019-ncov|novel coronavirus|sars coronavirus 2'))
      and regexp_matches(abstract, 'sars'), false) as sars_related, url
  from (select *, row_number() over (partition by abstract order by doc_id) as copy from (
    select * replace (regexp_replace(coalesce(nullif(abstract, 'Unknown'), title),
      '(Publisher|Abstract|Summary|BACKGROUND|INTRODUCTION)', '', 'g') as abstract) from (
    select * replace (case when length(coalesce(title, '')) < 30 and not regexp_matches(coalesce(title, ''),
      'vir|sars|mers|corona|ncov|immun|nosocomial.*epidem|emerg|vacc|cytokine')
      then '' else coalesce(title, '') end as title) from papers)))
  where copy = 1"""

DOCUMENTS = ("""corpus as (select doc_id, text, split_part(text, chr(10), 1) as title
  from documents)""",)
PREPARED_CORPUS = (*PREPARED, "corpus as (select *, abstract as text from prepared)")


def postings(stop_words) -> tuple[str, ...]:
    """Index tables over ``corpus(doc_id, text)``."""
    return (
        f"tokenized as (select doc_id, {tokens('text', stop_words)} as tokens from corpus)",
        """postings as materialized (
            select doc_id, term, count(*) as tf, any_value(dl) as dl
            from (select doc_id, len(tokens) as dl, unnest(tokens) as term from tokenized)
            group by doc_id, term)""",
        """counts as (select count(*) as n,
            coalesce(sum(len(tokens)) / count(*), 0) as avgdl from tokenized)""",
        """raw_terms as (select term, count(*) as df,
            ln((select n from counts) - count(*) + 0.5) - ln(count(*) + 0.5) as raw_idf
            from postings group by term)""",
        """stats as materialized (select n, avgdl,
            (select avg(raw_idf) from raw_terms) as mean_idf from counts)""",
        f"""terms as (select term, df, case when raw_idf < 0
            then {EPSILON} * (select mean_idf from stats) else raw_idf end as idf
            from raw_terms)""",
    )


def scores(queries: str, stop_words) -> tuple[str, ...]:
    """``scores(qid, doc_id, score)`` of all documents for the queries selected."""
    k1, b = K1, B
    return (
        *postings(stop_words),
        f"queries as ({queries})",
        f"""query_terms as (select qid, term, count(*) as repeats
            from (select qid, unnest({tokens('text', stop_words)}) as term from queries)
            group by qid, term)""",
        f"""hits as (select qid, doc_id, sum(repeats * idf * tf * ({k1} + 1)
                / (tf + {k1} * (1 - {b} + {b} * dl / (select avgdl from stats)))) as total
            from query_terms join terms using (term) join postings using (term)
            group by qid, doc_id)""",
        """scores as (select q.qid, c.doc_id, round(coalesce(h.total, 0), 9) as score
            from queries q cross join corpus c
            left join hits h on h.qid = q.qid and h.doc_id = c.doc_id)""",
    )


def one_query(text: str, stop_words) -> tuple[str, ...]:
    return scores(f"select 0 as qid, {quote(text)} as text", stop_words)


def top(k: int, where: str = "true") -> tuple[str, ...]:
    """``top(qid, rank, doc_id, score)``, then ``listed`` with one hit per title."""
    return (
        f"""top as (select * from (
            select qid, doc_id, score, row_number() over (
                partition by qid order by score desc, doc_id) as rank
            from scores join corpus using (doc_id) where {where}) where rank <= {k})""",
        """listed as (select * exclude (place) from (
            select top.qid, top.rank, top.score, corpus.*, row_number() over (
                partition by top.qid, title order by score desc, doc_id) as place
            from top join corpus using (doc_id)) where place = 1)""",
    )


def summaries(source: str) -> tuple[str, ...]:
    """``summaries(doc_id, summary)`` for ``select doc_id, text``, over explicit pairs."""
    k1, b, words = K1, B, 120
    first = (
        f"texts as materialized (select doc_id, text, {summary_sentence_list('text')} as parts,"
        f" len({sentence_list('text')}) as raw_sentences from ({source}))",
        """cut as (select doc_id, unnest(parts) as sentence,
            generate_subscripts(parts, 1) - 1 as pos from texts)""",
        rf"""bags as (select doc_id, pos, list_sort({tokens('sentence')}) as bag,
            len(regexp_extract_all(sentence, '\S+')) as words from cut)""",
        """sentences as materialized (select doc_id, pos, bag,
            min(pos) over w as node, max(pos) over w as shown,
            last_value(words) over (partition by doc_id, bag order by pos
                rows between unbounded preceding and unbounded following) as words
            from bags where len(bag) > 0 window w as (partition by doc_id, bag))""",
        """units as materialized (select doc_id, node, term, count(*) as times
            from (select doc_id, node, unnest(bag) as term from sentences where pos = node)
            group by doc_id, node, term)""",
        """nodes as (select doc_id, node, count(*) as size from units group by doc_id, node)""",
        """sizes as materialized (select doc_id, count(*) as n, avg(size) as mean_size
            from nodes group by doc_id)""",
        """raw_units as (select doc_id, term, times, count(*) as df,
            ln(any_value(n) - count(*) + 0.5) - ln(count(*) + 0.5) as raw
            from units join sizes using (doc_id) group by doc_id, term, times)""",
        "means as (select doc_id, avg(raw) as mean_raw from raw_units group by doc_id)",
        f"""weights as (select doc_id, term, times, case when raw < 0
            then greatest({EPSILON} * mean_raw, 0) else raw end as idf
            from raw_units join means using (doc_id) where df > 1)""",
        f"""gains as (select doc_id, node,
            ({k1} + 1) / (1 + {k1} * (1 - {b} + {b} * size / mean_size)) as gain
            from nodes join sizes using (doc_id))""",
        """shared as (select a.doc_id, a.node as i, b.node as j, sum(idf) as idf
            from units a join units b on a.doc_id = b.doc_id and a.term = b.term
                and a.times = b.times and a.node <> b.node
            join weights w on w.doc_id = a.doc_id and w.term = a.term and w.times = a.times
            where idf > 0 group by a.doc_id, a.node, b.node)""",
        """edges as materialized (select s.doc_id, i, j, idf * gain as weight
            from shared s join gains g on g.doc_id = s.doc_id and g.node = greatest(i, j))""",
        """strengths as materialized (select doc_id, i as node, sum(weight) as strength
            from edges group by doc_id, i)""",
        """linked as materialized (select doc_id, count(*) as n, sum(strength) as total
            from strengths group by doc_id)""",
        """step0 as materialized (select doc_id, node, strength, n, 1 / n as rank
            from strengths join linked using (doc_id))""",
    )
    steps = tuple(
        f"""step{k} as materialized (select e.doc_id, e.j as node,
            any_value(s.strength) as strength, any_value(r.n) as n,
            {1 - DAMPING} / any_value(r.n)
                + {DAMPING} * sum(r.rank * e.weight / r.strength) as rank
            from edges e join step{k - 1} r on r.doc_id = e.doc_id and r.node = e.i
            join strengths s on s.doc_id = e.doc_id and s.node = e.j
            group by e.doc_id, e.j)"""
        for k in range(1, STEPS + 1)
    )
    last = (
        f"""ranked as (select s.doc_id, pos, shown, words,
            count(*) over (partition by s.doc_id) as sentences,
            row_number() over (partition by s.doc_id
                order by round(coalesce(rank * r.n, 0), 7) desc, pos) as place
            from sentences s
            left join step{STEPS} r on r.doc_id = s.doc_id and r.node = s.node
            left join linked l on l.doc_id = s.doc_id
            join sizes z on z.doc_id = s.doc_id
            where coalesce(l.n, z.n) >= 3)""",
        f"""missing as (select *, {words} - coalesce(sum(words) over (partition by doc_id
            order by place rows between unbounded preceding and 1 preceding), 0) as lack
            from ranked)""",
        """stops as (select doc_id, min(place) as stop from missing
            where abs(lack - words) > abs(lack) group by doc_id)""",
        f"""chosen as (select doc_id, list_sort(list(shown)) as shown
            from missing left join stops using (doc_id)
            where case when stop = 1 then place <= floor(sentences * {fixed.SUMMARY_RATIO})
                else place < coalesce(stop, sentences + 1) end
            group by doc_id)""",
        """summaries as (select doc_id, case when raw_sentences > 1 and shown is not null
            then array_to_string(
                list_transform(shown, lambda p: parts[p + 1]), chr(10)) else text end as summary
            from texts left join chosen using (doc_id))""",
    )
    return (*first, *steps, *last)


RECORDS = f"""{{keys}}doc_id, title,
    {shorten('abstract', fixed.ABSTRACT_LENGTH)} as abstract,
    {shorten('summary', fixed.SUMMARY_LENGTH)} as summary,
    url, round_even(score, 1) as score, publish_time
  from listed join summaries using (doc_id) where title is not null"""
HIT_TEXTS = "select distinct doc_id, abstract as text from listed"
ALL_PAPERS = "select doc_id, title, abstract, publish_time, authors, url from papers"
SCORED = "select doc_id, round(score, 6) as score from {}"
BATCH = "select item_id as qid, text from benchmark"


def oracle() -> dict[str, str]:
    full, short = fixed.STOP_WORDS, t.SHORT_STOP_LIST
    common, rare = t.COMMON_QUERY, t.RARE_QUERY
    index = (*DOCUMENTS, *postings(short))
    return {
        "scan_papers": with_(PAPERS, select="""select cast(doc_id as varchar) as doc_id,
            nullif(title, '') as title, nullif(abstract, '') as abstract, publish_time, url
            from papers"""),
        "write_read_roundtrip": with_(PAPERS, select=ALL_PAPERS),
        "multi_path_scan": with_(PAPERS, select="select doc_id, title, abstract, url from papers"),
        "multi_header_scan": with_(PAPERS, select="""select cast(doc_id as varchar) as doc_id, title, abstract,
            case when doc_id % 3 < 2 then url end as url,
            case when doc_id % 3 = 2 then publish_time end as publish_time from papers"""),
        "register_table": with_(PAPERS, select=ALL_PAPERS),
        "read_table_limit": with_(PAPERS, select=ALL_PAPERS + " order by doc_id limit 100"),
        "sample_papers": with_(PAPERS, select="""select doc_id, title from papers
            where cast('0x' || substr(md5('1234:' || doc_id), 1, 8) as bigint)
                < cast(floor(0.1 * 4294967296) as bigint)"""),
        "project_columns": with_(
            PAPERS, select="select title, abstract, publish_time, authors, url from papers"
        ),
        "result_columns": with_(
            PAPERS, *summaries("select doc_id, abstract as text from papers where title is not null"),
            select="""select title, summary, publish_time from papers join summaries using (doc_id)
                where title is not null""",
        ),
        "after_date": with_(
            DATED, ISO_DATED, select="select * from iso_dated where publish_time >= '2022-06-15'"
        ),
        "after_date_with_nulls": with_(DATED, ISO_DATED, select="""select * from iso_dated
            where publish_time >= '2022-06-15' or publish_time is null"""),
        "since_cutoff": with_(DATED, ISO_DATED, select="""select * from iso_dated
            where publish_time >= '2022-01-01'"""),
        "drop_null_titles": with_(
            PAPERS, select="select doc_id, title from papers where title is not null"
        ),
        "fill_nulls": with_(PAPERS, select="""select doc_id, coalesce(authors, '') as authors,
            coalesce(abstract, '') as abstract from papers"""),
        "result_count": with_(
            PAPERS, select="select count(*) as results from papers where title is not null"
        ),
        "preview_rows": with_(PAPERS, select=ALL_PAPERS + " order by doc_id limit 5"),
        "clean_title": with_(PAPERS, CLEAN_TITLE, select="select doc_id, title from clean_title"),
        "clean_abstract": with_(*CLEANED, select="select doc_id, abstract from clean_abstract"),
        "dedup_abstract": with_(*CLEANED, DEDUP, select="select doc_id, abstract from dedup"),
        "tag_covid": with_(
            *CLEANED, select=f"select doc_id, {IS_COVID} as covid_related from clean_abstract"
        ),
        "tag_virus": with_(
            *CLEANED, select=f"select doc_id, {IS_VIRUS} as virus_related from clean_abstract"
        ),
        "tag_coronavirus": with_(
            *CLEANED, select=f"select doc_id, {IS_CORONA} as corona_related from clean_abstract"
        ),
        "tag_sars": with_(
            *CLEANED, select=f"select doc_id, {IS_SARS} as sars_related from clean_abstract"
        ),
        "format_date": with_(DATED, ISO_DATED, select="select * from iso_dated"),
        "prepared_papers": with_(*PREPARED, select="select * from prepared"),
        "prepared_defaults": with_(PAPERS, select=DEFAULTS),
        "prepare_without_ids": with_(
            NAMELESS, CLEAN_TITLE, CLEAN_ABSTRACT, DEDUP, *PREPARED[-1:],
            select="select * exclude (doc_id) from prepared",
        ),
        "unicode_spaces": f"""select doc_id, array_to_string({tokens('text')}, ' ') as tokens,
            cast(len(regexp_extract_all({plain_spaces('text')}, '\\S+')) as bigint) as words,
            cast(len({sentence_list('text')}) as bigint) as sentences,
            array_to_string({summary_sentence_list('text')}, '|') as parts
            from (select doc_id, {widened('text')} as text from documents)""",
        "clean_text": f"select doc_id, {clean_text('text')} as cleaned from documents",
        "tokenize_text": f"""select doc_id, cast(len(tokens) as bigint) as n_tokens,
            array_to_string(tokens, ' ') as tokens
            from (select doc_id, {tokens('text')} as tokens from documents)""",
        "shorten_text": with_(PAPERS, select=f"""select doc_id,
            {shorten('abstract', fixed.SHORTEN_LENGTH)} as default_length,
            {shorten('abstract', 300)} as abstract_length, {shorten('title', 20)} as title_length
            from papers"""),
        "doi_url": """select page_id, case when page_id % 4 in (0, 1) then '#'
            when page_id % 4 = 2 then 'http://doi.org/' || url
            else 'http://doi.org/' || url end as link from pages""",
        "num_sentences": f"""select doc_id, cast(len({sentence_list('text')}) as bigint)
            as sentences from documents""",
        "index_tokens": f"""select conv_id, turn, array_to_string({tokens('text')}, ' ') as tokens
            from conversations""",
        "bm25_postings": with_(*index, select="""select term, doc_id, tf,
            cast(dl as bigint) as dl from postings"""),
        "bm25_stats": with_(*index, select="""select n, round(avgdl, 6) as avgdl,
            round(mean_idf, 6) as mean_idf from stats"""),
        "bm25_idf": with_(*index, select="select term, df, round(idf, 6) as idf from terms"),
        "search_no_tokens": """select doc_id, cast(0 as double) as score from documents
            order by doc_id limit 10""",
        "bm25_scores": with_(
            *DOCUMENTS, *one_query(common, short), select=SCORED.format("scores")
        ),
        "search_topk": with_(
            *DOCUMENTS, *one_query(common, short), *top(10), select=SCORED.format("top")
        ),
        "search_flag_filter": with_(
            *PREPARED_CORPUS, *one_query(rare, full), *top(10, "covid_related"),
            select=SCORED.format("top"),
        ),
        "search_distinct_titles": with_(
            *DOCUMENTS, *one_query(common, short), *top(50),
            select="select doc_id, title, round(score, 6) as score from listed",
        ),
        "search": with_(
            *PREPARED_CORPUS, *one_query(rare, full), *top(10),
            select="""select doc_id, publish_time, title, abstract, covid_related, virus_related,
                corona_related, sars_related, url, round_even(score, 1) as score from listed""",
        ),
        "search_batch": with_(
            *PREPARED_CORPUS, *scores(BATCH, full), *top(10),
            select="""select qid, rank, doc_id, title, round_even(score, 1) as score
                from listed""",
        ),
        "summarize_docs": with_(
            *summaries("select doc_id, text from documents"), select="select * from summaries"
        ),
        "search_results": with_(
            *PREPARED_CORPUS, *one_query(rare, full), *top(10), *summaries(HIT_TEXTS),
            select="select " + RECORDS.format(keys=""),
        ),
        "search_batch_results": with_(
            *PREPARED_CORPUS, *scores(BATCH, full), *top(10), *summaries(HIT_TEXTS),
            select="select " + RECORDS.format(keys="qid, "),
        ),
    }
