"""SQL for DuckDB that gives the rows of the registered queries by other, plainer ways."""

from papyra.llm.licences import TEMPLATES

OP1 = r"""
with words as (
  select row_number() over () as r, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
), windows as (
  select r, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], chr(10)))) as w,
    unnest(range(1, len(ws) - 6)) as i
  from words where len(ws) > 7
), repeated as (
  select r, i from windows qualify count(*) over (partition by r, w) > 1
), covered as (
  select r, count(distinct i + k) as n from repeated, range(8) as t(k) group by r
), lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select r, unnest(string_split(text, chr(10))) as line from words)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
), counted as (
  select words.r, doc_id, stratum, cast(len(ws) as bigint) as n_words,
    cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words,
    coalesce(n_lines, 0) as n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as capitals,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) as stutter
  from words left join covered on covered.r = words.r left join lines on lines.r = words.r
), measured as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    case when n_words > 0 then n_symbols / n_words else 0 end as symbols_,
    case when n_words > 0 then stutter / n_words else 0 end as stutter_,
    case when word_chars > 0 then capitals / word_chars else 0 end as capitals_,
    case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_lines_,
    case when n_words > 0 then n_repeat_words / n_words else 0 end as repeats_
  from counted
), grid as (
  select rule, unnest(cuts) as cutoff, unnest(range(len(cuts))) as step from (values
    ('symbols', [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]::double[]),
    ('stutter', [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]::double[]),
    ('capitals', [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]::double[]),
    ('dup_lines', [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]::double[]),
    ('repeats', [0.3, 0.25, 0.2, 0.15, 0.1, 0.05]::double[])) as g(rule, cuts)
), long as (
  select r, doc_id, stratum, base_failed, rule,
    case rule when 'symbols' then symbols_ when 'stutter' then stutter_ when 'capitals' then capitals_
      when 'dup_lines' then dup_lines_ else repeats_ end as value
  from measured, (select distinct rule from grid)
), held as (
  select long.*, quality = 1 as good from long join labels using (doc_id)
  where not base_failed and quality in (0, 1)
), tried as (
  select stratum, rule, step, cutoff,
    count(*) filter (good) as n, count(*) filter (good and value > cutoff) as k,
    count(*) filter (not good) as m, count(*) filter (not good and value > cutoff) as b
  from held join grid using (rule) group by all
), tested as (
  select *, case when k >= n * 0.02 then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98)))) end as p,
    0.05 / (5 * (select count(distinct stratum) from held)) as level
  from tried
), passed as (
  select * from tested t where b > 0 and not exists (
    select 1 from tested u where u.stratum = t.stratum and u.rule = t.rule and u.step <= t.step and u.p > u.level)
), chosen as (
  select stratum, rule, cutoff from passed
  qualify row_number() over (partition by stratum, rule order by b / m - k / n desc, step) = 1
), failed as (
  select r, string_agg(rule, ',' order by case rule when 'symbols' then 1 when 'stutter' then 2
    when 'capitals' then 3 when 'dup_lines' then 4 else 5 end) as failed_rules
  from long join chosen using (stratum, rule) where value > cutoff group by r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and failed_rules is null as kept, coalesce(failed_rules, '') as failed_rules
from measured left join failed using (r)
"""

OP5 = r"""
with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
), items as (
  select cast(item_id as varchar) as item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark
), sized as (select item, ws, least(len(ws), 13) as size from items where len(ws) > 0
), bench as (
  select distinct item, size,
    unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as w
  from sized
), sizes as (select distinct size from bench
), windows as (
  select r, size, unnest(range(1, len(ws) - size + 2)) as i,
    unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as w
  from docs, sizes where len(ws) >= size
), hits as (select r, i, size, item from windows join bench using (size, w)
), hit_words as (
  select r, count(distinct j) as n_hit from (select distinct r, unnest(range(i, i + size)) as j from hits) group by r
), hit_items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct r, item from hits) group by r
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from docs left join hit_words using (r) left join hit_items using (r)
"""

_SPANS = r"""
  select r, '{kind}' as kind, {order} as k, unnest(list_transform(range(1, len(whole) + 1), lambda i:
      {{'start': list_sum(list_transform(gap[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0),
        'size': length(whole[i]), 'value': value[i]}}), recursive := true)
  from (select r, regexp_split_to_array(text, '{pattern}') as gap,
          regexp_extract_all(text, '{pattern}') as whole,
          regexp_extract_all(text, '{pattern}', {group}) as value
        from docs where regexp_matches(text, '{pattern}'))
"""

_ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)

_KNOWN = (
    "gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}"
    "|eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}"
)

OP9 = (
    """
with docs as (
  select row_number() over () as r, doc_id, coalesce(source, '') as source, coalesce(text, '') as text
  from documents
), spans as (
"""
    + " union all ".join(
        _SPANS.format(kind=kind, order=order, pattern=pattern, group=group)
        for order, (kind, pattern, group) in enumerate([
            ("assign", _ASSIGN, 2), ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]+", 0),
            ("known", _KNOWN, 0), ("mixed", "[A-Za-z0-9+/_-]{24,}", 0),
        ])
    )
    + """
), found as (
  select r, kind, k, cast(start as bigint) as start, cast(start + size as bigint) as stop, value from spans
  where length(value) >= case kind when 'assign' then 12 when 'access' then 18 when 'hex' then 16 else 24 end
    and (kind <> 'mixed' or regexp_matches(value, '[0-9]') and regexp_matches(value, '[a-z]')
      and regexp_matches(value, '[A-Z]'))
), sure as (
  select * from found a where k < 3 or k = 3 and not exists (
    select 1 from found b where b.r = a.r and b.k < 3 and a.start < b.stop and b.start < a.stop)
), candidates as (
  from sure union all select * from found a where k = 4 and not exists (
    select 1 from sure b where b.r = a.r and a.start < b.stop and b.start < a.stop)
), owners as (
  select value, count(distinct source) as n from candidates join docs using (r) group by value
), judged as (
  select c.*, n < 3 and regexp_matches(value, '[0-9]')
    and len(list_distinct(regexp_extract_all(value, '.'))) >= 6 as live
  from candidates c join owners using (value)
), listed as (
  select r, string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) as spans,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) filter (k < 3) as names,
    count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex, count(*) filter (live) as n_live
  from judged where live or k < 4 group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(names, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live
from docs left join listed using (r)
"""
)

def op2(templates: dict[str, str]) -> str:
    """Every window of every text against every template, by counting shared shingles."""
    rows = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in templates.items())
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"
    return f"""
with docs as (select row_number() over () as r, doc_id, {words} as ws from documents
), templates as (select licence, {words} as ws from (values {rows}) as t(licence, text)
), parts as (
  select distinct licence, cast(greatest(8, pow(2, ceil(log2(len(ws))))) as bigint) as scale,
    unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) as part
  from templates
), sizes as (select licence, scale, count(*) as n from parts group by all
), held as (
  select r, unnest(range(len(ws) - 4)) as pos,
    unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) as part
  from docs where len(ws) > 4
), hits as (
  select r, licence, scale, part, pos, unnest(range(cast(pos - pos % (scale // 2) as bigint), -1, -(scale // 2))) as first
  from held join parts using (part)
), found as (
  select r, licence, max(share) as share from (
    select r, licence, first, count(distinct part) * 100 // any_value(n) as share,
      count(distinct part) * 100 >= 75 * any_value(n) as enough
    from hits join sizes using (licence, scale)
    where pos + 5 <= first + scale * 3 // 2 group by r, licence, first
  ) where enough group by r, licence
), listed as (
  select r, count(*) as n_licences, string_agg(licence, ',' order by licence) as licences,
    cast(max(share) as bigint) as percent
  from found group by r
)
select doc_id, coalesce(n_licences, 0) as n_licences, coalesce(licences, '') as licences,
  coalesce(percent, 0) as percent
from docs left join listed using (r)
"""


OP11 = r"""
with words as (
  select 'd' as side, row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
  union all
  select 't', row_number() over (), null, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark
), crc_table as (
  select list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from (select unnest(range(256)) as i)
), terms as (
  select side, r, w, count(*) as n from (select side, r, unnest(ws) as w from words) group by all
), hexed as (
  select w, hex(w) as h, strlen(w) as size, t from (select distinct w from terms), crc_table
), bucketed as (
  select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(size), lambda i:
      instr('123456789ABCDEF', h[2 * i + 1]) * 16 + instr('123456789ABCDEF', h[2 * i + 2]))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 as bucket
  from hexed
), counts as (
  select bucket, sum(case when side = 'd' then n else 0 end) as s, sum(case when side = 't' then n else 0 end) as t
  from terms join bucketed using (w) group by bucket
), sums as (
  select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from counts
), gains as (
  select bucket, cast(floor(1000 * ln((t + 1)::double * (all_s + 10000)::double
    / ((s + 1)::double * (all_t + 10000)::double))) as bigint) as gain from counts, sums
), weights as (
  select r, sum(n * gain) as weight from terms join bucketed using (w) join gains using (bucket)
  where side = 'd' group by r
), scored as (
  select words.r, doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(weight, 0) as bigint) as weight,
    list_reduce(list_prepend(0, list_transform(range(1, 9), lambda i:
      instr('123456789abcdef', sha256('2024:' || coalesce(doc_id::varchar, ''))[i]))), lambda x, y: x * 16 + y) as h
  from words left join weights on weights.r = words.r where side = 'd'
), noisy as (
  select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score
  from scored
), placed as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last) as place,
    10 * count(case when n_words >= 20 then 1 end) over () // 100 as drawn
  from noisy
)
select doc_id, n_words as n_features, weight, score,
  cast(case when n_words >= 20 and place <= drawn then place end as bigint) as rank, n_words
from placed
"""

ORACLE = {
    "op1_quality_rules": OP1, "op2_license_scans": op2(TEMPLATES), "op5_benchmark_decontamination": OP5,
    "op9_secret_scans": OP9, "op11_importance_resampling": OP11,
}
