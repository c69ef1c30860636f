"""The named queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from shopwright.llm.licenses import COVERAGE, SLACK, TEMPLATES
from shopwright.llm.line_dedup import CHUNK, DEPTH, FIXED, LONG, MARKS, MIN_DOCS, MIN_TOKENS, RARE, SHARED
from shopwright.llm.quality import FLOORS, LEAST, SPREAD
from shopwright.llm.url_filter import DEFAULT, RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _licenses() -> str:
    values = ", ".join(
        f"({i}, '{t.label}', {t.base}, {len(t.text.split()) - 1}, string_split('{t.text}', ' '))"
        for i, t in enumerate(TEMPLATES)
    )
    return rf"""
with docs as (
  select row_number() over () as rid, doc_id,
         {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as words from documents),
templates(template, label, base, grams, words) as (values {values}),
places as (
  select rid, i - 1 as pos, words[i] as w, words[i + 1] as v
  from docs, unnest(range(1, len(words))) as r(i)),
known as (
  select template, label, base, grams, j - 1 as "at", words[j] as w, words[j + 1] as v
  from templates, unnest(range(1, len(words))) as r(j)),
diagonals as (
  select rid, template, any_value(label) as label, any_value(base) as base, any_value(grams) as grams,
         pos - "at" as diagonal, list("at") as ats
  from places join known using (w, v) group by rid, template, pos - "at"),
marked as (
  select *, case when diagonal - lag(diagonal) over o <= case when base then 0 else {SLACK} end then 0 else 1 end as far
  from diagonals window o as (partition by rid, template order by diagonal)),
islands as (
  select *, sum(far) over (partition by rid, template order by diagonal) as island from marked),
spans as (
  select rid, template, island, any_value(label) as label, any_value(base) as base,
         len(list_distinct(flatten(list(ats)))) / any_value(grams) as share,
         min(diagonal + list_min(ats)) as first
  from islands group by rid, template, island),
named as (
  select rid, max(share) as best,
         count(*) filter (base and share = 1) as n_base,
         min(first) filter (base and share = 1) as first_word,
         max(first) filter (base and share = 1) as last_word,
         string_agg(distinct label, ',' order by label) filter (base and share = 1) as base_labels,
         string_agg(distinct label, ',' order by label)
           filter (share >= case when base then 1 else {COVERAGE} end) as labels
  from spans group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
       first_word::bigint as first_word, last_word::bigint as last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(best, 0)::double as score
from docs left join named using (rid)"""


def _line_dedup() -> str:
    mask = "case when regexp_matches({0}, '[0-9]') then '<*>' else {0} end"
    tokens = _SPACED.format("line")
    leaf = ", ".join(mask.format(f"coalesce(tokens[{i + 1}], '')") for i in range(DEPTH))
    return rf"""
with docs as (
  select row_number() over () as rid, doc_id, text, string_split(text, chr(10)) as lines from documents),
lines as (
  select *, list_value(len(tokens)::varchar, {leaf}) as leaf
  from (select *, {tokens} as tokens from (
    select rid, text, i - 1 as pos, lines[i] as line from docs, unnest(range(1, len(lines) + 1)) as r(i)))
  where len(tokens) > 0),
-- Texts that differ, and the marks that each line finds in the others of its text.
texts as (select text, min(rid) as rid from docs where text is not null group by text),
wording_in as (select distinct rid, line, leaf, tokens from lines join texts using (rid)),
chunked as (
  select distinct rid, line, md5(part) as mark from (
    select rid, line, unnest(case when length(text) >= {LONG}
      then list_transform(string_split(regexp_replace(line, '{RARE}', '\1' || chr(10), 'g'), chr(10)),
                          lambda p: array_to_string(string_split(p, ' ')[1:3], ' '))
      else string_split(regexp_replace(line, '{CHUNK}', '\1' || chr(10), 'g'), chr(10)) end) as part
    from wording_in join texts using (rid))
  where contains(part, ' ')
  ),
best_chunks as (
  select * from chunked qualify row_number() over (partition by rid, line order by mark) <= {MARKS}),
first_chunks as (
  select * from best_chunks qualify row_number() over (partition by rid order by mark, md5(line)) <= {2 * MARKS}),
marks as (
  select distinct rid, line, mark from (
    select w.rid, w.line, c.mark from wording_in w join first_chunks c on c.rid = w.rid and c.line <> w.line
    qualify row_number() over (partition by w.rid, w.line order by c.mark, md5(c.line)) <= {MARKS})),
wordings as (
  select line, any_value(leaf) as leaf, any_value(tokens) as tokens, count(*) as n from wording_in group by line),
chosen as (
  select * from wordings where len(tokens) >= {MIN_TOKENS} and leaf in (
    select leaf from wordings where len(tokens) >= {MIN_TOKENS} group by leaf having sum(n) >= {MIN_DOCS})),
spread as (
  select line, leaf, n, len(tokens) as size, k as "at", tokens[k] as token
  from chosen, unnest(range(1, len(tokens) + 1)) as r(k) where not regexp_matches(tokens[k], '[0-9]')),
common as (select leaf, "at", token from spread group by leaf, "at", token having sum(n) >= {MIN_DOCS}),
shaped as (
  select line, any_value(n) as n, (leaf, list(("at", token) order by "at"))::varchar as template
  from spread join common using (leaf, "at", token) group by line, leaf, size having count(*) >= {FIXED} * size),
suspects as (
  select line, 'as written ' || line as template from wordings where n >= {MIN_DOCS}
  union all select line, template from shaped where template in (
    select template from shaped group by template having sum(n) >= {MIN_DOCS})),
met as (
  select distinct template, rid, coalesce(mark, '') as mark
  from suspects join wording_in using (line) left join marks using (rid, line)),
ranked as (
  select *, row_number() over (partition by template, rid order by sharing desc) as k, count(*) over (partition by template, rid) as n
  from (select *, count(*) over (partition by template, mark) as sharing from met)),
recurring as (
  select distinct line from suspects where template in (
    select template from ranked where k = least({SHARED}, n) group by template
    having sum((1000000000000::hugeint + sharing - 1) // sharing) >= 1000000000000::hugeint * {MIN_DOCS})),
dropped as (
  select rid, list(pos) as places from lines where line in (select line from recurring) group by rid)
select doc_id, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(places), 0)::bigint as n_dropped,
       case when places is null then text else array_to_string(
         list_filter(lines, lambda l, i: not list_contains(places, i - 1)), chr(10)) end as text
from docs left join dropped using (rid)"""


def _decontaminate() -> str:
    words = _WORDS.format(_LOWER.format("coalesce(text, '')"))
    return rf"""
with docs as (select row_number() over () as rid, doc_id, {words} as words from documents),
items as (select coalesce(item_id::varchar, 'null') as item, words, least(10, len(words)) as n
          from (select item_id, {words} as words from benchmark) where len(words) > 0),
windows as (
  select distinct item, n, array_to_string(words[i:i + n - 1], ' ') as win
  from items, unnest(range(1, len(words) - n + 2)) as r(i)),
sizes as (select distinct n from windows),
found as (
  select rid, i, n, item from (
    select rid, i, n, array_to_string(words[i:i + n - 1], ' ') as win
    from docs, sizes, unnest(range(1, len(words) - n + 2)) as r(i)) join windows using (n, win)),
hit as (select rid, count(distinct i + k) as n_hit from found, unnest(range(0, n)) as r(k) group by rid),
named as (select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from found group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (rid) left join named using (rid)"""


def _quality() -> str:
    quartiles = ", ".join(
        f"quantile_disc({r}, 0.25) as {r}_1, quantile_disc({r}, 0.75) as {r}_3" for r in FLOORS
    )
    columns = ", ".join(f"case when o.n >= {LEAST} then o.{r}_{q} when l.n >= {LEAST} then l.{r}_{q} else a.{r}_{q} end as {r}_{q}" for r in FLOORS for q in (1, 3))

    def high(r: str) -> str:
        return f"coalesce({r} > {r}_3 + {SPREAD} * greatest({r}_3 - {r}_1, {FLOORS[r]}), false)"

    r = "word_length"
    outside = " or ".join([*map(high, FLOORS), f"coalesce({r} < {r}_1 - {SPREAD} * greatest({r}_3 - {r}_1, {FLOORS[r]}), false)"])
    return rf"""
with docs as (
  select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text,
         {_SPACED.format("coalesce(text, '')")} as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select rid, i, (words[i], words[i + 1], words[i + 2]) as win from docs, unnest(range(1, len(words) - 1)) as r(i)),
repeated as (
  select rid, count(distinct i + k) as n_repeat_words
  from (select rid, i, count(*) over (partition by rid, win) as times from windows), unnest(range(0, 3)) as r(k)
  where times > 1 group by rid),
counts as (
  select rid, doc_id, lang, source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines) as n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from docs left join repeated using (rid)),
measured as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         case when word_chars > 0 then n_symbols / word_chars else 0 end as symbol_share,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_share,
         case when n_words > 0 then n_repeat_words / n_words else 0 end as repeat_share,
         case when n_words > 0 then word_chars / n_words else 0 end as word_length
  from counts),
own as (select lang, source, count(*) as n, {quartiles} from measured where not base_failed group by lang, source),
by_lang as (select lang, count(*) as n, {quartiles} from measured where not base_failed group by lang),
overall as (select count(*) as n, {quartiles} from measured where not base_failed),
bounds as (
  select o.lang, o.source, {columns}
  from own o join by_lang l on o.lang is not distinct from l.lang cross join overall a)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not ({outside}) as kept
from measured m left join bounds b on m.lang is not distinct from b.lang and m.source is not distinct from b.source"""


def _url_filter() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
with parts as (
  select row_number() over () as rid, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages)),
rules(rule_verdict, rule_host, rule_path) as (values {rules}),
best as (
  select rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) as verdict
  from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by rid)
select page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') as verdict from parts left join best using (rid)"""


_CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
numbered as (
  select *, row_number() over o as n, coalesce(lag(role) over o <> role, true) as opens
  from turns window o as (partition by conv_id order by turn nulls first, role, text)),
sized as (
  select *, length(replace(text, '<|', '<||'))
    + case when opens then 24 + length(replace(replace(role, '<|', '<||'), chr(10), '<|nl|>')) else 10 end as size
  from numbered)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
       sum(size)::bigint as formatted_chars
from sized group by conv_id"""

_HARD_NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
anchors as (
  select row_number() over () as anchor, * from (select distinct vec_id, label, v from rows where vec_id % 100 = 0)),
scored as (
  select anchor, a.vec_id as anchor_id, a.label = r.label as same, r.vec_id,
         list_dot_product(a.v, r.v)::bigint as score
  from anchors a join rows r on len(a.v) = len(r.v) and (a.label <> r.label or a.vec_id <> r.vec_id)),
positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor order by score desc, vec_id) <= 5),
below as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score,
         n.score as negative_score,
         row_number() over (partition by p.anchor, p.vec_id order by n.score desc, n.vec_id) as rank
  from positives p join scored n on n.anchor = p.anchor and not n.same
    and 100 * n.score between 30 * p.score and 90 * p.score)
select anchor_id::bigint as anchor_id, positive_id::bigint as positive_id, rank::int as rank,
       negative_id::bigint as negative_id, positive_score, negative_score
from below where rank <= 10"""

_COLLOCATIONS = rf"""
with pieces as (
  select row_number() over () as piece, lang, regexp_extract_all(part, '[^\x20\x09]+') as words
  from (select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as part
        from documents)),
totals as (select lang, sum(len(words))::hugeint as n from pieces group by lang),
counts as (
  select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase, count(*) as f
  from pieces, unnest(range(1, len(words) + 1)) as s(i), unnest(range(1, 6)) as t(k)
  where i + k - 1 <= len(words) group by all having count(*) >= 100),
split as (select *, string_split(phrase, ' ') as w from counts where k > 1),
cuts as (
  select c.lang, c.phrase, c.f as a, j, x.f as l, y.f as r, n,
         (1000 * c.f::hugeint * n // (x.f::hugeint * y.f::hugeint))::bigint as score
  from (select *, unnest(range(1, k)) as j from split) c
  join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:j], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(w[j + 1:], ' ')
  join totals t on t.lang = c.lang),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (
  select distinct lang, array_to_string(w[i:i + m - 1], ' ') as phrase, f
  from split, unnest(range(1, k)) as s(i), unnest(range(2, k)) as t(m) where i + m - 1 <= k)
select lang, rank, phrase, a, l, r, n::bigint as n, score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from lowest o where not exists (
    select 1 from inside i where i.lang = o.lang and i.phrase = o.phrase and 100 * i.f >= 100 * o.a))
where rank <= 2000"""

ORACLE: dict[str, str] = {
    "op2_licenses": _licenses(),
    "op3_line_dedup": _line_dedup(),
    "op4_decontaminate": _decontaminate(),
    "op6_quality": _quality(),
    "op7_url_filter": _url_filter(),
    "op9_chat": _CHAT,
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_collocations": _COLLOCATIONS,
}
