"""Plain SQL for those registered queries that it can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

_SPACE = r"'[\x20\x09-\x0D]+'"

# All pairs that share a run of three words are counted, and links are followed step by step.
SQL["op4_universe_partition_join"] = f"""with recursive
    w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_SPACE}), lambda x: x <> '') ws from documents),
    g as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
          else list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) end gs from w),
    n as (select doc_id, len(gs)::bigint n from g),
    e as (select doc_id, unnest(gs) s from g),
    p as (select a.doc_id a, b.doc_id b, count(*) c from e a join e b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
    both_ways as (select a, b from l union all select b, a from l),
    r(doc_id, found) as (select doc_id, doc_id from n union select both_ways.b, r.found from r join both_ways on both_ways.a = r.doc_id)
    select doc_id, any_value(n.n) n_shingles, min(found) component_id from r join n using (doc_id) group by doc_id"""

# The base counts, then the same tests of cutoffs as sums of binomial probabilities.
_RULES = {"symbols": ("n_symbols", "n_words"), "repeated_words": ("n_repeat_words", "n_words"), "repeated_lines": ("n_dup_lines", "n_lines"), "capitals": ("n_capitals", "n_letters")}


def _level(over: str, under: str) -> str:
    return f"case when {under} > 0 then greatest(0, least(40, ceil({over} * 40 / {under})::int - 1)) else 0 end"


SQL["op7_risk_controlled_rules"] = f"""with
    d as (select row_number() over () as row, doc_id, coalesce(text, '') txt from documents),
    w as (select row, list_filter(string_split_regex(txt, {_SPACE}), lambda x: x <> '') ws from d),
    runs as (select row, unnest(list_transform(range(1, len(ws) - 1), lambda i: {{'i': i, 's': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]}})) x from w where len(ws) > 2),
    named as (select row, x.i i, count(*) over (partition by row, x.s) c from runs),
    repeats as (select row, count(distinct i + k) n_repeat_words from named, (values (0), (1), (2)) t(k) where c > 1 group by row),
    lines as (select row, unnest(string_split(txt, chr(10))) line from d),
    dups as (select row, sum(case when regexp_matches(line, '[^\\x20\\x09-\\x0D]') then c - 1 else 0 end)::bigint n_dup_lines, sum(c)::bigint n_lines
             from (select row, line, count(*) c from lines group by 1, 2) group by row),
    counted as (select row, doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars, length(regexp_replace(txt, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
                n_dup_lines, coalesce(n_repeat_words, 0)::bigint n_repeat_words, n_lines, length(regexp_replace(txt, '[^A-Za-z]', '', 'g'))::bigint n_letters,
                length(regexp_replace(txt, '[^A-Z]', '', 'g'))::bigint n_capitals
                from d join w using (row) join dups using (row) left join repeats using (row)),
    judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, case when n_words <= 200 then 0 when n_words <= 1000 then 1 else 2 end stratum from counted),
    levels as ({" union all ".join(f"select row, doc_id, stratum, base_failed, '{r}' rule, {_level(o, u)} lev from judged" for r, (o, u) in _RULES.items())}),
    truth as (select doc_id, min(quality) q from labels where quality is not null group by doc_id),
    ids as (select doc_id, min(stratum) stratum from judged where not base_failed and doc_id is not null group by doc_id),
    most as (select doc_id, rule, max(lev) lev from levels where not base_failed group by 1, 2),
    seen as (select stratum, rule, lev, count(*) filter (q = 1) good, count(*) filter (q <> 1) bad from most join ids using (doc_id) join truth using (doc_id) group by 1, 2, 3),
    cuts as (select s.stratum, s.rule, c.cut::int cut, sum(good) n, coalesce(sum(good) filter (lev >= cut), 0) k, coalesce(sum(bad) filter (lev >= cut), 0) hits
             from seen s, range(1, 41) c(cut) group by all),
    tails as (select c.stratum, c.rule, c.cut, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.0025) + (n - i) * ln(0.9975))) p
              from cuts c, range(0, 2000) t(i) where i <= k and k < 0.0025 * n group by all),
    passed as (select c.*, bool_and(n > 0 and k < 0.0025 * n and coalesce(p, 1) <= 0.05 / 12) over (partition by c.stratum, c.rule order by c.cut desc) ok
               from cuts c left join tails t on t.stratum = c.stratum and t.rule = c.rule and t.cut = c.cut),
    chosen as (select stratum, rule, cut from passed where ok and hits - 10 * k > 0 qualify row_number() over (partition by stratum, rule order by hits - 10 * k desc, cut desc) = 1),
    broken as (select row, list(l.rule order by l.rule) rules from levels l join chosen c on c.stratum = l.stratum and c.rule = l.rule and l.lev >= c.cut group by row)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and rules is null kept,
           coalesce(array_to_string(rules, ','), '') broken_rules from judged left join broken using (row)"""

# Terms of whole texts, all sources of a language against all kept terms.
SQL["op12_chunk_divergence"] = r"""with
    d as (select row_number() over () as row, coalesce(lang, '') lang, coalesce(source, '') source,
          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') ts from documents),
    e as (select row, lang, source, unnest(ts) term from d),
    c as (select lang, source, term, count(*) n, count(distinct row) docs from e group by all),
    k as (select lang, term, sum(n) n from c group by all having sum(docs) >= 30),
    l as (select lang, count(*) v, sum(n) total from k group by lang),
    g as (select distinct lang, source from d),
    gn as (select g.lang, g.source, coalesce(l.v, 0) v, coalesce(l.total, 0) lang_total, coalesce(sum(c.n) filter (k.term is not null), 0) total
           from g left join l using (lang) left join c using (lang, source) left join k using (lang, term) group by all),
    p as (select gn.lang, gn.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (gn.total + 5 * gn.v) p,
          1 + (1000000000::hugeint * (k.n + 5)) // (gn.lang_total + 5 * gn.v) q
          from gn join k using (lang) left join c using (lang, source, term)),
    pairs as (select a.lang, a.source, b.source item, sum(abs(a.p - b.p)) value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    allpairs as (select a.lang, a.source, 'pair' part, b.source item, coalesce(value, 0) value
                 from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
    terms as (select lang, source, 'term' part, term item, p - q value from p where n > 0 and p > q),
    u as (select * from allpairs union all select * from terms),
    r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from u)
    select lang, source, part, item, value::bigint value, rank::int rank from r where part = 'pair' or rank <= 50"""

# All runs of one to four words, counted as text.
SQL["op13_filter_collocations"] = r"""with
    d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') txt from documents),
    p as (select lang, unnest(string_split_regex(txt, '[.,;:!?\x0A-\x0D]')) piece from d),
    w as (select row_number() over () as piece, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') ws from p),
    t as (select piece, lang, unnest(ws) word, generate_subscripts(ws, 1) i from w),
    n as (select lang, count(*) n from t group by lang),
    x as (select lang, word a, lead(word, 1) over v b, lead(word, 2) over v c, lead(word, 3) over v d from t window v as (partition by piece order by i)),
    g as (select lang, 1 k, a phrase from x union all select lang, 2, a || ' ' || b from x where b is not null
          union all select lang, 3, a || ' ' || b || ' ' || c from x where c is not null union all select lang, 4, a || ' ' || b || ' ' || c || ' ' || d from x where d is not null),
    f as (select lang, k, phrase, string_split(phrase, ' ') ws, count(*) f from g group by lang, k, phrase having count(*) >= 30),
    c as (select lang, k, phrase, ws, f a from f where k > 1),
    cuts as (select c.lang, c.k, c.phrase, c.a, x.x cut, l.f l, r.f r, ((2000000::hugeint * a) // (l.f + r.f))::bigint score
             from c join (values (1), (2), (3)) x(x) on x.x < c.k join f l on l.lang = c.lang and l.phrase = array_to_string(c.ws[1:x.x], ' ')
             join f r on r.lang = c.lang and r.phrase = array_to_string(c.ws[x.x + 1:], ' ')),
    weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
    inner_ as (select lang, a longer, unnest(list_transform(range(1, k - m.m + 2), lambda i: array_to_string(ws[i:i + m.m - 1], ' '))) phrase from c join (values (2), (3)) m(m) on m.m < c.k),
    covered as (select lang, phrase, max(longer) longer from inner_ group by all),
    kept as (select weakest.* from weakest left join covered using (lang, phrase) where longer is null or 100 * longer < 80 * a),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select lang, rank::bigint rank, phrase, a::bigint a, l::bigint l, r::bigint r, n, score from ranked join n using (lang) where rank <= 2000"""

# Each conversation joined in the order of its turns; the marks' lengths follow from the template.
_ADDED = r"regexp_replace(text, '([<\[])(\\*)(/?(?:s>|SYS\]|INST\]|ROLE\]))', '\1\\\2\3', 'g')"
SQL["op11_reply_trees"] = f"""with
    c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    f as (select *, length({_ADDED}) + case role when 'user' then 15 when 'system' then 13 when 'assistant' then 4 else 16 + length(role) end chars from c),
    o as (select conv_id, count(*)::bigint n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) turns,
          coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') loss, (3 + sum(chars))::bigint formatted_chars from f group by conv_id)
    select conv_id, n_turns, sha256(turns) turns_sha256, length(loss)::bigint loss_chars, sha256(loss) loss_sha256, formatted_chars from o"""
