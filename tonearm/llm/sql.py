"""SQL giving the rows of the queries that SQL can express."""

HOST_RULES = r"""
with texts as (
    select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents
), words as (
    select r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
    from texts
), windows as (
    select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
    from (select r, ws, unnest(range(1, len(ws) - 1)) as i from words)
), again as (
    select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n >= 2
), covered as (
    select r, count(distinct i + k) as n_repeat_words
    from again cross join (values (0), (1), (2)) as v(k) group by r
), counts as (
    select doc_id, source, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from words left join covered using (r)
), judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        [n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 10 * n_words, n_dup_lines > 2,
            word_chars < 3 * n_words or word_chars > 10 * n_words] as failed
    from counts
), limits(rule, most) as (values (1, 0.75::double), (2, 0.75), (3, 0.5), (4, 0.5), (5, 0.5)
), rates as (
    select source, rule, count(*)::double as n, sum(failed[rule]::int)::double as f
    from judged cross join limits where source is not null group by 1, 2
), sums as (
    select rule, count(*) as h, sum(n) as n, sum(f) / sum(n) as m, sum(n * n) as squares, sum(f * f / n) as weighted
    from rates group by 1
), spread as (
    select rule, m, m * (1 - m) as c, case when n - squares / n - (h - 1) > 0
        then (weighted - n * m * m - (h - 1) * m * (1 - m)) / (n - squares / n - (h - 1)) else 0 end as b from sums
), prior as (
    select rule, m, case when b > 0 then least(greatest(c / b - 1, 1.0), 1e6) else 1e6 end as s from spread
), rejected as (
    select source from rates join prior using (rule) join limits using (rule) where (f + m * s) / (n + s) > most
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and source is not null and source not in (select source from rejected)
    or not base_failed and source is null as kept
from judged
"""


def mixing(weights: dict[str, float], power: float, sweeps: int) -> str:
    """Raking written out: one step a margin and sweep."""
    given = ", ".join(f"('{k}', {float(v)!r}::double)" for k, v in weights.items())
    steps, last = [], "start"
    for sweep in range(sweeps):
        for margin in ("source", "lang", "topic"):
            name = f"{margin}_{sweep}"
            mass = f"sum(tokens * factor) over (partition by {margin})"
            steps.append(
                f"""{name} as (
    select source, lang, topic, tokens, factor * case when {mass} > 0 and share is not null
        then share * (select sum(tokens) from cells) / {mass} else 1.0 end as factor
    from (select c.*, share from {last} c left join target_{margin} t on t.category = c.{margin})
)"""
            )
            last = name
    smooth = "".join(
        f"""target_{m} as (
    select {m} as category, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) over () as share
    from cells group by 1 having sum(tokens) > 0
), """
        for m in ("source", "topic")
    )
    return f"""
with rows as (
    select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang, coalesce(text, '') as t,
        case when contains(t, 'icense') then 'licence' when contains(t, ' | ') then 'table'
            when contains(t, '@') then 'contact' when length(t) < 600 then 'brief' else 'prose' end as topic
    from documents
), cells as materialized (
    select source, lang, topic, sum(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')))::double as tokens
    from rows group by all
), given(category, weight) as (values {given}), {smooth}languages as (
    select lang as category, sum(tokens) as tokens, any_value(weight) as weight
    from cells left join given on category = lang group by 1 having sum(tokens) > 0
), target_lang as (
    select category, case when weight is null then tokens / (select sum(tokens) from languages)
        else weight / (select sum(weight) from languages) * (1 - coalesce((select sum(tokens) from languages where weight is null), 0)
            / (select sum(tokens) from languages)) end as share
    from languages
), start as (select *, 1.0::double as factor from cells), {", ".join(steps)}
select doc_id, r.source, r.lang, r.topic, least(1.0, round(factor, 9)) as probability,
    ('0x' || substr(md5('mix-' || coalesce(doc_id::varchar, '')), 1, 12))::bigint / 281474976710656.0
        < least(1.0, round(factor, 9)) as taken,
    floor(round(factor, 9))::bigint + (('0x' || substr(md5('mix-' || coalesce(doc_id::varchar, '')), 1, 12))::bigint / 281474976710656.0
        < round(factor, 9) - floor(round(factor, 9)))::bigint as copies
from rows r join {last} f using (source, lang, topic)
"""


def reached(nodes: str, key: str) -> str:
    """The smallest node that ``links`` (a, b, both ways) reach from each row of ``nodes``."""
    return f"""reach(a, b) as (
    select {key}, {key} from {nodes} union select r.a, l.b from reach r join links l on l.a = r.b
), component as (select a as {key}, min(b) as component_id from reach group by 1)"""


NEAR_VECTORS = f"""
with recursive vectors as (
    select vec_id, label, embedding::double[] as e,
        label is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0 as usable
    from embeddings
), sized as (select vec_id, label, e, sqrt(list_dot_product(e, e)) as size from vectors where usable
), links as (
    select x.vec_id as a, y.vec_id as b from sized x join sized y
    on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e)
        and list_dot_product(x.e, y.e) / (x.size * y.size) >= 0.98
), {reached("vectors", "vec_id")}, degree as (select a as vec_id, count(*) as n_links from links group by 1)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from vectors join component using (vec_id) left join degree using (vec_id)
"""

NEAR_TEXTS = rf"""
with recursive texts as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
    from documents
), shingles as (
    select distinct doc_id, unnest(case when len(ws) >= 3
        then list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        when len(ws) > 0 then [array_to_string(ws, ' ')] end) as s
    from texts
), sizes as (select doc_id, count(*) as n from shingles group by 1
), shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as n from shingles x join shingles y
    on x.s = y.s and x.doc_id < y.doc_id group by all
), near as (
    select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), links as (select a, b from near union all select b, a from near
), {reached("texts", "doc_id")}
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from texts join component using (doc_id) left join sizes using (doc_id)
"""

# CRC-32 bit by bit, over the decimal digits of doc_id.
_STEP = "case when {x} % 2 = 1 then xor({x} // 2, 3988292384) else {x} // 2 end"
_BYTE = "list_reduce([xor(acc, d)] || [0::bigint for _ in range(8)], lambda c, _: " + _STEP.format(x="c") + ")"
CRC_OF_ID = f"xor(4294967295, list_reduce([4294967295::bigint] || [ascii(c)::bigint for c in string_split(doc_id::varchar, '')], lambda acc, d: {_BYTE}))"

PERIODIC_RUNS = rf"""
with texts as (
    select doc_id, {CRC_OF_ID} as h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), planted as (
    select doc_id, ws, h, len(ws) as n, case when len(ws) > 0 then (h // 10) % len(ws) end as a from texts
), words as (
    select doc_id, n, case when h % 10 = 0 and n > 0
        then ws[:a] || [ws[1 + a + i % (1 + (n - a) // (3 + h // 10 % 8))] for i in range(n - a)] else ws end as ws
    from planted
), placed as (
    select doc_id, n, unnest(ws) as w, unnest(range(n)) as i from words
), pairs as (
    select x.doc_id, y.i - x.i as q, x.i from placed x join placed y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i
    where 2 * (y.i - x.i) <= x.n
), islands as (
    select doc_id, q, min(i) as s, count(*) + q as len
    from (select *, i - row_number() over (partition by doc_id, q order by i) as g from pairs)
    group by doc_id, q, g having count(*) >= greatest(12 - q, q)
), runs as (
    select doc_id, s, len, min(q) as q from islands group by doc_id, s, len
), lists as (
    select doc_id, count(*) as n_runs, max({{'len': len, 's': -s, 'q': -q}}) as top,
        string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as lines
    from runs group by doc_id
), dropped as (
    select distinct doc_id, unnest(range(s + q, s + len)) as i from runs
), collapsed as (
    select doc_id, string_agg(w, ' ' order by i) as t from placed anti join dropped using (doc_id, i) group by doc_id
)
select doc_id, coalesce(n_runs, 0) as n_runs, -top.s as start, top.len as length, -top.q as period,
    1000 * top.len // -top.q as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
    sha256(coalesce(t, '')) as collapsed_sha256
from documents left join lists using (doc_id) left join collapsed using (doc_id)
"""

RANKED_SEARCH = r"""
with words as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), held as (select doc_id, term, count(*) as tf from words group by all
), sizes as (select doc_id, count(*) as n from words group by 1
), totals as (select count(*) as nn, sum(n)::bigint as l from sizes
), weights as (
    select term, floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)))::bigint as w
    from (select term, count(*) as df from held group by 1), totals
), asked as (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), parts as (
    select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // l))) as part
    from held join sizes using (doc_id) join weights using (term), totals
), scores as (
    select item_id, doc_id, sum(part)::bigint as score from asked join parts using (term) group by all having sum(part) > 0
), placed as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores
)
select item_id, rank::int as rank, doc_id, score from placed where rank <= 10
"""

# Bytes are written as two hexadecimal digits, so a string of 400 bytes has 800.
REPEATED_BYTES = r"""
with texts as (
    select doc_id, hex(encode(coalesce(text, ''))) as t from documents
), stretches as (
    select doc_id, k, substr(t, 2 * k + 1, 928) as t
    from (select doc_id, t, unnest(range(0, len(t) // 2 - 399, 64)) as k from texts)
), strings as (
    select doc_id, k + j as i, hash(substr(t, 2 * j + 1, 800)) as s
    from (select doc_id, k, t, unnest(range(least(64, len(t) // 2 - 399))) as j from stretches)
), again as (
    select doc_id, i from strings semi join (select s from strings group by s having count(*) > 1) using (s)
), bounds as (
    select doc_id, i, i > lag(i + 400, 1, -1) over (partition by doc_id order by i) as new from again
), spans as (
    select doc_id, min(i) as a, max(i) + 400 as b
    from (select *, count(*) filter (new) over (partition by doc_id order by i) as k from bounds) group by doc_id, k
), gaps as (
    select doc_id, lag(b, 1, 0) over (partition by doc_id order by a) as a, a as b from spans
    union all select doc_id, max(b), null from spans group by doc_id
), kept as (
    select doc_id, string_agg(case when gaps.b is null then substr(t, 2 * gaps.a + 1) else substr(t, 2 * gaps.a + 1, 2 * (gaps.b - gaps.a)) end, '' order by gaps.a, gaps.b nulls last) as t
    from gaps join texts using (doc_id) group by doc_id
), sums as (select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans from spans group by 1)
select doc_id, (len(texts.t) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
    coalesce(n_spans, 0)::bigint as n_spans, sha256(from_hex(coalesce(kept.t, texts.t))) as kept_sha256
from texts left join sums using (doc_id) left join kept using (doc_id)
"""
