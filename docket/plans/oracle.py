"""The driver's queries in DuckDB's SQL, on the same tables."""

from __future__ import annotations

from docket.functions.unicode import decompositions

_NORM = r"trim(regexp_replace(text, '[\t\n\x0B\f\r ]+', ' ', 'g'))"
_DAY = "strftime({}, '%Y-%m-%d')"
_ORDER_DAY = _DAY.format("o_orderdate")

_GATED = """select o_orderkey, count(l_orderkey) n_checks, coalesce(bool_and(l_discount < 0.08), false) passed
from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey"""

_MARKERS = """select page_id, case when page_id % 5 = 0 then 'git-pending:data/' || page_id when page_id % 7 = 0 then url
else 'git-pending:' || case page_id % 3 when 0 then 'owner/main' when 1 then 'owner/cold' else 'owner/unknown' end || ':' || regexp_replace(url, '^https?://', '') end marker from pages"""

_PARSED = f"""select page_id, marker, starts_with(marker, 'git-pending:') pending, substr(marker, 13) rest,
instr(substr(marker, 13), ':') cut from ({_MARKERS})"""

_TOKENS = r"""select page_id, list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), '[^\p{L}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '),
lambda x: x <> '' and x not in ('motion','gällande','om','till','av','i','på','för','och','med','flera','svar','en','ett','att'))) tokens from pages"""

_SIMILAR = f"""select a.page_id, b.page_id "case", len(list_intersect(a.tokens, b.tokens)) / len(list_distinct(list_concat(a.tokens, b.tokens))) score
from ({_TOKENS}) a join ({_TOKENS}) b on b.page_id < a.page_id where len(a.tokens) > 0 and len(b.tokens) > 0"""

_BEST = f"""select page_id, "case", score from ({_SIMILAR}) where score >= 0.6 qualify row_number() over (partition by page_id order by score desc, "case") = 1"""

_CASES = """select o_orderkey, 'a-' || o_orderkey id, o_orderpriority title, o_orderstatus status from orders {orders}"""

_CASE_JSON = """select o_orderkey pos, '{{"id":"a-' || o_orderkey || '","status":"' || o_orderstatus || '","steps":[' || coalesce(steps, '') || '],"title":"' || o_orderpriority || '"}}' j
from orders left join (select l_orderkey, string_agg('{{"instance":"' || lower(l_returnflag) || '","l_linenumber":' || l_linenumber || ',"quote":"part ' || l_partkey || '","step_id":"s-' || l_linenumber || '"}}', ',' order by l_linenumber, lower(l_returnflag), 'part ' || l_partkey) steps
from lineitem group by 1) on l_orderkey = o_orderkey""".replace("{{", "{").replace("}}", "}")

_DATABASE = f"select sha256('[' || string_agg(j, ',' order by pos) || ']') h from ({_CASE_JSON})"

_BEFORE = "where {} <= timestamp '1996-06-30'"

_DECOMPOSED = chr(30).join(f"{c}{chr(31)}{d}" for c, d in decompositions().items() if "'" not in d)
_TITLE = r"trim(regexp_replace(regexp_replace({}, '[^\p{{L}}\p{{N}}\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_BARE = r"regexp_replace(t, '\p{Mn}+', '', 'g')"

_DIFF = f"""with p as (select 'a-' || o_orderkey id from orders {_BEFORE.format('o_orderdate')}),
w as (select 'a-' || o_orderkey id, p.id is null is_new from orders left join p on p.id = 'a-' || o_orderkey),
s as (select 'a-' || l_orderkey id, string_agg('s-' || l_linenumber, ',' order by l_linenumber) steps from lineitem l
where not exists (select 1 from lineitem m where m.l_orderkey = l.l_orderkey and m.l_linenumber = l.l_linenumber and m.l_shipdate <= timestamp '1996-06-30') group by 1)
select w.id, is_new, case when is_new then '' else steps end new_step_ids from w left join s on s.id = w.id where is_new or steps is not null"""

_STEPS = "select *, 's-' || l_linenumber step_id, row_number() over (partition by l_orderkey order by l_linenumber, 'part ' || l_partkey, 'u' || l_suppkey) - 1 step_pos from lineitem"

ORACLE = {
    "verbatim_checks": rf"""
with d as (select doc_id, coalesce(text, '') text, {_NORM.replace('text', "coalesce(text, '')")} n from documents),
o as (select doc_id, n, text, unnest(range(0, greatest(length(text) - 1, 0) // 120 + 1)) k from d),
r as (select doc_id, n, 'own ' || k field, substr(text, k * 120 + 1, 120) piece, (doc_id + k) % 6 kind, substr(text, k * 120 + 1, 480) long from o),
a as (select doc_id, n, field, case when kind < 2 then substr(piece, 1, 60) || case kind when 0 then ' not ' else '¤' end || substr(piece, 61, 60)
    when kind = 2 then long when kind = 3 then ' ' || chr(9) || ' ' else piece end text from r),
q as (select doc_id, n, field, {_NORM} m from a),
c as (select doc_id, field, case when m = '' then 'empty' when len(string_split(m, ' ')) > 40 then 'too long' when contains(n, m) then 'verified' else 'not found' end reason from q),
p as (select 'passage ' || item_id field, {_NORM} m from benchmark)
select doc_id, field, reason = 'verified' passed, reason from c
union all select doc_id, field, true, 'verified' from d join p on m <> '' and contains(n, m)""".replace("\\u00a4", "¤"),
    "whitespace_norm": f"select doc_id, length({_NORM}) n_chars, len(string_split({_NORM}, ' ')) n_words, md5({_NORM}) digest from documents",
    "word_limit_by_type": f"""select conv_id, turn, case role when 'assistant' then 60 else 40 end::bigint word_limit,
len(string_split({_NORM}, ' ')) > case role when 'assistant' then 60 else 40 end too_long from conversations""",
    "gate_all_of": _GATED,
    "gate_partition": f"select case when passed then 'ready' else 'needs_review' end list, count(*) n, sum(n_checks)::bigint n_checks from ({_GATED}) group by 1",
    "link_extract_first": """select page_id, link, min(pos)::bigint pos from (select page_id, unnest(l) link, generate_subscripts(l, 1) - 1 pos
from (select page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) l from pages)) group by page_id, link""",
    "link_absolutize": """select page_id, case when starts_with(link, 'http') then link else 'https://portal.example' || link end link, min(pos)::bigint pos
from (select page_id, unnest(l) link, generate_subscripts(l, 1) - 1 pos from (select page_id, list_append(regexp_extract_all(html, 'href="([^"]*)"', 1), url) l from pages)) group by 1, 2""",
    "meeting_links": f"""select distinct o_custkey, {_ORDER_DAY} date, 'https://portal.example/committees/council/mote-' || {_ORDER_DAY} meeting_url
from orders where o_orderkey % 3 > 0 and o_orderkey % 5 > 0""",
    "first_match_or_null": """select page_id, case when page_id % 3 > 0 then 'https://portal.example/committees/council/mote-2024-01-31/protocol/p-' || page_id || 'pdf-17' || case when page_id % 5 < 4 then '?downloadMode=open' else '' end end link from pages""",
    "filename_sanitize": r"""select page_id, substr(regexp_replace(regexp_replace(regexp_extract(url, '[^/]*$') || 'pdf' || case when page_id % 2 = 0 then '-' || page_id else '' end, 'pdf(-\d+)?$', '\1'), '[?#](.|\n)*$', ''), 1, 150) filename from pages""",
    "attachment_links": """select distinct l_orderkey, 'https://portal.example/welcome-sv/namnder-styrelser/council/agenda/doc-' || (l_partkey % 7) || 'pdf' || case when l_partkey % 2 = 0 then '-12' else '' end || case when l_linenumber % 2 = 0 then '?downloadMode=open' else '' end url,
'doc-' || (l_partkey % 7) || case when l_partkey % 2 = 0 then '-12' else '' end || '.pdf' filename from lineitem""",
    "unseen_anti": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "seen_upsert": f"select user_id, string_agg(day, ',' order by day) dates from (select distinct user_id, {_DAY.format('ts')} as day from events) group by user_id",
    "stream_batches": f"select user_id, string_agg(day, ',' order by day) dates from (select distinct user_id, {_DAY.format('ts')} as day from events) group by user_id",
    "backfill_batch": f"select o_orderkey, {_ORDER_DAY} date from orders where {_ORDER_DAY} between '1995-01-01' and '1997-12-31' and o_orderstatus <> 'F' order by date, o_orderkey limit 10",
    "newest_batch": f"select o_orderkey, {_ORDER_DAY} date from orders order by date desc, o_orderkey limit 15",
    "run_diagnostics": """select c_custkey, count(o_orderkey) found, max(case when o_orderstatus = 'P' then 'failed: ' || o_orderpriority end) error
from customer left join orders on o_custkey = c_custkey group by c_custkey""",
    "run_funnel": f"""select count(*) total, count(*) filter (r) in_range, count(*) filter (r and o_orderstatus = 'F') already_seen, count(*) filter (r and o_orderstatus <> 'F') remaining
from (select *, {_ORDER_DAY} between '1995-01-01' and '1997-12-31' r from orders)""",
    "json_validate": """select event_id, json_valid(raw) as valid, case when json_valid(raw) then (raw::json ->> '$.k')::bigint end k
from (select event_id, case when event_id % 10 = 0 then props || '}' else props end raw from events)""",
    "case_validation": """select o_orderkey, case when o_orderkey % 6 in (0, 5) then 1 else 0 end::bigint n_cases, case o_orderkey % 6 when 0 then 0 when 4 then 4 when 5 then 3 else 1 end::bigint n_errors,
case o_orderkey % 6 when 0 then 'ekonomi' when 5 then 'övrigt' end category, case o_orderkey % 6 when 0 then 'avgjort' when 5 then 'pågående' end status from orders""",
    "json_coerce_defaults": """select event_id, case event_type when 'click' then 'ekonomi' when 'view' then 'demokrati' else 'övrigt' end category, case event_type when 'purchase' then 'avgjort' else 'pågående' end status from events""",
    "verify_reconcile": """select doc_id, decision, case when quality = 1 and decision = 'publish' then 'publish' else 'needs_review' end final_status
from (select *, case when toxic = 1 then 'reject' when doc_id % 7 = 0 or doc_id % 11 = 0 then 'review' else 'publish' end decision from labels)""",
    "slug_normalize": "select p_partkey, replace(p_name, ' ', '-') slug from part",
    "stamp_left_join": """select l_orderkey, l_linenumber, case when s_suppkey % 3 > 0 then case when s_suppkey % 2 = 0 then 'git-pending:owner/cold:' || upper(s_name) else 'git-pending:owner/main:' || lower(s_name) end end archive_url
from lineitem left join supplier on s_suppkey = l_suppkey""",
    "content_hash": "select 'd/' || doc_id relative_path, sha256(text) sha256 from documents",
    "marker_roundtrip": f"""select page_id, pending, case when pending and cut > 0 then substr(rest, 1, cut - 1) end repo, case when pending and cut > 0 then substr(rest, cut + 1) end relative_path from ({_PARSED})""",
    "permalink_fill": f"""with m as (select *, case when cut > 0 and contains(substr(rest, 1, cut - 1), '/') then substr(rest, 1, cut - 1) else 'owner/main' end repo,
case when cut > 0 and contains(substr(rest, 1, cut - 1), '/') then substr(rest, cut + 1) else rest end path from ({_PARSED}))
select page_id, case when pending and repo = 'owner/main' then 'https://git.example/owner/main/blob/aaa/' || path when pending and repo = 'owner/cold' then 'https://git.example/owner/cold/blob/bbb/' || path else marker end link,
case when pending and repo = 'owner/main' then 'https://git.example/owner/main/blob/aaa/' || path else marker end link_without_archive from m""",
    "service_messages": """select event_id, case event_id % 6 when 0 then 'pending' when 1 then 'success' else 'error' end status, case event_id % 6 when 1 then 'https://archive.example/web/2024/https://a.example' end archived_url,
case event_id % 6 when 0 then 'j1' end job_id, event_id % 6 > 0 failed from events""",
    "paragraph_refs": """with c as (select o_orderkey, o_orderkey::varchar k, o_custkey::varchar c, ['KF', 'KS', 'VONAU', 'XX'][o_orderkey % 4 + 1] code from orders)
select o_orderkey, case when code = 'XX' then c || '|KF' when code = 'KF' and k = c then k || '|KF' else k || '|' || code || ',' || c || '|KF' end refs from c""",
    "section_scope": """with r as (select l_orderkey, l_linenumber n, '§ ' || l_linenumber || ' part ' || l_partkey line,
row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) k, count(*) over (partition by l_orderkey) last from lineitem),
t as (select l_orderkey, string_agg(line, chr(10) order by k) t from r group by 1),
own as (select l_orderkey, line || case when k = last then '' else chr(10) end own from r where n = l_orderkey % 3 + 1 qualify row_number() over (partition by l_orderkey order by k) = 1)
select l_orderkey, case when l_orderkey % 5 = 0 then replace(t, '§', 'par') else coalesce(own, '') end section from t left join own using (l_orderkey)""",
    "key_link_first": """with a as (select o_orderkey, 0 ref_pos, o_custkey p from orders union all select o_orderkey, 1, o_custkey + 7 from orders)
select o_orderkey, l_orderkey "case", p || '|KF' "key" from a join lineitem on l_partkey = p
qualify row_number() over (partition by o_orderkey order by l_orderkey, l_linenumber, ref_pos) = 1""",
    "title_similarity_best": f"""select page_id, "case", round(score, 9) score from ({_BEST})""",
    "link_decision": rf"""
with t as ({_TOKENS.replace("list_distinct(list_filter(", "(list_filter(")}), k as (select tokens[1] "key", min(page_id) "case" from t where len(tokens) > 0 group by 1),
r as (select page_id, lower(regexp_extract(unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)), '([^/?#]+)/?(?:[?#].*)?$', 1)) "key" from pages),
e as (select page_id, min("case") "case" from r join k using ("key") where r."key" <> '' and "case" < page_id group by 1)
select p.page_id, case when e.page_id is not null then 'paragraph_ref' when b.page_id is not null then 'fuzzy_title' else 'none' end kind, coalesce(e."case", b."case") "case"
from pages p left join e using (page_id) left join ({_BEST}) b using (page_id)""",
    "surrogate_ids": """with o as (select *, strftime(o_orderdate, '%Y') y from orders), used as (select distinct y, o_orderkey % 3000 + 1 k from o where o_orderstatus = 'F'),
new as (select o_orderkey, y, row_number() over (partition by y order by o_orderkey) nth from o where o_orderstatus <> 'F'),
span as (select y, unnest(range(1, n + m + 1)) k from (select y, count(*) n from new group by y) join (select y, count(*) m from used group by y) using (y)),
free as (select y, k, row_number() over (partition by y order by k) nth from span s where not exists (select 1 from used u where u.y = s.y and u.k = s.k))
select o_orderkey, printf('a-%s-%04d', y, k) id from new join free using (y, nth)""",
    "snapshot_diff": _DIFF,
    "range_diff": _DIFF,
    "changelog_entry": f"""with s as (select o_orderkey, o_orderdate > timestamp '1996-06-30' fresh,
exists (select 1 from lineitem l where l.l_orderkey = o_orderkey and not exists (select 1 from lineitem m where m.l_orderkey = l.l_orderkey and m.l_linenumber = l.l_linenumber and m.l_shipdate <= timestamp '1996-06-30')) more from orders)
select 'run-1' run_id, count(*) arende_count, count(*) filter (fresh) n_new, count(*) filter (not fresh and more) n_updated, any_value(h) data_hash from s, ({_DATABASE})""",
    "canonical_hash": """select event_id, sha256('{"a":' || replace(props, ' ', '') || ',"b":[2,1],"z":null}') hash from events""",
    "inline_escape": r"""select page_id, md5(replace(replace(regexp_replace(case when page_id % 2 = 0 then html || ' </SCRIPT>' || chr(8232) else html end, '</(script)', '<\\/\1', 'gi'), chr(8232), chr(92) || 'u2028'), chr(8233), chr(92) || 'u2029')) digest from pages""",
    "view_by_body": "select 'a-' || l_orderkey id, count(*) n_steps from lineitem group by l_orderkey having bool_or(lower(l_returnflag) = 'r')",
    "view_search": """select 'a-' || o_orderkey id, o_orderpriority title from orders where o_orderstatus = 'O'
and exists (select 1 from lineitem where l_orderkey = o_orderkey and lower(l_returnflag) = 'n') and exists (select 1 from lineitem where l_orderkey = o_orderkey and starts_with('part ' || l_partkey, 'part 1'))""",
    # what a candidate reaches is followed match by match; the places, numbers and flags follow from it
    "merge_append": """with recursive o as (select o_orderkey k, o_custkey c, o_orderstatus = 'F' old, o_orderpriority status, strftime(o_orderdate, '%Y') y, 'order ' || (o_orderkey % 2000) title from orders),
r as (select k, case when k % 20 = 3 then c + 1 else c end c from o where not old and k % 4 > 0),
e as (select r.k a, s.k b from r join o s on not s.old and s.c = r.c and s.k < r.k),
v as (select o.k, coalesce(d.v, case when not exists (select 1 from e where a = o.k) then n.n + o.k end) v
    from o left join (select r.k, min(s.k) v from r join o s on s.old and s.c = r.c group by 1) d on d.k = o.k, (select coalesce(max(k) filter (old), -1) + 1 n from o) n where not old),
reach(a, b) as (select k, k from v union select reach.a, e.b from reach join e on reach.b = e.a),
f as (select a k, min(v) place from reach join v on v.k = b group by 1),
n as (select coalesce(max(k) filter (old), -1) + 1 n from o),
fresh as (select o.*, place, row_number() over (partition by y order by k) nth from f join o using (k), n where place = n + k),
used as (select distinct y, k from o where old),
span as (select y, unnest(range(1, n + coalesce(m, 0) + 1)) k from (select y, count(*) n from fresh group by y) left join (select y, count(*) m from used group by y) using (y)),
free as (select y, k num, row_number() over (partition by y order by k) nth from span s where not exists (select 1 from used u where u.y = s.y and u.k = s.k)),
numbered as (select k pos, printf('a-%s-%04d', y, k) id, k, title, status, -1 since from o where old union all select place, printf('a-%s-%04d', y, num), k, title, status, k from fresh join free using (y, nth)),
flags as (select x.k, 'similar title: ' || z.id || ' (1.00)' flag from fresh x join numbered z on z.title = x.title and z.since < x.k where x.k % 4 = 0 qualify row_number() over (partition by x.k order by z.pos) = 1),
added as (select place pos, string_agg('s-' || k, ',' order by k) steps, arg_max(status, k) status from f join o using (k), n where place <> n + k group by 1)
select z.id, z.title, coalesce(a.status, z.status) status, 's-' || z.k || coalesce(',' || a.steps, '') steps, flag _link_flag from numbered z left join added a using (pos) left join flags on since >= 0 and flags.k = z.k""",
    # the same table of decompositions as the column expressions use; Hangul syllables and the order of marks don't show in titles
    "title_norm_nfkd": rf"""with m as (select string_split(e, chr(31))[1] c, string_split(e, chr(31))[2] d from (select unnest(string_split('{_DECOMPOSED}', chr(30))) e)),
l as (select doc_id, text, regexp_extract_all(lower(text), '(?s).') l from documents),
c as (select doc_id, unnest(l) c, generate_subscripts(l, 1) i from l),
n as (select doc_id, string_agg(coalesce(d, c), '' order by i) t from c left join m using (c) group by doc_id),
w as (select doc_id, case when text is not null then coalesce(t, '') end t from documents left join n using (doc_id))
select doc_id, {_TITLE.format('t')} title, {_TITLE.format(_BARE)} title_without_marks from w""",
    # three levels: up to 4 million positions
    "hash_tree": f"""with recursive a as (select pos // 1024 node, sha256(string_agg(sha256(j), '' order by pos)) hash, count(*) n from ({_CASE_JSON}) group by 1),
b as (select node // 64 node, sha256(string_agg(hash, '' order by node)) hash, sum(n) n from a where (select max(node) from a) > 0 group by 1),
c as (select node // 64 node, sha256(string_agg(hash, '' order by node)) hash, sum(n) n from b where (select max(node) from b) > 0 group by 1)
select 0 as level, node, hash, n::bigint n from a union all select 1, node, hash, n::bigint from b union all select 2, node, hash, n::bigint from c""",
    "paragraph_keys": "select o_orderkey, case o_orderkey % 4 when 0 then o_orderkey || '|KF' when 1 then o_orderkey || '|ÖFN' end \"key\" from orders",
    "gate_quotes": f"""select l_orderkey, step_pos, 0::bigint kind, step_id, 'quote' field, 'part ' || l_partkey quote, case when l_linenumber % 5 = 0 then 60 else 40 end::bigint word_limit from ({_STEPS}) where l_linenumber % 3 > 0
union all select l_orderkey, step_pos, 1, step_id, 'reservation[A+B]', 'r ' || l_partkey, null from ({_STEPS}) where l_linenumber % 2 = 0 and l_linenumber % 4 > 0
union all select l_orderkey, step_pos, 2, step_id, 'protocol_anteckning[C]', 'n ' || l_partkey, null from ({_STEPS}) where l_linenumber % 3 = 1 and l_linenumber % 4 > 0""",
    "failed_checks": "select l_orderkey, string_agg('s-' || l_linenumber || ':' || l_returnflag || ':not found', ',' order by 's-' || l_linenumber, l_returnflag) failed from lineitem where l_discount > 0.05 group by 1",
    "view_by_party": "select l_orderkey, count(*) n_steps from lineitem group by 1 having l_orderkey % 10 = 0 or bool_or(l_linenumber % 2 = 0)",
    "shown_links": f"select page_id, case when not pending then marker end link from ({_PARSED})",
    "stamped_sources": "select l_orderkey, 'file ' || l_orderkey urls, count(*) n_steps from lineitem group by 1",
    "snapshot_links": f"select l_orderkey, string_agg(case when s_suppkey % 3 > 0 then 'w' || s_suppkey else '-' end, ',' order by step_pos) links from ({_STEPS}) left join supplier on s_suppkey = l_suppkey group by 1",
    "served_by_body": "select 'a-' || l_orderkey id, count(*) n_steps from lineitem group by l_orderkey having bool_or(lower(l_returnflag) = 'r' and year(l_shipdate) between 1993 and 1995)",
    "served_by_party": """select party, 'a-' || l_orderkey id, count(*) n_steps from lineitem, (values ('F'), ('A')) p(party) group by all
having bool_or(l_linenumber % 3 = 1 and l_linestatus = party or l_linenumber % 3 = 2 and l_returnflag = party)""",
    "landed_pages": """select page_id, committee_slug, date, md5(html) digest, committee_slug = 'b1' and date between '2024-01-05' and '2024-01-20' asked
from (select page_id, html, 'b' || page_id % 3 committee_slug, strftime(date '2024-01-01' + (page_id % 28)::integer, '%Y-%m-%d') date from pages)""",
    "confirmed_bodies": "select c_custkey from customer where c_acctbal > 0",
}
ORACLE["view_search_indexed"] = ORACLE["view_search"]
ORACLE["merge_batches"] = ORACLE["merge_append"]
