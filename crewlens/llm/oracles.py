"""The queries' results in SQL, for those that SQL can express."""

from crewlens.llm import fingerprints, mixing, urls

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
with d as (select doc_id, source, cast(len({WORDS}) as bigint) size from documents),
s as (select source, cast(sum(size) as bigint) source_size, row_number() over (order by source nulls last) - 1 k from d group by source),
w as (select *, list_value({", ".join(f"{x}::double" for x in mixing.WEIGHTS)})[k % {len(mixing.WEIGHTS)} + 1] weight,
             source_size * {mixing.MOST}::double ceiling from s),
l as (select *, ceiling / weight lev,
             coalesce(sum(ceiling) over before, 0) cb, coalesce(sum(weight) over before, 0) wb
      from w window before as (order by ceiling / weight, source nulls last rows between unbounded preceding and 1 preceding)),
a as (select *, (({mixing.SHARE}::double * (select sum(source_size) from s)) - cb) / ((select sum(weight) from w) - wb) mark from l),
c as (select arg_min(mark, lev) common from a where mark <= lev),
g as (select source, source_size, case when common is null then ceiling else least(ceiling, common * weight) end target from w, c),
o as (select d.doc_id, d.source, d.size, source_size, target, target / nullif(source_size, 0) rate,
             row_number() over (partition by d.source order by d.size, d.doc_id) r,
             cast(('0x' || substr(md5(coalesce(d.source, '') || '{mixing.SEED}'), 1, 4)) as bigint) / 65536.0::double u
      from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target, cast(size * case
  when source_size = 0 then 0 when rate >= {mixing.MOST}::double then {int(mixing.MOST)}
  else floor(r * rate + u) - floor((r - 1) * rate + u) end as bigint) taken
from o"""

OP3 = rf"""
with d as (select doc_id, source, coalesce(text, '') t, {WORDS} w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines from documents),
win as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] k from (select doc_id, w, unnest(range(1, len(w) - 1)) i from d)),
rep as (select doc_id, i from win qualify count(*) over (partition by doc_id, k) > 1),
cov as (select doc_id, count(distinct i + j) n from rep, (values (0), (1), (2)) x(j) group by 1),
m as (select doc_id, source, cast(len(w) as bigint) n_words,
             cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) word_chars,
             cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
             cast(len(lines) - len(list_distinct(lines)) as bigint) n_dup_lines,
             cast(coalesce(cov.n, 0) as bigint) n_repeat_words, len(lines) n_lines
      from d left join cov using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base, 10 * n_symbols > n_words symbols,
             100 * n_dup_lines > 30 * n_lines dup_lines, not word_chars between 2 * n_words and 12 * n_words word_length from m),
h as (select source, unnest([base, symbols, dup_lines, word_length]) bad, unnest([1, 2, 3, 4]) rule from f where source is not null),
c as (select source, rule, count(*)::double n, (count(*) filter (where bad))::double fails from h group by all),
p as (select rule, sum(fails) / sum(n) mean, count(*) / sum(n) noise,
             sum(fails * fails / n) / sum(n) - (sum(fails) / sum(n)) * (sum(fails) / sum(n)) square from c group by rule),
s as (select rule, mean, case when mean > 0 and mean < 1 and noise < 1 and square / (mean * (1 - mean)) > noise
               then least(1e6, greatest(1, 1 / ((square / (mean * (1 - mean)) - noise) / (1 - noise)) - 1)) else 1e6 end st from p),
v as (select source, bool_or((fails + mean * st) / (n + st) > 0.5) rejected from c join s using (rule) group by 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base base_failed,
       not (base or symbols or dup_lines or word_length) and not coalesce(rejected, false) kept
from f left join v using (source)"""

OP4 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
p as (select doc_id, i, substr(h, 2 * i + 1, 200) s from (select doc_id, h, unnest(range(0, len(h) // 2 - 99)) i from d)),
c as (select doc_id, i from p qualify doc_id * 4294967296::hugeint + i > min(doc_id * 4294967296::hugeint + i) over (partition by s)),
n as (select *, coalesce(i > lag(i) over (partition by doc_id order by i) + 100, true) fresh from c),
g as (select *, sum(fresh::int) over (partition by doc_id order by i) run from n),
r as (select doc_id, min(i) a, max(i) + 100 b from g group by doc_id, run),
k as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) x, a y from r
      union all select doc_id, max(b), 2000000000 from r group by doc_id),
left_ as (select doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' order by x) h from k join d using (doc_id) group by doc_id),
gone as (select doc_id, sum(b - a) n, count(*) m from r group by doc_id)
select doc_id, cast(len(d.h) // 2 as bigint) n_bytes, cast(coalesce(gone.n, 0) as bigint) n_removed,
       cast(coalesce(m, 0) as bigint) n_spans, sha256(unhex(coalesce(left_.h, d.h))) kept_sha256
from d left join gone using (doc_id) left join left_ using (doc_id)"""

_RULES = ", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in urls.RULES)
_HOST = r"translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), '" + f"{UPPER}', '{LOWER}')"

OP6 = rf"""
with recursive u as (select page_id, html, coalesce({_HOST.format("url")}, '') host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') path from pages),
rules(verdict, rule, h, p) as (values {_RULES}),
hit as (select page_id, rule, verdict from u join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
        qualify row_number() over (partition by page_id order by len(rule) desc) = 1),
j as (select u.*, rule, verdict from u left join hit using (page_id)),
r0 as (select distinct case verdict when 'allow' then 'trust' else 'distrust' end kind, host, 1 - {urls.DAMPING}::double score
       from j where verdict is not null),
links as (select host src, unnest(regexp_extract_all(html, '{urls.LINK.replace("'", "''")}', 1)) link from u where host <> ''),
pairs as (select src, {_HOST.format("case when starts_with(link, '//') then 'http:' || link else link end")} dst from links),
edges as (select src, dst, count(*) n from pairs where dst <> '' and dst <> src group by all),
ways as (select 'trust' kind, src, dst, n from edges union all select 'distrust', dst, src, n from edges),
e as (select kind, src, dst, n / sum(n) over (partition by kind, src) part from ways),
handed as (select 0 hop, * from r0
  union all select hop + 1, e.kind, e.dst, sum(score * part * {urls.DAMPING}) from handed join e on e.kind = handed.kind and e.src = handed.host
  where hop < {urls.HOPS} group by hop, e.kind, e.dst),
t as (select host, coalesce(sum(score) filter (where kind = 'trust'), 0) trust,
             coalesce(sum(score) filter (where kind = 'distrust'), 0) distrust from handed group by 1)
select page_id, host, path, rule,
       coalesce(verdict, case when distrust > {urls.MOST_DISTRUST} * (trust + distrust) then 'block' else 'allow' end) verdict,
       round(coalesce(trust, 0), 6) trust, round(coalesce(distrust, 0), 6) distrust
from j left join t using (host)"""

OP7 = rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, array_to_string(w[i : least(i + 4, len(w))], ' ') g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) i from w where len(w) > 0)),
n as (select doc_id, count(*) n from s group by 1),
e as (select a.doc_id x, b.doc_id y from s a join s b using (g) join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
      where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
c as (select doc_id, doc_id root from documents union select e.y, c.root from c join e on e.x = c.doc_id)
select doc_id, cast(coalesce(any_value(n), 0) as bigint) n_shingles, min(root) component_id from c left join n using (doc_id) group by doc_id"""

_CLEAN = "replace(replace({0}, '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>')"
OP10 = f"""
with c as (select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role nulls first, text nulls first) t
           from conversations where conv_id is not null group by 1),
k as (select conv_id, t, cast(to_json(t) as varchar) whole from c),
inner_ as (select distinct cast(to_json(t[1:i]) as varchar) part from (select t, unnest(range(1, len(t))) i from c)),
m as (select min(conv_id) conv_id, count(*) copies from k where whole not in (select part from inner_) group by whole)
select conv_id, cast(len(t) as bigint) n_turns, copies,
       array_to_string(list_transform(t, lambda x: '<|im_start|>' || {_CLEAN.format("coalesce(x.role, 'user')")} || chr(10)
         || {_CLEAN.format("coalesce(x.text, '')")} || '<|im_end|>' || chr(10)), '') as text
from m join k using (conv_id)"""

_F = fingerprints
_SUMS = (
    "list_sum(list_transform(list_zip(q, {0}), lambda z: abs(z[1] - z[2])))",
    "list_sum(list_transform(list_zip(q, {0}), lambda z: greatest(z[1], z[2])))",
)
_BOUND = f"least({_F.BOUND}, {_SUMS[1]} + {_F.LENGTH_POINTS})"
_NEAR = f"1 - least({_SUMS[0]} + {_F.LENGTH_POINTS} * (greatest(n, {{1}}) - least(n, {{1}})) // greatest(n, {{1}}, 1), {_BOUND})::double / ({_BOUND})::double"
_LAST = f"lead({{0}}) over (order by doc_id), first({{0}}) over (order by doc_id)"
_DIGEST_LENGTH = f"printf('%0{_F.LENGTH_DIGITS}x', strlen(t))"
OP11 = f"""
with d as (select doc_id, coalesce(text, '') t from documents),
o as (select doc_id, t, coalesce({_LAST.format("t")}) following from d),
k as (select doc_id, false fresh, t from d
      union all select doc_id, true, left(t, length(t) - length(t) // 4) || left(following, length(t) // 4) from o),
x as (select doc_id, fresh, strlen(t) n, hex(encode(t)) || '{"00" * 2 * _F.SPREAD}' h from k),
b as (select doc_id, fresh, unnest(range(0, n)) i, unnest(list_transform(regexp_extract_all(substr(h, 1, 2 * n), '..'),
             lambda y: ('0x' || y)::bigint)) v from x),
w as (select doc_id, fresh, v * {_F.FACTORS[0]} + coalesce(lead(v, {_F.SPREAD}) over s, 0) * {_F.FACTORS[1]}
             + coalesce(lead(v, {2 * _F.SPREAD}) over s, 0) * {_F.FACTORS[2]} m from b window s as (partition by doc_id, fresh order by i)),
c as (select doc_id, fresh, ((m % 4294967296) >> {_F.SHIFT}) & {_F.BUCKETS - 1} bucket, count(*) c from w group by all),
e as (select doc_id, fresh, bucket, coalesce(c, 0) c from (select doc_id, fresh, unnest(range(0, {_F.BUCKETS})) bucket from x)
      left join c using (doc_id, fresh, bucket)),
s as (select doc_id, fresh, list_sort(list(c)) s from e group by all),
l as (select doc_id, fresh, bucket, (c > s[{_F.BUCKETS // 4}])::int + (c > s[{_F.BUCKETS // 2}])::int + (c > s[{_F.BUCKETS * 3 // 4}])::int q
      from e join s using (doc_id, fresh)),
digits as (select doc_id, fresh, bucket // 2 place, max(case when bucket % 2 = 0 then 4 * q else 0 end) + max(case when bucket % 2 = 1 then q else 0 end) v
           from l group by all),
f as (select doc_id, fresh, string_agg(printf('%x', v), '' order by place) f from digits group by all),
g as (select doc_id, fresh, list(q order by bucket) q from l group by all),
p as (select k.doc_id, k.fresh, strlen(t) n, length(t) chars, sha256(t) sha, {_DIGEST_LENGTH} || f f, q
      from k join f using (doc_id, fresh) join g using (doc_id, fresh)),
j as (select a.*, e.sha edited_sha, e.f ef, e.n en, e.q eq, coalesce(lead(a.n) over (order by a.doc_id), first(a.n) over (order by a.doc_id)) nn,
             coalesce(lead(a.q) over (order by a.doc_id), first(a.q) over (order by a.doc_id)) nq
      from p a join p e on a.doc_id = e.doc_id and not a.fresh and e.fresh)
select doc_id, cast(chars as bigint) n_chars, edited_sha edited_sha256, f fingerprint, ef edited_fingerprint,
       {_NEAR.format("eq", "en")} near_edited, {_NEAR.format("nq", "nn")} near_next
from j"""

# Four steps of the checksum at once, by the reversed polynomial.
_NIBBLES = []
for _n in range(16):
    for _ in range(4):
        _n = _n >> 1 ^ (0xEDB88320 if _n & 1 else 0)
    _NIBBLES.append(_n)
_HALF = f"xor({{0}} >> 4, {_NIBBLES}[({{0}} & 15) + 1])"
_BYTE = _HALF.format("(" + _HALF.format("xor(crc, b)") + ")")
CRC32 = (
    "xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split({0}, ''), lambda x: ascii(x)::bigint)), "
    f"lambda crc, b: {_BYTE}))"
)

OP12 = f"""
with t as (select conv_id c, coalesce(role, '') r, coalesce(text, '') x,
                  row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos
           from conversations where conv_id is not null),
k as (select c, {CRC32.format("cast(c as varchar)")} % 9 h from (select distinct c from t)),
rows_ as (select t.c, 2 part, pos, r, x from t join k using (c) where c % 5 = 0 or pos > h
          union all select k.c, 1, pos, r, x from k join t on t.c = k.c - k.c % 5 where k.c % 5 <> 0 and pos <= h),
s as (select k.c, coalesce(list({{'r': r, 'x': x}} order by part, pos) filter (part is not null), []) s from k left join rows_ using (c) group by k.c),
p as (select c, s, d, cast(to_json(s[1:d]) as varchar) node from (select c, s, unnest(range(0, len(s) + 1)) d from s)),
n as (select node, d, min(c) c, count(*) n, any_value(s[1:d]) s, coalesce(any_value(strlen(s[d].x)), 0) bytes,
             string_agg(c::varchar, ',' order by c) filter (len(s) = d) ends from p group by node, d),
above as (select *, cast(to_json(s[1:d - 1]) as varchar) up from n where d > 0),
children as (select up node, count(*) n_children from above group by 1),
down as (select cast(to_json(s[1:j]) as varchar) node, n, bytes, leaf from (
           select s, n, bytes, node not in (select node from children) leaf, unnest(range(0, d + 1)) j from n)),
sums as (select node, count(*) filter (leaf) n_leaves, sum((n - 1) * bytes) saved from down group by 1)
select n.c conv_id, cast(n.d as bigint) depth, q.c parent_conv_id, n.n n_convs, cast(coalesce(n_children, 0) as bigint) n_children,
       n_leaves, cast(saved as bigint) saved_tokens, sha256(coalesce(n.ends, '')) ends_sha256
from n left join above on above.node = n.node left join n q on q.node = above.up
left join children on children.node = n.node join sums on sums.node = n.node"""

ORACLES = {
    "op1_mix_sources": OP1,
    "op3_quality_rules": OP3,
    "op4_suffix_dedup": OP4,
    "op6_url_filters": OP6,
    "op7_jaccard_join": OP7,
    "op10_chat_formatting": OP10,
    "op11_fingerprints": OP11,
    "op12_prefix_trie": OP12,
}
