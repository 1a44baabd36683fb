"""The text operators as queries over the driver's tables, with checking SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm import (
    chat, decontaminate, exact_dedup, language, lexical, linededup, minhash, mixing, periodic, quality, simhash, toxicity, urlfilter,
)
from fieldlens.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = exact_dedup.exact_groups(read(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op4_exact_dedup"] = r"""
with d as (select doc_id, length(coalesce(text, '')) c, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) s,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') t from documents),
r as (select *, row_number() over (partition by t order by c desc, doc_id) k, count(*) over (partition by t) n,
    first_value(doc_id) over (partition by t order by c desc, doc_id) f from d)
select doc_id, f keep_id, n group_size, k = 1 kept, s text_sha256 from r"""


@query
def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    out = simhash.near_groups(read(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "fingerprint", "component_id")


@query
def op6_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_scores(read(spark, d, "documents"), read(spark, d, "labels"))


@query
def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, d, "documents"), read(spark, d, "labels"))


@query
def op9_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    out = decontaminate.contaminated(read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "benchmark"))
    return out.select("doc_id", "item_id", "distance")


@query
def op1_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(read(spark, d, "documents").select("doc_id", "text", "source"))


ORACLE["op1_mixture"] = r"""
with recursive t as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) n,
    coalesce('=' || source, '') sk, coalesce(cast(doc_id as varchar), '-') k from documents),
h as (select *, ('0x' || substr(md5('mix:' || k), 1, 15))::bigint spot, ('0x' || substr(md5('within:' || k), 1, 15))::bigint rk from t),
tot as (select sk, sum(n)::bigint total from t group by sk having sum(n) > 0),
w as (select sum(total)::bigint whole, count(*) m, min(total)::double / sum(total) least from tot),
p as (select sk, total, total / whole::double p from tot, w),
f as (select x, ln(z) - x * zl / z >= 0.97 * ln(m) - 1e-12 even, least ** (x - 1) / z > 4.0 worn
  from (select x, sum(p ** x) z, sum(p ** x * ln(p)) zl from p, (values (0.0::double), (1.0::double)) v(x) group by x), w),
e(i, a, b) as (select 0, 0.0::double, 1.0::double union all
  select i + 1, case when ln(z) - c * zl / z >= 0.97 * ln(m) - 1e-12 then c else a end, case when ln(z) - c * zl / z >= 0.97 * ln(m) - 1e-12 then b else c end
  from (select i, a, b, m, (a + b) / 2 c, (select sum(p ** ((a + b) / 2)) from p) z, (select sum(p ** ((a + b) / 2) * ln(p)) from p) zl from e, w where i < 24)),
r(i, a, b) as (select 0, 0.0::double, 1.0::double union all
  select i + 1, case when least ** (c - 1) / z > 4.0 then c else a end, case when least ** (c - 1) / z > 4.0 then b else c end
  from (select i, a, b, least, (a + b) / 2 c, (select sum(p ** ((a + b) / 2)) from p) z from r, w where i < 24)),
lim as (select case when (select even from f where x = 1) then 1.0 when not (select even from f where x = 0) then 0.0 else (select a from e where i = 24) end high,
  case when (select worn from f where x = 1) then 1.0 when not (select worn from f where x = 0) then 0.0 else (select b from r where i = 24) end low),
x as (select case when m = 1 then 1.0 when high >= low then floor(greatest(high, low) * 1e6) / 1e6 else ceil(low * 1e6) / 1e6 end x from lim, w),
plan as (select sk, total, cast(round(p ** x / (select sum(p ** x) from p, x) * whole) as bigint) budget, cast(ceil(total / 20000.0) as bigint) blocks from p, x, w),
d as (select h.*, total, budget, blocks, spot % blocks block from h join plan using (sk)),
bl as (select sk, block, sum(n)::bigint size, any_value(total) total, any_value(budget) budget from d group by all having sum(n) > 0),
ps as (select *, unnest(generate_series(0, greatest(0, cast(ceil(budget / total::double) as bigint) - 1))) pass from bl),
tu as (select *, ('0x' || substr(md5('pass:' || sk || ':' || pass || ':' || block), 1, 15))::bigint turn from ps),
st as (select *, pass * total + coalesce(sum(size) over (partition by sk, pass order by turn, block rows between unbounded preceding and 1 preceding), 0) pos from tu),
use as (select d.*, pass, size, pos, coalesce(sum(n) over (partition by d.sk, d.block, pass order by rk, k, n rows between unbounded preceding and 1 preceding), 0) before
  from d join (select sk, block, pass, size, pos from st where pos < budget) s on s.sk = d.sk and s.block = d.block)
select doc_id, source, n n_tokens, cast(pass as integer) pass, block, cast(pos as bigint) start_tokens, budget
from use where n > 0 and (pos + size <= budget or pos + before < budget)"""


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op2_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urlfilter.judge(read(spark, d, "pages").select("page_id", "url"), rules)


ORACLE["op2_url_filter"] = r"""
with r(rh, rp, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
a as (select page_id, case when contains(coalesce(url, ''), '://') then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
b as (select page_id, regexp_extract(rest, '^[^/?#]*') h, rest from a),
c as (select row_number() over () k, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') path from b),
m as (select c.*, rh || rp rule, v, row_number() over (partition by k order by length(rh || rp) desc nulls last) n
  from c left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rule, coalesce(v, 'allow') verdict from m where n = 1"""


PLANTED = r"\### Assistant: </turn> ok"


@query
def op3_chat_format(spark: SparkSession, d: str) -> DataFrame:
    own = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(own.unionByName(more)))


ORACLE["op3_chat_format"] = r"""
with a as (select conv_id, turn, role, text from conversations union all
  values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
b as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from a),
c as (select *, replace(replace(replace(t, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') e,
  replace(replace(replace(replace(r, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ':', '\:') f from b)
select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) turns_sha256,
  cast(coalesce(sum(length(t)) filter (where r = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (where r = 'assistant'), '')) loss_sha256,
  cast(sum(4 + length(f) + 2 + length(e) + 8) as bigint) formatted_chars
from c group by conv_id"""


@query
def op8_language(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(read(spark, d, "documents").select("doc_id", "text", "lang"))


@query
def op5_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return linededup.dedupe_lines(read(spark, d, "documents").select("doc_id", "text"))


ORACLE["op5_line_dedup"] = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) i from documents),
h as (select *, ('0x' || substr(md5(x), 1, 15))::bigint % 2147483647 a from l),
r as (select *, (a + coalesce(lag(a, 1) over w * 1000003 % 2147483647, 0) + coalesce(lag(a, 2) over w * (1000003::bigint * 1000003 % 2147483647) % 2147483647, 0)) % 2147483647 % 4 = 0 e
  from h window w as (partition by doc_id order by i)),
c as (select *, coalesce(sum(e::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) c from r),
k as (select doc_id, c, count(*) n, min(i) i, string_agg(x, chr(10) order by i) body from c group by all),
g as (select *, n > 1 and row_number() over (partition by body, n > 1 order by doc_id, i) > 1 gone from k)
select doc_id, coalesce(string_agg(body, chr(10) order by i) filter (where not gone), '') text, cast(sum(n) as bigint) n_lines,
  cast(coalesce(sum(n) filter (where gone), 0) as bigint) n_removed from g group by doc_id"""


def repeated_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by crc32 of its id goes on, from a word on, with the words from there over and over."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def changed(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    planted = F.element_at(F.transform(F.array(words), changed), 1)  # the outer array has the words found once
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), planted).otherwise(F.col("text")))


@query
def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    found = periodic.find_runs(repeated_tails(read(spark, d, "documents").select("doc_id", "text")))
    best = periodic.strongest(F.col("runs"))
    out = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        periodic.run_digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# crc32 by its table (polynomial EDB88320); runs by equal blocks of eight words at one distance, which any run has
ORACLE["op11_periodic_runs"] = r"""
with recursive bits(i, k, c) as (select i, 0, i::bigint from range(256) t(i) union all
  select i, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
tab as (select i, c from bits where k = 8),
crc(doc_id, s, c) as (select doc_id, doc_id::varchar, 4294967295::bigint from documents union all
  select doc_id, substr(s, 2), xor(crc.c >> 8, tab.c) from crc join tab on tab.i = xor(crc.c & 255, ascii(s)::bigint) where s <> ''),
h as (select doc_id, xor(c, 4294967295) h from crc where s = ''),
d as (select doc_id, h, h // 10 g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents join h using (doc_id)),
e as (select *, len(w) n, case when len(w) > 0 then g % len(w) end a from d),
f as (select *, 1 + (n - a) // (3 + g % 8) p from e),
o as (select doc_id, n, unnest(w) word, generate_subscripts(w, 1) - 1 i from f),
src as (select doc_id, unnest(range(n)) i, h, a, p from f where n > 0),
t as (select s.doc_id, s.i, o.word from src s join o on o.doc_id = s.doc_id
  and o.i = case when h % 10 = 0 and s.i >= a then a + (s.i - a) % p else s.i end),
gram as (select doc_id, i, string_agg(word, ' ') over w g8, count(*) over w c from t
  window w as (partition by doc_id order by i rows between current row and 7 following)),
pair as (select x.doc_id, x.i, y.i - x.i q from gram x join gram y on x.doc_id = y.doc_id and x.g8 = y.g8 and y.i > x.i where x.c = 8 and y.c = 8),
isle as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) k from pair),
eq as (select doc_id, q, min(i) start, count(*) + 7 + q length from isle group by doc_id, q, k),
run as (select doc_id, start, length, min(q) period from eq where length >= greatest(24, 3 * q) group by doc_id, start, length),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) i from run),
kept as (select doc_id, string_agg(word, ' ' order by i) body from t anti join gone using (doc_id, i) group by doc_id),
agg as (select doc_id, count(*) n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) lines from run group by doc_id),
best as (select x.* from run x where not exists (select 1 from run y where y.doc_id = x.doc_id and (y.length * x.period > x.length * y.period
  or y.length * x.period = x.length * y.period and (y.start < x.start or y.start = x.start and y.period < x.period))))
select d.doc_id, coalesce(n_runs, 0) n_runs, cast(start as bigint) start, cast(length as bigint) length, cast(period as bigint) period,
  cast(1000 * length // period as bigint) exponent_milli, sha256(coalesce(lines, '')) runs_sha256, sha256(coalesce(body, '')) collapsed_sha256
from d left join agg using (doc_id) left join best using (doc_id) left join kept using (doc_id)"""


@query
def op12_minhash(spark: SparkSession, d: str) -> DataFrame:
    out = minhash.near_groups(read(spark, d, "documents").select("doc_id", "text"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


ORACLE["op12_minhash"] = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
g as (select doc_id, case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end g from w),
s as (select distinct doc_id, unnest(g) x from g),
n as (select doc_id, count(*) n from s group by doc_id),
c as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.x = b.x and a.doc_id <> b.doc_id group by all),
l as (select c.a, c.b from c join n na on na.doc_id = c.a join n nb on nb.doc_id = c.b where 100 * c >= 85 * (na.n + nb.n - c)),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on l.a = r.b),
m as (select a, min(b) b from r group by a)
select w.doc_id, coalesce(n, 0) n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) component_id, w.doc_id <= coalesce(m.b, w.doc_id) kept
from w left join n on n.doc_id = w.doc_id left join m on m.a = w.doc_id"""


@query
def op13_lexical(spark: SparkSession, d: str) -> DataFrame:
    return lexical.search(read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "benchmark"))


ORACLE["op13_lexical"] = r"""
with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from documents),
q as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
len as (select doc_id, count(*) n from t group by doc_id),
al as (select count(*) nn, sum(n)::bigint ll from len),
m as (select doc_id, 25 + (75 * n * nn) // ll m from len, al),
tf as (select doc_id, term, count(*) tf from t group by all),
w as (select term, cast(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)::double)) as bigint) w from tf, al group by term, nn),
qt as (select item_id, term, count(*) qtf from q group by all),
s as (select item_id, doc_id, cast(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) score
  from qt join w using (term) join tf using (term) join m using (doc_id) group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) k from s where score > 0)
select item_id, cast(k as integer) "rank", doc_id, score from r where k <= 10"""
