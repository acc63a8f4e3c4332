"""Queries of the operators that run in DataFrame functions alone, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.llm import licenses, lines, mixing, secrets
from lotwise.llm.license_rules import BASE, WEIGHTS, compiled, signatures
from lotwise.llm.registry import query, table
from lotwise.session import materialize, scratch_path


def text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ------------------------------------------------------------------ 2: secrets
def _spans_sql(rule: secrets.Rule) -> str:
    p = text_sql(rule.pattern)
    return f"""
 select doc_id, {text_sql(rule.kind)} kind, {secrets.RULES.index(rule)} number, unnest(spans) span from (
  select doc_id, list_filter(list_transform(range(1, len(hits) + 1), lambda i: {{
     'start': coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0),
     'size': length(hits[i]), 'value': length(vals[i])}}), lambda x: x.value >= {rule.least}) spans
  from (select doc_id, regexp_extract_all(t, {p}, 0) hits, regexp_extract_all(t, {p}, {rule.group}) vals,
               string_split_regex(t, {p}) gaps from d))"""


SECRETS_SQL = f"""
with d as (select doc_id, coalesce(text, '') t from documents),
s as ({' union all '.join(_spans_sql(r) for r in secrets.RULES)}),
p as (select doc_id, kind, number, span.start a, span.start + span.size b from s),
o as (select doc_id, kind, number, cast(a as bigint) a, kind || ':' || cast(a as bigint) || ':' || cast(b as bigint) one
      from p)
select d.doc_id, count(*) filter (where kind = 'assign') n_assign, count(*) filter (where kind = 'access') n_access,
  count(*) filter (where kind = 'hex') n_hex,
  sha256(coalesce(string_agg(one, ',' order by a, number) filter (where number < {len(secrets.BASE)}), '')) base_sha256,
  coalesce(string_agg(one, ',' order by a, number), '') spans
from d left join o using (doc_id) group by d.doc_id"""


@query("op2_secret_scan", SECRETS_SQL)
def secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.update_ledger(docs, scratch_path(spark, "ledger"))
    found = secrets.findings(docs, ledger)
    base = F.filter("found", lambda x: x["number"] < len(secrets.BASE))

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("row.doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("found")).alias("spans"))


# ------------------------------------------------------------------ 3: licenses
def _licenses_sql() -> str:
    rules = ",\n".join(f"({i}, {text_sql(r.label)}, {r.priority}, {text_sql(f' {r.keyword} ')}, {text_sql(r.pattern)})"
                       for i, r in enumerate(signatures()))
    base = ",\n".join(f"({text_sql(label)}, {text_sql(compiled(p))})" for p, label in BASE.items())
    weights = " ".join(f"when {p} then {w}::double" for p, w in WEIGHTS.items())

    def places(source, pattern):
        return f"""
  select *, unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
     'a': (coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x) - length(replace(x, ' ', '')))), 0)
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x) - length(replace(x, ' ', '')))), 0)) // 2,
     'n': (length(hits[i]) - length(replace(hits[i], ' ', ''))) // 2}})) span
  from (select *, regexp_extract_all(line, {pattern}, 0) hits, string_split_regex(line, {pattern}) gaps from {source})"""

    return f"""
with rules(number, label, priority, keyword, pattern) as (values {rules}),
base(label, pattern) as (values {base}),
w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') words from documents),
d as (select doc_id, len(words) n_words, case when len(words) > 0 then ' ' || array_to_string(words, '  ') || ' '
   else '' end line from w),
b as (select doc_id, label, span.a a from ({places('(select d.doc_id, d.line, base.* from d, base)', 'pattern')})),
bb as (select doc_id, count(*) n, min(a) f, max(a) l, string_agg(distinct label, ',' order by label) labels
   from b group by doc_id),
m as (select doc_id, number, label, priority, span.a a, span.a + span.n e
   from ({places('(select d.doc_id, d.line, rules.* from d join rules on contains(d.line, rules.keyword))', 'pattern')})),
k as (select * from m where not exists (select 1 from m o where o.doc_id = m.doc_id and o.a <= m.a and o.e >= m.e
   and o.priority <= m.priority and (o.a < m.a or o.e > m.e or o.priority < m.priority or o.number < m.number))),
al as (select doc_id, label from k union select doc_id, label from b),
ll as (select doc_id, string_agg(distinct label, ',' order by label) labels from al group by doc_id),
kk as (select doc_id, case min(priority) {weights} end score from k group by doc_id)
select d.doc_id, d.n_words, coalesce(bb.n, 0) n_base, cast(bb.f as bigint) first_word, cast(bb.l as bigint) last_word,
  coalesce(bb.labels, '') base_labels, coalesce(ll.labels, '') labels, coalesce(kk.score, 0::double) score
from d left join bb using (doc_id) left join ll using (doc_id) left join kk using (doc_id)"""


@query("op3_license_scan", _licenses_sql())
def license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs)
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    labels = F.array_sort(F.array_union(base_labels, F.transform("kept", lambda d: d["label"])))
    starts = F.transform("base", lambda b: b["start"])
    return found.select("row.doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                        "score")


# ------------------------------------------------------------------ 4: mixing
def mixing_sql(docs: str = "documents") -> str:
    """Rows (doc_id, source, text, size, source_size, target, copies) of the plan."""
    size = f"cast(len(regexp_extract_all(coalesce(text, ''), {text_sql(mixing.WORD)})) as bigint)"
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
d as (select *, {size} size, md5(coalesce(cast(doc_id as varchar), '')) hash from {docs}),
c as (select *, greatest(length(bin(size)) - 6, 0) spare from d),
o as (select *, cast(spare * 64 + (size >> spare) as bigint) class from c),
t as (select source, cast(sum(size) as bigint) source_size from d group by source),
w as (select *, cast(list_value({weights})[(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1]
   as bigint) weight, {mixing.CAP} * source_size most from t),
r as (select *, sum(source_size) over () total,
   coalesce(sum(most) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) gone,
   sum(weight) over (order by most / weight, source nulls last rows between current row and unbounded following) rest from w),
f as (select *, most::double <= weight::double * ((total - gone)::double / rest::double) is_full from r),
g as (select *, (total - coalesce(sum(case when is_full then most end) over (), 0))::double
   / (sum(case when not is_full then weight end) over ())::double level from f),
s as (select source, source_size, case when is_full then most::double else weight::double * level end target,
   cast('0x' || substr(md5('{mixing.SEED}' || coalesce('=' || source, '-')), 1, 8) as bigint)::double / 4294967296.0 off from g),
p as (select o.*, s.source_size, s.target, s.off, case when s.source_size > 0 then s.target / s.source_size::double else 0 end rate,
   (row_number() over (partition by o.source order by class, hash, doc_id nulls first, size))::double place
   from o join s on o.source is not distinct from s.source),
plan as (select *, cast(least({mixing.CAP}, floor(place * rate + off) - floor((place - 1) * rate + off)) as bigint) copies from p)"""


@query("op4_mix_sources", f"with {mixing_sql()} select doc_id, size, source_size, target, copies * size taken from plan")
def mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    plan = mixing.planned_copies(sized, F.col("size"))
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


# ------------------------------------------------------------------ 9: lines
def lines_sql(docs: str = "documents") -> str:
    """Rows (row number rn, kept list) of every document."""
    bare = "trim({0}, ' ' || chr(9) || chr(13))"
    return f"""
n as (select *, row_number() over () rn from {docs}),
x as (select rn, doc_id, source, {bare.format('line')} bare from (select rn, doc_id, source,
   unnest(string_split(text, chr(10))) line from n)),
gone as (select bare, min(doc_id) holder from x where bare <> '' group by bare
   having count(distinct source) >= {lines.MIN_SITES}),
hit as (select x.rn, list(distinct x.bare) bares from x join gone on x.bare = gone.bare
   where x.doc_id is distinct from gone.holder group by x.rn),
cut as (select n.*, string_split(text, chr(10)) lines,
   list_filter(string_split(text, chr(10)), lambda l: not coalesce(list_contains(hit.bares, {bare.format('l')}), false)) kept
   from n left join hit on n.rn = hit.rn)"""


@query("op9_line_dedup", f"""with {lines_sql()}
select doc_id, cast(coalesce(len(lines), 0) as bigint) n_lines, cast(coalesce(len(lines) - len(kept), 0) as bigint) n_removed,
  case when text is not null then sha256(array_to_string(kept, chr(10))) end kept_sha256 from cut""")
def line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = lines.drop_boilerplate(docs)
    whole = F.greatest(F.size("lines"), F.lit(0))
    return out.select("row.doc_id", whole.cast("bigint").alias("n_lines"),
                      (whole - F.greatest(F.size("kept"), F.lit(0))).cast("bigint").alias("n_removed"),
                      F.when(F.col("lines").isNotNull(), F.sha2(F.array_join("kept", "\n"), 256)).alias("kept_sha256"))
