"""Queries of the manifest, of packing and of periodic runs."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from lotwise.llm import merkle, packing, runs
from lotwise.llm.registry import query, table


def word_tokenizer() -> str:
    """Definition of the public word tokenizer, read where the query is built and sent to the workers."""
    import public_tokenizers
    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


# The checksum of a number's decimal digits, one bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::bigint)),
   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""
_LEAF = "sha256(concat({}))".format(", ".join(
    f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text")))
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@query("op11_merkle_manifest", f"""
with recursive d as (select doc_id, coalesce('=' || lang, '') g, {_LEAF.format(n_chars='n_chars')} leaf, {_LEAF.format(n_chars='(n_chars + 1)')} other,
   {_CRC.format('(doc_id::varchar)')} % 7 = 0 bad from documents),
l as (select *, row_number() over (partition by g order by doc_id) - 1 spot, count(*) over (partition by g) n from d),
t as (select g, 0 lvl, spot pos, leaf h, n from l
   union all select g, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from t where n > 1 group by g, lvl, pos // 2, n),
s as (select g, h subroot, row_number() over (order by encode(g)) - 1 spot, count(*) over () n from t where n = 1),
u as (select 0 lvl, spot pos, subroot h, n from s
   union all select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from u where n > 1 group by lvl, pos // 2, n),
r as (select h root from u where n = 1),
steps as (select l.doc_id, 0 tier, t.lvl, (l.spot >> t.lvl) & 1 side, o.h sib from l join t on t.g = l.g and t.n > 1 and t.pos = l.spot >> t.lvl
     left join t o on o.g = t.g and o.lvl = t.lvl and o.pos = xor(t.pos, 1)
   union all select l.doc_id, 1, u.lvl, (s.spot >> u.lvl) & 1, o.h from l join s using (g) join u on u.n > 1 and u.pos = s.spot >> u.lvl
     left join u o on o.lvl = u.lvl and o.pos = xor(u.pos, 1)),
k as (select *, row_number() over (partition by doc_id order by tier, lvl) nr from steps),
p as (select doc_id, sha256(coalesce(string_agg(sib, '' order by nr), '')) proof, max(nr) most from k group by doc_id),
f as (select doc_id, 0::bigint nr, case when bad and n_ok then other else leaf end h from (select *, other is not null n_ok from l)
   union all select f.doc_id, k.nr, sha256(case when k.sib is null then f.h when k.side = 0 then f.h || k.sib else k.sib || f.h end)
     from f join k on k.doc_id = f.doc_id and k.nr = f.nr + 1),
e as (select doc_id, arg_max(h, nr) folded_root from f group by doc_id)
select l.doc_id, l.leaf, s.subroot, r.root, coalesce(p.proof, sha256('')) proof_sha256, e.folded_root, e.folded_root = r.root verified
from l join s using (g) cross join r left join p using (doc_id) join e using (doc_id)""")
def merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(docs, COLUMNS, {"n_chars": F.col("n_chars") + 1}, bad).drop("lang")


@query("op12_packing")
def packed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack(docs, word_tokenizer())
    return out.select("row.doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def with_planted_run(doc_id, text):
    """The text, of which some documents repeat a stretch of their words up to the end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size("words").cast("bigint")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("bigint")
    head, unit = F.slice("words", F.lit(1), a.cast("int")), F.slice("words", (a + 1).cast("int"), p.cast("int"))
    again = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    return F.when(h % 10 == 0, words), F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, again), " ")).otherwise(text)


@query("op13_periodic_runs")
def periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words, text = with_planted_run(F.col("doc_id"), F.col("text"))
    rows = docs.withColumn("words", words).select("doc_id", text.alias("text"))
    out = runs.periodic_runs(rows, keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = F.col("best.length"), -F.col("best.short")
    return out.withColumn("best", best).select(
        "row.doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.back")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
