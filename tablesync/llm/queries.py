"""One query for each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, jaccard, kneser_ney, language, merkle, packing, pii, quality, sharding, spelling, topk, urls, warc

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(buckets: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
g as (select hex, min(page_id) as first from p group by hex)
select page_id, strlen(html)::bigint as payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(p.hex, 1 + (i // 4) * 5, 5))::int >> (15 - 5 * (i % 4))) & 31)::int, 1)), 'string_agg', '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from p join g using (hex)
"""


@_query("op1_warc", OP1_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    root, lines = warc.write_archives(pages.select(F.col("page_id").alias("id"), "url", F.col("html").cast("binary").alias("payload")))
    found = warc.lookup(warc.build_index(root, lines), pages.select(warc.url_key(F.col("url")).alias("key")))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.learn_quality(docs.select("doc_id", "text"), labels.where(_fold(4) != 2).select("doc_id", "quality"))
    return quality.score_quality(docs, model).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.learn_languages(docs.where(_fold(5) != 0).select("doc_id", "text", "lang"))
    return language.predict_language(docs, model).select("doc_id", (_fold(5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


@_query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_passages(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP5_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as ws from documents),
t as (select doc_id, len(ws) as k, unnest(ws) as a, generate_subscripts(ws, 1) as i from w),
f as (select doc_id, k, i, hash(a, lead(a, 1) over d, lead(a, 2) over d, lead(a, 3) over d, lead(a, 4) over d) as g
      from t window d as (partition by doc_id order by i)),
e as (select distinct doc_id, g from f where i <= greatest(k - 4, 1)),
s as (select w.doc_id, count(e.g)::bigint as n from w left join e using (doc_id) group by w.doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as n from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by all),
o as (select c.a, c.b from c join s x on x.doc_id = c.a join s y on y.doc_id = c.b where 180 * c.n >= 80 * (x.n + y.n)),
l as (select a, b from o union all select b, a from o),
r as (select doc_id, doc_id as other from s union select r.doc_id, l.b from r join l on l.a = r.other)
select s.doc_id, any_value(s.n) as n_shingles, min(r.other) as component_id from s join r using (doc_id) group by s.doc_id
"""


@_query("op5_jaccard", OP5_SQL)
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=5, percent=80)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@_query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.learn_pii(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    place = F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"], F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"]).alias("place"), s["end"], s["kind"]))
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.array_sort(place)).alias("spans"))


@_query("op7_kneser_ney")
def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = kneser_ney.learn(docs.where(_fold(10) != 0).select("text"))
    return kneser_ney.score(docs, model).select(
        "doc_id", (_fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


OP8_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scored)
select query_id, r::int as rank, vec_id, score from ranked where r <= 5
"""


@_query("op8_top_k", OP8_SQL)
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"), k=5)


def tokenizer_files() -> tuple[str, str, str]:
    import public_tokenizers as files

    return files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN


@_query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(_table(spark, sf_dir, "documents"), *tokenizer_files()), capacity=1024)


@_query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows, 24, seed=20240).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# CRC-32 in SQL, byte by byte and bit by bit
def _crc32_sql(text: str) -> str:
    octets = f"list_transform(range(0, octet_length(encode({text}))::bigint), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::bigint, 2))::bigint)"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, d: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {octets}), lambda a, b: {bits}))"


def _leaf_sql(text: str) -> str:
    def told(c):
        return f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')"

    return f"sha256({' || '.join(map(told, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree_sql(name: str, leaves: str, tree: str) -> str:
    """Levels of the trees over ``leaves`` (tree, pos, n, h) and the siblings of every node."""
    return f"""
{name}(lvl, tree, pos, n, h) as (
  select 0::bigint, {tree}, pos, n, h from {leaves}
  union all
  select lvl + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' order by pos)) from {name} where n > 1 group by lvl, tree, pos // 3, n),
{name}_beside as (
  select lvl, tree, pos,
    coalesce(string_agg(h, '') over (run order by pos rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '') over (run order by pos rows between 1 following and unbounded following), '') as r
  from {name} where n > 1 window run as (partition by lvl, tree, pos // 3)),
{name}_top as (select tree, h, max(lvl) as lvl from {name} where n = 1 group by tree, h)"""


OP11_SQL = f"""
with recursive docs as (
  select doc_id, coalesce('=' || source, '') as tree, {_leaf_sql('text')} as h,
    case when {_crc32_sql('doc_id::varchar')} % 2 = 0 then {_leaf_sql("replace(text, chr(10), '')")} else {_leaf_sql('text')} end as seen from documents),
leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as pos, count(*) over (partition by tree) as n,
    row_number() over () as id from docs),
{_tree_sql('low', 'leaves', 'tree')},
groups as (select tree as name, h, row_number() over (order by tree) - 1 as pos, count(*) over () as n from low where n = 1),
{_tree_sql('high', 'groups', "''")},
steps as (
  select id, row_number() over (partition by id order by part, lvl) as step, l, r from (
    select id, 0 as part, b.lvl, l, r from leaves v join low_beside b on b.tree = v.tree and b.pos = v.pos // (3 ** b.lvl)::bigint
    union all
    select id, 1, b.lvl, l, r from leaves v join groups g on g.name = v.tree join high_beside b on b.pos = g.pos // (3 ** b.lvl)::bigint)),
fold(id, step, h) as (
  select id, 0::bigint, seen from leaves
  union all
  select f.id, f.step + 1, sha256(s.l || f.h || s.r) from fold f join steps s on s.id = f.id and s.step = f.step + 1),
ends as (select id, max_by(h, step) as h from fold group by id),
proofs as (select id, sha256(string_agg(l || r, '' order by step)) as h from steps group by id)
select v.doc_id, v.h as leaf, g.h as subroot, t.h as root, coalesce(p.h, sha256('')) as proof_sha256, e.h as folded_root, e.h = t.h as verified
from leaves v join groups g on g.name = v.tree join (select h from high where n = 1) t on true
left join proofs p using (id) join ends e using (id)
"""


@_query("op11_merkle", OP11_SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    def as_leaf(text: Column) -> Column:
        return merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    bare = F.when(_fold(2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = _table(spark, sf_dir, "documents").select("doc_id", "source", as_leaf(F.col("text")).alias("leaf"), as_leaf(bare).alias("seen"))
    built = merkle.build(rows, F.col("source"), F.col("doc_id"), F.col("leaf"))
    back = merkle.folded(F.col("row.seen"), F.col("path"))
    return built.select(
        "row.doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


OP12_SQL = f"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) as run
  from documents),
counted as (select doc_id, run, count(*) as times from runs group by all),
marked as (select run, times, {_crc32_sql("coalesce(doc_id::varchar, '') || ':' || run")} as h from counted),
slipped as (
  select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run) + 2)::int) else run end as word, times from marked),
words as (select word, sum(times)::bigint as n from slipped where length(word) >= 5 group by word having sum(times) >= 3),
cuts as (select word, n, i, substr(word, 1, (i - 1)::int) || substr(word, (i + 1)::int) as cut from words, lateral (select unnest(range(1, length(word) + 1)) as i)),
near as (
  select a.word, a.n, b.word as other, b.n as m from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
  union select a.word, a.n, b.word, b.n from cuts a join words b on a.cut = b.word
  union select b.word, b.n, a.word, a.n from cuts a join words b on a.cut = b.word),
best as (select word, other, m, count(*) over (partition by word) as n_near, row_number() over (partition by word order by m desc, other) as r from near),
formed as (
  select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near, case when b.m >= 2 * w.n then b.other end as form, case when b.m >= 2 * w.n then b.m end as form_n
  from words w left join best b on b.word = w.word and b.r = 1),
chain as (
  select word, word as at, form as next from formed
  union all
  select c.word, f.word, f.form from chain c join formed f on f.word = c.next)
select f.word, f.n, f.n_near, f.form, f.form_n, c.at as root from formed f join chain c on c.word = f.word and c.next is null
"""


@_query("op12_spelling", OP12_SQL)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _table(spark, sf_dir, "documents").select("doc_id", F.explode(spelling.lowered_runs(F.col("text"))).alias("run"))
    found = spelling.variants(runs.select(spelling.with_slips(F.col("doc_id"), F.col("run")).alias("word")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


RULES = (urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/"))


@_query("op13_url_filter")
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "score")
